"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three lower-cased code points (letters and the blanks
between words).  Document frequencies are counted by Spark over all rows that may be learnt
from.  The weights are fitted by follow-the-regularised-leader (FTRL-proximal) with an
elastic-net penalty, on a sample of at most ``sample_rows`` rows that the same rows give;
rows of the sample that the fit did not see set a softmax temperature.

Texts are scored one Arrow batch at a time: a text's logits are the mean, over its n-grams, of
the rows ``scale x idf x weight`` of a table of ``BUCKETS`` x languages, whose size is fixed.

Defined cases
    null text, no letter   ``und``, score 0.0
    null lang              not learnt from; predicted like any other
    null doc_id            hashed as the empty text: held out
    empty table, or no row to learn from
                           every text is ``und`` with score 0.0
    one language only      it is predicted wherever there is a letter
    repeated rows          one output row per input row
    further columns        not read
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import batch_of

BUCKETS = 1 << 15
SAMPLE_ROWS = 2400      # most rows the weights are fitted on, spread evenly over the languages
UNKNOWN = "und"
SCALE = 50.0            # of the features: shares of n-grams are small numbers
STEPS = 4000            # examples shown to the fit at least, in whole passes over the sample

# Odd multipliers that spread n-grams of each order over the buckets.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


_CLASS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point: 1 if it is a letter."""
    if not _CLASS:
        _CLASS.append(np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False
                                for c in range(0x110000)], dtype=bool))
    return _CLASS[0]


def grams(text: str | None) -> np.ndarray:
    """Buckets of all n-grams of a text; none if it has no letter."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return np.zeros(0, dtype=np.int64)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]                      # one blank after each word
    x = np.where(is_letter, points, 32)[keep].astype(np.uint64)
    x = np.concatenate([np.array([32], dtype=np.uint64), x])
    shift = np.uint64(64 - 15)
    one = x * MIX[0]
    two = (x[:-1] + x[1:] * np.uint64(0x100000001B3)) * MIX[1]
    three = (x[:-2] + x[1:-1] * np.uint64(0x100000001B3) + x[2:] * np.uint64(0x1B873593CC9E2D51)) * MIX[2]
    return (np.concatenate([one[1:], two, three]) >> shift).astype(np.int64)


def frequencies(docs: DataFrame) -> DataFrame:
    """``bucket``, ``df``: the number of texts that have an n-gram in the bucket."""
    out = pa.schema([("bucket", pa.int64()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        mark = np.zeros(BUCKETS, dtype=bool)
        for b in batches:
            for t in b.column(0).to_pylist():
                mark[:] = False
                mark[grams(t)] = True
                total += mark
        some = np.flatnonzero(total)
        yield batch_of(out, [some, total[some]])

    return (docs.select("text").mapInArrow(run, "bucket long, df long")
            .groupBy("bucket").agg(F.sum("df").alias("df")))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray        # BUCKETS x languages: scale times idf times weight
    bias: np.ndarray
    temperature: float

    def logits(self, buckets: np.ndarray) -> np.ndarray:
        return self.table[buckets].mean(axis=0) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        buckets = grams(text)
        if not len(buckets) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(buckets) / self.temperature)
        k = int(np.argmax(p))
        return self.langs[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int,
         alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal for the softmax loss.  ``rows``: (features, values) of each example; the
    bias is the last feature.  Weights whose accumulated gradient stays under ``l1`` are zero."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def weights(f: np.ndarray) -> np.ndarray:
        zf = z[f]
        return np.where(np.abs(zf) <= l1, 0.0, -(zf - np.sign(zf) * l1) / ((beta + np.sqrt(n[f])) / alpha + l2))

    order = np.random.default_rng(17)
    for _ in range(max(2, -(-STEPS // len(rows)))):
        for i in order.permutation(len(rows)):
            f, x = rows[i]
            w = weights(f)
            p = softmax(x @ w)
            p[labels[i]] -= 1.0
            g = x[:, None] * p[None, :]
            grown = n[f] + g * g
            z[f] += g - (np.sqrt(grown) - np.sqrt(n[f])) / alpha * w
            n[f] = grown
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least cross-entropy, on a fixed grid.  The true class counts as
    (n + 1) / (n + 2) certain after n rows, the rest is shared by the others, so that rows which
    are all right do not make the classifier certain of everything."""
    n = len(labels)
    if not n or logits.shape[1] < 2:
        return 1.0
    target = np.full(logits.shape, 1.0 / (n + 2) / (logits.shape[1] - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)
    return float(min(np.geomspace(0.05, 20, 121),
                     key=lambda t: -(target * np.log(np.maximum(softmax(logits / t), 1e-300))).sum()))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from ``text`` and non-null ``lang`` of the rows that are not held out."""
    rows = docs.where("lang is not null").where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    seen = np.zeros(BUCKETS)
    for r in frequencies(rows).collect():           # at most BUCKETS rows
        seen[r["bucket"]] = r["df"]
    total = sum(counts.values())
    idf = np.log((1 + total) / (1 + seen)) + 1.0

    # The share of each language that brings it to its part of the sample, by a hash of the text.
    spot = F.shiftrightunsigned(F.xxhash64("text", "doc_id"), 32)
    share = F.lit(0)
    for lang in langs:
        bound = int(min(1.0, sample_rows / len(langs) / counts[lang]) * 2 ** 32)
        share = F.when(F.col("lang") == lang, F.lit(bound)).otherwise(share)
    out = pa.schema([("lang", pa.string()), ("check", pa.bool_()), ("f", pa.list_(pa.int32())), ("c", pa.list_(pa.int32()))])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(grams(t), return_counts=True) for t in b.column(0).to_pylist()]
            yield batch_of(out, [b.column(1), b.column(2), [f.astype(np.int32) for f, _ in found],
                                 [c.astype(np.int32) for _, c in found]])

    sample = (rows.where(spot < share).limit(2 * sample_rows)
              .select("text", "lang", (spot % 5 == 1).alias("check"))
              .mapInArrow(features, "lang string, check boolean, f array<int>, c array<int>").toArrow())
    xs, ys, check = [], [], []
    for lang, c, f, n in zip(*[sample.column(k).to_pylist() if k < 2 else sample.column(k) for k in range(4)]):
        f, n = np.array(f.values, dtype=np.int64), np.array(n.values, dtype=np.float64)
        if len(f):
            xs.append((np.append(f, BUCKETS), np.append(SCALE * idf[f] * n / n.sum(), 1.0)))
            ys.append(langs.index(lang))
            check.append(c)
    ys, check = np.array(ys, dtype=np.int64), np.array(check, dtype=bool)
    if not len(ys):
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    train = np.flatnonzero(~check) if (~check).any() else np.arange(len(ys))
    w, bias = ftrl([xs[i] for i in train], ys[train], len(langs))
    whole = np.vstack([w, bias])
    unseen = np.flatnonzero(check)
    logits = np.array([xs[i][1] @ whole[xs[i][0]] for i in unseen]).reshape(len(unseen), len(langs))
    return Model(langs, (SCALE * idf[:, None] * w).astype(np.float32), bias, best_temperature(logits, ys[unseen]))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, one row per row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, sample_rows))   # fixed size
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.value.predict(t) for t in b.column(1).to_pylist()]
            yield batch_of(out, [b.column(0), b.column(2), [k for k, _ in found], [p for _, p in found]])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))
