"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every text is reduced to a fixed row of statistics, in one pass over its bytes.  The trees are
grown on histograms of at most ``BINS`` quantile bins per statistic, for the logistic loss,
from a sample of at most ``sample_rows`` labelled rows that are not held out; grown, they are
flattened into arrays of one complete tree each, which numpy walks for a whole batch of
documents level by level.

Defined cases
    null or empty text   statistics of the empty text; scored like any other
    null quality         that label row is not learnt from
    a doc_id labelled more than once, or documents with one doc_id
                         every pair of a document row and a label row is an example
    null doc_id          hashed as the empty text: held out; never has a label
    nothing to learn from
                         every score is 0.5
    repeated rows        one output row per input row
    empty table          no rows
    further columns      not read
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import stored

THRESHOLD = 0.3
SAMPLE_ROWS = 40_000    # most labelled rows the trees are grown on
BINS = 64

STATISTICS = (
    "bytes", "words", "word_bytes", "long_words", "distinct_words", "top_word", "lines", "dup_lines",
    "short_lines", "line_words", "stops", "stop_words", "upper", "all_caps", "digit", "white", "symbol",
    "punct", "bang", "pipe", "hash_like", "high", "entropy", "bigram_repeat", "trigram_repeat", "ends_in_stop",
    "max_word", "quote", "equals", "capital_starts")

_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_WHITE = np.array([9, 10, 11, 12, 13, 32])
_SYMBOL = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
_PUNCT = np.frombuffer(b".,;:!?\"'()-", dtype=np.uint8)
_CAPS = re.compile(rb"\b[A-Z]{2,}\b")
_HEX = re.compile(rb"[0-9a-fA-F]{16,}|[0-9]{10,}")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def repeats(words: list[bytes], n: int) -> float:
    """Share of n-word windows that are not the first of their kind."""
    total = len(words) - n + 1
    if total < 2:
        return 0.0
    return 1.0 - len(set(zip(*(words[k:] for k in range(n))))) / total


def statistics(text: str | None) -> tuple[float, ...]:
    data = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, len(data))
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    n = max(1, len(words))
    lines = [x for x in (y.strip() for y in data.split(b"\n")) if x]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    forms: dict[bytes, int] = {}
    for w in words:
        forms[w] = forms.get(w, 0) + 1
    tally = np.fromiter(forms.values(), dtype=np.float64, count=len(forms))
    share = tally / n
    stops = int(count[46] + count[33] + count[63])
    return (
        float(len(data)), float(len(words)), float(lengths.mean()) if len(words) else 0.0,
        float((lengths > 14).mean()) if len(words) else 0.0, len(forms) / n,
        float(share.max()) if len(forms) else 0.0, float(len(lines)),
        1.0 - len(set(lines)) / max(1, len(lines)), sum(len(x) < 20 for x in lines) / max(1, len(lines)),
        len(words) / max(1, len(lines)), stops / n, float(tally[tally >= 3].sum()) / n,
        float(count[_UPPER].sum()) / size, len(_CAPS.findall(data)) / n, float(count[_DIGIT].sum()) / size,
        float(count[_WHITE].sum()) / size, float(count[_SYMBOL].sum()) / size, float(count[_PUNCT].sum()) / size,
        float(count[33]) / n, float(count[124]) / n, float(len(_HEX.findall(data))), float(count[128:].sum()) / size,
        float(-(share * np.log(share)).sum() / np.log(n + 1)) if len(forms) else 0.0,
        repeats(words, 2), repeats(words, 3), float(data.rstrip()[-1:] in (b".", b"!", b"?")),
        float(lengths.max()) if len(words) else 0.0, float(count[34] + count[39]) / n, float(count[61]),
        sum(65 <= w[0] <= 90 for w in words) / n)


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out`` and ``x``, the statistics of the text as an array of float."""
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("x", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(STATISTICS)
        for b in batches:
            rows = np.array([statistics(t) for t in b.column(1).to_pylist()], dtype=np.float32).reshape(-1, width)
            x = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, width, dtype=np.int32), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), x.cast(out.field(2).type)], schema=out)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
            .mapInArrow(run, "doc_id long, held_out boolean, x array<float>"))


@dataclass
class Trees:
    """Complete binary trees of one depth, flattened: for each tree, ``2^depth - 1`` inner nodes
    in heap order (statistic and bound; a smaller or equal value goes left) and ``2^depth``
    leaves."""
    base: float
    depth: int
    feature: np.ndarray      # trees x inner nodes
    bound: np.ndarray
    leaf: np.ndarray         # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            margin += leaf[at - (2 ** self.depth - 1)]
        return 1.0 / (1.0 + np.exp(-margin))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
         ridge: float = 2.0, least: float = 3.0) -> Trees:
    """Boosts ``trees`` trees for the logistic loss.  Each level takes, for all its nodes at once,
    histograms of gradient and curvature over the bins and the split of the largest gain."""
    rows, width = x.shape
    if not rows:
        return Trees(0.0, depth, np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0)))
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)]).astype(np.int64)
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(rows, base)
    inner = 2 ** depth - 1
    features, bounds, leaves = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(rows, dtype=np.int64)          # node within the level
        for level in range(depth):
            nodes = 2 ** level
            best = np.zeros(nodes)
            cut = np.zeros((nodes, 2), dtype=np.int64)
            for k in range(width):
                if not len(edges[k]):
                    continue
                cell = at * BINS + binned[k]
                gs = np.bincount(cell, g, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                hs = np.bincount(cell, h, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = (gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge))
                gain[(hs < least) | (ht - hs < least)] = 0.0
                gain[:, len(edges[k]):] = 0.0
                top = gain.argmax(axis=1)
                value = gain[np.arange(nodes), top]
                better = value > best + 1e-9
                best[better] = value[better]
                cut[better] = np.stack([np.full(nodes, k), top], axis=1)[better]
            first = nodes - 1
            for node in np.flatnonzero(best > 0):
                feature[first + node], bound[first + node] = cut[node, 0], edges[cut[node, 0]][cut[node, 1]]
            limit = np.where(best > 0, cut[:, 1], BINS)
            at = 2 * at + (binned[cut[at, 0], np.arange(rows)] > limit[at])
        gs, hs = np.bincount(at, g, 2 ** depth), np.bincount(at, h, 2 ** depth)
        leaf = -rate * gs / (hs + ridge)
        margin += leaf[at]
        features.append(feature)
        bounds.append(bound)
        leaves.append(leaf)
    return Trees(base, depth, np.array(features), np.array(bounds), np.array(leaves))


def wanted(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``label_id``, ``quality``: the labels to learn from, none of a held-out document; of more than
    ``sample_rows`` a share by the hash of the id."""
    rows = labels.where("quality is not null").where("doc_id is not null").where(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("double").alias("quality"))
    share = int(min(1.0, sample_rows / max(1, rows.count())) * 2 ** 32)
    return rows.where(F.shiftrightunsigned(F.xxhash64("label_id"), 32) < share).limit(2 * sample_rows)


def fit(described: DataFrame, some: DataFrame) -> Trees:
    """Grows the trees from the rows of ``described`` that ``some`` (of ``wanted``) labels."""
    rows = (described.join(some, described["doc_id"] == some["label_id"])
            .select("doc_id", "x", "quality").toArrow().sort_by([("doc_id", "ascending"), ("quality", "ascending")]))
    x = np.array(rows.column("x").combine_chunks().flatten(), dtype=np.float32).reshape(-1, len(STATISTICS))
    return grow(x, (rows.column("quality").to_numpy() > 0.5).astype(np.float64))


def scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` (1 if score >= threshold), per row."""
    described = stored(describe(docs))
    trees = docs.sparkSession.sparkContext.broadcast(fit(described, wanted(labels, sample_rows)))   # fixed size
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(2).flatten(), dtype=np.float32).reshape(len(b), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(trees.value.score(x))], schema=out)

    return (described.select("doc_id", "held_out", "x")
            .mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, scored where they are: the trees
    travel to the rows, so no text is shuffled."""
    some = stored(wanted(labels))
    ids = some.select("label_id").distinct()
    # at most 2 * SAMPLE_ROWS ids: only labelled texts are described for the fit, each text once more for its score
    labelled = docs.join(F.broadcast(ids), docs["doc_id"].cast("long") == ids["label_id"], "left_semi")
    trees = docs.sparkSession.sparkContext.broadcast(fit(stored(describe(labelled)), some))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in b.column(at).to_pylist()], dtype=np.float32)
            if len(x):
                yield b.filter(pa.array(trees.value.score(x.reshape(len(b), -1)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
