"""Quality rules by n-gram perplexity.

A character model of order ``ORDER`` with modified Kneser-Ney smoothing is counted by Spark
over all documents, over every character (UTF-16 unit: a code point beyond 0xFFFF counts as its
two).  An n-gram is the 64 bits of its four units; each order is a table of n-grams with their
counts and those of their contexts, in the shared folder, and grows with the corpus.

For scoring, the n-grams of the highest order lie in arrays sorted by a one-to-one hash of their bits, with
their negative log-probabilities beside them; the leading bits of a hash give the place where to look.
Every worker holds those of the most frequent n-grams, ``BROADCAST_GRAMS`` of them at most.  A text's n-grams
that are not among them are counted and joined to the table of all the others: every n-gram of a text
has its probability of the one model, wherever it is kept.

A document is rejected by the base rules, or if its log-perplexity leaves the band of its
language.  A band reaches ``REACH`` interquartile ranges beyond the quartiles of the documents
that pass the base rules, and never less than ``LEAST`` nats from the median (so a corpus with
many near copies of one text does not get a band that fits only those); a short text, whose
mean varies by chance, gets ``NOISE / sqrt(characters)`` more on both sides.

Defined cases
    a NUL in a text     a blank, as other white space
    null or empty text  no words: fails the base rules; log-perplexity null
    null lang           a language of its own
    null doc_id         passed through
    repeated rows       one output row per input row; equal texts count once for the bands
    a language without a document that passes the base rules
                        has no band: nothing more is rejected
    empty table         no rows
    further columns     not read
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import batch_of, stored
from lessonlens.llm.suffixes import mixed

ORDER = 4
END = 0                  # the unit that stands before and after every text
REACH = 3.0
LEAST = 0.12
NOISE = 1.0              # added: this over the root of the number of characters, for short texts
CHUNK = 1 << 20          # n-grams looked at together
HELD_COUNTS = 1 << 22    # different n-grams a task counts before it sends them
UNITS = 1 << 16
BROADCAST_GRAMS = 1_000_000      # 12 bytes each and 8 to 16 for their places

# Fixed values of the base rules.
SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
LEAST_WORDS = 50
MOST_REPEATED = 50       # per cent of the words


def units(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), dtype=np.uint16)


def folded(point: np.ndarray) -> np.ndarray:
    """Digits count as 0, white space as a blank."""
    digit = (point >= 48) & (point <= 57)
    white = ((point >= 9) & (point <= 13)) | (point == 0xA0) | (point == END)
    return np.where(digit, 48, np.where(white, 32, point))


FOLD = folded(np.arange(UNITS)).astype(np.uint16)


def packed(u: np.ndarray) -> np.ndarray:
    """The n-grams of neighbouring units, 64 bits each."""
    pairs = u[:-1].astype(np.uint64) << np.uint64(16) | u[1:]
    return pairs[:-2] << np.uint64(32) | pairs[2:]


def gram_chunks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The n-grams that end at each character of the texts and at their ends, in chunks: the place of the
    text of each part, the part's number of n-grams, and the n-grams of all parts.  A long text is cut into
    parts from its beginning, whatever stands before it."""
    of, size, parts, waiting = [], [], [], 0
    for k, t in enumerate(texts):
        if not t:
            continue
        u = np.concatenate([np.full(ORDER - 1, END, np.uint16), FOLD[units(t)], np.full(1, END, np.uint16)])
        for at in range(0, len(u) - ORDER + 1, CHUNK):
            part = packed(u[at:at + CHUNK + ORDER - 1])
            of.append(k)
            size.append(len(part))
            parts.append(part)
            waiting += len(part)
            if waiting >= CHUNK:
                yield np.array(of), np.array(size), np.concatenate(parts)
                of, size, parts, waiting = [], [], [], 0
    if parts:
        yield np.array(of), np.array(size), np.concatenate(parts)


def added(code: np.ndarray, n: np.ndarray, more: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two lists of counts, each in ascending order, as one."""
    both, counts = np.concatenate([code, more]), np.concatenate([n, k])
    order = np.argsort(both, kind="stable")
    both, counts = both[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    return both[new], np.add.reduceat(counts, new)


def count_grams(docs: DataFrame) -> DataFrame:
    """``code`` (64 bits), ``n`` of every n-gram of the corpus."""
    out = pa.schema([("code", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        code, n = nothing
        for b in batches:
            for _, _, some in gram_chunks(b.column(0).to_pylist()):
                code, n = added(code, n, *np.unique(some, return_counts=True))
                if len(code) >= HELD_COUNTS:
                    yield batch_of(out, [code.view(np.int64), n])
                    code, n = nothing
        yield batch_of(out, [code.view(np.int64), n])

    return docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    return discounts_of([int((n == k).sum()) for k in (1, 2, 3, 4)])


def discounts_of(have: list[int]) -> np.ndarray:
    """The same from how many n-grams were counted 1, 2, 3 and 4 times."""
    if min(have) == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = have[0] / (have[0] + 2 * have[1])
    d = [k - (k + 1) * y * have[k] / have[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d))])


def suffix_of(code, order: int):
    """The n-gram without its first unit."""
    return F.col(code).bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))


def smoothed(grams: DataFrame) -> list[DataFrame]:
    """The model's orders from the highest down: ``code``, ``n``, the discounted ``share`` of the n-gram in
    its context, and the context's ``backoff``, the weight of the next lower order.  Lower orders count in
    how many contexts an n-gram was seen."""
    levels, counted = [], grams
    for order in range(ORDER, 0, -1):
        counted = stored(counted)
        d = discounts_of(list(counted.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first())).tolist()
        cut = F.element_at(F.array(*map(F.lit, d[1:])), F.least(F.col("n"), F.lit(3)).cast("int"))
        rows = counted.withColumns({"context": F.shiftrightunsigned("code", 16), "cut": cut})
        context = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("cut").alias("left"))
        levels.append(stored(rows.join(context, "context").select(
            "code", "n", ((F.col("n") - F.col("cut")) / F.col("total")).alias("share"),
            (F.col("left") / F.col("total")).alias("backoff"))))
        counted = counted.groupBy(suffix_of("code", order).alias("code")).agg(F.count("*").alias("n"))
    return levels


def model(grams: DataFrame) -> DataFrame:
    """``code``, ``n``, ``nll`` (negative log-probability of the last unit) of every n-gram.  The lowest order
    leaves the rest to an even share of all units."""
    levels = smoothed(grams)
    p = None
    for order, rows in enumerate(reversed(levels), start=1):
        if p is None:
            lower = F.lit(1.0 / max(1, rows.count()))        # a row for each unit
        else:
            rows = rows.withColumn("suffix", suffix_of("code", order)).join(p.drop("n"), "suffix")
            lower = F.col("p")
        p = rows.select(F.col("code").alias("suffix"), "n", (F.col("share") + F.col("backoff") * lower).alias("p"))
    return stored(p.select(F.col("suffix").alias("code"), "n", (-F.log(F.greatest("p", F.lit(1e-12)))).alias("nll")))


@dataclass
class HashArrays:
    """N-grams as ascending hashes (the last stands for none) with their values; ``first`` is the place of
    the first hash that is not below the given leading bits."""
    key: np.ndarray
    value: np.ndarray
    first: np.ndarray
    shift: int

    @classmethod
    def of(cls, code: np.ndarray, value: np.ndarray) -> HashArrays:
        h = mixed(code)                 # one to one: different n-grams have different hashes
        o = np.argsort(h)
        bits = max(1, int(len(h)).bit_length())
        shift = 64 - bits
        leading = np.arange(1 << bits, dtype=np.uint64) << np.uint64(shift)
        key = np.append(h[o], np.uint64(2 ** 64 - 1))
        return cls(key, np.append(value[o], 0).astype(np.float32), np.searchsorted(key, leading).astype(np.int32), shift)

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each n-gram (0 if it is not here), and whether it is here."""
        h = mixed(code)
        at = self.first[h >> np.uint64(self.shift)]
        later = np.flatnonzero(self.key[at] < h)
        while len(later):
            at[later] += 1
            later = later[self.key[at[later]] < h[later]]
        here = (self.key[at] == h) & (at < len(self.key) - 1)
        return np.where(here, self.value[at], np.float32(0)), here


def divided(table: DataFrame) -> tuple[HashArrays, DataFrame]:
    """The most frequent n-grams as arrays, at most ``BROADCAST_GRAMS``, and the table of all others."""
    digits = F.length(F.bin("n"))       # binary digits of the count
    sizes = table.groupBy(digits.alias("digits")).count().orderBy(F.desc("digits")).collect()      # 64 rows at most
    least, total = 65, 0
    for digit, count in sizes:
        total += count
        if total > BROADCAST_GRAMS:
            break
        least = digit
    held = table.where(digits >= least).select("code", "nll").toArrow()
    arrays = HashArrays.of(held.column(0).to_numpy().view(np.uint64), held.column(1).to_numpy())
    return arrays, table.where(digits < least).select("code", "nll")


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return (len(words), len(text) - int(count[9:14].sum() + count[32]), int(count[SYMBOLS].sum()),
            len(lines) - len(set(lines)), repeated(words))


def repeated(words: list[bytes]) -> int:
    """Words within 3-word windows that the text has twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    if len(known) == len(words):
        return 0
    _, pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    _, where, seen = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = seen[where] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k:k + n] |= again
    return int(covered.sum())


def lists(row: np.ndarray, values: np.ndarray, rows: int) -> pa.ListArray:
    """Values with their rows (ascending) as a list for each of so many rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), pa.array(values))


def score(texts: list[str | None], held: HashArrays) -> list:
    """For each text: how many n-grams it has, the sum of the values of those in ``held``, and the others
    with their counts."""
    n_grams, nll = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    rest = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for of, size, code in gram_chunks(texts):
        value, here = held.find(code)
        np.add.at(n_grams, of, size)
        np.add.at(nll, of, np.add.reduceat(value.astype(np.float64), np.cumsum(size) - size))
        if not here.all():
            row, code = np.repeat(of, size)[~here], code[~here]
            o = np.lexsort((code, row))
            row, code = row[o], code[o]
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (code[1:] != code[:-1])]))
            rest.append((row[new], code[new], np.diff(np.append(new, len(row)))))
    row, code, n = (np.concatenate(x) for x in zip(*rest))
    return [n_grams, nll, lists(row, code.view(np.int64), len(texts)), lists(row, n, len(texts))]


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, the base counts, ``log_ppl`` (null without text) of every row, by the model
    of all of them."""
    arrays, others = divided(model(count_grams(docs)))
    held = docs.sparkSession.sparkContext.broadcast(arrays)     # at most BROADCAST_GRAMS n-grams
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("lang", pa.string()), *((k, pa.int64()) for k in names),
                     ("n_grams", pa.int64()), ("nll", pa.float64()), ("odd", pa.list_(pa.int64())), ("odd_n", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            texts = b.column(1).to_pylist()
            counts = np.array([base_counts(t) for t in texts], dtype=np.int64).reshape(-1, len(names))
            yield batch_of(out, [np.arange(row, row + len(b)), b.column(0), b.column(2), *counts.T, *score(texts, held.value)])
            row += len(b)

    measured = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").mapInArrow(
        run, "row long, doc_id long, lang string, " + ", ".join(f"{k} long" for k in names)
        + ", n_grams long, nll double, odd array<long>, odd_n array<long>"))
    odd = (measured.where(F.size("odd") > 0).select("row", F.explode(F.arrays_zip("odd", "odd_n")).alias("g"))
           .select("row", F.col("g.odd").alias("code"), F.col("g.odd_n").alias("k")))
    odd = odd.join(others.withColumnRenamed("nll", "each"), "code").groupBy("row").agg(F.sum(F.col("k") * F.col("each")).alias("more"))
    # Rounded: equal texts get equal values in whatever order their n-grams are added.
    log_ppl = F.round((F.col("nll") + F.coalesce("more", F.lit(0.0))) / F.col("n_grams"), 9)
    return measured.join(odd, "row", "left").select("doc_id", "lang", *names, F.when(F.col("n_grams") > 0, log_ppl).alias("log_ppl"))


def bands(measured: DataFrame) -> DataFrame:
    """``band_lang``, ``low``, ``high`` of the log-perplexity, one row per language."""
    texts = measured.where(~F.col("base_failed")).select("lang", "n_words", "word_chars", "log_ppl").distinct()
    q = F.percentile_approx("log_ppl", F.lit([0.25, 0.5, 0.75]), 10_000)
    beyond = F.lit(REACH) * (F.col("q")[2] - F.col("q")[0])
    return texts.groupBy(F.col("lang").alias("band_lang")).agg(q.alias("q")).select(
        "band_lang", F.least(F.col("q")[0] - beyond, F.col("q")[1] - LEAST).alias("low"),
        F.greatest(F.col("q")[2] + beyond, F.col("q")[1] + LEAST).alias("high"))


def rules(docs: DataFrame) -> DataFrame:
    """The op8 contract: ``doc_id``, the base counts, ``base_failed``, ``kept``, and ``perplexity``
    with its language's ``low`` and ``high``."""
    measured = stored(measure(docs).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))))
    band = stored(bands(measured))
    noise = NOISE / F.sqrt(F.greatest(F.col("word_chars"), F.lit(1)))
    inside = F.col("log_ppl").between(F.col("low") - noise, F.col("high") + noise)
    return measured.join(band, measured["lang"].eqNullSafe(band["band_lang"]), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
        F.exp("log_ppl").alias("perplexity"), F.exp("low").alias("low"), F.exp("high").alias("high"))
