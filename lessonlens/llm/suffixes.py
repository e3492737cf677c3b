"""Exact removal of repeated byte strings by sampled, range-partitioned suffixes.

Which bytes lie in a ``LENGTH``-byte string that also starts earlier?  Sorting every suffix of
the corpus would answer it at a hundred times the corpus' size, so only some suffixes are
sorted, chosen by their content: the suffix that begins at the least hash of ``TOKEN`` bytes
among those within a ``LENGTH``-byte window.  Equal windows choose the same suffix at the same
place, so nothing is missed.  Neighbouring windows mostly share one; a suffix is sorted once
for all the windows it serves, with the tokens

    lead      hash of its first ``TOKEN`` bytes
    span      hash of all bytes of the windows it serves, before and after it

Splitters sampled from the tokens cut their order into ranges.  Each range is sorted locally
by multikey quicksort: suffixes with equal tokens serve equal windows, and all but the first
of them are repeats.  Suffixes that share the lead but not the span may still share some
windows; these are resolved the same way, one window at a time, in a second round (a lead
that meets a splitter may go on in the next range, so its suffixes go to the second round in
any case).  Before each shuffle a task drops what its own rows already show to be repeats, so
a text with any number of copies sends a record a task.

Hashes are 64 bits and only compared where a second, independent 64 bits agree.

Defined cases
    null or empty text, text shorter than ``LENGTH``
                        nothing is removed
    null doc_id         comes before all others
    rows with one doc_id but different texts
                        are different documents, in the order of a hash of the text
    rows with one doc_id and the same text
                        are one document, whose result each row gets
    empty table         no rows
    further columns     not read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import batch_of, stored

LENGTH = 100
TOKEN = 32
SPREAD = LENGTH - TOKEN + 1          # places in a window where a token may begin
PIECE = 1 << 23                      # bytes hashed at a time; places within fit 24 bits
PLACE = np.uint64((1 << 24) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of every element."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


# Hash of every byte value, and odd multipliers by which two halves are joined.
BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
JOIN = mixed(np.arange(1001, 1009, dtype=np.uint64)) | np.uint64(1)


def doubled(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 32 and of the 64 bytes from each place (as far as there are so many)."""
    h = BYTE[data]
    out = []
    for k in range(6):
        n = 1 << k
        h = h[:-n] * JOIN[k] + h[n:] if len(h) > n else h[:0]
        h ^= h >> np.uint64(29)
        if n >= 16:
            out.append(h)
    return out[0], out[1]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def chosen(data: np.ndarray, h32: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of ``data``: the first and last window that each chosen suffix serves, and
    where the suffix begins."""
    ranked = (mixed(h32) & ~PLACE) | np.arange(len(h32), dtype=np.uint64)
    place = (sliding_least(ranked, SPREAD) & PLACE).astype(np.int64)
    change = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate([[0], change])
    return first, np.concatenate([change - 1, [len(place) - 1]]), place[first]


def windows_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the bytes of one text, for each chosen suffix: lead, span, first window, number of windows."""
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(data) - LENGTH + 1, PIECE - LENGTH):
        piece = data[at:at + PIECE]
        if len(piece) < LENGTH:
            break
        h32, h64 = doubled(piece)
        first, last, place = chosen(piece, h32)
        size = last - first + LENGTH              # at most 168 bytes: three runs of 64 cover them
        span = (mixed(h64[first] * np.uint64(3) + mixed(h64[first + np.minimum(50, size - 64)]))
                + mixed(h64[last + LENGTH - 64] + (size * 256 + place - first).astype(np.uint64)))
        found.append((h32[place], span, first + at, last - first + 1))
        if at + PIECE >= len(data):
            break
    return tuple(np.concatenate(x) for x in zip(*found))


def window_hashes(data: np.ndarray, first: int, n: int) -> np.ndarray:
    """Hashes of ``n`` neighbouring windows."""
    _, h64 = doubled(data[first:first + n - 1 + LENGTH])
    return mixed(h64[:n] * np.uint64(5) + mixed(h64[LENGTH - 64:LENGTH - 64 + n]))


def multikey_order(tokens: list[np.ndarray], small: int = 1 << 14) -> np.ndarray:
    """The order of rows by their tokens, by multikey quicksort: three-way partition by one token,
    rows equal in it go on with the next; small parts are sorted directly."""
    order = np.arange(len(tokens[0]))
    todo = [(0, len(order), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        rows = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = rows[np.lexsort([t[rows] for t in reversed(tokens[depth:])])]
            continue
        value = tokens[depth][rows]
        some = np.sort(value[::max(1, len(value) // 64)])
        pivot = some[len(some) // 2]
        less, more = value < pivot, value > pivot
        equal = ~(less | more)
        order[lo:hi] = np.concatenate([rows[less], rows[equal], rows[more]])
        a, b = lo + int(less.sum()), hi - int(more.sum())
        todo += [(lo, a, depth), (b, hi, depth)]
        if depth + 1 < len(tokens):
            todo.append((a, b, depth + 1))
    return order


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in any of the columns."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def joined(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows of one document that follow one another become one run."""
    if not len(doc):
        return doc, tie, start, n
    o = np.lexsort((start, tie, doc))
    doc, tie, start, n = doc[o], tie[o], start[o], n[o]
    new = starts(doc, tie)
    new[1:] |= start[1:] > start[:-1] + n[:-1]
    at = np.flatnonzero(new)
    end = np.maximum.reduceat(start + n, at)
    return doc[at], tie[at], start[at], end - start[at]


# ---------------------------------------------------------------- the jobs

CHUNK = 1 << 20          # suffixes a task looks at together before it sends them
BUCKET_ROWS = 400_000    # suffixes wanted in a range
SPLITTERS = 1 << 20      # most splitters
SAMPLED = 16             # sampled suffixes for each splitter
HOT = 1000               # texts with one lead from which its windows are dealt out singly

NULL_ID = -(1 << 63)     # stands for a null doc_id within the jobs

SUFFIX = pa.schema([(k, pa.int64()) for k in ("bucket", "lead", "span", "doc", "tie", "start", "n")])
RUN = pa.schema([(k, pa.int64()) for k in ("doc", "tie", "start", "n", "lead", "state")])
REPEAT, UNSURE, UNSURE_HOT = 0, 1, 2
WINDOW = pa.schema([("bucket", pa.int64()), ("lead", pa.int64()), ("doc", pa.int64()), ("tie", pa.int64()),
                    ("start", pa.int64()), ("hashes", pa.binary())])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'long'}" for f in schema)


def keyed(docs: DataFrame) -> DataFrame:
    """``doc``, ``tie``, ``text``: the id (a stand-in for null) and a hash to tell texts of one id apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"),
                       F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie"), "text")


def bytes_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def sample_splitters(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Leads and spans that cut the order of all suffixes into ranges of about ``BUCKET_ROWS``."""
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    suffixes = 2 * (size["bytes"] or 0) // SPREAD
    ranges = min(SPLITTERS, max(1, suffixes // BUCKET_ROWS))
    if ranges == 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    share = min(1.0, (ranges * SAMPLED + 1000) / suffixes)
    out = pa.schema([("lead", pa.int64()), ("span", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0).to_pylist():
                data = bytes_of(t)
                if len(data) >= LENGTH:
                    lead, span, _, _ = windows_of(data)
                    some = mixed(lead + span) < np.uint64(int(share / part * 2 ** 64 * (1 - 1e-9)))
                    yield batch_of(out, [lead[some].view(np.int64), span[some].view(np.int64)])

    # Few texts give more suffixes each, unless all of them are needed.
    part = max(share, min(1.0, 4000 / max(1, size["n"])))
    texts = docs.where(F.shiftrightunsigned(F.xxhash64("tie", "doc"), 32) < int(part * 2 ** 32)).select("text")
    rows = texts.mapInArrow(run, "lead long, span long").toArrow()
    lead, span = (rows.column(k).to_numpy().view(np.uint64) for k in range(2))
    order = np.lexsort((span, lead))
    at = order[np.linspace(0, len(order), ranges + 1)[1:-1].astype(int)] if len(order) else order
    keep = starts(lead[at], span[at]) if len(at) else np.zeros(0, bool)
    return lead[at][keep], span[at][keep]


def bucket_of(lead: np.ndarray, span: np.ndarray, splitters: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The range of each suffix: the number of splitters that are not greater."""
    left, right = (np.searchsorted(splitters[0], lead, side=s) for s in ("left", "right"))
    for k in np.flatnonzero(left != right):       # a lead that is a splitter's: few rows
        left[k] += np.searchsorted(splitters[1][left[k]:right[k]], span[k], side="right")
    return left


def suffix_rows(docs: DataFrame, splitters: Broadcast) -> DataFrame:
    """The chosen suffixes of all texts by range; of those with equal tokens that a task meets
    together, the first.  The others are sent on as runs of repeated windows (``n`` below zero)."""

    def send(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        lead, span, doc, tie, start, n = (np.concatenate(x) for x in zip(*parts))
        o = np.lexsort((start, tie, doc, span, lead))
        lead, span, doc, tie, start, n = (x[o] for x in (lead, span, doc, tie, start, n))
        once = starts(lead, span, doc, tie, start)     # rows repeated in the table are one
        lead, span, doc, tie, start, n = (x[once] for x in (lead, span, doc, tie, start, n))
        first = starts(lead, span)
        runs = joined(doc[~first], tie[~first], start[~first], n[~first])
        none = np.zeros(len(runs[0]), dtype=np.int64)
        sent = bucket_of(lead[first], span[first], splitters.value)
        spread = (mixed(runs[0].view(np.uint64)) % np.uint64(len(splitters.value[0]) + 1)).astype(np.int64)
        columns = [(sent, spread), (lead[first].view(np.int64), none), (span[first].view(np.int64), none),
                   (doc[first], runs[0]), (tie[first], runs[1]), (start[first], runs[2]), (n[first], -runs[3])]
        return batch_of(SUFFIX, [np.concatenate(c) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for b in batches:
            for doc, tie, text in zip(*(c.to_pylist() for c in b.columns)):
                data = bytes_of(text)
                if len(data) < LENGTH:
                    continue
                lead, span, start, n = windows_of(data)
                waiting.append((lead, span, np.full(len(lead), doc), np.full(len(lead), tie), start, n))
                size += len(lead)
                if size >= CHUNK:
                    yield send(waiting)
                    waiting, size = [], 0
        if waiting:
            yield send(waiting)

    return docs.mapInArrow(run, ddl(SUFFIX))


def sort_range(table: pa.Table, splitters: Broadcast) -> pa.Table:
    """One range of suffixes: runs of repeated windows, and the suffixes that need a closer look."""
    _, lead, span, doc, tie, start, n = (c.to_numpy() for c in table.columns)
    done = n < 0
    parts = [(doc[done], tie[done], start[done], -n[done], np.zeros(done.sum(), np.int64), np.full(done.sum(), REPEAT))]
    lead, span, doc, tie, start, n = (x[~done] for x in (lead.view(np.uint64), span.view(np.uint64), doc, tie, start, n))
    if len(lead):
        o = multikey_order([lead, span, doc, tie, start])
        lead, span, doc, tie, start, n = (x[o] for x in (lead, span, doc, tie, start, n))
        once = starts(lead, span, doc, tie, start)
        lead, span, doc, tie, start, n = (x[once] for x in (lead, span, doc, tie, start, n))
        new_lead, new_span = starts(lead), starts(lead, span)
        group = np.cumsum(new_lead) - 1
        texts = np.bincount(group, new_span).astype(np.int64)[group]
        across = np.isin(lead, splitters.value[0])       # may go on beyond the range
        state = np.where(~new_span, REPEAT, np.where(across | (texts >= HOT), UNSURE_HOT, UNSURE))
        keep = ~new_span | across | (texts > 1)
        parts.append(tuple(x[keep] for x in (doc, tie, start, n, lead.view(np.int64), state)))
    return pa.table([np.concatenate(x) for x in zip(*parts)], schema=RUN)


def packed(docs: DataFrame) -> DataFrame:
    """``doc``, ``tie`` and the text's bytes compressed (``z``), in which form texts are shuffled."""
    out = pa.schema([("doc", pa.int64()), ("tie", pa.int64()), ("z", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            yield batch_of(out, [b.column(0), b.column(1), [squeeze(bytes_of(t).tobytes()) for t in b.column(2).to_pylist()]])

    return docs.mapInArrow(run, ddl(out))


def unpacked(z: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(z) if z else b"", dtype=np.uint8)


def by_document(runs: DataFrame, *columns: str) -> DataFrame:
    """The runs of each document as one list (as long as the text at most)."""
    return runs.groupBy("doc", "tie").agg(F.collect_list(F.struct(*columns)).alias("runs"))


def columns_of(runs: pa.ListScalar, k: int) -> list[np.ndarray]:
    fields = runs.values.flatten() if runs.is_valid else [np.zeros(0, np.int64)] * k
    return [np.asarray(x, dtype=np.int64) for x in fields]


def window_rows(texts: DataFrame, unsure: DataFrame, buckets: int) -> DataFrame:
    """Hashes of all windows that unsure suffixes serve: a row for each suffix, dealt by its lead, or a
    row for each window, dealt by lead and hash, where the lead is a hot one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, tie, z, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                data = unpacked(z)
                for start, n, lead, state in set(zip(*(c.tolist() for c in columns_of(runs, 4)))):
                    h = window_hashes(data, start, n)
                    if state == UNSURE_HOT:
                        dealt = (mixed(h + np.uint64(lead % 2 ** 64)) % np.uint64(buckets)).tolist()
                        rows += [(dealt[k], lead, doc, tie, start + k, h[k].tobytes()) for k in range(n)]
                    else:
                        rows.append((lead % buckets, lead, doc, tie, start, h.tobytes()))
            if rows:
                yield batch_of(WINDOW, list(zip(*rows)))

    lists = by_document(unsure, "start", "n", "lead", "state")
    return texts.join(lists, ["doc", "tie"]).select("doc", "tie", "z", "runs").mapInArrow(run, ddl(WINDOW))


def sort_windows(table: pa.Table) -> pa.Table:
    """Runs of the windows that come earlier as well."""
    lead, doc, tie, start = (table.column(k).to_numpy() for k in ("lead", "doc", "tie", "start"))
    raw = table.column("hashes").to_pylist()
    n = np.array([len(x) // 8 for x in raw], dtype=np.int64)
    h = np.frombuffer(b"".join(raw), dtype=np.uint64)
    within = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    lead, doc, tie, start = np.repeat(lead, n).view(np.uint64), np.repeat(doc, n), np.repeat(tie, n), np.repeat(start, n) + within
    o = multikey_order([lead, h, doc, tie, start])
    lead, h, doc, tie, start = (x[o] for x in (lead, h, doc, tie, start))
    again = ~starts(lead, h) & starts(lead, h, doc, tie, start)
    runs = joined(doc[again], tie[again], start[again], np.ones(int(again.sum()), np.int64))
    none = np.zeros(len(runs[0]), dtype=np.int64)
    return pa.table([*runs, none, none], schema=RUN)


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts (``doc``, ``tie``, ``z``) and the runs of their windows that start earlier as well (``doc``,
    ``tie``, ``start``, ``n``)."""
    spark = docs.sparkSession
    rows = keyed(docs)
    found = sample_splitters(rows)
    splitters = spark.sparkContext.broadcast(found)          # at most SPLITTERS pairs
    buckets = max(len(found[0]) + 1, 64)
    runs = stored(suffix_rows(rows, splitters).groupBy("bucket").applyInArrow(lambda t: sort_range(t, splitters), ddl(RUN)))
    texts = packed(rows)
    closer = window_rows(texts, runs.where(F.col("state") != REPEAT), buckets)
    more = stored(closer.groupBy("bucket").applyInArrow(sort_windows, ddl(RUN)))
    return texts, runs.where(F.col("state") == REPEAT).unionByName(more).select("doc", "tie", "start", "n")


def removed(size: int, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes (start, end) covered by the windows."""
    _, _, a, width = joined(np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), start, n + LENGTH - 1)
    return np.stack([a, np.minimum(a + width, size)], axis=1)


def cut(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (start and end of the removed runs, in bytes) and ``kept`` (the
    other bytes joined), one row per row of ``docs``."""
    texts, runs = repeated_windows(docs)
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes, spans, kept = [], [], [], []
            for doc, z, runs_of in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                data = unpacked(z)
                gone = removed(len(data), *columns_of(runs_of, 2)).tolist()
                at, parts = 0, []
                for x, y in gone:
                    parts.append(data[at:x])
                    at = y
                ids.append(None if doc == NULL_ID else doc)
                sizes.append(len(data))
                spans.append([{"start": x, "end": y} for x, y in gone])
                kept.append(np.concatenate([*parts, data[at:]]).tobytes())
            yield batch_of(out, [ids, sizes, spans, kept])

    lists = by_document(runs, "start", "n")
    return texts.join(lists, ["doc", "tie"], "left").select("doc", "z", "runs").mapInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def query(docs: DataFrame) -> DataFrame:
    """The op6 contract, derived from ``cut``."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut(docs).select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                            F.sha2("kept", 256).alias("kept_sha256"))
