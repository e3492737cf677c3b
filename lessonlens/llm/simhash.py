"""SimHash near-duplicates linked through vantage-point trees.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles.  The
distinct fingerprints are split into shards by a vantage-point tree fitted on a bounded
sample: every inner node sends a fingerprint to the near or far side of a vantage point, and
the triangle inequality says which fingerprints close to the boundary must be shown to the
other side as well.  Each shard runs the same tree further down and compares what is left
exactly.  Shards return a spanning forest of their links, never all pairs.

Defined cases
    null text           like an empty text: fingerprint zero
    empty text          fingerprint zero, linked like any other
    fewer words than the shingle length
                        one shingle of the whole word sequence
    repeated rows       one output row per input row, same class
    null doc_id         keeps its row; ignored when the smallest id of a class is taken (a
                        class of only null ids has a null component_id)
    empty table         no rows
    further columns     not read, so their names cannot clash
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lessonlens.llm.common import batch_of, components, stored

SEED = 42
SAMPLE_ROWS = 1 << 20   # most fingerprints the driver reads (8 MB) to fit the tree's upper levels, 16 a shard
SHARD_ROWS = 4096       # fingerprints a shard should be home to
LEAF_ROWS = 96          # below this, compare all


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint: a bit is 1 if set in over half the shingle hashes."""
    # bytes.lower and bytes.split know ASCII only: A-Z and \\x20 \\x09-\\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, mark: Column | None = None) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a signed long) and, if given, the long ``mark``,
    one row per row."""
    out = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())] + [("mark", pa.int64())] * (mark is not None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], schema=out)

    marks = [] if mark is None else [mark.cast("long").alias("mark")]
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *marks)
            .mapInArrow(run, "doc_id long, fp long" + ", mark long" * len(marks)))


# ---------------------------------------------------------------- vantage-point tree

def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def vantage(points: np.ndarray) -> tuple[np.uint64, int]:
    """Of a few evenly spaced candidates, the one whose distances spread most, and the radius
    nearest the median that leaves the fewest points at the boundary."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, 5).astype(int)]:
        d = distance(points, v)
        spread = float(d.std())
        if best is None or spread > best[0]:
            best = (spread, v, int(np.median(d)))
    return best[1], best[2]


def fit_tree(sample: np.ndarray, levels: int) -> list[tuple[int, int]]:
    """Vantage points and radii of a complete tree of ``levels`` levels, in heap order."""
    nodes: list[tuple[int, int]] = []
    level = [np.sort(sample)]
    for _ in range(levels):
        below = []
        for points in level:
            if len(points) < 2:      # nothing to learn here: an even split of the cube
                v, radius = np.uint64(0), 32
            else:
                v, radius = vantage(points)
            near = distance(points, v) <= radius
            nodes.append((int(v), radius))
            below += [points[near], points[~near]]
        level = below
    return nodes


def place(fps: np.ndarray, nodes: list[tuple[int, int]], levels: int, reach: int):
    """Shards of ``fps``: yields (shard, indices, home).  Every fingerprint has one home; it is
    also shown, as a visitor, to each shard that may hold a home within ``reach``.  A pair of
    homes that part at a node is met by the near one visiting the far side."""
    todo = [(0, 0, np.arange(len(fps)), np.ones(len(fps), dtype=bool))]
    while todo:
        node, level, idx, home = todo.pop()
        if not len(idx):
            continue
        if level == levels:
            yield node - (2 ** levels - 1), idx, home
            continue
        v, radius = nodes[node]
        d = distance(fps[idx], np.uint64(v)).astype(np.int16)
        near = d <= radius
        inner = np.where(home, near, d <= radius + reach)
        outer = d > radius - reach          # far homes, visitors, and near homes that visit
        todo.append((2 * node + 1, level + 1, idx[inner], home[inner]))
        todo.append((2 * node + 2, level + 1, idx[outer], home[outer] & ~near[outer]))


class Forest:
    """Labels of local classes; ``unite`` takes arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def unite(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def link(fps: np.ndarray, home: np.ndarray, reach: int) -> np.ndarray:
    """Local class label of each fingerprint, over all home-home and visitor-home pairs within
    ``reach``.  The tree goes on below the shard; where it no longer separates, blocks of
    pairs are compared directly."""
    forest = Forest(len(fps))
    everyone = np.arange(len(fps))
    todo = [(everyone[home], everyone[~home])]
    while todo:
        own, seen = todo.pop()
        if not len(own):
            continue
        if len(own) > LEAF_ROWS:
            v, radius = vantage(fps[own])
            d, e = distance(fps[own], v).astype(np.int16), distance(fps[seen], v).astype(np.int16)
            near = d <= radius
            cross = own[near & (d > radius - reach)]
            a = (own[near], seen[e <= radius + reach])
            b = (own[~near], np.concatenate([seen[e > radius - reach], cross]))
            work = sum(len(x) * (len(x) + len(y)) for x, y in (a, b))
            if work < 0.9 * len(own) * (len(own) + len(seen)):
                todo += [a, b]
                continue
        everything = np.concatenate([own, seen])
        step = max(1, (1 << 21) // len(own))
        for at in range(0, len(everything), step):
            rows = everything[at:at + step]
            r, c = np.nonzero(distance(fps[rows][:, None], fps[own][None, :]) <= reach)
            forest.unite(rows[r], own[c])
    return forest.label


def close_links(fps: DataFrame, reach: int, shard_rows: int = SHARD_ROWS,
                sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Edges ``a``, ``b`` that connect exactly the fingerprints (distinct, column ``fp``)
    connected by steps of at most ``reach`` bits."""
    spark = fps.sparkSession
    total = fps.count()
    levels = max(0, math.ceil(math.log2(max(1, total) / shard_rows)))
    levels = min(levels, int(math.log2(sample_rows // 16)))
    wanted = min(sample_rows, 64 * 2 ** levels)
    share = min(1.0, wanted / max(1, total))
    sample = np.array([r[0] for r in fps.where(
        F.shiftrightunsigned(F.xxhash64(F.col("fp"), F.lit(7)), 32) < int(share * 2 ** 32))
        .select("fp").limit(2 * sample_rows).collect()], dtype=np.int64).view(np.uint64) if levels else np.zeros(0, np.uint64)
    nodes = spark.sparkContext.broadcast(fit_tree(sample, levels))
    placed = pa.schema([("shard", pa.int64()), ("fp", pa.int64()), ("home", pa.bool_())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, idx, home in place(x, nodes.value, levels, reach):
                yield batch_of(placed, [np.full(len(idx), shard), x[idx].view(np.int64), home])

    edges = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(shard: pa.Table) -> pa.Table:
        x = shard.column("fp").to_numpy().view(np.uint64)
        label = link(x, shard.column("home").to_numpy().astype(bool), reach)
        tied = np.flatnonzero(label != np.arange(len(x)))
        return pa.table([x[tied].view(np.int64), x[label[tied]].view(np.int64)], schema=edges)

    return (fps.select("fp").mapInArrow(spread, "shard long, fp long, home boolean")
            .groupBy("shard").applyInArrow(compare, "a long, b long"))


def classes(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """The rows of ``prints`` (stored; ``doc_id``, ``fp``) with ``root``, which names the class that links of
    at most ``max_bits`` differing bits make, and ``component_id``, the smallest doc_id in it."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    star = components(close_links(distinct, max_bits))
    member = (distinct.join(star, distinct.fp == star.node, "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(member.join(lowest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (smallest doc_id reachable over links of at most
    ``max_bits`` differing bits), one row per row of ``docs``."""
    return classes(stored(fingerprints(docs, shingle)), max_bits).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` with one row kept of each class: the one with the class's smallest doc_id.  If
    that id repeats within the class, the row with the least hash of its text stays; rows of one
    doc_id in different classes are different documents.  Rows without doc_id all stay: they name no
    document that could be dropped for another."""
    mark = F.xxhash64("text")
    assigned = classes(stored(fingerprints(docs, shingle, mark)), max_bits)
    keep = (assigned.where("doc_id = component_id").groupBy("root")
            .agg(F.min("doc_id").alias("__id"), F.min("mark").alias("__mark")).drop("root"))
    named = docs.withColumn("__text", mark).join(
        keep, (F.col("doc_id").cast("long") == keep["__id"]) & (F.col("__text") == keep["__mark"]), "left_semi")
    # equal rows of one id share a mark: one of them stays
    first = F.row_number().over(Window.partitionBy("doc_id", "__text").orderBy(F.lit(0)))
    return (named.withColumn("__first", first).where("__first = 1").drop("__first", "__text")
            .unionByName(docs.where(docs["doc_id"].isNull())))


def query(docs: DataFrame) -> DataFrame:
    """The op1 contract: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``."""
    return near_duplicates(docs, 3, 2).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
