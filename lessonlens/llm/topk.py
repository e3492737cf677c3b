"""Exact top-k inner products through a pivot-distance index.

A few pivots are chosen from a bounded sample.  Every vector is keyed by its nearest pivot and
its distance to it, and the rows are range-partitioned and sorted by that key: a shard is a
run of neighbouring annuli.  With |q - v| >= | |q - p| - |v - p| | an annulus between the
distances lo and hi around p, of vectors no longer than m, holds no score above

    (|q|^2 + m^2 - gap^2) / 2,     gap = max(0, |q - p| - hi, lo - |q - p|)

(the origin is a pivot too, for which this is |q| m).  A query first searches the annuli around
its own row, which gives its k-th best score so far; then it is sent to the shards whose bound
reaches that score, and in a shard it goes through the annuli by falling bound until none
reaches its k-th best.  Bounds only ever leave out what cannot be among the k best, so
the result is that of comparing all; where vectors lie evenly in many dimensions they leave
out little, and the work is one blocked matrix product of the queries with all rows.

Defined cases
    null or non-finite    a vector that is null, empty, or holds a null, NaN or infinite component, or one of
                          2**26 / 256 or more (products would leave a long), takes no part
    other lengths         a query is compared with the vectors of its own length
    own row               rows with the query's vec_id, if it repeats, are all its own
    repeated rows         each is a candidate; a repeated query row asks again
    null vec_id           asks nothing; as a candidate it comes last in ties and keeps its null id
    ties                  smaller vec_id first; equal ids in any order (their rows are equal)
    fewer than k          all there are
    empty table           no rows
    further columns       not read, so their names cannot clash
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lessonlens.llm.common import stored
from lessonlens.llm.vectors import by_length, inner, integers, lists, squares

SCALE = 256
SAMPLE_ROWS = 2048      # rows that the pivots are chosen from
PIVOTS = 24             # for each vector length in the sample, beside the origin
ANNULUS_ROWS = 1024     # rows of an annulus in a shard
SHARD_ROWS = 1 << 16    # most rows of a shard, as far as MAX_SHARDS allows
LEAST_ROWS = 1024       # a shard is not made smaller than this for the sake of parallel tasks
MAX_SHARDS = 1 << 16    # bounds what describes the shards (24 bytes each and pivot met)
NO_ID = np.iinfo(np.int64).max
LOW = -(1 << 62)        # below any score

INDEX = "vec_id long, vec array<int>, pivot int, dist double, query boolean"


def choose_pivots(sample: DataFrame, pivots: int = PIVOTS, rows: int = SAMPLE_ROWS) -> dict[int, np.ndarray]:
    """Pivots by vector length: the origin, then rows of the sample that are each farthest from
    those before.  ``sample`` is read by hash, at most ``rows`` rows."""
    picked = (sample.orderBy(F.xxhash64("vec"), "vec_id").limit(rows).select("vec").collect())
    chosen = {}
    for d in sorted({len(r.vec) for r in picked}):
        x = np.unique(np.array([r.vec for r in picked if len(r.vec) == d], dtype=np.int64), axis=0)
        nearest = squares(x).astype(np.float64)
        rows_of = [np.zeros(d, np.int64)]
        for _ in range(min(pivots, len(x))):
            far = int(nearest.argmax())
            if nearest[far] == 0:
                break
            rows_of.append(x[far])
            nearest = np.minimum(nearest, squares(x - x[far]))
        chosen[d] = np.array(rows_of)
    return chosen


def distances(x: np.ndarray, pivots: dict[int, np.ndarray]) -> np.ndarray:
    """Distances of the rows of ``x`` to the pivots of their length (to the origin if there are none)."""
    p = pivots.get(x.shape[1], np.zeros((1, x.shape[1]), np.int64))
    return np.sqrt(np.maximum(squares(x)[:, None] + squares(p)[None] - 2 * inner(x, p), 0).astype(np.float64))


def index(vectors: DataFrame, asks, pivots: dict[int, np.ndarray], shards: int) -> DataFrame:
    """The vectors with pivot, distance and shard, stored in the order of the key.  ``asks`` is
    the condition that makes a row a query."""
    out = pa.schema([("vec_id", pa.int64()), ("vec", pa.list_(pa.int32())), ("pivot", pa.int32()),
                     ("dist", pa.float64()), ("query", pa.bool_())])

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in by_length(b.column("vec")):
                d = distances(x, pivots)
                near = d.argmin(1)
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    b.column("vec_id").take(take), lists(x, pa.int32()), pa.array(near, pa.int32()),
                    pa.array(d[np.arange(len(x)), near]), b.column("query").take(take)], schema=out)

    keyed = vectors.withColumn("query", F.coalesce(asks, F.lit(False))).mapInArrow(key, INDEX)
    order = [F.size("vec"), "pivot", "dist", "vec_id"]
    return stored(keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order)
                  .withColumn("shard", F.spark_partition_id()))


def bound(norms: np.ndarray, dist: np.ndarray, lo, hi, longest) -> np.ndarray:
    """Upper bounds of the scores (queries x annuli); the 1 + 1e-9 share pays for rounding."""
    gap = np.maximum(np.maximum(dist - hi, lo - dist), 0.0)
    return (norms[:, None] + longest - gap * gap) / 2 + 1 + 1e-9 * (norms[:, None] + longest)


class Best:
    """The k best (score, id) of each of some queries so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k = k
        self.floor = floor.copy()            # a score below cannot be among the k best,
        self.last = np.full(n, NO_ID)        # nor one as high with a larger id than this
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)

    def offer(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of the queries ``who`` with the rows ``ids``; LOW marks a query's own rows."""
        passing = self.passing(who, scores, ids)
        if scores.shape[1] >= self.k and np.count_nonzero(passing) > 4 * self.k * len(who):
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            raised = kth > self.floor[who]
            self.floor[who[raised]], self.last[who[raised]] = kth[raised], NO_ID
            passing = self.passing(who, scores, ids)
        r, c = np.nonzero(passing)
        if not len(r):
            return
        query = np.concatenate([self.query, who[r]])
        score = np.concatenate([self.score, scores[r, c]])
        id_ = np.concatenate([self.id, ids[c]])
        order = np.lexsort((id_, -score, query))
        query, score, id_ = query[order], score[order], id_[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        full = rank == self.k - 1
        self.floor[query[full]], self.last[query[full]] = score[full], id_[full]
        keep = rank < self.k
        self.query, self.score, self.id = query[keep], score[keep], id_[keep]

    def passing(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        floor = self.floor[who][:, None]
        return (scores > LOW) & ((scores > floor) | (scores == floor) & (ids[None] <= self.last[who][:, None]))


class Annuli:
    """Some rows of one length, in the order of the index, cut into annuli."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivot: np.ndarray, dist: np.ndarray, rows: int = ANNULUS_ROWS):
        cuts = np.flatnonzero(np.diff(pivot)) + 1
        starts = np.unique(np.concatenate([np.arange(0, len(x), rows), cuts])).astype(np.int64)
        ends = np.append(starts[1:], len(x))
        norms = squares(x)
        self.ids, self.x = ids, x
        self.spans = list(zip(starts.tolist(), ends.tolist()))
        self.pivot = pivot[starts]
        self.lo, self.hi = np.minimum.reduceat(dist, starts), np.maximum.reduceat(dist, starts)
        self.longest = np.maximum.reduceat(norms, starts).astype(np.float64)

    def search(self, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int,
               pivots: dict[int, np.ndarray]) -> Best:
        """The k best rows for each row of ``q`` among those that reach ``floor``."""
        upper = bound(squares(q).astype(np.float64), distances(q, pivots)[:, self.pivot], self.lo, self.hi, self.longest)
        best = Best(len(q), k, floor)
        for a in np.argsort(-upper.max(0), kind="stable"):
            who = np.flatnonzero(upper[:, a] >= best.floor)
            if not len(who):
                if upper[:, a].max() < best.floor.min():
                    break
                continue
            start, end = self.spans[a]
            ids = self.ids[start:end]
            scores = inner(q[who], self.x[start:end])
            scores[own[who][:, None] == ids[None]] = LOW
            best.offer(who, scores, ids)
        return best


def first_floors(indexed: DataFrame, k: int, pivots: dict[int, np.ndarray], window: int = 4 * ANNULUS_ROWS) -> DataFrame:
    """The queries (``ask`` names the row, ``vec_id``, ``vec``, ``floor``): ``floor`` is the k-th best
    score among the rows around the query's own in the index, or LOW if there are fewer."""
    out = pa.schema([("vec_id", pa.int64()), ("vec", pa.list_(pa.int32())), ("floor", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in windows(batches, window):
            for at, x in by_length(rows.column("vec").combine_chunks()):
                asked = np.flatnonzero(rows.column("query").to_numpy()[at])
                if not len(asked):
                    continue
                ids = named(rows.column("vec_id"))[at]
                near = Annuli(ids, x, rows.column("pivot").to_numpy()[at], rows.column("dist").to_numpy()[at])
                for s in range(0, len(asked), 512):
                    part = asked[s:s + 512]
                    floor = near.search(x[part], ids[part], np.full(len(part), LOW), k, pivots).floor
                    yield pa.RecordBatch.from_arrays([pa.array(ids[part]), lists(x[part], pa.int32()), pa.array(floor)],
                                                     schema=out)

    found = indexed.select("vec_id", "vec", "pivot", "dist", "query").mapInArrow(run, "vec_id long, vec array<int>, floor long")
    return stored(found.withColumn("ask", F.monotonically_increasing_id()))


def windows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def named(column) -> np.ndarray:
    """Ids as int64; NO_ID for null."""
    return column.fill_null(NO_ID).to_numpy().astype(np.int64)


def route(queries: DataFrame, zones: dict[int, tuple], pivots: dict[int, np.ndarray]) -> DataFrame:
    """A row (``shard``, ``ask``, ``vec_id``, ``vec``, ``floor``) for each query and shard whose bound
    reaches the query's floor.  ``zones``: by vector length, arrays of shard, pivot, lo, hi, longest,
    in the order of the shards."""
    out = pa.schema([("shard", pa.int32()), ("ask", pa.int64()), ("vec_id", pa.int64()), ("vec", pa.list_(pa.int32())),
                     ("floor", pa.int64())])
    shared = queries.sparkSession.sparkContext.broadcast((zones, pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zones, pivots = shared.value
        for b in batches:
            for at, x in by_length(b.column("vec")):
                shard, pivot, lo, hi, longest = zones[x.shape[1]]
                ask, ids, floor = (b.column(c).to_numpy()[at] for c in ("ask", "vec_id", "floor"))
                d, norms = distances(x, pivots), squares(x).astype(np.float64)
                starts = np.append(np.unique(shard, return_index=True)[1], len(shard))
                for s in range(0, len(starts) - 1, 64):            # a bounded part of the matrix at a time
                    first = starts[s:s + 65]
                    z = slice(first[0], first[-1])
                    reaches = bound(norms, d[:, pivot[z]], lo[z], hi[z], longest[z]) >= floor[:, None]
                    q, c = np.nonzero(np.logical_or.reduceat(reaches, first[:-1] - first[0], axis=1))
                    to = shard[first[:-1]]
                    for t in range(0, len(q), 4096):
                        asked = q[t:t + 4096]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(to[c[t:t + 4096]], pa.int32()), pa.array(ask[asked]), pa.array(ids[asked]),
                            lists(x[asked], pa.int32()), pa.array(floor[asked])], schema=out)

    return (queries.select("ask", "vec_id", "vec", "floor")
            .mapInArrow(run, "shard int, ask long, vec_id long, vec array<int>, floor long"))


def scan(rows: DataFrame, k: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` hold vectors (``ask`` null) and queries, by shard with the vectors first: a shard's
    vectors are kept and its queries, however many, stream past.  Gives (``ask``, ``query_id``,
    ``vec_id``, ``score``), the k best of each query in each shard."""
    out = pa.schema([("ask", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    schema = "ask long, query_id long, vec_id long, score long"

    def answers(held: dict[int, Annuli], b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, q in by_length(b.column("vec")):
            if q.shape[1] not in held:
                continue
            ask, own, floor = (b.column(c).to_numpy()[at] for c in ("ask", "vec_id", "floor"))
            best = held[q.shape[1]].search(q, own, floor, k, pivots)
            if len(best.query):
                ids = pa.array(best.id, mask=best.id == NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(ask[best.query]), pa.array(own[best.query]), ids,
                                                  pa.array(best.score)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, waiting, held = None, [], {}
        for b in batches:
            if not b.num_rows:
                continue
            shards = b.column("shard").to_numpy()
            asks = np.asarray(b.column("ask").is_valid())
            cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for start, end in zip(np.append(0, cuts), np.append(cuts, len(shards))):
                part = b.slice(start, end - start)
                if shards[start] != shard:
                    shard, waiting, held = shards[start], [], {}
                if not asks[start]:
                    waiting.append(part)
                    continue
                if waiting:
                    held = build(pa.Table.from_batches(waiting))
                    waiting = []
                yield from answers(held, part)

    def build(t: pa.Table) -> dict[int, Annuli]:
        ids, pivot, dist = named(t.column("vec_id")), t.column("pivot").to_numpy(), t.column("dist").to_numpy()
        return {x.shape[1]: Annuli(ids[at], x, pivot[at], dist[at])
                for at, x in by_length(t.column("vec").combine_chunks())}

    return rows.mapInArrow(run, schema)


def nearest(vectors: DataFrame, asks, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row of ``vectors`` (``vec_id``, integer
    ``vec``) that meets the condition ``asks``, its k largest inner products with other rows."""
    spark = vectors.sparkSession
    total = vectors.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = min(MAX_SHARDS, max(-(-total // SHARD_ROWS), min(parallel, -(-total // LEAST_ROWS))))
    pivots = choose_pivots(vectors)
    indexed = index(vectors, asks & F.col("vec_id").isNotNull(), pivots, shards)
    longest = F.aggregate("vec", F.lit(0).cast("long"), lambda s, c: s + c.cast("long") * c.cast("long"))
    seen = (indexed.groupBy(F.size("vec").alias("d"), "shard", "pivot")
            .agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.max(longest).alias("longest")).collect())
    zones = {}
    for d in {r.d for r in seen}:
        own = sorted((r.shard, r.pivot, r.lo, r.hi, float(r.longest)) for r in seen if r.d == d)
        zones[d] = tuple(np.array(c) for c in zip(*own))
    queries = first_floors(indexed, k, pivots)
    sent = route(queries, zones, pivots)
    none = F.lit(None)
    rows = (indexed.select("shard", none.cast("long").alias("ask"), "vec_id", "vec", "pivot", "dist",
                           none.cast("long").alias("floor"))
            .unionByName(sent.withColumns({"pivot": none.cast("int"), "dist": none.cast("double")})))
    # nulls sort first, so a shard's vectors come before its queries, in the order of the key
    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "ask", F.size("vec"), "pivot", "dist", "vec_id")
    found = scan(dealt, k, pivots)
    rank = F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def query(embeddings: DataFrame) -> DataFrame:
    """The op12 contract: queries are the rows whose vec_id is divisible by 50."""
    vectors = integers(embeddings, SCALE)
    return nearest(vectors, F.col("vec_id") % 50 == 0, 5)


ORACLE = f"""
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS x
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c) AND abs({SCALE} * c::DOUBLE) < {2 ** 26}))
        = len(embedding)),
scores AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM vectors q JOIN vectors c ON c.vec_id IS DISTINCT FROM q.vec_id AND len(c.x) = len(q.x)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 5"""
