"""k-means over vectors in Hilbert order, with zone maps.

The vectors are sorted along a Hilbert curve over their quantised components and cut into blocks;
a block keeps its rows and the least and greatest value of each component (its box).  In a round
a block asks of each centroid how near and how far its box can be, drops the centroids
whose least distance is above another's greatest, and compares its rows exactly with
those that are left.  Rounds read the stored blocks, add up count and component sums by centroid in
every task, and give the driver one row per centroid and component.  All arithmetic is on integers.

Defined cases
    null or non-finite    a vector that is null, has not exactly the asked number of components, or holds a
                          null, NaN or infinite component, or one of 2**26 / 64 or more (squares would leave
                          a long), is left out
    repeated rows         each is a vector of its own; of start rows with one id the smaller vector comes first
    null vec_id           is assigned like any other, with a null id, and starts no centroid
    fewer vectors than centroids
                          as many centroids as there are vectors with an id (if there are none, no rows)
    ties                  smaller centroid number
    empty cluster         keeps its centroid
    empty table           no rows
    further columns       not read, so their names cannot clash
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import stored
from lessonlens.llm.vectors import inner, integers, lists, matrix, squares

SCALE, LENGTH = 64, 64
CENTROIDS, ROUNDS, SEED = 16, 3, 1
BLOCK_ROWS = 256
LEVEL_BITS = 4              # the curve runs through 2**4 levels of each component
PARTITION_ROWS = 1 << 17    # most rows of a partition of the index, roughly
LEAST_ROWS = 1024           # a partition is not made smaller than this for the sake of parallel tasks


def hilbert_keys(levels: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``levels`` (integers below ``2 ** bits``), as
    rows of bytes that sort like the positions.

    The cube of each finer level is reached by undoing the exchanges and reflections of the
    coarser ones (axes to transposed index), then the bits are Gray-coded and interleaved."""
    x = levels.astype(np.int64).T.copy()
    d = len(x)
    for top in 1 << np.arange(bits - 1, 0, -1):
        low = top - 1
        for i in range(d):
            high = (x[i] & top) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for top in 1 << np.arange(bits - 1, 0, -1):
        flips ^= np.where((x[-1] & top) != 0, top - 1, 0)
    x ^= flips
    bit = np.arange(bits - 1, -1, -1)
    digits = (x.T[:, None, :] >> bit[None, :, None]) & 1      # rows x bits (high first) x axes
    return np.packbits(digits.reshape(len(levels), -1).astype(np.uint8), axis=1)


def blocks(vectors: DataFrame, total: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vectors`` (``vec_id``, ``vec`` of one length) as stored blocks of neighbours on the curve:
    ``ids``, ``rows`` (the vectors one after another), ``low`` and ``high`` (the box)."""
    least, most = vectors.agg(F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
    span = max(1, most - least + 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                levels = ((matrix(b.column(1)) - least) << LEVEL_BITS) // span
                keys = hilbert_keys(levels, LEVEL_BITS)
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in keys], pa.binary()), *b.columns],
                                                 names=["key", "vec_id", "vec"])

    out = pa.schema([("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int32())), ("low", pa.list_(pa.int32())),
                     ("high", pa.list_(pa.int32()))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            while n >= block_rows:
                t = pa.Table.from_batches(held)
                yield packed(t.slice(0, block_rows))
                rest = t.slice(block_rows)
                held, n = rest.to_batches(), rest.num_rows
        if n:
            yield packed(pa.Table.from_batches(held))

    def packed(t: pa.Table) -> pa.RecordBatch:
        x = matrix(t.column("vec").combine_chunks())
        ids = t.column("vec_id").combine_chunks()
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), lists(x.reshape(1, -1), pa.int32()),
            lists(x.min(0)[None], pa.int32()), lists(x.max(0)[None], pa.int32())], schema=out)

    parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(-(-total // PARTITION_ROWS), min(parallel, -(-total // LEAST_ROWS)))
    curve = (vectors.mapInArrow(keyed, "key binary, vec_id long, vec array<int>")
             .repartitionByRange(n, "key", "vec_id").sortWithinPartitions("key", "vec_id"))
    return stored(curve.select("vec_id", "vec")
                  .mapInArrow(pack, "ids array<long>, rows array<int>, low array<int>, high array<int>"))


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest (or tie) to a vector inside the box."""
    below, above = low - centroids, centroids - high
    least = squares(np.maximum(np.maximum(below, above), 0))
    most = squares(np.maximum(np.abs(centroids - low), np.abs(high - centroids)))
    return np.flatnonzero(least <= most.min())


def assign(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (smaller number in ties) and squared distance of each row of ``x``."""
    near = candidates(low, high, centroids)
    c = centroids[near]
    d = squares(x)[:, None] + squares(c)[None] - 2 * inner(x, c)
    best = d.argmin(1)
    return near[best], d[np.arange(len(x)), best]


def opened(b: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, vectors, low and high of each block in a batch."""
    low, high = matrix(b.column("low")), matrix(b.column("high"))
    rows, ids = b.column("rows"), b.column("ids")
    for k in range(b.num_rows):
        x = rows[k].values.to_numpy().astype(np.int64).reshape(-1, low.shape[1])
        yield ids[k].values, x, low[k], high[k]


def start(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of ``<seed>:<vec_id>``, in the order of the hashes."""
    first = (vectors.where(F.col("vec_id").isNotNull())
             .withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
             .orderBy("hash", "vec").limit(k).collect())
    return np.array([r.vec for r in first], dtype=np.int64)


def moved(index: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the floor of the mean of its vectors."""
    k, d = centroids.shape
    out = pa.schema([("cluster", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), ("total", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for b in batches:
            for _, x, low, high in opened(b):
                own, _ = assign(x, low, high, centroids)
                order = np.argsort(own, kind="stable")
                met, first = np.unique(own[order], return_index=True)
                n += np.bincount(own, minlength=k)
                sums[met] += np.add.reduceat(x[order], first, axis=0)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(met, d), pa.int32()), pa.array(np.tile(np.arange(d), len(met)), pa.int32()),
            pa.array(np.repeat(n[met], d)), pa.array(sums[met].reshape(-1))], schema=out)

    exact = "decimal(38,0)"
    sums = (index.select("ids", "rows", "low", "high").mapInArrow(run, "cluster int, at int, n long, total long")
            .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast(exact)).alias("total"))).collect()
    after = centroids.copy()
    for r in sums:
        after[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return after


def cluster(rows: DataFrame, scale: int = SCALE, length: int = LENGTH, k: int = CENTROIDS, rounds: int = ROUNDS,
            seed: int = SEED) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``: one row
    per vector of ``length`` components."""
    spark = rows.sparkSession
    schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    vectors = integers(rows, scale, length=length)
    total = vectors.count()
    centroids = start(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    index = blocks(vectors, total)
    for _ in range(rounds):
        centroids = moved(index, centroids)
    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, x, low, high in opened(b):
                own, distance = assign(x, low, high, final)
                yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.int32()), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])

    assigned = stored(index.mapInArrow(run, "vec_id long, cluster int, distance long"))
    spent = {r["cluster"]: r["spent"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("spent")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final.tolist()]
    said = spark.createDataFrame([(c, s, sum(spent.values()), digests[c]) for c, s in spent.items()],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(said), "cluster")          # one row per centroid
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same by plain SQL: every vector against every centroid."""
    parts = [f"""numbered AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {LENGTH}
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c) AND abs({SCALE} * c::DOUBLE) < {2 ** 26})) = {LENGTH}),
points AS (
  SELECT r, unnest(range(1, {LENGTH + 1})) AS i, floor({SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM numbered),
starts AS (
  SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) - 1 AS c FROM numbered
  WHERE vec_id IS NOT NULL QUALIFY c < {k}),
centroids0 AS (SELECT c, i, x AS m FROM starts JOIN points USING (r))"""]
    for n in range(rounds + 1):
        parts.append(f"""nearest{n} AS (
  SELECT r, c, d FROM (
    SELECT r, c, sum((x - m) * (x - m))::BIGINT AS d FROM points JOIN centroids{n} USING (i) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if n < rounds:
            parts.append(f"""means{n} AS (
  SELECT c, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m FROM nearest{n} JOIN points USING (r) GROUP BY c, i),
centroids{n + 1} AS (
  SELECT c, i, coalesce(v.m, o.m) AS m FROM centroids{n} o LEFT JOIN means{n} v USING (c, i))""")
    parts.append(f"""digests AS (
  SELECT c, sha256(string_agg(m::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM centroids{rounds} GROUP BY c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM nearest{rounds} JOIN numbered USING (r) JOIN digests USING (c)"""
