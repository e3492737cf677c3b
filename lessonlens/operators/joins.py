"""Join helpers: size-checked broadcast and gate joins."""

from __future__ import annotations

import functools
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.config import DEFAULT

# Most bytes of one broadcast relation, whatever its row count, and of all those of one plan together.
BROADCAST_BYTES = 64 * 1024 * 1024
PLAN_BROADCAST_BYTES = 256 * 1024 * 1024
SIZE_SECONDS = 600       # a size measured longer ago is measured anew (a stream's session lives long)

_SIZE_CACHE: dict[tuple, tuple[float, int, int]] = {}
_LOCK = threading.Lock()


class BroadcastBudget:
    """Bytes that the broadcasts of one plan take together.  They are granted in the order in which
    the plan is declared; a relation that the plan uses again costs nothing more."""

    def __init__(self, limit: int | None = None):
        self.limit = PLAN_BROADCAST_BYTES if limit is None else limit
        self.spent: dict[int, int] = {}
        self._lock = threading.Lock()

    def grants(self, relation: int, size: int) -> bool:
        with self._lock:
            if relation not in self.spent:
                if sum(self.spent.values()) + size > self.limit:
                    return False
                self.spent[relation] = size
            return True


_BUDGET: ContextVar[BroadcastBudget | None] = ContextVar("broadcast budget", default=None)


@contextmanager
def within(budget: BroadcastBudget) -> Iterator[None]:
    """Joins declared here draw on ``budget``."""
    token = _BUDGET.set(budget)
    try:
        yield
    finally:
        _BUDGET.reset(token)


def one_plan(build):
    """The joins that the function declares share one budget: that of the plan it is part of, or a new one."""
    @functools.wraps(build)
    def declared(*args, **kw):
        with within(_BUDGET.get() or BroadcastBudget()):
            return build(*args, **kw)
    return declared


def measured(df: DataFrame, key: tuple | None = None) -> tuple[int, int]:
    """Rows and bytes of a dimension, memoised for a while if ``key`` is given: texts by their length, 8 bytes
    for a fixed-width column, 1024 for a nested one, 16 for a row and for a text's place.

    The memo is looked up by the session and by the plan itself, so a scoped
    or otherwise filtered frame never answers for a full one of the same name.
    """
    if key is not None:
        key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), *key)
        with _LOCK:
            at, *known = _SIZE_CACHE.get(key, (None,))
        if at is not None and time.monotonic() - at < SIZE_SECONDS:
            return known[0], known[1]
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    texts = [c for c, k in kinds.items() if k in ("string", "binary", "varchar", "char")]
    nested = sum(k in ("array", "map", "struct", "variant") for k in kinds.values())
    width = 16 + 16 * len(texts) + 1024 * nested + 8 * (len(kinds) - len(texts) - nested)
    n, *lengths = df.agg(F.count(F.lit(1)), *[F.sum(F.octet_length(F.col(f"`{c}`"))) for c in texts]).first()
    size = n * width + sum(x or 0 for x in lengths)
    if key is not None:
        with _LOCK:
            _SIZE_CACHE[key] = (time.monotonic(), n, size)
    return n, size


def row_count(df: DataFrame, key: tuple | None = None) -> int:
    """Row count of a dimension (``measured``)."""
    return measured(df, key)[0]


def may_broadcast(df: DataFrame, key: tuple | None = None, limit_rows: int | None = None) -> bool:
    """Whether ``df`` is proven to stay under the row and byte bounds of a broadcast, and the plan being
    declared has that much left."""
    limit = DEFAULT.broadcast_row_limit if limit_rows is None else limit_rows
    n, size = measured(df, key)
    budget = _BUDGET.get()
    return n <= limit and size <= BROADCAST_BYTES and (budget is None or budget.grants(df.semanticHash(), size))


def bounded_broadcast(df: DataFrame, key: tuple | None = None,
                      limit_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when its size is proven (``may_broadcast``).

    The measure is one cheap job on a dimension-sized input.  Above the bounds the
    plain DataFrame is returned and Spark plans a shuffle join (AQE may still
    switch to broadcast at run time from real sizes, and splits skewed partitions).
    """
    return F.broadcast(df) if may_broadcast(df, key, limit_rows) else df


def dimension_join(big: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner",
                   size_key: tuple | None = None, limit_rows: int | None = None,
                   spread: str = "user_id", salts: int = 64) -> DataFrame:
    """Join a data-sized relation to a dimension on a possibly hot key.

    Below the row bound the dimension is broadcast (no shuffle at all).  Above
    it, a salted shuffle join: each dimension row is replicated over ``salts``
    buckets and each big row goes to one bucket by a hash of ``spread`` (e.g.
    ``user_id``), so one key holding a third of the big rows is split over
    ``salts`` tasks instead of landing in one.  Results are identical.
    """
    if may_broadcast(dim, size_key, limit_rows):
        return big.join(F.broadcast(dim), keys, how)
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int"))
    return salted_big.join(salted_dim, [*keys, "_salt"], how).drop("_salt")


def gate_join(df: DataFrame, mapping: DataFrame, keys: list[str], flag: str,
              size_key: tuple | None = None) -> DataFrame:
    """Left join to a de-duplicated mapping, adding ``flag`` = 1 on a hit.

    Used for "key IS NULL OR mapping row exists" gates; de-duplicating the
    mapping first means the gate can never multiply rows.
    """
    m = mapping.select(*keys).distinct().withColumn(flag, F.lit(1))
    return df.join(bounded_broadcast(m, size_key), keys, "left")


BITMAP_BITS = 1 << 27      # 16 MB broadcast, whatever the number of keys
_WORD_BITS = 1 << 15       # of one bitmap as Spark aggregates them (4 KB)


def bitmap_semi_join(df: DataFrame, keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among ``keys`` (which has that column), without a shuffle of
    ``df``: a Bloom filter of one hash.  The keys, however many, become a bitmap of a fixed size that is
    broadcast; a row passes if its hash's bit is set.  No row of a key is lost; with ``n`` keys a
    share of about ``n / bits`` of the other rows passes too, which an exact join after the aggregate
    removes.  NULLs do not pass."""
    spot = F.pmod(F.xxhash64(F.col(column)), F.lit(bits))
    maps = (keys.where(F.col(column).isNotNull()).select(spot.alias("_spot"))
            .groupBy(F.bitmap_bucket_number("_spot").alias("_part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_spot")).alias("_map")))
    place = F.bitmap_bit_position("_spot")
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, cast(_place % 8 as int))").bitwiseAND(F.lit(1)) == 1
    return (df.where(F.col(column).isNotNull()).withColumn("_spot", spot)
            .withColumn("_part", F.bitmap_bucket_number("_spot"))
            .join(F.broadcast(maps), "_part")       # at most bits / 32768 rows of 4 KB
            .withColumn("_byte", byte).withColumn("_place", place).where(hit).select(*df.columns))
