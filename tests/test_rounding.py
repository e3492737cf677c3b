"""Exact rounding: pct() and round_avg() against Python Decimal HALF_UP on random data."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from lessonlens.functions.columns import pct, round_avg


def test_pct_matches_decimal_half_up(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 400), rnd.randint(1, 400)) for _ in range(400)]
    pairs = [(d, n) for d, n in pairs if d <= n]
    df = spark.createDataFrame(pairs, "d long, n long")
    got = {(r.d, r.n): r.p for r in df.select("d", "n", pct("d", "n").alias("p")).collect()}
    for d, n in pairs:
        want = (Decimal(d) * 100 / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[(d, n)] == want, (d, n)


def test_round_avg_matches_two_step_half_up(spark):
    rnd = random.Random(11)
    groups = {g: [Decimal(rnd.randint(0, 20000)) / 100 for _ in range(rnd.randint(1, 9))]
              for g in range(150)}
    rows = [(g, v) for g, vals in groups.items() for v in vals]
    df = spark.createDataFrame(rows, "g int, v decimal(10,2)")
    got = {r.g: r.a for r in df.groupBy("g").agg(round_avg("v").alias("a")).collect()}
    for g, vals in groups.items():
        six = (sum(vals) / len(vals)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        assert got[g] == six.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP), g
