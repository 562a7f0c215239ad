"""Dialect helpers: truncating integer division, rounding cast, and exact
quotients on both sides."""

import math
import re
from decimal import Decimal
from fractions import Fraction

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aisle.functions.scalars import int_div, quotient4, r4, round_to_int
from aisle.plans.registry import load_all, oracle_text


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-1000, 1000).filter(lambda d: d != 0)),
                min_size=50, max_size=50))
def test_int_div_truncates(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(int_div("n", "d")).collect()]
    assert got == [int(n / d) if abs(n) < 2**52 else (abs(n) // abs(d)) * (1 if (n >= 0) == (d > 0) else -1)
                   for n, d in pairs]


def test_round_cast_and_ties(spark):
    df = spark.createDataFrame([(2.5, Decimal("171.42125"), -0.00005, 1.23444)], "a double, b decimal(10,5), c double, d double")
    r = df.select(round_to_int(F.col("a")).alias("a"), quotient4("b", F.lit(1), 5).alias("b"), r4("c").alias("c"), r4("d").alias("d")).first()
    assert r["a"] == 3                      # decimal to int rounds (Spark's cast would truncate)
    assert r["b"] == 171.4213 and r["c"] == -0.0001 and r["d"] == 1.2344
    assert not math.isnan(r["b"])


def exact4(n, d):
    """n / d with halves away from zero at the fourth place, in fractions."""
    q = Fraction(n) * 10000 / Fraction(d)
    return math.copysign(math.floor(abs(q) + Fraction(1, 2)), q) / 10000


def test_quotient_is_exact_on_ties(spark):
    """Quotients that end in a 5 at the fifth place, and their neighbours, in
    Spark, in DuckDB and in fractions."""
    rows = [(Decimal(k * 5 + e).scaleb(-2) * s, n) for n in (1000, 2000, 8000, 1600, 64000, 7) for k in range(1, 4000, 37)
            for e in (-1, 0, 1) for s in (1, -1)] + [(Decimal("171421.25"), 1000), (None, 0), (Decimal("9007199254.74"), 3)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, s decimal(38,2), n long")
    got = [r[1] for r in df.select("i", quotient4("s", "n").alias("q")).orderBy("i").collect()]
    want = [None if n == 0 else exact4(s, n) for s, n in rows]
    assert got == want
    assert sum(Fraction(s) * 20000 / n % 2 == 1 for s, n in rows if n) > 200
    con = duckdb.connect()
    con.register("t", pd.DataFrame({"i": range(len(rows)), "s": [None if s is None else str(s) for s, _ in rows], "n": [n for _, n in rows]}))
    duck = con.execute("SELECT round(CAST(CAST(s AS DECIMAL(38,2)) * 10000 AS DOUBLE) / n) / 10000 FROM t ORDER BY i").fetchall()
    assert [r[0] for r in duck] == want


def test_quotient_of_four_places_and_zero(spark):
    df = spark.createDataFrame([(Decimal("0.0001"), Decimal("2.00")), (Decimal("-1.2345"), Decimal("10.00")), (Decimal("1.0000"), Decimal("0.00")),
                                (None, Decimal("1.00"))], "a decimal(38,4), b decimal(38,2)")
    assert [r[0] for r in df.select(quotient4("a", "b", 4)).collect()] == [0.0001, -0.1235, None, None]


def test_no_text_is_edited():
    """The DuckDB twins are run as they are written: no rounded average is
    left to the engine."""
    for key, entry in load_all().items():
        assert "AVG(" not in re.sub(r"(?is)avg\(b\.total / a\.total\)", "", " ".join(
            re.findall(r"(?is)round\(cast\(avg\(.*?, 4\)", oracle_text(key) or ""))).upper(), key
