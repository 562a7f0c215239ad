"""Join shapes of the suite, written so that each is a single Spark join.

* ``exists_flags``: ``EXISTS a AND (EXISTS b OR EXISTS c)`` as one left-semi
  join plus two flag joins on *distinct* keys (each build side is bounded by
  the number of distinct keys, never by the fact size).
* ``not_exists``: ``LEFT JOIN .. WHERE right IS NULL`` is written as a
  left-anti join (Catalyst does not rewrite that form itself).
* ``full_coalesce``: full outer join with the join keys coalesced.
* ``attach_scalar``: one-row aggregate beside every row.  The one-row side
  is the output of a global aggregate, so its size is proven (1 row) and
  it is broadcast; this is the only place a key-less join is used.
* ``semi_other``: ``EXISTS (same key, other value)`` without comparing
  all pairs inside a key: per key min and max of the value suffice.
* ``without``: a ``not_exists`` that is evaluated after the joins of its left
  side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(df: DataFrame, keys: list[str], prefix: str) -> tuple[DataFrame, list[str]]:
    names = [f"{prefix}{i}" for i in range(len(keys))]
    return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct(), names


def semi(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str]) -> DataFrame:
    r, names = _keys(right, rkeys, "_sk")
    cond = [F.col(a) == r[b] for a, b in zip(lkeys, names)]
    return left.join(r, cond, "left_semi")


def not_exists(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str]) -> DataFrame:
    r, names = _keys(right, rkeys, "_ak")
    cond = [F.col(a) == r[b] for a, b in zip(lkeys, names)]
    return left.join(r, cond, "left_anti")


def without(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str]) -> DataFrame:
    """``not_exists`` that stays where it is written: the optimizer moves an
    anti join below the joins of ``left``, to rows that those would filter."""
    return with_flag(left, right, lkeys, rkeys, "_met").filter(~F.col("_met")).drop("_met")


def with_flag(left: DataFrame, right: DataFrame, lkeys: list[str], rkeys: list[str],
              flag: str) -> DataFrame:
    """Add boolean ``flag``: a row of ``right`` has the same keys (existence join)."""
    r, names = _keys(right, rkeys, f"_{flag}")
    r = r.withColumn(flag, F.lit(True))
    cond = [F.col(a) == r[b] for a, b in zip(lkeys, names)]
    return (left.join(r, cond, "left").drop(*names)
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def exists_flags(left: DataFrame, lkeys: list[str], must: DataFrame, must_keys: list[str],
                 either: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """``EXISTS must AND (EXISTS e1 OR EXISTS e2 ...)``."""
    out = semi(left, must, lkeys, must_keys)
    flags = []
    for i, (df, ks) in enumerate(either):
        out = with_flag(out, df, lkeys, ks, f"_e{i}")
        flags.append(F.col(f"_e{i}"))
    cond = flags[0]
    for f in flags[1:]:
        cond = cond | f
    return out.filter(cond).drop(*[f"_e{i}" for i in range(len(either))])


def full_coalesce(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on ``keys`` (same names both sides), keys coalesced."""
    a2 = a.select(*[F.col(k).alias(f"_a_{k}") for k in keys],
                  *[c for c in a.columns if c not in keys])
    b2 = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys],
                  *[c for c in b.columns if c not in keys])
    cond = [a2[f"_a_{k}"] == b2[f"_b_{k}"] for k in keys]
    j = a2.join(b2, cond, "full")
    return j.select(*[F.coalesce(F.col(f"_a_{k}"), F.col(f"_b_{k}")).alias(k) for k in keys],
                    *[c for c in j.columns if not c.startswith(("_a_", "_b_"))])


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row global aggregate beside every row."""
    return df.crossJoin(F.broadcast(one_row))


def semi_other(left: DataFrame, right: DataFrame, lkey: str, lval: str, rkey: str,
               rval: str, anti: bool = False) -> DataFrame:
    """Rows of ``left`` for which ``right`` has a row with the same key and a
    different value (``anti``: has none).  Per key only min and max of the
    right values are needed, so each key contributes one row to the join."""
    mm = (right.groupBy(F.col(rkey).alias("_ok"))
          .agg(F.min(rval).alias("_mn"), F.max(rval).alias("_mx")))
    cond = (F.col(lkey) == mm["_ok"]) & ((mm["_mn"] != F.col(lval)) | (mm["_mx"] != F.col(lval)))
    return left.join(mm, cond, "left_anti" if anti else "left_semi")
