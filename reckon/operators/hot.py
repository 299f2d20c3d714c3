"""Joins whose hot keys are known before the shuffle.

A sketch (``approx_top_k``) over the keys of the large side finds those with
more than a share of the rows. Rows of a hot key, and rows without a key, meet
the few reference rows of the hot keys by broadcast and never travel; all other
rows join by shuffle, where no key is hot any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hot keys at most, counters of the sketch, and the share of the rows from which on a key is hot.
MOST, COUNTERS, SHARE = 64, 4096, 0.01


def _text(keys: list[str]) -> Column:
    """The keys as one text that names the columns by place, null when a key is."""
    some = F.lit(True)
    for k in keys:
        some = some & F.col(k).isNotNull()
    return F.when(some, F.to_json(F.array(*[F.col(k).cast("string") for k in keys])))


def hot_keys(df: DataFrame, keys: list[str], share: float = SHARE) -> list[str]:
    """Keys (as text) that hold more than ``share`` of the rows of ``df``, ``MOST`` at most: one pass, a sketch of fixed size a task."""
    key = _text(keys)
    got = df.select(key.alias("k")).agg(F.count("*").alias("n"), F.expr(f"approx_top_k(k, {MOST}, {COUNTERS})").alias("top")).first()
    return [r["item"] for r in got.top or [] if r["item"] is not None and r["count"] > share * got.n]


def hot_left_join(df: DataFrame, ref: DataFrame, on: dict[str, str], share: float = SHARE) -> DataFrame:
    """``df`` left joined with the other columns of ``ref``, which has one row for each key (raises
    otherwise for hot ones). ``df`` is read three times: cut it before if it is dear."""
    left, right = list(on), list(on.values())
    ref = ref.where(" and ".join(f"`{c}` is not null" for c in right))
    hot = hot_keys(df, left, share)
    taken = [c for c in ref.columns if c not in right]
    ref = ref.select(*[F.col(c).alias(f"__h{k}") for k, c in enumerate(right)], *taken)
    own = [f"__h{k}" for k in range(len(right))]
    few = ref.where(_text(own).isin(hot)).groupBy(*own).agg(F.count("*").alias("__n"), *[F.any_value(c).alias(c) for c in taken])
    few = few.where(F.when(F.col("__n") > 1, F.raise_error(F.lit("the reference has a hot key twice"))).otherwise(F.lit(True))).drop("__n")
    key = _text(left)
    here = key.isNull() | key.isin(hot) if hot else key.isNull()

    def met(rows: DataFrame, side: DataFrame) -> DataFrame:
        cond = None
        for c, a in zip(left, own):
            e = rows[c] == side[a]
            cond = e if cond is None else cond & e
        return rows.join(side, cond, "left").select(*[rows[c] for c in df.columns], *[side[c] for c in taken])

    return met(df.where(~here), ref).unionByName(met(df.where(here), F.broadcast(few)))  # ``few`` has MOST rows at most
