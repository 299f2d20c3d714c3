"""Group roll-ups written as partial aggregates.

Every roll-up is a ``groupBy().agg()`` (map-side combine, so a key with a
third of all rows costs one partial row per mapper) and, when the value is
wanted on each row, a join back on the group key. The join back is
many-to-one; AQE's skew-join handling splits a hot key's partition. A
``Window.partitionBy`` alternative is offered (``via='window'``) for small
or well-spread groups: it saves the join but puts each group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reckon.functions.columns import ColumnOrName, _c
from reckon.operators.hot import hot_left_join
from reckon.operators.ordering import pick_first


def _keys(group) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def _not_null(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def with_group_value(df: DataFrame, grouped: DataFrame, group, cols: list[str] | None = None, hot: bool = False) -> DataFrame:
    """Write per-group values back onto each row (left join on the group). ``hot``: hot groups
    are found by a sketch first and their rows stay where they are (``operators.hot``)."""
    keys = _keys(group)
    cols = cols or [c for c in grouped.columns if c not in keys]
    if hot:
        return hot_left_join(df, grouped.select(*keys, *cols), {k: k for k in keys})
    g = grouped.select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)], *cols)
    cond = None
    for i, k in enumerate(keys):
        c = df[k] == g[f"__g{i}"]
        cond = c if cond is None else cond & c
    return df.join(g, cond, "left").select(*[df[c] for c in df.columns], *[g[c] for c in cols])


def priority_rollup(
    df: DataFrame,
    group,
    label: ColumnOrName,
    ranking: list[str],
    default: str | None,
    name: str,
    per_row: bool = False,
    via: str = "join",
) -> DataFrame:
    """Group value = the highest-ranked label present (``ranking[0]`` is the
    highest), else ``default``. Null group keys are not a group.

    Returns ``(group..., name)`` or, with ``per_row``, ``df`` plus ``name``.
    """
    keys = _keys(group)
    ranks = F.array(*[F.lit(x) for x in ranking])
    pos = F.array_position(ranks, _c(label))
    rank = F.when(pos > 0, pos)
    # ``get`` is 0-based and null-safe (``element_at`` over a literal array
    # returns the last element for a null index in Spark 4.1).
    pick = lambda r: F.coalesce(F.get(ranks, r.cast("int") - F.lit(1)), F.lit(default))
    if per_row and via == "window":
        w = Window.partitionBy(*keys)
        v = F.when(_not_null(keys), pick(F.min(rank).over(w)))
        return df.withColumn(name, v)
    g = df.where(_not_null(keys)).groupBy(*keys).agg(F.min(rank).alias("__rank"))
    g = g.select(*keys, pick(F.col("__rank")).alias(name))
    return with_group_value(df, g, keys, [name]) if per_row else g


def any_match(df: DataFrame, group, cond: Column, name: str, per_row: bool = False) -> DataFrame:
    """Per group: does any row satisfy ``cond`` (null counts as no)."""
    keys = _keys(group)
    g = df.where(_not_null(keys)).groupBy(*keys).agg(F.bool_or(F.coalesce(cond, F.lit(False))).alias(name))
    return with_group_value(df, g, keys, [name]) if per_row else g


def complete_group_max(
    df: DataFrame,
    group,
    value: ColumnOrName,
    found: Column,
    name: str,
    require_all: bool = False,
    per_row: bool = False,
) -> DataFrame:
    """Max of ``value`` per group, but only when every member was found
    (``found`` true on all rows) and at least one value is present; with
    ``require_all`` every member also needs a value. Else null."""
    keys = _keys(group)
    v = _c(value)
    g = df.where(_not_null(keys)).groupBy(*keys).agg(
        F.max(v).alias("__max"),
        F.bool_and(F.coalesce(found, F.lit(False))).alias("__all_found"),
        F.count(v).alias("__n_val"),
        F.count(F.lit(1)).alias("__n"),
    )
    ok = F.col("__all_found") & (F.col("__n_val") > 0)
    if require_all:
        ok = ok & (F.col("__n_val") == F.col("__n"))
    g = g.select(*keys, F.when(ok, F.col("__max")).alias(name))
    return with_group_value(df, g, keys, [name]) if per_row else g


def latest_per_key(df: DataFrame, key, order_col: str, where: Column | None = None, ties: str = "all") -> DataFrame:
    """Rows holding the latest ``order_col`` per key, after ``where``
    (applied to both the rows and the max, like a correlated
    ``= (select max(...) where ...)``). ``ties='all'`` keeps tied rows."""
    keys = _keys(key)
    base = df if where is None else df.where(where)
    if ties == "one":
        return pick_first(base, keys, [f"{order_col} desc"] + [f"{c} desc" for c in df.columns if c not in keys and c != order_col])
    m = base.where(_not_null(keys)).groupBy(*keys).agg(F.max(order_col).alias("__max"))
    m = m.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__max")
    cond = base[order_col] == m["__max"]
    for i, k in enumerate(keys):
        cond = cond & (base[k] == m[f"__k{i}"])
    return base.join(m, cond, "left_semi")


def first_per_group(df: DataFrame, key, order, drop_null_keys: bool = True) -> DataFrame:
    """First row per key under ``order`` (e.g. ``["d desc nulls first",
    "id"]``); skew-safe partial aggregate, see ``ordering.pick_first``."""
    return pick_first(df, _keys(key), order, drop_null_keys)


def dedupe_latest(df: DataFrame, key, date_col: str, tie: str) -> DataFrame:
    """Keep the latest row per key (blank dates last), ties by ``tie``."""
    return pick_first(df, _keys(key), [f"{date_col} desc nulls last", f"{tie} asc"])
