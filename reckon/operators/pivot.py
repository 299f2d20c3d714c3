"""Attribute (EAV) and typed-id pivots, role-playing dimensions.

Pivots use conditional aggregation over an explicit list of names/types, so
there is no extra pass to discover the distinct values and the aggregate is
partial (map-side combine)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_attributes(df: DataFrame, key, name_col: str, value_col: str, names: dict | list, agg: str = "max") -> DataFrame:
    """One row per key, one column per attribute name: ``agg(value) where
    name = n`` (the scalar-subquery-per-attribute pattern in one scan)."""
    keys = [key] if isinstance(key, str) else list(key)
    if isinstance(names, list):
        names = {n: n for n in names}
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "first": F.any_value}[agg]
    return df.groupBy(*keys).agg(
        *[fn(F.when(F.col(name_col) == F.lit(n), F.col(value_col))).alias(alias) for n, alias in names.items()]
    )


def pivot_typed_ids(df: DataFrame, key, type_col: str, id_col: str, types: dict, order_col: str | None = None) -> DataFrame:
    """One column per id type. With ``order_col`` the id on the row with the
    greatest ``order_col`` of that type (ties by greatest id), else the
    greatest id."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = []
    for t, alias in types.items():
        is_t = F.col(type_col) == F.lit(t)
        if order_col:
            s = F.max(F.when(is_t, F.struct(F.col(order_col).alias("o"), F.col(id_col).alias("v"))))
            aggs.append(s.getField("v").alias(alias))
        else:
            aggs.append(F.max(F.when(is_t, F.col(id_col))).alias(alias))
    return df.groupBy(*keys).agg(*aggs)


def fan_out_typed_ids(df: DataFrame, key, type_col: str, id_col: str, types: dict) -> DataFrame:
    """One column per id type, with every id: a key with several ids of a
    type has a row for each combination, one without an id of a type null
    (a left join per type on the same key). Repeated ids count once."""
    keys = [key] if isinstance(key, str) else list(key)
    out = df.select(*keys).distinct()
    for t, alias in types.items():
        of_type = df.where(F.col(type_col) == F.lit(t)).select(*keys, F.col(id_col).alias(alias)).distinct()
        out = out.join(of_type, keys, "left")
    return out


def role_dims(df: DataFrame, dim: DataFrame, dim_key: str, roles: dict, take: list[str], bounded: bool = False) -> DataFrame:
    """Join the same dimension once per role. ``roles`` maps a prefix to the
    foreign-key column of ``df``; each taken column arrives as
    ``<prefix>_<column>``. ``bounded=True`` broadcasts the dimension (only
    for tables whose size is fixed by definition, e.g. code lists)."""
    out = df
    for prefix, fk in roles.items():
        d = dim.select(F.col(dim_key).alias(f"__{prefix}_k"), *[F.col(c).alias(f"{prefix}_{c}") for c in take])
        if bounded:
            d = F.broadcast(d)
        out = out.join(d, out[fk] == d[f"__{prefix}_k"], "left").drop(f"__{prefix}_k")
    return out
