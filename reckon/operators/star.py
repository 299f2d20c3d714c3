"""Star and snowflake pulls with a full semi-join reducer.

A pull over many relations keeps few of their rows. ``reduce_star`` therefore
passes key sets through the tree of relations before anything is joined: up,
from the leaves to the root, so that a row without its required partners is
gone early; and down, so that of each relation only the rows that the remaining
root rows refer to are left. ``join_star`` then joins what is left. Key sets are
de-duplicated with a partial aggregate, so a hot key costs one row a mapper.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.operators.lookup import semi_in


@dataclass(frozen=True)
class Dim:
    """A relation of a star. ``on`` maps columns of the ``parent`` (the root by default) to
    columns of ``df``, ``take`` maps columns of ``df`` to result columns. A row of the
    parent without a partner is dropped if ``inner``, else it has nulls. ``code``: a code table, of a size fixed
    by definition, which is not reduced. ``after`` is applied to the reduced rows (a pivot, say) and keeps the ``on`` columns."""

    name: str
    df: DataFrame
    on: dict[str, str]
    take: dict[str, str] = field(default_factory=dict)
    parent: str = ""
    inner: bool = False
    code: bool = False
    after: Callable[[DataFrame], DataFrame] | None = None


def _check(root: DataFrame, dims: list[Dim]) -> None:
    known = {"": root}
    for d in dims:
        if d.name in known:
            raise ValueError(f"relation {d.name} occurs twice")
        if d.parent not in known:
            raise ValueError(f"relation {d.name}: its parent {d.parent} must come before it")
        for c in d.on:
            if c not in known[d.parent].columns:
                raise ValueError(f"relation {d.name}: {d.parent or 'the root'} has no column {c}")
        for c in [*d.on.values(), *(() if d.after else d.take)]:
            if c not in d.df.columns:
                raise ValueError(f"relation {d.name} has no column {c}")
        known[d.name] = d.df


def reduce_star(root: DataFrame, dims: list[Dim], cut: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, list[Dim]]:
    """The root and the relations with only the rows that take part in the result. ``cut`` (as
    ``session.cut_lineage``) materialises the reduced root, which every key set on the way down is read from."""
    _check(root, dims)
    now = {"": root} | {d.name: d.df for d in dims}
    for d in reversed(dims):
        if d.inner:
            now[d.parent] = semi_in(now[d.parent], now[d.name], d.on)
    if cut:
        now[""] = cut(now[""])
    for d in dims:
        if not d.code:
            now[d.name] = semi_in(now[d.name], now[d.parent], {own: c for c, own in d.on.items()})
        if d.after:
            now[d.name] = d.after(now[d.name])
    return now[""], [replace(d, df=now[d.name], after=None) for d in dims]


def join_star(root: DataFrame, dims: list[Dim]) -> DataFrame:
    """The root's columns and those taken from each relation. Several partners give several rows.

    Relations of a relation are joined to it before it meets the root, and the root's own relations are taken
    by their key columns, in the order of the first of each, so that the wide rows are shuffled once a key."""
    _check(root, dims)

    def met(left: DataFrame, parent: str) -> tuple[DataFrame, bool]:
        """``left`` with its relations, and whether one of them is required."""
        own = [d for d in dims if d.parent == parent]
        first = {key: k for k, key in reversed([*enumerate(tuple(sorted(d.on)) for d in own)])}
        required = False
        for d in sorted(own, key=lambda d: first[tuple(sorted(d.on))]):
            keys = {c: f"__{d.name}_k_{c}" for c in d.on.values()}
            links = {c: f"__{d.name}_{c}" for x in dims if x.parent == d.name for c in x.on}  # what its own relations join on
            right = d.df.select(*[F.col(c).alias(n) for c, n in keys.items()], *[F.col(c).alias(n) for c, n in links.items()], *[F.col(c).alias(n) for c, n in d.take.items()])
            right, inner = met(right, d.name)
            cond = None
            for c, k in d.on.items():
                e = left[f"__{parent}_{c}" if parent else c] == right[keys[k]]
                cond = e if cond is None else cond & e
            # a required relation of an optional one drops the root's row as well
            required, inner = required or d.inner or inner, d.inner or inner
            left = left.join(right, cond, "inner" if inner else "left").drop(*keys.values(), *links.values())
        return left, required

    return met(root, "")[0]


def star(root: DataFrame, dims: list[Dim], cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``reduce_star``, then ``join_star``."""
    return join_star(*reduce_star(root, dims, cut))


def decode_roles(df: DataFrame, dim: DataFrame, dim_key: str, value: str, roles: dict[str, str]) -> DataFrame:
    """A lookup table in many roles with one join: ``roles`` maps result columns to foreign keys.

    The distinct combinations of the foreign keys (a partial aggregate; codes are few) are stacked,
    met with the table once, and aggregated back; the rows then look up their combination. The number of
    shuffles does not grow with the roles. ``dim_key`` is unique; null or unknown keys give null.
    """
    names = [f"__f{k}" for k in range(len(roles))]
    rows = df.select("*", *[F.col(fk).alias(n) for fk, n in zip(roles.values(), names)])
    combos = rows.select(*names).distinct()
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("role"), F.col(n).alias("key")) for k, n in enumerate(names)]))
    stacked = combos.select(*names, at.alias("__at")).select(*names, "__at.role", "__at.key")
    codes = dim.select(F.col(dim_key).alias("__code"), F.col(value).alias("__value"))
    met = stacked.join(codes, F.col("key") == F.col("__code"))
    met = met.groupBy(*[F.col(n).alias(f"{n}_") for n in names]).agg(*[F.max(F.when(F.col("role") == k, F.col("__value"))).alias(out) for k, out in enumerate(roles)])
    cond = None
    for n in names:
        e = F.col(n).eqNullSafe(F.col(f"{n}_"))
        cond = e if cond is None else cond & e
    return rows.join(met, cond, "left").drop(*names, *[f"{n}_" for n in names])
