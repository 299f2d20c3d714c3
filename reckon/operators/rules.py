"""Rule cascades compiled to one expression.

``waterfall``: ordered rules; the first whose condition is true sets
(label, category); a rule fires only while the label is blank; a null
condition is no match. It is a single ``coalesce(when(c1, s1), ...)`` over
structs: one projection, no pass per rule, cost independent of data size.

``staged_status``: ordered stages that either ``fill`` (only if blank) or
``overwrite`` a status column, folded into nested ``when``s.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reckon.functions.columns import is_blank
from reckon.operators.rollup import any_match, with_group_value


@dataclass(frozen=True)
class Rule:
    label: str
    category: str | None
    cond: Column


@dataclass(frozen=True)
class Stage:
    mode: str  # 'fill' | 'overwrite'
    cond: Column
    value: object


@dataclass(frozen=True)
class Case:
    cond: Column
    values: dict = field(default_factory=dict)


def _struct(label, category, label_col, category_col) -> Column:
    return F.struct(F.lit(label).cast("string").alias(label_col), F.lit(category).cast("string").alias(category_col))


def waterfall_expr(
    rules: list[Rule],
    default: tuple[str | None, str | None] = (None, None),
    label_col: str = "reason",
    category_col: str = "category",
    existing: tuple[Column, Column] | None = None,
) -> Column:
    branches = []
    if existing is not None:
        el, ec = existing
        branches.append(F.when(~is_blank(el), F.struct(el.cast("string").alias(label_col), ec.cast("string").alias(category_col))))
    for r in rules:
        branches.append(F.when(F.coalesce(r.cond, F.lit(False)), _struct(r.label, r.category, label_col, category_col)))
    branches.append(_struct(default[0], default[1], label_col, category_col))
    return F.coalesce(*branches)


def waterfall(
    df: DataFrame,
    rules: list[Rule],
    default: tuple[str | None, str | None] = (None, None),
    label_col: str = "reason",
    category_col: str = "category",
    keep_existing: bool = False,
) -> DataFrame:
    """Apply a first-match rule list; adds/replaces ``label_col`` and
    ``category_col``. With ``keep_existing`` a non-blank label already on
    the row wins over every rule (rules only fill blanks)."""
    existing = None
    if keep_existing and label_col in df.columns:
        existing = (F.col(label_col), F.col(category_col) if category_col in df.columns else F.lit(None))
    s = waterfall_expr(rules, default, label_col, category_col, existing)
    keep = [F.col(c) for c in df.columns if c not in (label_col, category_col)]
    return df.select(*keep, s.alias("__wf")).select(
        *[c for c in df.columns if c not in (label_col, category_col)],
        F.col(f"__wf.{label_col}").alias(label_col),
        F.col(f"__wf.{category_col}").alias(category_col),
    )


def staged_expr(start: Column, stages: list[Stage]) -> Column:
    expr = start
    for st in stages:
        cond = F.coalesce(st.cond, F.lit(False))
        val = st.value if isinstance(st.value, Column) else F.lit(st.value)
        if st.mode == "fill":
            expr = F.when(is_blank(expr) & cond, val).otherwise(expr)
        elif st.mode == "overwrite":
            expr = F.when(cond, val).otherwise(expr)
        else:
            raise ValueError(f"unknown stage mode {st.mode}")
    return expr


def staged_status(df: DataFrame, col: str, stages: list[Stage]) -> DataFrame:
    """Fold ordered fill/overwrite stages into ``col`` in one projection."""
    start = F.col(col) if col in df.columns else F.lit(None).cast("string")
    return df.withColumn(col, staged_expr(start, stages))


def case_map(df: DataFrame, cases: list[Case], defaults: dict) -> DataFrame:
    """Disjoint CASE mapping onto several columns at once: the first case
    whose condition holds sets all its columns; otherwise ``defaults``."""
    names = list(defaults)
    def st(values):
        return F.struct(*[(values[n] if isinstance(values.get(n), Column) else F.lit(values.get(n))).cast("string").alias(n) for n in names])
    expr = F.coalesce(*[F.when(F.coalesce(c.cond, F.lit(False)), st(c.values)) for c in cases], st(defaults))
    keep = [c for c in df.columns if c not in names]
    return df.select(*keep, expr.alias("__cm")).select(*keep, *[F.col(f"__cm.{n}").alias(n) for n in names])


def group_category(df: DataFrame, group, category_col: str, value: str, name: str, cut=None, hot: bool = False) -> DataFrame:
    """Per row: does any row of the same group have ``category_col == value``. ``cut`` (as
    ``session.cut_lineage``) writes the labelled rows once, so that what made them is not planned
    again for the groups; ``hot`` see ``with_group_value``."""
    if cut:
        df = cut(df)
    keys = [group] if isinstance(group, str) else list(group)
    if not cut and not hot:
        return any_match(df, group, F.col(category_col) == F.lit(value), name, per_row=True)
    has = group_labels(df, keys, category_col, [value], "__labels").select(*keys, (F.col("__labels") != 0).alias(name))
    return with_group_value(df, has, keys, [name], hot=hot)


def group_labels(df: DataFrame, group, label_col: str, labels: list[str], name: str) -> DataFrame:
    """One row per group (null keys are none): the set of ``labels`` that occur in it, bit k for the k-th (63 at most), by ``bit_or``."""
    if len(labels) > 63:
        raise ValueError("more than 63 labels")
    keys = [group] if isinstance(group, str) else list(group)
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label_col))
    bit = F.when(place > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))).otherwise(F.lit(0).cast("long"))
    rows = df.select(*keys, bit.alias("__bit"))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys).agg(F.bit_or("__bit").alias(name))


def observe_labels(df: DataFrame, label_col: str, labels: list[str], name: str = "labels") -> tuple[DataFrame, Observation]:
    """``df`` with a counter per label (and of ``rows``, ``unlabelled`` and ``other`` labels) that the job reading it
    fills: no extra pass. ``observation.get`` waits for that job; a rule that never fired is a 0 there."""
    c, seen = F.col(label_col), Observation(name)
    if len(set(labels)) < len(labels) or {"rows", "unlabelled", "other"} & set(labels):
        raise ValueError("labels repeat, or have the name of another counter")
    counts = [F.count_if(c == F.lit(x)).alias(x) for x in labels]
    rest = [F.count(F.lit(1)).alias("rows"), F.count_if(c.isNull()).alias("unlabelled"), F.count_if(~c.isin(list(labels))).alias("other")]
    return df.observe(seen, *rest, *counts), seen


def in_term_cancel(term_end, cycle, project, unit, cust_term_end, passthrough: str, discontinuance: str, wholesale: str):
    """In-term exception: term end after the cycle date cancels, unless the
    project is the pass-through exemption, or it is a discontinuance for a
    wholesale unit whose customer term end reaches the term end. A null
    customer term end is not exempt; equality cancels (strict ``<``)."""
    exempt_pass = F.coalesce(project == F.lit(passthrough), F.lit(False))
    exempt_whs = F.coalesce((project == F.lit(discontinuance)) & (unit == F.lit(wholesale)) & (cust_term_end >= term_end), F.lit(False))
    return F.coalesce(term_end > cycle, F.lit(False)) & ~exempt_pass & ~exempt_whs
