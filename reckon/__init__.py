"""reckon: reconciliation operators for PySpark DataFrames.

Pure functions ``DataFrame -> DataFrame`` built from Spark built-in
expressions: keyed lookups with replace/fill/overwrite modes, semi/anti
joins on key sets, attribute pivots, priority roll-ups, first-match rule
waterfalls, staged statuses, period-over-period comparison, lenient
parsing, partitioned snapshots and named multi-table outputs.
"""

from reckon.functions.columns import (
    blank_to_null,
    ci_eq,
    ci_like,
    ci_ne,
    ci_not_like,
    clamped_diff,
    concat_strict,
    contains_lit,
    is_blank,
    key_concat,
    money,
    ne_null_safe,
    pct_change,
    safe_date,
    safe_num,
    scale_by_decimals,
    threshold_flag,
)
from reckon.functions.dates import (
    check_date,
    cycle_date,
    mdy,
    prev_month_abbr,
    yyyymm,
)
from reckon.operators.lookup import anti_not_in, lookup, propagate_by_key, semi_in
from reckon.operators.rollup import (
    any_match,
    complete_group_max,
    first_per_group,
    latest_per_key,
    dedupe_latest,
    priority_rollup,
    with_group_value,
)
from reckon.operators.rules import Case, Rule, Stage, case_map, group_category, in_term_cancel, staged_status, waterfall
from reckon.operators.pivot import pivot_attributes, pivot_typed_ids, role_dims
from reckon.operators.compare import compare_periods, latest_snapshot, period_compare, sum_by_month

from reckon.session import cut_lineage, scale_conf

__all__ = [name for name in dir() if not name.startswith("_")]
