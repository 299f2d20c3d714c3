"""Independent SQL twins of the registry queries (DuckDB dialect, run on
the same parquet tables). Written by hand from the operator semantics,
not generated from the Spark code, so a shared bug cannot hide."""

from __future__ import annotations

from reckon.plans.classify import Labels
from reckon.plans.oracle_cycle import CYCLE_PREP_SQL, CYCLE_PULLS_SQL

_MONEY = "CAST({} AS DECIMAL(18,2))"


def _m(c: str) -> str:
    return _MONEY.format(c)


_BY_MONTH = """SELECT o_orderpriority, o_orderstatus, CAST(month(o_orderdate) AS INTEGER) AS month,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS sum_price
FROM orders WHERE year(o_orderdate) = {year} GROUP BY 1, 2, 3"""

_STAR = """SELECT l.l_orderkey, l.l_linenumber, o.o_custkey,
  CASE WHEN c.c_acctbal < 0 THEN 'Negative balance'
       WHEN o.o_orderstatus = 'P' THEN 'Pending order'
       WHEN l.l_returnflag = 'R' AND coalesce(contains(lower(p.p_type), 'promo'), false) THEN 'Promo return'
       WHEN l.l_returnflag = 'R' THEN 'Returned'
       WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Automobile segment'
       WHEN l.l_discount >= 0.09 THEN 'High discount'
       WHEN p.p_size > 45 THEN 'Large part'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'Urgent'
       ELSE 'Proceed' END AS reason,
  CASE WHEN c.c_acctbal < 0 THEN 'NonActionable'
       WHEN o.o_orderstatus = 'P' THEN 'NonActionable'
       WHEN l.l_returnflag = 'R' AND coalesce(contains(lower(p.p_type), 'promo'), false) THEN 'Actionable'
       WHEN l.l_returnflag = 'R' THEN 'NonActionable'
       WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'NonActionable'
       WHEN l.l_discount >= 0.09 THEN 'Potentially Actionable'
       WHEN p.p_size > 45 THEN 'NonActionable'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'Actionable'
       ELSE 'Actionable' END AS category
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey"""

_MOVE_BACK = "Move back to complete - Reversal cannot be completed due to disconnect"

ORACLE: dict[str, str] = {
    "scan_filter": """SELECT * FROM orders WHERE lower(o_orderstatus) <> 'p'
        AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND year(o_orderdate) = 1997""",
    "like_not_like": """SELECT p_partkey, p_name, p_brand FROM part
        WHERE p_name ILIKE 'small%' AND NOT (p_name ILIKE '%ring%')""",
    "project_swap": """SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_tax AS l_discount,
        l_discount AS l_tax, l_returnflag AS return_flag FROM lineitem WHERE l_returnflag = 'R'""",
    "semi_in": """SELECT * FROM lineitem WHERE l_orderkey IN
        (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "anti_not_in": """SELECT * FROM orders o WHERE NOT EXISTS
        (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "blank_filter": """SELECT * FROM (SELECT event_id, user_id,
        NULLIF(CASE WHEN event_type = 'error' THEN '' ELSE event_type END, '') AS event_type, value FROM events)
        WHERE event_type IS NULL OR event_type = ''""",
    "contains_literal": """SELECT p_partkey, p_type FROM part WHERE coalesce(contains(lower(p_type), 'promo'), false)""",
    "mismatch_subset": """SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.p_size AS ref_size
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
        WHERE p.p_size IS NULL OR CAST(p.p_size AS DOUBLE) IS DISTINCT FROM l.l_quantity""",
    "distinct_multi": """SELECT DISTINCT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem""",
    "latest_snapshot": """SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
    "snapshot_prev_month": """SELECT event_id, user_id, event_type, ts FROM events
        WHERE strftime(ts, '%Y%m') = strftime(DATE '2024-02-17' - INTERVAL 1 MONTH, '%Y%m')""",
    "join_inner": """SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_extendedprice, l.l_shipdate
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
        WHERE o.o_orderstatus = 'F' AND l.l_returnflag = 'R'""",
    "lookup_left": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand AS brand, p.p_retailprice AS retail_price
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "lookup_concat_key": """WITH seg AS (
          SELECT CAST(c_nationkey AS VARCHAR) || c_mktsegment AS gkey, count(*) AS n_in_group,
                 CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS seg_balance
          FROM customer GROUP BY c_nationkey, c_mktsegment)
        SELECT c.c_custkey, CAST(c.c_nationkey AS VARCHAR) || c.c_mktsegment AS ckey, s.n_in_group, s.seg_balance
        FROM customer c LEFT JOIN seg s ON CAST(c.c_nationkey AS VARCHAR) || c.c_mktsegment = s.gkey""",
    "lookup_fill_chain": """WITH s AS (
          SELECT s_suppkey, s_nationkey, n.n_regionkey AS s_regionkey,
                 CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS balance
          FROM supplier LEFT JOIN nation n ON s_nationkey = n.n_nationkey),
        nat AS (SELECT s_nationkey, CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) / count(balance) AS nation_avg
                FROM s GROUP BY s_nationkey),
        reg AS (SELECT s_regionkey, CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) / count(balance) AS region_avg
                FROM s WHERE s_regionkey IS NOT NULL GROUP BY s_regionkey)
        SELECT s.s_suppkey, coalesce(s.balance, nat.nation_avg, reg.region_avg) AS balance
        FROM s LEFT JOIN nat ON s.s_nationkey = nat.s_nationkey LEFT JOIN reg ON s.s_regionkey = reg.s_regionkey""",
    "lookup_overwrite": """WITH s AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS line_total
                  FROM lineitem GROUP BY l_orderkey)
        SELECT o.o_orderkey, coalesce(s.line_total, o.o_totalprice) AS o_totalprice
        FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey""",
    "propagate_by_key": """WITH r AS (
          SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey
                 ORDER BY l_extendedprice DESC, l_linenumber DESC, l_returnflag DESC) AS rn
          FROM lineitem WHERE l_returnflag IS NOT NULL AND l_returnflag <> '')
        SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, r.l_returnflag AS order_flag
        FROM lineitem l LEFT JOIN r ON l.l_orderkey = r.l_orderkey AND r.rn = 1""",
    "left_join_on_filter": """SELECT c.c_custkey, o.o_orderkey, o.o_totalprice
        FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_orderstatus = 'F'""",
    "left_where_inner": """SELECT c.c_custkey, o.o_orderkey, o.o_totalprice
        FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus = 'F'""",
    "open_rows_after_left": """SELECT o.o_orderkey, o.o_orderstatus FROM orders o
        LEFT JOIN (SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R') r ON o.o_orderkey = r.l_orderkey
        WHERE r.l_shipdate IS NULL""",
    "star_join": """SELECT r.r_name, p.p_brand, CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
               count(*) AS n_lines
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
        JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
        GROUP BY r.r_name, p.p_brand""",
    "role_playing_dim": """SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS cust_nation, sn.n_name AS supp_nation
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey""",
    "typed_id_pivot": """WITH r AS (SELECT user_id, event_type, event_id,
            row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        SELECT user_id,
          max(CASE WHEN event_type = 'view' AND rn = 1 THEN event_id END) AS last_view,
          max(CASE WHEN event_type = 'click' AND rn = 1 THEN event_id END) AS last_click,
          max(CASE WHEN event_type = 'signup' AND rn = 1 THEN event_id END) AS last_signup,
          max(CASE WHEN event_type = 'error' AND rn = 1 THEN event_id END) AS last_error,
          max(CASE WHEN event_type = 'purchase' AND rn = 1 THEN event_id END) AS last_purchase
        FROM r GROUP BY user_id""",
    "typed_id_fanout": """SELECT k.l_orderkey, r.id AS supplier_r, a.id AS supplier_a, n.id AS supplier_n
        FROM (SELECT DISTINCT l_orderkey FROM lineitem) k
        LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey AS id FROM lineitem WHERE l_returnflag = 'R') r ON k.l_orderkey = r.l_orderkey
        LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey AS id FROM lineitem WHERE l_returnflag = 'A') a ON k.l_orderkey = a.l_orderkey
        LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey AS id FROM lineitem WHERE l_returnflag = 'N') n ON k.l_orderkey = n.l_orderkey""",
    "eav_pivot": """WITH a AS (SELECT user_id,
            max(CASE WHEN event_type = 'view' THEN value END) AS max_view,
            max(CASE WHEN event_type = 'click' THEN value END) AS max_click,
            max(CASE WHEN event_type = 'signup' THEN value END) AS max_signup,
            max(CASE WHEN event_type = 'error' THEN value END) AS max_error,
            max(CASE WHEN event_type = 'purchase' THEN value END) AS max_purchase
          FROM events GROUP BY user_id)
        SELECT c.c_custkey, a.max_view, a.max_click, a.max_signup, a.max_error, a.max_purchase
        FROM customer c LEFT JOIN a ON c.c_custkey = a.user_id""",
    "join_expr_key": """SELECT o.o_orderkey, o.o_custkey, c.c_name, CAST(o.o_custkey AS VARCHAR) AS key_text,
               CAST(NULL AS VARCHAR) AS ma_piid
        FROM orders o JOIN customer c ON CAST(right(c.c_name, 9) AS BIGINT) = o.o_custkey""",
    "agg_sum_by_month": """SELECT o_orderpriority, o_orderstatus, month, CAST(sum_price AS DOUBLE) AS sum_price
        FROM (""" + _BY_MONTH.format(year=1997) + ")",
    "group_amount_match": """WITH g AS (SELECT l_orderkey,
            sum(CASE WHEN l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS amount,
            max(CAST(l_extendedprice AS DECIMAL(18,2))) AS current_amt,
            min(CAST(l_extendedprice AS DECIMAL(18,2))) AS new_amt
          FROM lineitem GROUP BY l_orderkey)
        SELECT l_orderkey, CAST(amount AS DOUBLE) AS amount, CAST(current_amt AS DOUBLE) AS current_amt,
               CAST(new_amt AS DOUBLE) AS new_amt,
               CASE WHEN amount = current_amt THEN 'Proceed' WHEN amount <> new_amt THEN 'Cancel' ELSE 'Unchanged' END AS amount_status
        FROM g""",
    "any_match_group": """SELECT l_orderkey, bool_or(coalesce(l_returnflag = 'R', false)) AS has_return
        FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey""",
    "priority_rollup": """SELECT l_partkey,
          coalesce(CASE min(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 WHEN 'N' THEN 3 END)
                   WHEN 1 THEN 'R' WHEN 2 THEN 'A' WHEN 3 THEN 'N' END, 'N') AS part_flag
        FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey""",
    "priority_rollup_default": """SELECT l_orderkey, l_linenumber, l_partkey,
          CASE min(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 END) OVER (PARTITION BY l_partkey)
               WHEN 1 THEN 'R' WHEN 2 THEN 'A' END AS part_flag
        FROM lineitem""",
    "complete_group_max": """WITH po AS (SELECT l_orderkey, max(l_shipdate) AS order_last_ship FROM lineitem GROUP BY l_orderkey),
        o AS (SELECT o.o_custkey, po.order_last_ship, po.l_orderkey IS NOT NULL AS found
              FROM orders o LEFT JOIN po ON o.o_orderkey = po.l_orderkey)
        SELECT o_custkey, CASE WHEN bool_and(found) AND count(order_last_ship) > 0 THEN max(order_last_ship) END AS last_ship
        FROM o WHERE o_custkey IS NOT NULL GROUP BY o_custkey""",
    "latest_per_key_ties": """SELECT o_custkey, o_orderkey, o_orderdate FROM orders a
        WHERE o_orderstatus <> 'P' AND o_orderdate =
          (SELECT max(o_orderdate) FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderstatus <> 'P')""",
    "first_per_group_nulls_first": """WITH x AS (SELECT l_orderkey,
            CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_shipdate END AS first_date FROM lineitem)
        SELECT l_orderkey, first_date FROM (SELECT l_orderkey, first_date,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY first_date DESC NULLS FIRST) AS rn FROM x)
        WHERE rn = 1""",
    "dedupe_latest": """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT o_custkey, o_orderkey, o_orderdate,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC) AS rn
          FROM orders) WHERE rn = 1""",
    "sort_multi": """SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier ORDER BY s_nationkey ASC, s_acctbal DESC, s_suppkey""",
    "union_by_name": """SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus,
               CAST(NULL AS TIMESTAMP) AS o_orderdate FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT o_orderkey, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), o_orderstatus, o_orderdate
        FROM orders WHERE o_orderstatus = 'P'""",
    "str_funcs": """SELECT c_custkey, c_name || c_mktsegment AS name_seg, substring(c_name, 4) AS name_tail,
               right(c_name, 9) AS name_digits, regexp_matches(right(c_name, 9), '^[0-9]+$') AS all_digits,
               regexp_matches(regexp_extract(c_name, '([^#]*)$', 1), '^[0-9]{11,}$') AS long_digits
        FROM customer""",
    "date_funcs": """SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS order_mdy,
               upper(strftime(o_orderdate - INTERVAL 1 MONTH, '%b')) AS prev_mon,
               CAST(date_trunc('month', o_orderdate) + INTERVAL 3 MONTH AS DATE) AS check_date,
               least(last_day(CAST(o_orderdate AS DATE)), CAST(date_trunc('month', o_orderdate) AS DATE) + 30) AS cycle_date
        FROM orders""",
    "safe_cast": """SELECT event_id, TRY_CAST(k AS INTEGER) AS k_num, try_strptime('2024-01-' || k, '%Y-%m-%d') AS k_date
        FROM (SELECT event_id, nullif(regexp_extract(props, '"k": *(-?[0-9]+)', 1), '') AS k FROM events)""",
    "scale_amount": """SELECT l_orderkey, l_linenumber, l_extendedprice / 100 AS price_hundredths,
               l_extendedprice / pow(10, l_linenumber % 3) AS price_scaled FROM lineitem""",
    "clamped_diff": """WITH x AS (SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS a,
               CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2)) AS b
          FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey)
        SELECT l_orderkey, l_linenumber,
               CAST(CASE WHEN a IS NULL OR b IS NULL THEN NULL WHEN a - b < 0.01 THEN 0 ELSE a - b END AS DOUBLE) AS diff
        FROM x""",
    "period_compare_yyyymm": """SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
               CAST(year(o_orderdate) AS INTEGER) AS p_year, CAST(month(o_orderdate) AS INTEGER) AS p_month
        FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) >= 199706""",
    "period_compare": """WITH p AS (""" + _BY_MONTH.format(year=1996) + """),
        c AS (""" + _BY_MONTH.format(year=1997) + """),
        j AS (SELECT p.o_orderpriority, p.o_orderstatus, p.month, CAST(p.sum_price AS DOUBLE) AS prev_value,
                     CAST(c.sum_price AS DOUBLE) AS curr_value
              FROM p LEFT JOIN c ON p.o_orderpriority IS NOT DISTINCT FROM c.o_orderpriority
                AND p.o_orderstatus IS NOT DISTINCT FROM c.o_orderstatus AND p.month IS NOT DISTINCT FROM c.month),
        k AS (SELECT *, CASE WHEN prev_value IS NOT NULL AND curr_value IS NOT NULL AND prev_value <> 0
                        THEN (curr_value - prev_value) / prev_value * 100 END AS percent_diff FROM j)
        SELECT *, CASE WHEN percent_diff IS NOT NULL THEN CAST(percent_diff > 20 AS INTEGER) END AS over_hi,
                  CASE WHEN percent_diff IS NOT NULL THEN CAST(percent_diff < -20 AS INTEGER) END AS under_lo
        FROM k""",
    "case_rules": """SELECT o_orderkey,
          CASE WHEN o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Canceled' END AS new_status,
          CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'Renewal'
               WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'Disconnect' END AS reason,
          CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'Renewal per validator'
               WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'Disconnect per validator' END AS note,
          CASE WHEN o_orderstatus = 'F' AND o_totalprice <> 0 THEN 'Proceed with Rerate'
               WHEN o_orderstatus = 'P' THEN 'Proceed with Reversal' END AS row_status
        FROM orders""",
    "cycle_date_fix": """SELECT l_orderkey, l_linenumber,
          CASE WHEN l_shipdate IS NOT NULL THEN least(last_day(make_date(2025, 6, 1)), make_date(2025, 6, 1) + 30) END AS fixed_date
        FROM lineitem""",
    "flag_repair": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
          CASE WHEN l.l_returnflag IS NULL OR l.l_returnflag = '' OR l.l_returnflag = 'N'
               THEN CASE WHEN coalesce(contains(lower(p.p_type), 'promo'), false) THEN 'N' ELSE 'Y' END
               ELSE l.l_returnflag END AS repaired_flag
        FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "rule_waterfall": "SELECT l_orderkey, l_linenumber, reason, category FROM (" + _STAR + ")",
    "group_actionable": """SELECT l_orderkey, l_linenumber, o_custkey, category,
          bool_or(coalesce(category = 'Actionable', false)) OVER (PARTITION BY o_custkey) AS customer_actionable
        FROM (""" + _STAR + ")",
    "staged_status": """WITH s1 AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'Returned' END AS st FROM lineitem),
        s2 AS (SELECT * REPLACE (CASE WHEN (st IS NULL OR st = '') AND l_linestatus = 'O' THEN 'Open' ELSE st END AS st) FROM s1),
        s3 AS (SELECT * REPLACE (CASE WHEN l_quantity > 48 THEN 'Bulk' ELSE st END AS st) FROM s2),
        s4 AS (SELECT * REPLACE (CASE WHEN (st IS NULL OR st = '') AND l_discount = 0 THEN 'No discount' ELSE st END AS st) FROM s3),
        s5 AS (SELECT * REPLACE (CASE WHEN l_tax > 0.07 AND l_returnflag = 'A' THEN 'Taxed accepted' ELSE st END AS st) FROM s4)
        SELECT l_orderkey, l_linenumber, st AS status FROM s5""",
    "exception_rule": """SELECT l.l_orderkey, l.l_linenumber,
          CASE WHEN coalesce(l.l_shipdate > TIMESTAMP '1998-06-30', false)
                AND NOT coalesce(o.o_orderpriority = '5-LOW', false)
                AND NOT coalesce(o.o_orderpriority = '4-NOT SPECIFIED' AND o.o_orderstatus = 'F'
                                 AND o.o_orderdate + INTERVAL 36 MONTH >= l.l_shipdate, false)
               THEN 'Cancel - Circuit in term' END AS status
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "cycle_prep_mini": """WITH base AS (
          SELECT l_orderkey AS piid, l_linenumber AS line_no, l_partkey AS part_id, l_suppkey AS supp_id,
                 CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
                      ELSE CAST(l_partkey AS VARCHAR) END AS scid,
                 l_discount AS cur_rate, l_tax AS new_rate, 'rerate' AS kind, CAST(NULL AS DATE) AS reversal_date
          FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL
          SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                 CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)
                      ELSE CAST(l_partkey AS VARCHAR) END,
                 l_tax, l_discount, 'reversal', CASE WHEN l_shipdate IS NOT NULL THEN DATE '2025-06-30' END
          FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'),
        billed AS (SELECT CAST(l_partkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR) AS bkey, max(l_discount) AS rate
                   FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
        s1 AS (SELECT b.*, bl.rate AS billed FROM base b
               LEFT JOIN billed bl ON CAST(b.part_id AS VARCHAR) || CAST(b.supp_id AS VARCHAR) = bl.bkey),
        s2 AS (SELECT s1.*, s.s_name AS active FROM s1
               LEFT JOIN (SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0) s ON s1.supp_id = s.s_suppkey),
        fa AS (SELECT piid, active AS pact FROM (SELECT piid, active,
                 row_number() OVER (PARTITION BY piid ORDER BY line_no, supp_id) AS rn
               FROM s2 WHERE active IS NOT NULL AND active <> '') WHERE rn = 1),
        s3 AS (SELECT s2.* REPLACE (CASE WHEN s2.active IS NULL OR s2.active = '' THEN fa.pact ELSE s2.active END AS active)
               FROM s2 LEFT JOIN fa ON s2.piid = fa.piid),
        s4 AS (SELECT s3.* REPLACE (CASE WHEN contains(s3.scid, '-') AND s3.billed IS NULL THEN p.p_retailprice / 10000
                                         ELSE s3.billed END AS billed)
               FROM s3 LEFT JOIN part p ON s3.part_id = p.p_partkey),
        s5 AS (SELECT *, CASE WHEN billed IS NULL OR cur_rate IS NULL THEN NULL
                              WHEN cur_rate - billed < 0.01 THEN 0.0 ELSE cur_rate - billed END AS difference FROM s4),
        disc AS (SELECT l_orderkey, bool_or(coalesce(l_linestatus = 'O' AND l_returnflag = 'N', false)) AS has_disconnect
                 FROM lineitem GROUP BY l_orderkey),
        s6 AS (SELECT s5.*,
                 CASE WHEN s5.billed IS NULL AND s5.kind = 'reversal' AND coalesce(d.has_disconnect, false)
                        THEN '""" + _MOVE_BACK + """'
                      WHEN s5.billed IS NULL AND coalesce(d.has_disconnect, false) THEN 'Cancel - Disconnect'
                      WHEN s5.difference IS NULL OR s5.difference <> 0 THEN 'Cancel for MRR Cost Change' END AS status
               FROM s5 LEFT JOIN disc d ON s5.piid = d.l_orderkey),
        s7 AS (SELECT s6.*, coalesce(o.o_orderdate, f.last_ship) AS term_end FROM s6
               LEFT JOIN (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F') o ON s6.piid = o.o_orderkey
               LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) f
                 ON s6.piid = f.l_orderkey)
        SELECT piid, line_no, scid, kind, cur_rate, new_rate, billed, active, difference, status, term_end,
               CASE min(CASE status WHEN 'Cancel - Disconnect' THEN 1 WHEN '""" + _MOVE_BACK + """' THEN 2
                                    WHEN 'Cancel for MRR Cost Change' THEN 3 END) OVER (PARTITION BY piid)
                    WHEN 1 THEN 'Cancel - Disconnect' WHEN 2 THEN '""" + _MOVE_BACK + """'
                    WHEN 3 THEN 'Cancel for MRR Cost Change' END AS piid_status,
               reversal_date
        FROM s7""",
    "classify_mini": """WITH m AS (SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority,
                 o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn
               FROM orders) WHERE rn = 1),
        j AS (SELECT c.c_custkey, c.c_acctbal, m.o_custkey IS NULL AS missing, m.o_orderdate, m.o_orderstatus,
                     m.o_orderpriority, m.o_totalprice FROM customer c LEFT JOIN m ON c.c_custkey = m.o_custkey)
        SELECT c_custkey,
          CASE WHEN missing THEN 'Not in margin base' WHEN c_acctbal < 0 THEN 'Negative balance'
               WHEN o_orderstatus = 'P' THEN 'Pending'
               WHEN CAST(o_orderdate AS DATE) > DATE '1997-09-01' AND o_orderpriority = '1-URGENT' THEN 'In Term - Urgent'
               WHEN CAST(o_orderdate AS DATE) > DATE '1997-09-01' THEN 'In Term'
               WHEN o_totalprice = 0 THEN 'Service is $0 Biller' ELSE 'Proceed with Rerate' END AS reason,
          CASE WHEN missing THEN 'NonActionable' WHEN c_acctbal < 0 THEN 'NonActionable'
               WHEN o_orderstatus = 'P' THEN 'NonActionable'
               WHEN CAST(o_orderdate AS DATE) > DATE '1997-09-01' AND o_orderpriority = '1-URGENT' THEN 'Actionable'
               WHEN CAST(o_orderdate AS DATE) > DATE '1997-09-01' THEN 'NonActionable'
               ELSE 'Actionable' END AS category
        FROM j""",
    "validator_mini": """WITH d AS (SELECT DISTINCT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority,
                 l.l_returnflag, l.l_linestatus
          FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
          WHERE NOT (o.o_orderpriority ILIKE '%low%') AND lower(o.o_orderstatus) <> 'p'
            AND year(o.o_orderdate) IN (1996, 1997))
        SELECT o_orderkey, o_custkey,
          CASE WHEN o_orderstatus = 'O' AND l_returnflag IN ('R', 'A') THEN 'Canceled' END AS workflow_status,
          CASE WHEN o_orderstatus = 'O' AND l_returnflag = 'R' THEN 'Renewal'
               WHEN o_orderstatus = 'O' AND l_returnflag = 'A' THEN 'Disconnect' END AS non_opp_reason,
          CASE WHEN o_orderstatus = 'O' AND l_returnflag = 'R' THEN 'Renewal per validator'
               WHEN o_orderstatus = 'O' AND l_returnflag = 'A' THEN 'Disconnect per validator' END AS notes
        FROM d""",
    "forecast_compare_job": """WITH hist AS (
          SELECT o_orderpriority AS initiative, o_orderstatus AS rerate_type, o_orderdate AS rerate_month, o_totalprice AS increase,
                 TIMESTAMP '2025-05-28' AS finalized_date FROM orders
          UNION ALL
          SELECT o_orderpriority, o_orderstatus, o_orderdate, o_totalprice * 2, TIMESTAMP '2025-04-28' FROM orders WHERE o_orderstatus = 'P'),
        past AS (SELECT initiative, rerate_type, CAST(month(rerate_month) AS INTEGER) AS rerate_month,
                        CAST(sum(CAST(increase AS DECIMAL(18,2))) AS DOUBLE) AS may_sum_increase
                 FROM hist WHERE finalized_date = (SELECT max(finalized_date) FROM hist) AND year(rerate_month) = 1997 GROUP BY 1, 2, 3),
        lines AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS increase FROM lineitem GROUP BY l_orderkey),
        cur AS (SELECT o.o_orderpriority AS initiative, o.o_orderstatus AS rerate_type, CAST(month(o.o_orderdate) AS INTEGER) AS rerate_month,
                       CAST(sum(CAST(CAST(l.increase AS DOUBLE) AS DECIMAL(18,2))) AS DOUBLE) AS june_sum_increase
                FROM orders o JOIN lines l ON o.o_orderkey = l.l_orderkey WHERE year(o.o_orderdate) = 1997 GROUP BY 1, 2, 3),
        j AS (SELECT p.initiative, p.rerate_type, p.rerate_month,
                     coalesce(p.initiative, '') || coalesce(p.rerate_type, '') || coalesce(CAST(p.rerate_month AS VARCHAR), '') AS concat,
                     p.may_sum_increase, c.june_sum_increase
              FROM past p LEFT JOIN cur c ON p.initiative IS NOT DISTINCT FROM c.initiative
                AND p.rerate_type IS NOT DISTINCT FROM c.rerate_type AND p.rerate_month IS NOT DISTINCT FROM c.rerate_month),
        k AS (SELECT *, CASE WHEN may_sum_increase IS NOT NULL AND june_sum_increase IS NOT NULL AND may_sum_increase <> 0
                        THEN (june_sum_increase - may_sum_increase) / may_sum_increase * 100 END AS percent_diff FROM j)
        SELECT *, CASE WHEN percent_diff IS NOT NULL THEN CAST(percent_diff > 20 AS INTEGER) END AS over_20_increase,
                  CASE WHEN percent_diff IS NOT NULL THEN CAST(percent_diff < -20 AS INTEGER) END AS over_20_decrease
        FROM k""",
    "validator_job": """WITH log AS (
          SELECT CAST(o_orderkey AS VARCHAR) AS piid_meid, CAST(o_custkey AS VARCHAR) AS product_inst_id,
                 CASE WHEN o_orderstatus = 'P' THEN 'Red' ELSE 'GREEN' END AS redblue, o_orderpriority AS subprojname,
                 CASE WHEN o_orderstatus = 'O' THEN 'In Progress' ELSE 'Complete' END AS workflowstatus,
                 month(o_orderdate) AS rerate_month, year(o_orderdate) AS fiscalyear, o_orderdate AS disconnectdate,
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'Disconnect' WHEN '2-HIGH' THEN 'Canceled due to Renewal'
                      WHEN '3-MEDIUM' THEN 'Overlap found' ELSE 'Other' END AS disposition,
                 o_orderstatus AS disconnected, CAST(NULL AS TIMESTAMP) AS dtedisconnected
          FROM orders),
        hdr AS (SELECT CAST(l_orderkey AS VARCHAR) AS piid_meid, CASE WHEN l_returnflag = 'R' THEN 'Canceled' ELSE 'Open' END AS workflowstatus,
                       month(l_shipdate) AS rerate_month_actual, day(l_shipdate) AS invoice_day, year(l_shipdate) AS fiscalyear,
                       l_linestatus AS non_opp_reason FROM lineitem),
        v AS (SELECT DISTINCT l.piid_meid, l.product_inst_id, l.redblue, l.subprojname, l.workflowstatus, l.rerate_month, l.fiscalyear,
                     l.disconnectdate, l.disposition, r.invoice_day, l.disconnected, l.dtedisconnected, r.non_opp_reason
              FROM log l JOIN hdr r ON r.piid_meid = l.piid_meid
              WHERE lower(l.redblue) = 'green' AND NOT (l.subprojname ILIKE '%special access%') AND NOT (l.disposition ILIKE '%overlap%')
                AND lower(r.workflowstatus) <> 'canceled' AND r.rerate_month_actual = 6 AND r.invoice_day = 15 AND r.fiscalyear = 1997)
        SELECT piid_meid, product_inst_id, disconnectdate,
               CASE WHEN workflowstatus = 'In Progress' AND disposition IN ('Canceled due to Renewal', 'Disconnect') THEN 'Canceled' END AS workflowstatus,
               CASE WHEN workflowstatus = 'In Progress' AND disposition = 'Canceled due to Renewal' THEN 'Renewal'
                    WHEN workflowstatus = 'In Progress' AND disposition = 'Disconnect' THEN 'Disconnect' END AS non_opp_reason,
               CASE WHEN workflowstatus = 'In Progress' AND disposition = 'Canceled due to Renewal' THEN 'Renewal per validator'
                    WHEN workflowstatus = 'In Progress' AND disposition = 'Disconnect' THEN 'Disconnect per validator' END AS notes1
        FROM v""",
    "lookup_first_ordered": """WITH r AS (SELECT o_custkey, o_orderkey, o_orderdate,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders WHERE o_custkey IS NOT NULL)
        SELECT c.c_custkey, c.c_name, r.o_orderkey AS last_order, r.o_orderdate AS last_order_date
        FROM customer c LEFT JOIN r ON c.c_custkey = r.o_custkey AND r.rn = 1""",
    "propagate_last": """WITH r AS (SELECT l_orderkey, l_returnflag,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_linenumber DESC NULLS LAST,
                                                         l_returnflag DESC NULLS LAST) AS rn
          FROM lineitem WHERE l_returnflag IS NOT NULL AND l_returnflag <> '')
        SELECT l.l_orderkey, l.l_linenumber, r.l_returnflag AS order_flag
        FROM lineitem l LEFT JOIN r ON l.l_orderkey = r.l_orderkey AND r.rn = 1""",
    "first_per_group_mixed": """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, l_extendedprice FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey
                 ORDER BY l_quantity DESC, l_shipdate ASC, l_linenumber ASC, l_extendedprice DESC) AS rn
          FROM lineitem WHERE l_orderkey IS NOT NULL) WHERE rn = 1""",
    "waterfall_keep_existing": """SELECT o_orderkey,
          CASE WHEN o_orderstatus = 'P' THEN 'Pre-set' WHEN o_orderpriority = '1-URGENT' THEN 'Urgent'
               WHEN o_totalprice > 300000 THEN 'Large' ELSE 'Proceed' END AS reason,
          CASE WHEN o_orderstatus = 'P' THEN 'Held' WHEN o_orderpriority = '1-URGENT' THEN 'Actionable'
               WHEN o_totalprice > 300000 THEN 'NonActionable' ELSE 'Actionable' END AS category
        FROM orders""",
    "classify_job": """WITH ms AS (
          SELECT CAST(o_orderkey AS VARCHAR) AS ecckt_aml_id, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ecckt_stripped_name,
                 o_orderpriority AS sap_account_cd, CAST(o_orderkey AS VARCHAR) AS rev_product_compnt_id,
                 CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS rev_mrr, CAST(o_custkey AS VARCHAR) AS solution_id_prime,
                 CASE WHEN o_orderpriority = '5-LOW' THEN 'Y' ELSE 'N' END AS gov_ind,
                 CASE WHEN o_orderstatus = 'F' THEN 'CABS' ELSE 'KEN' END AS bill_src_sys_cd,
                 strftime(o_orderdate, '%Y-%m-%d') AS last_rerate_date, 199706 AS jrnl_yr_mnth_nbr,
                 CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Contractual' END AS dnt_reason_code,
                 strftime(CAST(o_orderdate AS DATE) + 120, '%Y-%m-%d') AS hold_expiration_date
          FROM orders),
        mc AS (
          SELECT CAST(c_custkey AS VARCHAR) AS solution_id_prime, c_mktsegment AS product_concat,
                 CASE WHEN c_mktsegment = 'BUILDING' THEN 'Y' ELSE 'N' END AS in_term_tdm_rr,
                 strftime(DATE '1997-06-01' + CAST(c_custkey % 400 AS INTEGER), '%Y-%m-%d') AS customer_term_end_dt,
                 CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS marc_rev_mrr,
                 CASE WHEN c_nationkey < 20 THEN 'NA' ELSE 'EMEA' END AS occ_region_concat
          FROM customer),
        gl AS (
          SELECT cd AS gl_account_cd, CASE WHEN cd = '2-HIGH' THEN 'Disco Shelf GL' ELSE 'GL ' || cd END AS gl_account_desc,
                 CASE WHEN cd = '3-MEDIUM' THEN 'Fixed Netex' ELSE 'Direct Netex' END AS gl_account_ess_tier3_desc
          FROM (SELECT DISTINCT o_orderpriority AS cd FROM orders)),
        inp AS (SELECT CAST(c_custkey AS VARCHAR) AS input_ecckt_aml_id, c_name AS input_name FROM customer),
        base AS (
          SELECT ms.*, mc.product_concat, mc.in_term_tdm_rr, mc.customer_term_end_dt, mc.marc_rev_mrr, mc.occ_region_concat,
                 gl.gl_account_desc, gl.gl_account_ess_tier3_desc
          FROM ms LEFT JOIN mc ON ms.solution_id_prime = mc.solution_id_prime LEFT JOIN gl ON ms.sap_account_cd = gl.gl_account_cd
          WHERE ms.ecckt_stripped_name IN (SELECT input_name FROM inp)),
        nf AS (SELECT input_name FROM inp WHERE input_name NOT IN (SELECT ecckt_stripped_name FROM base)),
        snap AS (
          SELECT c_name AS sid, CASE WHEN c_custkey % 5 = 0 THEN 'N' ELSE 'Y' END AS active_ind,
                 CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 1 END AS company
          FROM customer WHERE c_name IN (SELECT input_name FROM nf)),
        sflags AS (SELECT sid, true AS snap_found, bool_or(coalesce(active_ind = 'N', false)) AS snap_inactive,
                          bool_or(company IS DISTINCT FROM 1) AS snap_other FROM snap GROUP BY sid),
        bill AS (SELECT CAST(l_orderkey AS VARCHAR) AS primary_type_1,
                        CASE WHEN l_linestatus <> 'O' THEN TRY_CAST(strftime(l_shipdate, '%Y-%m-%d') AS TIMESTAMP) END AS d FROM lineitem),
        stops AS (SELECT primary_type_1, CASE WHEN count(*) > count(d) THEN NULL ELSE max(d) END AS kdate, true AS stop_found
                  FROM bill GROUP BY primary_type_1),
        df0 AS (
          SELECT i.input_ecckt_aml_id, i.input_name, b.*, b.ecckt_stripped_name IS NOT NULL AS in_margin,
                 sf.snap_found, sf.snap_inactive, sf.snap_other, st.kdate, st.stop_found
          FROM inp i LEFT JOIN base b ON i.input_name = b.ecckt_stripped_name
          LEFT JOIN sflags sf ON i.input_name = sf.sid LEFT JOIN stops st ON b.rev_product_compnt_id = st.primary_type_1),
        disco AS (SELECT solution_id_prime, CASE WHEN bool_and(coalesce(stop_found, false)) AND count(kdate) > 0 THEN max(kdate) END AS disco_date
                  FROM df0 WHERE solution_id_prime IS NOT NULL GROUP BY solution_id_prime),
        holds AS (SELECT DISTINCT solution_id_prime, dnt_reason_code, TRY_CAST(hold_expiration_date AS TIMESTAMP) AS hold
                  FROM ms WHERE lower(dnt_reason_code) IN ('contractual', 'bankruptcy')
                    AND solution_id_prime IN (SELECT solution_id_prime FROM base)),
        hflag AS (SELECT solution_id_prime, bool_or(coalesce(hold > TIMESTAMP '1997-09-01', false)) AS dntl_hold FROM holds GROUP BY 1),
        hist AS (SELECT CAST(o_custkey AS VARCHAR) AS product_inst_id, o_orderdate AS rerate_date,
                        CASE WHEN o_orderstatus = 'O' THEN 'In Progress' WHEN o_orderstatus = 'F' THEN 'Complete' ELSE 'Canceled' END AS wf
                 FROM orders),
        hist2 AS (SELECT * FROM hist WHERE lower(wf) <> 'canceled' AND product_inst_id IN (SELECT solution_id_prime FROM base)),
        wf AS (SELECT a.product_inst_id, bool_or(a.wf = 'In Progress') AS wf_in_progress, bool_or(a.wf = 'Canceled') AS wf_canceled
               FROM hist2 a WHERE a.rerate_date = (SELECT max(b.rerate_date) FROM hist2 b WHERE b.product_inst_id = a.product_inst_id)
               GROUP BY a.product_inst_id),
        df AS (
          SELECT df0.*, disco.disco_date, hflag.dntl_hold, wf.wf_in_progress, wf.wf_canceled,
                 TRY_CAST(df0.customer_term_end_dt AS TIMESTAMP) AS term_end, TRY_CAST(df0.last_rerate_date AS TIMESTAMP) AS last_rr
          FROM df0 LEFT JOIN disco ON df0.solution_id_prime = disco.solution_id_prime
          LEFT JOIN hflag ON df0.solution_id_prime = hflag.solution_id_prime
          LEFT JOIN wf ON df0.solution_id_prime = wf.product_inst_id),
        r AS (
          SELECT input_ecckt_aml_id, rev_product_compnt_id, solution_id_prime,
            CASE WHEN NOT in_margin AND snap_found IS NULL THEN 'ECCKT does not exist in (month) AIM|NonActionable'
                 WHEN NOT in_margin AND coalesce(snap_inactive, false) THEN 'Expense Not Active in (month) AIM|NonActionable'
                 WHEN NOT in_margin AND coalesce(snap_other, false) THEN 'Not Own-Company Expense (DW Secure Company <> 1)|NonActionable'
                 WHEN coalesce(gl_account_ess_tier3_desc IS DISTINCT FROM 'Direct Netex'
                      AND (gl_account_ess_tier3_desc = 'Fixed Netex' OR coalesce(contains(gl_account_desc, 'OPEX'), false)), false)
                   THEN 'Not Direct Netex (Fixed or Opex)|NonActionable'
                 WHEN rev_mrr IS NULL AND (coalesce(contains(gl_account_desc, 'Disco Shelf'), false) OR coalesce(contains(gl_account_desc, 'Held for Term'), false))
                   THEN 'Disco Shelf Life or Held for Term|NonActionable'
                 WHEN rev_mrr IS NULL AND (coalesce(contains(rev_product_compnt_id, 'UNMATCHED'), false) OR coalesce(contains(rev_product_compnt_id, 'UNKNOWN'), false))
                   THEN 'Cost not matched in Tail Matching|NonActionable'
                 WHEN rev_mrr IS NULL THEN 'Cost is matched to Component/Service which does not bill/invoice|NonActionable'
                 WHEN disco_date IS NOT NULL THEN 'Revenue Disconnect|NonActionable'
                 WHEN coalesce(contains(gov_ind, 'Y'), false) THEN 'Fed Govt|NonActionable'
                 WHEN coalesce(contains(bill_src_sys_cd, 'ENS'), false) THEN 'ENSEMBLE|NonActionable'
                 WHEN coalesce(contains(lower(rev_product_compnt_id), 'vantive'), false) THEN 'VANTIVE|NonActionable'
                 WHEN coalesce(contains(bill_src_sys_cd, 'CABS'), false) THEN 'CABS|NonActionable'
                 WHEN coalesce(contains(lower(product_concat), 'enterprise broadband'), false) THEN 'Enterprise Broadband|NonActionable'
                 WHEN occ_region_concat IS NOT NULL AND occ_region_concat <> '' AND occ_region_concat <> 'NA' THEN 'Non-North America|NonActionable'
                 WHEN coalesce(regexp_matches(solution_id_prime, '^[0-9]{11,}$') OR contains(lower(solution_id_prime), '**lcc'), false)
                   THEN 'OE Process Needs to be Defined|NonActionable'
                 WHEN coalesce(CAST(term_end AS DATE) > DATE '1997-09-01' AND in_term_tdm_rr = 'Y', false) THEN 'In Term TDM - Reratable|Actionable'
                 WHEN coalesce(CAST(term_end AS DATE) > DATE '1997-09-01', false) THEN 'In Term|NonActionable'
                 WHEN coalesce(dntl_hold, false) THEN 'DNTL|NonActionable'
                 WHEN coalesce(wf_in_progress AND last_rr IS NOT NULL AND CAST(last_rr AS DATE) <= DATE '1997-07-17', false)
                   THEN 'Rerate In Progress within next 30 days|NonActionable'
                 WHEN coalesce(NOT coalesce(wf_canceled, false) AND jrnl_yr_mnth_nbr IS NOT NULL AND last_rr IS NOT NULL
                      AND year(last_rr) * 100 + month(last_rr) >= jrnl_yr_mnth_nbr, false)
                   THEN 'Rerated within 3 Months|Potentially Actionable - Requires Cancel and Reload'
                 WHEN coalesce(contains(input_name, 'revshare'), false) THEN 'RevShare|NonActionable'
                 WHEN coalesce(marc_rev_mrr = 0, false) THEN 'Service is $0 Biller|Actionable'
                 ELSE 'Proceed with Rerate|Actionable' END AS rc
          FROM df),
        r2 AS (SELECT input_ecckt_aml_id, rev_product_compnt_id, solution_id_prime, split_part(rc, '|', 1) AS nonactionable_reason,
                      split_part(rc, '|', 2) AS actionable_nonactionable FROM r)
        SELECT input_ecckt_aml_id, rev_product_compnt_id, nonactionable_reason, actionable_nonactionable,
               CASE WHEN solution_id_prime IS NULL THEN NULL
                    ELSE bool_or(actionable_nonactionable = 'Actionable') OVER (PARTITION BY solution_id_prime) END AS piid_any_actionable
        FROM r2""",
    "cycle_prep_job": CYCLE_PREP_SQL,
    "cycle_prep_pulls": CYCLE_PULLS_SQL,
    "csv_roundtrip": "SELECT * FROM orders",
}
ORACLE["sink_roundtrip"] = (
    f"SELECT *, 'tstage' AS output FROM ({ORACLE['agg_sum_by_month']}) UNION ALL BY NAME "
    f"SELECT *, 'flags' AS output FROM ({ORACLE['any_match_group']})"
)

ORACLE["billing_star"] = """
WITH product AS (
    SELECT l_orderkey AS tid, l_linenumber AS tserv, l_partkey AS sub, l_suppkey AS acct, l_linenumber AS comp, l_orderkey * 8 + l_linenumber AS view_id,
           l_shipdate AS active_dt, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + 30 END AS inactive_dt,
           l_discount = 0 AS no_bill, CASE WHEN l_tax > 0.04 THEN 'M' || (l_linenumber % 3) END AS period
    FROM lineitem WHERE l_returnflag <> 'R'),
ids AS (
    SELECT p_partkey AS sub, 'C' || p_partkey AS id, 1 AS kind, CASE WHEN p_partkey % 5 = 0 THEN TIMESTAMP '2020-01-01' END AS gone FROM part WHERE p_partkey % 9 <> 0
    UNION ALL SELECT p_partkey, 'D' || p_partkey, 1, NULL FROM part WHERE p_partkey % 15 = 0
    UNION ALL SELECT p_partkey, 'P' || p_partkey, 5, NULL FROM part WHERE p_partkey % 2 = 0
    UNION ALL SELECT p_partkey, 'S' || p_partkey, 6, NULL FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT p_partkey, 'T' || p_partkey, 6, NULL FROM part WHERE p_partkey % 6 = 0
    UNION ALL SELECT p_partkey, 'F' || p_partkey, 65, NULL FROM part WHERE p_partkey % 7 = 0),
keys AS (SELECT (CASE WHEN p_size % 2 = 0 THEN 'C' ELSE 'P' END) || p_partkey AS id FROM part WHERE p_size < 30),
bans AS (
    SELECT c_custkey AS acct, 'B' || c_custkey AS ban FROM customer WHERE c_custkey % 11 <> 0
    UNION ALL SELECT c_custkey, 'BB' || c_custkey FROM customer WHERE c_custkey % 13 = 0),
attr AS (SELECT l_orderkey * 8 + l_linenumber AS view_id, (['29', '28', '166', '165', '164', '9'])[1 + l_linenumber % 6] AS param, l_returnflag || l_suppkey AS v FROM lineitem),
views AS (
    SELECT view_id, max(v) FILTER (param = '29') AS description_override, max(v) FILTER (param = '28') AS description_override1, max(v) FILTER (param = '166') AS prcmp_desc,
           max(v) FILTER (param = '165') AS prcmp_code, max(v) FILTER (param = '164') AS prcmp_id
    FROM attr GROUP BY view_id)
SELECT DISTINCT p.sub AS subscr_no, a.c_nationkey AS account_type, CASE WHEN a.c_custkey % 2 = 0 THEN 'O' || a.c_custkey END AS bus_org_id, b.ban, 'I' || a.c_custkey AS invoice_ban,
       a.c_custkey AS account_no, a.c_mktsegment AS bill_company, pv.display_value AS package, cv.n_name AS component, s.p_size AS config_id, 'Config ' || s.p_size AS config_value,
       p.active_dt AS product_active_dt, p.inactive_dt AS product_inactive_dt, i1.gone AS inactive_1, i5.gone AS inactive_5, i6.gone AS inactive_6, i65.gone AS inactive_65,
       p.no_bill AS product_no_bill, a.c_acctbal < 0 AS account_no_bill, s.p_size % 3 = 0 AS service_no_bill,
       CASE WHEN p.period IS NOT NULL THEN 'Period ' || r1.r_name ELSE 'Period ' || r2.r_name END AS bill_period,
       i1.id AS primary_type_1, i5.id AS piid_type_5, i6.id AS scid_type_6, i65.id AS former_prim_type_65, pk.l_shipdate AS create_dt, 'Currency ' || cur.r_name AS currency,
       CAST(round(o.l_extendedprice * 100) AS BIGINT) / 100 AS bill_rate, s.p_brand AS last_changed_by,
       v.description_override, v.description_override1, v.prcmp_desc, v.prcmp_code, v.prcmp_id, CASE WHEN s.p_size % 2 = 0 THEN 'CKT' || s.p_partkey END AS circuit_id
FROM product p
JOIN (SELECT DISTINCT sub FROM ids WHERE id IN (SELECT id FROM keys)) w ON w.sub = p.sub
JOIN part s ON s.p_partkey = p.sub AND s.p_size % 10 <> 0 AND s.p_size < 45
JOIN customer a ON a.c_custkey = p.acct AND a.c_custkey % 17 <> 0
JOIN bans b ON b.acct = a.c_custkey
JOIN nation cv ON cv.n_nationkey = p.comp AND cv.n_nationkey < 6
LEFT JOIN ids i1 ON i1.sub = p.sub AND i1.kind = 1
LEFT JOIN ids i5 ON i5.sub = p.sub AND i5.kind = 5
LEFT JOIN ids i6 ON i6.sub = p.sub AND i6.kind = 6
LEFT JOIN ids i65 ON i65.sub = p.sub AND i65.kind = 65
LEFT JOIN lineitem ce ON ce.l_orderkey = p.tid AND ce.l_linenumber = p.tserv AND ce.l_linenumber <= 5 AND ce.l_partkey % 4 <> 0
LEFT JOIN lineitem pc ON pc.l_orderkey = ce.l_orderkey AND pc.l_linenumber = ce.l_linenumber AND pc.l_linenumber <= 3
LEFT JOIN (SELECT n_nationkey AS id, 'Package ' || n_name AS display_value FROM nation WHERE n_nationkey % 4 <> 0) pv ON pv.id = pc.l_suppkey % 30
LEFT JOIN lineitem pk ON pk.l_orderkey = p.tid AND pk.l_linenumber = p.tserv AND pk.l_quantity > 10
LEFT JOIN lineitem o ON o.l_orderkey = p.tid AND o.l_linenumber = p.tserv AND o.l_linenumber % 2 = 0
LEFT JOIN region r1 ON 'M' || r1.r_regionkey = p.period
LEFT JOIN region r2 ON r2.r_regionkey = a.c_custkey % 7
LEFT JOIN region cur ON cur.r_regionkey = a.c_nationkey % 7
LEFT JOIN views v ON v.view_id = p.view_id
WHERE i1.gone IS NULL AND (o.l_orderkey IS NULL OR o.l_returnflag <> 'A')
"""

ORACLE["ses_star"] = """
WITH alt AS (SELECT l_orderkey * 8 + l_linenumber AS no, (['24256', '85454', '1', '21701', '105652'])[1 + l_linenumber % 5] AS kind, 'ALT' || l_partkey AS v FROM lineitem WHERE l_quantity > 25),
note AS (SELECT l_orderkey * 8 + l_linenumber AS no, 'note ' || l_suppkey AS note_text FROM lineitem WHERE l_discount > 0.07)
SELECT 'O' || o.o_orderkey AS order_id, 'CO' || o.o_custkey AS customer_order_id, 'S' || s.l_partkey AS service_id, o.o_orderdate AS created_date, s.l_shipdate AS bill_start_date,
       CASE WHEN o.o_orderstatus <> 'P' THEN CAST(o.o_orderdate AS DATE) + 7 END AS last_updated_date, n.note_text, ai.v AS instance_id, ac.v AS circuit,
       e.n_name AS service_provisioning_status, i.n_name AS service_action, j.n_name AS service_status, f.n_name AS order_action, g.n_name AS order_type, h.n_name AS order_status
FROM lineitem s
JOIN orders o ON o.o_orderkey = s.l_orderkey
LEFT JOIN alt ac ON ac.no = s.l_orderkey * 8 + s.l_linenumber AND ac.kind IN ('85454', '87879', '85469', '105652')
LEFT JOIN alt ai ON ai.no = s.l_orderkey * 8 + s.l_linenumber AND ai.kind IN ('24256', '21701')
LEFT JOIN note n ON n.no = s.l_orderkey * 8 + s.l_linenumber
LEFT JOIN nation e ON e.n_nationkey = s.l_linenumber
LEFT JOIN nation i ON i.n_nationkey = s.l_suppkey % 9
LEFT JOIN nation j ON j.n_nationkey = CASE WHEN s.l_partkey % 6 <> 0 THEN s.l_partkey % 6 END
LEFT JOIN nation f ON f.n_nationkey = o.o_custkey % 5
LEFT JOIN nation g ON g.n_nationkey = o.o_custkey % 40
LEFT JOIN nation h ON h.n_nationkey = CASE o.o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 4 END
WHERE 'S' || s.l_partkey IN (SELECT 'S' || p_partkey FROM part WHERE p_size < 20)
"""

ORACLE["account_star"] = """
WITH grp AS (
    SELECT l_orderkey AS acct, l_linenumber AS occ, 'K' || l_partkey AS ckt, 'G' || l_linenumber AS cd, CAST(l_partkey AS VARCHAR) AS val, l_suppkey % 8 AS app FROM lineitem),
element AS (
    SELECT 'G' || (p_size % 7 + 1) AS cd, CAST(p_partkey AS VARCHAR) AS val, 'E' || p_partkey AS id FROM part WHERE p_size % 3 = 0
    UNION ALL SELECT 'G' || (p_size % 7 + 1), CAST(p_partkey AS VARCHAR), 'EE' || p_partkey FROM part WHERE p_size % 2 = 0)
SELECT DISTINCT g.app AS application_code, 'Application ' || r.r_name AS application_cd_dsc, g.occ AS occurrence_number, g.acct AS product_account_id, g.ckt AS common_ckt,
       g.cd AS component_group_cd, g.val AS component_grp_val, pa.o_custkey AS customer_acct_id, ct.o_orderdate AS contract_date, ct.o_custkey % 60 AS term_length,
       CASE WHEN ct.o_orderstatus = 'F' THEN CAST(ct.o_orderdate AS DATE) + 365 END AS termination_date, pd.n_nationkey * 100 AS prcmp_id, pd.n_name AS prcmp_dsc,
       pd.n_regionkey = 1 AS billable_ind, c.l_suppkey % 40 AS prcmp_code, CASE WHEN c.l_tax = 0 THEN c.l_shipdate END AS prcmp_override_dt,
       CASE WHEN c.l_discount > 0.08 THEN c.l_shipdate END AS promotion_bgn_date, CASE WHEN c.l_discount > 0.08 THEN CAST(c.l_shipdate AS DATE) + 90 END AS promotion_end_date,
       c.l_shipdate AS bill_eff_bgn_date, CASE WHEN c.l_returnflag = 'A' THEN c.l_shipdate END AS bill_eff_end_date, CAST(c.l_shipdate AS DATE) + 30 AS billed_thru_date,
       c.l_extendedprice AS monthly_rev_est, e.id AS service_element_id, 'PC' || (pa.o_custkey % 7) AS product_code,
       CASE WHEN n.n_nationkey IS NOT NULL THEN g.cd END AS cg_component_group_cd, 'Group ' || n.n_name AS cg_cmp_group_code_dsc
FROM grp g
LEFT JOIN orders ct ON ct.o_orderkey = g.acct AND ct.o_orderstatus <> 'P'
LEFT JOIN element e ON e.val = g.val AND e.cd = g.cd
LEFT JOIN lineitem c ON c.l_orderkey = g.acct AND c.l_linenumber = g.occ AND c.l_quantity > 5
LEFT JOIN orders pa ON pa.o_orderkey = g.acct AND pa.o_custkey % 10 <> 0
LEFT JOIN region r ON r.r_regionkey = g.app
LEFT JOIN nation pd ON pd.n_nationkey = c.l_suppkey % 40
LEFT JOIN nation n ON n.n_nationkey BETWEEN 1 AND 5 AND 'G' || n.n_nationkey = g.cd
WHERE g.ckt IN (SELECT 'K' || p_partkey FROM part WHERE p_size < 25) AND (c.l_orderkey IS NULL OR c.l_returnflag <> 'A')
"""

_INVOICE_LINES = """
ids AS (
    SELECT p_partkey AS sub, 'C' || p_partkey AS id, 1 AS kind FROM part WHERE p_partkey % 9 <> 0
    UNION ALL SELECT p_partkey, 'D' || p_partkey, 1 FROM part WHERE p_partkey % 15 = 0
    UNION ALL SELECT p_partkey, 'P' || p_partkey, 5 FROM part WHERE p_partkey % 2 = 0),
lines AS (
    SELECT CASE WHEN b.l_linenumber % 2 = 0 THEN 'ACCOUNT' ELSE 'SERVICE' END AS billing_level, i.o_orderdate AS prep_date, CAST(i.o_orderdate AS DATE) + 5 AS statement_date, 1 AS prep_status,
           CASE WHEN a.c_custkey % 2 = 0 THEN 'O' || a.c_custkey END AS bus_org_id, a.c_mktsegment AS bill_company, 'I' || a.c_custkey AS ban, strftime(b.l_shipdate, '%m/%d/%Y') AS from_date,
           strftime(CAST(b.l_shipdate AS DATE) + 30, '%m/%d/%Y') AS to_date, 'Package ' || pv.n_name AS package, d.n_name AS description_text, substr(cur.r_name, 1, 3) AS currency,
           CAST(b.l_partkey % 50 + 1 AS DECIMAL(18,2)) AS amount, i1.id AS primary_id, i5.id AS piid, 'pk' || lpad(CAST(s.p_partkey AS VARCHAR), 8, '0') AS package_id,
           b.l_linenumber % 6 AS type_code, 'line ' || b.l_linenumber AS annotation, b.l_discount AS discount, CASE WHEN b.l_discount > 0 THEN b.l_suppkey END AS discount_id,
           b.l_linenumber - 2 AS subtype_code
    FROM customer a
    JOIN orders i ON i.o_custkey = a.c_custkey AND i.o_orderstatus = 'O' AND i.o_orderdate >= TIMESTAMP '1997-04-26'
    JOIN lineitem b ON b.l_orderkey = i.o_orderkey AND b.l_suppkey % 20 NOT IN (0, 1) AND b.l_linenumber >= 2 AND b.l_linenumber % 6 <> 5
    JOIN part s ON s.p_partkey = b.l_partkey AND s.p_size % 10 <> 0 AND s.p_size % 4 <> 0
    LEFT JOIN nation pv ON pv.n_nationkey = b.l_suppkey % 30 AND pv.n_nationkey % 4 <> 0
    LEFT JOIN nation d ON d.n_nationkey = b.l_linenumber AND d.n_nationkey < 6
    LEFT JOIN region cur ON cur.r_regionkey = b.l_suppkey % 7
    LEFT JOIN ids i1 ON i1.sub = b.l_partkey AND i1.kind = 1
    LEFT JOIN ids i5 ON i5.sub = b.l_partkey AND i5.kind = 5
    WHERE a.c_custkey % 17 <> 0 AND 'I' || a.c_custkey IN (SELECT inv_ban FROM bans))
"""

ORACLE["invoice_lines"] = f"""
WITH bans AS (SELECT 'I' || c_custkey AS inv_ban FROM customer WHERE c_nationkey % 3 = 0), {_INVOICE_LINES}
SELECT * FROM lines
"""

ORACLE["package_status"] = f"""
WITH pkg AS (
    SELECT 'M' || o_orderkey AS piid_meid, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS component_grp_val, 'pk' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS scid, 'I' || o_custkey AS inv_ban,
           CASE o_orderstatus WHEN 'O' THEN 'In Progress' WHEN 'F' THEN 'Reversal' ELSE 'Complete' END AS workflowstatus, p_name AS pkg_dsc,
           CAST(p_size AS DOUBLE) AS monthly_rev_est, CAST(o_custkey % 50 + 1 AS DOUBLE) AS piid_current_rate, CAST(o_orderkey % 50 AS DOUBLE) AS piid_new_rate
    FROM orders JOIN part ON p_partkey = o_custkey WHERE o_orderpriority <> '5-LOW'),
first AS (
    SELECT *, workflowstatus = 'Reversal' AND monthly_rev_est <> piid_current_rate AND monthly_rev_est = piid_new_rate AS back FROM pkg),
bans AS (SELECT inv_ban FROM pkg WHERE workflowstatus = 'In Progress' AND monthly_rev_est <> piid_current_rate), {_INVOICE_LINES},
sums AS (SELECT package_id, sum(amount) AS amount FROM lines GROUP BY package_id)
SELECT piid_meid, component_grp_val, scid, inv_ban, workflowstatus, pkg_dsc, monthly_rev_est, piid_current_rate, piid_new_rate,
       CASE WHEN back THEN 0.0 ELSE monthly_rev_est - piid_current_rate END AS diff,
       CASE WHEN amount = piid_current_rate THEN 'Proceed with Rerate' WHEN amount <> monthly_rev_est AND amount <> piid_current_rate THEN 'Cancel for MRR Cost Change'
            WHEN back THEN 'Proceed with Reversal' WHEN workflowstatus = 'In Progress' AND monthly_rev_est = piid_current_rate THEN 'Proceed with Rerate' END AS pkg_status
FROM first LEFT JOIN sums ON sums.package_id = first.scid
"""

ORACLE["primary_terms"] = """
WITH met AS (
    SELECT DISTINCT 'I' || o.o_custkey AS product_inst_id, 'S' || c.l_partkey AS circuit_scid, 'P' || c.l_suppkey AS circuit_piid
    FROM lineitem w JOIN orders o ON o.o_orderkey = w.l_orderkey JOIN lineitem c ON c.l_partkey = w.l_partkey AND c.l_returnflag <> 'N'),
terms AS (
    SELECT m.*, CASE WHEN t.o_custkey % 5 <> 0 THEN t.o_orderdate END AS term_end_date
    FROM met m LEFT JOIN orders t ON 'P' || t.o_custkey = m.circuit_piid AND t.o_orderstatus <> 'P')
SELECT product_inst_id, circuit_scid, circuit_piid, term_end_date FROM terms
QUALIFY row_number() OVER (PARTITION BY product_inst_id ORDER BY term_end_date DESC NULLS LAST, circuit_scid DESC, circuit_piid DESC) = 1
"""

ORACLE["ledger_ingest"] = """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS o_code,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'quarantine' ELSE 'row' END AS kind
FROM orders
"""

ORACLE["bucketed_join"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

ORACLE["ci_pushdown"] = """
SELECT p_partkey, p_name, p_brand FROM part WHERE lower(p_brand) <> 'brand#11' AND lower(p_name) LIKE 'small%'
"""

ORACLE["snapshot_newest"] = """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS snapshot
FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders)
"""

_LABELS = ", ".join(f"('{x}')" for x in vars(Labels()).values())
ORACLE["rule_counts"] = f"""
WITH c AS ({ORACLE["classify_job"]}), labels(label) AS (VALUES {_LABELS})
SELECT label, (SELECT count(*) FROM c WHERE nonactionable_reason = label) AS n FROM labels
UNION ALL SELECT 'rows', count(*) FROM c
UNION ALL SELECT 'unlabelled', count(*) FROM c WHERE nonactionable_reason IS NULL
UNION ALL SELECT 'other', count(*) FROM c WHERE nonactionable_reason NOT IN (SELECT label FROM labels)
"""
