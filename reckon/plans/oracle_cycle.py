"""SQL twin of the registered cycle-preparation job (DuckDB dialect).

Written stage by stage from the job's documented semantics on the same
derived inputs; kept apart from ``oracle.py`` for its length."""

_MOVE_BACK = "Move back to complete - Reversal cannot be completed due to disconnect"

CYCLE_PREP_SQL = """
WITH
-- derived inputs -------------------------------------------------------------
hdr AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS piid_meid,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'PK-' || lpad(CAST(o_custkey AS VARCHAR), 8, '0')
              ELSE 'P' || CAST(o_custkey AS VARCHAR) END AS product_inst_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'red' ELSE 'Green' END AS redblue,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'In Term TDM Cost Increase Pass Thru'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'Offnet TDM Discontinuance'
              WHEN o_orderpriority = '2-HIGH' THEN 'Core Access' ELSE 'Core' END AS subprojname,
         CASE WHEN o_orderstatus = 'O' THEN 'In Progress'
              WHEN o_orderstatus = 'F' AND year(o_orderdate) = 1997 THEN 'Reversal'
              WHEN o_orderstatus = 'F' THEN 'Complete' ELSE 'canceled' END AS workflowstatus,
         month(o_orderdate) AS rerate_month_actual, year(o_orderdate) AS fiscalyear, 31 AS invoice_day,
         CASE WHEN o_custkey % 2 = 0 THEN 'WHOLESALE' ELSE 'RETAIL' END AS business_unit,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 36 MONTH AS TIMESTAMP) AS cust_contract_term_end_dt,
         o_totalprice / 10000 AS piid_current_rate, o_totalprice / 5000 AS piid_new_rate
  FROM orders),
lx AS (
  SELECT *, CASE WHEN l_linenumber = 7 THEN 'pk' WHEN l_linenumber % 3 = 0 THEN 'X-' ELSE 'CI' END AS cid,
         lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS grp, 'S' || CAST(l_suppkey AS VARCHAR) AS comp
  FROM lineitem),
det AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS rr_piid_meid, cid || grp AS serv_comp_id, cid AS component_id, grp AS component_grp_val_id,
         comp AS component, l_discount AS scp_current_rate, l_tax AS scp_increase, l_discount + l_tax AS scp_new_rate,
         CASE WHEN l_returnflag <> 'N' THEN 'SE' || CAST(l_linenumber AS VARCHAR) END AS service_element_id,
         CASE WHEN l_returnflag = 'A' THEN 'xpkg' END AS promo_code, 'PC' AS prod_cmpnt_cd,
         CASE WHEN l_returnflag = 'N' THEN 'N' WHEN l_returnflag = 'R' THEN 'Y' END AS pre_billed_ind,
         CASE WHEN l_suppkey % 10 = 0 THEN 'Other' ELSE 'Latis' END AS dw_source_system_cd,
         CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS reversal_date
  FROM lx),
billed AS (SELECT cid || grp AS primary_id, comp AS prcmp_desc, l_discount AS rate FROM lx WHERE l_linestatus = 'F'),
ap AS (SELECT cid AS component_group_cd, grp AS component_grp_val, comp AS prcmp_dsc, 'PC' || CAST(l_partkey % 7 AS VARCHAR) AS product_code,
              'PR' AS prcmp_code, max(l_tax) AS monthly_rev_est,
              CASE WHEN l_partkey % 11 = 0 THEN 'PKA' END AS pkg_acct_id, 'Pack' AS pkg_dsc
       FROM lx WHERE l_linestatus = 'O' GROUP BY cid, grp, comp, l_partkey),
qguide AS (SELECT DISTINCT 'PC' || CAST(p_partkey % 7 AS VARCHAR) || 'PR' AS unique_product_prcmp,
                  CASE WHEN p_partkey % 7 = 0 THEN 'Always > 1' WHEN p_partkey % 7 = 1 THEN 'Could be > 1 or = 1' ELSE 'Always = 1' END AS quantity_status
           FROM part),
brates AS (SELECT cid || grp AS primary_type_1, CASE WHEN l_linenumber <> 4 THEN l_discount + 0.01 END AS bill_rate,
                  CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS product_inactive_dt, l_shipdate AS product_active_dt
           FROM lx WHERE l_returnflag = 'R'),
lo AS (SELECT lx.*, h.product_inst_id AS o_piid FROM lx JOIN hdr h ON CAST(lx.l_orderkey AS VARCHAR) = h.piid_meid),
arates AS (SELECT o_piid AS common_ckt, l_discount AS rev, l_shipdate AS bill_eff_bgn_date FROM lo WHERE l_returnflag = 'A'),
ses AS (SELECT cid || grp AS service_id, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'Disconnect' ELSE 'Change' END AS service_action FROM lx),
tprim AS (SELECT cid || grp AS circuit_scid, CAST(CAST(l_shipdate AS DATE) + INTERVAL 12 MONTH AS TIMESTAMP) AS r4_termenddate
          FROM lx WHERE l_returnflag = 'R'),
tfall AS (SELECT cid || grp AS scid, o_piid AS piid, CAST(CAST(l_shipdate AS DATE) + INTERVAL 24 MONTH AS TIMESTAMP) AS service_end_date
          FROM lo WHERE l_returnflag = 'A'),
seid AS (SELECT cid || grp || comp AS seid_unique, 'SEX' || CAST(max(l_partkey) AS VARCHAR) AS service_element_id, 'PCX' AS prcmp_code
         FROM lx WHERE l_returnflag = 'R' GROUP BY cid, grp, comp),
-- base: rerates of June 1997 U reversals (rates swapped, reversal date forced) ----
j AS (SELECT d.*, h.* EXCLUDE (piid_meid) FROM det d JOIN hdr h ON d.rr_piid_meid = h.piid_meid
      WHERE lower(h.redblue) = 'green' AND NOT (h.subprojname ILIKE '%access%') AND d.scp_increase <> 0
        AND lower(d.dw_source_system_cd) IN ('sdp', 'orion', 'latis')),
base AS (
  SELECT serv_comp_id, product_inst_id, rr_piid_meid, component_id, component_grp_val_id, component, scp_current_rate, scp_new_rate,
         service_element_id, promo_code, prod_cmpnt_cd, pre_billed_ind, subprojname, business_unit, cust_contract_term_end_dt,
         workflowstatus, reversal_date, false AS is_reversal
  FROM j WHERE fiscalyear = 1997 AND rerate_month_actual = 6 AND lower(workflowstatus) <> 'canceled'
  UNION ALL
  SELECT serv_comp_id, product_inst_id, rr_piid_meid, component_id, component_grp_val_id, component, scp_new_rate, scp_current_rate,
         service_element_id, promo_code, prod_cmpnt_cd, pre_billed_ind, subprojname, business_unit, cust_contract_term_end_dt,
         workflowstatus, CASE WHEN reversal_date IS NOT NULL THEN TIMESTAMP '1997-06-30' END, true
  FROM j WHERE lower(workflowstatus) = 'reversal'),
b0 AS (SELECT *, component_id || component_grp_val_id || component AS "unique" FROM base),
-- 1 billed rate (largest per key) ---------------------------------------------
tstage AS (SELECT primary_id || prcmp_desc AS scid, max(rate) AS rate FROM billed
           WHERE primary_id IN (SELECT serv_comp_id FROM b0) GROUP BY 1),
s1 AS (SELECT b0.*, t.rate AS kenan FROM b0 LEFT JOIN tstage t ON b0."unique" = t.scid),
-- 2 active value, fallback on the group value propagated per component id ------
la AS (SELECT *, component_group_cd || component_grp_val || prcmp_dsc AS scid, product_code || prcmp_code AS quantity_unique
       FROM ap WHERE component_grp_val IN (SELECT component_grp_val_id FROM b0)),
la1 AS (SELECT scid, min(component_grp_val) AS v FROM la GROUP BY scid),
grp AS (SELECT DISTINCT component_grp_val FROM la),
s2a AS (SELECT s1.*, la1.v AS latis_active,
               CASE WHEN la1.v IS NULL THEN g.component_grp_val END AS fb
        FROM s1 LEFT JOIN la1 ON s1."unique" = la1.scid LEFT JOIN grp g ON s1.component_grp_val_id = g.component_grp_val),
fbk AS (SELECT serv_comp_id, min(fb) AS fbv FROM s2a WHERE fb IS NOT NULL AND fb <> '' GROUP BY 1),
s2 AS (SELECT s2a.* EXCLUDE (fb, latis_active),
              CASE WHEN s2a.latis_active IS NULL OR s2a.latis_active = '' THEN fbk.fbv ELSE s2a.latis_active END AS latis_active
       FROM s2a LEFT JOIN fbk ON s2a.serv_comp_id = fbk.serv_comp_id),
-- 3 split ids: estimated revenue fills the rate per unique ---------------------
est1 AS (SELECT scid, max(monthly_rev_est) AS est FROM la GROUP BY scid),
s3a AS (SELECT s2.*, CASE WHEN contains(s2.serv_comp_id, '-') THEN e.est END AS est FROM s2 LEFT JOIN est1 e ON s2."unique" = e.scid),
estk AS (SELECT "unique", min(est) AS ev FROM s3a WHERE est IS NOT NULL GROUP BY 1),
s3 AS (SELECT s3a.* EXCLUDE (est, kenan), CASE WHEN s3a.kenan IS NULL THEN estk.ev ELSE s3a.kenan END AS kenan
       FROM s3a LEFT JOIN estk ON s3a."unique" = estk."unique"),
-- 4 billing-star rate overwrites blank/mismatched rates; move back -------------
need AS (SELECT DISTINCT serv_comp_id FROM s3 WHERE latis_active IS NULL OR latis_active = ''),
kp AS (SELECT * FROM brates WHERE primary_type_1 IN (SELECT serv_comp_id FROM need)),
bill_one AS (SELECT primary_type_1, bill_rate FROM (
               SELECT *, row_number() OVER (PARTITION BY primary_type_1 ORDER BY product_inactive_dt ASC NULLS LAST,
                                            product_active_dt ASC NULLS LAST, bill_rate DESC) AS rn
               FROM kp WHERE bill_rate IS NOT NULL) WHERE rn = 1),
unrated4 AS (SELECT DISTINCT primary_type_1 FROM kp WHERE bill_rate IS NULL),
revs AS (SELECT DISTINCT serv_comp_id FROM s3 WHERE is_reversal),
s4a AS (SELECT s3.*, s3.serv_comp_id IN (SELECT serv_comp_id FROM revs) AS rev_scid, b.bill_rate AS k4, coalesce(s3.serv_comp_id IN (SELECT primary_type_1 FROM unrated4), false) AS unrated,
               (s3.kenan IS NULL OR s3.scp_current_rate IS DISTINCT FROM s3.kenan) AS mism
        FROM s3 LEFT JOIN bill_one b ON s3.serv_comp_id = b.primary_type_1),
h4 AS (SELECT serv_comp_id, min(k4) AS hv FROM s4a WHERE mism AND k4 IS NOT NULL GROUP BY 1),
mb4 AS (SELECT "unique", bool_or(mism AND (k4 IS NULL OR unrated) AND rev_scid) AS mb FROM s4a WHERE "unique" IS NOT NULL GROUP BY 1),
s4 AS (SELECT s4a.* EXCLUDE (kenan, k4, mism, unrated), coalesce(h4.hv, s4a.kenan) AS kenan,
              CASE WHEN coalesce(mb4.mb, false) THEN '""" + _MOVE_BACK + """' END AS status
       FROM s4a LEFT JOIN h4 ON s4a.serv_comp_id = h4.serv_comp_id LEFT JOIN mb4 ON s4a."unique" = mb4."unique"),
-- 5 account-star rate by instance id for split ids; move back fill ------------
split AS (SELECT DISTINCT product_inst_id FROM s4 WHERE contains(serv_comp_id, '-')),
acct AS (SELECT common_ckt, rev FROM (
           SELECT *, row_number() OVER (PARTITION BY common_ckt ORDER BY bill_eff_bgn_date DESC NULLS LAST, rev DESC) AS rn
           FROM arates WHERE rev IS NOT NULL AND common_ckt IN (SELECT product_inst_id FROM split)) WHERE rn = 1),
unrated5 AS (SELECT DISTINCT common_ckt FROM arates WHERE rev IS NULL AND common_ckt IN (SELECT product_inst_id FROM split)),
s5a AS (SELECT s4.*, a.rev AS k5, coalesce(s4.product_inst_id IN (SELECT common_ckt FROM unrated5), false) AS unrated, (s4.kenan IS NULL OR s4.scp_current_rate IS DISTINCT FROM s4.kenan) AS mism
        FROM s4 LEFT JOIN acct a ON s4.product_inst_id = a.common_ckt),
h5 AS (SELECT serv_comp_id, min(k5) AS hv FROM s5a WHERE mism AND k5 IS NOT NULL GROUP BY 1),
mb5 AS (SELECT "unique", bool_or(mism AND (k5 IS NULL OR unrated) AND rev_scid) AS mb FROM s5a WHERE "unique" IS NOT NULL GROUP BY 1),
s5 AS (SELECT s5a.* EXCLUDE (kenan, k5, mism, unrated, status, rev_scid), coalesce(h5.hv, s5a.kenan) AS kenan,
              CASE WHEN (s5a.status IS NULL OR s5a.status = '') AND coalesce(mb5.mb, false) THEN '""" + _MOVE_BACK + """'
                   ELSE s5a.status END AS status
       FROM s5a LEFT JOIN h5 ON s5a.serv_comp_id = h5.serv_comp_id LEFT JOIN mb5 ON s5a."unique" = mb5."unique"),
-- 6 difference, 7 disconnect, 8 cost change --------------------------------------
s6 AS (SELECT *, CASE WHEN scp_current_rate IS NULL OR kenan IS NULL THEN NULL
                      WHEN scp_current_rate - kenan < 0.01 THEN 0.0 ELSE scp_current_rate - kenan END AS difference FROM s5),
disc AS (SELECT service_id, bool_or(coalesce(service_action = 'Disconnect', false)) AS d FROM ses
         WHERE service_id IN (SELECT serv_comp_id FROM s6 WHERE kenan IS NULL) GROUP BY 1),
s8 AS (SELECT s6.* EXCLUDE (status),
              CASE WHEN (s6.status IS NULL OR s6.status = '') AND coalesce(disc.d, false) THEN 'Cancel - Disconnect'
                   WHEN (s6.status IS NULL OR s6.status = '') AND (s6.difference IS NULL OR s6.difference <> 0) THEN 'Cancel for MRR Cost Change'
                   ELSE s6.status END AS status
       FROM s6 LEFT JOIN disc ON s6.serv_comp_id = disc.service_id),
-- 9 quantity roll-up per group value --------------------------------------------
laq AS (SELECT la.*, q.qs AS qty FROM la LEFT JOIN (SELECT unique_product_prcmp, min(quantity_status) AS qs FROM qguide GROUP BY 1) q
        ON la.quantity_unique = q.unique_product_prcmp),
gq AS (SELECT component_grp_val,
              coalesce(CASE min(CASE qty WHEN 'Always > 1' THEN 1 WHEN 'Could be > 1 or = 1' THEN 2 WHEN 'Always = 1' THEN 3 END)
                       WHEN 1 THEN 'Always > 1' WHEN 2 THEN 'Could be > 1 or = 1' WHEN 3 THEN 'Always = 1' END, 'Always = 1') AS group_qty
       FROM laq WHERE component_grp_val IS NOT NULL GROUP BY 1),
sq AS (SELECT laq.scid, min(gq.group_qty) AS group_qty FROM laq JOIN gq ON laq.component_grp_val = gq.component_grp_val GROUP BY 1),
s9 AS (SELECT s8.*, CASE WHEN NOT coalesce(s8.component_id IN ('EQ', 'IQ', 'LL'), false) THEN sq.group_qty END AS qty
       FROM s8 LEFT JOIN sq ON s8."unique" = sq.scid),
-- 10 bad packages (own pull), 11 hidden packages ------------------------------
bad AS (SELECT DISTINCT d.serv_comp_id FROM det d JOIN hdr h ON d.rr_piid_meid = h.piid_meid
        WHERE d.serv_comp_id ILIKE 'pk%' AND NOT (h.product_inst_id ILIKE 'pk-%') AND lower(h.workflowstatus) = 'in progress'
          AND h.rerate_month_actual = 6 AND h.invoice_day = 31),
hid AS (SELECT DISTINCT component_grp_val FROM ap WHERE pkg_acct_id IS NOT NULL
          AND component_grp_val IN (SELECT component_grp_val_id FROM s9 WHERE NOT coalesce(contains(lower(product_inst_id), 'pk-'), false))),
s11 AS (SELECT s9.* EXCLUDE (status),
               CASE WHEN (s9.status IS NULL OR s9.status = '') AND s9.serv_comp_id IN (SELECT serv_comp_id FROM bad)
                      THEN 'Cancel - PIID Mapping Issue - PK SCID does not have proper PK PIID'
                    WHEN (s9.status IS NULL OR s9.status = '') AND s9.component_grp_val_id IN (SELECT component_grp_val FROM hid)
                      THEN 'Cancel - PIID Mapping Issue - service is an unidentified package'
                    ELSE s9.status END AS status
        FROM s9),
-- 12 package status ------------------------------------------------------------
s12a AS (SELECT *, CASE WHEN coalesce(contains(lower(product_inst_id), 'pk-'), false) THEN substring(product_inst_id, 4) END AS pkg_cgv FROM s11),
pkrows AS (SELECT * FROM s12a WHERE coalesce(contains(lower(product_inst_id), 'pk-'), false)),
psrc AS (SELECT a.component_grp_val, a.component_group_cd || a.component_grp_val AS scid, h.workflowstatus, a.pkg_dsc,
                a.monthly_rev_est, h.piid_current_rate, a.monthly_rev_est - h.piid_current_rate AS diff, h.piid_new_rate
         FROM (SELECT * FROM ap WHERE component_grp_val IN (SELECT pkg_cgv FROM pkrows WHERE pkg_cgv IS NOT NULL)) a
         JOIN (SELECT * FROM hdr WHERE piid_meid IN (SELECT rr_piid_meid FROM pkrows)) h ON a.component_grp_val = right(h.product_inst_id, 8)),
pst AS (SELECT component_grp_val, pkg_dsc,
               CASE WHEN diff <> 0 AND workflowstatus = 'Reversal' AND monthly_rev_est = piid_new_rate THEN 'Proceed with Reversal'
                    WHEN diff = 0 AND workflowstatus = 'In Progress' THEN 'Proceed with Rerate' END AS pkg_status
        FROM psrc),
pone AS (SELECT component_grp_val, pkg_dsc, pkg_status FROM (
           SELECT *, row_number() OVER (PARTITION BY component_grp_val ORDER BY CASE WHEN pkg_status LIKE 'Cancel%' THEN 1 WHEN pkg_status = 'Proceed with Reversal' THEN 2
                                             WHEN pkg_status = 'Proceed with Rerate' THEN 3 ELSE 4 END, pkg_dsc DESC NULLS LAST) AS rn
           FROM pst WHERE component_grp_val IS NOT NULL) WHERE rn = 1),
s12 AS (SELECT s12a.* EXCLUDE (status), p.pkg_dsc AS pkg_description, p.pkg_status, coalesce(s12a.status, p.pkg_status) AS status
        FROM s12a LEFT JOIN pone p ON s12a.pkg_cgv = p.component_grp_val),
-- 13 term end: primary latest per instance, else fallback -----------------------
r4 AS (SELECT r.product_inst_id AS ma_piid, t.r4_termenddate FROM tprim t LEFT JOIN s12 r ON t.circuit_scid = r.serv_comp_id),
r4ted AS (SELECT ma_piid, max(r4_termenddate) AS r4_termenddate FROM r4 WHERE ma_piid IS NOT NULL GROUP BY 1),
ctd AS (SELECT r.product_inst_id AS ma_piid, max(t.service_end_date) AS sed FROM tfall t JOIN s12 r ON t.scid = r.serv_comp_id
        WHERE t.piid IN (SELECT product_inst_id FROM s12) AND r.product_inst_id IS NOT NULL GROUP BY 1),
s13 AS (SELECT s12.*, coalesce(r.r4_termenddate, c.sed) AS r4_term_end_date
        FROM s12 LEFT JOIN r4ted r ON s12.product_inst_id = r.ma_piid LEFT JOIN ctd c ON s12.product_inst_id = c.ma_piid),
-- 14 in-term exception: every row of the unique key -------------------------------
interm AS (SELECT DISTINCT "unique" FROM s13
           WHERE coalesce(r4_term_end_date > TIMESTAMP '1997-06-30', false)
             AND NOT coalesce(subprojname = 'In Term TDM Cost Increase Pass Thru', false)
             AND NOT coalesce(subprojname = 'Offnet TDM Discontinuance' AND business_unit = 'WHOLESALE'
                              AND cust_contract_term_end_dt >= r4_term_end_date, false)),
s14 AS (SELECT s13.* EXCLUDE (status),
               CASE WHEN "unique" IN (SELECT "unique" FROM interm) THEN 'Cancel - Circuit in term' ELSE status END AS status
        FROM s13),
-- 15 service element and component code (replace) ------------------------------
sone AS (SELECT seid_unique, service_element_id, prcmp_code FROM (
           SELECT *, row_number() OVER (PARTITION BY seid_unique ORDER BY service_element_id ASC NULLS LAST) AS rn
           FROM seid WHERE seid_unique IN (SELECT cid || grp || comp FROM lx WHERE grp IN (
                 SELECT component_grp_val_id FROM s14 WHERE service_element_id IS NULL OR service_element_id = '')))
         WHERE rn = 1),
s15 AS (SELECT s14.* EXCLUDE (service_element_id, prod_cmpnt_cd), so.service_element_id, so.prcmp_code AS prod_cmpnt_cd
        FROM s14 LEFT JOIN sone so ON s14."unique" = so.seid_unique),
-- 16 pre-billed flag repair ------------------------------------------------------
s16 AS (SELECT s15.* EXCLUDE (pre_billed_ind),
               CASE WHEN pre_billed_ind IS NULL OR pre_billed_ind = '' OR pre_billed_ind = 'N'
                    THEN CASE WHEN coalesce(contains(lower(promo_code), 'pkg'), false) THEN 'N' ELSE 'Y' END
                    ELSE pre_billed_ind END AS pre_billed_ind
        FROM s15),
-- 17 instance-level status ---------------------------------------------------------
pl AS (SELECT product_inst_id,
              CASE min(CASE status WHEN 'Cancel - Disconnect' THEN 1 WHEN '""" + _MOVE_BACK + """' THEN 2
                                   WHEN 'Cancel for MRR Cost Change' THEN 3 END)
                   WHEN 1 THEN 'Cancel - Disconnect' WHEN 2 THEN '""" + _MOVE_BACK + """' WHEN 3 THEN 'Cancel for MRR Cost Change' END
                AS piid_level_status
       FROM s16 WHERE product_inst_id IS NOT NULL GROUP BY 1)
SELECT s16.serv_comp_id, s16.product_inst_id, s16."unique", s16.is_reversal, s16.scp_current_rate, s16.scp_new_rate, s16.kenan,
       s16.latis_active, s16.difference, s16.status, s16.qty, s16.r4_term_end_date, s16.pkg_cgv, s16.pkg_status, s16.pkg_description,
       s16.service_element_id, s16.prod_cmpnt_cd, s16.pre_billed_ind, pl.piid_level_status, s16.reversal_date
FROM s16 LEFT JOIN pl ON s16.product_inst_id = pl.product_inst_id
"""


def _with(sql: str, **ctes: str) -> str:
    """The statement with the bodies of the named CTEs replaced."""
    for name, body in ctes.items():
        head, rest = sql.split(f"\n{name} AS (", 1)
        depth, at = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[at], 0)
            at += 1
        sql = f"{head}\n{name} AS ({body}){rest[at:]}"
    return sql


# The same job with its pulls made from their relations: only what the pulls give differs.
CYCLE_PULLS_SQL = _with(
    CYCLE_PREP_SQL,
    brates="""SELECT r.cid || r.grp AS primary_type_1, CAST(round((v.l_discount + 0.01) * 100) AS BIGINT) / 100 AS bill_rate,
                  CASE WHEN r.l_linestatus <> 'O' THEN r.l_shipdate END AS product_inactive_dt, r.l_shipdate AS product_active_dt
           FROM lx r LEFT JOIN lx v ON v.l_orderkey = r.l_orderkey AND v.l_linenumber = r.l_linenumber AND v.l_returnflag = 'R' AND v.l_linenumber <> 4 WHERE r.l_returnflag = 'R'""",
    arates="""SELECT g.o_piid AS common_ckt, c.l_discount AS rev, c.l_shipdate AS bill_eff_bgn_date
           FROM lo g LEFT JOIN lx c ON c.l_orderkey = g.l_orderkey AND c.l_linenumber = g.l_linenumber AND c.l_returnflag <> 'N' WHERE c.l_orderkey IS NULL OR c.l_quantity <= 45""",
    tprim="""SELECT cid || grp AS circuit_scid, CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS TIMESTAMP) AS r4_termenddate
          FROM lx JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""",
    seid="""SELECT DISTINCT g.cid || g.grp || c.comp AS seid_unique, CASE WHEN g.l_partkey % 2 = 0 THEN 'SEX' || g.l_partkey END AS service_element_id, CAST(c.l_suppkey AS VARCHAR) AS prcmp_code
         FROM lo g JOIN lx c ON c.l_orderkey = g.l_orderkey AND c.l_linenumber = g.l_linenumber AND c.l_returnflag <> 'N' AND c.l_quantity <= 45""",
    psrc="""SELECT a.component_grp_val, a.component_group_cd || a.component_grp_val AS scid, h.workflowstatus, a.pkg_dsc, 'I' || CAST(right(h.product_inst_id, 8) AS BIGINT) AS inv_ban,
                a.monthly_rev_est, h.piid_current_rate, a.monthly_rev_est - h.piid_current_rate AS diff, h.piid_new_rate
         FROM (SELECT * FROM ap WHERE component_grp_val IN (SELECT pkg_cgv FROM pkrows WHERE pkg_cgv IS NOT NULL)) a
         JOIN (SELECT * FROM hdr WHERE piid_meid IN (SELECT rr_piid_meid FROM pkrows)) h ON a.component_grp_val = right(h.product_inst_id, 8)""",
    sone="""SELECT seid_unique, service_element_id, prcmp_code FROM (
           SELECT *, row_number() OVER (PARTITION BY seid_unique ORDER BY service_element_id ASC NULLS LAST, prcmp_code ASC NULLS LAST) AS rn
           FROM seid WHERE seid_unique IN (SELECT cid || grp || comp FROM lx
                 WHERE grp IN (SELECT component_grp_val_id FROM s14 WHERE service_element_id IS NULL OR service_element_id = '')
                   AND comp IN (SELECT component FROM s14 WHERE service_element_id IS NULL OR service_element_id = '')))
         WHERE rn = 1""",
    pst="""SELECT component_grp_val, pkg_dsc,
               CASE WHEN amount = CAST(piid_current_rate AS DECIMAL(18,2)) THEN 'Proceed with Rerate'
                    WHEN amount <> CAST(piid_current_rate AS DECIMAL(18,2)) AND amount <> CAST(monthly_rev_est AS DECIMAL(18,2)) THEN 'Cancel for MRR Cost Change'
                    WHEN diff <> 0 AND workflowstatus = 'Reversal' AND monthly_rev_est = piid_new_rate THEN 'Proceed with Reversal'
                    WHEN diff = 0 AND workflowstatus = 'In Progress' THEN 'Proceed with Rerate' END AS pkg_status
        FROM psrc LEFT JOIN (
            SELECT 'CI' || b.grp AS package_id, sum(CAST(b.l_partkey % 50 + 1 AS DECIMAL(18,2))) AS amount
            FROM orders i JOIN lx b ON b.l_orderkey = i.o_orderkey
            WHERE i.o_orderstatus = 'O' AND i.o_orderdate >= TIMESTAMP '1997-04-26' AND b.l_suppkey % 20 NOT IN (0, 1) AND b.l_linenumber >= 2 AND b.l_linenumber % 6 <> 5
              AND b.l_partkey IN (SELECT l_partkey FROM lx WHERE cid = 'CI')
              AND 'I' || i.o_custkey IN (SELECT inv_ban FROM psrc WHERE workflowstatus = 'In Progress' AND diff <> 0)
            GROUP BY 1) ON package_id = scid""",
)
