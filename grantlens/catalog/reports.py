"""Report pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import reports, stages
from .aggregates import (average_sql, ratio_sql, ADHOC, ADHOC_COLUMNS, BY_PANEL, DEMOG, LATEST_ROWS, MARKS, PANEL_ROWS, PROJ_PANEL, RANK_SCORE, SELECTED,
                         SUMMARY, TIMED, YEARS, stats_sql)
from .registry import LIST_CHECKS, LISTS, query
from .strings import ASSESSED, CONFLICT_PEOPLE, CONFLICT_TEXT, OUTCOMES, PLACED
from .windows import CODES, LATEST, MATCH, NAMED, PATTERNS, PEOPLE, _slot_sql, patterns

RA = """ra AS (SELECT x.prop_id AS lead, max(x.last_updt_tmsp) AS "RAupdate" FROM (SELECT prop_id, last_updt_tmsp FROM v_ra UNION ALL SELECT prop_id, last_updt_tmsp FROM v_upld WHERE upload_type_code = '034') x
  JOIN v_prj p ON p.prop_id = x.prop_id AND p."ILN" < 'M' GROUP BY x.prop_id)"""
PRIMARY = "v_pi pi ON pi.pi_id = p.pi_id AND pi.prim_addr_flag = 'Y'"
DIV = """JOIN v_org o ON o.org_code = p.org_code"""
BASE_FROM = f"""v_prj p {DIV} JOIN v_org o2 ON o2.org_code = left(p.org_code, 2) || '000000' JOIN v_inst i ON i.inst_id = p.inst_id JOIN {PRIMARY}"""
BASE = f"""bs AS (SELECT p.received_date, nullif(p.dd_rcom_date, TIMESTAMP '1900-01-01') AS dd_rcom_date, o2.dir_div_abbr AS "Dir", p.org_code, p.org_code || ' - ' || o.dir_div_abbr AS "OrgLabel", p.pgm_ele_code,
  CASE WHEN p.pgm_ele_code <> p.orig_pgm_ele_code THEN p.orig_pgm_ele_code END AS "origPEC", p.pgm_annc_id, CASE WHEN p.org_code <> p.orig_org_code THEN p.orig_org_code END AS "origORG", p.pgm_ele_code || ' - ' || g.pgm_ele_name AS "Pgm", p.pm_ibm_logn_id AS "PO", p.obj_clas_code, nr.natr_rqst_abbr, ps.prop_stts_abbr, ps.prop_stts_txt,
  p.rqst_eff_date, p.rqst_mnth_cnt, p.cntx_stmt_id, p.natr_rqst_code, p.prop_stts_code, p."ILN", p.lead, o.dir_div_abbr AS "Div", p.prop_id, pi.pi_last_name, pi.pi_frst_name,
  i.inst_shrt_name AS inst_name, i.st_code, pi.pi_emai_addr, p.prop_titl_txt, p.rqst_dol, p.inst_id, p.pi_id FROM {BASE_FROM} JOIN v_pgm g ON g.pgm_ele_code = p.pgm_ele_code JOIN v_stts ps ON ps.prop_stts_code = p.prop_stts_code JOIN v_rqst nr ON nr.natr_rqst_code = p.natr_rqst_code)"""
APPROVALS = """ap AS (SELECT s.prop_id, CASE WHEN c.hum_date IS NOT NULL THEN strftime(c.hum_date, '%m/%d/%y') WHEN c.humn_date_pend_flag = 'Y' THEN 'Pend' END AS humn_date,
  CASE WHEN c.vert_date IS NOT NULL THEN strftime(c.vert_date, '%m/%d/%y') WHEN c.vrtb_date_pend_flag = 'Y' THEN 'Pend' END AS vrtb_date FROM v_subm s JOIN v_covr c ON c.temp_prop_id = s.temp_prop_id)"""
COUNTRY = """cy AS (SELECT prop_id, string_agg(ctry_name, '; ' ORDER BY n) AS "Country" FROM (SELECT b.prop_id, c.ctry_name, row_number() OVER (PARTITION BY b.prop_id ORDER BY c.ctry_name) AS n
  FROM v_subm b JOIN v_item i ON i.temp_prop_id = b.temp_prop_id JOIN v_ctry c ON c.ctry_code = i.spcl_item_code WHERE i.end_date IS NULL) WHERE n <= 8 GROUP BY prop_id)"""


ALL_COUNTRIES = """cy AS (SELECT b.prop_id, string_agg(c.ctry_name, '; ' ORDER BY c.ctry_name) AS "Country" FROM v_subm b JOIN v_item i ON i.temp_prop_id = b.temp_prop_id
  JOIN v_ctry c ON c.ctry_code = i.spcl_item_code WHERE i.end_date IS NULL GROUP BY b.prop_id)"""


def _codes(name: str, sep: str, cap: int, padded: bool = False) -> str:
    rows = "(SELECT prop_id, prop_atr_code, row_number() OVER (PARTITION BY prop_id ORDER BY prop_atr_code) AS n FROM v_atr)"
    if padded:
        text = f" || '{sep}' || ".join(f"max(CASE n WHEN {i + 1} THEN prop_atr_code ELSE '' END)" for i in range(cap))
    else:
        text = f"string_agg(prop_atr_code, '{sep}' ORDER BY n) FILTER (n <= {cap})"
    return f"{name} AS (SELECT prop_id, {text} AS codes FROM {rows} GROUP BY prop_id)"


SPLIT_CODES = """sc AS (SELECT prop_id, splt_id, budg_yr, string_agg(pgm_ref_code, ' ' ORDER BY n) AS codes FROM (SELECT *, row_number() OVER (PARTITION BY prop_id, splt_id, budg_yr ORDER BY pgm_ref_code) AS n FROM v_splt_code)
  WHERE n <= 11 GROUP BY prop_id, splt_id, budg_yr)"""
FACTS = """rf AS (SELECT v.revr_id, v.revr_last_name, v.revr_frst_name, v.inst_id, i.inst_shrt_name, i.st_code, m.revr_addr_txt AS revr_email FROM v_revr v LEFT JOIN v_inst i ON i.inst_id = v.inst_id
  LEFT JOIN v_revr_mail m ON m.revr_id = v.revr_id AND m.addr_lne_type_code = 'E')"""
PRESENT = """dp AS (SELECT s.prop_id, s.temp_prop_id, coalesce((SELECT CAST(pdf_page_cnt AS STRING) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'proj_desc' AND pdf_page_cnt > 0), 'No PD') AS pd,
  CASE WHEN NOT EXISTS (SELECT 1 FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'bibl' AND (coalesce(trim(path_name), '') <> '' OR text_len > 0)) THEN 'No RC'
    ELSE (SELECT CAST(pdf_page_cnt AS STRING) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'bibl') END AS rc,
  CASE WHEN NOT EXISTS (SELECT 1 FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'dmp_plan' AND trim(path_name) <> '') THEN 'No DMP'
    ELSE (SELECT CAST(pdf_page_cnt AS STRING) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'dmp_plan') END AS dmp,
  EXISTS (SELECT 1 FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'ment_plan' AND trim(path_name) <> '') AS mp,
  (SELECT CAST(pdf_page_cnt AS STRING) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'ment_plan') AS mp_pg,
  (SELECT CAST(sum(pdf_page_cnt) AS BIGINT) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'budg_expl') AS bj,
  (SELECT nullif(count(*), 0) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'supp') AS sup FROM v_subm s)"""


@query("rpt_last_update", f"WITH {RA} SELECT * FROM ra")
def rpt_last_update(e):
    return reports.last_update(e)


@query("rpt_glossary_program", "SELECT DISTINCT o.org_code AS code, o.dir_div_abbr AS description FROM v_org o JOIN v_prop p ON p.org_code = o.org_code")
def rpt_glossary_program(e):
    return reports.glossary(e.prop, "org_code", e.org.select("org_code", "dir_div_abbr"))


@query("rpt_glossary_codes", """
SELECT 'lookup' AS kind, prop_atr_code AS code, ctry_name AS description FROM v_atr JOIN v_ctry ON ctry_code = prop_atr_code GROUP BY prop_atr_code, ctry_name
UNION ALL SELECT 'none', prop_atr_code, 'lookup table missing' FROM v_atr GROUP BY prop_atr_code""")
def rpt_glossary_codes(e):
    """With the lookup, and what is shown where it is not installed."""
    known = reports.glossary(e.atr, "prop_atr_code", e.ctry).withColumn("kind", F.lit("lookup"))
    return known.unionByName(reports.glossary(e.atr, "prop_atr_code", None).withColumn("kind", F.lit("none")))


_PANEL_SLOTS = {"rec": "rcom_abbr", "panl_id": "panl_id", "rank": "rk", "panl_name": "panl_name", "panl_end": "panl_end_date", "revs": '"V"',
                "PanlString": "outcome", "pnlst": "pnl", "confl": '"C"', "conflrev": '"CR"'}


@query("rpt_project_wide", f"""
WITH {ASSESSED}, {BY_PANEL}, {SUMMARY}, {CONFLICT_PEOPLE}, {PROJ_PANEL}, {MARKS}, {OUTCOMES}, {LATEST}, {CODES}, {RA},
pv AS (SELECT pj.*, v.panl_name, v.panl_end_date, ot.outcome, (SELECT count(DISTINCT revr_id) FROM v_panl_revr x WHERE x.panl_id = pj.panl_id) AS pnl,
  row_number() OVER (PARTITION BY pj.lead ORDER BY v.panl_end_date, pj.panl_id) AS slot FROM pj JOIN v_panl v ON v.panl_id = pj.panl_id JOIN ot ON ot.panl_id = pj.panl_id),
sp AS (SELECT lead, {_slot_sql(_PANEL_SLOTS, 3).replace('CASE n WHEN', 'CASE slot WHEN')} FROM pv GROUP BY lead),
pp AS (SELECT p.lead, p.prop_id, pi.pi_last_name, pi.pi_frst_name, pi.pi_emai_addr, i.inst_shrt_name, p.rqst_dol, round(lb.t, 2) AS t, lb.revn_num, cd."R" AS r,
  row_number() OVER (PARTITION BY p.lead ORDER BY p."ILN", p.prop_id) AS n FROM v_prj p LEFT JOIN {PRIMARY} LEFT JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN lb ON lb.prop_id = p.prop_id LEFT JOIN cd ON cd.prop_id = p.prop_id),
ss AS (SELECT lead, {_slot_sql(dict(stages.PROP_FIELDS, btot='t', PRC='r'), 7)} FROM pp GROUP BY lead),
tt AS (SELECT lead, CAST(CAST(sum(CAST(rqst_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS rqst_tot, CAST(CAST(sum(CAST(t AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS budg_tot, max(revn_num) AS "budRevnMax", substr(string_agg(CASE WHEN n <= 7 THEN pi_emai_addr END, ';' ORDER BY n), 1, 255) AS "allPIemail" FROM pp GROUP BY lead)
SELECT p.pgm_annc_id, p.pm_ibm_logn_id AS "PO", p.obj_clas_code, p.cntx_stmt_id, p.pgm_ele_code || ' - ' || g.pgm_ele_name AS "Pgm", ps.prop_stts_abbr, nr.natr_rqst_abbr,
  CASE WHEN p.org_code <> p.orig_org_code THEN p.orig_org_code END AS "origORG", CASE WHEN p.pgm_ele_code <> p.orig_pgm_ele_code THEN p.orig_pgm_ele_code END AS "origPEC", p.rqst_eff_date, p.rqst_mnth_cnt, p.lead, p.received_date, nullif(p.dd_rcom_date, TIMESTAMP '1900-01-01') AS dd_rcom_date, p.org_code, p.pgm_ele_code, p.natr_rqst_code, p.prop_stts_code, rtrim(p.prop_titl_txt) AS prop_titl_txt,
  o.dir_div_abbr AS "Div", o2.dir_div_abbr AS "Dir", pi.pi_emai_addr AS email, ra."RAupdate", sm.* EXCLUDE (lead), mk."Nunrlsbl", ah."N" AS "AhNrev", ah."V" AS "AhRevs", ah.last_rev_date AS "AhLast",
  sp.* EXCLUDE (lead), pl."nPanl", ss.* EXCLUDE (lead), tt.* EXCLUDE (lead), {RANK_SCORE} AS "RecRkMin"
FROM v_prj p {DIV} JOIN v_pgm g ON g.pgm_ele_code = p.pgm_ele_code JOIN v_stts ps ON ps.prop_stts_code = p.prop_stts_code JOIN v_rqst nr ON nr.natr_rqst_code = p.natr_rqst_code LEFT JOIN v_org o2 ON o2.org_code = left(p.org_code, 2) || '000000' LEFT JOIN {PRIMARY} LEFT JOIN ra ON ra.lead = p.lead LEFT JOIN sm ON sm.lead = p.lead LEFT JOIN mk ON mk.lead = p.lead
LEFT JOIN bp ah ON ah.lead = p.lead AND ah.panl_id = '.ad hoc' LEFT JOIN sp ON sp.lead = p.lead LEFT JOIN pl ON pl.lead = p.lead LEFT JOIN ss ON ss.lead = p.lead LEFT JOIN tt ON tt.lead = p.lead WHERE p."ILN" < 'M'""")
def rpt_project_wide(e):
    return reports.project_wide(e)


@query("rpt_coding_check", f"""
WITH {ASSESSED}, {BY_PANEL}, {SUMMARY}, {CONFLICT_PEOPLE}, {PROJ_PANEL}, {MARKS}, {CODES}, {RA}, {DEMOG}
SELECT p.pgm_annc_id, p.pm_ibm_logn_id AS "PO", p.obj_clas_code, p.cntx_stmt_id, p.pgm_ele_code || ' - ' || g.pgm_ele_name AS "Pgm", ps.prop_stts_abbr, nr.natr_rqst_abbr,
  CASE WHEN p.org_code <> p.orig_org_code THEN p.orig_org_code END AS "origORG", CASE WHEN p.pgm_ele_code <> p.orig_pgm_ele_code THEN p.orig_pgm_ele_code END AS "origPEC", p.apld_rsch_pct, p.educ_trng_pct, p.mjr_equp_pct, p.land_buld_fix_equp_pct, p.non_invt_pct,
  nullif(p.dd_rcom_date, TIMESTAMP '1900-01-01') AS dd_rcom_date, p.received_date, p.org_code, p.pgm_ele_code, p.prop_stts_code, p.natr_rqst_code, p.bas_rsch_pct, p.other_pct, cd."R" AS "propPRCs", i.st_code,
  ra."RAupdate", p.lead, p."ILN", o.dir_div_abbr AS "Div", p.prop_id, pi.pi_last_name, pi.pi_frst_name, i.inst_shrt_name AS inst, pl."nPanl", pl."nPSunmrkd", pl."nPSunrls", round(pl.best, 6) AS "RecRkMin", sm."Nrev", sm."allReviews",
  sm.avg_score, sm.last_rev_date, sm."Nunmkd", mk."Nconfl", mk."Nunrlsbl", mk."n_released_unfinished", mk."NpendSlct", mk."n_systems_differ", p.prop_titl_txt, p.rqst_dol AS rqst_tot, dm."NfmlPIs", dm."NhispPIs", dm."NhndcpPIs", dm."NnonWhtAsnPIs",
  pi.pi_emai_addr AS email
FROM v_prj p {DIV} JOIN v_pgm g ON g.pgm_ele_code = p.pgm_ele_code JOIN v_stts ps ON ps.prop_stts_code = p.prop_stts_code JOIN v_rqst nr ON nr.natr_rqst_code = p.natr_rqst_code LEFT JOIN {PRIMARY} LEFT JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN cd ON cd.prop_id = p.prop_id LEFT JOIN ra ON ra.lead = p.lead LEFT JOIN dm ON dm.prop_id = p.prop_id
LEFT JOIN sm ON sm.lead = p.prop_id LEFT JOIN mk ON mk.lead = p.prop_id LEFT JOIN pl ON pl.lead = p.prop_id""")
def rpt_coding_check(e):
    return reports.coding_check(e)


_LEAD_DIF = ", ".join(f"CASE WHEN p.\"ILN\" = 'N' AND p.{x} <> first_value(p.{x}) OVER (PARTITION BY p.lead ORDER BY p.\"ILN\", p.prop_id) THEN 1 ELSE 0 END AS \"dif_{x}\"" for x in stages.COMPARED)


@query("rpt_coding_flags", f"""
WITH {ASSESSED}, {SUMMARY}, {DEMOG}, held AS (SELECT prop_id, list(rtrim(prop_atr_code)) AS codes FROM v_atr WHERE prop_atr_type_code = 'PRC' GROUP BY prop_id)
SELECT p.lead, p."ILN", p.prop_id, CASE WHEN p.bas_rsch_pct + p.other_pct <> 1 THEN 1 ELSE 0 END AS bad_pct,
  CASE WHEN (i.st_code IN ('S1', 'S2')) <> coalesce(list_contains(held.codes, '0015'), false) THEN 1 ELSE 0 END AS bad_state,
  CASE WHEN (dm."NfmlPIs" + dm."NhispPIs" + dm."NhndcpPIs" + dm."NnonWhtAsnPIs" > 0) <> coalesce(list_contains(held.codes, '0012'), false) THEN 1 ELSE 0 END AS bad_people,
  CASE WHEN p."ILN" < 'M' AND coalesce(sm."Nrev", 0) < 3 THEN 1 ELSE 0 END AS few_reviews, {_LEAD_DIF}
FROM v_prj p LEFT JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN held ON held.prop_id = p.prop_id LEFT JOIN dm ON dm.prop_id = p.prop_id LEFT JOIN sm ON sm.lead = p.prop_id""")
def rpt_coding_flags(e):
    return reports.coding_flags(e)


_SPLITS = f"""{CODES}, {SPLIT_CODES}, sl AS (SELECT p.received_date, nullif(p.dd_rcom_date, TIMESTAMP '1900-01-01') AS dd_rcom_date, p.cntx_stmt_id, p.pgm_annc_id, ps.prop_stts_abbr, nr.natr_rqst_abbr, p.lead, p."ILN", o.dir_div_abbr AS "Div", p.prop_id,
  pi.pi_last_name, i.inst_shrt_name AS inst, p.org_code AS "pOrg", s.org_code AS "bOrg", p.pgm_ele_code AS "pPEC", s.pgm_ele_code AS "bPEC", p.pm_ibm_logn_id AS "pPO", s.pm_ibm_logn_id AS "bPO", p.obj_clas_code AS "pObj", s.obj_clas_code AS "bObj",
  s.awd_id, cd."R" AS "propPRCs", sc.codes AS "bPRCs", s.budg_yr, s.splt_id, round(s.budg_splt_tot_dol, 2) AS budg_splt_tot_dol, p.prop_titl_txt FROM v_prj p {DIV} JOIN v_stts ps ON ps.prop_stts_code = p.prop_stts_code JOIN v_rqst nr ON nr.natr_rqst_code = p.natr_rqst_code JOIN v_splt s ON s.prop_id = p.prop_id LEFT JOIN {PRIMARY} LEFT JOIN v_inst i ON i.inst_id = p.inst_id
  LEFT JOIN cd ON cd.prop_id = p.prop_id LEFT JOIN sc ON sc.prop_id = s.prop_id AND sc.budg_yr = s.budg_yr AND sc.splt_id = s.splt_id)"""


@query("rpt_splits", f"WITH {_SPLITS} SELECT * FROM sl")
def rpt_splits(e):
    return reports.split_rows(e)


@query("rpt_split_flags", f"""WITH {_SPLITS}, pset AS (SELECT prop_id, list_sort(list(DISTINCT rtrim(prop_atr_code))) AS codes FROM v_atr WHERE prop_atr_type_code = 'PRC' GROUP BY prop_id),
bset AS (SELECT prop_id, budg_yr, splt_id, list_sort(list(DISTINCT rtrim(pgm_ref_code))) AS codes FROM v_splt_code GROUP BY ALL)
SELECT sl.prop_id, sl.budg_yr, sl.splt_id, """ + ", ".join(f'CASE WHEN "p{n}" <> "b{n}" THEN 1 ELSE 0 END AS "dif_{n}"' for n in ("Org", "PEC", "PO", "Obj")) + """, (pset.codes IS DISTINCT FROM bset.codes)::INT AS "dif_PRCs",
CASE WHEN row_number() OVER (PARTITION BY sl.prop_id ORDER BY sl.budg_yr, sl.splt_id) = 1 THEN 1 ELSE 0 END AS new_group
FROM sl LEFT JOIN pset USING (prop_id) LEFT JOIN bset ON bset.prop_id = sl.prop_id AND bset.budg_yr = sl.budg_yr AND bset.splt_id = sl.splt_id""")
def rpt_split_flags(e):
    return reports.split_flags(e)


@query("rpt_award_check", f"""
WITH {LATEST}, {LATEST_ROWS}, {RA}, {APPROVALS}, {COUNTRY}, yr AS (SELECT q.prop_id, {YEARS} FROM (SELECT DISTINCT prop_id FROM v_budg) q)
SELECT nullif(p.dd_rcom_date, TIMESTAMP '1900-01-01') AS dd_rcom_date, p.received_date, p.org_code, p.pgm_ele_code, p.prop_stts_code, p.natr_rqst_code, ra."RAupdate", p.lead, p."ILN", o.dir_div_abbr AS "Div", p.prop_id, pi.pi_last_name,
  i.inst_shrt_name AS inst, i.st_code, ap.humn_date, ap.vrtb_date, cy."Country", nullif(lb.frgn, 0) AS frgn_trav_tot, p.prop_titl_txt, lb.revn_num AS brevn, p.rqst_dol AS rqst_tot, round(lb.t, 2) AS budg_tot, yr.* EXCLUDE (prop_id),
  nullif(lb.sub_ctr, 0) AS sub_ctr_tot, nullif(lb.part, 0) AS part_tot_cnt, pi.pi_emai_addr AS email
FROM v_prj p {DIV} LEFT JOIN {PRIMARY} LEFT JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN ra ON ra.lead = p.lead LEFT JOIN ap ON ap.prop_id = p.prop_id LEFT JOIN cy ON cy.prop_id = p.prop_id LEFT JOIN lb ON lb.prop_id = p.prop_id
LEFT JOIN yr ON yr.prop_id = p.prop_id""")
def rpt_award_check(e):
    return reports.award_check(e)


@query("rpt_award_flags", f"""
WITH {LATEST}, {ALL_COUNTRIES}, q AS (SELECT p.*, round(lb.t, 2) AS t, lb.part_d, lb.part, coalesce(cy."Country", '') AS "Country" FROM v_prj p LEFT JOIN lb ON lb.prop_id = p.prop_id LEFT JOIN cy ON cy.prop_id = p.prop_id)
SELECT p.lead, p."ILN", p.prop_id, CASE WHEN p.rqst_dol < p.t THEN 1 ELSE 0 END AS below_budget, CASE WHEN p.rqst_dol > p.t THEN 1 ELSE 0 END AS above_budget,
  CASE WHEN (coalesce(p.part_d, 0) > 0) <> (coalesce(p.part, 0) > 0) THEN 1 ELSE 0 END AS part_mismatch,
  """ + ", ".join(f"CASE WHEN p.\"ILN\" = 'N' AND p.\"{x}\" <> first_value(p.\"{x}\") OVER (PARTITION BY p.lead ORDER BY p.\"ILN\", p.prop_id) THEN 1 ELSE 0 END AS \"dif_{x}\"" for x in ("org_code", "pgm_ele_code", "Country", "prop_titl_txt")) + " FROM q p")
def rpt_award_flags(e):
    return reports.award_flags(e)


@query("rpt_budget_blocks", f"""
WITH {CODES}, {LATEST_ROWS}
SELECT p.lead, p."ILN", p.prop_id, p.org_code, p.pgm_ele_code, cd."R" AS "PRCs", '' AS pi_last_name, '' AS inst_name, round(b.frgn_trav_dol, 4) AS frgn_trav_dol, b.part_cnt, b.revn_num, b.budg_seq_yr, round(b.budg_tot_dol, 2) AS dol
FROM v_prj p LEFT JOIN cd ON cd.prop_id = p.prop_id LEFT JOIN lr b ON b.prop_id = p.prop_id
UNION ALL SELECT p.lead, p."ILN", p.prop_id, p.org_code, p.pgm_ele_code, cd."R", pi.pi_last_name, i.inst_shrt_name, NULL, NULL, (SELECT max(revn_num) FROM lr b WHERE b.prop_id = p.prop_id), NULL,
  (SELECT CAST(CAST(sum(CAST(budg_tot_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) FROM lr b WHERE b.prop_id = p.prop_id) FROM v_prj p LEFT JOIN cd ON cd.prop_id = p.prop_id LEFT JOIN {PRIMARY} LEFT JOIN v_inst i ON i.inst_id = p.inst_id""")
def rpt_budget_blocks(e):
    return reports.budget_blocks(e)


@query("rpt_projects", f"""
WITH {BASE}, k AS (SELECT lead, count(*) AS "nProp", CAST(sum(1 + (SELECT count(*) FROM v_copi c WHERE c.prop_id = p.prop_id)) AS BIGINT) AS "nPI", CAST(CAST(sum(CAST(rqst_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS rqst_dol_tot FROM v_prj p GROUP BY lead),
pc AS (SELECT prop_id, count(*) AS n, max(panl_id) AS m FROM v_panl_prop GROUP BY prop_id)
SELECT bs.* EXCLUDE (rqst_dol), k.* EXCLUDE (lead), coalesce(pc.n, 0) AS "nPanl", pc.m AS panl_idmax, bs.pi_last_name || ', ' || bs.pi_frst_name AS pi_name FROM bs JOIN k ON k.lead = bs.lead LEFT JOIN pc ON pc.prop_id = bs.lead WHERE bs."ILN" < 'M'""")
def rpt_projects(e):
    return reports.projects_report(e)


_ROUTE = f"""rt AS (SELECT s.prop_id, {" || ' ' || ".join(f"max(CASE n WHEN {i + 1} THEN code ELSE '' END)" for i in range(4))} AS "rout_PECs"
  FROM (SELECT *, row_number() OVER (PARTITION BY temp_prop_id ORDER BY sequence) AS n FROM v_route) r JOIN v_subm s ON s.temp_prop_id = r.temp_prop_id GROUP BY s.prop_id)"""


@query("rpt_proposals", f"""
WITH {BASE}, {_codes('cc', ',', 7)}, {APPROVALS}, {COUNTRY}, {_ROUTE}
SELECT bs.*, cc.codes AS "PRCs", ap.humn_date, ap.vrtb_date, rt."rout_PECs", cy."Country" FROM bs JOIN ap ON ap.prop_id = bs.prop_id LEFT JOIN cc ON cc.prop_id = bs.prop_id LEFT JOIN rt ON rt.prop_id = bs.prop_id LEFT JOIN cy ON cy.prop_id = bs.prop_id""")
def rpt_proposals(e):
    return reports.proposals_report(e)


@query("rpt_people", f"""
WITH {NAMED}, {BASE}, p3 AS (SELECT prop_id, "ILN", pers, last_name, frst_name, inst_shrt_name FROM iv UNION ALL SELECT prop_id, "ILN", pers, last_name, frst_name, inst_shrt_name FROM sr),
sb AS (SELECT DISTINCT p.prop_id, p."ILN", 'subAwd' AS pers, s.last_name, s.frst_name, i.inst_shrt_name FROM v_prj p JOIN v_subpi s ON s.prop_id = p.prop_id JOIN v_inst i ON i.inst_id = s.inst_id
  WHERE NOT EXISTS (SELECT 1 FROM p3 x WHERE x.prop_id = s.prop_id AND x.last_name = s.last_name AND x.frst_name = s.frst_name AND x.inst_shrt_name = i.inst_shrt_name))
SELECT a.*, CASE WHEN a.pers = ' PI' THEN bs.rqst_dol ELSE 0 END AS rqst_dol, CASE WHEN a.pers = ' PI' THEN bs.pi_id WHEN a.pers = 'coPI' THEN q.pi_id END AS pi_id, CASE WHEN a.pers IN (' PI', 'coPI') THEN q.pi_gend_code END AS pi_gend_code,
  CASE WHEN a.pers IN (' PI', 'coPI') THEN q.pi_emai_addr END AS pi_emai_addr, bs.lead, bs."Dir", bs."Div", bs.org_code, bs.prop_stts_code
FROM (SELECT * FROM p3 UNION ALL SELECT * FROM sb) a JOIN bs ON bs.prop_id = a.prop_id LEFT JOIN v_pi q ON q.pi_last_name = a.last_name AND q.prim_addr_flag = 'Y'""")
def rpt_people(e):
    return reports.people_report(e)


@query("rpt_project_text", f"""
WITH {BASE} SELECT bs.lead, bs."ILN", bs."Dir", bs."Div", bs.prop_id, bs.pi_last_name, bs.inst_name, bs.prop_titl_txt, (SELECT CAST(CAST(sum(CAST(p.rqst_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) FROM v_prj p WHERE p.lead = bs.lead) AS rqst_dol_tot,
CASE WHEN d.source LIKE '%7' THEN 'Y' WHEN d.doc_id IS NOT NULL THEN 'N' END AS spcl_char_pdf, d.text AS proj_summ_txt, d.lang AS intul_mert, d.source AS brodr_impt FROM bs LEFT JOIN documents d ON d.doc_id = bs.prop_id WHERE bs."ILN" < 'M'""")
def rpt_project_text(e):
    return reports.project_text(e)


@query("rpt_suggested_reviewers", f"""
WITH {BASE} SELECT bs.lead, bs."ILN", bs."Div", bs.prop_id, bs.pi_last_name, d.revr_want AS "Suggested_Reviewers", d.revr_dont_want AS "Unwanted_Reviewers", length(d.revr_want) + length(d.revr_dont_want) AS len_tot
FROM bs JOIN v_subm s ON s.prop_id = bs.prop_id JOIN v_sugg d ON d.temp_prop_id = s.temp_prop_id""")
def rpt_suggested_reviewers(e):
    return reports.suggested_reviewers(e)


@query("rpt_orphans", f"""
WITH {BASE} SELECT bs.prop_id, bs.lead, bs."ILN", bs."Div", bs.prop_stts_code, bs.pi_last_name, bs.inst_name, bs.prop_titl_txt, nullif(count(r.revr_id), 0) AS sent_adhoc, nullif(count(r.revr_id) - count(r.rev_rtrn_date), 0) AS out_adhoc,
max(r.rev_due_date) AS last_due FROM bs LEFT JOIN v_rev r ON r.prop_id = bs.prop_id AND r.rev_type_code = 'R' WHERE NOT EXISTS (SELECT 1 FROM v_panl_prop pp WHERE pp.prop_id = bs.prop_id) GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")
def rpt_orphans(e):
    return reports.orphans(e)


_XFER = """pi.pi_last_name, i.inst_shrt_name"""
_HELD = """JOIN v_pi pi ON pi.pi_id = q.pi_id AND pi.prim_addr_flag = 'Y' JOIN v_inst i ON i.inst_id = q.inst_id"""


@query("rpt_transfers", f"""
WITH RECURSIVE lk AS (SELECT p.prop_id AS node, c.prev_awd_id AS reached FROM v_prop p JOIN v_subm s ON s.prop_id = p.prop_id JOIN v_covr c ON c.temp_prop_id = s.temp_prop_id
    WHERE c.prev_awd_id IS NOT NULL AND p.natr_rqst_code NOT IN ('BUILDING', 'MACHINERY') UNION SELECT awd_id, last_prop_id FROM v_log WHERE awd_id <> last_prop_id),
rc(prop_id, awd_id, hops) AS (SELECT prop_id, prop_id, CAST(0 AS BIGINT) FROM v_prop UNION SELECT rc.prop_id, lk.reached, rc.hops + 1 FROM rc JOIN lk ON lk.node = rc.awd_id),
pa AS (SELECT prop_id, awd_id, min(hops) AS hops FROM rc GROUP BY prop_id, awd_id),
al AS (SELECT pa.prop_id, pa.awd_id, pa.hops, min(l.last_prop_id) AS last_prop_id, 'awd ' AS xfer_type, {_XFER}, CASE WHEN l.org_code <> q.org_code THEN q.org_code END AS "fromORG", l.org_code AS "toORG",
    CASE WHEN l.pgm_ele_code <> q.pgm_ele_code THEN q.pgm_ele_code END AS "fromPEC", l.pgm_ele_code AS "toPEC",
    CASE WHEN l.pm_ibm_logn_id <> q.pm_ibm_logn_id THEN q.pm_ibm_logn_id END AS "fromPO", l.pm_ibm_logn_id AS "toPO", min(l.awd_chg_date) AS crtd_date, CAST(NULL AS STRING) AS note
  FROM pa JOIN v_log l ON l.awd_id = pa.awd_id JOIN v_prop q ON q.prop_id = l.last_prop_id {_HELD} GROUP BY ALL
  UNION ALL SELECT pa.prop_id, pa.awd_id, pa.hops, pa.awd_id, 'prop', {_XFER}, CASE WHEN h.to_org <> h.from_org THEN h.from_org END, h.to_org, CASE WHEN h.to_pgm <> h.from_pgm THEN h.from_pgm END, h.to_pgm,
    CASE WHEN h.to_lan_id <> h.from_lan_id THEN h.from_lan_id END, h.to_lan_id, h.crtd_date, coalesce(h.note, '')
  FROM pa JOIN v_own h ON h.prop_id = pa.awd_id AND h.ownr_stts_code = 9 JOIN v_prop q ON q.prop_id = pa.awd_id {_HELD})
SELECT al.*, p.lead, p."ILN", p.natr_rqst_code, p.prop_stts_code FROM al JOIN v_prj p ON p.prop_id = al.prop_id""")
def rpt_transfers(e):
    return reports.transfers(e)


@query("rpt_panelists", f"""
WITH {FACTS} SELECT rf.*, count(pr.panl_id) AS "nPanls", max(v.panl_bgn_date) AS latest FROM v_panl_revr pr JOIN rf ON rf.revr_id = pr.revr_id JOIN v_panl v ON v.panl_id = pr.panl_id WHERE pr.panl_id LIKE 'P1%' GROUP BY ALL""")
def rpt_panelists(e):
    return reports.panelists(e)


@query("rpt_panelist_stats", f"""
WITH {FACTS}, {TIMED}, {SELECTED} SELECT b.*, a.* EXCLUDE (revr_id), (SELECT count(*) FROM v_panl_revr pr WHERE pr.revr_id = b.revr_id AND pr.panl_id LIKE 'P1%') AS "nPanls", rf.* EXCLUDE (revr_id)
FROM b LEFT JOIN a ON a.revr_id = b.revr_id AND a."nProps_all" <> b."nProps" LEFT JOIN rf ON rf.revr_id = b.revr_id""")
def rpt_panelist_stats(e):
    return reports.panelist_statistics(e)


@query("rpt_reviewers", f"""
WITH {FACTS} SELECT rf.*, count(r.prop_id) AS "nProps", max(r.rev_rtrn_date) AS latest FROM v_rev r JOIN rf ON rf.revr_id = r.revr_id WHERE r.prop_id IN (SELECT lead FROM v_prj) AND r.rev_rtrn_date IS NOT NULL AND r.rev_type_code <> 'C' GROUP BY ALL""")
def rpt_reviewers(e):
    return reports.reviewers(e)


@query("rpt_reviewer_stats", f"""
WITH {FACTS}, {TIMED}, x AS (SELECT tm.* FROM tm WHERE prop_id IN (SELECT lead FROM v_prj) AND rev_rtrn_date IS NOT NULL AND rev_type_code <> 'C'), s AS ({stats_sql('x')}) SELECT s.*, rf.* EXCLUDE (revr_id) FROM s JOIN rf ON rf.revr_id = s.revr_id""")
def rpt_reviewer_stats(e):
    return reports.reviewer_statistics(e)


@query("rpt_props_on_panels", f"""
WITH {BASE}, {APPROVALS}, {COUNTRY}, {OUTCOMES}, rr AS (SELECT p.lead, m.string, m.score, r.rev_rtrn_date, row_number() OVER (PARTITION BY p.lead ORDER BY m.score DESC NULLS LAST, r.revr_id) AS n
  FROM v_prj p JOIN v_rev r ON r.prop_id = p.lead JOIN v_rating m ON m.yn = r.rev_prop_rtng_ind WHERE p."ILN" < 'M' AND r.rev_stts_code <> 'C'),
rv AS (SELECT lead, string_agg(CASE WHEN n <= 10 THEN string END, ',' ORDER BY n) AS reviews, {average_sql("score", 1000)} AS avg_score, max(rev_rtrn_date) AS last_rev_date FROM rr GROUP BY lead)
SELECT bs.*, ap.humn_date, ap.vrtb_date, pp.panl_id, CASE WHEN s.panl_id IS NOT NULL THEN 'Y' END AS panl_held, s.panl_summ_rlse_flag AS summ_rlse, s.prop_ordr AS rank, s.rcom_seq_num AS rcom_seq, s.rcom_abbr, v.panl_name, v.panl_bgn_date,
  rv.reviews, rv.avg_score, rv.last_rev_date, cy."Country", CASE WHEN s.prop_ordr IS NOT NULL THEN 'rk ' || s.prop_ordr || ' of ' ELSE '' END || coalesce(ob."panlSumm", '') AS "rankInPanl"
FROM bs JOIN ap ON ap.prop_id = bs.prop_id LEFT JOIN v_panl_prop pp ON pp.prop_id = bs.lead LEFT JOIN v_rec s ON s.panl_id = pp.panl_id AND s.prop_id = bs.lead LEFT JOIN v_panl v ON v.panl_id = pp.panl_id
LEFT JOIN ob ON ob.panl_id = pp.panl_id LEFT JOIN rv ON rv.lead = bs.lead LEFT JOIN cy ON cy.prop_id = bs.prop_id""")
def rpt_props_on_panels(e):
    return reports.props_on_panels(e)


@query("rpt_panels", f"""
WITH {OUTCOMES} SELECT v.*, (SELECT count(*) FROM v_panl_prop pp JOIN v_prj p ON p.prop_id = pp.prop_id WHERE pp.panl_id = v.panl_id AND p."ILN" < 'M') AS "numProps", replace(ob."panlSumm", ' proj: ', ' rated projects: ') AS "panlSumm"
FROM v_panl v JOIN ob ON ob.panl_id = v.panl_id""")
def rpt_panels(e):
    return reports.panels_report(e)


@query("rpt_new_institutions", f"""
WITH {BASE} SELECT bs.* FROM bs WHERE bs.inst_id IN (SELECT inst_id FROM v_prop WHERE prop_stts_code = 'P') AND NOT EXISTS (SELECT 1 FROM v_awd a WHERE a.inst_id = bs.inst_id AND a.awd_exp_date >= DATE '2009-02-20' - INTERVAL 58 MONTH)""")
def rpt_new_institutions(e):
    return reports.new_institutions(e)


@query("rpt_coi_reviewers", """
SELECT DISTINCT v.revr_last_name, v.revr_frst_name, m.revr_addr_txt AS email FROM v_rev r JOIN v_revr v ON v.revr_id = r.revr_id LEFT JOIN v_revr_mail m ON m.revr_id = v.revr_id AND m.addr_lne_type_code = 'E' WHERE r.prop_id IN (SELECT prop_id FROM v_idlist)""")
def rpt_coi_reviewers(e):
    return reports.coi_reviewers(e)


@query("rpt_coi_projects", f"""WITH {BASE} SELECT "Div", prop_id, "ILN", pi_last_name, inst_name FROM bs WHERE "ILN" < 'M' AND prop_stts_code NOT IN ('O')""")
def rpt_coi_projects(e):
    return reports.coi_projects(e)


@query("rpt_subaward_recon", f"""
WITH {BASE}, c AS (SELECT prop_id, perf_inst_id, revn_num, CASE WHEN src = 'budg' THEN coalesce(sub_ctr_req_dol, 0) ELSE 0 END AS s, CASE WHEN src = 'indirect' THEN CAST({ratio_sql("CAST(round(coalesce(rate, 0) * 10000) AS BIGINT) * CAST(round(coalesce(amount, 0) * 100) AS BIGINT)", "100000000")} AS DOUBLE) ELSE coalesce(amount, 0) END AS b
  FROM v_cost WHERE prop_id IN (SELECT prop_id FROM v_cost WHERE sub_ctr_req_dol > 0)),
g AS (SELECT prop_id, perf_inst_id, revn_num, CAST(round(sum(CAST(s AS DECIMAL(18, 4))), 0) AS DOUBLE) AS s, CAST(round(sum(CAST(b AS DECIMAL(18, 4))), 0) AS DOUBLE) AS b FROM c GROUP BY prop_id, perf_inst_id, revn_num)
SELECT bs.prop_id, bs.lead, bs."ILN", bs."Div", bs.pi_last_name, bs.inst_name, bs.prop_titl_txt, i.inst_shrt_name AS perf_inst, g.revn_num, g.b AS budg_total,
  nullif(round(g.b - (SELECT CAST(sum(CAST(x.budg_tot_dol AS DECIMAL(18, 4))) AS DOUBLE) FROM v_budg x WHERE x.prop_id = g.prop_id AND x.revn_num = 0), 2), 0) AS budg_diff, g.s AS "subAwd",
  nullif(g.s - (SELECT coalesce(sum(y.b), 0) FROM g y WHERE y.s = 0 AND y.prop_id = g.prop_id AND y.revn_num = g.revn_num), 0) AS "subAwd_diff"
FROM g JOIN v_inst i ON i.inst_id = g.perf_inst_id JOIN bs ON bs.prop_id = g.prop_id WHERE g.s > 0""")
def rpt_subaward_recon(e):
    return reports.subaward_reconciliation(e)


@query("rpt_autocode_check", f"""
WITH {_codes('cp7', ' ', 7, True)}, {DEMOG}
SELECT p.lead, p."ILN", p.prop_id, p.cntx_stmt_id, pi.pi_last_name, pi.pi_frst_name, i.inst_shrt_name, i.st_code, p.prop_stts_code, ps.prop_stts_abbr, p.pm_ibm_logn_id AS "PO", p.bas_rsch_pct, p.other_pct,
  p.apld_rsch_pct, p.educ_trng_pct, p.mjr_equp_pct, p.land_buld_fix_equp_pct, p.non_invt_pct, p.org_code, CASE WHEN p.org_code <> p.orig_org_code THEN p.orig_org_code END AS orig_org, p.pgm_ele_code,
  CASE WHEN p.pgm_ele_code <> p.orig_pgm_ele_code THEN p.orig_pgm_ele_code END AS "orig_PEC", dm.* EXCLUDE (prop_id), cp7.codes AS "PRCs", p.prop_titl_txt
FROM v_prj p JOIN {PRIMARY} JOIN v_inst i ON i.inst_id = p.inst_id JOIN dm ON dm.prop_id = p.prop_id JOIN v_stts ps ON ps.prop_stts_code = p.prop_stts_code LEFT JOIN cp7 ON cp7.prop_id = p.prop_id""")
def rpt_autocode_check(e):
    return reports.autocode_check(e)


def _side(name: str) -> str:
    return f'{name}.panl_id AS {name}_panl, {name}.panl_bgn_date AS {name}_begin, {name}.rcom_seq_num AS {name}_recno, {name}.rcom_abbr AS {name}_rec, {name}.prop_ordr AS {name}_rank'


@query("rpt_tracker_proposal", f"""
WITH {PANEL_ROWS}, {ADHOC}, cp6 AS ({PLACED}), sx AS (SELECT prop_id, min(panl_bgn_date) AS lo, max(panl_bgn_date) AS hi FROM pw GROUP BY prop_id),
first AS (SELECT pw.* FROM pw JOIN sx ON sx.prop_id = pw.prop_id AND pw.panl_bgn_date = sx.lo), last AS (SELECT pw.* FROM pw JOIN sx ON sx.prop_id = pw.prop_id AND pw.panl_bgn_date = sx.hi AND sx.hi > sx.lo),
mo AS (SELECT prop_id, CAST(CAST(sum(CAST(budg_splt_tot_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS split_tot_dol, max(frwd_date) AS split_frwd_date FROM v_splt GROUP BY prop_id)
SELECT p.lead AS lead_id, p."ILN", p.prop_id, p.org_code, p.pgm_ele_code, p.prop_stts_code, p.natr_rqst_code, p.rqst_dol, p.received_date, nullif(p.dd_rcom_date, TIMESTAMP '1900-01-01') AS dd_rcom_date, p.bas_rsch_pct, p.prop_titl_txt,
  pi.pi_last_name, pi.pi_gend_code, i.inst_shrt_name AS inst_name, cp6."PRCs6" AS "PRCs", {ADHOC_COLUMNS}, {_side('first')}, {_side('last')}, mo.split_tot_dol, mo.split_frwd_date,
  a.awd_id, a.tot_intn_awd_amt, a.awd_stts_code, a.awd_eff_date, a.awd_exp_date, i2.inst_shrt_name AS inst_awd
FROM v_prj p JOIN {PRIMARY} JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN cp6 ON cp6.prop_id = p.prop_id LEFT JOIN ah ON ah.prop_id = p.prop_id LEFT JOIN first ON first.prop_id = p.prop_id LEFT JOIN last ON last.prop_id = p.prop_id LEFT JOIN mo ON mo.prop_id = p.prop_id
LEFT JOIN v_awd a ON a.awd_id = p.prop_id LEFT JOIN v_inst i2 ON i2.inst_id = a.inst_id""")
def rpt_tracker_proposal(e):
    return reports.tracker_proposal(e)


def _omit(e) -> DataFrame:
    """Splits to leave out: all of the listed proposals' year 1999."""
    return e.idlist.select("prop_id", F.lit(1999).alias("budg_yr"), F.lit(None).cast("string").alias("splt_id"))


@query("rpt_tracker_split", f"""
WITH {PATTERNS}, {_codes('c11', ' ', 11)}, {SPLIT_CODES}, k AS (SELECT s.* FROM v_splt s WHERE s.pgm_ele_code LIKE 'S%' UNION SELECT s.* FROM v_splt s JOIN pt ON {MATCH}),
o AS (SELECT s.* FROM k s WHERE NOT EXISTS (SELECT 1 FROM v_idlist l WHERE l.prop_id = s.prop_id AND s.budg_yr = 1999))
SELECT s.prop_id, s.budg_yr, s.splt_id, round(s.budg_splt_tot_dol, 2) AS budg_splt_tot_dol, s.pgm_ele_code AS "PEC_bdg_splt", p."ILN", p.lead AS lead_id, p.received_date, p.org_code, p.pgm_ele_code AS "PEC_prop", p.prop_stts_code,
  pi.pi_last_name, i.inst_shrt_name AS inst_name, p.rqst_dol, c11.codes AS "PropPRCs", sc.codes AS "BudgPRCs", a.awd_stts_code
FROM o s JOIN v_prj p ON p.prop_id = s.prop_id LEFT JOIN {PRIMARY} LEFT JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN c11 ON c11.prop_id = s.prop_id LEFT JOIN sc ON sc.prop_id = s.prop_id AND sc.budg_yr = s.budg_yr AND sc.splt_id = s.splt_id
LEFT JOIN v_awd a ON a.awd_id = s.prop_id""")
def rpt_tracker_split(e):
    return reports.tracker_split(e, patterns(e), _omit(e))


_PAIRS = """lp AS (SELECT lead, prop_id, pi_id FROM v_prj WHERE prop_id IN (SELECT prop_id FROM v_idlist) OR lead_prop_id IN (SELECT prop_id FROM v_idlist)),
pr AS (SELECT * FROM lp UNION SELECT p.lead, p.prop_id, c.pi_id FROM lp p JOIN v_copi c ON c.prop_id = p.prop_id)"""


@query("pi_bridge", f"WITH {_PAIRS} SELECT lead, prop_id, pi_id FROM pr", LISTS, LIST_CHECKS)
def pi_bridge(e):
    return reports.listed_people(e)


@query("pi_held_awards", f"""
WITH {_PAIRS}, mn AS (SELECT t.awd_id, t.n AS "totPIs", o.* EXCLUDE (oblg_id) FROM (SELECT awd_id, count(DISTINCT pi_id) AS n FROM v_awd_pi WHERE end_date IS NULL GROUP BY awd_id) t
  JOIN (SELECT oblg_id, CAST(CAST(sum(CAST(oblg_amt AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS "totOblg_amt", CAST(CAST(sum(CAST(cuml_xpnd_amt AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS "totCuml_xpnd_amt", max(last_pymt_date) AS last_pymt_date FROM v_oblg GROUP BY oblg_id) o ON o.oblg_id = t.awd_id)
SELECT w.pi_id, w.awd_id, w.proj_role_code, a.tot_intn_awd_amt, a.awd_exp_date, mn.* EXCLUDE (awd_id), i2.inst_shrt_name AS inst_awd, pi.pi_last_name, pi.pi_frst_name
FROM v_awd_pi w JOIN v_awd a ON a.awd_id = w.awd_id AND a.awd_stts_code = '80' JOIN mn ON mn.awd_id = w.awd_id JOIN v_inst i2 ON i2.inst_id = a.inst_id JOIN v_pi pi ON pi.pi_id = w.pi_id AND pi.prim_addr_flag = 'Y'
WHERE w.end_date IS NULL AND w.pi_id IN (SELECT pi_id FROM pr)""", LISTS, LIST_CHECKS)
def pi_held_awards(e):
    return reports.awards_of_people(e)


@query("pi_held_pending", f"""
WITH {_PAIRS}, ro AS (SELECT prop_id AS pend_id, pi_id, '1' AS proj_role_code FROM v_prop WHERE prop_stts_code = 'P' UNION SELECT c.prop_id, c.pi_id, '2' FROM v_copi c JOIN v_prop p ON p.prop_id = c.prop_id AND p.prop_stts_code = 'P')
SELECT ro.*, pi.pi_last_name, p.rqst_dol, p.org_code, p.pgm_ele_code, p.prop_stts_code, p.prop_titl_txt FROM ro JOIN v_pi pi ON pi.pi_id = ro.pi_id AND pi.prim_addr_flag = 'Y' JOIN v_prop p ON p.prop_id = ro.pend_id
WHERE ro.pi_id IN (SELECT pi_id FROM pr)""", LISTS, LIST_CHECKS)
def pi_held_pending(e):
    return reports.pending_of_people(e)


@query("rpt_pi_awards", f"""
WITH {_PAIRS}, mn AS (SELECT t.awd_id, t.n AS "totPIs", o.* EXCLUDE (oblg_id) FROM (SELECT awd_id, count(DISTINCT pi_id) AS n FROM v_awd_pi WHERE end_date IS NULL GROUP BY awd_id) t
  JOIN (SELECT oblg_id, CAST(CAST(sum(CAST(oblg_amt AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS "totOblg_amt", CAST(CAST(sum(CAST(cuml_xpnd_amt AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS "totCuml_xpnd_amt", max(last_pymt_date) AS last_pymt_date FROM v_oblg GROUP BY oblg_id) o ON o.oblg_id = t.awd_id)
SELECT pr.lead, pr.prop_id, pr.pi_id, w.awd_id, w.proj_role_code, a.tot_intn_awd_amt, a.awd_exp_date, mn.* EXCLUDE (awd_id), pi.pi_last_name, pi.pi_frst_name, pi.pi_emai_addr, i.inst_shrt_name AS inst_name, i2.inst_shrt_name AS inst_awd
FROM pr JOIN v_awd_pi w ON w.pi_id = pr.pi_id AND w.end_date IS NULL JOIN v_awd a ON a.awd_id = w.awd_id AND a.awd_stts_code = '80' JOIN mn ON mn.awd_id = w.awd_id JOIN v_pi pi ON pi.pi_id = pr.pi_id JOIN v_inst i ON i.inst_id = pi.inst_id
JOIN v_inst i2 ON i2.inst_id = a.inst_id""")
def rpt_pi_awards(e):
    return reports.pi_awards(e)


@query("rpt_pi_pending", f"""
WITH {_PAIRS}, w AS (SELECT pr.lead, pr.prop_id, pr.pi_id, '1' AS proj_role_code, p.prop_id AS pend_id FROM pr JOIN v_prop p ON p.pi_id = pr.pi_id AND p.prop_stts_code = 'P' AND p.prop_id <> pr.prop_id
  UNION SELECT pr.lead, pr.prop_id, pr.pi_id, '2', c.prop_id FROM pr JOIN v_copi c ON c.pi_id = pr.pi_id AND c.prop_id <> pr.prop_id JOIN v_prop p ON p.prop_id = c.prop_id AND p.prop_stts_code = 'P'),
np AS (SELECT prop_id, count(*) AS n FROM v_copi GROUP BY prop_id)
SELECT w.*, pi.pi_last_name, pi.pi_emai_addr, i.inst_shrt_name AS inst_name, p.rqst_dol, p.org_code, p.pgm_ele_code, p.prop_stts_code, p.prop_titl_txt, 1 + coalesce(np.n, 0) AS "numPI", s.panl_id, s.rcom_seq_num, s.rcom_abbr
FROM w JOIN v_pi pi ON pi.pi_id = w.pi_id AND pi.prim_addr_flag = 'Y' JOIN v_prop p ON p.prop_id = w.pend_id JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN np ON np.prop_id = w.pend_id LEFT JOIN v_rec s ON s.prop_id = w.pend_id""")
def rpt_pi_pending(e):
    return reports.pi_pending(e)


@query("rpt_panel_minutes", f"""
WITH {CONFLICT_TEXT} SELECT v.*, (SELECT count(*) FROM v_panl_prop pp JOIN v_prj p ON p.prop_id = pp.prop_id WHERE pp.panl_id = v.panl_id AND p.prop_id = p.lead) AS "Nproj", (SELECT count(*) FROM v_panl_prop pp WHERE pp.panl_id = v.panl_id) AS "Nprop",
(SELECT nullif(count(*), 0) FROM v_panl_revr pr WHERE pr.panl_id = v.panl_id) AS "Nrevr", ct."Conflicts" FROM v_panl v LEFT JOIN ct ON ct.panl_id = v.panl_id""")
def rpt_panel_minutes(e):
    return reports.panel_minutes(e)


@query("rpt_compliance_prop", f"""
WITH {PRESENT}, {APPROVALS}, b AS (SELECT prop_id, CAST(sum(CAST(budg_tot_dol AS DECIMAL(18, 4))) AS DOUBLE) AS cum, sum(pdoc_grnt_dol) AS pdoc FROM v_budg WHERE revn_num = 0 GROUP BY prop_id), np AS (SELECT prop_id, count(*) AS n FROM v_copi GROUP BY prop_id)
SELECT p."ILN", p.lead, p.prop_id, p.org_code, p.pgm_ele_code, CASE WHEN p.pgm_ele_code <> p.orig_pgm_ele_code THEN p.orig_pgm_ele_code END AS orig_pgm_ele_code, CASE WHEN upper(p.prop_titl_txt) LIKE '%GOALI%' THEN 'Y' END AS "GOALI_flag",
  ap.humn_date, ap.vrtb_date, CASE WHEN p."ILN" = 'N' THEN 'N/A' ELSE dp.pd END AS "ProjDesc", dp.rc AS "RefCited", CASE WHEN b.pdoc > 0 AND NOT dp.mp THEN 'No MP' ELSE dp.mp_pg END AS "MentPlan", dp.dmp AS "DMP", dp.bj AS budg_just_pg,
  dp.sup AS oth_supp_cnt, 1 + coalesce(np.n, 0) AS "tot_PIs", p.rqst_dol AS tot_rqst_dol, round(b.cum, 2) AS cumulative_tot_dol, nullif(round(b.cum - coalesce(p.rqst_dol, 0), 2), 0) AS "Diff_tot_dol"
FROM v_prj p JOIN dp ON dp.prop_id = p.prop_id LEFT JOIN ap ON ap.prop_id = p.prop_id LEFT JOIN b ON b.prop_id = p.prop_id LEFT JOIN np ON np.prop_id = p.prop_id""")
def rpt_compliance_prop(e):
    return reports.compliance_by_proposal(e)


@query("rpt_compliance_proj", f"""
WITH {PRESENT}, {PEOPLE}, b AS (SELECT p.lead, CAST(sum(CAST(x.budg_tot_dol AS DECIMAL(18, 4))) AS DOUBLE) AS cum, sum(x.pdoc_grnt_dol) AS pdoc FROM v_budg x JOIN v_prj p ON p.prop_id = x.prop_id WHERE x.revn_num = 0 GROUP BY p.lead),
t AS (SELECT lead, CAST(CAST(sum(CAST(rqst_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS tot_rqst_dol, CASE WHEN min(prop_titl_txt) <> max(prop_titl_txt) THEN 'Y' END AS dif_titl_collab FROM v_prj GROUP BY lead),
s AS (SELECT lead, count(*) AS "NumPIs", count("LastAwd") AS "NumRPS", {_slot_sql(stages.PEOPLE_FIELDS, 10, 'pi{i}_{f}')} FROM ps GROUP BY lead)
SELECT p.lead, p.org_code, p.pgm_ele_code, CASE WHEN upper(p.prop_titl_txt) LIKE '%GOALI%' THEN 'Y' END AS "GOALI_flag", dp.pd AS "ProjDesc", dp.rc AS "RefCited", CASE WHEN b.pdoc > 0 AND NOT dp.mp THEN 'No MP' ELSE dp.mp_pg END AS "MentPlan",
  dp.dmp AS "DMP", t.dif_titl_collab, t.tot_rqst_dol, round(b.cum, 2) AS cumulative_tot_dol, nullif(round(b.cum - coalesce(t.tot_rqst_dol, 0), 2), 0) AS "Diff_tot_dol", s.* EXCLUDE (lead)
FROM v_prj p JOIN s ON s.lead = p.lead JOIN dp ON dp.prop_id = p.prop_id LEFT JOIN t ON t.lead = p.lead LEFT JOIN b ON b.lead = p.lead WHERE p."ILN" < 'M'""")
def rpt_compliance_proj(e):
    return reports.compliance_by_project(e)


@query("rpt_list_found", """
WITH r AS (SELECT prop_id, row_number() OVER (ORDER BY lead, "ILN", prop_id) + 2 AS n FROM v_prj) SELECT l.prop_id, coalesce(CAST(r.n AS STRING), '--') AS found FROM v_idlist l LEFT JOIN r ON r.prop_id = l.prop_id""")
def rpt_list_found(e):
    return reports.list_found(e)


@query("rpt_portfolio", """
SELECT q.* EXCLUDE (prop_stts_code), o.dir_div_abbr AS "Dir", nr.natr_rqst_abbr, oc.obj_clas_name, g.pgm_ele_name, ps.prop_stts_abbr FROM (SELECT pm_ibm_logn_id AS "PO", left(org_code, 4) AS "Org", pgm_annc_id, pgm_ele_code, natr_rqst_code, obj_clas_code, prop_stts_code, count(prop_id) AS "Nprop", CAST(sum(CASE WHEN lead_prop_id <> prop_id THEN 0 ELSE 1 END) AS BIGINT) AS "Nproj", CAST(CAST(sum(CAST(rqst_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS "SumRqstDol"
FROM v_prop WHERE dd_rcom_date >= TIMESTAMP '1995-01-01' AND dd_rcom_date <= TIMESTAMP '1997-01-01' AND obj_clas_code LIKE '4%' GROUP BY 1, 2, 3, 4, 5, 6, 7) q JOIN v_org o ON o.org_code = left(q."Org", 2) || '000000'
JOIN v_rqst nr ON nr.natr_rqst_code = q.natr_rqst_code JOIN v_class oc ON oc.obj_clas_code = q.obj_clas_code JOIN v_pgm g ON g.pgm_ele_code = q.pgm_ele_code JOIN v_stts ps ON ps.prop_stts_code = q.prop_stts_code""")
def rpt_portfolio(e):
    return reports.portfolio(e)


@query("rpt_panel_load_org", """
WITH h AS (SELECT panl_id FROM v_panl WHERE panl_bgn_date BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-01-01')
SELECT p.org_code, p.pgm_ele_code, count(DISTINCT pp.panl_id) AS "Npanl", count(DISTINCT p.lead) AS "Nproj" FROM v_panl_prop pp SEMI JOIN h ON h.panl_id = pp.panl_id
JOIN v_prj p ON p.prop_id = pp.prop_id AND p."ILN" < 'M' GROUP BY ALL""")
def rpt_panel_load_org(e):
    return reports.panel_load_by_org(e)


@query("rpt_panel_load", """
WITH h AS (SELECT panl_id, left(panl_id, 2) AS manager FROM v_panl WHERE panl_bgn_date BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-01-01'),
n AS (SELECT pp.panl_id, pp.prop_id FROM v_panl_prop pp JOIN v_prj p ON p.prop_id = pp.prop_id AND p."ILN" < 'M' AND p.org_code LIKE '10%')
SELECT h.manager, count(DISTINCT h.panl_id) AS "Npanl", count(DISTINCT n.panl_id) AS "Nreviewing", count(n.prop_id) AS "Nproj" FROM h LEFT JOIN n ON n.panl_id = h.panl_id GROUP BY h.manager""")
def rpt_panel_load(e):
    return reports.panel_load(e)
