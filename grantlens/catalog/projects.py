"""The project model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions import criteria
from ..operators import budgets, selection
from ..plans import stages
from .registry import query


@query("prj_iln", """SELECT prop_id, CASE WHEN lead_prop_id IS NULL THEN 'I' WHEN lead_prop_id <> prop_id THEN 'N' ELSE 'L' END AS "ILN" FROM v_prop""")
def prj_iln(e):
    return e.facts.select("prop_id", c.role("lead_prop_id", "prop_id").alias("ILN"))


@query("prj_lead", "SELECT prop_id, ifnull(lead_prop_id, prop_id) AS lead FROM v_prop")
def prj_lead(e):
    return e.facts.select("prop_id", c.lead("lead_prop_id", "prop_id").alias("lead"))


@query("prj_expand", """
WITH s AS (SELECT prop_id, lead_prop_id FROM v_prop WHERE prop_stts_code = 'F')
SELECT lead_prop_id, prop_id FROM s
UNION SELECT p.lead_prop_id, p.prop_id FROM v_prop p JOIN s ON s.lead_prop_id = p.lead_prop_id
WHERE NOT EXISTS (SELECT 1 FROM s x WHERE x.prop_id = p.prop_id)""")
def prj_expand(e):
    chosen = criteria.apply(e.facts, {"prop_stts_code": "F"})
    return selection.expand(chosen, e.facts).select("lead_prop_id", "prop_id")


@query("prj_expand_leadfirst", """
WITH l AS (SELECT DISTINCT ifnull(lead_prop_id, prop_id) AS lead FROM v_prop WHERE pgm_ele_code IN ('1-URGENT', '2-HIGH')),
a AS (SELECT CASE WHEN p.lead_prop_id IS NULL THEN 'I' ELSE 'L' END AS "ILN", l.lead, p.prop_id, p.pi_id, p.rqst_dol FROM l JOIN v_prop p ON p.prop_id = l.lead),
b AS (SELECT * FROM a UNION ALL SELECT 'N', p.lead_prop_id, p.prop_id, p.pi_id, p.rqst_dol FROM a JOIN v_prop p ON a.prop_id = p.lead_prop_id AND a.prop_id <> p.prop_id)
SELECT * FROM b UNION ALL SELECT 'P', b.lead, b.prop_id, c.pi_id, 0 FROM b JOIN v_copi c ON c.prop_id = b.prop_id""")
def prj_expand_leadfirst(e):
    chosen = criteria.apply(e.prop, {"pgm_ele_code": "1-URGENT,2-HIGH"})
    return selection.expand_from_leads(selection.leads_of(chosen), e.prop, e.copi).drop("prop_titl_txt")


@query("prj_add_omit", """
WITH s AS (SELECT prop_id, lead_prop_id FROM v_prop WHERE prop_stts_code = 'P' OR prop_id IN (SELECT prop_id FROM v_idlist)),
x AS (SELECT * FROM s UNION SELECT p.prop_id, p.lead_prop_id FROM v_prop p WHERE p.lead_prop_id IN (SELECT lead_prop_id FROM s))
SELECT prop_id, lead_prop_id FROM x WHERE prop_id NOT IN (SELECT prop_id FROM v_panl_prop WHERE panl_id = 'P11')""")
def prj_add_omit(e):
    chosen = criteria.apply(e.facts, {"prop_stts_code": "P"})
    omitted = e.panl_prop.filter("panl_id = 'P11'").select("prop_id")
    return selection.add_and_omit(chosen, e.facts, e.idlist, omitted).select("prop_id", "lead_prop_id")


_A_SQL = "(org_code LIKE '10%' OR org_code LIKE '11%' OR org_code LIKE '12%') AND pgm_ele_code = '1-URGENT'"


def _criteria_a():
    return criteria.combine({"org_code": "1[0-2]%", "pgm_ele_code": "1-URGENT"})


_LEADFIRST = """
SELECT CASE WHEN p.lead_prop_id IS NULL THEN 'I' ELSE 'L' END AS "ILN", l.lead, p.prop_id FROM l JOIN v_prop p ON p.prop_id = l.lead
UNION ALL SELECT 'N', l.lead, p.prop_id FROM l JOIN v_prop p ON p.lead_prop_id = l.lead AND p.prop_id <> l.lead"""


@query("prj_a_plus_b", f"""
WITH l AS (SELECT DISTINCT ifnull(lead_prop_id, prop_id) AS lead FROM v_prop WHERE ({_A_SQL}) OR prop_id IN (SELECT prop_id FROM v_idlist))
{_LEADFIRST}""")
def prj_a_plus_b(e):
    chosen = selection.criteria_or_list(e.prop, _criteria_a(), e.idlist)
    return selection.expand_from_leads(selection.leads_of(chosen), e.prop).select("ILN", "lead", "prop_id")


@query("prj_a_minus_b", f"""
WITH l AS (SELECT DISTINCT ifnull(lead_prop_id, prop_id) AS lead FROM v_prop WHERE ({_A_SQL}) AND prop_id NOT IN (SELECT prop_id FROM v_idlist))
{_LEADFIRST}""")
def prj_a_minus_b(e):
    chosen = selection.criteria_not_list(e.prop, _criteria_a(), e.idlist)
    return selection.expand_from_leads(selection.leads_of(chosen), e.prop).select("ILN", "lead", "prop_id")


@query("prj_base", """
SELECT p.received_date, nullif(p.dd_rcom_date, TIMESTAMP '1900-01-01') AS dd_rcom_date, o2.dir_div_abbr AS "Dir", p.org_code,
  p.org_code || ' - ' || o.dir_div_abbr AS "OrgLabel", p.pgm_ele_code, CASE WHEN p.pgm_ele_code <> p.orig_pgm_ele_code THEN p.orig_pgm_ele_code END AS "origPEC",
  p.pgm_annc_id, CASE WHEN p.org_code <> p.orig_org_code THEN p.orig_org_code END AS "origORG", p.pgm_ele_code || ' - ' || g.pgm_ele_name AS "Pgm", p.pm_ibm_logn_id AS "PO", p.obj_clas_code, nr.natr_rqst_abbr, ps.prop_stts_abbr, ps.prop_stts_txt,
  p.rqst_eff_date, p.rqst_mnth_cnt, p.cntx_stmt_id, p.natr_rqst_code, p.prop_stts_code, p."ILN", p.lead, o.dir_div_abbr AS "Div", p.prop_id, pi.pi_last_name, pi.pi_frst_name, i.inst_shrt_name AS inst_name, i.st_code,
  pi.pi_emai_addr, p.prop_titl_txt, p.rqst_dol, p.inst_id, p.pi_id
FROM v_prj p JOIN v_org o ON o.org_code = p.org_code JOIN v_org o2 ON o2.org_code = left(p.org_code, 2) || '000000'
JOIN v_inst i ON i.inst_id = p.inst_id JOIN v_pi pi ON pi.pi_id = p.pi_id JOIN v_pgm g ON g.pgm_ele_code = p.pgm_ele_code JOIN v_stts ps ON ps.prop_stts_code = p.prop_stts_code JOIN v_rqst nr ON nr.natr_rqst_code = p.natr_rqst_code WHERE pi.prim_addr_flag = 'Y'""")
def prj_base(e):
    return stages.base(e)


@query("prj_one_row", """SELECT lead, prop_id, "ILN" FROM v_prj WHERE "ILN" < 'M'""")
def prj_one_row(e):
    return selection.one_row_per_project(selection.with_project(e.facts)).select("lead", "prop_id", "ILN")


@query("prj_with_template", """
WITH s AS (SELECT DISTINCT lead_prop_id, prop_id, 'Award' AS template FROM v_prop WHERE prop_stts_code = 'F'
  UNION SELECT DISTINCT lead_prop_id, prop_id, 'Decline' FROM v_prop WHERE bas_rsch_pct < 1)
SELECT * FROM s UNION SELECT DISTINCT p.lead_prop_id, p.prop_id, s.template FROM s JOIN v_prop p ON p.lead_prop_id = s.lead_prop_id
WHERE s.lead_prop_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s x WHERE x.prop_id = p.prop_id AND x.template = s.template)""")
def prj_with_template(e):
    tagged = (criteria.apply(e.facts, {"prop_stts_code": "F"}).withColumn("template", F.lit("Award"))
              .unionByName(e.facts.filter("bas_rsch_pct < 1").withColumn("template", F.lit("Decline"))))
    return selection.expand(tagged, e.facts, ["template"]).select("lead_prop_id", "prop_id", "template")


@query("prj_totals", """
WITH b AS (SELECT prop_id, revn_num, CAST(CAST(sum(CAST(budg_tot_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS t FROM v_budg x
  WHERE NOT EXISTS (SELECT 1 FROM v_budg y WHERE y.prop_id = x.prop_id AND y.revn_num > x.revn_num) GROUP BY prop_id, revn_num)
SELECT p.lead, CAST(CAST(sum(CAST(p.rqst_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS rqst_tot, CAST(CAST(sum(CAST(b.t AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS budg_tot, max(b.revn_num) AS "budRevnMax"
FROM v_prj p LEFT JOIN b ON b.prop_id = p.prop_id GROUP BY p.lead""")
def prj_totals(e):
    return selection.project_totals(selection.with_project(e.facts), budgets.totals(e.budg, {}))


@query("prj_counts", """
SELECT lead, count(*) AS "nProp", CAST(sum(1 + (SELECT count(*) FROM v_copi c WHERE c.prop_id = p.prop_id)) AS BIGINT) AS "nPI",
  (SELECT count(*) FROM v_panl_prop pp WHERE pp.prop_id = p.lead) AS "nPanl", (SELECT max(panl_id) FROM v_panl_prop pp WHERE pp.prop_id = p.lead) AS "panl_idmax"
FROM v_prj p GROUP BY lead""")
def prj_counts(e):
    return selection.project_counts(selection.with_project(e.facts), e.copi, e.panl_prop)
