"""Filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import criteria
from ..operators import children
from ..sources import sinks
from ..plans import stages
from ..sources.inputs import id_prefix
from .registry import query

SPECS = {"pgm_ele_code": "'1-URGENT', \"2-HIGH\",3-MEDIUM", "natr_rqst_code": "~BUILDING", "org_code": "1[0-3]%",
         "prop_titl_txt": "%study%", "prop_stts_code": "F::O", "orig_pgm_ele_code": "eg:5-LOW", "pi_id": "~10::40"}


@query("flt_criteria", """
SELECT prop_id FROM v_prop WHERE pgm_ele_code IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND NOT (natr_rqst_code = 'BUILDING')
AND substr(org_code, 1, 2) IN ('10', '11', '12', '13') AND contains(prop_titl_txt, 'study') AND prop_stts_code >= 'F' AND prop_stts_code <= 'O'
AND (pi_id < 10 OR pi_id > 40)""")
def flt_criteria(e):
    return criteria.apply(e.prop, SPECS, integers=("pi_id",)).select("prop_id")


@query("flt_like_class", "SELECT prop_id, org_code FROM v_prop WHERE substr(org_code, 2, 1) IN ('0', '1', '4') AND substr(org_code, 8, 1) <> '5'")
def flt_like_class(e):
    return e.prop.filter(criteria.like(F.col("org_code"), "1[014]%[^5]")).select("prop_id", "org_code")


@query("flt_dim", """SELECT p.prop_id, p.org_code FROM v_prop p JOIN v_org o ON o.org_code = p.org_code WHERE o.dir_div_abbr LIKE 'NATION_1%'""")
def flt_dim(e):
    kept = children.by_dimension(e.prop, e.org, "org_code", "dir_div_abbr", "NATION[_]1%")
    return children.by_dimension(kept, e.inst, "inst_id", "st_code", "eg:S1").select("prop_id", "org_code")


@query("flt_attr_any", """SELECT p.prop_id FROM v_prop p WHERE EXISTS (SELECT 1 FROM v_atr a WHERE a.prop_id = p.prop_id AND a.prop_atr_code IN ('0005', '0007', '0041'))""")
def flt_attr_any(e):
    return children.by_codes(e.facts, e.atr, "prop_atr_code", "0005,0007,0041").select("prop_id")


@query("flt_attr_none", """SELECT p.prop_id FROM v_prop p WHERE NOT EXISTS (SELECT 1 FROM v_atr a WHERE a.prop_id = p.prop_id AND a.prop_atr_code BETWEEN '0005' AND '0020')""")
def flt_attr_none(e):
    return children.by_codes(e.facts, e.atr, "prop_atr_code", "~0005::0020").select("prop_id")


@query("flt_attr_other", """SELECT DISTINCT p.prop_id FROM v_prop p JOIN v_atr a ON a.prop_id = p.prop_id WHERE NOT (a.prop_atr_code LIKE '00%1')""")
def flt_attr_other(e):
    return children.other_child(e.facts, e.atr, criteria.positive(F.col("prop_atr_code"), "00%1")).select("prop_id")


@query("flt_date_range", """SELECT prop_id, received_date FROM v_prop WHERE received_date >= TIMESTAMP '1996-02-01' AND received_date <= TIMESTAMP '1999-06-30' AND dd_rcom_date <= TIMESTAMP '1999-07-15'""")
def flt_date_range(e):
    return (stages.date_range(stages.date_range(e.facts, "received_date", "1996-02-01", "1999-06-30"), "dd_rcom_date", None, "1999-07-15")
            .select("prop_id", "received_date"))


@query("flt_date_day_inclusive", """SELECT prop_id, received_date FROM v_prop WHERE received_date BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-07-01'""")
def flt_date_day_inclusive(e):
    end = F.lit("1998-06-30").cast("timestamp_ntz") + F.make_dt_interval(F.lit(1))
    return e.facts.filter(F.col("received_date").between(F.lit("1997-01-01").cast("timestamp_ntz"), end)).select(
        "prop_id", "received_date")


@query("flt_guard_empty", """
SELECT 'blank' AS spec, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'example', 0
UNION ALL SELECT 'real', count(*) FROM v_prop WHERE prop_stts_code <> 'F'""")
def flt_guard_empty(e):
    """No restriction selects nothing, never the whole table."""
    specs = {"blank": {"org_code": "", "prop_stts_code": None}, "example": {"org_code": "eg: 10%"},
             "real": {"org_code": " ", "prop_stts_code": "~F"}}
    parts = [criteria.apply(e.prop, s).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("spec"), "n")
             for name, s in specs.items()]
    return reduce(DataFrame.unionByName, parts)


@query("flt_route", """
SELECT p.prop_id FROM v_prop p WHERE p.prop_id IN (SELECT s.prop_id FROM v_subm s JOIN v_route r ON r.temp_prop_id = s.temp_prop_id WHERE r.code IN ('R2', 'R5'))""")
def flt_route(e):
    routed = e.subm.join(e.route.filter(criteria.predicate("code", "R2,R5")).select("temp_prop_id"),
                         "temp_prop_id", "left_semi")
    return e.facts.join(routed.select("prop_id"), "prop_id", "left_semi").select("prop_id")


@query("flt_primary_row", """
SELECT q.prop_id, q.pi_id, q.pers, pi.pi_last_name, CASE WHEN pi.pi_id IS NULL THEN 0 ELSE 1 END AS kept_by_where
FROM v_person q LEFT JOIN v_pi pi ON pi.pi_id = q.pi_id AND pi.prim_addr_flag = 'Y'""")
def flt_primary_row(e):
    """One address per person: in the join condition it keeps people without one, as a filter not."""
    address = e.pi_primary.select("pi_id", "pi_last_name", F.lit(1).alias("_found"))
    return (e.person.join(address, "pi_id", "left")
            .select("prop_id", "pi_id", "pers", "pi_last_name", F.coalesce("_found", F.lit(0)).alias("kept_by_where")))


@query("flt_active_child", "SELECT awd_id, pi_id, proj_role_code FROM v_awd_pi WHERE end_date IS NULL")
def flt_active_child(e):
    return e.awd_pi.filter(F.col("end_date").isNull()).select("awd_id", "pi_id", "proj_role_code")


@query("flt_fiscal_prefix", """
SELECT prop_id, org_code FROM v_prop WHERE substr(format('{:07d}', prop_id), 1, 4) = '0000' AND regexp_matches(org_code, '^12')""")
def flt_fiscal_prefix(e):
    return e.prop.filter(id_prefix("prop_id", "0000") & F.col("org_code").startswith("12")).select("prop_id", "org_code")


@query("flt_precount", """SELECT count(*) AS num_retrieved, CASE WHEN count(*) > 300 THEN 1 ELSE 0 END AS warn FROM v_prop WHERE prop_stts_code = 'O'""")
def flt_precount(e):
    return sinks.large_selection(criteria.apply(e.facts, {"prop_stts_code": "O"}))
