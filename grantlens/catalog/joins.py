"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.ordered import cumulative, slots
from ..operators import awards, people, selection, splits
from ..plans import stages
from .registry import query
from .windows import MATCH, NAMED, PATTERNS, id_step, patterns


@query("jn_inner_dims", """
SELECT p.prop_id, o.dir_div_abbr AS "Div", d.dir_div_abbr AS "Dir", i.inst_shrt_name, i.st_code, pi.pi_last_name, c.c_mktsegment AS segment
FROM v_prop p, v_org o, v_org d, v_inst i, v_pi pi, customer c WHERE o.org_code = p.org_code AND d.org_code = concat(left(p.org_code, 2), '000000')
AND i.inst_id = p.inst_id AND pi.pi_id = p.pi_id AND pi.prim_addr_flag = 'Y' AND c.c_custkey = p.pi_id""")
def jn_inner_dims(e):
    rows = selection.base_rows(selection.with_project(e.prop), e.org, e.pi_primary, e.inst)
    segment = e.table("customer").select(F.col("c_custkey").alias("pi_id"), F.col("c_mktsegment").alias("segment"))
    return rows.join(segment, "pi_id").select("prop_id", "Div", "Dir", F.col("inst_name").alias("inst_shrt_name"), "st_code",
                                              "pi_last_name", "segment")


@query("jn_left", """SELECT v.revr_id, v.revr_last_name, i.inst_shrt_name FROM v_revr v LEFT JOIN v_inst i ON i.inst_id = v.inst_id AND i.st_code <> 'S1'""")
def jn_left(e):
    right = e.inst.filter("st_code <> 'S1'").select("inst_id", "inst_shrt_name")
    return e.revr.join(right, "inst_id", "left").select("revr_id", "revr_last_name", "inst_shrt_name")


PANEL_ROWS = """pw AS (SELECT pp.prop_id, pp.panl_id, v.panl_bgn_date, r.rcom_seq_num, d.rcom_abbr, r.prop_ordr FROM v_panl_prop pp JOIN v_panl v ON v.panl_id = pp.panl_id
  LEFT JOIN v_rec r ON r.panl_id = pp.panl_id AND r.prop_id = pp.prop_id
  LEFT JOIN (SELECT DISTINCT panl_id, rcom_seq_num, rcom_abbr FROM v_rec) d ON d.panl_id = r.panl_id AND d.rcom_seq_num = r.rcom_seq_num)"""


@query("jn_legacy_outer", f"WITH {PANEL_ROWS} SELECT * FROM pw")
def jn_legacy_outer(e):
    return stages.panel_rows(e)


@query("jn_composite", """
SELECT s.prop_id, s.budg_yr, s.splt_id, round(s.budg_splt_tot_dol, 2) AS dol, k.pgm_ref_code FROM v_splt s
JOIN v_splt_code k ON k.prop_id = s.prop_id AND k.budg_yr = s.budg_yr AND k.splt_id = s.splt_id""")
def jn_composite(e):
    return (e.splt.select(*splits.KEY, F.round("budg_splt_tot_dol", 2).alias("dol")).join(e.splt_code, splits.KEY))


@query("jn_computed_key", """SELECT p.prop_id, o.dir_div_abbr AS "Dir" FROM v_prop p JOIN v_org o ON o.org_code = left(p.org_code, 2) || '000000'""")
def jn_computed_key(e):
    return (e.prop.select("prop_id", c.directorate_code("org_code").alias("org_code"))
            .join(e.org, "org_code").select("prop_id", F.col("dir_div_abbr").alias("Dir")))


@query("jn_name_triple", f"WITH {NAMED} SELECT prop_id, last_name, frst_name, inst_shrt_name FROM sr")
def jn_name_triple(e):
    new = people.candidates(e.senior, selection.with_project(e.prop), e.inst)
    return new.join(stages.investigators(e).select(*people.NAME), people.NAME, "left_anti").select(*people.NAME)


LAST_AWARD = """aw AS (SELECT pi_id, count(*) AS "NumAwd", max(strftime(awd_eff_date, '%Y.%m.%d') || ' ' || awd_id || '.' || proj_role_code) AS l FROM v_awd_pi
  WHERE awd_eff_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31' GROUP BY pi_id),
am AS (SELECT CAST(prop_id AS STRING) AS awd_id, CAST(CAST(CAST(sum(CAST(budg_splt_tot_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS DECIMAL(18,2)) AS amt FROM v_splt GROUP BY prop_id)"""


@query("jn_substring_key", f"""WITH {LAST_AWARD} SELECT aw.pi_id, CAST(am.awd_id AS BIGINT) AS awd_id, CAST(am.amt AS DOUBLE) AS awd_amt
FROM aw JOIN am ON am.awd_id = split_part(substr(aw.l, 12), '.', 1)""")
def jn_substring_key(e):
    """The latest award travels as a struct: no key is cut out of a text."""
    start, end = (F.lit(d).cast("timestamp_ntz") for d in stages.AWARD_WINDOW)
    latest = e.awd_pi.filter(F.col("awd_eff_date").between(start, end)).groupBy("pi_id").agg(
        F.max(F.struct("awd_eff_date", F.col("awd_id").cast("string"), "proj_role_code", F.col("awd_id").alias("id")))["id"].alias("awd_id"))
    return latest.join(awards.award_amounts(e.splt), "awd_id").withColumn("awd_amt", F.round("awd_amt", 2))


@query("jn_wildcard_null", f"WITH {PATTERNS} SELECT s.prop_id, s.budg_yr, s.splt_id FROM v_splt s JOIN pt ON {MATCH}")
def jn_wildcard_null(e):
    return splits.matching(e.splt, patterns(e)).select("prop_id", "budg_yr", "splt_id")


@query("jn_semi", "SELECT prop_id FROM v_prop p WHERE EXISTS (SELECT 1 FROM v_budg b WHERE b.prop_id = p.prop_id AND b.sub_ctr_dol > 1000)")
def jn_semi(e):
    return e.facts.select("prop_id").join(e.budg.filter("sub_ctr_dol > 1000").select("prop_id"), "prop_id", "left_semi")


@query("jn_anti", "SELECT prop_id FROM v_prop WHERE prop_id NOT IN (SELECT prop_id FROM v_panl_prop)")
def jn_anti(e):
    return e.facts.select("prop_id").join(e.panl_prop.select("prop_id"), "prop_id", "left_anti")


@query("jn_anti_double", """
SELECT c_custkey AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM v_copi c WHERE c.pi_id = c_custkey)
AND NOT EXISTS (SELECT 1 FROM v_prop p WHERE p.pi_id = c_custkey AND p.prop_stts_code = 'F')""")
def jn_anti_double(e):
    return (e.table("customer").select(F.col("c_custkey").alias("id"))
            .join(e.copi.select(F.col("pi_id").alias("id")), "id", "left_anti")
            .join(e.facts.filter("prop_stts_code = 'F'").select(F.col("pi_id").alias("id")), "id", "left_anti"))


@query("jn_anti_range", """
SELECT DISTINCT p.inst_id FROM v_prop p WHERE p.prop_stts_code = 'P'
AND NOT EXISTS (SELECT 1 FROM v_awd a WHERE a.inst_id = p.inst_id AND a.awd_exp_date >= DATE '2009-02-20' - INTERVAL 58 MONTH)""")
def jn_anti_range(e):
    return stages.new_institutions(e.prop, e.awd)


@query("jn_self_rank", """
SELECT panl_id, revr_id, prop_id, (SELECT count(*) FROM v_confl d WHERE d.panl_id = c.panl_id AND d.revr_id = c.revr_id AND d.prop_id <= c.prop_id) AS seq FROM v_confl c""")
def jn_self_rank(e):
    places = cumulative(e.confl, ["panl_id", "revr_id"], "prop_id", id_step("prop_id"))
    return places.select("panl_id", "revr_id", "prop_id", F.col("n_le").alias("seq"))


@query("jn_post_agg_ne", """
WITH b AS (SELECT revr_id, count(*) AS n FROM v_rev WHERE rev_type_code <> 'R' GROUP BY revr_id),
a AS (SELECT revr_id, count(*) AS n_all, max(rev_rtrn_date) AS latest_all FROM v_rev WHERE rev_stts_code <> 'D' AND (rev_type_code <> 'R' OR revr_id % 2 = 0) GROUP BY revr_id)
SELECT b.revr_id, b.n, a.n_all, a.latest_all FROM b LEFT JOIN a ON a.revr_id = b.revr_id AND a.n_all <> b.n""")
def jn_post_agg_ne(e):
    b = e.rev.filter("rev_type_code <> 'R'").groupBy("revr_id").agg(F.count(F.lit(1)).alias("n"))
    a = (e.rev.filter("rev_stts_code <> 'D' AND (rev_type_code <> 'R' OR revr_id % 2 = 0)")
         .groupBy(F.col("revr_id").alias("_r")).agg(F.count(F.lit(1)).alias("n_all"), F.max("rev_rtrn_date").alias("latest_all")))
    return b.join(a, (F.col("_r") == F.col("revr_id")) & (F.col("n_all") != F.col("n")), "left").drop("_r")


@query("jn_self_slots", """
WITH s AS (SELECT prop_id, panl_id, rcom_abbr, prop_ordr, row_number() OVER (PARTITION BY prop_id ORDER BY panl_id) - 1 AS seq FROM v_rec)
SELECT q.prop_id, a.panl_id AS panl0, a.rcom_abbr AS rec0, a.prop_ordr AS rank0, b.panl_id AS panl1, b.rcom_abbr AS rec1, b.prop_ordr AS rank1,
  c.panl_id AS panl2, c.rcom_abbr AS rec2, c.prop_ordr AS rank2 FROM (SELECT DISTINCT prop_id FROM v_rec) q
LEFT JOIN s a ON a.prop_id = q.prop_id AND a.seq = 0 LEFT JOIN s b ON b.prop_id = q.prop_id AND b.seq = 1 LEFT JOIN s c ON c.prop_id = q.prop_id AND c.seq = 2""")
def jn_self_slots(e):
    return slots(e.rec, ["prop_id"], [F.col("panl_id")], {"panl": "panl_id", "rec": "rcom_abbr", "rank": "prop_ordr"}, 3)
