"""Positions, project numbers, comparisons with the lead, wide slots; sort and top n; set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.ordered import cumulative, running_number
from ..operators import awards, selection, splits
from ..plans import stages
from .registry import query

ID_STEP = 12  # ids are stepped by 4096


def id_step(col: str):
    return F.shiftright(F.col(col), ID_STEP)


@query("win_seq", """SELECT prop_id, prop_atr_code, (SELECT count(*) FROM v_atr b WHERE b.prop_id = a.prop_id AND b.prop_atr_code < a.prop_atr_code) AS seq FROM v_atr a""")
def win_seq(e):
    places = cumulative(stages.codes_of(e.atr), ["prop_id"], "prop_atr_code", F.substring("prop_atr_code", 1, 3))
    return places.select("prop_id", "prop_atr_code", F.col("n_lt").alias("seq"))


@query("win_rank_le", """SELECT revr_id, prop_id, count(*) OVER (PARTITION BY revr_id ORDER BY prop_id RANGE UNBOUNDED PRECEDING) AS pos FROM v_confl""")
def win_rank_le(e):
    """Ties (the same proposal on several panels) share the higher position."""
    places = cumulative(e.confl, ["revr_id"], "prop_id", id_step("prop_id"))
    return e.confl.select("revr_id", "prop_id").join(places.select("revr_id", "prop_id", F.col("n_le").alias("pos")), ["revr_id", "prop_id"])


@query("win_rank_lt", """SELECT revr_id, rev_due_date, CAST(rank() OVER (PARTITION BY revr_id ORDER BY rev_due_date) - 1 AS BIGINT) AS pos, prop_id FROM v_rev""")
def win_rank_lt(e):
    places = cumulative(e.rev, ["revr_id"], "rev_due_date", F.trunc("rev_due_date", "month"))
    return e.rev.select("revr_id", "rev_due_date", "prop_id").join(
        places.select("revr_id", "rev_due_date", F.col("n_lt").alias("pos")), ["revr_id", "rev_due_date"])


@query("win_project_no", """
SELECT prop_id, lead, CAST(sum(CASE WHEN "ILN" < 'M' THEN 1 ELSE 0 END) OVER (ORDER BY lead, "ILN", prop_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS project_no,
dense_rank() OVER (ORDER BY lead) AS key_no FROM v_prj""")
def win_project_no(e):
    """Running project number: one more at every project head, or at every change of the lead."""
    rows = stages.projects(e).select("prop_id", "lead", "ILN")
    numbers = {"project_no": F.sum(c.flag(c.heads_project())), "key_no": F.max(F.lit(1))}
    return running_number(rows, "lead", numbers).select("prop_id", "lead", "project_no", "key_no")


@query("win_differs_prev", """
SELECT prop_id, lead, """ + ", ".join(
    f"CASE WHEN \"ILN\" = 'N' AND {x} <> first_value({x}) OVER (PARTITION BY lead ORDER BY \"ILN\", prop_id) THEN 1 ELSE 0 END AS dif_{x}" for x in stages.COMPARED) + " FROM v_prj")
def win_differs_prev(e):
    return stages.differs_from_lead(selection.with_project(e.prop)).select("prop_id", "lead", *[f"dif_{x}" for x in stages.COMPARED])


@query("win_first_of_group", """
SELECT prop_id, budg_yr, splt_id, CASE WHEN lag(prop_id) OVER (ORDER BY prop_id, budg_yr, splt_id) = prop_id THEN 0 ELSE 1 END AS is_first FROM v_splt""")
def win_first_of_group(e):
    first = e.splt.groupBy("prop_id").agg(F.min(F.struct("budg_yr", "splt_id")).alias("_f"))
    return e.splt.join(first, "prop_id").select(
        "prop_id", "budg_yr", "splt_id", c.flag(F.struct("budg_yr", "splt_id") == F.col("_f")).alias("is_first"))


def _slot_sql(fields: dict[str, str], k: int, pattern: str = "{f}{i}") -> str:
    return ", ".join(f"max(CASE n WHEN {i + 1} THEN {x} END) AS \"{pattern.format(f=f, i=i)}\"" for i in range(k) for f, x in fields.items())


@query("win_slots_panels", f"""
WITH s AS (SELECT p.lead, r.*, v.panl_name, v.panl_end_date, row_number() OVER (PARTITION BY p.lead ORDER BY v.panl_end_date, v.panl_id) AS n
  FROM v_prj p JOIN v_rec r ON r.prop_id = p.lead JOIN v_panl v ON v.panl_id = r.panl_id WHERE p."ILN" < 'M')
SELECT lead, {_slot_sql(stages.PANEL_FIELDS, 3)} FROM s GROUP BY lead""")
def win_slots_panels(e):
    return stages.panel_slots(e)


# the budget of the latest revision and the code string, for the checks
LATEST = """lb AS (SELECT prop_id, revn_num, CAST(CAST(sum(CAST(budg_tot_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS t, CAST(sum(CAST(sub_ctr_dol AS DECIMAL(18, 4))) AS DOUBLE) AS sub_ctr, CAST(sum(CAST(cnsl_dol AS DECIMAL(18, 4))) AS DOUBLE) AS cnsl, CAST(sum(CAST(cptr_serv_dol AS DECIMAL(18, 4))) AS DOUBLE) AS cptr, CAST(sum(CAST(frgn_trav_dol AS DECIMAL(18, 4))) AS DOUBLE) AS frgn, CAST(sum(CAST(pdoc_grnt_dol AS DECIMAL(18, 4))) AS DOUBLE) AS pdoc, CAST(sum(CAST(part_dol AS DECIMAL(18, 4))) AS DOUBLE) AS part_d, CAST(sum(CAST(part_cnt AS DECIMAL(18, 4))) AS DOUBLE) AS part, CAST(sum(CAST(grad_pers_tot_cnt AS DECIMAL(18, 4))) AS DOUBLE) AS grad, CAST(sum(CAST(sr_pers_cnt AS DECIMAL(18, 4))) AS DOUBLE) AS sr, CAST(sum(CAST(sr_summ_mnth_cnt AS DECIMAL(18, 4))) AS DOUBLE) AS sr_summ, CAST(sum(CAST(sr_acad_mnth_cnt AS DECIMAL(18, 4))) AS DOUBLE) AS sr_acad, CAST(sum(CAST(sr_cal_mnth_cnt AS DECIMAL(18, 4))) AS DOUBLE) AS sr_cal FROM v_budg x
  WHERE NOT EXISTS (SELECT 1 FROM v_budg y WHERE y.prop_id = x.prop_id AND y.revn_num > x.revn_num) GROUP BY prop_id, revn_num)"""
CODES = """cd AS (SELECT prop_id, substr(string_agg(prop_atr_code, ' ' ORDER BY prop_atr_code), 1, 35) AS "R" FROM (
  SELECT *, row_number() OVER (PARTITION BY prop_id ORDER BY prop_atr_code) AS n FROM v_atr) WHERE n <= 11 GROUP BY prop_id)"""


@query("win_slots_props", f"""
WITH {LATEST}, {CODES}, s AS (SELECT p.lead, p.prop_id, pi.pi_last_name, pi.pi_frst_name, i.inst_shrt_name, p.rqst_dol, round(lb.t, 2) AS t, cd."R" AS r,
  row_number() OVER (PARTITION BY p.lead ORDER BY p."ILN", p.prop_id) AS n FROM v_prj p LEFT JOIN v_pi pi ON pi.pi_id = p.pi_id AND pi.prim_addr_flag = 'Y'
  LEFT JOIN v_inst i ON i.inst_id = p.inst_id LEFT JOIN lb ON lb.prop_id = p.prop_id LEFT JOIN cd ON cd.prop_id = p.prop_id)
SELECT lead, {_slot_sql(dict(stages.PROP_FIELDS, btot='t', PRC='r'), 7)} FROM s GROUP BY lead""")
def win_slots_props(e):
    return stages.proposal_slots(e)


PEOPLE = """pr AS (SELECT p."ILN", p.lead, p.prop_id, p.pi_id FROM v_prj p UNION ALL SELECT 'P', p.lead, p.prop_id, c.pi_id FROM v_prj p JOIN v_copi c ON c.prop_id = p.prop_id),
aw AS (SELECT pi_id, count(*) AS "NumAwd", max(strftime(awd_eff_date, '%Y.%m.%d') || ' ' || awd_id || '.' || proj_role_code) AS l FROM v_awd_pi
  WHERE awd_eff_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31' GROUP BY pi_id),
am AS (SELECT CAST(prop_id AS STRING) AS awd_id, CAST(CAST(CAST(sum(CAST(budg_splt_tot_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS DECIMAL(18,2)) AS amt FROM v_splt GROUP BY prop_id),
ai AS (SELECT aw.pi_id, aw."NumAwd", aw.l || ' $' || am.amt AS "LastAwd" FROM aw JOIN am ON am.awd_id = split_part(substr(aw.l, 12), '.', 1)),
ps AS (SELECT pr.*, pi.pi_last_name, pi.pi_emai_addr, i.inst_shrt_name, ai."NumAwd", ai."LastAwd",
  row_number() OVER (PARTITION BY pr.lead ORDER BY pr."ILN", ai."NumAwd" DESC NULLS LAST, pr.prop_id, pr.pi_id) AS n
  FROM pr JOIN v_pi pi ON pi.pi_id = pr.pi_id AND pi.prim_addr_flag = 'Y' LEFT JOIN v_inst i ON i.inst_id = pi.inst_id LEFT JOIN ai ON ai.pi_id = pr.pi_id)"""


@query("win_slots_people", f"""WITH {PEOPLE} SELECT lead, {_slot_sql(stages.PEOPLE_FIELDS, 10, 'pi{i}_{f}')} FROM ps GROUP BY lead""")
def win_slots_people(e):
    return stages.people_slots(stages.people_rows(e))


# --- sort, limit, top-k --------------------------------------------------------------------


@query("top_n", "SELECT prop_id, revr_id, rev_rtrn_date FROM v_rev WHERE rev_rtrn_date IS NOT NULL ORDER BY rev_rtrn_date DESC, prop_id, revr_id LIMIT 10")
def top_n(e):
    return (e.rev.filter(F.col("rev_rtrn_date").isNotNull()).select("prop_id", "revr_id", "rev_rtrn_date")
            .orderBy(F.col("rev_rtrn_date").desc(), "prop_id", "revr_id").limit(10))


@query("top_then_enrich", """
WITH t AS (SELECT revr_id, count(*) AS "nProp" FROM v_rev WHERE rev_stts_code <> 'C' AND rev_rtrn_date IS NOT NULL GROUP BY revr_id ORDER BY "nProp" DESC, revr_id LIMIT 20)
SELECT t.revr_id, v.revr_last_name, v.revr_frst_name, i.inst_shrt_name, t."nProp" FROM t JOIN v_revr v ON v.revr_id = t.revr_id LEFT JOIN v_inst i ON i.inst_id = v.inst_id""")
def top_then_enrich(e):
    top = (stages.returned(e.rev).groupBy("revr_id").agg(F.count("prop_id").alias("nProp"))
           .orderBy(F.col("nProp").desc(), "revr_id").limit(20))
    return (e.revr.join(F.broadcast(top), "revr_id")  # 20 rows
            .join(e.inst.select("inst_id", "inst_shrt_name"), "inst_id", "left")
            .select("revr_id", "revr_last_name", "revr_frst_name", "inst_shrt_name", "nProp"))


@query("top_row_limit", """SELECT lead, "ILN", prop_id, rqst_dol FROM v_prj ORDER BY lead, "ILN", prop_id LIMIT 300""")
def top_row_limit(e):
    report = selection.with_project(e.facts).select("lead", "ILN", "prop_id", "rqst_dol")
    return stages.limited(report, 300, ["lead", "ILN", "prop_id"])


@query("ord_project", """SELECT lead, "ILN", prop_id, prop_titl_txt FROM v_prj ORDER BY lead, "ILN", prop_id""")
def ord_project(e):
    return selection.with_project(e.prop).select("lead", "ILN", "prop_id", "prop_titl_txt").orderBy("lead", "ILN", "prop_id")


# --- set operations ------------------------------------------------------------------------


@query("set_union_all", """
SELECT doc_id AS prop_id, 'Doc' AS kind, source AS author, length(text) AS len FROM documents
UNION ALL SELECT conv_id, 'Conv', role, length(text) FROM conversations UNION ALL SELECT page_id, 'Page', url, length(html) FROM pages""")
def set_union_all(e):
    def part(table, key, kind, author, text):
        return e.table(table).select(F.col(key).alias("prop_id"), F.lit(kind).alias("kind"), F.col(author).alias("author"),
                                     F.length(text).cast("long").alias("len"))

    return (part("documents", "doc_id", "Doc", "source", "text")
            .unionByName(part("conversations", "conv_id", "Conv", "role", "text"))
            .unionByName(part("pages", "page_id", "Page", "url", "html")))


@query("set_union_distinct", """
SELECT lead, prop_id, pi_id FROM v_prj UNION SELECT p.lead, p.prop_id, c.pi_id FROM v_prj p JOIN v_copi c ON c.prop_id = p.prop_id""")
def set_union_distinct(e):
    return awards.investigator_pairs(selection.with_project(e.prop), e.copi)


NAMED = """iv AS (SELECT p.prop_id, p."ILN", ' PI' AS pers, pi.pi_last_name AS last_name, pi.pi_frst_name AS frst_name, i.inst_shrt_name FROM v_prj p JOIN v_pi pi ON pi.pi_id = p.pi_id AND pi.prim_addr_flag = 'Y' JOIN v_inst i ON i.inst_id = p.inst_id
  UNION ALL SELECT p.prop_id, p."ILN", 'coPI', pi.pi_last_name, pi.pi_frst_name, i.inst_shrt_name FROM v_prj p JOIN v_copi c ON c.prop_id = p.prop_id JOIN v_pi pi ON pi.pi_id = c.pi_id AND pi.prim_addr_flag = 'Y' JOIN v_inst i ON i.inst_id = pi.inst_id),
sr AS (SELECT DISTINCT p.prop_id, p."ILN", 'srPers' AS pers, s.last_name, s.frst_name, i.inst_shrt_name FROM v_prj p JOIN v_senior s ON s.prop_id = p.prop_id JOIN v_inst i ON i.inst_id = s.inst_id
  WHERE NOT EXISTS (SELECT 1 FROM iv x WHERE x.prop_id = s.prop_id AND x.last_name = s.last_name AND x.frst_name = s.frst_name AND x.inst_shrt_name = i.inst_shrt_name))"""


@query("set_insert_new", f"""WITH {NAMED} SELECT prop_id, pers, last_name, frst_name, inst_shrt_name FROM iv UNION ALL SELECT prop_id, pers, last_name, frst_name, inst_shrt_name FROM sr""")
def set_insert_new(e):
    return stages.with_seniors(e).select("prop_id", "pers", "last_name", "frst_name", "inst_shrt_name")


PATTERNS = """pt AS (SELECT prop_id, CASE WHEN prop_id % 2 = 0 THEN 1996 + CAST(abs(prop_id) % 4 AS INT) END AS budg_yr, CASE WHEN prop_id % 3 = 0 THEN '2' END AS splt_id FROM v_idlist)"""
MATCH = "pt.prop_id = s.prop_id AND ifnull(pt.budg_yr, s.budg_yr) = s.budg_yr AND ifnull(pt.splt_id, s.splt_id) = s.splt_id"


def patterns(e):
    """Pattern rows made from the id list: some without year, some without split."""
    p = F.col("prop_id")
    return e.idlist.select(p, F.when(p % 2 == 0, (1996 + F.abs(p) % 4).cast("int")).alias("budg_yr"),
                           F.when(p % 3 == 0, "2").alias("splt_id"))


@query("set_delete_matching", f"""WITH {PATTERNS} SELECT s.prop_id, s.budg_yr, s.splt_id FROM v_splt s WHERE NOT EXISTS (SELECT 1 FROM pt WHERE {MATCH})""")
def set_delete_matching(e):
    return splits.without(e.splt, patterns(e)).select("prop_id", "budg_yr", "splt_id")


@query("set_distinct", "SELECT pgm_ele_code, natr_rqst_code, prop_stts_code FROM v_prop GROUP BY pgm_ele_code, natr_rqst_code, prop_stts_code")
def set_distinct(e):
    return e.prop.select("pgm_ele_code", "natr_rqst_code", "prop_stts_code").distinct()
