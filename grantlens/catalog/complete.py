"""Complete lists: every item of a key with its position, where reports show only the first ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ordered import chunked, numbered
from ..operators import budgets, selection
from ..plans import stages
from .registry import query
from .strings import ASSESSED


def _sql(source: str, keys: str, items: str) -> str:
    return f"SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY {', '.join(f'{i} NULLS FIRST' for i in items.split(', '))}) AS position, {items} FROM ({source}) q"


_CODES = "SELECT DISTINCT prop_id, prop_atr_code FROM v_atr WHERE prop_atr_type_code = 'PRC'"


@query("all_codes", _sql(_CODES, "prop_id", "prop_atr_code"))
def all_codes(e):
    return numbered(stages.codes_of(e.atr), ["prop_id"], ["prop_atr_code"], F.substring("prop_atr_code", 1, 3))


@query("all_codes_text", f"""
SELECT prop_id, (n - 1) // 3 AS chunk, string_agg(prop_atr_code, ' ' ORDER BY n) AS joined FROM (SELECT *, row_number() OVER (PARTITION BY prop_id ORDER BY prop_atr_code) AS n FROM ({_CODES})) GROUP BY ALL""")
def all_codes_text(e):
    """The codes of a proposal as text, three a chunk."""
    return chunked(all_codes(e), ["prop_id"], F.col("prop_atr_code"), " ", 3)


@query("all_split_codes", _sql("SELECT * FROM v_splt_code", "prop_id, splt_id, budg_yr", "pgm_ref_code"))
def all_split_codes(e):
    return numbered(e.splt_code, ["prop_id", "splt_id", "budg_yr"], ["pgm_ref_code"], F.substring("pgm_ref_code", 1, 3))


@query("all_routing", _sql("SELECT b.prop_id, r.sequence, r.code FROM v_route r JOIN v_subm b ON b.temp_prop_id = r.temp_prop_id", "prop_id", "sequence, code"))
def all_routing(e):
    rows = e.subm.select("prop_id", "temp_prop_id").join(e.route, "temp_prop_id")
    return numbered(rows, ["prop_id"], ["sequence", "code"], F.floor(F.col("sequence") / 64))


@query("all_countries", _sql("SELECT b.prop_id, c.ctry_name FROM v_subm b JOIN v_item i ON i.temp_prop_id = b.temp_prop_id JOIN v_ctry c ON c.ctry_code = i.spcl_item_code WHERE i.end_date IS NULL",
                             "prop_id", "ctry_name"))
def all_countries(e):
    return numbered(stages.country_rows(e), ["prop_id"], ["ctry_name"], F.substring("ctry_name", 1, 2))


@query("all_panels", _sql('SELECT p.lead, v.panl_end_date, r.panl_id, v.panl_name, r.rcom_seq_num, r.rcom_abbr, r.prop_ordr FROM v_rec r JOIN v_prj p ON p.prop_id = r.prop_id AND p."ILN" < \'M\' JOIN v_panl v ON v.panl_id = r.panl_id',
                          "lead", "panl_end_date, panl_id, panl_name, rcom_seq_num, rcom_abbr, prop_ordr"))
def all_panels(e):
    """Every panel of a project with its recommendation."""
    rows = (e.rec.join(stages.heads(e), "prop_id", "left_semi").withColumnRenamed("prop_id", "lead")
            .join(e.panl.select("panl_id", "panl_name", "panl_end_date"), "panl_id"))
    return numbered(rows, ["lead"], ["panl_end_date", "panl_id", "panl_name", "rcom_seq_num", "rcom_abbr", "prop_ordr"], F.date_trunc("month", "panl_end_date"))


@query("all_members", _sql('SELECT lead, "ILN" AS iln, prop_id FROM v_prj', "lead", "iln, prop_id"))
def all_members(e):
    """Every proposal of a project, its head first."""
    rows = selection.with_project(e.keys).select("lead", F.col("ILN").alias("iln"), "prop_id")
    return numbered(rows, ["lead"], ["iln", "prop_id"], F.struct("iln", F.floor(F.col("prop_id") / 4096)))


@query("all_ratings", f"WITH {ASSESSED} " + _sql("SELECT lead, -score AS below, revr_id, string FROM rv WHERE confl = 0", "lead", "below, revr_id, string"))
def all_ratings(e):
    """Every rating of a project, best first; reviews without a score come first."""
    rows = stages.lead_reviews(e).filter("confl = 0").select("lead", (-F.col("score")).alias("below"), "revr_id", "string")
    return numbered(rows, ["lead"], ["below", "revr_id", "string"], F.struct("below", F.floor(F.col("revr_id") / 4096)))


@query("all_conflicts", _sql("SELECT panl_id, revr_id, prop_id FROM v_confl", "panl_id, revr_id", "prop_id"))
def all_conflicts(e):
    """Every proposal that a panelist may not judge."""
    return numbered(e.confl, ["panl_id", "revr_id"], ["prop_id"], F.floor(F.col("prop_id") / 4096))


@query("all_outcomes", "SELECT r.panl_id, r.rcom_seq_num, r.rcom_abbr, count(r.prop_id) AS n FROM v_rec r JOIN v_prj p ON p.prop_id = r.prop_id AND p.lead = p.prop_id GROUP BY 1, 2, 3")
def all_outcomes(e):
    """Projects per panel and recommendation, whatever recommendations there are."""
    leads = stages.projects(e).filter("lead = prop_id").select("prop_id")
    return e.rec.join(leads, "prop_id", "left_semi").groupBy("panl_id", "rcom_seq_num", "rcom_abbr").agg(F.count("prop_id").alias("n"))


@query("all_budget_years", """
SELECT prop_id, revn_num, budg_seq_yr, count(*) AS n, CAST(sum(CAST(budg_tot_dol AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS dol FROM v_budg x
WHERE revn_num = (SELECT max(revn_num) FROM v_budg y WHERE y.prop_id = x.prop_id) GROUP BY ALL""")
def all_budget_years(e):
    """Every year of the latest revision, the seventh and later ones too."""
    return budgets.latest_revision(e.budg).groupBy("prop_id", "revn_num", "budg_seq_yr").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("budg_tot_dol").cast("decimal(18,2)")).alias("dol"))
