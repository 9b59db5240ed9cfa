"""Stages shared by the reports. Each takes the entities and returns a lazy DataFrame."""

from __future__ import annotations

from copy import copy

from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions import text
from ..functions.ordered import ordered_concat, padded_concat, placed_concat, slots
from ..functions import criteria
from ..operators import awards, budgets, cube, documents, panels, people, reviews, selection
from ..sources import sinks

COMPARED = ["org_code", "pgm_ele_code", "natr_rqst_code", "prop_titl_txt"]
AWARD_WINDOW = ("1996-01-01", "2000-12-31")
AS_OF = "2009-02-20"
CUBE_TABLES = ["orders", "customer", "nation", "region"]
PANEL_FIELDS = {"panl_id": "panl_id", "panl_name": "panl_name", "panl_end": "panl_end_date", "rec_seq": "rcom_seq_num", "rec": "rcom_abbr", "rank": "prop_ordr"}
PROP_FIELDS = {"prop_id": "prop_id", "last": "pi_last_name", "frst": "pi_frst_name", "inst": "inst_shrt_name", "rqst": "rqst_dol", "btot": "T", "PRC": "R"}
PEOPLE_FIELDS = {"last_name": "pi_last_name", "email": "pi_emai_addr", "inst": "inst_shrt_name", "num_awd": "NumAwd", "last_awd": "LastAwd"}


def with_head_panels(e):
    """The entities for reports on heads alone: the panels of proposals are staged, only of heads, as several branches read them and what is made of them."""
    own = copy(e)
    own.panl_prop = sinks.staged(e.panl_prop.join(heads(e), "prop_id", "left_semi").select(*e.panl_prop.columns))
    return own


AT_ITS_PROJECT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}  # rows of a project that are in one place are joined there, also by further keys


def credited_reviews(e):
    """The reviews of the heads with their panels, staged; the files hold projects together, so that aggregates by project combine before their shuffle."""
    return sinks.staged(lead_reviews(e, True), AT_ITS_PROJECT)


def codes_of(atr):
    return atr.filter("prop_atr_type_code = 'PRC'").select("prop_id", "prop_atr_code").distinct()


def codes_space(atr):
    return ordered_concat(codes_of(atr), ["prop_id"], [F.col("prop_atr_code")], "prop_atr_code", " ", 11, 35, "R")


def placed_codes(e, name):
    """Six codes at their stored places."""
    return placed_concat(e.atr_seq, ["prop_id"], "prop_atr_seq", "prop_atr_code", " ", 6, name)


def codes_comma(atr):
    return ordered_concat(codes_of(atr), ["prop_id"], [F.col("prop_atr_code")], F.rtrim("prop_atr_code"), ",", 7, name="PRCs")


def split_codes(splt_code):
    return ordered_concat(splt_code, ["prop_id", "splt_id", "budg_yr"], [F.col("pgm_ref_code")], F.rtrim("pgm_ref_code"),
                          " ", 11, name="bPRCs")


def projects(e):
    """prop_id, lead, ILN, rqst_dol of all proposals."""
    return selection.with_project(e.keys).drop("lead_prop_id")


def heads(e):
    """prop_id of the head of every project."""
    return selection.one_row_per_project(projects(e)).select("prop_id")


def lead_reviews(e, panels_too: bool = False):
    """Assessed reviews of the lead proposals, optionally with the panel they are credited to."""
    out = reviews.assessed(e.rev.join(heads(e), "prop_id", "left_semi"), e.rating)
    return reviews.with_panel(out, e.panl_prop, e.panl_revr) if panels_too else out


def short_reviews(e):
    """Rated, unconflicted reviews of the leads: the panel report's simpler choice."""
    rated = e.rating.select(F.col("yn").alias("rev_prop_rtng_ind"), "string", "score")
    return (e.rev.filter("rev_stts_code <> 'C'").join(heads(e), "prop_id", "left_semi").withColumnRenamed("prop_id", "lead")
            .join(rated, "rev_prop_rtng_ind"))


def country_rows(e):
    """Countries of a proposal, one a row."""
    return (e.subm.join(e.item.filter(F.col("end_date").isNull()), "temp_prop_id")
            .join(e.ctry.withColumnRenamed("ctry_code", "spcl_item_code"), "spcl_item_code"))


def countries(e):
    """The first eight countries of a proposal; `all_countries` lists them all."""
    return ordered_concat(country_rows(e), ["prop_id"], [F.col("ctry_name")], "ctry_name", "; ", 8, name="Country")


def routing(e):
    lists = padded_concat(e.route, ["temp_prop_id"], [F.col("sequence")], "code", " ", 4, "rout_PECs")
    return e.subm.join(lists, "temp_prop_id").select("prop_id", "rout_PECs")


def differs_from_lead(projects, compared=COMPARED):
    """0/1 per column: does a non-lead differ from the head of its project?

    The head is found by a minimum per lead, which is combined before the shuffle.
    """
    head = projects.groupBy("lead").agg(F.min(F.struct("ILN", "prop_id", *compared)).alias("_h"))
    joined = projects.join(head, "lead")
    return joined.select(*projects.columns, *[
        c.flag((F.col("ILN") == "N") & (F.col(x) != F.col(f"_h.{x}"))).alias(f"dif_{x}") for x in compared])


def panel_slots(e):
    rows = (e.rec.join(heads(e), "prop_id", "left_semi").withColumnRenamed("prop_id", "lead")
            .join(e.panl.select("panl_id", "panl_name", "panl_end_date"), "panl_id"))
    return slots(rows, ["lead"], [F.col("panl_end_date"), F.col("panl_id")], PANEL_FIELDS, 3)


def budget_totals(e):
    """Revision and total budget of every proposal, in cents; budget lines travel once where the entities offer them together."""
    together = getattr(e, "budg_together", None)
    sums = budgets.totals(e.budg, {}) if together is None else budgets.totals(together, {}, True)
    return sums.withColumn("T", F.round("T", 2))


def proposal_rows(e):
    """Every proposal with PI, institution, latest budget (RN, T) and code string (R)."""
    return (selection.with_project(e.prop)
            .join(e.pi_primary.select("pi_id", "pi_last_name", "pi_frst_name", "pi_emai_addr"), "pi_id", "left")
            .join(e.inst, "inst_id", "left")
            .join(budget_totals(e), "prop_id", "left")
            .join(codes_space(e.atr), "prop_id", "left"))


def proposal_slots(e, mail: bool = False):
    """Seven proposals of a project side by side, optionally with all their addresses as one text."""
    fields = {**PROP_FIELDS, "_mail": "pi_emai_addr"} if mail else PROP_FIELDS
    wide = slots(proposal_rows(e), ["lead"], [F.col("ILN"), F.col("prop_id")], fields, 7)
    if not mail:
        return wide
    each = [f"_mail{i}" for i in range(7)]
    return wide.withColumn("allPIemail", c.clip(F.concat_ws(";", *each), 255)).drop(*each)


def people_rows(e):
    """Investigators of whole projects with their awards."""
    rows = selection.expand_from_leads(selection.leads_of(e.prop), e.prop, e.copi)
    last = awards.last_award(e.awd_pi, awards.award_amounts(e.splt), *AWARD_WINDOW)
    return (rows.select("ILN", "lead", "prop_id", "pi_id")
            .join(e.pi_primary.select("pi_id", "pi_last_name", "pi_emai_addr", "inst_id"), "pi_id")
            .join(e.inst, "inst_id", "left").join(last, "pi_id", "left"))


def people_slots(rows):
    order = [F.col("ILN"), F.col("NumAwd").desc_nulls_last(), F.col("prop_id"), F.col("pi_id")]
    return slots(rows, ["lead"], order, PEOPLE_FIELDS, 10, pattern="pi{i}_{field}")


def investigators(e):
    return people.investigators(selection.with_project(e.prop), e.copi, e.pi_primary, e.inst)


def with_seniors(e):
    projects = selection.with_project(e.prop)
    return people.add_new(investigators(e), people.candidates(e.senior, projects, e.inst), "srPers")


def limited(report, limit=None, order=()):
    """Optional row limit of a report, taken in report order."""
    return report if limit is None else report.orderBy(*order).limit(limit)


def returned(rev):
    return rev.filter((F.col("rev_stts_code") != "C") & F.col("rev_rtrn_date").isNotNull())


def panel_rows(e):
    """Proposal on panel with begin date, and what the panel said where it said something."""
    said = e.rec.select("panl_id", "prop_id", "rcom_seq_num", "prop_ordr")
    return (e.panl_prop.join(e.panl.select("panl_id", "panl_bgn_date"), "panl_id")
            .join(said, ["panl_id", "prop_id"], "left")
            .join(e.rcom_def, ["panl_id", "rcom_seq_num"], "left"))


def new_institutions(prop, awd, as_of=AS_OF, months=58, status="P"):
    """Institutions of pending proposals without an award that ran within the last months."""
    cutoff = F.add_months(F.lit(as_of).cast("date"), -months).cast("timestamp_ntz")
    recent = awd.filter(F.col("awd_exp_date") >= cutoff).select("inst_id")
    pending = prop.filter(F.col("prop_stts_code") == status).select("inst_id").distinct()
    return pending.join(recent, "inst_id", "left_anti")


PORTFOLIO = ("pgm_annc_id", "pgm_ele_code", "natr_rqst_code", "obj_clas_code", "prop_stts_code")


def portfolio_counts(prop, kinds=("pgm_ele_code", "natr_rqst_code")):
    return prop.groupBy(F.substring("org_code", 1, 4).alias("Org"), *kinds).agg(
        F.count("prop_id").alias("Nprop"),
        F.sum(F.when(F.col("lead_prop_id") != F.col("prop_id"), 0).otherwise(1)).alias("Nproj"),
        c.money("rqst_dol").alias("SumRqstDol"))


def timed(e):
    return reviews.timed(e.rev, e.rating, e.rev_txt)


def title_totals(projects):
    return projects.groupBy("lead").agg(
        c.money("rqst_dol").alias("tot_rqst_dol"),
        c.yes(F.min("prop_titl_txt") != F.max("prop_titl_txt")).alias("dif_titl_collab"))


def adhoc_counters(rev):
    """Per proposal: ad hoc reviews asked and pending, their last due date, received, last due."""
    adhoc = F.col("rev_type_code") == "R"
    pending = adhoc & (F.col("rev_stts_code") == "P")
    return rev.groupBy("prop_id").agg(
        F.count_if(adhoc).alias("adhoc_reqd"), F.count_if(pending).alias("adhoc_pend"),
        F.max(F.when(pending, F.col("rev_due_date"))).alias("last_adhoc_due"),
        F.count_if(F.col("rev_stts_code") == "R").alias("revRcvd"), F.max("rev_due_date").alias("last_rev_due"))


def project_panel_rows(e, assessed, by_panel=None, outcomes=None):
    """Rows per (project, panel) with outcomes and conflicts, from the assessed reviews."""
    by_panel = reviews.by_panel(assessed) if by_panel is None else by_panel
    outcomes = panels.rated_outcomes(e.panl, e.rec, projects(e)) if outcomes is None else outcomes
    return panels.project_panels(by_panel, outcomes, panels.conflict_people(assessed, e.revr, e.inst), e.rec)


def release_check(e):
    """Unreleasable and unmarked counts per proposal, of reviews and of panel summaries."""
    said = e.rec.select("panl_id", "prop_id", "panl_summ_rlse_flag", "panl_summ_unrl_flag")
    released, unreleasable = F.col("panl_summ_rlse_flag") == "Y", F.col("panl_summ_unrl_flag") == "Y"
    summaries = e.panl_prop.join(said, ["panl_id", "prop_id"], "left").groupBy("prop_id").agg(
        F.count("panl_id").alias("Npanl"), c.zero_to_null(F.sum(c.flag(unreleasable))).alias("NpanlUnreleasable"),
        c.zero_to_null(F.sum(F.when(released | unreleasable, 0).otherwise(1))).alias("NpanlUnmarked"))
    return (e.facts.select("prop_id").join(reviews.release_counts(e.rev), "prop_id", "left")
            .join(summaries, "prop_id", "left"))


def review_summary(e):
    """Selection of heads, reconciled scores, statistics and the ratings string per project."""
    return reviews.summary(lead_reviews(e))


def narratives(e):
    """Narrative texts, one per proposal."""
    return e.table("documents").select(F.col("doc_id").alias("prop_id"), "source", "lang", "n_chars", "text")


def summaries(e):
    """Project summaries of three sections, or a note where the stored flag says that a PDF holds them."""
    return (narratives(e).withColumn("spcl_char_pdf", F.when(F.col("source").endswith("7"), "Y").otherwise("N"))
            .withColumn("summ", text.sections("spcl_char_pdf", "text", "lang", "source")))


def review_rows(e):
    """Rated reviews of the heads, without the text that is kept for the proposal."""
    rated = e.rev.join(heads(e), "prop_id", "left_semi").join(
        e.rating.select(F.col("yn").alias("rev_prop_rtng_ind"), "string"), "rev_prop_rtng_ind")
    return rated.join(e.revr.select("revr_id", "revr_last_name"), "revr_id").join(people.emails(e.revr_mail), "revr_id")


def stream_references(e):
    """The stream of documents before any text: one row for each review, and one for each proposal (`form` null) with the lengths of its head's documents."""
    rows = projects(e).select("prop_id", F.col("lead").alias("of_lead"), "ILN")
    lengths = documents_of(e, False).groupBy(F.col("prop_id").alias("of_lead"), "doc_type").agg(F.max("n").alias("n")).groupBy("of_lead").agg(
        *[F.max(F.when(F.col("doc_type") == k, F.col("n"))).alias(f"len_{k}") for k in COMPARED_TEXTS])
    own = rows.join(lengths, "of_lead", "left").withColumn("form", F.lit(None).cast("string"))
    said = review_rows(e).select("prop_id", F.lit("Review").alias("form"), F.col("revr_last_name").alias("name"), F.col("revr_email").alias("info"), F.col("rev_stts_code").alias("stts"),
                                 F.col("rev_due_date").alias("due"), F.col("rev_rtrn_date").alias("returned"), F.col("string").alias("score"))
    return own.unionByName(said, allowMissingColumns=True)


COMPARED_TEXTS = ("POCmnt", "Abstr")  # of a collaborator only where they differ in length from the head's


def documents_of(e, texts: bool = True):
    """prop_id, doc_type and length of the documents that proposals have; with their texts, or without."""
    d = F.col("doc_id")
    kind = F.when(d % 3 == 0, "Abstr").when(d % 3 == 1, "POCmnt").otherwise("RA")
    more = ["source", "lang", "text"] if texts else []
    return e.table("documents").select(d.alias("prop_id"), kind.alias("doc_type"), F.length("text").alias("n"), *more)


def collected(e):
    """Seven kinds of documents of all projects as one stream of rows.

    Rows refer to documents until the last step: texts of documents are joined once, to reviews and proposals together, so that they are
    shuffled once, and a proposal with very many reviews is split by that join.
    """
    s = documents.as_stream
    lead_rows = heads(e).withColumn("lead", F.col("prop_id"))
    said = (e.panl_prop.select("panl_id", "prop_id").join(lead_rows, "prop_id").join(e.panl.select("panl_id", "panl_name", "panl_bgn_date"), "panl_id")
            .join(e.rec.select("panl_id", "prop_id", "rcom_abbr", "prop_ordr"), ["panl_id", "prop_id"], "left")
            .withColumn("t", F.concat(F.lit("Panel "), F.col("panl_name"), F.lit(": "), F.coalesce("rcom_abbr", F.lit("none")))))
    attached = stream_references(e).join(documents_of(e), "prop_id")
    head, kind = F.col("ILN") < "M", F.col("doc_type")
    differs = F.col("n") != F.coalesce(*[F.when(kind == k, F.col(f"len_{k}")) for k in COMPARED_TEXTS])
    summary = text.sections("spcl_char_pdf", "text", "lang", "source")
    one = lambda name, author, body: F.struct(F.lit(name).alias("doc_type") if isinstance(name, str) else name.alias("doc_type"), author.alias("name"), body.alias("text"))
    kept = F.when(kind == "RA", head).otherwise(head | differs)
    shown = F.when(F.col("form").isNotNull(), F.array(one("Review", F.col("name"), F.col("text")))).otherwise(F.concat(
        F.when(kept, F.array(one(kind, F.col("source"), F.col("text")))).otherwise(F.array()), F.when(head, F.array(one("SummProj", F.lit(None).cast("string"), summary))).otherwise(F.array())))
    flagged = attached.withColumn("spcl_char_pdf", F.when(F.col("source").endswith("7"), "Y").otherwise("N"))
    texts = flagged.select(F.coalesce("of_lead", "prop_id").alias("lead"), "prop_id", "info", "stts", "due", "returned", "score", F.explode(shown).alias("d"))
    diaries = e.table("conversations").select(F.col("conv_id").alias("prop_id"), F.col("role").alias("author"), "text").join(projects(e).select("prop_id", "lead"), "prop_id")
    panel = s(said, " PanlSumm", lead="lead", prop_id="prop_id", name=F.concat(F.lit(" "), F.col("panl_name")), info="panl_id",
              stts=F.col("prop_ordr").cast("string"), due="panl_bgn_date", score="rcom_abbr", text="t")
    return (texts.select("lead", "prop_id", "d.doc_type", "d.name", "info", "stts", "due", "returned", "score", "d.text")
            .unionByName(panel).unionByName(s(diaries, "xDiaryNt", lead="lead", prop_id="prop_id", name="author", text="text")))



def base(e):
    return base_names(e, base_people(e)).select(*selection.BASE)


def base_people(e):
    return selection.base_people(selection.with_project(e.prop), e.pi_primary)


def base_names(e, rows):
    rows = selection.base_names(rows, e.org, e.inst, [e.pgm_ele, e.prop_stts, e.natr_rqst])
    return rows.withColumn("Pgm", F.concat_ws(" - ", "pgm_ele_code", "pgm_ele_name"))


def proposal_cube(e):
    """All proposals over the dimensions of the dashboards, stored once; entities without a folder build theirs each time."""
    make = lambda: cube.build(base(e))
    folder = getattr(e, "folder", None)
    return make() if folder is None else cube.kept(e.spark, folder, CUBE_TABLES, make)


def date_range(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Both ends are included and optional; the bounds are literals, so they reach the scan."""
    if start:
        df = df.filter(F.col(col) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        df = df.filter(F.col(col) <= F.lit(end).cast("timestamp_ntz"))
    return df


def panelists(e, panels_spec):
    """Reviewers on the panels a specification names, one row per panel."""
    return e.panl_revr.filter(criteria.predicate("panl_id", panels_spec))


def panelist_stats(e, panels_spec, since):
    """Statistics of panelists: their reviews on the chosen panels, and all since a date if different."""
    chosen = criteria.predicate("panl_id", panels_spec)
    people_on = panelists(e, panels_spec).select("revr_id").distinct()
    held = timed(e).filter("rev_type_code NOT IN ('C', 'R')").join(people_on, "revr_id", "left_semi")
    selected = held.filter("rev_rtrn_date IS NOT NULL").join(e.panl_prop.filter(chosen).select("prop_id"), "prop_id")
    everything = held.filter(F.col("rev_rtrn_date") > F.lit(since).cast("timestamp_ntz"))
    return reviews.selected_and_all(selected, everything)
