"""Report pipelines. Each takes the entities and returns one lazy DataFrame.

Reports are unordered; `limited` and `order_by_project` are for the sink.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions import criteria
from ..functions.ordered import cumulative, ordered_concat, padded_concat, running_number, slots
from ..operators import awards, budgets, changes, children, documents, panels, people, reviews, selection, splits
from ..sources import sinks
from ..sources.entities import SHARES
from . import stages

ID_STEP = 12  # ids are counted in steps of 4096


def _projects(e) -> DataFrame:
    return selection.with_project(e.prop)


def _heads(e) -> DataFrame:
    return selection.one_row_per_project(_projects(e))


def last_update(e) -> DataFrame:
    """Per project the last change of its analysis, written or uploaded (type 034)."""
    heads = stages.heads(e)
    both = e.ra.unionByName(e.upld.filter("upload_type_code = '034'").select("prop_id", "last_updt_tmsp"))
    return (both.groupBy("prop_id").agg(F.max("last_updt_tmsp").alias("RAupdate"))
            .join(heads, "prop_id", "left_semi").withColumnRenamed("prop_id", "lead"))


def glossary(used: DataFrame, code: str, names: DataFrame | None, name: str = "description") -> DataFrame:
    """Distinct codes with their description, or with a remark where the lookup is not installed."""
    codes = used.select(F.col(code).alias("code")).distinct()
    if names is None:
        return codes.withColumn(name, F.lit("lookup table missing"))
    return codes.join(names.toDF("code", name), "code")


HEAD_FACTS = ["pgm_annc_id", "PO", "obj_clas_code", "cntx_stmt_id", "Pgm", "prop_stts_abbr", "natr_rqst_abbr", "origORG", "origPEC"]


def _with_head_facts(e, rows: DataFrame) -> DataFrame:
    """Proposals with what the reports show of their own row: officer, announcement, context, object class, names of codes, changed organisation and program."""
    return (rows.join(e.pgm_ele, "pgm_ele_code").join(e.prop_stts.drop("prop_stts_txt"), "prop_stts_code").join(e.natr_rqst, "natr_rqst_code")
            .withColumn("Pgm", F.concat_ws(" - ", "pgm_ele_code", "pgm_ele_name")).withColumnRenamed("pm_ibm_logn_id", "PO")
            .withColumn("origORG", c.only_if_changed("org_code", "orig_org_code")).withColumn("origPEC", c.only_if_changed("pgm_ele_code", "orig_pgm_ele_code")))


def project_wide(e) -> DataFrame:
    """The flagship: one wide row per project with its reviews, up to three panels, up to seven
    proposals and totals."""
    projects = _projects(e)
    own = stages.with_head_panels(e)
    own.panl_revr = sinks.staged(e.panl_revr)
    assessed = stages.credited_reviews(own)
    by_panel = sinks.staged(reviews.by_panel(assessed))
    panelists = own.panl_revr.groupBy("panl_id").agg(F.count("revr_id").alias("P"))
    outcomes = sinks.staged(panels.rated_outcomes(e.panl, own.rec, stages.projects(e)).join(panelists, "panl_id", "left"))  # one row a panel
    on_panels = sinks.staged(stages.project_panel_rows(own, assessed, by_panel, outcomes))
    panel_fields = {"rec": "RA", "panl_id": "panl_id", "rank": "RK", "panl_name": "panl_name", "panl_end": "panl_end_date",
                    "revs": "V", "PanlString": "outcome", "pnlst": "P", "confl": "C", "conflrev": "CR"}
    wide_panels = slots(on_panels, ["lead"], [F.col("panl_end_date"), F.col("panl_id")], panel_fields, 3)
    totals = selection.project_totals(stages.projects(e), stages.budget_totals(e))
    ad_hoc = by_panel.filter(F.col("panl_id") == reviews.AD_HOC).select(
        "lead", F.col("N").alias("AhNrev"), F.col("V").alias("AhRevs"), F.col("last_rev_date").alias("AhLast"))
    division = e.org.select("org_code", F.col("dir_div_abbr").alias("Div"))
    directorate = e.org.select(F.col("org_code").alias("_dir"), F.col("dir_div_abbr").alias("Dir"))
    heads = selection.one_row_per_project(projects).join(e.pi_primary.select("pi_id", F.col("pi_emai_addr").alias("email")), "pi_id", "left")
    parts = [
        last_update(e), reviews.summary(assessed, once=True), reviews.marks(assessed).select("lead", "Nunrlsbl"), ad_hoc, wide_panels,
        panels.project_panel_summary(on_panels).select("lead", "nPanl", F.col("RecRkMin").alias("_best")),
        stages.proposal_slots(e, mail=True), totals,
    ]
    wide = reduce(lambda a, b: a.join(b, "lead", "left"), [heads, *parts])
    # names of codes come last: they are looked up where the row is, and not shuffled
    named = (_with_head_facts(e, wide).withColumn("dd_rcom_date", c.real_date("dd_rcom_date")).withColumn("prop_titl_txt", F.rtrim("prop_titl_txt"))
             .withColumn("_dir", c.directorate_code("org_code")).join(division, "org_code").join(directorate, "_dir", "left")
             .withColumn("RecRkMin", panels.rank_score(F.col("_best"), F.col("avg_score"))))
    order = ["lead", "org_code", *HEAD_FACTS, "rqst_eff_date", "rqst_mnth_cnt", "received_date", "dd_rcom_date", "pgm_ele_code", "natr_rqst_code", "prop_stts_code", "prop_titl_txt",
             "Div", "Dir", "email", *[x for part in parts for x in part.columns if x not in ("lead", "_best")], "RecRkMin"]
    return named.select(*order)


def coding_check(e) -> DataFrame:
    """Coding facts of every proposal, with review counts on heads and demographics."""
    own = stages.with_head_panels(e)
    assessed = stages.credited_reviews(own)
    on_panels = panels.project_panel_summary(panels.said_by_panels(reviews.panels_of(assessed), own.rec))
    division = e.org.select("org_code", F.col("dir_div_abbr").alias("Div"))
    # only keys of proposals travel to the project for its date, and back; a proposal has one project, but nothing here needs it
    dates = (stages.projects(e).select("prop_id", "lead").join(last_update(e), "lead").groupBy("prop_id")
             .agg(F.map_from_entries(F.collect_set(F.struct("lead", "RAupdate"))).alias("_dates")))

    def on_head(df):
        return df.withColumnRenamed("lead", "prop_id")

    rows = (_projects(e).withColumn("dd_rcom_date", c.real_date("dd_rcom_date"))
            .join(e.pi_primary.select("pi_id", "pi_last_name", "pi_frst_name", "pi_emai_addr"), "pi_id", "left")
            .join(stages.codes_space(e.atr), "prop_id", "left")  # what follows is joined by proposal
            .join(people.demographics(e.person, e.pi, e.pdmog), "prop_id", "left")
            .join(dates, "prop_id", "left").withColumn("RAupdate", F.try_element_at("_dates", "lead"))
            .join(on_head(reviews.summary(assessed, once=True)), "prop_id", "left")
            .join(on_head(reviews.marks(assessed)), "prop_id", "left")
            .join(on_head(on_panels), "prop_id", "left"))
    # names of codes come last: they are looked up where the row is, and not shuffled
    return (_with_head_facts(e, rows).join(division, "org_code").join(e.inst, "inst_id", "left")
            .withColumn("RecRkMin", F.round("RecRkMin", 6))
            .select(*HEAD_FACTS, *SHARES, "dd_rcom_date", "received_date", "org_code", "pgm_ele_code", "prop_stts_code", "natr_rqst_code", "bas_rsch_pct",
                    "other_pct", F.col("R").alias("propPRCs"), "st_code", "RAupdate", "lead", "ILN", "Div", "prop_id", "pi_last_name",
                    "pi_frst_name", F.col("inst_shrt_name").alias("inst"), "nPanl", "nPSunmrkd", "nPSunrls", "RecRkMin", "Nrev",
                    "allReviews", "avg_score", "last_rev_date", "Nunmkd", "Nconfl", "Nunrlsbl", "n_released_unfinished", "NpendSlct", "n_systems_differ",
                    "prop_titl_txt", F.col("rqst_dol").alias("rqst_tot"), "NfmlPIs", "NhispPIs", "NhndcpPIs", "NnonWhtAsnPIs",
                    F.col("pi_emai_addr").alias("email")))


def coding_flags(e, states=("S1", "S2"), state_code="0015", people_code="0012", reviews_wanted=3) -> DataFrame:
    """Rule checks, 0/1 each: percentages, state list against its code, demographics against their
    code, too few reviews on a head, and non-leads that differ from their lead."""
    assessed = stages.lead_reviews(e)
    wanted = ["org_code", "pgm_ele_code", "natr_rqst_code", "prop_titl_txt"]
    demog = people.demographics(e.person, e.pi, e.pdmog)
    counted = assessed.filter("confl = 0").groupBy(F.col("lead").alias("prop_id")).agg(F.count("revr_id").alias("Nrev"))
    rows = (stages.differs_from_lead(_projects(e), wanted)
            .join(e.inst.select("inst_id", "st_code"), "inst_id", "left")
            .join(children.holds(stages.codes_of(e.atr), "prop_id", "prop_atr_code", {"has_state": state_code, "has_people": people_code}), "prop_id", "left")
            .join(demog, "prop_id", "left").join(counted, "prop_id", "left"))
    counted_people = F.col("NfmlPIs") + F.col("NhispPIs") + F.col("NhndcpPIs") + F.col("NnonWhtAsnPIs") > 0
    return rows.select(
        "lead", "ILN", "prop_id", c.flag(F.col("bas_rsch_pct") + F.col("other_pct") != 1).alias("bad_pct"),
        c.flag(c.differs(F.col("st_code").isin(*states), F.col("has_state"))).alias("bad_state"),
        c.flag(c.differs(counted_people, F.col("has_people"))).alias("bad_people"),
        c.flag(c.heads_project() & (F.coalesce("Nrev", F.lit(0)) < reviews_wanted)).alias("few_reviews"),
        *[f"dif_{x}" for x in wanted])


PAIRS = {"Org": "org_code", "PEC": "pgm_ele_code", "PO": "pm_ibm_logn_id", "Obj": "obj_clas_code"}  # what a split has as well as its proposal


def split_rows(e) -> DataFrame:
    """Every split next to its proposal: organisation, program, officer, object class and codes of both, and the split's award."""
    rows = (stages.proposal_rows(e).join(e.org.select("org_code", F.col("dir_div_abbr").alias("Div")), "org_code").join(e.prop_stts, "prop_stts_code").join(e.natr_rqst, "natr_rqst_code")
            .select("received_date", c.real_date("dd_rcom_date").alias("dd_rcom_date"), "cntx_stmt_id", "pgm_annc_id", "prop_stts_abbr", "natr_rqst_abbr", "lead", "ILN", "Div", "prop_id", "pi_last_name",
                    F.col("inst_shrt_name").alias("inst"), F.col("R").alias("propPRCs"), "prop_titl_txt", *[F.col(x).alias(f"p{n}") for n, x in PAIRS.items()]))
    s = e.splt.select(*splits.KEY, F.round("budg_splt_tot_dol", 2).alias("budg_splt_tot_dol"), "awd_id", *[F.col(x).alias(f"b{n}") for n, x in PAIRS.items()])
    # splits have their codes before they meet their proposal: the wide rows are made by the last join and never shuffled
    whole = s.join(stages.split_codes(e.splt_code), splits.KEY, "left")
    columns = [*splits.KEY, *[x for x in rows.columns if x not in splits.KEY], *[x for x in whole.columns if x not in splits.KEY]]
    return rows.join(whole, "prop_id").select(*columns)


def split_flags(e) -> DataFrame:
    """Where a split differs from its proposal in any of five things, and where a proposal's splits begin."""
    rows = (split_rows(e)
            .join(children.bag(stages.codes_of(e.atr), ["prop_id"], F.rtrim("prop_atr_code"), "_prop_codes"), "prop_id", "left")
            .join(children.bag(e.splt_code, splits.KEY, F.rtrim("pgm_ref_code"), "_splt_codes", True), splits.KEY, "left"))
    first = rows.groupBy("prop_id").agg(F.min(F.struct("budg_yr", "splt_id")).alias("_f"))
    return rows.join(first, "prop_id").select(
        *splits.KEY, *[c.flag(F.col(f"p{n}") != F.col(f"b{n}")).alias(f"dif_{n}") for n in PAIRS],
        c.flag(~F.col("_prop_codes").eqNullSafe(F.col("_splt_codes"))).alias("dif_PRCs"),
        c.flag(F.struct("budg_yr", "splt_id") == F.col("_f")).alias("new_group"))


def approvals(e) -> DataFrame:
    return (e.subm.join(e.covr, "temp_prop_id")
            .select("prop_id", c.approval("hum_date", "humn_date_pend_flag").alias("humn_date"),
                    c.approval("vert_date", "vrtb_date_pend_flag").alias("vrtb_date")))


def award_check(e) -> DataFrame:
    """Award readiness: approvals, countries, yearly and total budget of the latest revision."""
    totals = budgets.totals(e.budg, budgets.only("sub_ctr_tot", "frgn_trav_tot", "part_tot_cnt"))
    money = [F.round(x, 4).alias(x) for x in ("sub_ctr_tot", "frgn_trav_tot")]
    totals = totals.select("prop_id", F.col("RN").alias("brevn"), F.round("T", 2).alias("budg_tot"), *money, "part_tot_cnt")
    return (_projects(e).withColumn("dd_rcom_date", c.real_date("dd_rcom_date"))
            .join(e.org.select("org_code", F.col("dir_div_abbr").alias("Div")), "org_code")
            .join(e.pi_primary.select("pi_id", "pi_last_name", "pi_emai_addr"), "pi_id", "left")
            .join(e.inst.select("inst_id", "inst_shrt_name", "st_code"), "inst_id", "left")
            .join(last_update(e), "lead", "left")
            .join(approvals(e), "prop_id", "left").join(stages.countries(e), "prop_id", "left")
            .join(totals, "prop_id", "left").join(budgets.year_columns(e.budg), "prop_id", "left")
            .select("dd_rcom_date", "received_date", "org_code", "pgm_ele_code", "prop_stts_code", "natr_rqst_code", "RAupdate", "lead",
                    "ILN", "Div", "prop_id", "pi_last_name", F.col("inst_shrt_name").alias("inst"), "st_code", "humn_date", "vrtb_date",
                    "Country", "frgn_trav_tot", "prop_titl_txt", "brevn", F.col("rqst_dol").alias("rqst_tot"), "budg_tot",
                    *[f"y{y}_tot" for y in range(1, 7)], "sub_ctr_tot", "part_tot_cnt", F.col("pi_emai_addr").alias("email")))


def award_flags(e) -> DataFrame:
    """Request against budget, participant money against head count, non-leads against their lead."""
    totals = budgets.totals(e.budg, budgets.only("part_tot_dol", "part_tot_cnt"))
    rows = (_projects(e).join(totals, "prop_id", "left").join(
        children.bag(stages.country_rows(e), ["prop_id"], F.col("ctry_name"), "Country"), "prop_id", "left")
            .withColumn("T", F.round("T", 2)).withColumn("Country", F.coalesce("Country", children.empty_bag())))
    marked = stages.differs_from_lead(rows, ["org_code", "pgm_ele_code", "Country", "prop_titl_txt"])
    return marked.select(
        "lead", "ILN", "prop_id", c.flag(F.col("rqst_dol") < F.col("T")).alias("below_budget"),
        c.flag(F.col("rqst_dol") > F.col("T")).alias("above_budget"),
        c.flag(c.differs(F.col("part_tot_dol") > 0, F.col("part_tot_cnt") > 0)).alias("part_mismatch"),
        "dif_org_code", "dif_pgm_ele_code", "dif_Country", "dif_prop_titl_txt")


def budget_blocks(e) -> DataFrame:
    """Year rows of every proposal's latest revision and a total row that carries the names."""
    latest = budgets.latest_revision(e.budg)
    codes = stages.codes_space(e.atr).withColumnRenamed("R", "PRCs")
    base = _projects(e).select("lead", "ILN", "prop_id", "org_code", "pgm_ele_code", "pi_id", "inst_id").join(codes, "prop_id", "left")
    facts = ["lead", "ILN", "prop_id", "org_code", "pgm_ele_code", "PRCs"]
    years = base.join(latest, "prop_id", "left").select(
        *facts, F.lit("").alias("pi_last_name"), F.lit("").alias("inst_name"), F.round("frgn_trav_dol", 4).alias("frgn_trav_dol"),
        "part_cnt", "revn_num", "budg_seq_yr", F.round("budg_tot_dol", 2).alias("dol"))
    sums = latest.groupBy("prop_id").agg(F.max("revn_num").alias("revn_num"), c.money("budg_tot_dol").alias("dol"))
    total = (base.join(sums, "prop_id", "left")
             .join(e.pi_primary.select("pi_id", "pi_last_name"), "pi_id", "left")
             .join(e.inst.select("inst_id", F.col("inst_shrt_name").alias("inst_name")), "inst_id", "left")
             .select(*facts, "pi_last_name", "inst_name", F.lit(None).cast("double").alias("frgn_trav_dol"),
                     F.lit(None).cast("double").alias("part_cnt"), "revn_num", F.lit(None).cast("int").alias("budg_seq_yr"), "dol"))
    return years.unionByName(total)


def projects_report(e) -> DataFrame:
    """One base row per project with counts of proposals, people and panels, and the total request."""
    projects = _projects(e)
    base = stages.base(e).filter(c.heads_project())
    money = projects.groupBy("lead").agg(c.money("rqst_dol").alias("rqst_dol_tot"))
    counts = selection.project_counts(projects, e.copi, e.panl_prop)
    return base.join(counts, "lead").join(money, "lead").drop("rqst_dol").withColumn(
        "pi_name", F.concat_ws(", ", "pi_last_name", "pi_frst_name"))


def proposals_report(e) -> DataFrame:
    """Base row with codes, routing, countries and approvals."""
    return (stages.base(e).join(stages.codes_comma(e.atr), "prop_id", "left").join(approvals(e), "prop_id")
            .join(stages.routing(e), "prop_id", "left").join(stages.countries(e), "prop_id", "left"))


def people_report(e) -> DataFrame:
    """PIs, co-PIs, then senior people and subaward people who are new by name."""
    projects = _projects(e)
    everybody = people.add_new(stages.with_seniors(e), people.candidates(e.subpi, projects, e.inst), "subAwd")
    facts = stages.base(e).select("prop_id", "lead", "Dir", "Div", "org_code", "prop_stts_code")
    return everybody.join(facts, "prop_id")


def project_text(e) -> DataFrame:
    """Summary sections of every project with its total request."""
    money = stages.projects(e).groupBy("lead").agg(c.money("rqst_dol").alias("rqst_dol_tot"))
    sections = stages.summaries(e).select("prop_id", "spcl_char_pdf", F.col("text").alias("proj_summ_txt"), F.col("lang").alias("intul_mert"),
                                          F.col("source").alias("brodr_impt"))
    return (stages.base(e).filter(c.heads_project()).join(money, "lead").join(sections, "prop_id", "left")
            .select("lead", "ILN", "Dir", "Div", "prop_id", "pi_last_name", "inst_name", "prop_titl_txt", "rqst_dol_tot", "spcl_char_pdf",
                    "proj_summ_txt", "intul_mert", "brodr_impt"))


def suggested_reviewers(e) -> DataFrame:
    rows = stages.base(e).join(e.subm, "prop_id").join(e.sugg, "temp_prop_id")
    return rows.select("lead", "ILN", "Div", "prop_id", "pi_last_name", F.col("revr_want").alias("Suggested_Reviewers"),
                       F.col("revr_dont_want").alias("Unwanted_Reviewers"),
                       (F.length("revr_want") + F.length("revr_dont_want")).cast("long").alias("len_tot"))


def orphans(e) -> DataFrame:
    """Proposals on no panel, with ad hoc reviews sent and still out."""
    alone = stages.base(e).join(e.panl_prop.select("prop_id"), "prop_id", "left_anti")
    sent = (e.rev.filter("rev_type_code = 'R'").groupBy("prop_id")
            .agg(F.count(F.lit(1)).alias("sent_adhoc"), F.count("rev_rtrn_date").alias("_back"), F.max("rev_due_date").alias("last_due")))
    return (alone.join(sent, "prop_id", "left")
            .select("prop_id", "lead", "ILN", "Div", "prop_stts_code", "pi_last_name", "inst_name", "prop_titl_txt", "sent_adhoc",
                    c.zero_to_null(F.col("sent_adhoc") - F.col("_back")).alias("out_adhoc"), "last_due"))


NEW_KINDS = ["BUILDING", "MACHINERY"]
OTHER_FACTS = ["orig_org_code", "pm_ibm_logn_id", "obj_clas_code", "pgm_annc_id", "rqst_eff_date", "rqst_mnth_cnt", "cntx_stmt_id", *SHARES]


def transfers(e) -> DataFrame:
    projects = _projects(e)
    chain = changes.proposal_awards(projects, e.log, e.covr, e.subm, NEW_KINDS)
    props = e.prop.select("prop_id", "pi_id", "inst_id", *[own for own, _, _ in changes.PARTS.values()]).join(e.inst.select("inst_id", "inst_shrt_name"), "inst_id")
    moved = changes.transfers(chain, props, e.pi_primary.select("pi_id", "pi_last_name"), e.log, e.own)
    facts = projects.select("prop_id", "lead", "ILN", "natr_rqst_code", "prop_stts_code")
    return moved.join(facts, "prop_id")


def panelists(e, panels_spec="P1%") -> DataFrame:
    """Reviewers on the chosen panels: how many panels, the latest, where they are."""
    on = (stages.panelists(e, panels_spec).join(e.panl.select("panl_id", "panl_bgn_date"), "panl_id")
          .groupBy("revr_id").agg(F.count("panl_id").alias("nPanls"), F.max("panl_bgn_date").alias("latest")))
    return on.join(people.reviewer_facts(e.revr, e.revr_mail, e.inst), "revr_id")


def panelist_statistics(e, panels_spec="P1%", since="1996-01-01") -> DataFrame:
    on = stages.panelists(e, panels_spec).groupBy("revr_id").agg(F.count("panl_id").alias("nPanls"))
    return (stages.panelist_stats(e, panels_spec, since).join(on, "revr_id", "left").fillna(0, ["nPanls"])
            .join(people.reviewer_facts(e.revr, e.revr_mail, e.inst), "revr_id", "left"))


def reviewers(e) -> DataFrame:
    """Who returned reviews for the projects: how many, the latest."""
    heads = stages.heads(e)
    done = (e.rev.filter("rev_rtrn_date IS NOT NULL AND rev_type_code <> 'C'").join(heads, "prop_id", "left_semi")
            .groupBy("revr_id").agg(F.count("prop_id").alias("nProps"), F.max("rev_rtrn_date").alias("latest")))
    return done.join(people.reviewer_facts(e.revr, e.revr_mail, e.inst), "revr_id")


def reviewer_statistics(e) -> DataFrame:
    heads = stages.heads(e)
    held = stages.timed(e).filter("rev_rtrn_date IS NOT NULL AND rev_type_code <> 'C'").join(heads, "prop_id", "left_semi")
    return reviews.score_stats(held).join(people.reviewer_facts(e.revr, e.revr_mail, e.inst), "revr_id")


def props_on_panels(e) -> DataFrame:
    """Proposal by panel: rank, outcome of the panel, ratings, countries, approvals."""
    own = stages.with_head_panels(e)
    said = own.rec.select("panl_id", "prop_id", F.lit("Y").alias("panl_held"), F.col("panl_summ_rlse_flag").alias("summ_rlse"),
                          F.col("prop_ordr").alias("rank"), F.col("rcom_seq_num").alias("rcom_seq"), "rcom_abbr")
    on = own.panl_prop.join(said, ["panl_id", "prop_id"], "left").withColumnRenamed("prop_id", "lead")
    outcome = sinks.staged(panels.listed_outcomes(e.panl.select("panl_id", "panl_name", "panl_bgn_date"), own.rec, stages.projects(e)))  # one row a panel
    short = stages.short_reviews(e)
    rated = short.groupBy("lead").agg(c.average("score", reviews.SCORES).alias("avg_score"), F.max("rev_rtrn_date").alias("last_rev_date")).join(
        reviews.ratings(short, ["lead"], "reviews", 10, None), "lead")
    people, approved, countries = stages.base_people(e), approvals(e), stages.countries(e)
    # proposals are complete before they meet their panels: the wide rows of the report are made by the last join and never shuffled, and names
    # of codes by the lookups before it
    whole = stages.base_names(e, people.join(approved, "prop_id").join(countries, "prop_id", "left").join(rated, "lead", "left"))
    rows = whole.join(on.join(outcome, "panl_id", "left"), "lead", "left").withColumn("rankInPanl", panels.rank_in_panel(F.col("rank"), F.col("panlSumm")))
    order = [*selection.BASE, *approved.columns, *on.columns, *outcome.columns, *rated.columns, *countries.columns, "rankInPanl"]
    return rows.select(*dict.fromkeys(["prop_id", "lead", "panl_id", *order])).drop("panlSumm")


def panels_report(e) -> DataFrame:
    """Panels that consider the projects, and how all proposals on them fared."""
    heads = stages.heads(e)
    on = e.panl_prop.join(heads, "prop_id", "left_semi").groupBy("panl_id").agg(F.count("prop_id").alias("numProps"))
    rows = e.panl.join(on, "panl_id")
    text = panels.listed_outcomes(rows, e.rec, stages.projects(e))
    return text.withColumn("panlSumm", F.replace(F.col("panlSumm"), F.lit(" proj: "), F.lit(" rated projects: ")))


def new_institutions(e, as_of=stages.AS_OF) -> DataFrame:
    fresh = stages.new_institutions(e.prop, e.awd, as_of)
    return stages.base(e).join(fresh, "inst_id", "left_semi")


def coi_reviewers(e) -> DataFrame:
    """Distinct names and addresses of everybody who reviewed a listed proposal."""
    who = e.rev.join(e.idlist, "prop_id", "left_semi").select("revr_id").distinct()
    return (who.join(e.revr, "revr_id").join(people.emails(e.revr_mail), "revr_id", "left")
            .select("revr_last_name", "revr_frst_name", F.col("revr_email").alias("email")).distinct())


def coi_projects(e, withdrawn=("O",)) -> DataFrame:
    return (stages.base(e).filter(c.heads_project() & ~F.col("prop_stts_code").isin(*withdrawn))
            .select("Div", "prop_id", "ILN", "pi_last_name", "inst_name"))


def subaward_reconciliation(e) -> DataFrame:
    place = e.inst.select(F.col("inst_id").alias("perf_inst_id"), F.col("inst_shrt_name").alias("perf_inst"))
    facts = stages.base(e).select("prop_id", "lead", "ILN", "Div", "pi_last_name", "inst_name", "prop_titl_txt")
    return (budgets.subaward_differences(e.cost, e.budg).join(place, "perf_inst_id").drop("perf_inst_id").join(facts, "prop_id"))


def autocode_check(e) -> DataFrame:
    """Codes, percentages, context, changed organisation and program, and demographics of every proposal."""
    codes = padded_concat(stages.codes_of(e.atr), ["prop_id"], [F.col("prop_atr_code")], "prop_atr_code", " ", 7, "PRCs")
    return (_projects(e).join(e.pi_primary.select("pi_id", "pi_last_name", "pi_frst_name"), "pi_id").join(e.inst, "inst_id")
            .join(people.demographics(e.person, e.pi, e.pdmog), "prop_id").join(codes, "prop_id", "left")
            .join(e.prop_stts.select("prop_stts_code", "prop_stts_abbr"), "prop_stts_code")
            .select("lead", "ILN", "prop_id", "cntx_stmt_id", "pi_last_name", "pi_frst_name", "inst_shrt_name", "st_code", "prop_stts_code", "prop_stts_abbr", F.col("pm_ibm_logn_id").alias("PO"),
                    "bas_rsch_pct", "other_pct", *SHARES, "org_code", c.only_if_changed("org_code", "orig_org_code").alias("orig_org"), "pgm_ele_code",
                    c.only_if_changed("pgm_ele_code", "orig_pgm_ele_code").alias("orig_PEC"),
                    "NfmlPIs", "NhispPIs", "NhndcpPIs", "NnonWhtAsnPIs", "PRCs", "prop_titl_txt"))


def tracker_proposal(e) -> DataFrame:
    """Tracking row: ad hoc counters, first and last panel, splits, award."""
    ends = sinks.staged(panels.first_and_last(stages.panel_rows(e)))

    def side(df, name):
        return df.select("prop_id", F.col("panl_id").alias(f"{name}_panl"), F.col("panl_bgn_date").alias(f"{name}_begin"),
                         F.col("rcom_seq_num").alias(f"{name}_recno"), F.col("rcom_abbr").alias(f"{name}_rec"),
                         F.col("prop_ordr").alias(f"{name}_rank"))

    money = e.splt.groupBy("prop_id").agg(c.money("budg_splt_tot_dol").alias("split_tot_dol"),
                                          F.max("frwd_date").alias("split_frwd_date"))
    award = e.awd.select(F.col("awd_id").alias("prop_id"), F.col("awd_id"), "tot_intn_awd_amt", "awd_stts_code", "awd_eff_date", "awd_exp_date",
                         F.col("inst_id").alias("_ai")).join(
        e.inst.select(F.col("inst_id").alias("_ai"), F.col("inst_shrt_name").alias("inst_awd")), "_ai", "left").drop("_ai")
    codes = stages.placed_codes(e, "PRCs")
    return (_projects(e).withColumnRenamed("lead", "lead_id").withColumn("dd_rcom_date", c.real_date("dd_rcom_date"))
            .join(e.pi_primary.select("pi_id", "pi_last_name", "pi_gend_code"), "pi_id").join(e.inst.select("inst_id", F.col("inst_shrt_name").alias("inst_name")), "inst_id")
            .join(codes, "prop_id", "left").join(stages.adhoc_counters(e.rev), "prop_id", "left")
            .fillna(0, ["adhoc_reqd", "adhoc_pend", "revRcvd"])
            .join(side(ends.filter("is_first"), "first"), "prop_id", "left").join(side(ends.filter("is_last"), "last"), "prop_id", "left")
            .join(money, "prop_id", "left").join(award, "prop_id", "left")
            .drop("lead_prop_id", "pi_id", "inst_id", "orig_pgm_ele_code", "other_pct", *OTHER_FACTS))


def tracker_split(e, include: DataFrame, omit: DataFrame, spec="S%") -> DataFrame:
    """Splits by criteria and include list without the omitted, next to their proposal and award."""
    chosen = criteria.predicate("pgm_ele_code", spec)
    kept = splits.tracked(e.splt, chosen, include, omit)
    rows = stages.proposal_rows(e)
    proposal = rows.select("prop_id", "ILN", F.col("lead").alias("lead_id"), "received_date", "org_code", F.col("pgm_ele_code").alias("PEC_prop"),
                           "prop_stts_code", "pi_last_name", F.col("inst_shrt_name").alias("inst_name"), "rqst_dol")
    codes = ordered_concat(stages.codes_of(e.atr), ["prop_id"], [F.col("prop_atr_code")], F.rtrim("prop_atr_code"), " ", 11, name="PropPRCs")
    award = e.awd.select(F.col("awd_id").alias("prop_id"), "awd_stts_code")
    return (kept.select(*splits.KEY, F.round("budg_splt_tot_dol", 2).alias("budg_splt_tot_dol"), F.col("pgm_ele_code").alias("PEC_bdg_splt"))
            .join(proposal, "prop_id").join(codes, "prop_id", "left")
            .join(stages.split_codes(e.splt_code).withColumnRenamed("bPRCs", "BudgPRCs"), splits.KEY, "left")
            .join(award, "prop_id", "left"))


def _listed_pairs(e) -> DataFrame:
    return awards.investigator_pairs(selection.listed(_projects(e), e.idlist), e.copi)


def listed_people(e) -> DataFrame:
    """The bridge of the reports on people's awards: which listed project has which investigator (lead, prop_id, pi_id).

    With `awards_of_people` and `pending_of_people` it holds what `pi_awards` and `pi_pending` spell out for every pair: each table grows
    with its inputs, also where one person is in very many projects and has very many awards.
    """
    return _listed_pairs(e)


def awards_of_people(e) -> DataFrame:
    """Active awards of everybody in the bridge, each person and award once, with money and names."""
    rows = awards.held_awards(_listed_pairs(e), e.awd, e.awd_pi, e.oblg)
    paid = e.inst.select("inst_id", F.col("inst_shrt_name").alias("inst_awd"))
    return rows.join(paid, "inst_id").drop("inst_id").join(e.pi_primary.select("pi_id", "pi_last_name", "pi_frst_name"), "pi_id")


def pending_of_people(e, status=("P",)) -> DataFrame:
    """Pending proposals of everybody in the bridge, each person, proposal and role once; a reader leaves out the project itself."""
    rows = awards.pending_roles(_listed_pairs(e), e.prop, e.copi, list(status))
    facts = e.prop.select(F.col("prop_id").alias("pend_id"), "rqst_dol", "org_code", "pgm_ele_code", "prop_stts_code", "prop_titl_txt")
    return rows.join(e.pi_primary.select("pi_id", "pi_last_name"), "pi_id").join(facts, "pend_id")


def pi_awards(e) -> DataFrame:
    """Active awards, with money totals, of all PIs and co-PIs of the listed projects."""
    listed = selection.listed(_projects(e), e.idlist)
    rows = awards.active_awards(awards.investigator_pairs(listed, e.copi), e.awd, e.awd_pi, e.oblg)
    who = e.pi.select("pi_id", "pi_last_name", "pi_frst_name", "pi_emai_addr", F.col("inst_id").alias("_home"))
    home = e.inst.select(F.col("inst_id").alias("_home"), F.col("inst_shrt_name").alias("inst_name"))
    paid = e.inst.select("inst_id", F.col("inst_shrt_name").alias("inst_awd"))
    return (rows.join(who, "pi_id").join(home, "_home").join(paid, "inst_id").drop("_home", "inst_id"))


def pi_pending(e, status=("P",)) -> DataFrame:
    """Other pending proposals of all PIs and co-PIs of the listed projects: panel outcome, number
    of investigators."""
    listed = selection.listed(_projects(e), e.idlist)
    rows = awards.pending(awards.investigator_pairs(listed, e.copi), e.prop, e.copi, list(status))
    who = e.pi_primary.select("pi_id", "pi_last_name", "pi_emai_addr")
    numbers = e.copi.groupBy(F.col("prop_id").alias("pend_id")).agg(F.count(F.lit(1)).alias("_n"))
    facts = e.prop.select(F.col("prop_id").alias("pend_id"), "rqst_dol", "org_code", "pgm_ele_code", "prop_stts_code", "prop_titl_txt", "inst_id").join(
        e.inst.select("inst_id", F.col("inst_shrt_name").alias("inst_name")), "inst_id").drop("inst_id")
    facts = facts.join(numbers, "pend_id", "left").withColumn("numPI", 1 + F.coalesce("_n", F.lit(0))).drop("_n")
    said = e.rec.select(F.col("prop_id").alias("pend_id"), "panl_id", "rcom_seq_num", "rcom_abbr")
    return rows.join(who, "pi_id").join(facts, "pend_id").join(said, "pend_id", "left")


def panel_minutes(e) -> DataFrame:
    """Panel facts, numbers of projects, proposals and panelists, and the conflict text block."""
    heads = stages.projects(e).select("prop_id", c.flag(F.col("prop_id") == F.col("lead")).alias("_h"))
    considered = (e.panl_prop.join(heads, "prop_id", "left").groupBy("panl_id")
                  .agg(F.sum(F.coalesce("_h", F.lit(0))).alias("Nproj"), F.count("prop_id").alias("Nprop")))
    seated = e.panl_revr.groupBy("panl_id").agg(F.count("revr_id").alias("Nrevr"))
    return (e.panl.join(considered, "panl_id", "left").join(seated, "panl_id", "left")
            .join(panels.conflict_text(e.confl, e.revr), "panl_id", "left").fillna(0, ["Nproj", "Nprop"]))


def compliance_by_proposal(e) -> DataFrame:
    """Which documents are there, and money asked against money budgeted.

    A document of the whole project is not asked of non-leads.
    """
    first_budget = e.budg.filter("revn_num = 0").groupBy("prop_id").agg(
        c.money("budg_tot_dol").alias("_cum"), F.sum("pdoc_grnt_dol").alias("_pd"))
    number = (e.copi.groupBy("prop_id").agg(F.count(F.lit(1)).alias("_n")))
    rows = (_projects(e).join(e.subm, "prop_id").join(documents.presence(e.doc), "temp_prop_id", "left")
            .join(first_budget, "prop_id", "left").join(number, "prop_id", "left").join(approvals(e), "prop_id", "left"))
    member = F.col("ILN") == "N"
    return rows.select(
        "ILN", "lead", "prop_id", "org_code", "pgm_ele_code", c.only_if_changed("pgm_ele_code", "orig_pgm_ele_code").alias("orig_pgm_ele_code"),
        c.yes(F.contains(F.upper("prop_titl_txt"), F.lit("GOALI"))).alias("GOALI_flag"), "humn_date", "vrtb_date",
        F.when(member, "N/A").otherwise(documents.project_description()).alias("ProjDesc"),
        documents.references_cited().alias("RefCited"), documents.mentoring_plan(F.col("_pd")).alias("MentPlan"),
        documents.data_plan().alias("DMP"), F.col("budg_expl_pg").alias("budg_just_pg"),
        F.nullif("supp_n", F.lit(0)).alias("oth_supp_cnt"), (1 + F.coalesce("_n", F.lit(0))).alias("tot_PIs"),
        F.col("rqst_dol").alias("tot_rqst_dol"), F.round("_cum", 2).alias("cumulative_tot_dol"),
        c.zero_to_null(F.round(F.col("_cum") - F.coalesce("rqst_dol", F.lit(0.0)), 2)).alias("Diff_tot_dol"))


def compliance_by_project(e) -> DataFrame:
    """Per project: the same on its head, title differences, ten people with their awards."""
    rows = sinks.staged(stages.people_rows(e))  # read for the numbers and for the slots
    numbers = rows.groupBy("lead").agg(F.count(F.lit(1)).alias("NumPIs"), F.count("LastAwd").alias("NumRPS"))
    projects = _projects(e)
    first_budget = (e.budg.filter("revn_num = 0").groupBy("prop_id").agg(c.money("budg_tot_dol").alias("_cum"), F.sum("pdoc_grnt_dol").alias("_pd"))
                    .join(projects.select("prop_id", "lead"), "prop_id").groupBy("lead").agg(c.money("_cum").alias("_cum"), F.sum("_pd").alias("_pd")))
    heads = (selection.one_row_per_project(projects).select("lead", "prop_id", "org_code", "pgm_ele_code", "prop_titl_txt")
             .join(e.subm, "prop_id").join(documents.presence(e.doc), "temp_prop_id", "left"))
    wide = (heads.join(numbers, "lead").join(stages.title_totals(projects), "lead", "left").join(first_budget, "lead", "left")
            .join(stages.people_slots(rows), "lead"))
    people_cols = [x for x in wide.columns if x.startswith("pi") and x[2].isdigit()]
    return wide.select(
        "lead", "org_code", "pgm_ele_code", c.yes(F.contains(F.upper("prop_titl_txt"), F.lit("GOALI"))).alias("GOALI_flag"),
        documents.project_description().alias("ProjDesc"), documents.references_cited().alias("RefCited"),
        documents.mentoring_plan(F.col("_pd")).alias("MentPlan"), documents.data_plan().alias("DMP"), "dif_titl_collab", "tot_rqst_dol",
        F.round("_cum", 2).alias("cumulative_tot_dol"),
        c.zero_to_null(F.round(F.col("_cum") - F.coalesce("tot_rqst_dol", F.lit(0.0)), 2)).alias("Diff_tot_dol"),
        "NumPIs", "NumRPS", *people_cols)


def list_found(e) -> DataFrame:
    """Every listed id with its row in the by-proposal report (two header rows above), or `--`.

    Rows are numbered project by project with two counts: rows before the project, and the place
    inside it, so no task ever sorts the whole report.
    """
    rows = _projects(e).select("lead", "prop_id", F.when(c.heads_project(), -1).otherwise(F.col("prop_id")).alias("_o"))
    sizes = rows.groupBy("lead").agg(F.count(F.lit(1)).alias("_size"))
    upto = running_number(sizes, "lead", {"_upto": F.max("_size")})
    listed = e.idlist.select("prop_id").distinct()
    touched = rows.join(listed, "prop_id", "left_semi").select("lead").distinct()
    inside = cumulative(rows.join(touched, "lead", "left_semi"), ["lead"], "_o", F.shiftright("_o", ID_STEP)).select("lead", "_o", "n_le")
    found = (rows.join(listed, "prop_id", "left_semi").join(inside, ["lead", "_o"]).join(upto, "lead")
             .select("prop_id", (F.col("_upto") - F.col("_size") + F.col("n_le") + 2).cast("string").alias("_row")))
    return e.idlist.join(found, "prop_id", "left").select("prop_id", F.coalesce("_row", F.lit("--")).alias("found"))


def portfolio(e, start="1995-01-01", end="1997-01-01", classes="4%") -> DataFrame:
    """Proposals, projects and money by officer, organisation, announcement, program, request, object class and status, of those recommended in a
    date window in some object classes; names are joined to the groups."""
    window = criteria.apply(stages.date_range(e.prop, "dd_rcom_date", start, end), {"obj_clas_code": classes})
    names = e.org.select(F.col("org_code").alias("_dir"), F.col("dir_div_abbr").alias("Dir"))
    out = stages.portfolio_counts(window, [F.col("pm_ibm_logn_id").alias("PO"), *stages.PORTFOLIO]).withColumn("_dir", c.directorate_code("Org")).join(names, "_dir").drop("_dir")
    for lookup in (e.natr_rqst, e.obj_clas, e.pgm_ele, e.prop_stts.select("prop_stts_code", "prop_stts_abbr")):
        out = out.join(lookup, lookup.columns[0])
    return out.drop("prop_stts_code")


def panel_load_by_org(e, start="1995-01-01", end="1996-01-01") -> DataFrame:
    """Panels and projects on them in a date window, by organisation and program of the projects.

    Reduced to panels and projects per group first; each distinct count is then a plain one.
    """
    window = F.col("panl_bgn_date").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    held = e.panl.filter(window).select("panl_id")
    rows = e.panl_prop.join(held, "panl_id", "left_semi").join(_heads(e).select("prop_id", "lead", "org_code", "pgm_ele_code"), "prop_id")
    by = ["org_code", "pgm_ele_code"]
    panels_of = rows.select(*by, "panl_id").distinct().groupBy(*by).agg(F.count("panl_id").alias("Npanl"))
    projects_of = rows.select(*by, "lead").distinct().groupBy(*by).agg(F.count("lead").alias("Nproj"))
    return panels_of.join(projects_of, by)


def panel_load(e, start="1995-01-01", end="1996-01-01", org_spec="10%") -> DataFrame:
    """Panels per manager in a date window, and the projects of some organisations they review."""
    window = F.col("panl_bgn_date").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    held = e.panl.filter(window).select("panl_id", F.substring("panl_id", 1, 2).alias("manager"))
    heads = criteria.apply(_heads(e), {"org_code": org_spec}).select("prop_id")
    on = e.panl_prop.join(heads, "prop_id", "left_semi").groupBy("panl_id").agg(F.count("prop_id").alias("_n"))
    return held.join(on, "panl_id", "left").groupBy("manager").agg(
        F.count("panl_id").alias("Npanl"), F.count("_n").alias("Nreviewing"), F.sum(F.coalesce("_n", F.lit(0))).alias("Nproj"))
