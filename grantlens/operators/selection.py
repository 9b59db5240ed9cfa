"""Projects: a lead proposal and its collaborators, and how a selection of them is made."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c


def with_project(prop: DataFrame) -> DataFrame:
    """Add the role ILN and the project's lead id."""
    return prop.withColumn("ILN", c.role("lead_prop_id", "prop_id")).withColumn(
        "lead", c.lead("lead_prop_id", "prop_id"))


def one_row_per_project(projects: DataFrame) -> DataFrame:
    return projects.filter(c.heads_project())


def expand(selected: DataFrame, prop: DataFrame, tags: Sequence[str] = ()) -> DataFrame:
    """The selection plus all collaborators of every collaboration it touches.

    With `tags` (e.g. a template) a proposal may be selected several times; it is completed per tag.
    A collaborative row is its own sibling, so the siblings already contain the selected rows and
    neither a distinct over wide rows nor an anti join is needed.
    """
    tags = list(tags)
    cols = list(prop.columns)
    touched = (selected.filter(F.col("lead_prop_id").isNotNull())
               .select("lead_prop_id", *tags).distinct())
    siblings = prop.join(touched, "lead_prop_id", "inner" if tags else "left_semi").select(*cols, *tags)
    singles = selected.filter(F.col("lead_prop_id").isNull()).select(*cols, *tags).dropDuplicates(["prop_id", *tags])
    return siblings.unionByName(singles)


def leads_of(selected: DataFrame) -> DataFrame:
    """The distinct project ids of a selection."""
    return selected.select(c.lead("lead_prop_id", "prop_id").alias("lead")).distinct()


def expand_from_leads(leads: DataFrame, prop: DataFrame, copi: DataFrame | None = None) -> DataFrame:
    """Rows of whole projects, starting from lead ids: leads (I or L), non-leads (N), co-PIs (P).

    Columns: ILN, lead, prop_id, pi_id, rqst_dol (0 for co-PIs), prop_titl_txt.
    """
    p = prop.select("prop_id", "lead_prop_id", "pi_id", "rqst_dol", "prop_titl_txt")
    heads = (p.join(leads, F.col("prop_id") == F.col("lead"), "left_semi")
             .withColumn("lead", F.col("prop_id"))
             .withColumn("ILN", F.when(F.col("lead_prop_id").isNull(), "I").otherwise("L")))
    # the lead itself must exist for its collaborators to be taken
    members = (p.filter(F.col("lead_prop_id") != F.col("prop_id"))
               .join(heads.select(F.col("prop_id").alias("lead")), F.col("lead_prop_id") == F.col("lead"))
               .withColumn("ILN", F.lit("N")))
    cols = ["ILN", "lead", "prop_id", "pi_id", "rqst_dol", "prop_titl_txt"]
    rows = heads.select(*cols).unionByName(members.select(*cols))
    if copi is None:
        return rows
    others = (rows.select("lead", "prop_id").join(copi.select("prop_id", "pi_id"), "prop_id")
              .select(F.lit("P").alias("ILN"), "lead", "prop_id", "pi_id", F.lit(0.0).alias("rqst_dol"),
                      F.lit("").alias("prop_titl_txt")))
    return rows.unionByName(others)


def add_and_omit(criteria: DataFrame, prop: DataFrame, added: DataFrame, omitted: DataFrame) -> DataFrame:
    """Criteria set and added ids, completed to whole projects, then without the omitted ids."""
    listed = prop.join(added, "prop_id", "left_semi")
    return (expand(criteria.unionByName(listed), prop)
            .dropDuplicates(["prop_id"])
            .join(omitted, "prop_id", "left_anti"))


def criteria_or_list(prop: DataFrame, cond: Column, ids: DataFrame) -> DataFrame:
    marked = prop.join(ids.select("prop_id").distinct().withColumn("_listed", F.lit(1)), "prop_id", "left")
    return marked.filter(cond | F.col("_listed").isNotNull()).drop("_listed")


def criteria_not_list(prop: DataFrame, cond: Column, ids: DataFrame) -> DataFrame:
    """Taken before leads are looked up, so a listed lead may come back through a collaborator."""
    return prop.filter(cond).join(ids, "prop_id", "left_anti")


def listed(projects: DataFrame, ids: DataFrame) -> DataFrame:
    """Proposals that are listed, or whose lead is."""
    by_id = projects.join(ids.select("prop_id"), "prop_id", "left_semi")
    by_lead = (projects.filter(F.col("lead_prop_id") != F.col("prop_id"))
               .join(ids.select(F.col("prop_id").alias("lead_prop_id")), "lead_prop_id", "left_semi")
               .join(ids.select("prop_id"), "prop_id", "left_anti"))
    return by_id.unionByName(by_lead)


def base_rows(projects: DataFrame, org: DataFrame, pi_primary: DataFrame, inst: DataFrame, names: Sequence[DataFrame] = ()) -> DataFrame:
    """One denormalised row per proposal; the directorate is found by a key made from the division's.

    names: lookups of codes, each with the code's column first.
    """
    return base_names(base_people(projects, pi_primary), org, inst, names)


def base_people(projects: DataFrame, pi_primary: DataFrame) -> DataFrame:
    """What of the denormalised row is joined by a shuffle: the proposal and its investigator."""
    return projects.join(pi_primary.select("pi_id", "pi_last_name", "pi_frst_name", "pi_emai_addr"), "pi_id")


def base_names(projects: DataFrame, org: DataFrame, inst: DataFrame, names: Sequence[DataFrame] = ()) -> DataFrame:
    """The rest of the row, from small lookups: it can wait until rows have been shuffled for other joins."""
    division = org.select("org_code", F.col("dir_div_abbr").alias("Div"))
    directorate = org.select(F.col("org_code").alias("_dir"), F.col("dir_div_abbr").alias("Dir"))
    place = inst.select("inst_id", F.col("inst_shrt_name").alias("inst_name"), "st_code")
    for lookup in names:
        projects = projects.join(lookup, lookup.columns[0])
    return (
        projects.join(division, "org_code")
        .withColumn("_dir", c.directorate_code("org_code")).join(directorate, "_dir").drop("_dir")
        .join(place, "inst_id")
        .withColumn("origPEC", c.only_if_changed("pgm_ele_code", "orig_pgm_ele_code"))
        .withColumn("origORG", c.only_if_changed("org_code", "orig_org_code"))
        .withColumnRenamed("pm_ibm_logn_id", "PO")
        .withColumn("OrgLabel", F.concat_ws(" - ", "org_code", "Div"))
        .withColumn("dd_rcom_date", c.real_date("dd_rcom_date"))
    )


BASE = ["received_date", "dd_rcom_date", "pgm_annc_id", "Dir", "org_code", "origORG", "OrgLabel", "pgm_ele_code", "Pgm", "origPEC",
        "PO", "obj_clas_code", "natr_rqst_abbr", "prop_stts_abbr", "prop_stts_txt", "rqst_eff_date", "rqst_mnth_cnt", "cntx_stmt_id",
        "natr_rqst_code", "prop_stts_code", "ILN", "lead", "Div", "prop_id", "pi_last_name", "pi_frst_name",
        "inst_name", "st_code", "pi_emai_addr", "prop_titl_txt", "rqst_dol", "inst_id", "pi_id"]


def project_counts(projects: DataFrame, copi: DataFrame, panl_prop: DataFrame) -> DataFrame:
    """Per lead: proposals, investigators (1 + co-PIs each), panels of the lead, highest panel id."""
    co = copi.groupBy("prop_id").agg(F.count(F.lit(1)).alias("_n"))
    people = (projects.select("lead", "prop_id").join(co, "prop_id", "left")
              .groupBy("lead").agg(F.count(F.lit(1)).alias("nProp"),
                                   F.sum(1 + F.coalesce("_n", F.lit(0))).alias("nPI")))
    panels = (panl_prop.groupBy(F.col("prop_id").alias("lead"))
              .agg(F.count("panl_id").alias("nPanl"), F.max("panl_id").alias("panl_idmax")))
    return people.join(panels, "lead", "left").fillna(0, ["nPanl"])


def project_totals(projects: DataFrame, budget_totals: DataFrame) -> DataFrame:
    """Per lead: requested and budgeted money and the highest budget revision."""
    return (projects.select("lead", "prop_id", "rqst_dol")
            .join(budget_totals.select("prop_id", "RN", "T"), "prop_id", "left")
            .groupBy("lead")
            .agg(c.money("rqst_dol").alias("rqst_tot"), c.money("T").alias("budg_tot"),
                 F.max("RN").alias("budRevnMax")))
