"""Investigators, senior people and reviewers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_first(last: str, first: str) -> Column:
    return F.concat_ws(", ", F.rtrim(last), F.rtrim(first))


def first_last_place(first: str, last: str, place: str) -> Column:
    return F.concat(F.rtrim(first), F.lit(" "), F.rtrim(last), F.lit(", "), F.coalesce(F.rtrim(place), F.lit("")))


def demographics(person: DataFrame, pi: DataFrame, attributes: DataFrame) -> DataFrame:
    """Per proposal four counts over (investigator x address x attribute) rows.

    A person with several attribute rows is counted that often, as the reports always did. The
    products are formed per person first, so the join to proposals never multiplies rows.
    """
    address = pi.groupBy("pi_id").agg(F.count(F.lit(1)).alias("_a"), F.count_if(F.col("pi_gend_code") == "F").alias("_f"),
                                      F.count_if(F.col("pi_ethn_code") == "H").alias("_h"))
    handicap = (F.col("dmog_tbl_code") == "H") & (F.col("dmog_code") != "N")
    race = (F.col("dmog_tbl_code") == "R") & ~F.col("dmog_code").isin("U", "W", "B3")
    attribute = attributes.groupBy("pi_id").agg(F.count(F.lit(1)).alias("_d"), F.count_if(handicap).alias("_hc"),
                                                F.count_if(race).alias("_nw"))
    per_person = (address.join(attribute, "pi_id", "full")
                  .select("pi_id",
                          (F.coalesce("_f", F.lit(0)) * F.coalesce("_d", F.lit(1))).alias("_f"),
                          (F.coalesce("_h", F.lit(0)) * F.coalesce("_d", F.lit(1))).alias("_h"),
                          (F.coalesce("_hc", F.lit(0)) * F.coalesce("_a", F.lit(1))).alias("_hc"),
                          (F.coalesce("_nw", F.lit(0)) * F.coalesce("_a", F.lit(1))).alias("_nw")))
    sums = {"NfmlPIs": "_f", "NhispPIs": "_h", "NhndcpPIs": "_hc", "NnonWhtAsnPIs": "_nw"}
    return (person.join(per_person, "pi_id", "left").groupBy("prop_id")
            .agg(*[F.sum(F.coalesce(f, F.lit(0))).alias(n) for n, f in sums.items()]))


NAME = ["prop_id", "last_name", "frst_name", "inst_shrt_name"]


def investigators(projects: DataFrame, copi: DataFrame, pi_primary: DataFrame, inst: DataFrame) -> DataFrame:
    """PI rows (with the project's title, money and institution) and co-PI rows."""
    who = pi_primary.select("pi_id", F.col("pi_last_name").alias("last_name"), F.col("pi_frst_name").alias("frst_name"),
                            F.col("inst_id").alias("_home"), "pi_gend_code", "pi_emai_addr")
    place = inst.select("inst_id", "inst_shrt_name")
    cols = ["prop_id", "ILN", "pers", "last_name", "frst_name", "inst_shrt_name", "pi_gend_code", "pi_emai_addr", "pi_id", "rqst_dol"]
    lead = (projects.join(who, "pi_id").join(place, "inst_id").withColumn("pers", F.lit(" PI")).select(*cols))
    others = (copi.join(projects.select("prop_id", "ILN"), "prop_id").join(who, "pi_id")
              .join(place.withColumnRenamed("inst_id", "_home"), "_home")
              .withColumn("pers", F.lit("coPI")).withColumn("rqst_dol", F.lit(0.0)).select(*cols))
    return lead.unionByName(others)


def add_new(people: DataFrame, candidates: DataFrame, kind: str) -> DataFrame:
    """Append people who have no id, only where (proposal, last, first, institution) is new."""
    fresh = candidates.join(people.select(*NAME), NAME, "left_anti").distinct()
    return people.unionByName(fresh.withColumn("pers", F.lit(kind)).withColumn("rqst_dol", F.lit(0.0)),
                              allowMissingColumns=True)


def candidates(named: DataFrame, projects: DataFrame, inst: DataFrame) -> DataFrame:
    return (named.join(projects.select("prop_id", "ILN"), "prop_id")
            .join(inst.select("inst_id", "inst_shrt_name"), "inst_id").select(*NAME, "ILN").distinct())


def emails(revr_mail: DataFrame) -> DataFrame:
    return revr_mail.filter("addr_lne_type_code = 'E'").select("revr_id", F.col("revr_addr_txt").alias("revr_email"))


def reviewer_facts(revr: DataFrame, revr_mail: DataFrame, inst: DataFrame) -> DataFrame:
    return (revr.join(inst.select("inst_id", "inst_shrt_name", "st_code"), "inst_id", "left")
            .join(emails(revr_mail), "revr_id", "left")
            .select("revr_id", "revr_last_name", "revr_frst_name", "inst_id", "inst_shrt_name", "st_code", "revr_email"))


def conflicted_with_place(rev: DataFrame, revr: DataFrame, inst: DataFrame) -> DataFrame:
    """Distinct reviewers in conflict with any of the proposals, with their institution."""
    return (rev.filter("rev_stts_code = 'C'").select("revr_id").distinct()
            .join(revr, "revr_id").join(inst.select("inst_id", "inst_shrt_name"), "inst_id", "left")
            .select("revr_id", "inst_shrt_name", last_first("revr_last_name", "revr_frst_name").alias("Panelist")))
