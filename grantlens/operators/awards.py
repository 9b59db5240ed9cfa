"""Awards of people: last award, active awards with money, pending proposals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c


def last_award(awd_pi: DataFrame, amounts: DataFrame, start: str, end: str) -> DataFrame:
    """Per person: awards that began in the window, and the latest as `date id.role $amount`.

    The latest is kept as a struct, so its id is a join key without being cut out of the text.
    """
    def bound(d):
        return F.lit(d).cast("timestamp_ntz")

    began = awd_pi.filter(F.col("awd_eff_date").between(bound(start), bound(end)))
    latest = (began.groupBy("pi_id").agg(
        F.count("awd_id").alias("NumAwd"),
        F.max(F.struct(F.to_date("awd_eff_date").alias("day"), F.col("awd_id").cast("string").alias("awd"),
                       F.col("proj_role_code").alias("role"), F.col("awd_id").alias("id"))).alias("last"))
        .withColumn("awd_id", F.col("last.id")))
    text = F.concat(c.dotted_date(F.col("last.day")), F.lit(" "), F.col("last.awd"), F.lit("."), F.col("last.role"),
                    F.lit(" $"), money_text(F.col("awd_amt")))
    return latest.join(amounts, "awd_id").select("pi_id", "NumAwd", text.alias("LastAwd"))


def money_text(amount: Column) -> Column:
    return F.round(amount, 2).cast("decimal(18,2)").cast("string")


def award_amounts(splt: DataFrame) -> DataFrame:
    return splt.groupBy(F.col("prop_id").alias("awd_id")).agg(c.money("budg_splt_tot_dol").alias("awd_amt"))


def active_people(awd_pi: DataFrame) -> DataFrame:
    return awd_pi.filter(F.col("end_date").isNull())


def people_count(awd_pi: DataFrame) -> DataFrame:
    return active_people(awd_pi).groupBy("awd_id").agg(F.countDistinct("pi_id").alias("totPIs"))


def balances(oblg: DataFrame) -> DataFrame:
    return oblg.groupBy(F.col("oblg_id").alias("awd_id")).agg(
        c.money("oblg_amt").alias("totOblg_amt"), c.money("cuml_xpnd_amt").alias("totCuml_xpnd_amt"),
        F.max("last_pymt_date").alias("last_pymt_date"))


def award_money(awd_pi: DataFrame, oblg: DataFrame) -> DataFrame:
    """Per award with active people: how many, obligated, spent, last payment.

    Three independent aggregates joined one to one.
    """
    return people_count(awd_pi).join(balances(oblg), "awd_id")


def investigator_pairs(projects: DataFrame, copi: DataFrame) -> DataFrame:
    """Distinct (lead, prop_id, pi_id) of PIs and co-PIs."""
    own = projects.select("lead", "prop_id", "pi_id")
    others = copi.join(projects.select("lead", "prop_id"), "prop_id").select("lead", "prop_id", "pi_id")
    return own.unionByName(others).distinct()


def held_awards(people: DataFrame, awd: DataFrame, awd_pi: DataFrame, oblg: DataFrame) -> DataFrame:
    """Active awards of people (pi_id), each person and award once, with the money of each award."""
    running = awd.filter("awd_stts_code = '80'").select("awd_id", "inst_id", "tot_intn_awd_amt", "awd_exp_date")
    held = active_people(awd_pi).select("pi_id", "awd_id", "proj_role_code").join(people.select("pi_id").distinct(), "pi_id", "left_semi").join(running, "awd_id")
    money = award_money(awd_pi.join(running, "awd_id", "left_semi"),
                        oblg.join(running, F.col("oblg_id") == F.col("awd_id"), "left_semi"))
    return held.join(money, "awd_id")


def pending_roles(people: DataFrame, prop: DataFrame, copi: DataFrame, status: list[str]) -> DataFrame:
    """pi_id, pend_id, proj_role_code: the pending proposals of people (pi_id), each role once."""
    waiting = prop.filter(F.col("prop_stts_code").isin(status)).select(F.col("prop_id").alias("pend_id"), F.col("pi_id").alias("_pi"))
    as_lead = waiting.select("pend_id", F.col("_pi").alias("pi_id"), F.lit("1").alias("proj_role_code"))
    as_other = (copi.select(F.col("prop_id").alias("pend_id"), "pi_id").join(waiting.select("pend_id"), "pend_id", "left_semi")
                .withColumn("proj_role_code", F.lit("2")))
    roles = as_lead.unionByName(as_other.select("pend_id", "pi_id", "proj_role_code")).distinct()
    return roles.join(people.select("pi_id").distinct(), "pi_id", "left_semi")


def active_awards(pairs: DataFrame, awd: DataFrame, awd_pi: DataFrame, oblg: DataFrame) -> DataFrame:
    """Active awards of everybody in `pairs`, with the money of each award."""
    return pairs.join(held_awards(pairs, awd, awd_pi, oblg), "pi_id")


def pending(pairs: DataFrame, prop: DataFrame, copi: DataFrame, status: list[str]) -> DataFrame:
    """Other pending proposals of everybody in `pairs`, each role once."""
    return pairs.join(pending_roles(pairs, prop, copi, status), "pi_id").filter(F.col("pend_id") != F.col("prop_id"))
