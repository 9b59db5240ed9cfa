"""Transfers: what changed hands, at the award and at the proposal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.closure import closure

# What may change hands: the column of an award's log and of a proposal, and how an ownership history calls it before and after.
PARTS = {"ORG": ("org_code", "from_org", "to_org"), "PEC": ("pgm_ele_code", "from_pgm", "to_pgm"), "PO": ("pm_ibm_logn_id", "from_lan_id", "to_lan_id")}


def links(projects: DataFrame, log: DataFrame, cover: DataFrame, subm: DataFrame, new_kinds: list[str]) -> DataFrame:
    """node, reached: from a proposal to the earlier award that it continues, and from an award to the proposal that its log names."""
    earlier = (projects.filter(~F.col("natr_rqst_code").isin(new_kinds)).select("prop_id")
               .join(subm, "prop_id").join(cover.select("temp_prop_id", "prev_awd_id"), "temp_prop_id")
               .filter(F.col("prev_awd_id").isNotNull())
               .select(F.col("prop_id").alias("node"), F.col("prev_awd_id").alias("reached")))
    named = log.select(F.col("awd_id").alias("node"), F.col("last_prop_id").alias("reached"))
    return earlier.unionByName(named).distinct()


def proposal_awards(projects: DataFrame, log: DataFrame, cover: DataFrame, subm: DataFrame, new_kinds: list[str]) -> DataFrame:
    """prop_id, awd_id, hops: a proposal's own award (0 hops) and all earlier ones along the chain, however long."""
    own = projects.select("prop_id", F.col("prop_id").alias("awd_id"), F.lit(0).cast("long").alias("hops"))
    chain = closure(links(projects, log, cover, subm, new_kinds))
    earlier = chain.select(F.col("node").alias("prop_id"), F.col("reached").alias("awd_id"), "hops").join(projects.select("prop_id"), "prop_id", "left_semi")
    return own.unionByName(earlier)


def transfers(awards: DataFrame, props: DataFrame, people: DataFrame, log: DataFrame, history: DataFrame) -> DataFrame:
    """Changes of the awards that a proposal's chain holds, and of the proposals on it.

    At an award, the earlier value is that of the proposal its log names; only values that differ are shown, and equal changes are one
    row with their first date. They are merged per award before they meet the proposals, so a long log is reduced first. A proposal's
    ownership history knows both sides itself (status 9 is a completed transfer).
    awards: prop_id, awd_id, hops. props: prop_id, pi_id, inst and the columns of PARTS. people: pi_id, pi_last_name.
    """
    now = [own for own, _, _ in PARTS.values()]
    merged = log.groupBy("awd_id", "last_prop_id", *now).agg(F.min("awd_chg_date").alias("crtd_date"))
    source = props.join(people, "pi_id").select(F.col("prop_id").alias("last_prop_id"), "pi_last_name", "inst_shrt_name", *[F.col(x).alias(f"_{x}") for x in now])
    sides = [x for part, (own, _, _) in PARTS.items() for x in (c.only_if_changed(own, f"_{own}").alias(f"from{part}"), F.col(own).alias(f"to{part}"))]
    of_award = merged.join(source, "last_prop_id").select("awd_id", "last_prop_id", "pi_last_name", "inst_shrt_name", *sides, "crtd_date")
    names = [f"{side}{part}" for part in PARTS for side in ("from", "to")]
    keys = ["awd_id", "pi_last_name", "inst_shrt_name", *names]
    of_award = of_award.groupBy(*keys).agg(F.min("last_prop_id").alias("last_prop_id"), F.min("crtd_date").alias("crtd_date"))
    by_award = awards.join(of_award, "awd_id").select(
        "prop_id", "awd_id", "hops", "last_prop_id", F.lit("awd ").alias("xfer_type"), "pi_last_name", "inst_shrt_name", *names, "crtd_date", F.lit(None).cast("string").alias("note"))
    done = history.filter("ownr_stts_code = 9").withColumnRenamed("prop_id", "awd_id")
    sides = [x for part, (_, before, after) in PARTS.items() for x in (c.only_if_changed(after, before).alias(f"from{part}"), F.col(after).alias(f"to{part}"))]
    holder = props.join(people, "pi_id").select(F.col("prop_id").alias("awd_id"), "pi_last_name", "inst_shrt_name")
    of_proposal = done.join(holder, "awd_id").select("awd_id", "pi_last_name", "inst_shrt_name", *sides, "crtd_date", F.coalesce("note", F.lit("")).alias("note"))
    by_proposal = awards.join(of_proposal, "awd_id").select(
        "prop_id", "awd_id", "hops", F.col("awd_id").alias("last_prop_id"), F.lit("prop").alias("xfer_type"), "pi_last_name", "inst_shrt_name", *names, "crtd_date", "note")
    return by_award.unionByName(by_proposal)
