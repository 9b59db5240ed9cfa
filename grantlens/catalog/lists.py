"""Complete lists beside the capped columns of ratings by panel, conflicted people, addresses, investigators and recommendations."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..functions.ordered import numbered
from ..operators import panels, selection
from ..plans import stages
from . import registry
from .complete import _sql
from .strings import ASSESSED
from .windows import PEOPLE

listed = partial(registry.query, queries=registry.LISTS, checks=registry.LIST_CHECKS)


@listed("all_ratings_by_panel", f"WITH {ASSESSED} " + _sql("SELECT lead, panl_id, -score AS below, revr_id, string FROM rv WHERE confl = 0", "lead, panl_id", "below, revr_id, string"))
def all_ratings_by_panel(e):
    """Every rating of a project by the panel it is credited to, best first; reviews without a score come first."""
    rows = stages.lead_reviews(e, True).filter("confl = 0").select("lead", "panl_id", (-F.col("score")).alias("below"), "revr_id", "string")
    return numbered(rows, ["lead", "panl_id"], ["below", "revr_id", "string"], F.struct("below", F.floor(F.col("revr_id") / 4096)))


@listed("all_conflict_people", f"WITH {ASSESSED} " + _sql("""SELECT c.lead, c.panl_id, v.revr_last_name, v.revr_id, v.revr_frst_name, i.inst_shrt_name FROM rv c JOIN v_revr v ON v.revr_id = c.revr_id
LEFT JOIN v_inst i ON i.inst_id = v.inst_id WHERE c.confl = 1 AND EXISTS (SELECT 1 FROM rv h WHERE h.lead = c.lead AND h.panl_id = c.panl_id AND h.confl = 0)""",
                                                                   "lead, panl_id", "revr_last_name, revr_id, revr_frst_name, inst_shrt_name"))
def all_conflict_people(e):
    """Every conflicted person of a panel that reviewed the project."""
    rows = panels.conflicted(stages.lead_reviews(e, True), e.revr, e.inst)
    return numbered(rows, ["lead", "panl_id"], ["revr_last_name", "revr_id", "revr_frst_name", "inst_shrt_name"], F.struct(F.substring("revr_last_name", 1, 2)))


@listed("all_emails", _sql("SELECT p.lead, p.\"ILN\" AS iln, p.prop_id, pi.pi_emai_addr FROM v_prj p LEFT JOIN v_pi pi ON pi.pi_id = p.pi_id AND pi.prim_addr_flag = 'Y'",
                           "lead", "iln, prop_id, pi_emai_addr"))
def all_emails(e):
    """The whole address of the PI of every proposal of a project, its head first."""
    rows = selection.with_project(e.prop).join(e.pi_primary.select("pi_id", "pi_emai_addr"), "pi_id", "left").select("lead", F.col("ILN").alias("iln"), "prop_id", "pi_emai_addr")
    return numbered(rows, ["lead"], ["iln", "prop_id", "pi_emai_addr"], F.struct("iln", F.floor(F.col("prop_id") / 4096)))


@listed("all_people", f"WITH {PEOPLE} " + _sql("""SELECT lead, "ILN" AS iln, -coalesce("NumAwd", 0) AS fewer, prop_id, pi_id, pi_last_name, pi_emai_addr, inst_shrt_name, "NumAwd" AS num_awd, "LastAwd" AS last_awd FROM ps""",
                                               "lead", "iln, fewer, prop_id, pi_id, pi_last_name, pi_emai_addr, inst_shrt_name, num_awd, last_awd"))
def all_people(e):
    """Every investigator of a project with their awards, in the order of the slots: PIs first, those with more awards first."""
    rows = stages.people_rows(e).withColumnsRenamed({"ILN": "iln", "NumAwd": "num_awd", "LastAwd": "last_awd"}).withColumn("fewer", -F.coalesce("num_awd", F.lit(0)))
    return numbered(rows, ["lead"], ["iln", "fewer", "prop_id", "pi_id", "pi_last_name", "pi_emai_addr", "inst_shrt_name", "num_awd", "last_awd"],
                    F.struct("iln", "fewer", F.floor(F.col("prop_id") / 4096)))


@listed("all_recommendations", _sql("SELECT prop_id, panl_id, rcom_abbr, prop_ordr FROM v_rec", "prop_id", "panl_id, rcom_abbr, prop_ordr"))
def all_recommendations(e):
    """What every panel said of a proposal, non-leads too."""
    return numbered(e.rec, ["prop_id"], ["panl_id", "rcom_abbr", "prop_ordr"], F.struct(F.substring("panl_id", 1, 3)))
