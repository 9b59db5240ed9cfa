"""Closures of links, and transfers along chains of awards."""

import random

from grantlens.functions.closure import closure
from grantlens.operators import changes


def reached(pairs):
    """(node, reached) -> fewest steps, by walking."""
    near, out = {}, {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
    for start in near:
        at, step, seen = {start}, 0, {start}
        while at:
            step += 1
            at = {y for x in at for y in near.get(x, ())} - seen
            seen |= at
            out.update({(start, y): step for y in at})
    return out


def found(spark, pairs):
    return {(r["node"], r["reached"]): r["hops"] for r in closure(spark.createDataFrame(pairs, "node long, reached long")).collect()}


def test_chains_forks_cycles_and_a_hot_node(spark):
    random.seed(3)
    pairs = [(i, i + 1) for i in range(20)] + [(100, 101), (101, 102), (102, 100)] + [(200 + i, 199) for i in range(60)] + [(199, 198), (5, 5), (7, 300), (300, 9), (0, 1)]
    pairs += [(random.randrange(400, 440), random.randrange(400, 440)) for _ in range(30)]
    assert found(spark, pairs) == reached(pairs)
    assert found(spark, [(1, 1)]) == {} and closure(spark.createDataFrame([], "node long, reached long")).count() == 0


def test_a_chain_of_five_awards(spark):
    """The last proposal continues an award that continues another, five deep; officer and program changed on the way."""
    props = spark.createDataFrame([(p, 1, "I1", f"org{p // 20}", "A" if p < 30 else "B", "po1") for p in (10, 20, 30, 40, 50, 60, 77)], "prop_id long, pi_id long, inst_shrt_name string, org_code string, pgm_ele_code string, pm_ibm_logn_id string")
    projects = spark.createDataFrame([(60, "X"), (77, "X"), (50, "X"), (40, "X"), (30, "X"), (20, "NEW"), (10, "X")], "prop_id long, natr_rqst_code string")
    subm = projects.selectExpr("prop_id", "prop_id + 1000 AS temp_prop_id")
    cover = spark.createDataFrame([(1060, 50), (1050, 40), (1040, 30), (1030, 20), (1020, 10), (1077, None)], "temp_prop_id long, prev_awd_id long")
    log = spark.createDataFrame([(20, 20, "org1", "B", "po9", "2001-01-02"), (20, 20, "org1", "B", "po9", "2001-01-01"), (40, 30, "org2", "B", "po1", "2002-01-01"), (77, 77, "org3", "B", "po1", "2003-01-01")],
                                "awd_id long, last_prop_id long, org_code string, pgm_ele_code string, pm_ibm_logn_id string, awd_chg_date string")
    chain = changes.proposal_awards(projects, log, cover, subm, ["NEW"])
    got = {(r["prop_id"], r["awd_id"]): r["hops"] for r in chain.collect()}
    # The proposal of award 20 was a new one: nothing before it counts, although its cover names an award. 40 also reaches 30 by its log.
    assert {a: h for (p, a), h in got.items() if p == 60} == {60: 0, 50: 1, 40: 2, 30: 3, 20: 4}
    assert got[77, 77] == 0 and len([k for k in got if k[0] == 77]) == 1
    history = spark.createDataFrame([(30, 9, "a", "b", "A", "A", "p", "q", "2000-01-01", None), (30, 1, "a", "b", "A", "A", "p", "q", "2000-01-01", None)],
                                    "prop_id long, ownr_stts_code int, from_org string, to_org string, from_pgm string, to_pgm string, from_lan_id string, to_lan_id string, crtd_date string, note string")
    people = spark.createDataFrame([(1, "Smith")], "pi_id long, pi_last_name string")
    rows = [r.asDict() for r in changes.transfers(chain, props, people, log, history).collect() if r["prop_id"] == 60]
    award = next(r for r in rows if r["xfer_type"] == "awd " and r["awd_id"] == 20)
    assert (award["fromPEC"], award["toPEC"], award["fromPO"], award["toPO"], award["fromORG"], award["toORG"]) == ("A", "B", "po1", "po9", None, "org1")
    assert award["hops"] == 4 and award["crtd_date"] == "2001-01-01" and sum(r["awd_id"] == 20 for r in rows) == 1
    owned = [r for r in rows if r["xfer_type"] == "prop"]
    assert [(r["awd_id"], r["hops"], r["fromORG"], r["fromPEC"], r["fromPO"], r["note"]) for r in owned] == [(30, 3, "a", None, "p", "")]
