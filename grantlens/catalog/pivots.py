"""Dashboard pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions import criteria
from ..operators import cube, pivots, selection
from ..plans import stages
from .registry import LIST_CHECKS, LISTS, query

STATUS = ("F", "O", "P")


def _rollup(dims: list[str], select: str, src: str) -> str:
    """Subtotals written as a union of groupings."""
    parts = []
    for k in range(len(dims), -1, -1):
        shown = ", ".join(f"CAST({d} AS STRING) AS {d}" if i < k else f"'Total' AS {d}" for i, d in enumerate(dims))
        group = f" GROUP BY {', '.join(dims[:k])}" if k else ""
        parts.append(f"SELECT {shown}, {select} FROM {src}{group}")
    return " UNION ALL ".join(parts)


_BASE = """bs AS (SELECT o2.dir_div_abbr AS "Dir", o.dir_div_abbr AS "Div", p.pgm_ele_code AS pgm, p.* FROM v_prj p JOIN v_org o ON o.org_code = p.org_code JOIN v_org o2 ON o2.org_code = left(p.org_code, 2) || '000000')"""



def _counted(e, dims: list[str], kept: DataFrame | None = None) -> DataFrame:
    """Proposals counted over dimensions of the cube, with subtotals."""
    return pivots.totalled(stages.proposal_cube(e) if kept is None else kept, dims, F.sum("n").alias("n"))


def _across(e, rows: DataFrame, dims: list[str], by: str, values, prefix: str) -> DataFrame:
    return pivots.totalled(rows, dims, *[F.coalesce(F.sum(F.when(F.col(by) == v, F.col("n"))), F.lit(0)).alias(f"{prefix}{v}") for v in values], F.sum("n").alias("n"))


# One pivot for each dimension of the cube that proposals are counted by: status, object class, kind of summary, program, request, organisation, officer.
for _name, _dim in {"pvt_count_1d": "prop_stts_code", "pvt_count_class": "obj_clas_code", "pvt_count_kind": "ILN", "pvt_count_program": "pgm_ele_code",
                    "pvt_count_request": "natr_rqst_code", "pvt_count_organisation": "org_code", "pvt_count_officer": "PO"}.items():
    _added = {} if _name not in ("pvt_count_class", "pvt_count_kind", "pvt_count_officer") else {"queries": LISTS, "checks": LIST_CHECKS}
    query(_name, _rollup([_dim], "count(*) AS n", "(SELECT *, pm_ibm_logn_id AS PO FROM v_prj) t"), **_added)(lambda e, dim=_dim: _counted(e, [dim]))


@query("pvt_count_investigator", _rollup(["pi_id"], "count(*) AS n", "v_prop"))
def pvt_count_investigator(e):
    """Counted from the proposals: investigators are too many for the cube."""
    return pivots.totalled(e.facts, ["pi_id"], F.count(F.lit(1)).alias("n"))


REQUESTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("pvt_program_request", _rollup(["pgm_ele_code"], ", ".join(f"count(*) FILTER (WHERE natr_rqst_code = '{r}') AS \"rq_{r}\"" for r in REQUESTS) + ", count(*) AS n", "v_prop"))
def pvt_program_request(e):
    """Programs down, kinds of request across."""
    return _across(e, stages.proposal_cube(e), ["pgm_ele_code"], "natr_rqst_code", REQUESTS, "rq_")


_ACROSS = ", ".join(f"count(CASE WHEN prop_stts_code = '{s}' THEN 1 END) AS \"st_{s}\"" for s in STATUS) + ", count(*) AS n"


@query("pvt_count_2d", f"WITH {_BASE} " + _rollup(['"Dir"', '"Div"', "pgm"], _ACROSS, "bs"))
def pvt_count_2d(e):
    return _across(e, stages.proposal_cube(e).withColumnRenamed("pgm_ele_code", "pgm"), ["Dir", "Div", "pgm"], "prop_stts_code", STATUS, "st_")


_TICKS = "CAST(sum(CAST(CAST(rqst_dol AS DECIMAL(18,4)) * 10000 AS BIGINT)) AS BIGINT)"
_MONEY = f"round(min(rqst_dol), 2) AS min_dol, ((2 * {_TICKS} + count(rqst_dol)) // (2 * count(rqst_dol))) / 10000 AS avg_dol, round(max(rqst_dol), 2) AS max_dol"


@query("pvt_minavgmax", f"WITH {_BASE} " + _rollup(['"Dir"', '"Div"', "pgm"], _MONEY, "bs"))
def pvt_minavgmax(e):
    found = cube.measures()
    return pivots.totalled(stages.proposal_cube(e).withColumnRenamed("pgm_ele_code", "pgm"), ["Dir", "Div", "pgm"], *[found[m].alias(m) for m in ("min_dol", "avg_dol", "max_dol")])


@query("pvt_sum", """
WITH d AS (SELECT lead, min(strftime(received_date, '%m/%d/%y')) FILTER ("ILN" < 'M') AS day, count(*) AS n FROM v_prj GROUP BY lead)
SELECT day, CAST(sum(n) AS BIGINT) AS "nProp" FROM d GROUP BY day UNION ALL SELECT 'Total', CAST(sum(n) AS BIGINT) FROM d""")
def pvt_sum(e):
    """Proposals by the day their project was received, as mm/dd/yy."""
    projects = selection.with_project(e.prop)
    per = projects.groupBy("lead").agg(F.min(F.when(c.heads_project(), c.us_date("received_date"))).alias("day"),
                                       F.count(F.lit(1)).alias("n"))
    return pivots.totalled(per, ["day"], F.sum("n").alias("nProp"))


@query("pvt_people", """
WITH q AS (SELECT pi.pi_last_name || ', ' || pi.pi_frst_name AS pi_name, i.inst_shrt_name AS inst, v.pers FROM v_person v JOIN v_pi pi ON pi.pi_id = v.pi_id AND pi.prim_addr_flag = 'Y' JOIN v_inst i ON i.inst_id = pi.inst_id) """
    + _rollup(["inst", "pi_name"], "count(CASE WHEN pers = ' PI' THEN 1 END) AS \"PI\", count(CASE WHEN pers = 'coPI' THEN 1 END) AS \"coPI\", count(*) AS n", "q"))
def pvt_people(e):
    """Counted per person and role before names are joined."""
    n = e.person.groupBy("pi_id").agg(F.count_if(F.col("pers") == " PI").alias("a"), F.count_if(F.col("pers") == "coPI").alias("b"))
    named = (n.join(e.pi_primary, "pi_id").join(e.inst, "inst_id")
             .select(F.col("inst_shrt_name").alias("inst"), F.concat_ws(", ", "pi_last_name", "pi_frst_name").alias("pi_name"), "a", "b"))
    return pivots.totalled(named, ["inst", "pi_name"], F.sum("a").alias("PI"), F.sum("b").alias("coPI"), F.sum(F.col("a") + F.col("b")).alias("n"))


@query("pvt_filtered", f"""WITH {_BASE}, f AS (SELECT * FROM bs WHERE "Dir" <> 'ASIA' AND natr_rqst_code IN ('BUILDING', 'MACHINERY') AND "ILN" IN ('I', 'L')) """
       + _rollup(["pgm"], _ACROSS, "f"))
def pvt_filtered(e):
    kept = criteria.apply(stages.proposal_cube(e), {"Dir": "~ASIA", "natr_rqst_code": "BUILDING,MACHINERY", "ILN": "I,L", "Div": "eg:X"})
    return _across(e, kept.withColumnRenamed("pgm_ele_code", "pgm"), ["pgm"], "prop_stts_code", STATUS, "st_")


@query("pvt_sliced", """WITH f AS (SELECT pm_ibm_logn_id AS "PO", * FROM v_prj WHERE obj_clas_code IN ('4100', '4110') AND pm_ibm_logn_id <> 'po3' AND pgm_ele_code >= '2' AND pgm_ele_code <= '4' AND prop_stts_code IN ('F', 'O')) """
       + _rollup(['"PO"', "obj_clas_code"], _ACROSS, "f"), LISTS, LIST_CHECKS)
def pvt_sliced(e):
    """Officers and object classes down, status across, with slicers on four dimensions."""
    kept = criteria.apply(stages.proposal_cube(e), {"obj_clas_code": "4100,4110", "PO": "~po3", "pgm_ele_code": "2::4", "prop_stts_code": "F,O"})
    return _across(e, kept, ["PO", "obj_clas_code"], "prop_stts_code", STATUS, "st_")
