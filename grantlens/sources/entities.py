"""The proposal entities, projected lazily from the base tables.

Small fixed dimensions (regions, nations, ratings) carry a broadcast hint; every other join is left
to Spark, which broadcasts only below its size threshold.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import previous_value
from ..session import expect
from .inputs import rating_table
from .tables import Catalog


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def _text(c: Column) -> Column:
    return c.cast("string")


class Entities:
    def __init__(self, spark: SparkSession, folder: str, sized: bool = False):
        """With `sized`, the session is this query's own and its shuffles follow what the opened tables hold."""
        self.spark, self.folder, self.sized = spark, folder, sized
        self.catalog = Catalog(spark, folder)
        self._tables: dict[str, DataFrame] = {}
        self._sizes: dict[str, int] = {}  # of opened tables; copies of these entities share both

    def table(self, name: str) -> DataFrame:
        """A base table; its footer is read once per set of entities."""
        if name not in self._tables:
            self._tables[name] = self.catalog.table(name)
            if self.sized:
                self._sizes[name] = self.catalog.size(name)
                expect(self.spark, sum(self._sizes.values()))
        return self._tables[name]

    @cached_property
    def nation(self) -> DataFrame:
        return F.broadcast(self.table("nation"))  # 25 rows

    # --- proposals -------------------------------------------------------------------------

    @cached_property
    def facts(self) -> DataFrame:
        """What a proposal's own table holds: enough for ids, projects, status, dates and money, without a join."""
        k, prio = F.col("o_orderkey"), F.col("o_orderpriority")
        return self.table("orders").select(
            k.alias("prop_id"),
            F.when(k % 4 != 3, k - k % 4).alias("lead_prop_id"),
            F.col("o_custkey").alias("pi_id"),
            prio.alias("pgm_ele_code"),
            F.when(k % 7 == 0, "5-LOW").otherwise(prio).alias("orig_pgm_ele_code"),
            F.col("o_orderstatus").alias("prop_stts_code"),
            F.col("o_totalprice").alias("rqst_dol"),
            F.col("o_orderdate").alias("received_date"),
            F.when(F.col("o_orderstatus") == "O", F.lit("1900-01-01").cast("timestamp_ntz"))
            .otherwise(F.col("o_orderdate") + _days(90)).alias("dd_rcom_date"),
            F.when(k % 5 == 0, 0.75).otherwise(1.0).alias("bas_rsch_pct"),
            F.when(k % 10 == 0, 0.25).otherwise(0.0).alias("other_pct"),
            F.concat(F.lit("po"), _text(k % 13)).alias("pm_ibm_logn_id"),
            F.when(k % 3 == 0, "4100").when(k % 3 == 1, "4110").otherwise("4120").alias("obj_clas_code"),
            F.concat(F.lit("PA-"), _text(k % 5)).alias("pgm_annc_id"),
            (F.col("o_orderdate") + _days(180)).alias("rqst_eff_date"),
            (12 + 12 * (k % 5)).alias("rqst_mnth_cnt"),
            F.when(k % 6 == 0, F.concat(F.lit("C"), _text(k % 4))).alias("cntx_stmt_id"),
            *[F.when(k % m == 1, share).otherwise(0.0).alias(name) for name, (m, share) in SHARES.items()],
        )

    @cached_property
    def prop(self) -> DataFrame:
        """Proposals with the facts that come from their investigator: organisation, institution, request and title."""
        k = F.col("prop_id")
        return (
            self.facts.join(self.table("customer"), F.col("c_custkey") == F.col("pi_id"))
            .join(self.nation, F.col("n_nationkey") == F.col("c_nationkey"))
            .select(
                "prop_id", "lead_prop_id", "pi_id", F.col("c_nationkey").alias("inst_id"), _org_code().alias("org_code"),
                F.when(k % 11 == 0, "10000001").otherwise(_org_code()).alias("orig_org_code"),
                "pgm_ele_code", "orig_pgm_ele_code", "prop_stts_code", F.col("c_mktsegment").alias("natr_rqst_code"),
                "rqst_dol", "received_date", "dd_rcom_date", "bas_rsch_pct", "other_pct",
                "pm_ibm_logn_id", "obj_clas_code", "pgm_annc_id", "rqst_eff_date", "rqst_mnth_cnt", "cntx_stmt_id", *SHARES,
                F.concat(F.when(k % 23 == 0, "Goali: ").otherwise(""), "c_mktsegment", F.lit(" study "),
                         _text(k - k % 4), F.when(k % 29 == 1, " (revised)").otherwise("")).alias("prop_titl_txt"),
            )
        )

    def _named_codes(self, rows: dict[str, tuple[str, ...]], schema: str) -> DataFrame:
        """A fixed lookup of a few codes."""
        return F.broadcast(self.spark.createDataFrame([(code, *names) for code, names in rows.items()], schema))

    @cached_property
    def pgm_ele(self) -> DataFrame:
        return self._named_codes(PROGRAMS, "pgm_ele_code string, pgm_ele_name string")

    @cached_property
    def prop_stts(self) -> DataFrame:
        return self._named_codes(STATUSES, "prop_stts_code string, prop_stts_abbr string, prop_stts_txt string")

    @cached_property
    def natr_rqst(self) -> DataFrame:
        return self._named_codes(REQUESTS, "natr_rqst_code string, natr_rqst_abbr string")

    @cached_property
    def obj_clas(self) -> DataFrame:
        return self._named_codes(CLASSES, "obj_clas_code string, obj_clas_name string")

    @cached_property
    def keys(self) -> DataFrame:
        """Proposal, lead and request alone: one table where no other fact of a proposal is needed."""
        k = F.col("o_orderkey")
        return self.table("orders").select(k.alias("prop_id"), F.when(k % 4 != 3, k - k % 4).alias("lead_prop_id"),
                                           F.col("o_totalprice").alias("rqst_dol"))

    @cached_property
    def org(self) -> DataFrame:
        divisions = self.nation.select(_org_code().alias("org_code"), F.col("n_name").alias("dir_div_abbr"))
        directorates = self.table("region").select(
            F.concat(_text(F.col("r_regionkey") + 10), F.lit("000000")).alias("org_code"),
            F.col("r_name").alias("dir_div_abbr"))
        return F.broadcast(divisions.unionByName(directorates))  # 30 rows

    @cached_property
    def inst(self) -> DataFrame:
        return self.nation.select(
            F.col("n_nationkey").alias("inst_id"), F.col("n_name").alias("inst_shrt_name"),
            F.concat(F.lit("S"), _text(F.col("n_regionkey"))).alias("st_code"))

    @cached_property
    def ctry(self) -> DataFrame:
        return self.nation.select(F.lpad(_text(F.col("n_nationkey")), 4, "0").alias("ctry_code"),
                                  F.col("n_name").alias("ctry_name"))

    # --- people ----------------------------------------------------------------------------

    @cached_property
    def pi(self) -> DataFrame:
        k = F.col("c_custkey")

        def rows(df, primary, host):
            return df.select(
                k.alias("pi_id"), F.col("c_name").alias("pi_last_name"),
                F.concat(F.lit("F"), _text(k % 10)).alias("pi_frst_name"), F.lit(primary).alias("prim_addr_flag"),
                F.concat(F.lower("c_name"), F.lit(host)).alias("pi_emai_addr"),
                F.col("c_nationkey").alias("inst_id"),
                F.when(k % 3 == 0, "F").otherwise("M").alias("pi_gend_code"),
                F.when(k % 8 == 0, "H").otherwise("N").alias("pi_ethn_code"))

        customer = self.table("customer")
        return rows(customer, "Y", "@example.org").unionByName(
            rows(customer.filter(k % 5 == 0), "N", "@old.example.org"))

    @cached_property
    def pi_primary(self) -> DataFrame:
        return self.pi.filter(F.col("prim_addr_flag") == "Y")

    @cached_property
    def pdmog(self) -> DataFrame:
        k, customer = F.col("c_custkey"), self.table("customer")
        race = F.when(k % 4 == 0, "W").when(k % 4 == 1, "B3").otherwise("A")
        return (customer.filter(k % 6 != 0)
                .select(k.alias("pi_id"), F.lit("R").alias("dmog_tbl_code"), race.alias("dmog_code"))
                .unionByName(customer.filter(k % 2 == 0).select(
                    k.alias("pi_id"), F.lit("H").alias("dmog_tbl_code"),
                    F.when(k % 9 == 0, "Y").otherwise("N").alias("dmog_code"))))

    @cached_property
    def copi(self) -> DataFrame:
        return (self.table("lineitem").filter("l_linenumber = 2")
                .select(F.col("l_orderkey").alias("prop_id"), F.col("l_suppkey").alias("pi_id")).distinct())

    @cached_property
    def person(self) -> DataFrame:
        return (self.prop.select("prop_id", "pi_id", F.lit(" PI").alias("pers"))
                .unionByName(self.copi.select("prop_id", "pi_id", F.lit("coPI").alias("pers"))))

    def _named(self, lines: str) -> DataFrame:
        return (self.table("lineitem").filter(lines)
                .select(F.col("l_orderkey").alias("prop_id"), F.col("l_suppkey").alias("c_custkey")).distinct()
                .join(self.table("customer"), "c_custkey")
                .select("prop_id", F.col("c_name").alias("last_name"),
                        F.concat(F.lit("F"), _text(F.col("c_custkey") % 10)).alias("frst_name"),
                        F.col("c_nationkey").alias("inst_id")))

    @cached_property
    def senior(self) -> DataFrame:
        """Senior personnel by name only; some are also (co-)investigators."""
        return self._named("l_linenumber <= 2")

    @cached_property
    def subpi(self) -> DataFrame:
        """People of subawards by name only."""
        return self._named("l_linenumber BETWEEN 2 AND 3")

    @cached_property
    def revr(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            k.alias("revr_id"), F.col("s_name").alias("revr_last_name"),
            F.concat(F.lit("F"), _text(k % 10)).alias("revr_frst_name"),
            F.when(k % 12 != 0, F.col("s_nationkey")).alias("inst_id"))

    @cached_property
    def revr_mail(self) -> DataFrame:
        """Optional address lines of reviewers; type E is e-mail."""
        k = F.col("s_suppkey")
        return self.table("supplier").filter(k % 4 != 1).select(
            k.alias("revr_id"), F.when(k % 4 == 3, "P").otherwise("E").alias("addr_lne_type_code"),
            F.concat(F.lower("s_name"), F.lit("@review.example.org")).alias("revr_addr_txt"))

    # --- codes -----------------------------------------------------------------------------

    @cached_property
    def _line_part(self) -> DataFrame:
        return self.table("lineitem").join(self.table("part"), F.col("p_partkey") == F.col("l_partkey"))

    @cached_property
    def atr(self) -> DataFrame:
        return self._line_part.select(
            F.col("l_orderkey").alias("prop_id"), F.lit("PRC").alias("prop_atr_type_code"),
            F.lpad(_text(F.col("p_size")), 4, "0").alias("prop_atr_code")).repartition("prop_id").distinct()  # lists of a proposal's codes need no further shuffle

    @cached_property
    def atr_seq(self) -> DataFrame:
        """Codes with the place that is stored for them: places may be empty, or hold several codes."""
        return (self._line_part.groupBy(F.col("l_orderkey").alias("prop_id"), F.lpad(_text(F.col("p_size")), 4, "0").alias("prop_atr_code"))
                .agg((F.min("l_linenumber") % 6 + 1).cast("int").alias("prop_atr_seq")))

    @cached_property
    def subm(self) -> DataFrame:
        """Submission control: bridge from proposal to its submission."""
        return self.table("orders").select(F.col("o_orderkey").alias("prop_id"),
                                           (F.col("o_orderkey") + 5000000).alias("temp_prop_id"))

    @cached_property
    def route(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_orderkey") + 5000000).alias("temp_prop_id"),
            F.concat(F.lit("R"), _text(F.col("l_linenumber"))).alias("code"),
            (8 - F.col("l_linenumber")).alias("sequence")).distinct()

    @cached_property
    def item(self) -> DataFrame:
        """Special items; a null end date means still valid."""
        code = F.col("prop_atr_code").cast("int")
        return self.atr.select(
            (F.col("prop_id") + 5000000).alias("temp_prop_id"), F.col("prop_atr_code").alias("spcl_item_code"),
            F.when(code % 6 == 5, F.lit("2000-01-01").cast("date")).alias("end_date"))

    @cached_property
    def covr(self) -> DataFrame:
        """Cover sheet: approvals, earlier award."""
        k, d = F.col("o_orderkey"), F.col("o_orderdate")
        return self.table("orders").select(
            (k + 5000000).alias("temp_prop_id"),
            F.when(k % 6 == 0, d + _days(10)).alias("hum_date"),
            F.when(k % 6 == 1, "Y").otherwise("N").alias("humn_date_pend_flag"),
            F.when(k % 9 == 0, d + _days(20)).alias("vert_date"),
            F.when(k % 9 == 4, "Y").otherwise("N").alias("vrtb_date_pend_flag"),
            F.when((k % 8 == 5) & (k % 40 != 5), k - 8).alias("prev_awd_id"))  # chains of up to five

    # --- reviews ---------------------------------------------------------------------------

    @cached_property
    def rating(self) -> DataFrame:
        return F.broadcast(rating_table(self.spark))

    @cached_property
    def rev(self) -> DataFrame:
        k, m = F.col("k"), F.col("m")
        bits = F.concat(*[F.when(m % (2 * b) >= b, "Y").otherwise("N") for b in (16, 8, 4, 2, 1)])
        letter = F.when(k % 6 == 0, "E").when(k % 6 == 1, "V").when(k % 6 == 2, "G").when(k % 6 == 3, "F").when(k % 6 == 4, "P")
        status = (F.when(k % 11 == 0, "C").when(k % 13 == 0, "P").when(k % 17 == 0, "S").when(k % 19 == 0, "D").otherwise("R"))
        # Lines meet their order before they are grouped: groups need no shuffle of their own, and an order with very many lines is split by that join.
        of_order, orders = F.col("o_orderkey") == F.col("l_orderkey"), self.table("orders")
        grouped = (self.table("lineitem").join(orders.select("o_orderkey"), of_order, "left_semi")
                   .groupBy(F.col("l_orderkey").alias("prop_id"), F.col("l_suppkey").alias("revr_id"))
                   .agg(F.min("l_partkey").alias("k"), F.max("l_shipdate").alias("shp")))
        return (
            grouped.join(orders.select("o_orderkey", "o_orderdate"), F.col("o_orderkey") == F.col("prop_id"))
            .withColumn("m", k + 3 * F.col("prop_id"))
            .select(
                "prop_id", "revr_id", status.alias("rev_stts_code"),
                F.when(k % 5 == 0, "R").otherwise("P").alias("rev_type_code"),
                letter.alias("rev_prop_rtng_code"),
                F.when(k % 7 != 0, bits).alias("rev_prop_rtng_ind"),
                F.when(k % 3 == 0, "Y").otherwise("N").alias("rev_rlse_flag"),
                F.when(k % 21 == 1, "Y").otherwise("N").alias("rev_prop_unrl_flag"),
                F.when(k % 25 == 0, "D").when(k % 4 != 0, "S").alias("rev_subm_flag"),
                F.when((k % 13 != 0) & (k % 17 != 0), F.col("shp")).alias("rev_rtrn_date"),
                (F.col("o_orderdate") + _days(60)).alias("rev_due_date"),
            )
        )

    @cached_property
    def rev_txt(self) -> DataFrame:
        """Length of the review text per proposal: the text itself stays at the scan."""
        return self.table("documents").select(F.col("doc_id").alias("prop_id"), F.length("text").alias("text_len"))

    # --- panels ----------------------------------------------------------------------------

    @cached_property
    def panl_prop(self) -> DataFrame:
        return (self._line_part.filter("l_orderkey % 20 <> 19")
                .select(_panel_id().alias("panl_id"), F.col("l_orderkey").alias("prop_id")).distinct())

    @cached_property
    def panl_revr(self) -> DataFrame:
        return (self._line_part.filter("l_suppkey % 9 <> 4")
                .select(_panel_id().alias("panl_id"), F.col("l_suppkey").alias("revr_id")).distinct())

    @cached_property
    def panl(self) -> DataFrame:
        first = F.min("l_shipdate")
        return (self._line_part.groupBy("p_brand")
                .agg(first.alias("panl_bgn_date"), (first + _days(2)).alias("panl_end_date"))
                .select(_panel_id().alias("panl_id"), F.col("p_brand").alias("panl_name"),
                        "panl_bgn_date", "panl_end_date"))

    @cached_property
    def rec(self) -> DataFrame:
        p = F.col("prop_id")
        rated = p % 9 != 0
        abbr = F.when(p % 5 == 0, "HC").when(p % 5 == 1, "C").when(p % 5 == 2, "LC").when(p % 5 == 3, "NC").otherwise("NDP")
        return self.panl_prop.filter(p % 10 != 3).select(
            "panl_id", "prop_id", F.when(rated, 1 + p % 5).alias("rcom_seq_num"),
            F.when(rated, abbr).alias("rcom_abbr"), F.when(p % 3 != 0, 1 + p % 30).alias("prop_ordr"),
            F.when(p % 8 == 0, "Y").otherwise("N").alias("panl_summ_rlse_flag"),
            F.when(p % 31 == 0, "Y").otherwise("N").alias("panl_summ_unrl_flag"))

    @cached_property
    def rcom_def(self) -> DataFrame:
        """What each recommendation number of a panel is called."""
        names = F.array(*[F.struct(F.lit(i).cast("long").alias("rcom_seq_num"), F.lit(n).alias("rcom_abbr"))
                          for i, n in enumerate(("HC", "C", "LC", "NC", "NDP"), 1)])
        return (self.table("part").select(_panel_id().alias("panl_id")).distinct()
                .select("panl_id", F.inline(names)))

    @cached_property
    def confl(self) -> DataFrame:
        return (self.rev.filter("rev_stts_code = 'C'").select("prop_id", "revr_id")
                .join(self.panl_prop, "prop_id").join(self.panl_revr, ["panl_id", "revr_id"])
                .select("panl_id", "revr_id", "prop_id"))

    # --- money -----------------------------------------------------------------------------

    @cached_property
    def budg(self) -> DataFrame:
        return self._budget("prop_id", "revn_num", "budg_seq_yr")

    @cached_property
    def budg_together(self) -> DataFrame:
        """As `budg`, with all rows of a proposal in one partition, for sums by proposal."""
        return self._budget("prop_id")

    def _budget(self, *place: str) -> DataFrame:
        exact = lambda name: F.col(name).cast("decimal(12,2)")
        price, line = exact("l_extendedprice"), F.col("l_linenumber")
        sum_of = lambda value, when=None: F.coalesce(F.sum(value if when is None else F.when(when, value)), F.lit(0)).cast("double")
        flag, closed, quantity = F.col("l_returnflag"), F.col("l_linestatus") == "F", exact("l_quantity")
        # Lines travel as they are: the sums of a group are five times as wide, and a group seldom has two lines.
        lines = (self.table("lineitem").withColumns({"prop_id": F.col("l_orderkey"), "revn_num": F.col("l_partkey") % 3, "budg_seq_yr": line})
                 .repartition(*place))
        return (lines.groupBy("prop_id", "revn_num", "budg_seq_yr")
                .agg(sum_of(price).alias("budg_tot_dol"), sum_of(price * exact("l_discount"), flag == "A").alias("sub_ctr_dol"), sum_of(price * exact("l_tax"), flag == "N").alias("cnsl_dol"),
                     sum_of(price * exact("l_discount"), line % 2 == 0).alias("cptr_serv_dol"), sum_of(price * exact("l_tax")).alias("frgn_trav_dol"), sum_of(price, line % 3 == 0).alias("pdoc_grnt_dol"),
                     sum_of(price * exact("l_tax"), closed & (flag == "R")).alias("part_dol"), sum_of(quantity, closed).alias("part_cnt"), sum_of(quantity, flag == "R").alias("grad_pers_tot_cnt"),
                     sum_of(F.lit(1), flag == "A").alias("sr_pers_cnt"), sum_of(quantity, line % 3 == 0).alias("sr_summ_mnth_cnt"), sum_of(quantity, line % 3 == 1).alias("sr_acad_mnth_cnt"),
                     sum_of(quantity, line % 3 == 2).alias("sr_cal_mnth_cnt")))

    @cached_property
    def splt(self) -> DataFrame:
        return (self._line_part
                .groupBy(F.col("l_orderkey").alias("prop_id"), F.year("l_shipdate").alias("budg_yr"),
                         _text(F.col("l_linenumber")).alias("splt_id"))
                .agg(F.sum("l_extendedprice").alias("budg_splt_tot_dol"), F.min("p_type").alias("pgm_ele_code"),
                     F.max("l_shipdate").alias("frwd_date"), F.min("l_partkey").alias("_p"), F.max("l_linestatus").alias("_s"))
                .withColumn("org_code", F.concat(_text(F.col("_p") % 5 + 10), F.lpad(_text(F.col("_p") % 25 + 1), 6, "0")))
                .withColumn("pm_ibm_logn_id", F.concat(F.lit("po"), _text(F.col("_p") % 13)))
                .withColumn("obj_clas_code", F.when(F.col("_p") % 4 == 0, "2500").when(F.col("_p") % 4 == 1, "4100").otherwise("4110"))
                .withColumn("awd_id", F.when(F.col("_s") == "F", F.col("prop_id"))).drop("_p", "_s"))

    @cached_property
    def splt_code(self) -> DataFrame:
        return self._line_part.select(
            F.col("l_orderkey").alias("prop_id"), F.year("l_shipdate").alias("budg_yr"),
            _text(F.col("l_linenumber")).alias("splt_id"),
            F.lpad(_text(F.col("p_size")), 4, "0").alias("pgm_ref_code")).repartition("prop_id", "budg_yr", "splt_id").distinct()  # as codes of proposals

    @cached_property
    def cost(self) -> DataFrame:
        n, price = F.col("l_linenumber") % 4, F.col("l_extendedprice")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("prop_id"), (F.col("l_suppkey") % 3).alias("perf_inst_id"),
            (F.col("l_partkey") % 2).alias("revn_num"),
            F.when(n == 0, "budg").when(n == 1, "senior").when(n == 2, "equip").otherwise("indirect").alias("src"),
            F.when((n == 0) & (F.col("l_suppkey") % 3 == 0), price * F.col("l_discount")).alias("sub_ctr_req_dol"),
            price.alias("amount"), (F.col("l_tax") * 100).alias("rate"))

    @cached_property
    def awd(self) -> DataFrame:
        return self.table("orders").filter("o_orderstatus = 'F'").select(
            F.col("o_orderkey").alias("awd_id"), (F.col("o_custkey") % 25).cast("int").alias("inst_id"),
            F.when(F.col("o_orderkey") % 3 == 0, "90").otherwise("80").alias("awd_stts_code"),
            F.col("o_totalprice").alias("tot_intn_awd_amt"), F.col("o_orderdate").alias("awd_eff_date"),
            (F.col("o_orderdate") + _days(1000)).alias("awd_exp_date"), F.concat(F.lit("po"), _text(F.col("o_orderkey") % 7)).alias("pm_ibm_logn_id"),
            F.concat(_text(F.col("o_orderkey") % 5 + 10), F.lit("000001")).alias("org_code"), F.col("o_orderpriority").alias("pgm_ele_code"))

    @cached_property
    def awd_pi(self) -> DataFrame:
        k, d = F.col("o_orderkey"), F.col("o_orderdate")
        awards = self.table("orders").filter("o_orderstatus = 'F'")
        dates = [d.alias("awd_eff_date"), (d + _days(1000)).alias("awd_exp_date")]
        leads = awards.select(k.alias("awd_id"), F.col("o_custkey").alias("pi_id"), F.lit("1").alias("proj_role_code"),
                              *dates, F.when(k % 6 == 0, d + _days(30)).alias("end_date"))
        others = (self.copi.join(awards, k == F.col("prop_id"))
                  .select(F.col("prop_id").alias("awd_id"), "pi_id", F.lit("2").alias("proj_role_code"), *dates,
                          F.lit(None).cast("timestamp_ntz").alias("end_date")))
        return leads.unionByName(others)

    @cached_property
    def oblg(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("oblg_id"), F.col("l_extendedprice").alias("oblg_amt"),
            F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).otherwise(0.0).alias("cuml_xpnd_amt"),
            F.col("l_shipdate").alias("last_pymt_date"))

    # --- changes, lists, texts ---------------------------------------------------------------

    @cached_property
    def chg(self) -> DataFrame:
        log = self.table("events").select(
            F.col("user_id").alias("awd_id"), "event_id", F.col("ts").alias("awd_chg_date"),
            F.col("event_type").alias("to_org"))
        return previous_value(log, ["awd_id"], F.to_date("awd_chg_date"), ["awd_chg_date", "event_id"],
                              "to_org", "from_org")

    @cached_property
    def idlist(self) -> DataFrame:
        orders, k = self.table("orders"), F.col("o_orderkey")
        return (orders.filter(k % 97 == 5).select(k.alias("prop_id"))
                .unionByName(orders.filter(k % 997 == 5).select((-1 - k).alias("prop_id"))))

    @cached_property
    def text(self) -> DataFrame:
        d = F.col("doc_id")
        return (self.table("documents").select(
            d.alias("prop_id"), F.when(d % 3 == 0, "Abstr").when(d % 3 == 1, "POCmnt").otherwise("RA").alias("doc_type"),
            F.col("source").alias("author"), "text")
            .unionByName(self.table("conversations").select(
                F.col("conv_id").alias("prop_id"), F.lit("xDiaryNt").alias("doc_type"),
                F.col("role").alias("author"), "text")))

    @cached_property
    def doc(self) -> DataFrame:
        """Uploaded documents of a submission: kind, pages, stored path, typed text."""
        d, n = F.col("doc_id"), F.col("n_chars")
        kinds = F.array(*[F.lit(x) for x in DOC_KINDS])
        return (self.table("documents")
                .select(d, n, "source", F.explode(kinds).alias("kind"))
                .withColumn("_i", F.array_position(kinds, F.col("kind")).cast("int"))
                .filter((d + F.col("_i")) % 4 != 0)
                .select((d + 5000000).alias("temp_prop_id"), "kind",
                        F.floor(n / (F.col("_i") * 300)).cast("int").alias("pdf_page_cnt"),
                        F.when((d + F.col("_i")) % 5 == 0, " ").when((d + F.col("_i")) % 5 != 1, F.col("source")).alias("path_name"),
                        F.when((d + F.col("_i")) % 7 != 0, n).alias("text_len")))

    @cached_property
    def ra(self) -> DataFrame:
        """Analyses written as text, with the time of their last change."""
        start = F.lit("2001-01-01").cast("timestamp_ntz")
        return self.table("documents").select(
            F.col("doc_id").alias("prop_id"),
            (start + F.make_dt_interval((F.col("n_chars") % 1000).cast("int"))).alias("last_updt_tmsp"))

    @cached_property
    def upld(self) -> DataFrame:
        """Uploaded documents; type 034 is an analysis."""
        return self.table("events").select(
            F.col("user_id").alias("prop_id"), F.when(F.col("event_type") == "click", "034").otherwise("099").alias("upload_type_code"),
            F.col("ts").alias("last_updt_tmsp"))

    @cached_property
    def sugg(self) -> DataFrame:
        return self.table("documents").select(
            (F.col("doc_id") + 5000000).alias("temp_prop_id"), F.col("text").alias("revr_want"),
            F.concat_ws(" ", "source", "lang").alias("revr_dont_want"))

    @cached_property
    def log(self) -> DataFrame:
        """Award change log: what the award became, and the proposal that the change came from."""
        k = F.col("event_id")
        return self.chg.select(
            "awd_id", (F.col("awd_id") - F.col("awd_id") % 2).alias("last_prop_id"), "awd_chg_date",
            F.concat(_text(k % 5 + 10), F.lpad(_text(k % 25 + 1), 6, "0")).alias("org_code"),
            F.get(F.array(*map(F.lit, PROGRAMS)), (k % 5).cast("int")).alias("pgm_ele_code"), F.concat(F.lit("po"), _text(k % 13)).alias("pm_ibm_logn_id"))

    @cached_property
    def own(self) -> DataFrame:
        """Ownership history of proposals; status 9 is a completed transfer."""
        k = F.col("event_id")
        return self.chg.select(
            (F.col("awd_id") * 2).alias("prop_id"), F.when(k % 3 == 0, 9).otherwise(1).alias("ownr_stts_code"),
            F.col("awd_chg_date").alias("crtd_date"), "from_org", "to_org",
            F.get(F.array(*map(F.lit, PROGRAMS)), (k % 3).cast("int")).alias("from_pgm"), F.get(F.array(*map(F.lit, PROGRAMS)), (k % 5).cast("int")).alias("to_pgm"),
            F.concat(F.lit("po"), _text(k % 4)).alias("from_lan_id"), F.concat(F.lit("po"), _text(k % 6)).alias("to_lan_id"),
            F.when(k % 6 == 0, F.concat(F.lit("event "), _text(k))).alias("note"))


# Names of the codes that the tables hold.
PROGRAMS = {"1-URGENT": ("Urgent",), "2-HIGH": ("High",), "3-MEDIUM": ("Medium",), "4-NOT SPECIFIED": ("Not specified",), "5-LOW": ("Low",)}
STATUSES = {"F": ("AWD", "Awarded"), "O": ("PEND", "Pending"), "P": ("DECL", "Declined")}
REQUESTS = {"AUTOMOBILE": ("SUPP",), "BUILDING": ("NEW",), "FURNITURE": ("CONT",), "HOUSEHOLD": ("TRAN",), "MACHINERY": ("RNEW",)}
CLASSES = {"4100": ("Grants",), "4110": ("Contracts",), "4120": ("Fellowships",)}
# Further percentages of a proposal: one of so many proposals has the share.
SHARES = {"apld_rsch_pct": (5, 0.5), "educ_trng_pct": (7, 0.2), "mjr_equp_pct": (9, 0.1), "land_buld_fix_equp_pct": (11, 0.05), "non_invt_pct": (13, 0.3)}
DOC_KINDS = ("proj_desc", "bibl", "dmp_plan", "ment_plan", "budg_expl", "supp")


def _org_code() -> Column:
    return F.concat(_text(F.col("n_regionkey") + 10), F.lpad(_text(F.col("n_nationkey") + 1), 6, "0"))


def _panel_id() -> Column:
    return F.concat(F.lit("P"), F.lpad(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")), 2, "0"))
