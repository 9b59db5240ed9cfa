"""Review scoring: two systems hold ratings of the same review and may disagree."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.ordered import first_in_group, joined, ordered_concat
from ..sources.inputs import LETTER_SCORES

AD_HOC = ".ad hoc"  # fixed value: stands for the panel of a review outside any panel
SCORES = 1000  # scores are thousandths
CAP, WIDTH = 15, 50  # fixed values: places and width of a ratings string


def with_rating(rev: DataFrame, rating: DataFrame) -> DataFrame:
    """Text and score of the packed rating (null where there is none)."""
    return rev.join(rating.withColumnsRenamed({"yn": "rev_prop_rtng_ind", "string": "packed_string", "score": "packed_score"}),
                    "rev_prop_rtng_ind", "left")


def letter_score() -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in LETTER_SCORES.items()))
    return F.try_element_at(table, F.col("rev_prop_rtng_code"))


def reconciled() -> dict[str, Column]:
    """The packed rating where it has a score, else the letter."""
    packed = F.col("packed_score").isNotNull()
    return {"string": F.when(packed, F.col("packed_string")).otherwise(F.col("rev_prop_rtng_code")),
            "score": F.when(packed, F.col("packed_score")).otherwise(letter_score())}


def counts() -> Column:
    """Which reviews count: released, conflicted, rated by letter, or rated and not deleted."""
    return (
        (F.col("rev_rlse_flag") == "Y") | (F.col("rev_stts_code") == "C")
        | F.col("rev_prop_rtng_code").isin(*LETTER_SCORES)
        | ((F.col("rev_prop_rtng_ind") > "NNNNN") & (F.coalesce("rev_subm_flag", F.lit("U")) != "D"))
    )


def flags() -> dict[str, Column]:
    """Six 0/1 flags. The last and the unmarked one are 1 unless shown otherwise, so nulls count."""
    status, released = F.col("rev_stts_code"), F.col("rev_rlse_flag") == "Y"
    unreleasable = F.col("rev_prop_unrl_flag") == "Y"
    agreed = status.isin("C", "D", "N", "R") | (F.col("rev_prop_rtng_code") == F.nullif("packed_string", F.lit(" ")))
    return {
        "confl": c.flag(status == "C"),
        "pendSlct": c.flag(status.isin("P", "S")),
        "unrlsbl": c.flag(unreleasable),
        "unmkd": F.when(F.col("rev_prop_rtng_ind").isNull() | released | unreleasable, 0).otherwise(1),
        "released_unfinished": c.flag(released & status.isin("C", "D", "N", "P", "S")),
        "systems_differ": F.when(agreed, 0).otherwise(1),
    }


def assessed(rev: DataFrame, rating: DataFrame) -> DataFrame:
    """The reviews that count, with string, score and flags; prop_id becomes the project's lead."""
    return (with_rating(rev.filter(counts()), rating)
            .withColumns({**reconciled(), **flags()})
            .select(F.col("prop_id").alias("lead"), "revr_id", "rev_rtrn_date", "string", "score", *flags()))


def credit_panel(rev: DataFrame, panl_prop: DataFrame, panl_revr: DataFrame) -> DataFrame:
    """prop_id, revr_id, panl_id: the smallest panel that had both the proposal and the reviewer."""
    shared = (rev.select("prop_id", "revr_id")
              .join(panl_prop.filter(F.col("panl_id").startswith("P")), "prop_id")
              .join(panl_revr, ["panl_id", "revr_id"], "left_semi")
              .groupBy("prop_id", "revr_id").agg(F.min("panl_id").alias("panl_id")))
    return (rev.select("prop_id", "revr_id").join(shared, ["prop_id", "revr_id"], "left")
            .fillna(AD_HOC, ["panl_id"]))


def with_panel(reviews: DataFrame, panl_prop: DataFrame, panl_revr: DataFrame) -> DataFrame:
    """Assessed reviews with the panel they are credited to.

    A review is keyed by (lead, revr_id), so its other columns are the same in all copies. Only its key meets the panels of its
    proposal; what else it holds is not multiplied by them, and not shuffled again: the credits travel to the project, where the reviews are.
    """
    considered = panl_prop.filter(F.col("panl_id").startswith("P")).withColumnRenamed("prop_id", "lead")
    rest = [x for x in reviews.columns if x not in ("lead", "revr_id")]
    shared = (reviews.select("lead", "revr_id").join(considered.select("lead", "panl_id"), "lead").join(panl_revr, ["panl_id", "revr_id"], "left_semi")
              .repartition("lead").groupBy("lead", "revr_id").agg(F.min("panl_id").alias("panl_id")))
    return (reviews.groupBy("lead", "revr_id").agg(*[F.any_value(x).alias(x) for x in rest]).join(shared, ["lead", "revr_id"], "left")
            .select("lead", "revr_id", F.coalesce("panl_id", F.lit(AD_HOC)).alias("panl_id"), *rest))


def ratings_order() -> list[Column]:
    return [F.col("score").desc_nulls_last(), F.col("revr_id")]


def summary(reviews: DataFrame, once: bool = False) -> DataFrame:
    """Per project over its unconflicted reviews: reviewers, scores, ratings string, last date. A reviewer with several reviews counts once.

    once: a reviewer has one review of a project at most, as `with_panel` leaves them; there is nothing to make distinct.
    """
    counted = reviews.filter("confl = 0")
    stats = counted.groupBy("lead").agg(
        (F.count("revr_id") if once else F.countDistinct("revr_id")).alias("Nrev"), c.zero_to_null(F.sum("unmkd")).alias("Nunmkd"),
        F.min("score").alias("minScore"), c.average("score", SCORES).alias("avg_score"),
        F.max("score").alias("maxScore"), F.max("rev_rtrn_date").alias("last_rev_date"))
    return stats.join(ratings(counted, ["lead"], "allReviews", CAP, WIDTH), "lead", "left")


def ratings(reviews: DataFrame, keys: list[str], name: str, cap: int, width: int | None) -> DataFrame:
    return ordered_concat(reviews, keys, ratings_order(), "string", ",", cap, width, name)


def marks(reviews: DataFrame) -> DataFrame:
    """Per project, conflicted reviews included: how many need attention (0 shown as null)."""
    names = {"Nconfl": "confl", "Nunrlsbl": "unrlsbl", "n_released_unfinished": "released_unfinished", "NpendSlct": "pendSlct",
             "n_systems_differ": "systems_differ"}
    return reviews.groupBy("lead").agg(*[c.zero_to_null(F.sum(f)).alias(n) for n, f in names.items()])


def by_panel(reviews: DataFrame) -> DataFrame:
    """Per (project, panel): N, ratings V, last date. Needs panl_id.

    Places are counted over the whole project, so the cap applies there and not per panel.
    """
    counted = reviews.filter("confl = 0")
    stats = counted.groupBy("lead", "panl_id").agg(
        F.count("revr_id").alias("N"), F.max("rev_rtrn_date").alias("last_rev_date"))
    strings = (first_in_group(counted.select("lead", "panl_id", "string", "score", "revr_id"), ["lead"],
                              ratings_order(), CAP)
               .groupBy("lead", "panl_id").agg(joined("rn", F.col("string"), ",", WIDTH).alias("V")))
    return stats.join(strings, ["lead", "panl_id"], "left").fillna("", ["V"])


def panels_of(reviews: DataFrame) -> DataFrame:
    """The (project, panel) pairs with an unconflicted review. Needs panl_id."""
    return reviews.filter("confl = 0").select("lead", "panl_id").distinct()


def release_counts(rev: DataFrame) -> DataFrame:
    """Per proposal over reviews in both systems without conflict: all, unreleasable, unmarked."""
    released, unreleasable = F.col("rev_rlse_flag") == "Y", F.col("rev_prop_unrl_flag") == "Y"
    return (rev.filter("rev_stts_code <> 'C'").groupBy("prop_id").agg(
        F.count(F.lit(1)).alias("Nrev"),
        c.zero_to_null(F.sum(c.flag(unreleasable))).alias("NrevUnreleasable"),
        c.zero_to_null(F.sum(F.when(released | unreleasable, 0).otherwise(1))).alias("NrevUnmarked")))


def score_stats(reviews: DataFrame, key: str = "revr_id", suffix: str = "") -> DataFrame:
    """Count, latest, score, length and earliness statistics per reviewer.

    Needs prop_id, rev_rtrn_date, score, text_len, days_early. Deviations are sample deviations.
    """
    return reviews.groupBy(key).agg(
        F.count("prop_id").alias(f"nProps{suffix}"), F.max("rev_rtrn_date").alias(f"latest{suffix}"),
        F.min("score").alias(f"min_score{suffix}"), c.average("score", SCORES).alias(f"avg_score{suffix}"),
        F.max("score").alias(f"max_score{suffix}"), c.deviation("score", SCORES).alias(f"std_score{suffix}"),
        c.average("text_len").alias(f"avg_len{suffix}"), c.deviation("text_len").alias(f"std_len{suffix}"),
        c.average("days_early").alias(f"avg_days_early{suffix}"),
        c.deviation("days_early").alias(f"std_days_early{suffix}"))


def timed(rev: DataFrame, rating: DataFrame, texts: DataFrame) -> DataFrame:
    """Rated reviews with packed score, text length and how many days early they came."""
    return (rev.join(rating.select(F.col("yn").alias("rev_prop_rtng_ind"), "score"), "rev_prop_rtng_ind")
            .join(texts, "prop_id")
            .withColumn("days_early", F.datediff("rev_due_date", "rev_rtrn_date").cast("double")))


def selected_and_all(selected: DataFrame, everything: DataFrame) -> DataFrame:
    """Statistics on the selection, and on everything where that has a different count."""
    b, a = score_stats(selected), score_stats(everything, suffix="_all")
    a = a.withColumnRenamed("revr_id", "_revr")
    return b.join(a, (F.col("_revr") == F.col("revr_id")) & (F.col("nProps_all") != F.col("nProps")), "left").drop("_revr")
