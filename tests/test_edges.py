"""Hand-made frames: nulls, empties, ties, caps, and the texts the tables do not contain."""

import itertools
import random
import string

import pytest
from pyspark.sql import functions as F

from grantlens.functions import columns as c
from grantlens.functions import text
from grantlens.functions.ordered import cumulative, ordered_concat, padded_concat, previous_value, running_number, slots
from grantlens.operators import budgets, panels, people, reviews, selection, splits
from grantlens.sources import inputs, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t"))).first()[0]


# --- selection -------------------------------------------------------------------------------

PROPS = "prop_id long, lead_prop_id long, pi_id long, rqst_dol double, prop_titl_txt string"


@pytest.fixture(scope="module")
def prop(spark):
    data = [(1, 1), (2, 1), (3, 1), (4, None), (5, 5), (6, 5), (7, 99)]  # lead 99 is not in the table
    return spark.createDataFrame([(p, ld, p * 10, 1.0 * p, "t") for p, ld in data], PROPS)


def test_expand_adds_siblings_when_only_a_member_is_selected(prop):
    got = selection.expand(prop.filter("prop_id IN (2, 4)"), prop)
    assert sorted(r.prop_id for r in got.collect()) == [1, 2, 3, 4]


def test_expand_is_idempotent(prop):
    once = selection.expand(prop.filter("prop_id IN (3, 7)"), prop)
    assert rows(selection.expand(once, prop)) == rows(once)


def test_expand_per_template(spark, prop):
    a = prop.filter("prop_id = 2").withColumn("tpl", F.lit("A"))
    b = prop.filter("prop_id IN (1, 4)").withColumn("tpl", F.lit("B"))
    got = selection.expand(a.unionByName(b), prop, ["tpl"])
    assert sorted((r.tpl, r.prop_id) for r in got.collect()) == [
        ("A", 1), ("A", 2), ("A", 3), ("B", 1), ("B", 2), ("B", 3), ("B", 4)]


def test_from_leads_needs_the_lead(prop):
    got = selection.expand_from_leads(selection.leads_of(prop.filter("prop_id IN (3, 4, 7)")), prop)
    assert sorted((r.ILN, r.lead, r.prop_id) for r in got.collect()) == [("I", 4, 4), ("L", 1, 1), ("N", 1, 2), ("N", 1, 3)]


def test_a_plus_b_contains_a_and_a_minus_b_avoids_b(spark, prop):
    ids = spark.createDataFrame([(2,), (6,), (77,)], "prop_id long")
    cond = F.col("prop_id") <= 3
    plus = {r.prop_id for r in selection.criteria_or_list(prop, cond, ids).collect()}
    minus = {r.prop_id for r in selection.criteria_not_list(prop, cond, ids).collect()}
    assert plus == {1, 2, 3, 6} and minus == {1, 3}


def test_listed_by_lead(spark, prop):
    ids = spark.createDataFrame([(1,), (6,)], "prop_id long")
    got = selection.listed(selection.with_project(prop), ids)
    assert sorted(r.prop_id for r in got.collect()) == [1, 2, 3, 6]


# --- ordered strings and positions -------------------------------------------------------------


def test_concat_cap_ties_nulls(spark):
    data = [("a", 3, "x"), ("a", 1, "y"), ("a", 2, None), ("a", 4, "z"), ("b", 1, None)]
    df = spark.createDataFrame(data, "k string, o int, v string")
    got = {r.k: r.s for r in ordered_concat(df, ["k"], [F.col("o")], "v", ",", 3, name="s").collect()}
    assert got == {"a": "y,x", "b": ""}  # the null keeps its place, the fourth value is beyond the cap
    clipped = ordered_concat(df, ["k"], [F.col("o")], "v", "--", 9, 4, "s").filter("k = 'a'").first().s
    assert clipped == "y--x"


def test_padded_keeps_separators(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "9")], "k string, v string")
    got = {r.k: r.s for r in padded_concat(df, ["k"], [F.col("v")], "v", " ", 3, "s").collect()}
    assert got == {"a": "1 2 ", "b": "9  "}


def test_slots_leave_the_rest_null(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("a", 3, "z"), ("b", 7, None)], "k string, o int, v string")
    got = rows(slots(df, ["k"], [F.col("o")], {"v": "v", "o": "o"}, 2))
    assert got == [("a", "x", 1, "y", 2), ("b", None, 7, None, None)]


def test_cumulative_on_a_hot_group(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", rng.randrange(3000)) for _ in range(6000)]
    df = spark.createDataFrame(data, "k string, v long")
    got = {(r.k, r.v): (r.n_le, r.n_lt) for r in cumulative(df, ["k"], "v", F.shiftright("v", 6)).collect()}
    for (k, v), (le, lt) in random.Random(1).sample(sorted(got.items()), 200):
        same = [x for kk, x in data if kk == k]
        assert le == sum(x <= v for x in same) and lt == sum(x < v for x in same)


def test_previous_value_crosses_steps(spark):
    rng = random.Random(7)
    data = [(rng.choice(["hot", "hot", "a", "b"]), i, rng.randrange(500), f"v{i}") for i in range(800)]
    df = spark.createDataFrame(data, "k string, id long, t long, v string")
    got = {r.id: r.p for r in previous_value(df, ["k"], F.shiftright("t", 4), ["t", "id"], "v", "p").collect()}
    last = {}
    for k, i, _, v in sorted(data, key=lambda d: (d[0], d[2], d[1])):
        assert got[i] == last.get(k)
        last[k] = v


@pytest.mark.parametrize("keys", [range(0, 3000, 3), [10 ** i for i in range(18)], [5], list(range(-400, 400, 7))])
def test_running_number(spark, keys):
    keys = list(keys)
    df = spark.createDataFrame([(k, j) for k in keys for j in range(1 + abs(k) % 3)], "k long, j int")
    got = {(r.k, r.j): (r.n, r.groups) for r in running_number(
        df, "k", {"n": F.count(F.lit(1)), "groups": F.max(F.lit(1))}).collect()}
    total = 0
    for place, k in enumerate(sorted(keys), 1):
        total += 1 + abs(k) % 3
        for j in range(1 + abs(k) % 3):
            assert got[(k, j)] == (total, place)


# --- reviews -------------------------------------------------------------------------------------


def test_review_truth_table(spark):
    letters, packed = [None, "E", "X"], [None, "NNNNN", "YYNNN", "YNNNN"]
    cases = list(itertools.product(letters, packed, ["C", "P", "R"], ["Y", "N", None], ["Y", "N"], ["D", None]))
    schema = ("prop_id long, revr_id long, rev_prop_rtng_code string, rev_prop_rtng_ind string, rev_stts_code string, "
              "rev_rlse_flag string, rev_prop_unrl_flag string, rev_subm_flag string")
    df = spark.createDataFrame([(1, i, *x) for i, x in enumerate(cases)], schema)
    rated = reviews.with_rating(df, inputs.rating_table(spark))
    kept = {r.revr_id for r in rated.filter(reviews.counts()).collect()}
    got = {r.revr_id: r for r in rated.withColumns({**reviews.reconciled(), **reviews.flags()}).collect()}
    text_of, score_of = {y: s for y, s, _ in inputs.RATINGS}, {y: v for y, _, v in inputs.RATINGS}
    for i, (letter, pk, status, released, unrel, subm) in enumerate(cases):
        counts = released == "Y" or status == "C" or letter == "E" or (pk is not None and pk > "NNNNN" and subm != "D")
        assert (i in kept) == counts
        score = score_of.get(pk)
        want = score if score is not None else (9.0 if letter == "E" else None)
        assert got[i].score == want and got[i].string == (text_of[pk] if score is not None else letter)
        assert got[i].unmkd == (0 if pk is None or released == "Y" or unrel == "Y" else 1)
        same = letter is not None and pk is not None and letter == text_of[pk]
        assert got[i].systems_differ == (0 if status in "CR" or same else 1)
        assert got[i].released_unfinished == (1 if released == "Y" and status in "CP" else 0)


def test_summary_without_scores(spark):
    df = spark.createDataFrame([(1, 5, None, None, None, 0, 0), (1, 6, None, None, None, 1, 0)],
                               "lead long, revr_id long, rev_rtrn_date date, string string, score double, confl int, unmkd int")
    row = reviews.summary(df).first()
    assert (row.Nrev, row.Nunmkd, row.avg_score, row.allReviews) == (1, None, None, "")


def test_rank_score_defaults(spark):
    df = spark.range(1).select(panels.rank_score(F.lit(None).cast("double"), F.lit(None).cast("double")).alias("a"),
                               panels.rank_score(F.lit(2.05), F.lit(7.0)).alias("b"))
    assert tuple(df.first()) == (99.0045, 2.051)


def test_first_and_last_panel(spark):
    data = [(1, "A", 1), (1, "B", 1), (2, "A", 1), (2, "B", 3), (2, "C", 3), (3, "A", 2)]
    ends = panels.first_and_last(spark.createDataFrame(data, "prop_id long, panl_id string, panl_bgn_date int"))
    assert [r[:2] for r in rows(ends.filter("is_first"))] == [(1, "A"), (1, "B"), (2, "A"), (3, "A")]
    assert [r[:2] for r in rows(ends.filter("is_last"))] == [(2, "B"), (2, "C")]


def test_outcome_texts(spark):
    rec = spark.createDataFrame([("P1", 1, 2, "C"), ("P1", 2, 2, "C"), ("P1", 3, None, None), ("P2", 4, None, None)],
                                "panl_id string, prop_id long, rcom_seq_num int, rcom_abbr string")
    projects = spark.createDataFrame([(i, i) for i in range(1, 5)], "prop_id long, lead long")
    panl = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "panl_id string")
    assert [r[1] for r in rows(panels.rated_outcomes(panl, rec, projects))] == [
        "3 rated projects, 2 C", "1 rated projects", "No rated projects"]
    assert [r[1] for r in rows(panels.listed_outcomes(panl, rec, projects))] == ["2 proj: , 2 C", " proj: ", " proj: "]


# --- people and money ------------------------------------------------------------------------------


def test_demographics_multiply_by_rows(spark):
    person = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 99)], "prop_id long, pi_id long")
    pi = spark.createDataFrame([(10, "F", "N"), (10, "F", "N"), (11, "F", "H"), (12, "M", "N")], "pi_id long, pi_gend_code string, pi_ethn_code string")
    attr = spark.createDataFrame([(10, "R", "A"), (10, "H", "Y"), (11, "R", "W"), (99, "R", "A")], "pi_id long, dmog_tbl_code string, dmog_code string")
    # 10: two addresses x two attributes; 11: one each; 12: none; 99: unknown address
    assert rows(people.demographics(person, pi, attr)) == [(1, 5, 1, 2, 2), (2, 0, 0, 0, 1)]


def test_latest_revision_and_totals(spark):
    data = [(1, 0, 1, 5.0, 1.0, 0.0, 0.0), (1, 2, 1, 7.0, 0.0, 0.0, 2.0), (1, 2, 2, 8.0, 0.0, 1.0, 0.0), (2, 0, 1, 3.0, 1.0, 0.0, 0.0)]
    budg = spark.createDataFrame(data, "prop_id long, revn_num long, budg_seq_yr int, budg_tot_dol double, sub_ctr_dol double, frgn_trav_dol double, part_cnt double")
    lines = {"sub_ctr_dol": "s", "frgn_trav_dol": "f", "part_cnt": "p"}
    assert rows(budgets.totals(budg, lines)) == [(1, 2, 15.0, None, 1.0, 2.0), (2, 0, 3.0, 1.0, None, None)] and len(budgets.LINES) == 12
    detail = budgets.detail_and_total(budg).collect()
    for p in (1, 2):
        assert sum(r.dol for r in detail if r.prop_id == p and r.budg_seq_yr) == sum(r.dol for r in detail if r.prop_id == p and r.budg_seq_yr is None)


def test_split_patterns(spark):
    s = spark.createDataFrame([(1, 2000, "1"), (1, 2000, "2"), (1, 2001, "1"), (2, 2000, "1")], "prop_id long, budg_yr int, splt_id string")

    def pattern(*p):
        return spark.createDataFrame(list(p), "prop_id long, budg_yr int, splt_id string")

    assert splits.matching(s, pattern((1, None, None), (1, 2000, None))).count() == 3  # named twice, kept once
    assert rows(splits.matching(s, pattern((1, None, "1")))) == [(1, 2000, "1"), (1, 2001, "1")]
    assert rows(splits.without(s, pattern((1, 2000, None), (3, None, None)))) == [(1, 2001, "1"), (2, 2000, "1")]


# --- input, output, text ---------------------------------------------------------------------------


def test_ids(spark):
    typed = spark.createDataFrame([(" 123 ",), (" ",), ("",), ("123",), ("12345678",)], "line string")
    assert rows(inputs.clean_ids(typed, "line", 7)) == [("0000123",), ("12345678",)]
    pasted = spark.createDataFrame([("1234567 title",), (" 99999",), ("100000\tx",), ("x 1234567",), ("123456789",), ("1234567.6",)], "line string")
    assert rows(inputs.ids_from_lines(pasted, "line")) == [("0100000",), ("1234567",), ("1234568",)]


def test_literal_table(spark):
    t = inputs.literal_table(spark, [("a", "1", "3"), ("", "9", "9"), ("b", 2, ""), ("c", None, " ")], "prop_id string, budg_yr int, splt_id string")
    assert rows(t) == [("a", 1, "3"), ("b", 2, None), ("c", None, None)]


def test_saved_result_counts_rows(spark, tmp_path):
    done = sinks.save_result(spark.range(17), str(tmp_path / "r"))
    assert done["n_rows"] == 17 and spark.read.parquet(done["path"]).count() == 17


def test_shared_folder_is_used_when_named(spark, tmp_path):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
        named = spark.sparkContext.getCheckpointDir()
    first, second = sinks.work_folder(spark), sinks.work_folder(spark)
    assert first.startswith(named) and first != second
    kept = sinks.staged(spark.range(5))
    assert kept.count() == 5 and named.removeprefix("file:") in kept.inputFiles()[0]


@pytest.mark.parametrize("dirty, clean", [
    ("“A” ‘b’ – c—d… ﬁn\x0bé", "\"A\" 'b' - c--d... fin\ré"), ("", ""), (None, None)])
def test_ascii(spark, dirty, clean):
    assert one(spark, dirty, text.to_ascii) == clean


@pytest.mark.parametrize("raw, left", [
    ("[[a]] b [[c]]", " b "), ("x [[a\nb] c]] y", "x  y"), ("[[a [[b]] c", "[[a  c"), ("a [[ b", "a [[ b"), ("a ]] b", "a ]] b"),
    ("[[" + "x" * 200000 + "]]z", "z"), ("[ ]" * 20000, "[ ]" * 20000)])
def test_brackets(spark, raw, left):
    assert one(spark, raw, text.strip_brackets) == left


def marks_in_words(s):
    """The rule of `question_marks` in words: marks are looked at from the last to the first, a mark after an ASCII letter and before a blank or
    quote is a question, any other is reported with its neighbours, and a report covers the three characters before it. With fewer than three
    characters before a mark, the snippet starts at the mark, and nothing before it is looked at."""
    snippets, covered = [], len(s) + 1
    for at in [i for i, ch in reversed(list(enumerate(s))) if ch == "?"]:
        if at >= covered:
            continue
        if at < 3:
            snippets.append(s[at:at + 5])
            break
        asks = at + 1 < len(s) and s[at - 1] in string.ascii_letters and s[at + 1] in " '\""
        if not asks:
            snippets.append(s[at - 3:at + 5])
            covered = at - 3
    return "".join(x + "|" for x in reversed(snippets)) + " "


def test_question_marks(spark):
    rng = random.Random(3)
    cases = ["Who knows? Caf? au lait", "\"Really?\" she said", "na?ve r?sum?", "end?", "", "no", "??", "a?b?c?d", "x?", "??????????"]
    cases += ["".join(rng.choice("ab? \"'.1\n") for _ in range(rng.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, t string").select("i", text.question_marks("t").alias("m"))
    for r in df.collect():
        assert r.m == marks_in_words(cases[r.i]), cases[r.i]


@pytest.mark.parametrize("first, second, tail", [
    ("x Key words: a, b", "", ": a, b"), ("Keywords: q", "", ": q"), ("keyword: q", "", " q"), ("nothing", "KEYWORD-z", "z"), ("ends with keyword", "key word x y", "x y"), ("a", "b", "")])
def test_keywords(spark, first, second, tail):
    df = spark.createDataFrame([(first, second)], "a string, b string")
    assert df.select(text.keyword_tail("a", "b")).first()[0] == tail


def test_dates(spark):
    df = spark.sql("SELECT timestamp_ntz'1999-03-07 23:59:59' AS d, timestamp_ntz'1900-01-01' AS z")
    assert tuple(df.select(c.us_date("d"), c.dotted_date("d"), c.real_date("z")).first()) == ("03/07/99", "1999.03.07", None)


def test_averages_and_deviations_do_not_depend_on_order(spark):
    """Whole sums: halves go away from zero on both sides, a single value has no deviation, missing values do not count."""
    import math
    import statistics

    groups = {1: [4.992, 3.65, 9.0, None], 2: [-0.5, 0.0], 3: [2.0], 4: [None], 5: [1.0, 2.0, 2.0], 6: [1e5] * 3 + [99_999.0], 7: [-1.0, -2.0, -2.0]}
    frame = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v double")
    got = {r["k"]: (r["a"], r["d"]) for r in frame.groupBy("k").agg(c.average("v", 1000).alias("a"), c.deviation("v", 1000).alias("d")).collect()}
    for k, vs in groups.items():
        vs = [v for v in vs if v is not None]
        assert got[k][0] == (pytest.approx(math.fsum(vs) / len(vs), abs=6e-7) if vs else None)
        assert got[k][1] == (pytest.approx(statistics.stdev(vs), abs=6e-7) if len(vs) > 1 else None)
    assert got[5][0] == 1.666667 and got[7][0] == -1.666667
    half = spark.createDataFrame([(0.000001,), (0.0,), (-0.000001,), (-0.000002,)], "v double")
    assert half.agg(c.average("v", 1_000_000).alias("a")).first()["a"] == -0.000001  # -0.5 of the last place
    assert half.agg(c.dollars(F.lit(0.5)).alias("a"), c.dollars(F.lit(-0.625)).alias("b")).first() == (2.0, -3.0)


# --- patterns by shape, stored places, people and awards, texts once ---------------------------


def test_patterns_meet_only_splits_that_they_name(spark):
    """All four shapes, patterns that overlap or repeat, a proposal with very many splits and patterns; no residual condition in the plan."""
    splits_ = spark.createDataFrame([(1, 2000 + i % 50, str(i), float(i)) for i in range(500)] + [(2, 2001, "7", 1.0), (3, None, None, 2.0), (None, 2001, "1", 3.0)],
                                    "prop_id long, budg_yr int, splt_id string, dol double")
    patterns = spark.createDataFrame([(1, 2003, None), (1, None, "9"), (1, 2003, "53"), (1, 2003, "53"), (1, 1990, "1"), (2, None, None), (3, None, None), (None, 2001, "1"), (9, None, None)]
                                     + [(1, 3000 + i, str(i)) for i in range(400)], "prop_id long, budg_yr int, splt_id string")
    named = {(r["prop_id"], r["dol"]) for r in splits.matching(splits_, patterns).collect()}
    assert named == {(1, float(i)) for i in range(500) if i % 50 == 3 or i == 9} | {(2, 1.0), (3, 2.0)}
    rest = [(r["prop_id"], r["dol"]) for r in splits.without(splits_, patterns).collect()]
    assert len(rest) == splits_.count() - len(named) and not named & set(rest) and splits.matching(splits_, patterns).columns == splits_.columns
    text = splits.matching(splits_, patterns)._jdf.queryExecution().optimizedPlan().toString()
    assert all(" OR " not in line and "isnull" not in line for line in text.splitlines() if "Join" in line)


def test_values_stand_at_their_stored_places(spark):
    from grantlens.functions.ordered import placed_concat

    frame = spark.createDataFrame([(1, 1, "a"), (1, 4, "d"), (2, 2, "x"), (2, 2, "y"), (2, 9, "far"), (3, None, "n"), (4, 0, "zero")], "k long, place int, v string")
    got = {r["k"]: r["s"] for r in placed_concat(frame, ["k"], "place", "v", "-", 4, "s").collect()}
    assert got == {1: "a---d", 2: "-y--", 3: "---", 4: "---"}


def test_awards_of_people_grow_with_their_inputs(spark):
    """One person in 200 listed projects with 100 awards: 200 rows in the bridge and 100 awards, not their product."""
    from grantlens.operators import awards

    pairs = spark.createDataFrame([(p, p, 1) for p in range(200)] + [(5, 5, 2)], "lead long, prop_id long, pi_id long")
    awd = spark.createDataFrame([(a, 1, "80", 1.0, "2001-01-01") for a in range(100)], "awd_id long, inst_id int, awd_stts_code string, tot_intn_awd_amt double, awd_exp_date string")
    awd_pi = spark.createDataFrame([(a, 1, "1", None) for a in range(100)] + [(3, 9, "2", None)], "awd_id long, pi_id long, proj_role_code string, end_date string")
    oblg = spark.createDataFrame([(a, 10.0, 1.0, "2001-01-01") for a in range(100)], "oblg_id long, oblg_amt double, cuml_xpnd_amt double, last_pymt_date string")
    held = awards.held_awards(pairs, awd, awd_pi, oblg)
    assert held.count() == 100 and awards.active_awards(pairs, awd, awd_pi, oblg).count() == 200 * 100
    prop = spark.createDataFrame([(p, "P", 1) for p in range(50)], "prop_id long, prop_stts_code string, pi_id long")
    copi = spark.createDataFrame([(7, 1), (7, 2), (8, 3)], "prop_id long, pi_id long")
    assert awards.pending_roles(pairs, prop, copi, ["P"]).count() == 50 + 2
    assert awards.pending(pairs.limit(1), prop, copi, ["P"]).count() == 50


def test_tables_are_planned_without_footers_and_counted_from_them(spark, folder, tmp_path):
    from grantlens.sources import tables

    catalog = tables.Catalog(spark, folder)
    for name in catalog.names:
        catalog.schema(name)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    frames = [tables.Catalog(spark, folder).table(name) for name in catalog.names]
    counts = tables.row_counts(catalog)
    assert not tracker.getJobIdsForGroup("planning") and len(frames) == 14
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") == 14
    assert {r["table_name"]: r["n_rows"] for r in counts.collect()} == {name: spark.read.parquet(catalog.path(name)).count() for name in catalog.names}
    with pytest.raises(KeyError):
        catalog.table("orders_of_magnitude")
    # A table whose files change is looked at again.
    spark.range(3).withColumnRenamed("id", "r_regionkey").coalesce(1).write.parquet(f"{tmp_path}/region.parquet")
    assert tables.scan(spark, str(tmp_path), "region").columns == ["r_regionkey"]
    spark.range(3).withColumnRenamed("id", "other").write.mode("overwrite").parquet(f"{tmp_path}/region.parquet")
    assert tables.scan(spark, str(tmp_path), "region").columns == ["other"]


def test_texts_of_documents_are_joined_once(spark, folder):
    from grantlens.catalog import QUERIES

    text = QUERIES["txt_collect"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in text.splitlines() if "Relation [" in line and "doc_id#" in line]
    assert len(scans) == 2  # lengths, and the texts themselves
