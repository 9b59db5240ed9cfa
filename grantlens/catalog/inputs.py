"""Sources, user input and result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import selection
from ..sources import inputs, sinks, tables
from .registry import LIST_CHECKS, LISTS, query


@query("src_tables", """
SELECT c_custkey, c_name, n_name, s_suppkey FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN supplier ON s_suppkey = c_custkey""")
def src_tables(e):
    """A join across both catalogs, by the names of their tables."""
    staff, submission = (tables.Catalog(e.spark, e.folder, names) for names in tables.CATALOGS.values())
    return (staff.table("customer").join(F.broadcast(staff.table("nation")), F.col("n_nationkey") == F.col("c_nationkey"))
            .join(submission.table("supplier"), F.col("s_suppkey") == F.col("c_custkey"))
            .select("c_custkey", "c_name", "n_name", "s_suppkey"))


@query("src_catalogs", " UNION ALL ".join(f"SELECT '{catalog}' AS catalog, '{t}' AS table_name, count(*) AS n_rows FROM {t}" for catalog, names in tables.CATALOGS.items() for t in names), LISTS, LIST_CHECKS)
def src_catalogs(e):
    """All tables of both catalogs with their rows."""
    parts = [tables.row_counts(tables.Catalog(e.spark, e.folder, names)).withColumn("catalog", F.lit(catalog)) for catalog, names in tables.CATALOGS.items()]
    return parts[0].unionByName(parts[1])


@query("src_id_list", """
SELECT p.prop_id, lpad(CAST(p.prop_id AS STRING), 7, '0') AS id_text, p.rqst_dol FROM v_prop p
WHERE p.prop_id IN (SELECT prop_id FROM v_idlist)""")
def src_id_list(e):
    """A list typed with blanks, invisible blanks and empty lines, then used as a selection."""
    typed = (e.idlist.select(F.concat(F.lit(" "), F.col("prop_id").cast("string"), F.lit(inputs.NBSP)).alias("line"))
             .unionByName(e.idlist.select(F.lit(" " + inputs.NBSP).alias("line")))
             .unionByName(e.idlist.select(F.col("prop_id").cast("string").alias("line"))))
    ids = inputs.clean_ids(typed, "line", width=7, name="id_text")
    return e.facts.withColumn("id_text", inputs.pad_id("prop_id")).join(ids, "id_text", "left_semi").select(
        "prop_id", "id_text", "rqst_dol")


@query("src_id_pad", """
SELECT prop_id, CASE WHEN prop_id < 10000000 THEN format('{:07d}', prop_id) ELSE CAST(prop_id AS STRING) END AS id_text FROM v_prop""")
def src_id_pad(e):
    return e.facts.select("prop_id", inputs.pad_id("prop_id").alias("id_text"))


@query("src_paste_ids", r"""
WITH lines AS (SELECT unnest(string_split(concat(CAST(doc_id * 1000 + 7 AS STRING), chr(9), text, chr(10), CAST(doc_id * 100000 AS STRING), ' x'), chr(10))) AS line FROM documents),
heads AS (SELECT TRY_CAST(regexp_extract(regexp_replace(substr(line, 1, 10), '[ \t\r]', '', 'g'), '^([0-9]+(\.[0-9]+)?)', 1) AS DOUBLE) AS v FROM lines),
nums AS (SELECT CAST(round_even(v, 0) AS BIGINT) AS n FROM heads)
SELECT format('{:07d}', n) AS prop_id, count(*) AS n_lines FROM nums WHERE n >= 100000 AND n < 100000000 GROUP BY n""")
def src_paste_ids(e):
    pasted = e.table("documents").select(F.concat(
        (F.col("doc_id") * 1000 + 7).cast("string"), F.lit("\t"), F.col("text"), F.lit("\n"),
        (F.col("doc_id") * 100000).cast("string"), F.lit(" x")).alias("t"))
    lines = pasted.select(F.explode(F.split("t", "\n")).alias("line"))
    return inputs.ids_from_lines(lines, "line").groupBy("prop_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query("src_literal_table", """
SELECT t.splt_id, t.budg_yr, t.label, count(*) AS n, CAST(CAST(sum(CAST(s.budg_splt_tot_dol AS DECIMAL(18, 4))) AS DECIMAL(28, 2)) AS DOUBLE) AS dol
FROM (VALUES ('1', 1996, 'first'), ('2', NULL, NULL), ('3', 1997, NULL)) AS t(splt_id, budg_yr, label)
JOIN v_splt s ON s.splt_id = t.splt_id AND coalesce(t.budg_yr, s.budg_yr) = s.budg_yr
GROUP BY t.splt_id, t.budg_yr, t.label""")
def src_literal_table(e):
    cells = [("1", "1996", "first"), ("", "1995", "skipped"), ("2", "", ""), ("3", 1997, " ")]
    t = inputs.literal_table(e.spark, cells, "splt_id string, budg_yr int, label string")
    t = F.broadcast(t.withColumnRenamed("budg_yr", "t_yr"))  # typed in by hand
    return (e.splt.join(t, "splt_id").filter(F.col("t_yr").isNull() | (F.col("t_yr") == F.col("budg_yr")))
            .groupBy("splt_id", F.col("t_yr").alias("budg_yr"), "label")
            .agg(F.count(F.lit(1)).alias("n"), c.money("budg_splt_tot_dol").alias("dol")))


@query("src_rating_map", """
SELECT m.yn, m.string, m.score, (SELECT count(*) FROM v_rev r WHERE r.rev_prop_rtng_ind = m.yn) AS n_reviews FROM v_rating m""")
def src_rating_map(e):
    used = e.rev.groupBy(F.col("rev_prop_rtng_ind").alias("yn")).agg(F.count(F.lit(1)).alias("n_reviews"))
    return inputs.rating_table(e.spark).join(used, "yn", "left").fillna(0, ["n_reviews"])


@query("snk_result", """
SELECT prop_id, lead, "ILN", rqst_dol, (SELECT count(*) FROM v_prop) AS n_rows FROM v_prj""")
def snk_result(e):
    """Write a report and read it back next to the row count the write observed."""
    path = sinks.work_folder(e.spark)
    report = selection.with_project(e.facts).select("prop_id", "lead", "ILN", "rqst_dol")
    done = sinks.save_result(report, path)
    return e.spark.read.parquet(path).withColumn("n_rows", F.lit(done["n_rows"]).cast("long"))


@query("snk_table_stats", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in (*tables.STAFF, *tables.SUBMISSION)))
def snk_table_stats(e):
    return tables.row_counts(tables.Catalog(e.spark, e.folder))
