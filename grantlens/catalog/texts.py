"""Texts and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import documents, people, reviews, selection
from ..plans import stages
from .aggregates import average_sql, deviation_sql
from .registry import query


@query("txt_collect", """
WITH t AS (SELECT p.lead, p."ILN", v.* FROM v_prj p JOIN v_text v ON v.prop_id = p.prop_id)
SELECT r.prop_id AS lead, r.prop_id, 'Review' AS doc_type, v.revr_last_name AS name, m.revr_addr_txt AS info, r.rev_stts_code AS stts, r.rev_due_date AS due, r.rev_rtrn_date AS returned, g.string AS score, d.text
  FROM v_rev r JOIN v_prj p ON p.prop_id = r.prop_id AND p."ILN" < 'M' JOIN v_rating g ON g.yn = r.rev_prop_rtng_ind JOIN v_revr v ON v.revr_id = r.revr_id
  JOIN v_revr_mail m ON m.revr_id = r.revr_id AND m.addr_lne_type_code = 'E' JOIN documents d ON d.doc_id = r.prop_id
UNION ALL SELECT p.lead, a.prop_id, ' PanlSumm', ' ' || v.panl_name, a.panl_id, CAST(r.prop_ordr AS STRING), v.panl_bgn_date, NULL, r.rcom_abbr, 'Panel ' || v.panl_name || ': ' || coalesce(r.rcom_abbr, 'none')
  FROM v_panl_prop a JOIN v_prj p ON p.prop_id = a.prop_id AND p."ILN" < 'M' JOIN v_panl v ON v.panl_id = a.panl_id LEFT JOIN v_rec r ON r.panl_id = a.panl_id AND r.prop_id = a.prop_id
UNION ALL SELECT lead, prop_id, doc_type, author, NULL, NULL, NULL, NULL, NULL, text FROM t WHERE doc_type IN ('POCmnt', 'Abstr')
  AND ("ILN" < 'M' OR length(text) <> (SELECT max(length(l.text)) FROM v_text l WHERE l.prop_id = t.lead AND l.doc_type = t.doc_type))
UNION ALL SELECT lead, prop_id, doc_type, author, NULL, NULL, NULL, NULL, NULL, text FROM t WHERE doc_type = 'xDiaryNt' OR (doc_type = 'RA' AND "ILN" < 'M')
UNION ALL SELECT p.lead, p.prop_id, 'SummProj', NULL, NULL, NULL, NULL, NULL, NULL, if(d.source LIKE '%7', '(in the PDF)', d.text || d.lang || d.source) FROM v_prj p JOIN documents d ON d.doc_id = p.prop_id WHERE p."ILN" < 'M'""")
def txt_collect(e):
    return stages.collected(e)


@query("txt_nonlead_if_differs", """
SELECT p.lead, p.prop_id, d.text FROM v_prj p JOIN documents d ON d.doc_id = p.prop_id LEFT JOIN documents l ON l.doc_id = p.lead WHERE p."ILN" < 'M' OR length(d.text) <> length(l.text)""")
def txt_nonlead_if_differs(e):
    return documents.unless_same_length(stages.narratives(e), selection.with_project(e.prop)).select("lead", "prop_id", "text")


@query("txt_concat_sections", "SELECT doc_id AS prop_id, if(source LIKE '%7', '(in the PDF)', concat(text, lang, source)) AS summ FROM documents")
def txt_concat_sections(e):
    return stages.summaries(e).select("prop_id", "summ")


def _ascii_sql(col: str) -> str:
    def lit(s):
        return "'" + s.replace("'", "''") + "'" if s.isprintable() else f"chr({ord(s)})"

    for a, b in {**text.ONE_TO_ONE, **text.ONE_TO_MANY}.items():
        col = f"replace({col}, {lit(a) if a.isprintable() and not a.isspace() else f'chr({ord(a)})'}, {lit(b)})"
    return col


@query("txt_clean_ascii", f"SELECT 'd' AS kind, doc_id AS id, {_ascii_sql('text')} AS clean FROM documents UNION ALL SELECT 'p', page_id, {_ascii_sql('html')} FROM pages")
def txt_clean_ascii(e):
    docs = e.table("documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), text.to_ascii("text").alias("clean"))
    return docs.unionByName(e.table("pages").select(F.lit("p").alias("kind"), F.col("page_id").alias("id"), text.to_ascii("html").alias("clean")))


@query("txt_strip_brackets", """SELECT conv_id, turn, regexp_replace(concat('[[', role, ']] ', text, ' [[end', chr(10), 'note]]'), '(?s)\\[\\[.*?\\]\\]', '', 'g') AS clean FROM conversations""")
def txt_strip_brackets(e):
    marked = F.concat(F.lit("[["), F.col("role"), F.lit("]] "), F.col("text"), F.lit(" [[end\nnote]]"))
    return e.table("conversations").select("conv_id", "turn", text.strip_brackets(marked).alias("clean"))


@query("txt_quest_marks", """
WITH RECURSIVE d AS (SELECT doc_id, replace(replace(text, ',', '?'), '. ', '?x') AS t FROM documents),
w AS (SELECT doc_id, t, length(t) + 1 AS stop, ' ' AS s FROM d
  UNION ALL SELECT doc_id, t, CASE WHEN i < 4 THEN 0 WHEN plain THEN i ELSE i - 3 END,
    CASE WHEN i < 4 THEN substr(t, i, 5) || '|' || s WHEN plain THEN s ELSE substr(t, i - 3, 8) || '|' || s END
  FROM (SELECT *, stop - strpos(reverse(substr(t, 1, stop - 1)), '?') AS i, regexp_full_match(substr(t, stop - strpos(reverse(substr(t, 1, stop - 1)), '?') - 1, 3), '[a-zA-Z][?][ ''"]') AS plain
    FROM w WHERE stop > 1 AND strpos(substr(t, 1, stop - 1), '?') > 0) q)
SELECT doc_id, arg_min(s, stop) AS marks FROM w GROUP BY doc_id""")
def txt_quest_marks(e):
    lost = F.replace(F.replace(F.col("text"), F.lit(","), F.lit("?")), F.lit(". "), F.lit("?x"))
    return e.table("documents").select("doc_id", text.question_marks(lost).alias("marks"))


@query("txt_keyword_tail", """
WITH k AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || ' Keywords: ' || source WHEN 1 THEN text || ' KEY WORD: ' || lang ELSE text END AS a, CASE doc_id % 4 WHEN 2 THEN source || ' key words ' || text ELSE lang || ' keyword' END AS b FROM documents)
SELECT doc_id, CASE WHEN contains(lower(a), 'keyword') AND strpos(lower(a), 'keyword') + 7 <= length(a) THEN substr(a, strpos(lower(a), 'keyword') + 8)
  WHEN contains(lower(a), 'key word') AND strpos(lower(a), 'key word') + 8 <= length(a) THEN substr(a, strpos(lower(a), 'key word') + 9)
  WHEN contains(lower(b), 'keyword') AND strpos(lower(b), 'keyword') + 7 <= length(b) THEN substr(b, strpos(lower(b), 'keyword') + 8)
  WHEN contains(lower(b), 'key word') AND strpos(lower(b), 'key word') + 8 <= length(b) THEN substr(b, strpos(lower(b), 'key word') + 9) ELSE '' END AS tail FROM k""")
def txt_keyword_tail(e):
    d, t = F.col("doc_id") % 4, F.col("text")
    a = F.when(d == 0, F.concat(t, F.lit(" Keywords: "), "source")).when(d == 1, F.concat(t, F.lit(" KEY WORD: "), "lang")).otherwise(t)
    b = F.when(d == 2, F.concat("source", F.lit(" key words "), t)).otherwise(F.concat("lang", F.lit(" keyword")))
    return e.table("documents").select("doc_id", text.keyword_tail(a, b).alias("tail"))


@query("txt_search_flag", """
SELECT d.doc_id, CASE WHEN lower(p.prop_titl_txt) LIKE '%study 1%' OR lower(d.text || d.lang || d.source) LIKE '%src1%' THEN 'Y' ELSE 'N' END AS found,
CASE WHEN lower(p.prop_titl_txt) LIKE '%study 1%' THEN 1 ELSE 0 END AS in_title FROM documents d JOIN v_prop p ON p.prop_id = d.doc_id""")
def txt_search_flag(e):
    joined = stages.narratives(e).join(e.prop.select("prop_id", "prop_titl_txt"), "prop_id")
    in_title = text.contains("prop_titl_txt", "Study 1")
    in_text = text.contains(F.concat("text", "lang", "source"), "SRC1")
    return joined.select(F.col("prop_id").alias("doc_id"), F.when(in_title | in_text, "Y").otherwise("N").alias("found"),
                         F.when(in_title, 1).otherwise(0).alias("in_title"))


@query("txt_title_flag", """SELECT prop_id, CASE WHEN strpos(upper(prop_titl_txt), 'GOALI') > 0 THEN 'Y' END AS "GOALI_flag" FROM v_prop""")
def txt_title_flag(e):
    return e.prop.select("prop_id", text.title_flag("prop_titl_txt", "GOALI").alias("GOALI_flag"))


@query("txt_doc_presence", """
SELECT s.prop_id, coalesce((SELECT CAST(pdf_page_cnt AS STRING) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'proj_desc' AND pdf_page_cnt > 0), 'No PD') AS "ProjDesc",
CASE WHEN NOT EXISTS (SELECT 1 FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'bibl' AND (coalesce(trim(path_name), '') <> '' OR text_len > 0)) THEN 'No RC'
  ELSE (SELECT CAST(pdf_page_cnt AS STRING) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'bibl') END AS "RefCited",
CASE WHEN NOT EXISTS (SELECT 1 FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'dmp_plan' AND trim(path_name) <> '') THEN 'No DMP'
  ELSE (SELECT CAST(pdf_page_cnt AS STRING) FROM v_doc d WHERE d.temp_prop_id = s.temp_prop_id AND d.kind = 'dmp_plan') END AS "DMP" FROM v_subm s""")
def txt_doc_presence(e):
    return (e.subm.join(documents.presence(e.doc), "temp_prop_id", "left")
            .select("prop_id", documents.project_description().alias("ProjDesc"),
                    documents.references_cited().alias("RefCited"), documents.data_plan().alias("DMP")))


@query("txt_length_stats", f"""
SELECT r.revr_id, {average_sql("length(d.text)")} AS avg_len, {deviation_sql("length(d.text)")} AS std_len FROM v_rev r JOIN documents d ON d.doc_id = r.prop_id JOIN v_rating m ON m.yn = r.rev_prop_rtng_ind GROUP BY r.revr_id""")
def txt_length_stats(e):
    return reviews.score_stats(stages.timed(e)).select("revr_id", "avg_len", "std_len")


@query("txt_person_name", """
SELECT v.revr_id, v.revr_last_name || ', ' || v.revr_frst_name AS last_first, v.revr_frst_name || ' ' || v.revr_last_name || ', ' || coalesce(i.inst_shrt_name, '') AS first_last_inst FROM v_revr v LEFT JOIN v_inst i ON i.inst_id = v.inst_id""")
def txt_person_name(e):
    return (e.revr.join(e.inst.select("inst_id", "inst_shrt_name"), "inst_id", "left")
            .select("revr_id", people.last_first("revr_last_name", "revr_frst_name").alias("last_first"),
                    people.first_last_place("revr_frst_name", "revr_last_name", "inst_shrt_name").alias("first_last_inst")))
