"""Documents of a proposal: which are there, and its texts as one stream of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("proj_desc", "bibl", "dmp_plan", "ment_plan", "budg_expl", "supp")


def presence(docs: DataFrame, kinds=KINDS) -> DataFrame:
    """One row per submission: per kind its pages and whether there is a path or a text."""
    aggs = []
    for k in kinds:
        here = F.col("kind") == k
        path = F.col("path_name")
        aggs += [F.sum(F.when(here, F.col("pdf_page_cnt"))).alias(f"{k}_pg"),
                 F.max(F.when(here & (F.trim(path) != ""), 1)).alias(f"{k}_file"),
                 F.max(F.when(here & (F.col("text_len") > 0), 1)).alias(f"{k}_text"),
                 F.count_if(here).alias(f"{k}_n")]
    return docs.groupBy("temp_prop_id").agg(*aggs)


def pages_or(missing: Column, label: str, pages: Column) -> Column:
    return F.when(missing, F.lit(label)).otherwise(pages.cast("string"))


def project_description() -> Column:
    return F.when(F.col("proj_desc_pg") > 0, F.col("proj_desc_pg").cast("string")).otherwise("No PD")


def references_cited() -> Column:
    nothing = F.col("bibl_file").isNull() & F.col("bibl_text").isNull()
    return pages_or(nothing, "No RC", F.col("bibl_pg"))


def data_plan() -> Column:
    return pages_or(F.col("dmp_plan_file").isNull(), "No DMP", F.col("dmp_plan_pg"))


def mentoring_plan(postdoc: Column) -> Column:
    return pages_or((postdoc > 0) & F.col("ment_plan_file").isNull(), "No MP", F.col("ment_plan_pg"))


def unless_same_length(texts: DataFrame, projects: DataFrame, col: str = "text") -> DataFrame:
    """Texts of heads, and of collaborators only where the length differs from the head's.

    A head with several texts is represented by its longest. The heads' lengths travel to the
    proposals first, without texts, so texts are shuffled once, by their own proposal.
    """
    heads = (texts.select(F.col("prop_id").alias("lead"), F.length(col).alias("_len"))
             .groupBy("lead").agg(F.max("_len").alias("_len")))
    wanted = projects.select("prop_id", "lead", "ILN").join(heads, "lead", "left")
    compared = texts.join(wanted, "prop_id")
    return compared.filter((F.col("ILN") < "M") | (F.length(col) != F.col("_len"))).drop("_len")


STREAM = ["lead", "prop_id", "doc_type", "name", "info", "stts", "due", "returned", "score", "text"]


def as_stream(df: DataFrame, doc_type: str, **cols: Column | str) -> DataFrame:
    """Bring one kind of text into the common shape; what it does not have is null."""
    types = {"lead": "bigint", "prop_id": "bigint", "name": "string", "info": "string", "stts": "string",
             "due": "timestamp_ntz", "returned": "timestamp_ntz", "score": "string", "text": "string"}
    out = []
    for field in STREAM:
        if field == "doc_type":
            out.append(F.lit(doc_type).alias(field))
            continue
        c = cols.get(field)
        c = F.lit(None) if c is None else (F.col(c) if isinstance(c, str) else c)
        out.append(c.cast(types[field]).alias(field))
    return df.select(*out)
