"""What a user types or pastes: id lists, small literal tables; and the rating table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NBSP = " "

# Packed ratings (Excellent, Very good, Good, Fair, Poor as Y/N), their text and score.
RATINGS = [
    ("NNNNN", "R", None), ("NNNNY", "P", 1.0), ("NNNYN", "F", 3.0), ("NNNYY", "F/P", 2.0),
    ("NNYNN", "G", 5.0), ("NNYNY", "G/P", 2.98), ("NNYYN", "G/F", 4.0), ("NNYYY", "G/F/P", 2.99),
    ("NYNNN", "V", 7.0), ("NYNNY", "V/P", 3.98), ("NYNYN", "V/F", 4.98), ("NYNYY", "V/F/P", 3.65),
    ("NYYNN", "V/G", 6.0), ("NYYNY", "V/G/P", 4.32), ("NYYYN", "V/G/F", 4.99), ("NYYYY", "V/G/F/P", 3.97),
    ("YNNNN", "E", 9.0), ("YNNNY", "E/P", 4.992), ("YNNYN", "E/F", 5.98), ("YNNYY", "E/F/P", 4.325),
    ("YNYNN", "E/G", 6.98), ("YNYNY", "E/G/P", 4.995), ("YNYYN", "E/G/F", 5.66), ("YNYYY", "E/G/F/P", 4.5),
    ("YYNNN", "E/V", 8.0), ("YYNNY", "E/V/P", 5.666), ("YYNYN", "E/V/F", 6.33), ("YYNYY", "E/V/F/P", 4.996),
    ("YYYNN", "E/V/G", 6.99), ("YYYNY", "E/V/G/P", 5.5), ("YYYYN", "E/V/G/F", 5.99), ("YYYYY", "E/V/G/F/P", 4.997),
]

# The score of a single letter.
LETTER_SCORES = {"E": 9.0, "V": 7.0, "G": 5.0, "F": 3.0, "P": 1.0}


def rating_table(spark: SparkSession) -> DataFrame:
    """yn, string, score: 32 constant rows, always safe to broadcast."""
    return spark.createDataFrame(RATINGS, "yn string, string string, score double")


def pad_id(col: Column | str, width: int = 7) -> Column:
    """Text id with leading zeros; longer ids stay whole."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def id_prefix(col: Column | str, prefix: str, width: int = 7) -> Column:
    """Whether a numeric id, padded to `width` digits, begins with a prefix: a range, which reaches the scan."""
    step = 10 ** (width - len(prefix))
    c = F.col(col) if isinstance(col, str) else col
    return c.between(int(prefix) * step, (int(prefix) + 1) * step - 1)


def clean_ids(lines: DataFrame, col: str, width: int | None = None, name: str = "prop_id") -> DataFrame:
    """Distinct ids of a user's column: blanks (also invisible ones) removed, empties dropped."""
    bare = F.regexp_replace(F.col(col), f"[ {NBSP}]", "")
    out = lines.select(bare.alias(name)).filter(F.col(name) != "").distinct()
    return out if width is None else out.withColumn(name, pad_id(name, width))


def ids_from_lines(lines: DataFrame, col: str, name: str = "prop_id") -> DataFrame:
    """Ids pasted from a work list: the number that starts a line, if it has 6 to 8 digits.

    Only the first ten characters count, and blanks inside them are ignored.
    """
    head = F.regexp_replace(F.substring(F.col(col), 1, 10), r"[ \t\r]", "")
    number = F.bround(F.regexp_extract(head, r"^([0-9]+(\.[0-9]+)?)", 1).try_cast("double")).cast("long")
    return (lines.select(number.alias("_n"))
            .filter((F.col("_n") >= 100000) & (F.col("_n") < 100000000))
            .select(pad_id("_n").alias(name)))


def literal_table(spark: SparkSession, rows: Sequence[Sequence[object]], schema: T.StructType | str) -> DataFrame:
    """A typed table out of spreadsheet cells.

    Rows with a blank first cell are skipped, other blank cells become null, integers are parsed
    where the schema says so.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    parsed = []
    for row in rows:
        if str(row[0] if row[0] is not None else "").strip() == "":
            continue
        out = []
        for cell, field in zip(row, struct.fields, strict=True):
            text = "" if cell is None else str(cell)
            if text.strip() == "":
                out.append(None)
            elif isinstance(field.dataType, T.IntegralType):
                out.append(int(text))
            elif isinstance(field.dataType, T.FractionalType):
                out.append(float(text))
            else:
                out.append(text)
        parsed.append(tuple(out))
    return spark.createDataFrame(parsed, struct)
