"""Column expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_DATE = "1900-01-01"  # fixed value: stored in place of a missing date


def role(lead_prop_id: Column | str, prop_id: Column | str) -> Column:
    """I = individual, L = lead, N = non-lead member of a collaboration."""
    lead, own = _c(lead_prop_id), _c(prop_id)
    return F.when(lead.isNull(), "I").when(lead != own, "N").otherwise("L")


def lead(lead_prop_id: Column | str, prop_id: Column | str) -> Column:
    return F.coalesce(_c(lead_prop_id), _c(prop_id))


def heads_project() -> Column:
    """True on the one row per project that is not a non-lead or a co-investigator."""
    return F.col("ILN").isin("I", "L")


def zero_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(0))


def real_date(col: Column | str) -> Column:
    """The date, or null where the 1900 stand-in is stored."""
    c = _c(col)
    return F.when(c != F.lit(NO_DATE).cast("date"), c)


def only_if_changed(now: Column | str, before: Column | str) -> Column:
    """The earlier value, shown only where it differs from the present one."""
    return F.when(_c(now) != _c(before), _c(before))


def clip(col: Column, width: int | None) -> Column:
    """Truncate to a fixed column width."""
    return col if width is None else F.substring(col, 1, width)


def us_date(col: Column | str) -> Column:
    """mm/dd/yy, cut out of the ISO text so that no session time zone is involved."""
    iso = F.to_date(_c(col)).cast("string")
    return F.concat_ws("/", iso.substr(6, 2), iso.substr(9, 2), iso.substr(3, 2))


def dotted_date(col: Column | str) -> Column:
    """yyyy.mm.dd"""
    return F.translate(F.to_date(_c(col)).cast("string"), "-", ".")


def approval(date: Column | str, pending: Column | str) -> Column:
    """An approval as its date, `Pend` while it is pending, else null."""
    d = _c(date)
    return F.when(d.isNotNull(), us_date(d)).when(_c(pending) == "Y", "Pend")


_WHOLE = "decimal(38,0)"


def half_up(over: Column, under: Column) -> Column:
    """The ratio of two whole numbers (the lower one above 0) as a whole number, halves away from zero; exact, whatever was added in which order."""
    twice = 2 * over + F.signum(over).cast("int") * under
    return ((twice - twice % (2 * under)).cast("double") / (2 * under).cast("double")).cast("double")


def _steps(col: Column | str, scale: int) -> Column:
    return F.round(_c(col) * scale).cast("long")


def average(col: Column | str, scale: int = 1) -> Column:
    """Aggregate: the mean to six places of values that are whole multiples of 1 / scale, from whole sums."""
    total, n = F.sum(_steps(col, scale)).cast(_WHOLE), F.count(_c(col))
    return F.when(n > 0, F.round(half_up(total * (1_000_000 // scale), n)) / 1_000_000)


def deviation(col: Column | str, scale: int = 1) -> Column:
    """Aggregate: the sample deviation to six places of such values; the variance's numerator is a whole number, and null for a single value."""
    x = _steps(col, scale).cast("decimal(18,0)")
    n, total, squares = F.count(_c(col)), F.sum(x).cast("decimal(19,0)"), F.sum(x * x).cast("decimal(28,0)")
    over = (squares * n.cast("decimal(10,0)")).cast(_WHOLE) - (total * total).cast(_WHOLE)
    return F.when(n > 1, F.round(F.sqrt(over.cast("double") / (n * (n - 1)).cast("double")) / scale, 6))


def money(col: Column | str) -> Column:
    """Aggregate: a sum of amounts in exact decimals, to the cent; the order of partial sums cannot change it."""
    return F.sum(_c(col).cast("decimal(18,4)")).cast("decimal(28,2)").cast("double")


def precise(col: Column | str) -> Column:
    """Aggregate: a sum of amounts of up to four places, exact."""
    return F.sum(_c(col).cast("decimal(18,4)")).cast("double")


def dollars(col: Column | str) -> Column:
    """Aggregate: an exact sum in whole dollars."""
    return F.round(F.sum(_c(col).cast("decimal(18,4)")), 0).cast("double")


def flag(cond: Column) -> Column:
    """0/1 so that it can be summed; an unknown condition counts as 0."""
    return F.when(cond, 1).otherwise(0)


def yes(cond: Column) -> Column:
    """`Y` or null."""
    return F.when(cond, "Y")


def differs(a: Column, b: Column) -> Column:
    """Exclusive or of two conditions, an unknown one counting as false."""
    return F.coalesce(a, F.lit(False)) != F.coalesce(b, F.lit(False))


def directorate_code(org_code: Column | str) -> Column:
    return F.concat(F.substring(_c(org_code), 1, 2), F.lit("000000"))


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x
