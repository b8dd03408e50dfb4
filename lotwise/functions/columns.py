"""Column expressions shared by the operators. All are built-in, none is a UDF."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.schemas import DWELLING_TYPES, FRENCH_MONTHS, NULL_KEY_MARKER


def is_dwelling(kind: str = "type_local") -> Column:
    """True for a house or a flat; a lot without type is not a dwelling."""
    return F.coalesce(F.col(kind).isin(*DWELLING_TYPES), F.lit(False))


def price_per_sqm(price: str = "prix", area: str = "surface_bati") -> Column:
    """Price per square metre, null where the area is null or zero."""
    return F.try_divide(F.col(price), F.col(area))


def iso_date(text: str = "date_mutation") -> Column:
    """Strict yyyy-MM-dd parsing: a malformed date fails the job under ANSI mode."""
    return F.to_date(F.col(text), "yyyy-MM-dd")


def nearest_long(number: str) -> Column:
    """Double to long, halves away from zero (a plain cast would truncate)."""
    return F.round(F.col(number)).cast("long")


def padded_postcode(code: str = "code_postal") -> Column:
    return F.lpad(nearest_long(code).cast("string"), 5, "0")


def surrogate_key(*names: str) -> Column:
    """md5 over the dash-joined key parts, a marker standing in for null."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit(NULL_KEY_MARKER)) for n in names]
    return F.md5(F.concat_ws("-", *parts))


def french_month(date: str) -> Column:
    """Month name from a fixed list, so that no JVM locale is involved."""
    return F.element_at(F.array(*map(F.lit, FRENCH_MONTHS)), F.month(date))


def percent_change(new: str, old: str) -> Column:
    return F.round(F.lit(100) * F.try_divide(F.col(new) - F.col(old), F.col(old)), 1)
