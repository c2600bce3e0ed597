"""Cleaning expressions for dirty commerce data.

Everything is a Column expression, so a whole cleaning pass is one projection
that Catalyst collapses, with filters pushed as early as their inputs allow.
ANSI mode stays on: dirty text goes through ``try_to_timestamp`` / regex checks /
``try_cast`` and never raises.

Fixed values below (token lists, patterns, formats) must equal the reference's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Text that means "no value".
NULL_TOKENS = ["NULL", "null", "N/A", "NA", ""]
# Accepted date layouts, tried in this order.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "MM-dd-yyyy"]
# Shape of text each layout can possibly parse (a superset of what Spark's parser
# accepts: 4-digit year, optionally negative, 2-digit month and day, ASCII digits).
# Text of another shape skips the parse attempt, whose failure is costly.
_DATE_SHAPES = {
    "yyyy-MM-dd": r"^-?[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "yyyy/MM/dd": r"^-?[0-9]{4}/[0-9]{2}/[0-9]{2}$",
    "MM-dd-yyyy": r"^[0-9]{2}-[0-9]{2}--?[0-9]{4}$",
}
# Plain dates of each layout, and the same date as Spark's own cast reads it, which takes
# a fraction of the parser's time.  Years 0000 and below are left to the parser.
_PLAIN_DATES = {
    "yyyy-MM-dd": (r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z", lambda c: c),
    "yyyy/MM/dd": (r"^(?!0000)[0-9]{4}/[0-9]{2}/[0-9]{2}\z", lambda c: F.translate(c, "/", "-")),
    "MM-dd-yyyy": (r"^[0-9]{2}-[0-9]{2}-(?!0000)[0-9]{4}\z", lambda c: F.concat(F.substring(c, 7, 4), F.lit("-"), F.substring(c, 1, 5))),
}
# Boolean words.
TRUE_WORDS = ["TRUE", "YES", "Y"]
FALSE_WORDS = ["FALSE", "NO", "N"]
# Validation patterns.
EMAIL_RE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PRODUCT_ID_RE = r"^P\d+$"
DECIMAL_TEXT_RE = r"^\d+(\.\d+)?$"
# Canonical countries, payment methods and order states.
USA_NAMES = ["USA", "U.S.A.", "UNITED STATES"]
CREDIT_CARDS = ["Visa", "MasterCard"]
VALID_ORDER_STATUS = ["Delivered", "Pending", "Cancelled", "Returned", "Shipped"]

MONEY = "decimal(18,2)"
# Unrounded amounts and percentages: six decimals.
EXACT = "decimal(18,6)"
PERCENT = "decimal(9,6)"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL when empty."""
    t = F.trim(c)
    return F.when(t != "", t)


def null_token_to_null(c: Column) -> Column:
    """NULL for the null tokens (string columns only — see the schema trap)."""
    return F.when(~c.isin(NULL_TOKENS), c)


def tidy_strings(df: DataFrame, null_tokens: bool = False) -> DataFrame:
    """P23 (+P24) on every string column in one projection."""
    cols = string_columns(df)

    def fix(name):
        # the null tokens hold the empty text, so that one test does for both
        return null_token_to_null(F.trim(F.col(name))) if null_tokens else blank_to_null(F.col(name))

    return df.withColumns({n: fix(n) for n in cols})


def settled(df: DataFrame) -> DataFrame:
    """The same rows, whose columns are computed once: later filters are not moved below this place,
    where they would repeat the columns' whole expressions (one array of one struct, unfolded)."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def parse_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """first layout that parses wins; impossible or unknown dates → NULL."""

    def attempt(f):
        parsed = F.try_to_timestamp(c, F.lit(f)).cast("date")
        shape = _DATE_SHAPES.get(f)
        if not shape:
            return parsed
        plain, iso = _PLAIN_DATES[f]
        return F.when(c.rlike(plain), iso(c).try_cast("date")).when(c.rlike(shape), parsed)

    return F.coalesce(*[attempt(f) for f in formats])


def to_bool(c: Column) -> Column:
    """TRUE/YES/Y → true, FALSE/NO/N → false (case-insensitive, trimmed), else NULL."""
    u = F.upper(F.trim(c))
    return F.when(u.isin(TRUE_WORDS), F.lit(True)).when(u.isin(FALSE_WORDS), F.lit(False))


def valid_or_null(c: Column, pattern: str) -> Column:
    """keep the value only when it matches ``pattern``."""
    return F.when(c.rlike(pattern), c)


def strip_dollar(c: Column) -> Column:
    """remove ``$`` signs."""
    return F.regexp_replace(c, r"\$", "")


def is_decimal_text(c: Column) -> Column:
    """Numeric text check used as a row filter (NULL → row dropped, like the reference)."""
    return c.rlike(DECIMAL_TEXT_RE)


def country(c: Column) -> Column:
    """USA spellings → USA, CANADA → Canada, anything else unchanged."""
    u = F.upper(c)
    return F.when(u.isin(USA_NAMES), "USA").when(u == "CANADA", "Canada").otherwise(c)


def state(c: Column) -> Column:
    """upper-case, MINNESOTA → MN."""
    u = F.upper(c)
    return F.when(u == "MINNESOTA", "MN").otherwise(u)


def payment(c: Column) -> Column:
    """card brands → Credit Card, Debit → Debit Card."""
    return F.when(c.isin(CREDIT_CARDS), "Credit Card").when(c == "Debit", "Debit Card").otherwise(c)


def non_negative_or_zero(c: Column) -> Column:
    """NULL or negative → 0."""
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))


def phone(c: Column) -> Column:
    """F32: digits only, 10–15 long, else NULL."""
    d = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(d).between(10, 15), d)


def email(c: Column) -> Column:
    """valid address → lower-cased, else NULL."""
    return F.when(c.rlike(EMAIL_RE), F.lower(c))
