"""UDF surface (U1–U3), re-expressed natively where possible.

* U2 ``first[0] + last + str(age)[-2]`` is a native expression (``name_code``);
  an Arrow-batched pandas UDF with the same result is kept for callers that want
  the UDF form (``name_code_udf``) — never used on a hot path here.
* U3 ``normalize_phone`` is registered as a SQL function, so it can be called from
  SQL text and is inlined by the optimizer.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def name_code(first: Column | str, last: Column | str, age: Column | str) -> Column:
    """First initial + last name + the tens digit of the age.

    ``str(age)[-2]`` is the second character from the end; for a one-digit age the
    reference raises, here the digit part is ''.
    """
    return F.concat(
        F.substring(_c(first), 1, 1), _c(last), F.substring(_c(age).cast("string"), -2, 1)
    )


@F.pandas_udf(StringType())
def name_code_udf(first: pd.Series, last: pd.Series, age: pd.Series) -> pd.Series:
    """U2 as an Arrow-batched pandas UDF (vectorised string ops, no per-row Python calls)."""
    a = age.astype("Int64").astype("string")
    tens = a.str.slice(-2, -1).fillna("")
    return first.str.slice(0, 1) + last + tens


PHONE_FN = "normalize_phone"


def register_normalize_phone(spark: SparkSession) -> str:
    """``normalize_phone(STRING) RETURNS STRING`` — keep digits only (SQL function)."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {PHONE_FN}(s STRING) RETURNS STRING "
        "RETURN regexp_replace(s, '[^0-9]', '')"
    )
    return PHONE_FN


def phone_or_null(raw: Column | str, min_len: int = 10, max_len: int = 15) -> Column:
    """F32: digits only; NULL unless the digit string is ``min_len``–``max_len`` long."""
    d = F.regexp_replace(_c(raw), "[^0-9]", "")
    return F.when(F.length(d).between(min_len, max_len), d)
