"""Text functions (F1, F3, F4, F13, F16, F17, F33, P8, P14, P15) as JVM expressions.

Fixed values below must equal the reference's behaviour:
* whitespace for ``str.split()`` (Python's definition of whitespace);
* the word pattern ``\\b\\w+(?: '\\w+)*\\b`` (words, optionally joined by a
  space-apostrophe part), with ``\\w`` spelled as Unicode letters, numbers and
  underscore so Java and RE2 agree;
* the access-log pattern with capture groups ip, endpoint, status.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.split() treats as whitespace.
PY_WHITESPACE = (
    r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
# word = run of letters / numbers / underscore, optionally followed by
# " '" + another run (the reference's contraction rule).
WORD = r"[\p{L}\p{N}_]+(?: '[\p{L}\p{N}_]+)*"
# Common-log-format capture of ip, endpoint and status.
ACCESS_LOG = r'^(\S+).*?"\S+\s(\S+)\sHTTP/\d\.\d"\s(\d{3})'


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitespace_tokens(text: Column | str) -> Column:
    """``str.split()`` — split on whitespace runs, no empty tokens."""
    return F.filter(F.split(_c(text), PY_WHITESPACE), lambda t: t != F.lit(""))


def normalised_words(text: Column | str) -> Column:
    """lower-cased word tokens (``WORD_RE.findall(line.lower())``)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD), 0)


def access_log_fields(line: Column | str) -> dict[str, Column]:
    """F16: ip, endpoint, status via one regex; a miss yields '' (not NULL)."""
    v = _c(line)
    return {
        "ip": F.regexp_extract(v, ACCESS_LOG, 1),
        "endpoint": F.regexp_extract(v, ACCESS_LOG, 2),
        "status": F.regexp_extract(v, ACCESS_LOG, 3),
    }


def log_line_fields(line: Column | str) -> dict[str, Column]:
    """``date time LEVEL message…`` → level (3rd token, NULL-safe) and message (the rest)."""
    toks = F.split(_c(line), " ")
    return {
        "level": F.get(toks, 2),
        "message": F.array_join(F.slice(toks, 4, F.greatest(F.size(toks) - 3, F.lit(0))), " "),
    }


def neighbour_count(line: Column | str) -> dict[str, Column]:
    """``id nbr nbr …`` → node id and number of neighbours on the line.

    The line is trimmed first (a trailing space would otherwise add a token) and
    split on runs of spaces; the id is ``try_cast`` so malformed lines give NULL.
    """
    toks = F.split(F.trim(_c(line)), " +")
    return {"id": F.get(toks, 0).try_cast("long"), "connections": F.size(toks) - 1}
