"""URL filter: a few longest-match rules, and association rules mined from what those rules label.

Labelled are the pages that a list of rules covers, and those whose host has a word from a short list
(``SEEDS``).  URLs become sets of tokens (host labels and their parts, path segments, query keys;
digits as ``#``, in parts left out), with the label, if there is one, as one more token.  Tokens that always
come together, as the segments of a deep path that many pages share, are one item (the first of them), so that
their subsets are not mined one by one.  Spark's FP-growth mines the frequent item sets of all pages, so
unlabelled pages count against a rule; rules with a label as their consequent stay if their
confidence and support suffice and no shorter rule of the same label is as sure.  A page that no listed
rule covers is blocked if its host has a seed word, with confidence 1 as for the listed rules, both
being given by hand; else it gets the verdict of its surest mined rule, found through an inverted
index on each rule's rarest token; else ``allow``.

Frequent items of a page are few where its tokens vary freely; ``max_rules`` is checked all the same, and
beyond it the matching runs as a join, with the same result.

:func:`judge` writes ``host``, ``path``, ``rule``, ``verdict``, ``confidence`` and ``mined_tokens``, in
place of columns of those names; other columns stay.  Repeated rows count each and are judged alike; of
rules equally sure the longer, then the more frequent, then ``block``, then the first by its tokens wins.
A very long url is a long set of tokens.  An empty table gives an empty result.

Null urls and urls without ``://`` have an empty host and path, no tokens, and are allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, run_dir, written

#: Words in host names that mark a page as blocked when rules are mined; a parameter of :func:`judge`.
SEEDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "warez")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class ListRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    ListRule("block", "net", "/"),
    ListRule("allow", "example.net", "/en/"),
    ListRule("block", "example.com", "/de/"),
    ListRule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


_DIGITS = regex.compile(r"\d+")
_SPLIT = regex.compile(r"[^\p{L}\p{M}\p{N}]+|\d+")


def tokens_of(url: str | None) -> list[str]:
    """Distinct tokens of a URL, sorted."""
    if not url or "://" not in url:
        return []
    rest = url.split("://", 1)[1]
    rest, _, _ = rest.partition("#")
    rest, _, query = rest.partition("?")
    host, _, path = rest.partition("/")
    out = set()
    for label in host.lower().split("."):
        if label:
            out.add("host:" + _DIGITS.sub("#", label))
            out.update("part:" + p for p in _SPLIT.split(label) if p and p != label)  # a whole label is its own part
    for seg in _DIGITS.sub("#", path.lower()).split("/"):
        if seg and seg != "#":
            out.add("path:" + seg)
    for pair in _DIGITS.sub("#", query.lower()).split("&"):
        key = pair.partition("=")[0]
        if key:
            out.add("query:" + key)
    return sorted(out)


def with_tokens(pages: DataFrame, url: str = "url") -> DataFrame:
    bounded_batches(pages.sparkSession)

    @F.arrow_udf("array<string>")
    def run(urls: pa.Array) -> pa.Array:
        return pa.array([tokens_of(u) for u in urls.to_pylist()], pa.list_(pa.string()))

    return pages.withColumn("tokens", run(F.col(url)))


@dataclass(frozen=True)
class MinedRule:
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def together(sets: DataFrame, min_support: float) -> DataFrame:
    """(token, item): the frequent tokens of ``tokens``, and the first of those that stand in the very same rows.

    Rows are told apart by all their tokens, so rows that are equal in them may count as one or as many.
    Tokens are alike if as many rows have them and the rows' hashes have the same sum.  At
    most as many tokens are frequent as rows have on average, divided by ``min_support``.
    """
    least = sets.count() * min_support
    each = sets.select(F.explode("tokens").alias("token"), F.xxhash64("tokens").cast("decimal(38,0)").alias("h"))
    seen = each.groupBy("token").agg(F.count("*").alias("n"), F.sum("h").alias("h")).where(F.col("n") >= least)
    first = seen.groupBy("n", "h").agg(F.min("token").alias("item"))
    return seen.join(first, ["n", "h"]).select("token", "item")


def mine(labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.6, max_tokens: int = 3) -> list[MinedRule]:
    """Rules from ``tokens`` and ``verdict`` (null: unlabelled), the surest first.  No rows: no rules."""
    items = labelled.where(F.size("tokens") > 0)
    # frequent tokens only, as items; a row without any stays, as the support is a share of all rows
    known = dict(together(items, min_support).collect())  # a row for each frequent token

    @F.arrow_udf("array<string>")
    def as_items(rows: pa.Array) -> pa.Array:
        return pa.array([sorted({known[t] for t in x if t in known}) for x in rows.to_pylist()], pa.list_(pa.string()))

    items = items.withColumn("tokens", as_items("tokens"))
    items = items.select(F.concat("tokens", F.array_compact(F.array(F.concat(F.lit("label:"), "verdict")))).alias("items"))
    if items.isEmpty():
        return []
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    is_label = lambda x: x.startswith("label:")
    found = model.associationRules.where(is_label(F.col("consequent")[0]) & ~F.exists("antecedent", is_label) & (F.size("antecedent") <= max_tokens))
    rules = sorted(
        (MinedRule(tuple(sorted(r.antecedent)), r.consequent[0].removeprefix("label:"), r.confidence, r.support) for r in found.toLocalIterator()),
        key=lambda r: (len(r.tokens), r.tokens, r.verdict),
    )
    kept: list[MinedRule] = []
    by_token: dict[str, list[MinedRule]] = {}
    for r in rules:
        shorter = {x for t in r.tokens for x in by_token.get(t, ())}
        if not any(x.verdict == r.verdict and x.confidence >= r.confidence and set(x.tokens) < set(r.tokens) for x in shorter):
            kept.append(r)
            for t in r.tokens:
                by_token.setdefault(t, []).append(r)
    return sorted(kept, key=lambda r: (-r.confidence, -len(r.tokens), -r.support, r.verdict != "block", r.tokens))


class Index:
    """Inverted index: every rule stands under the token of its own that fewest rules have."""

    def __init__(self, rules: list[MinedRule]):
        uses: dict[str, int] = {}
        for r in rules:
            for t in r.tokens:
                uses[t] = uses.get(t, 0) + 1
        self.rules = rules
        self.under: dict[str, list[tuple[int, frozenset]]] = {}
        for k, r in enumerate(rules):
            self.under.setdefault(min(r.tokens, key=lambda t: (uses[t], t)), []).append((k, frozenset(r.tokens)))

    def match(self, tokens: list[str]) -> MinedRule | None:
        have = set(tokens)
        hits = [k for t in have for k, need in self.under.get(t, ()) if need <= have]
        return self.rules[min(hits)] if hits else None


def by_rules(pages: DataFrame, rules: list[MinedRule], max_rules: int = 100_000) -> DataFrame:
    """Adds ``mined`` (verdict, confidence and the rule's tokens; null where no mined rule matches) to pages with ``tokens``."""
    kind = "struct<verdict:string,confidence:double,tokens:string>"
    if not rules:
        return pages.withColumn("mined", F.lit(None).cast(kind))
    spark = pages.sparkSession
    if len(rules) <= max_rules:
        index = spark.sparkContext.broadcast(Index(rules))

        @F.arrow_udf(kind)
        def run(tokens: pa.Array) -> pa.Array:
            got = [index.value.match(t or []) for t in tokens.to_pylist()]
            return pa.array(
                [r and {"verdict": r.verdict, "confidence": r.confidence, "tokens": " ".join(r.tokens)} for r in got],
                pa.struct([("verdict", pa.string()), ("confidence", pa.float64()), ("tokens", pa.string())]),
            )

        return pages.withColumn("mined", run(F.col("tokens")))
    under = Index(rules).under
    table = spark.createDataFrame(
        [(t, k, list(rules[k].tokens), rules[k].verdict, rules[k].confidence) for t, at in under.items() for k, _ in at],
        "token string, k long, need array<string>, verdict string, confidence double",
    )
    sets = pages.select("tokens").distinct()
    hits = sets.withColumn("token", F.explode("tokens")).join(table, "token").where(F.size(F.array_except("need", "tokens")) == 0)
    best = hits.groupBy("tokens").agg(F.min_by(F.struct("verdict", "confidence", F.array_join("need", " ").alias("tokens")), "k").alias("mined"))
    return pages.join(best, "tokens", "left")


def judge(pages: DataFrame, rules=RULES, seeds=SEEDS, max_rules: int | None = None, **mining) -> DataFrame:
    """Host, path, listed rule, verdict, and for the method's own verdicts how sure it is; other columns stay."""
    parsed = with_tokens(pages).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "listed": verdict})
    seeded = F.when(F.arrays_overlap("tokens", F.array(*[F.lit(kind + w) for w in seeds for kind in ("host:", "part:")])), "block") if seeds else F.lit(None)
    # tokens are made once, for the several passes of the mining and for the matching
    parsed = written(parsed, run_dir(pages.sparkSession, "urls"), "parsed")
    mined = mine(parsed.select("tokens", F.coalesce("listed", seeded).alias("verdict")), **mining)
    out = by_rules(parsed, mined, **({"max_rules": max_rules} if max_rules is not None else {}))
    by_seed = F.when(seeded.isNotNull(), 1.0)
    return out.withColumns(
        {
            "verdict": F.coalesce("listed", seeded, F.col("mined.verdict"), F.lit("allow")),
            "confidence": F.when(F.col("listed").isNotNull(), 1.0).otherwise(F.coalesce(by_seed, F.col("mined.confidence"), F.lit(0.0))),
            "mined_tokens": F.when(F.col("listed").isNull() & seeded.isNull(), F.col("mined.tokens")),
        }
    ).drop("listed", "mined", "tokens")


def report(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "confidence", "mined_tokens")
