"""Quality classifier: a sparse ensemble of rules.

Statistics of each text feed shallow random-forest trees; every path from a root is a rule, a
conjunction of thresholds.  A lasso logistic regression over the rules keeps few of them, and these
become one Spark column expression over the statistics: the score is the logistic function of the
intercept and the weights of the rules that hold.

Only text goes into a score.  Labels are learnt from documents that are not held out, of which a
sample of ``max_rows`` is taken by a hash of the id where there are more.  Null and empty texts have
all statistics 0 and get the score those give.  Without labels of both kinds every score is the share of
label 1 (0.5 without any).  If an id has several labels, the lowest counts.

Equal tables give equal models: the fits read the sample in a fixed order, and weights are rounded, as
partial sums reach the driver in any order.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, hash_sample, held_out, run_dir, written

THRESHOLD = 0.7
#: Of the bounded sample: few enough that each round of a fit is one stage, without a tree of partial sums.
FIT_PARTITIONS = 4
DIGITS = 6

STATISTICS = (
    "n_words", "n_lines", "word_length", "upper_share", "digit_share", "symbol_share", "marked_words", "bar_share",
    "new_words", "repeated_lines", "top_word", "letter_share", "comma_share", "line_words",
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.array([33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,;:'\"!?-()" for b in range(256)])
_ENDS = tuple("$%&*#@!|~^<>=+")


def statistics(text: str | None) -> list[float]:
    if not text:
        return [0.0] * len(STATISTICS)
    b = text.encode("utf-8", "surrogatepass")
    of = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, w, ln = len(b), max(1, len(words)), max(1, len(lines))
    letters = max(1, int(of[_UPPER].sum() + of[_LOWER].sum() + of[0xC0:].sum()))
    count = Counter(words)
    return [
        float(len(words)),
        float(len(lines)),
        (n - of[32] - of[10]) / w,
        of[_UPPER].sum() / letters,
        of[_DIGIT].sum() / n,
        of[_SYMBOL].sum() / n,
        sum(x.endswith(_ENDS) for x in words) / w,
        float(of[ord("|")]) / w,
        len(count) / w,
        1 - len(set(lines)) / ln,
        max(count.values(), default=0) / w,
        letters / n,
        float(of[ord(",")]) / w,
        w / ln,
    ]


def with_statistics(docs: DataFrame, text: str = "text", to: str = "stats") -> DataFrame:
    bounded_batches(docs.sparkSession)
    kind = pa.struct([(s, pa.float64()) for s in STATISTICS])

    @F.arrow_udf("struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">")
    def run(texts: pa.Array) -> pa.Array:
        rows = [statistics(x) for x in texts.to_pylist()]
        columns = list(zip(*rows)) if rows else [()] * len(STATISTICS)
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], fields=list(kind))

    return docs.withColumn(to, run(F.col(text)))


Rule = tuple  # of (statistic, is at most, threshold)


def rules_of(node, path: Rule = ()) -> set[Rule]:
    """Every path of a fitted tree, leaves and inner nodes alike, the root aside."""
    out = {path} if path else set()
    if node.getClass().getSimpleName() != "LeafNode":
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], split.threshold()
        out |= rules_of(node.leftChild(), (*path, (name, True, at))) | rules_of(node.rightChild(), (*path, (name, False, at)))
    return out


def simplified(rule: Rule) -> Rule:
    """One bound of each kind for each statistic."""
    tight: dict = {}
    for name, low, at in rule:
        tight[name, low] = min(at, tight.get((name, low), at)) if low else max(at, tight.get((name, low), at))
    return tuple(sorted((name, low, at) for (name, low), at in tight.items()))


def holds(rule: Rule, stats: str) -> Column:
    return reduce(lambda a, b: a & b, [(F.col(f"{stats}.{n}") <= at) if low else (F.col(f"{stats}.{n}") > at) for n, low, at in rule])


class RuleEnsemble:
    def __init__(self, intercept: float, weights: list[tuple[Rule, float]]):
        self.intercept, self.weights = intercept, weights

    def score(self, stats: str = "stats") -> Column:
        total = reduce(lambda a, b: a + b, [F.when(holds(r, stats), w).otherwise(0.0) for r, w in self.weights], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, label, stats) of at most about ``max_rows`` labelled documents that are not held out."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = hash_sample(known.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label")), F.col("doc_id"), max_rows)
    # max_rows pairs of numbers: a fixed bound, whatever the size of the corpus
    return with_statistics(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")).select("doc_id", "label", "stats")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, trees: int = 20, depth: int = 3, lasso: float = 0.002) -> RuleEnsemble:
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = written(sample(docs, labels, max_rows), run_dir(spark, "quality"), "sample")
    seen = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(seen) < 2:
        share = 0.5 if not seen else next(iter(seen))
        return RuleEnsemble(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), [])
    vector = VectorAssembler(inputCols=[f"f_{s}" for s in STATISTICS], outputCol="features")
    rows = rows.repartition(FIT_PARTITIONS).sortWithinPartitions("doc_id", "label", "stats")
    flat = rows.select("label", *[F.col(f"stats.{s}").alias(f"f_{s}") for s in STATISTICS])
    flat = vector.transform(flat).select("label", "features")
    flat.persist()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=11, featureSubsetStrategy="onethird").fit(flat)
    flat.unpersist()
    rules = sorted({simplified(r) for t in forest.trees for r in rules_of(t._call_java("rootNode"))})
    tested = rows.select("label", F.array(*[holds(r, "stats").cast("double") for r in rules]).alias("hit"))
    tested = tested.select("label", array_to_vector("hit").alias("features"))
    tested.persist()
    fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(tested)
    tested.unpersist()
    weights = [(r, round(float(w), DIGITS)) for r, w in zip(rules, fit.coefficients.toArray())]
    return RuleEnsemble(round(float(fit.intercept), DIGITS), [(r, w) for r, w in weights if w])


def score(docs: DataFrame, model: RuleEnsemble, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``score`` and ``predicted``; other columns stay, those two and ``stats`` are replaced."""
    return with_statistics(docs, text).withColumn("score", model.score()).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("stats")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier predicts to be of good quality."""
    model = train(docs, labels)
    kept = score(docs.select(F.struct(*docs.columns).alias("__row"), F.col("text").alias("__text")), model, "__text")
    return kept.where(F.col("predicted") == 1).select("__row.*")
