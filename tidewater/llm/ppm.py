"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of up to three bytes, learnt from a bounded sample of
labelled texts.  The cost of a byte is its exact code length under the frozen counts: the longest
known context predicts it or escapes (escape method C) to the next shorter one, from which the bytes
already excluded are taken out; below the empty context all remaining byte values are equally likely.
The language with the shortest code wins.

Texts without a letter, empty or null, are ``und`` with score 0.  Ties go to the language that is
first in alphabetical order.  Without any labelled text everything is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches, held_out

ORDER = 3
_LETTER = regex.compile(r"\p{L}")
_CHUNK = 1 << 20


def _segments(texts):
    """(index, bytes with three bytes of context before them); long texts come in several pieces."""
    for i, x in enumerate(texts):
        b = b"\0" * ORDER + x.encode("utf-8", "surrogatepass")
        for at in range(0, len(b) - ORDER, _CHUNK):
            yield i, b[at : at + _CHUNK + ORDER]


def _codes(b: bytes) -> np.ndarray:
    """For each byte after the first three, it and the three before it as one number."""
    x = np.frombuffer(b, np.uint8).astype(np.uint32)
    return (x[:-3] << 24) | (x[1:-2] << 16) | (x[2:-1] << 8) | x[3:]


class Tree:
    """Counts of one language, for orders 0 to 3, as sorted arrays."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.keys, self.n, self.ctx, self.total, self.kinds = [], [], [], [], []
        self.left_total, self.left_kinds = [None], [None]
        for order in range(ORDER + 1):
            mask = np.uint32((1 << (8 * (order + 1))) - 1)
            key, inv = np.unique(grams & mask, return_inverse=True)
            n = np.bincount(inv, counts, len(key))
            ctx, inv = np.unique(key >> np.uint32(8), return_inverse=True)
            self.keys.append(key)
            self.n.append(n)
            self.ctx.append(ctx)
            self.total.append(np.bincount(inv, n, len(ctx)))
            self.kinds.append(np.bincount(inv, minlength=len(ctx)).astype(float))
            if order:  # what the next shorter context holds besides the bytes seen in this one
                short = np.uint32((1 << (8 * order)) - 1)
                seen = self.n[order - 1][np.searchsorted(self.keys[order - 1], key & short)]
                up = np.searchsorted(self.ctx[order - 1], ctx & np.uint32((1 << (8 * (order - 1))) - 1)) if order > 1 else np.zeros(len(ctx), int)
                self.left_total.append(self.total[order - 1][up] - np.bincount(inv, seen, len(ctx)))
                self.left_kinds.append(self.kinds[order - 1][up] - self.kinds[order])

    def bits(self, codes: np.ndarray) -> np.ndarray:
        cost = np.zeros(len(codes))
        todo = np.arange(len(codes))
        total = kinds = None  # of the coming order, where a longer context was escaped from
        for order in range(ORDER, -1, -1):
            if not len(todo):
                return cost
            c = codes[todo]
            ctx = (c >> np.uint32(8)) & np.uint32((1 << (8 * order)) - 1)
            at = np.minimum(np.searchsorted(self.ctx[order], ctx), len(self.ctx[order]) - 1)
            known = self.ctx[order][at] == ctx
            t, d = self.total[order][at], self.kinds[order][at]
            if total is not None:
                escaped = total >= 0
                t, d = np.where(escaped, total, t), np.where(escaped, kinds, d)
            key = c & np.uint32((1 << (8 * (order + 1))) - 1)
            k = np.minimum(np.searchsorted(self.keys[order], key), len(self.keys[order]) - 1)
            hit = known & (self.keys[order][k] == key)
            cost[todo[hit]] += np.log2((t + d)[hit]) - np.log2(self.n[order][k[hit]])
            out = known & ~hit & (d > 0)
            cost[todo[out]] += np.log2((t + d)[out]) - np.log2(d[out])
            if order:
                total = np.where(known, self.left_total[order][at], -1.0)[~hit]
                kinds = np.where(known, self.left_kinds[order][at], 0.0)[~hit]
            todo = todo[~hit]
        cost[todo] += np.log2(max(1.0, 256 - len(self.keys[0])))
        return cost


class Model:
    """Trees of several languages and a memo of fixed size for code lengths already worked out."""

    SLOTS = 20

    def __init__(self, trees: dict[str, Tree]):
        self.langs = sorted(trees)
        self.trees = [trees[x] for x in self.langs]
        self._keys = None

    def __getstate__(self):
        return {"langs": self.langs, "trees": self.trees, "_keys": None}

    def _costs(self, codes: np.ndarray) -> np.ndarray:
        if self._keys is None:
            self._keys = np.zeros(1 << self.SLOTS, np.uint32)
            self._cost = np.zeros((1 << self.SLOTS, len(self.langs)), np.float32)
            self._cost[0] = self._slow(np.zeros(1, np.uint32))[0]
        slot = (codes * np.uint32(2654435761)) >> np.uint32(32 - self.SLOTS)
        miss = self._keys[slot] != codes
        out = self._cost[slot]
        if miss.any():
            new, inv = np.unique(codes[miss], return_inverse=True)
            cost = self._slow(new)
            out[miss] = cost[inv]
            at = (new * np.uint32(2654435761)) >> np.uint32(32 - self.SLOTS)
            _, last = np.unique(at[::-1], return_index=True)  # one owner for each slot
            last = len(at) - 1 - last
            keep = at[last] != 0
            self._keys[at[last][keep]] = new[last][keep]
            self._cost[at[last][keep]] = cost[last][keep]
        return out

    def _slow(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([t.bits(codes) for t in self.trees], 1).astype(np.float32)

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of every text under every language."""
        out = np.zeros((len(texts), len(self.langs)))
        rows, parts, size = [], [], 0
        for i, b in [*_segments(texts), (None, None)]:
            if b is not None:
                rows.append(i)
                parts.append(_codes(b))
                size += len(b)
            if rows and (b is None or size >= _CHUNK):
                cost = self._costs(np.concatenate(parts))
                starts = np.cumsum([0, *map(len, parts[:-1])])
                np.add.at(out, rows, np.add.reduceat(cost, starts, 0, dtype=float))
                rows, parts, size = [], [], 0
        return out


def sample(docs: DataFrame, per_language: int, max_chars: int) -> DataFrame:
    """About ``per_language`` labelled texts of each language, chosen by a hash of the id; all of them where there are no more."""
    known = docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") <= max_chars))
    sizes = known.groupBy("lang").count().collect()  # a row for each language
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, min(1.0, per_language / r["count"]))]) if sizes else F.create_map().cast("map<string,double>")
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))


def _count(batches):
    """Counts of four-byte strings per language in what one task reads."""
    found: dict[str, list] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            if text:
                found.setdefault(lang, []).extend(_codes(s) for _, s in _segments([text]))
    for lang, codes in found.items():
        gram, n = np.unique(np.concatenate(codes), return_counts=True)
        for at in range(0, len(gram), 50_000):
            part = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram[part])), pa.array(gram[part].astype(np.int64)), pa.array(n[part].astype(np.int64))], ["lang", "gram", "n"])


def train(docs: DataFrame, per_language: int = 400, max_chars: int = 100_000, max_grams: int = 500_000) -> Model:
    """Learn from text and language of a sample bounded by ``per_language`` texts of up to ``max_chars`` characters.

    The most frequent ``max_grams`` four-byte strings of each language are kept, so the model has a fixed bound too.
    """
    bounded_batches(docs.sparkSession)
    grams = sample(docs, per_language, max_chars).select("lang", "text").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = grams.toArrow()
    lang, gram, n = (got.column(c).combine_chunks() for c in ("lang", "gram", "n"))
    trees = {}
    for x in lang.unique().to_pylist():
        own = np.flatnonzero(pc.equal(lang, x).to_numpy(zero_copy_only=False))
        g, k = gram.to_numpy()[own], n.to_numpy()[own]
        most = np.lexsort((g, -k))[:max_grams]
        trees[x] = Tree(g[most].astype(np.uint32), k[most].astype(float))
    return Model(trees)


IDENTIFIED = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])


def judge(model: Model, texts: list) -> pa.Array:
    ok = [i for i, x in enumerate(texts) if x and model.langs and _LETTER.search(x)]
    out = [{"lang_pred": "und", "score": 0.0, "bits_per_byte": None}] * len(texts)
    if ok:
        bits = model.bits([texts[i] for i in ok])
        size = np.array([len(texts[i].encode("utf-8", "surrogatepass")) for i in ok], float)
        rate = bits / size[:, None]
        best = rate.argmin(1)
        low = rate[np.arange(len(ok)), best]
        # how much likelier the best is than all, over as much as 50 bytes of such text
        share = 1 / np.exp2(-(rate - low[:, None]) * np.minimum(size, 50)[:, None]).sum(1)
        for j, i in enumerate(ok):
            out[i] = {"lang_pred": model.langs[best[j]], "score": float(share[j]), "bits_per_byte": float(low[j])}
    return pa.array(out, IDENTIFIED)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1) and ``bits_per_byte`` of the best language (null for ``und``).

    Extra columns stay; columns of these three names are replaced.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,bits_per_byte:double>")
    def run(texts: pa.Array) -> pa.Array:
        return judge(shared.value, texts.to_pylist())

    held = docs.withColumn("__ppm", run(F.col(text)))
    return held.withColumns({k: F.col(f"__ppm.{k}") for k in ("lang_pred", "score", "bits_per_byte")}).drop("__ppm")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The pipeline's filter: texts go that are ``und`` or that no learnt language codes in less than their eight bits a byte."""
    kept = identify(docs.withColumn("__row", F.struct(*docs.columns)).select("__row", F.col("text").alias("__text")), model, "__text")
    return kept.where((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < 8)).select("__row.*")
