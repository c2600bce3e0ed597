"""Main text of web pages from flat text blocks, by a decision tree.

A page becomes a flat list of blocks: the text between two block-level tags.  Each has its words, the
share of words inside links, the same of its two neighbours, and what it stands in (article, page
furniture, a container whose class or id names advertising, comments and the like).  A Spark ML
decision tree is trained on a small labelled table of such blocks (``LABELLED``), and turned into a
column expression that keeps or drops each block.

Null or empty html, and pages without a kept block, give an empty text.  Broken markup (missing end
tags, unclosed quotes, ``<`` in text) is read as far as it goes.  Left out before the tree are scripts,
styles, titles and text areas, up to the page's end if they are not closed, and buttons, drawings and
the like (``_HIDDEN``) that have their end tag.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import bounded_batches

_RAW = "script|style|textarea|title"  # text up to the end tag, or the end of the page
_HIDDEN = frozenset("noscript template select svg iframe object canvas button".split())  # markup, left out with its end tag only
_HAS_HIDDEN = re.compile(rf"<(?:{'|'.join(sorted(_HIDDEN))})(?=[\s/>])", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*(?<!/)>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>"']|"[^"]*"|'[^']*')*+|[^>]*)>"""
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("nav header footer aside menu dialog head".split())
_MAIN = frozenset("article main".split())
#: Names in class, id or role that mark what is not the article; also after one of _BEFORE or before one of _AFTER.
_NOISE = frozenset(
    "ad ads advert advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice popup promo promotion related respond share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription tags toolbar widget complementary contentinfo search".split()
)
_BEFORE = frozenset("article blog bottom footer global google header left main mobile page post primary related right secondary side site sticky top user".split())
_AFTER = frozenset(
    "area bar block bottom box container count form frame footer header holder inner item items left link links list main menu meta nav outer panel primary "
    "region right row secondary section slot title top unit widget wrap wrapper".split()
)
#: Words that mark a class or id whatever else it says (comment-thread, ad-300x250), unless one of _NEGATED is there too (no-sidebar).
_STRONG = frozenset("ad ads adsbygoogle adsense adslot adunit advert advertisement advertising breadcrumb breadcrumbs comment comments commentform commentlist consent cookie cookies disqus gdpr newsletter sidebar sponsor sponsored".split())
_NEGATED = frozenset("closed disable disabled enable enabled has have hide is no non not off open with without".split())
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

FEATURES = ("words", "link_density", "prev_words", "prev_link_density", "next_words", "next_link_density", "heading", "in_main", "in_furniture", "in_noise")

#: Labelled blocks: the features in the order above, and whether the block belongs to the main text.
#: What tells them apart: furniture and noise go; so do lists of links (a link next to a link) and short text among
#: links; a link or a short paragraph between texts, a heading over text, and any other text stay.
LABELLED = (
    ((60, 0.0, 55, 0.0, 48, 0.0, 0, 1, 0, 0), 1),
    ((1, 0.0, 9, 0.0, 70, 0.0, 0, 1, 0, 0), 1),
    ((2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 0), 1),
    ((9, 0.0, 12, 0.0, 64, 0.0, 1, 1, 0, 0), 1),
    ((3, 1.0, 40, 0.0, 38, 0.0, 0, 1, 0, 0), 1),
    ((24, 0.4, 30, 0.1, 31, 0.0, 0, 1, 0, 0), 1),
    ((140, 0.02, 1, 1.0, 12, 0.0, 0, 1, 0, 0), 1),
    ((12, 0.0, 1, 1.0, 12, 0.0, 1, 1, 0, 0), 1),
    ((33, 0.0, 2, 1.0, 6, 0.0, 0, 1, 0, 0), 1),
    ((5, 0.0, 5, 0.0, 9, 0.0, 0, 1, 0, 0), 1),
    ((28, 0.0, 40, 0.0, 2, 1.0, 0, 1, 0, 0), 1),
    ((3, 0.0, 50, 0.0, 1, 1.0, 0, 1, 0, 0), 1),
    ((4, 0.0, 1, 1.0, 0, 0.0, 0, 1, 0, 0), 1),
    ((17, 0.0, 17, 0.0, 3, 0.0, 1, 1, 0, 0), 1),
    ((6, 1.0, 4, 0.0, 3, 0.0, 0, 1, 0, 0), 1),
    ((2, 1.0, 9, 0.0, 0, 0.0, 0, 1, 0, 0), 1),
    ((1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), 0),
    ((2, 1.0, 30, 0.0, 2, 1.0, 0, 1, 0, 0), 0),
    ((6, 1.0, 4, 1.0, 30, 0.0, 0, 1, 0, 0), 0),
    ((8, 1.0, 9, 1.0, 7, 1.0, 0, 1, 0, 0), 0),
    ((4, 1.0, 5, 1.0, 0, 0.0, 0, 1, 0, 0), 0),
    ((80, 0.0, 70, 0.0, 60, 0.0, 0, 0, 0, 0), 1),
    ((66, 0.0, 20, 0.0, 2, 1.0, 0, 0, 0, 0), 1),
    ((21, 0.0, 70, 0.0, 4, 0.0, 0, 0, 0, 0), 1),
    ((35, 0.1, 40, 0.0, 5, 0.0, 0, 0, 0, 0), 1),
    ((14, 0.0, 30, 0.1, 20, 0.0, 0, 0, 0, 0), 1),
    ((25, 0.0, 3, 1.0, 30, 0.0, 0, 0, 0, 0), 1),
    ((7, 0.0, 2, 1.0, 45, 0.0, 1, 0, 0, 0), 1),
    ((2, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0), 1),
    ((5, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0, 0), 1),
    ((4, 0.0, 30, 0.0, 6, 0.0, 0, 0, 0, 0), 1),
    ((1, 0.0, 60, 0.0, 50, 0.0, 0, 0, 0, 0), 1),
    ((6, 0.0, 3, 0.0, 5, 0.0, 0, 0, 0, 0), 1),
    ((3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0), 1),
    ((3, 1.0, 40, 0.0, 38, 0.0, 0, 0, 0, 0), 1),
    ((1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), 0),
    ((2, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), 0),
    ((4, 1.0, 3, 1.0, 5, 1.0, 0, 0, 0, 0), 0),
    ((5, 1.0, 3, 1.0, 50, 0.0, 0, 0, 0, 0), 0),
    ((5, 1.0, 50, 0.0, 3, 1.0, 0, 0, 0, 0), 0),
    ((3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), 0),
    ((2, 0.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0), 0),
    ((1, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), 0),
    ((2, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), 0),
    ((3, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0), 0),
    ((60, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), 1),
    ((60, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0), 1),
    ((45, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), 1),
    ((16, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), 1),
    ((30, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), 1),
    ((12, 0.0, 2, 1.0, 3, 1.0, 0, 1, 0, 0), 1),
    ((3, 0.0, 0, 0.0, 2, 1.0, 0, 1, 0, 0), 1),
    ((20, 0.9, 10, 1.0, 12, 1.0, 0, 0, 0, 0), 0),
    ((40, 0.8, 30, 0.9, 35, 0.8, 0, 0, 0, 0), 0),
    ((1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 1, 0), 0),
    ((30, 0.0, 70, 0.0, 0, 0.0, 0, 0, 1, 0), 0),
    ((12, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1, 0), 0),
    ((20, 0.2, 50, 0.0, 40, 0.0, 0, 1, 1, 0), 0),
    ((4, 0.0, 33, 0.0, 44, 0.0, 0, 1, 1, 0), 0),
    ((60, 0.0, 60, 0.0, 60, 0.0, 0, 0, 1, 0), 0),
    ((8, 0.0, 60, 0.0, 30, 0.0, 1, 1, 1, 0), 0),
    ((2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0), 0),
    ((9, 0.0, 1, 1.0, 10, 0.0, 0, 0, 0, 1), 0),
    ((25, 0.0, 25, 0.0, 25, 0.0, 0, 1, 0, 1), 0),
    ((2, 0.5, 20, 0.0, 30, 0.0, 0, 1, 0, 1), 0),
    ((50, 0.0, 3, 0.0, 60, 0.0, 0, 0, 0, 1), 0),
    ((40, 0.0, 1, 1.0, 10, 0.0, 0, 0, 0, 1), 0),
    ((70, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1), 0),
    ((6, 0.0, 60, 0.0, 5, 0.0, 1, 1, 0, 1), 0),
    ((3, 1.0, 40, 0.0, 38, 0.0, 0, 1, 0, 1), 0),
    ((8, 0.0, 1, 1.0, 8, 0.0, 0, 0, 1, 1), 0),
)


def _noise_name(name: str) -> bool:
    """A word of _STRONG, or one of _NOISE, alone or with _BEFORE and _AFTER; numbers do not count, other words do."""
    words = [w for w in re.split(r"[-_\d]+", name) if w]
    if not _STRONG.isdisjoint(words):
        return _NEGATED.isdisjoint(words)
    at = next((k for k, w in enumerate(words) if w in _NOISE), None)
    return at is not None and all(w in _BEFORE or w in _NOISE for w in words[:at]) and all(w in _AFTER or w in _NOISE for w in words[at:][1:])


def _noisy(tag: str, attributes: str) -> bool:
    return tag not in ("html", "body") and any(_noise_name(w) for m in _ATTRIBUTE.finditer(attributes) for w in m[2].lower().strip("\"'").split())


def _left_out(page: str) -> dict[int, int]:
    """Where each hidden element that has its end tag begins and ends; an end tag closes all that stands open inside its element."""
    out: dict[int, int] = {}
    if not _HAS_HIDDEN.search(page):
        return out
    open_: list[tuple[str, int]] = []
    count: dict[str, int] = {}  # of open elements by name, so that a stray end tag costs nothing
    for m in _TOKEN.finditer(page):
        tag = (m["tag"] or "").lower()
        if not tag or tag in _INLINE or tag in _VOID or tag in ("p", "li"):
            continue
        if not m["end"]:
            if not (m["rest"] or "").endswith("/"):
                open_.append((tag, m.start()))
                count[tag] = count.get(tag, 0) + 1
        elif count.get(tag):
            while True:
                name, start = open_.pop()
                count[name] -= 1
                if name == tag:
                    break
            if tag in _HIDDEN:
                out[start] = m.end()
    return out


def blocks(page: str | None) -> list[dict]:
    """The text blocks of a page in order, with their features."""
    out: list[dict] = []
    open_: list[tuple] = []  # container, how many of main, furniture, noise it stands in, forms and own headers before it
    state = (0, 0, 0)
    parts: list[str] = []
    linked: list[str] = []
    link = heading = 0
    forms: list[list] = []  # of each form: has it headings, paragraphs or an article, and words
    in_forms: list[list[int]] = []  # the forms that each block stands in
    inside: list[int] = []
    own_header = 0  # how many headers of an article it stands in

    def flush():
        nonlocal parts, linked, link
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            n = text.count(" ") + 1
            for f in inside:
                forms[f][1] += n
            in_forms.append(list(inside))
            furniture = state[1] > (own_header if heading else 0)  # the heading in an article's own header is the article's
            out.append({"text": text, "words": float(n), "link_density": min(1.0, len(entities.unescape("".join(linked)).split()) / n), "heading": float(heading), "in_main": float(state[0] > 0), "in_furniture": float(furniture), "in_noise": float(state[2] > 0)})
        parts, linked, link = [], [], 0

    left_out, shown_from = _left_out(page or ""), 0
    for m in _TOKEN.finditer(page or ""):
        if m.start() < shown_from:
            continue
        if (text := m["text"]) is not None:
            parts.append(text)
            if link:
                linked.append(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _HIDDEN and not m["end"]:  # closed at once or never: nothing to leave out
            shown_from = left_out.get(m.start(), 0)
            continue
        if tag in _INLINE:
            if tag == "a":
                link = 0 if m["end"] else 1
                if linked:
                    linked.append(" ")
            continue
        flush()
        heading = int(not m["end"] and re.fullmatch("h[1-6]", tag) is not None)
        if not m["end"] and (heading or tag == "p" or tag in _MAIN):
            for f in inside:
                forms[f][0] = True
        if tag in _VOID or tag in ("p", "li", "br") or heading:
            continue
        if m["end"]:
            at = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == tag), None)
            if at is not None:
                *state, form, header = open_[at][1:]
                state, own_header = tuple(state), header
                del inside[form:], open_[at:]
        elif not (m["rest"] or "").endswith("/"):
            open_.append((tag, *state, len(inside), own_header))
            main, furniture, noise = state
            noisy = _noisy(tag, m["rest"] or "")
            if tag == "form" and not noisy:
                inside.append(len(forms))
                forms.append([False, 0])
            own_header += tag == "header" and main > 0
            state = (main + (tag in _MAIN), furniture + (tag in _FURNITURE), noise + noisy)
    flush()
    # a form around most of a page's text, with headings or paragraphs, only wraps the page; any other is furniture
    total = sum(b["words"] for b in out)
    for b, at in zip(out, in_forms):
        if any(not forms[f][0] or 2 * forms[f][1] <= total for f in at):
            b["in_furniture"] = 1.0
    for k, b in enumerate(out):
        for name, j in (("prev", k - 1), ("next", k + 1)):
            there = 0 <= j < len(out)
            b[f"{name}_words"] = out[j]["words"] if there else 0.0
            b[f"{name}_link_density"] = out[j]["link_density"] if there else 0.0
    return out


def train(spark: SparkSession, labelled=LABELLED, depth: int = 8):
    """A Spark ML decision tree on labelled blocks."""
    rows = spark.createDataFrame([(Vectors.dense(x), float(y)) for x, y in labelled], ["features", "label"])
    return DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=1).fit(rows)


def paths(node, path=()) -> list:
    """Leaves of a fitted tree: ((feature, is at most, threshold), ...), prediction, impurity counts aside."""
    if node.getClass().getSimpleName() == "LeafNode":
        return [(path, node.prediction())]
    split = node.split()
    at = (split.featureIndex(), split.threshold())
    return paths(node.leftChild(), (*path, (at[0], True, at[1]))) + paths(node.rightChild(), (*path, (at[0], False, at[1])))


def keeps(model, block: Column) -> Column:
    """The tree as an expression over a block."""
    out = F.lit(False)
    for path, label in paths(model._java_obj.rootNode()):
        if label >= 0.5:
            leaf = F.lit(True)
            for feature, low, threshold in path:
                value = block[FEATURES[feature]]
                leaf = leaf & ((value <= threshold) if low else (value > threshold))
            out = out | leaf
    return out


def with_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``blocks``: an array of text and features."""
    bounded_batches(pages.sparkSession)
    fields = ("text", *FEATURES)
    kind = pa.list_(pa.struct([(f, pa.string() if f == "text" else pa.float64()) for f in fields]))

    @F.arrow_udf("array<struct<text:string," + ",".join(f"{f}:double" for f in FEATURES) + ">>")
    def run(pages_: pa.Array) -> pa.Array:
        return pa.array([blocks(x) for x in pages_.to_pylist()], kind)

    return pages.withColumn("blocks", run(F.col(html)))


def extract(pages: DataFrame, html: str = "html", to: str = "text") -> DataFrame:
    """Adds the main text; other columns stay, ``blocks`` and ``to`` are replaced."""
    model = train(pages.sparkSession)
    kept = F.filter("blocks", lambda b: keeps(model, b))
    return with_blocks(pages, html).withColumn(to, F.array_join(F.transform(kept, lambda b: b["text"]), "\n")).drop("blocks")


def report(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
