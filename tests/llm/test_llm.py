"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import base64
import hashlib
import io
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import public_tokenizers as P
from tidewater.llm import bpe, decontam, html_blocks, icws, licenses, ppm, quality, queries, syncmers, urls, warc
from tidewater.llm.common import held_out, load

SF = "/root/testdata/sf0.001"
RANKS = P.path(queries.RANKS)


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


# 1 licenses
def test_templates_accept_optional_and_replaceable_wording():
    m = licenses.Automaton()
    labels = lambda t: {m.templates[k].label for k, _, _ in m.matches(licenses.words_of(t))}
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache", "apache-2.0"}
    assert "apache-2.0" in labels("licensed under the terms of the APACHE license version 2.0")
    assert labels("licensed under the Apache Software License") == set()
    permission = "Permission is hereby granted, free of charge, to any person obtaining a copy of {} and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    assert labels(permission.format("this software")) == {"mit-text"}
    assert labels(permission.format("this software of ours")) == {"mit-text"}
    assert labels(permission.format("")) == set()
    with pytest.raises(ValueError):
        licenses.parse("a<<beginOptional>>b")


def test_only_whole_license_texts_score_highest():
    import re

    m = licenses.Automaton()
    score = lambda t: max((m.templates[k].score for k, _, _ in m.matches(licenses.words_of(t))), default=0)
    for name in ("text-mit", "text-bsd"):
        markup = next(t.markup for t in m.templates if t.name == name)
        whole = re.sub("<<var[^>]*>>", "the copyright holders", re.sub("<<(begin|end)Optional>>", " ", markup))
        assert score(whole) == score(whole.upper() + " more") == 1.0
        words = whole.split()
        assert all(0 < score(" ".join(words[:k])) < 1 for k in range(60, len(words)))
        assert 0 < score(whole.replace("AS IS", "AS IS for research only", 1)) < 1
        assert score(whole.replace("MERCHANTABILITY", "")) < 1


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))


def test_license_odd_rows(odd):
    got = licenses.scan(odd).collect()
    assert len(got) == 10 and all(r.matches == [] for r in got) and got[0].score is None


# 2 language
def test_ppm_code_lengths_are_those_of_a_plain_coder(spark):
    docs = load(spark, SF, "documents")
    model = ppm.train(docs)
    trees = {x: [{} for _ in range(4)] for x in model.langs}  # by order: context -> byte -> count
    for r in ppm.sample(docs, 400, 100_000).collect():
        b = b"\0\0\0" + (r.text or "").encode()
        for i in range(3, len(b)):
            for order in range(4):
                of = trees[r.lang][order].setdefault(b[i - order : i], {})
                of[b[i]] = of.get(b[i], 0) + 1

    def cost(tree, b, i):
        bits, out = 0.0, set()
        for order in (3, 2, 1, 0):
            left = {x: n for x, n in tree[order].get(b[i - order : i], {}).items() if x not in out}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if b[i] in left:
                return bits + math.log2(total / left[b[i]])
            bits += math.log2(total / len(left))
            out |= set(left)
        return bits + math.log2(max(1, 256 - len(tree[0].get(b"", {}))))

    texts = [r.text for r in docs.where(held_out(F.col("doc_id")) & (F.length("text") < 700)).collect()][:14] + ["zq\u4e2d\0\0 xyz", "a", "naïve Übermaß ¿qué?"]
    got = model.bits(texts)
    for k, t in enumerate(texts):
        b = b"\0\0\0" + t.encode()
        for j, lang in enumerate(model.langs):
            assert abs(sum(cost(trees[lang], b, i) for i in range(3, len(b))) - got[k, j]) < 1e-4 * len(b) + 1e-3


def test_ppm_held_out_accuracy_and_code(spark):
    docs = load(spark, SF, "documents")
    model = ppm.train(docs)
    got = ppm.identify(docs, model).where(held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    # code lengths are a probability: over all next bytes of a context they sum to 1 at most
    tree = model.trees[0]
    codes = (np.uint32(tree.keys[3][5]) & np.uint32(0xFFFFFF00)) | np.arange(256, dtype=np.uint32)
    assert abs(np.exp2(-tree.bits(codes)).sum() - 1) < 1e-6
    memo = model.bits(["abc", "word " * 400_000])
    assert np.allclose(memo[0], [t.bits(ppm._codes(b"\0\0\0abc")).sum() for t in model.trees], rtol=1e-4)


def test_ppm_odd_rows(spark, odd):
    model = ppm.train(load(spark, SF, "documents"))
    got = ppm.identify(odd, model).collect()
    assert [r.lang_pred for r in got[:4]] == ["und"] * 4
    assert got[4].lang_pred == got[5].lang_pred == "en" and ppm.keep_known(odd, model).columns == odd.columns
    none = ppm.train(odd.where("false"))
    assert {r.lang_pred for r in ppm.identify(odd, none).collect()} == {"und"}


# 3 urls
def test_url_rules(spark):
    rows = [
        ("https://WWW.a.Example.NET/en/1?x#y", "example.net/en/", "allow"), ("http://b.net/de", "net/", "block"), ("http://net/x", "net/", "block"),
        ("http://xnet/x", None, None), ("http://b.net", None, None), ("http://example.com/de/x", "example.com/de/", "block"),
        ("http://a.org/fr/", "org/fr/", "allow"), ("no scheme", None, "allow"), (None, None, "allow"), ("http://h?q=/x", None, None),
    ]
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(rows)], "page_id long, url string")
    got = sorted(urls.report(pages).collect())
    for r, (_, rule, verdict) in zip(got, rows):
        assert r.rule == rule and verdict in (None, r.verdict)
    assert got[0].host == "www.a.example.net" and got[0].path == "/en/1" and got[8].host == got[8].path == ""
    assert urls.report(pages.where("false")).count() == 0


def test_mined_rules_match_brute_force(spark):
    random.seed(3)
    names = ["casino-win", "spam-farm", "news", "shop", "blog"]
    pages = spark.createDataFrame(
        [(i, f"http://{random.choice(names)}.example.{random.choice(['net', 'com', 'org'])}/{random.choice(['en', 'de', 'fr'])}/{i}") for i in range(400)], "page_id long, url string"
    )
    tokens = urls.with_tokens(pages)
    rule, verdict = urls.listed(urls.host_of(F.col("url")), urls.path_of(F.col("url")))
    rows = tokens.select("tokens", verdict.alias("verdict")).collect()
    mined = urls.mine(tokens.select("tokens", verdict.alias("verdict")))
    assert mined
    for r in mined:
        have = [x for x in rows if set(r.tokens) <= set(x.tokens)]
        hit = [x for x in have if x.verdict == r.verdict]
        assert abs(len(hit) / len(have) - r.confidence) < 1e-9 and r.confidence >= 0.6 and len(hit) / len(rows) >= 0.005
    index = urls.Index(mined)
    joined = {r.page_id: r.mined and r.mined.tokens for r in urls.by_rules(tokens, mined, max_rules=0).collect()}
    for x in tokens.collect():
        want = next((r for r in mined if set(r.tokens) <= set(x.tokens)), None)
        assert index.match(x.tokens) == want
        assert joined[x.page_id] == (want and " ".join(want.tokens))


def test_deep_shared_paths_are_one_item(spark):
    deep = "/".join(f"seg{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    rows = [f"http://h{k % 3}.net/{deep}/x{k}" for k in range(200)] + [f"http://h.example.com/{deep}/tail/y" for _ in range(40)] + [f"http://o.org/{k}" for k in range(100)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    tokens = urls.with_tokens(pages).cache()
    known = dict(urls.together(tokens.select("tokens"), 0.005).collect())
    segs = {known[t] for t in known if t.startswith("path:seg")}
    assert len(segs) == 1 and known["path:tail"] in ("host:example", "host:com", "path:tail", "host:h")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    joined = {r.page_id: r for r in urls.judge(pages, max_rules=0).collect()}
    for k in range(len(rows)):
        a, b = got[k], joined[k]
        assert (a.verdict, a.confidence, a.mined_tokens) == (b.verdict, b.confidence, b.mined_tokens)
        assert a.verdict == ("block" if k < 200 else a.verdict)


def test_no_mined_rule_overrules_a_seed_word(spark):
    rows = [f"http://a{k % 5}.org/fr/{k}" for k in range(300)] + ["http://casino.example.se/fr/x", "http://casino.example.se/xx/x", "http://shop.example.se/fr/x"]
    got = {r.url: r for r in urls.judge(spark.createDataFrame([(u, "old", 1) for u in rows], "url string, verdict string, n int")).collect()}
    assert got["http://casino.example.se/fr/x"].verdict == got["http://casino.example.se/xx/x"].verdict == "block"
    assert got["http://casino.example.se/fr/x"].mined_tokens is None and got["http://shop.example.se/fr/x"].verdict == "allow"
    assert {r.n for r in got.values()} == {1}


def test_seed_words_in_any_host_label(spark):
    plain = [f"http://h{k % 7}.example.com/en/{k}" for k in range(1000)]  # each seeded page is under min_support
    seeded = ["http://casino.example.com/a", "http://ads.example.org/b", "http://casino24-win.example.com/c", "https://x.casino24.org:80/d", "http://SPAM7.com"]
    other = ["http://broadside.example.com/ads", "http://adsorption.com/", "http://a.com/?casino=1"]
    urls_ = plain + seeded + other
    got = {r.page_id: r for r in urls.report(spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")).collect()}
    for k, u in enumerate(urls_):
        assert got[k].verdict == ("block" if u in seeded else "allow"), u
    assert got[1000].confidence == 1.0 and got[0].confidence == 0.0


# 4 bpe
def test_bpe_is_tiktoken(spark):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello  world!!\n\n it's 123", "naïve café ’s 你好  x \x1c\x1d y", "a" * 3000, "<|endoftext|>", "\x00\x7f", "😀" * 50, " " * 40 + "z"]
    texts += [r.text for r in load(spark, SF, "documents").collect()]
    texts += ["tab\t\tx  \r\n", "'s's 't 'LL it'll", "12a3 _ ", "a\x1c\x1d b", " " * 50 + "a\n"]  # of ASCII alone
    df = bpe.decode(bpe.encode(docs_of(spark, texts), RANKS, P.PATTERN), RANKS)
    for r in df.collect():
        t = texts[r.doc_id] or ""
        assert r.ids == enc.encode_ordinary(t) and bytes(r.decoded) == t.encode()


def test_bpe_memo_changes_no_id(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    entries = bpe.read_ranks(RANKS)
    small, large = bpe.Codec(entries, P.PATTERN), bpe.Codec(entries, P.PATTERN)
    monkeypatch.setattr(bpe, "KEPT", 4)
    texts = ["one two three four", "two qwertyz two, four qwertyz", "five six", "one two qwertyz"] * 3
    monkeypatch.setattr(bpe, "MEMO", 3)
    got = [small.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "MEMO", 10**6)
    assert got == [large.encode(t) for t in texts] and len(small) <= 7
    assert bpe.ascii_form(r"\p{Han}+") is None and bpe.ascii_form(r"[^\p{L}]|\p{N}")("a1-b") == ["1", "-"]


def test_perfect_hash_is_minimal_and_exact():
    keys = [str(i).encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert [h.find(k) for k in keys] == list(range(5000)) and None not in h.keys and [h.find(k) for k in (b"x", b"5000")] == [-1, -1]


# 5 near-duplicates
def brute_classes(spark, df):
    rows = df.collect()
    idf = icws.idf_table(df)
    h, tf, at, size, node, n = icws.shingle_sets([r.text or "" for r in rows])
    w = icws.weights(h, tf, idf)
    up = list(range(len(rows)))
    find = lambda x: x if up[x] == x else find(up[x])
    s = [slice(a, a + k) for a, k in zip(at, size)]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i].text and rows[j].text and ((size[i] and size[j] and icws.weighted_jaccard(h[s[i]], w[s[i]], h[s[j]], w[s[j]]) >= 0.8) or rows[i].text == rows[j].text):
                up[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r.doc_id)
    return {d: min(g) for g in groups.values() for d in g}


def test_icws_matches_brute_force(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for k in range(12):
        base = random.choices(words, k=120)
        for _ in range(8):
            x = list(base)
            for _ in range(random.randint(0, 6)):
                x[random.randrange(len(x))] = random.choice(words)
            texts.append(" ".join(x))
    texts += [" ".join(["shared line that all of these texts hold"] * 3 + random.choices(words, k=6)) for _ in range(40)]
    df = docs_of(spark, texts)
    got = {r.doc_id: r.class_id for r in icws.classes(df).collect()}
    assert got == brute_classes(spark, df)


def test_icws_odd_rows(spark, odd):
    got = sorted(((r.doc_id, r.class_id) for r in icws.classes(odd).collect()), key=str)
    assert sorted(x for x in got if x[0] in (4, 5)) == [(4, 4), (4, 4), (5, 4)] and len(got) == 10
    kept = icws.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7]
    assert icws.classes(odd.where("false")).count() == 0


def test_icws_tells_rows_apart_by_id_and_text(spark):
    words = lambda p, n: " ".join(f"{p}{i}" for i in range(n))
    a, b, c = words("a", 60), words("b", 60), words("c", 60)
    rows = [(1, a, 1), (1, b, 2), (2, c, 3), (2, c, 3), (3, a + " more", 4), (None, b + " more", 5), (None, words("d", 60), 6), (None, words("d", 60) + " more", 7), (None, None, 8), (4, None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = sorted(((r.doc_id, r.class_id, r.n_texts) for r in icws.classes(df).collect()), key=str)
    assert got == sorted([(1, 1, 2), (1, 1, 2), (2, 2, 1), (2, 2, 1), (3, 1, 2), (None, 1, 2), (None, None, 2), (None, None, 2), (None, None, 1), (4, 4, 1)], key=str)
    kept = icws.keep_one(df)
    assert kept.columns == df.columns and sorted(r.n for r in kept.collect()) in ([1, 2, 3, 6, 8, 9], [1, 2, 3, 7, 8, 9])


# 6 decontamination
def test_leaks_match_brute_force(spark):
    random.seed(7)
    items = load(spark, SF, "benchmark")
    rows = []
    for k, r in enumerate(items.collect()):
        w = r.text.split()
        if k % 4 == 1:
            w = w[1:]
        if k % 4 == 2:
            w[len(w) // 2] = "zq"
        if k % 4 == 3:
            w = w[: len(w) // 3]
        rows.append(" ".join(["before"] * 9 + w + ["after"] * 9))
    docs = docs_of(spark, rows)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.report(docs, items).collect()}
    for k, r in enumerate(sorted(items.collect())):
        if k % 4 in (0, 1):
            assert got.get((k, r.item_id), 0) >= 0.8
        if k % 4 == 3:
            assert (k, r.item_id) not in got
    assert decontam.report(docs_of(spark, ["quite another text of no item at all"] * 3), items).count() == 0


def test_no_edited_leak_is_lost(spark):
    random.seed(5)
    shared = [f"x{k}" for k in range(20)]  # boilerplate of half the items: it weighs little, so much of it may go
    texts = [[f"w{random.randrange(900)}" for _ in range(random.randint(15, 59))] + shared * (k % 2) for k in range(40)]
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    df = Counter(g for t in texts for g in grams(t))
    weigh = lambda c: {g: n * (1 + math.log(len(texts) / df.get(g, 1))) for g, n in c.items()}
    rows, want = [], {}
    for k, t in enumerate(texts):
        for _ in range(12):
            w, at, cut = list(t), random.randrange(len(t)), random.randint(1, max(1, len(t) // 8))
            if random.random() < 0.5:
                at, cut = (len(t) - cut, cut) if k % 2 == 0 else (len(t) - 2 * cut, 2 * cut)  # the tail
            w[at : at + cut] = [f"z{random.randrange(10**9)}" for _ in w[at : at + cut]]
            a, b = weigh(grams(w)), weigh(grams(t))
            common = sum(min(v, b.get(g, 0)) for g, v in a.items())
            if (likeness := common / (sum(a.values()) + sum(b.values()) - common)) >= 0.8:
                want[len(rows), k] = likeness
            rows.append(" ".join(["before"] * 9 + w + ["after"] * 9))
    items = docs_of(spark, [" ".join(t) for t in texts]).withColumnRenamed("doc_id", "item_id")
    found = decontam.report(docs_of(spark, rows), items).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    lost = [p for p, x in want.items() if got.get(p, 0) < x - 1e-9]
    assert len(want) > 150 and not lost, (len(lost), len(want))
    # the fingerprints' radius alone finds them, and no pair is reported whose window is not that similar
    assert sum(r.distance <= decontam.RADIUS for r in found) >= 0.99 * len(found)
    for r in found:
        a, b = weigh(grams(rows[r.doc_id].split()[r.start : r.start + r.n_words])), weigh(grams(texts[r.item_id]))
        common = sum(min(v, b.get(g, 0)) for g, v in a.items())
        assert abs(common / (sum(a.values()) + sum(b.values()) - common) - r.similarity) < 1e-6 and r.similarity >= 0.8 - 1e-9


def test_blocks_meet_within_the_radius(spark):
    random.seed(11)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for k in range(300):
        a, flips = random.getrandbits(64), random.sample(range(64), decontam.RADIUS if k % 2 else random.randint(0, decontam.RADIUS))
        rows.append((k, signed(a), signed(a ^ sum(1 << b for b in flips))))
    df = spark.createDataFrame(rows, "k int, a long, b long")
    left = df.select("k", F.inline(decontam.blocks(F.col("a"), decontam.PROBE)))
    right = df.select("k", F.inline(decontam.blocks(F.col("b"))))
    assert left.join(right, ["k", "block", "value"]).select("k").distinct().count() == len(rows)
    assert df.select(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("d")).agg(F.max("d")).first()[0] == decontam.RADIUS


def test_leaks_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "the cat sat on the mat and the dog"), (2, None), (None, ""), (3, "a b")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.report(odd, items).collect()}
    assert got == {(4, 1), (5, 1), (7, 3)}
    assert all(r.distance is not None for r in decontam.leaks(odd, items).collect())
    clean = decontam.keep_clean(odd, items)
    assert clean.columns == odd.columns and clean.count() == 6
    assert decontam.report(odd, items.where("false")).count() == 0


# 7 warc
def test_warc_round_trip(spark):
    big = "<p>" + "x" * 200 + "</p>"
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (9, "u", big), (1, "u", "small"), (2, "u", "small"), (7, "u", None), (None, "u", big), (8, "u", "é" * 60), (11, "u", "z" * 5_000_000)]
    got = {r.page_id: r for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert {k: (r.record_type, r.refers_to) for k, r in got.items() if r.record_type == "revisit"} == {5: ("revisit", 3), 9: ("revisit", 3), None: ("revisit", 3)}
    for p, _, h in rows:
        b = (h or "").encode()
        assert got[p].payload_bytes == len(b) and got[p].payload_digest == hashlib.sha256(b).hexdigest()
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_dictionary_and_faults():
    samples = [f"<html><body><p>page {i} {'text ' * (i % 7)}</p></body></html>".encode() * 4 for i in range(400)]
    trained = warc.dictionary(samples)
    assert trained
    out = io.BytesIO()
    w = warc.Writer(out, trained)
    records = [warc.record("response", i, "u", s, hashlib.sha256(s).hexdigest(), None) for i, s in enumerate(samples)]
    for r in records:
        w.add(r)
    assert list(warc.frames(io.BytesIO(out.getvalue()))) == records
    assert warc.parse(records[0])["problem"] is None
    assert warc.parse(records[0][:-5])["problem"] and warc.parse(b"HTTP/1.1")["problem"] and warc.parse(records[0].replace(b"page 0", b"page 1", 1))["problem"]
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(out.getvalue()[:-3])))


# 8 html
def test_html_blocks(spark):
    pages = [
        "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav><div class='ad'>Buy this now please do</div>"
        "<article><h1>A &amp; B</h1><p><b>One  two\n three.<br><p>1 &lt; 2 &copy;</p><ul><li>item</li></ul><div class='comments'><p>nice post, thank you very much</p></div></article>"
        "<aside>other things to read here</aside><footer>&copy; all rights reserved by us</footer></body></html>",
        None, "", "<article>open < text <p>and \"quoted</article>", "<p>" + "long text " * 40_000 + "</p>",
    ]
    got = {i: t for i, t in enumerate(r.text for r in html_blocks.extract(spark.createDataFrame([(i, p, "clash") for i, p in enumerate(pages)], "page_id long, html string, text string")).orderBy("page_id").collect())}
    assert got[0] == "A & B\nOne two three.\n1 < 2 ©\nitem"
    assert got[1] == got[2] == "" and got[3] == 'open < text\nand "quoted' and len(got[4]) == 399_999


def test_html_neighbours_decide_and_wrappers_do_not(spark):
    model = html_blocks.train(spark)
    weight = dict(zip(html_blocks.FEATURES, model.featureImportances.toArray()))
    assert weight["prev_link_density"] > 0 and weight["next_link_density"] > 0 and weight["prev_words"] + weight["next_words"] > 0
    assert all(model.predict(Vectors.dense(x)) == y for x, y in html_blocks.LABELLED)
    long = "word " * 40
    nav = "<nav><a href=1>Home</a><a href=2>Away</a></nav>"
    pages = {
        # readers' comments, adverts, notices and lists of links in an article
        f"<article><p>{long}</p><div class='comment-thread'><p>I am a reader.</p></div><div id='reader-comments'><p>me too I say</p></div>"
        "<div class='ad-300x250'><p>Buy now this thing</p></div><div class='adsbygoogle'>x</div><div class='gdpr-notice'><p>We use things</p></div>"
        "<div class='cookie-law-info'><p>cookies here</p></div><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></article>": long.strip(),
        # short paragraphs, with and without an article
        "<body><h2>Title</h2><p>Yes it is.</p><p>No.</p><p>Maybe so then.</p></body>": "Title\nYes it is.\nNo.\nMaybe so then.",
        f"<body><p>{long}</p><p>Yes.</p><p>{long}</p></body>": f"{long.strip()}\nYes.\n{long.strip()}",
        # a link between texts stays
        f"<body><p>{long}</p><p><a href=1>See there</a></p><p>{long}</p></body>": f"{long.strip()}\nSee there\n{long.strip()}",
        # a form around the page wraps it, another is furniture
        f"<body><form id=aspnetForm>{nav}<h1>Story</h1><p>{long}</p><p>End of it.</p></form></body>": f"Story\n{long.strip()}\nEnd of it.",
        f"<body><form action=s><label>Search this site</label></form><h1>Story</h1><p>{long}</p></body>": f"Story\n{long.strip()}",
        # the page's header goes, the heading in the article's own stays
        f"<body><header><h1>Site</h1></header><article><header><h1>My story</h1><p>by me</p></header><p>{long}</p></article></body>": f"My story\n{long.strip()}",
        f"<body class='page no-sidebar has-comments'><div class='post-with-comments'><p>{long}</p></div><div class='commentary'><p>fine text</p></div></body>": f"{long.strip()}\nfine text",
    }
    rows = list(enumerate(pages))
    got = {r.page_id: r.text for r in html_blocks.extract(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    for k, page in rows:
        assert got[k] == pages[page], page


def test_html_blocks_lose_no_main_text(spark):
    body = "<article><p>first words here</p>{}<p>last words here</p></article>"
    bare = ["<svg class=i/>", "<svg/>", "<button>", "<title-bar>", "<title-bar></title-bar>", "<select-menu>", "<select>", "<svg><title/></svg>", "<svg><title>hidden</title><svg/><path d='x'/></svg>",
            "<button>hidden</button>", "<noscript><div>hidden</noscript>", "<script>hidden</script >", "<style>hidden</style x>", "<object><object>hidden</object></object>"]
    pages = [body.format(x) for x in bare]
    n = len(pages)
    pages.append("<article><p>first words here</p><button><p>open one</p><button>hidden</button><p>last words here</p></article>")
    pages.append(body.format("<figure><img src=x><figcaption>the caption</figcaption></figure>"))
    main = body.format("")
    pages += [f"<html class='ads'><body class='{c}'>{main}</body></html>" for c in ("page no-sidebar", "has-sidebar", "sidebar")]
    pages += [f"<div class='{c}'>{main}</div>" for c in ("no-sidebar", "with-comments", "layout-with-sidebar")]
    pages += [f"<div {c}>{main}</div>" for c in ("class='x sidebar'", "id=sidebar-2", "class=site-footer", "class='ad-box_1'", "role=search")]
    got = [r.text for r in html_blocks.extract(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")).orderBy("page_id").collect()]
    both = "first words here\nlast words here"
    assert got[:n] == [both] * n
    assert got[n] == "first words here\nopen one\nlast words here" and got[n + 1] == "first words here\nthe caption\nlast words here"
    assert got[n + 2 : n + 8] == [both] * 6 and got[n + 8 :] == [""] * 5
    assert len(html_blocks.blocks("<button><div>" * 50_000 + "</p>" * 50_000 + "end")) == 1


# 9 syncmers
def brute_anchors(text):
    from tidewater.llm.syncmers import K, S, _runs

    x = np.array([ord(c) for c in text], np.uint64)
    inner, outer = _runs(x, S), _runs(x, K)
    span = K - S + 1
    out = [i for i in range(len(x) - K + 1) if min(inner[i : i + span]) in (inner[i], inner[i + span - 1])]
    return (outer[out] >> np.uint64(32)).astype(np.uint32)


def test_syncmers(spark):
    random.seed(2)
    text = "".join(random.choices("abcdefgh ", k=2000))
    assert (syncmers.anchors(text) == brute_anchors(text)).all()
    moved = syncmers.anchors("".join(random.choices("qrstuv", k=100)) + text)
    assert set(syncmers.anchors(text).tolist()) <= set(moved.tolist())
    assert syncmers.likeness(syncmers.anchors(text), moved) > 0.9
    texts = [text, "", None, text, "short", "é" * 90, text[::-1], *["".join(random.choices("klmnop ", k=random.randint(1, 400))) for _ in range(60)]]
    rows = {r.doc_id: r for r in syncmers.report(docs_of(spark, texts)).collect()}
    order = sorted(rows, reverse=True)
    assert len(order) == len(texts)
    for i, d in enumerate(order):
        own, after = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        k = len(own) // 3
        edited = own[: len(own) - k] + after[:k]
        assert rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[d].n_chars == len(own)
        assert rows[d].near_next == syncmers.likeness(syncmers.anchors(own), syncmers.anchors(after))
    assert rows[0].fingerprint == rows[3].fingerprint
    assert syncmers.report(docs_of(spark, texts).where("false")).count() == 0


@pytest.mark.parametrize("following", ["", "Z", "QRSTUVWXYZ" * 20])
def test_short_edited_texts_stay_near(following):
    random.seed(11)
    for n in range(3, 121):
        for _ in range(20):
            text = "".join(random.choices("abcdefghijklmnop ", k=n))
            own, new = syncmers.anchors(text), syncmers.anchors(syncmers.edited_text(text, following))
            assert len(own) > 1 and 0 < syncmers.likeness(own, new) < 1, (n, text)
            assert syncmers.likeness(own, syncmers.anchors("QRSTUVWXYZ" * 12)) == 0


def test_syncmers_odd_rows(odd):
    assert syncmers.report(odd).count() == 10


# 10 quality
def test_quality_held_out(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    got = {r.doc_id: r for r in quality.report(docs, labels).collect()}
    held = [x for x in labels.collect() if got[x.doc_id].held_out]
    assert sum(got[x.doc_id].predicted == x.quality for x in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_quality_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.report(odd, none).collect()
    assert len(got) == 10 and {r.score for r in got} == {0.5}
    assert quality.keep_good(odd, none).columns == odd.columns


def test_quality_model_repeats(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    one, two = (quality.train(docs.repartition(3), labels) for _ in range(2))
    assert one.weights and (one.intercept, one.weights) == (two.intercept, two.weights)


# pipeline
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = load(spark, SF, "documents")
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "encode":
            assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < out.count() <= seen
        docs, seen = out, out.count()


def leaked(texts, items):
    """Places of the texts that hold an item's window, over all windows of the item's length, by brute force."""
    import regex

    split = lambda t: [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", (t or "").lower()) if w]
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
    sets = [(w, Counter(grams(w))) for w in map(split, items) if w]
    df = Counter(g for _, c in sets for g in c)
    weigh = lambda c: {g: n * (1 + math.log(len(sets) / df.get(g, 1))) for g, n in c.items()}
    weighed = [(len(w), weigh(c)) for w, c in sets]
    out = set()
    for k, words in enumerate(map(split, texts)):
        for n, want in weighed:
            size = min(n, 5)
            at = [i for i in range(len(words) - size + 1) if tuple(words[i : i + size]) in want]
            for start in sorted({max(0, i - j) for i in at for j in range(n - size + 1)}):
                got = weigh(Counter(grams(words[start : start + n])))
                common = sum(min(v, want.get(g, 0)) for g, v in got.items())
                if common / (sum(got.values()) + sum(want.values()) - common) >= 0.8 - 1e-9:
                    out.add(k)
                    break
    return out


def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline
    import tiktoken

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "quality", "near_dedup", "decontaminate", "encode"]
    docs = load(spark, SF, "documents")

    def run(name, docs):
        out = stages[name](spark, docs, SF)
        rows = out.collect()
        return spark.createDataFrame(rows, out.schema), rows

    seen = docs.collect()
    model = ppm.train(docs)
    judged = ppm.judge(model, [r.text for r in seen]).to_pylist()
    docs, rows = run("language", docs)
    assert sorted(rows) == sorted(r for r, x in zip(seen, judged) if x["lang_pred"] != "und" and x["bits_per_byte"] < 8)

    # every rule's condition and weight, row by row
    model = quality.train(docs, load(spark, SF, "labels"))
    stats = {r.doc_id: r.stats for r in quality.with_statistics(docs).collect()}
    seen, good = rows, []
    for r in seen:
        held = [w for rule, w in model.weights if all((stats[r.doc_id][n] <= at) if low else (stats[r.doc_id][n] > at) for n, low, at in rule)]
        if 1 / (1 + math.exp(-(model.intercept + sum(held)))) >= 0.7:
            good.append(r)
    docs, rows = run("quality", docs)
    assert sorted(rows) == sorted(good) and 0 < len(good) < len(seen)

    classes = brute_classes(spark, docs)
    seen = rows
    docs, rows = run("near_dedup", docs)
    assert sorted(r.doc_id for r in rows) == sorted(set(classes.values())) and set(rows) <= set(seen) and len(rows) < len(seen)

    bad = leaked([r.text for r in rows], [r.text for r in load(spark, SF, "benchmark").collect()])
    seen = rows
    docs, rows = run("decontaminate", docs)
    assert sorted(rows) == sorted(r for k, r in enumerate(seen) if k not in bad) and bad

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((r.doc_id, len(i := enc.encode_ordinary(r.text)), digest(" ".join(map(str, i)).encode()), digest(r.text.encode())) for r in rows)
    assert sorted(map(tuple, run("encode", docs)[1])) == want
