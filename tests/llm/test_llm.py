"""The training-data operators against brute force, public libraries and edge cases."""

import hashlib
import json
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import bpe, components, html, langid, lines, minhash, mixing, pii, queries, quality, rules, spotsigs, textops

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (3, "one", "fr", "a", 3), (4, "one", "fr", "a", 3),
    (4, "one", "fr", "a", 3), (None, "no id here", "en", "a", 10), (5, "x" * 70_000, "de", "b", 70_000),
    (6, "word " * 20_000, "en", None, 100_000), (7, "\n\n\n", None, "b", 3), (8, "日本 語　テキスト", "ja", "c", 8),
    (9, "!!! ... ???", "en", "c", 11), (10, "a\nb\nc\na\nb\nc", "en", "c", 11)]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = spark.createDataFrame(EDGE, DOC)
    for name in ("score", "size", "rank", "label", "n", "row", "component", "node", "key", "held_out", "kept"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


# Text kernels


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_words_and_hashes():
    b = textops.as_bytes("  ab c\tab\nñandú  ".encode())
    start, end = textops.word_bounds(b)
    assert [bytes(b[i:j]).decode() for i, j in zip(start, end)] == ["ab", "c", "ab", "ñandú"]
    h = textops.word_hashes(b)
    assert h[0] == h[2] and len(set(h.tolist())) == 3
    assert len(textops.chain(h, 5)) == 0 and len(textops.chain(h, 4)) == 1


# 1 HTML


def test_html_main_text(spark):
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.extract(pages, html.fit(pages)).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.references.unescape(re.sub(r"<[^>]*>?", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]] == "\n".join(x for x in blocks if x)


def test_html_declared_parts(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()]
    model = html.fit_pages(pages)
    story = "".join(f"<p>The {k} harbour of the old town was, as ever, full of boats, and of people who sold fish.</p>" for k in range(6))
    page = ("<html><body><header><h2>My site</h2></header><nav><a href=/>Home</a></nav><div class='cookie-notice'><p>We use cookies, "
            f"as you may know, to serve you.</p></div><main><h1>Boats</h1>{story}</main><aside><p>Read this, and that, too.</p></aside>"
            "<div id=comments><p>What a nice text, I say, thank you for it.</p></div><form><p>Name, please.</p></form></body></html>")
    nodes = html.parse(page)
    text = html.main_text(nodes, html.decode(nodes, model.log_odds(html.features(nodes))))
    assert text.startswith("Boats\nThe 0 harbour") and text.count("\n") == 6


def test_html_fit_reads_every_sampled_page(monkeypatch):
    """A long page that sorts first leaves the nodes of the others in the fit."""
    long = "<body><article>" + "<p>some words of an article, more of them.</p>" * 7000 + "</article></body>"
    short = "<html><body><nav><a href='x'>home</a></nav><article><p>a</p><blockquote>quoted text.</blockquote></article></body></html>"
    seen = []
    monkeypatch.setattr(html, "boost", lambda x, y: seen.append(x))
    html.fit_pages([long, short])
    want = html.features(html.parse(short))
    assert all((seen[0] == row).all(axis=1).any() for row in want)


@pytest.mark.parametrize("start", [
    "<html><head><title>t</title>", "<head><meta charset=utf-8><link href=x>", "<head><head><script>s</script>",
    "<head><noscript><img src=x></noscript>", "<head><template><p>no</p></template>", "<head></head><body>"])
@pytest.mark.parametrize("body", ["<p>text <b>here</b></p>", "<article><p>text here</p></article>", "text here", "<b>text</b> here"])
def test_html_head_without_end(start, body):
    """A page may omit </head> and <body>: its text stays, and the head's own doesn't count."""
    nodes = html.parse(start + "\n" + body)
    assert html.main_text(nodes, [True] * len(nodes)) == "text here"


def test_html_decoding_is_the_best_consistent_labelling():
    rng = random.Random(5)
    for _ in range(50):
        n = rng.randrange(1, 9)
        nodes = [html.Node("div", -1)]
        for k in range(1, n):
            p = rng.randrange(k)
            nodes.append(html.Node("div", p))
            nodes[p].children.append(k)
        odds = np.array([rng.uniform(-2, 2) for _ in range(n)])

        def value(c):
            return sum(o if x else -o for o, x in zip(odds, c))
        allowed = [c for c in ([bool(m >> k & 1) for k in range(n)] for m in range(1 << n))
                   if all(not c[k] or c[nodes[k].parent] for k in range(1, n))]
        assert value(html.decode(nodes, odds)) == pytest.approx(max(map(value, allowed)))


def test_html_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", "<p>x"), (None, "u", "<script>if (a<b) {}"), (3, "u", "<p " * 500), (4, "u", "plain"),
            (5, "u", "<div>" * 2000 + "x"), (6, "u", "<p>&lt;b&gt; &amp;amp; &#233;&nbsp;&unknown;</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = html.extract(frame, html.fit(frame)).collect()
    assert len(out) == len(rows) and all(r["text"] is not None for r in out)
    nothing = frame.where("false")
    assert html.extract(nothing, html.fit(nothing)).count() == 0


# 2 quality


def test_quality_held_out(spark, docs):
    big = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    out = quality.score(documents, quality.fit(documents, labels)).join(labels, "doc_id").toPandas()
    assert all(out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id])
    test = out[out.held_out]
    assert (test.predicted == test.quality).mean() > 0.9
    assert ((out.score >= 0.7) == (out.predicted == 1)).all() and out.score.between(0, 1).all()


def test_dual_coordinate_descent_finds_the_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 5))
    y = np.sign(x[:, 0] + 0.3 * rng.normal(size=40))
    rows = [np.arange(5, dtype=np.int32)] * 40
    w, b = quality.dual_coordinate_descent(rows, list(x.astype(np.float32)), y, np.full(40, 1.0), epochs=2000, tol=1e-6)

    def loss(v, c):
        return 0.5 * (v @ v + c * c) + np.maximum(0, 1 - y * (x @ v + c)).sum()
    best = loss(w[:5].astype(float), b)
    for _ in range(300):
        assert loss(w[:5] + 0.05 * rng.normal(size=5), b + 0.05 * rng.normal()) >= best - 1e-3


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 1, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.where("false")):
        model = quality.fit(edge, some)
        out = quality.score(edge, model).collect()
        assert len(out) == len(EDGE) and all(0 <= r["score"] <= 1 for r in out)
        assert quality.score(empty, model).count() == 0
        assert quality.filter_predicted(edge, model).columns == edge.columns


# 3 BPE


def test_bpe_equals_tiktoken(spark):
    import tiktoken
    path = public_tokenizers.path(queries.TOKENIZER)
    tokens = bpe.read_ranks(path)
    codec = bpe.Codec(bpe.serialise(tokens), tokens, public_tokenizers.PATTERN)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(1)
    pool = [chr(c) for c in (*range(0, 0x250), *range(0x3040, 0x30ff), *range(0x1f600, 0x1f640), 0x2028, 0x3000, 0xfeff)]
    samples = ["", " ", "a" * 3000, "<|endoftext|>", "I'll don't we'VE", "\0\x01\x1c\x1d \x85\xa0", "x  \n\n y ", *tokens_as_text(tokens, rng)]
    samples += ["".join(rng.choice(pool) for _ in range(rng.randrange(80))) for _ in range(800)]
    for text, ids in zip(samples, codec.encode(samples)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == other.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def tokens_as_text(tokens, rng):
    return [t.decode() for t in rng.sample(tokens, 2000) if _is_text(t)]


def _is_text(t):
    try:
        t.decode()
    except UnicodeDecodeError:
        return False
    return True


def test_bpe_query_and_edges(spark, edge, empty, docs, texts):
    got = {r["doc_id"]: r for r in queries.token_digests(docs).collect()}
    assert all(got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items())
    out = bpe.round_trip(edge, public_tokenizers.path(queries.TOKENIZER), public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["decoded"]).decode() for r in out) == sorted(r[1] or "" for r in EDGE)
    assert queries.token_digests(empty).count() == 0


# 4 PII

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text, re.A):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 14 <= len(d) <= 19 and luhn(d or "0"), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return [f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_pii_base_spans(spark, docs, texts):
    rng = random.Random(4)
    alphabet = "a1@.+-5 ()%ñ🙂7\n"
    odd = ["a@b.c_d@e.f", "x@y.z@w.v.u", "1.2.3.4.5.6.7.8", "0256.1.1.1 00255.001.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
           "+1 (555) 010-9999 x", "+1..2", "🙂 mail a.b@c.de, 🙂 10.0.0.1", "5" * 40, "a" * 5000, "1." * 3000, "a@" + "b." * 3000 + "c", "+" * 100 + "1" * 12]
    odd += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "doc_id long, text string").unionByName(
        docs.select((F.col("doc_id") + 100_000).alias("doc_id"), "text"))
    want = dict(enumerate(odd)) | {i + 100_000: t for i, t in texts.items()}
    for r in pii.report(frame).collect():
        spans = plain_spans(want[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), want[r["doc_id"]]
        assert [x for x in r["spans"].split(",") if x and not x.startswith("term")] == spans
        assert r["n_email"] == sum(x.startswith("email") for x in spans)


def test_pii_disclosing_terms(spark):
    """A name that stands only by one address is told, words that stand elsewhere too are not."""
    rows = [(k, f"letter {w} from Zaphod Beeble at zb@x.example.com about {w} things", "en", "a", 1) for k, w in enumerate(("red", "blue", "green", "old"))]
    rows += [(100 + k, f"letter about red blue green old things from many at {k} times", "en", "a", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, DOC)
    got = {r["doc_id"]: r for r in pii.report(docs).collect()}
    for k, r in enumerate(rows[:4]):
        terms = {r[1][int(a):int(b)] for _, a, b in (x.split(":") for x in got[k]["spans"].split(",") if x.startswith("term"))}
        assert terms == {"Zaphod", "Beeble"}
    assert all(got[100 + k]["spans"] == "" for k in range(60))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[0] == "letter red from   at [email] about red things" and clean[100] == rows[4][1]
    # Copies of one text are one context: they tell nothing.
    copies = spark.createDataFrame([(k, rows[0][1], "en", "a", 1) for k in range(5)] + rows[4:], DOC)
    assert all(r["n_terms"] == 0 for r in pii.report(copies).collect())


def test_pii_edges(edge, empty):
    assert pii.report(edge).count() == len(EDGE)
    assert pii.report(empty).count() == 0 and pii.sanitise(empty).count() == 0


# 5 MinHash


def shingles(text, size):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words_of(text)]
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_components(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    at = {}
    for i, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(i)
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in {(a, b) for x in at.values() for a in x for b in x if a < b}:
        n = len(sets[a] & sets[b])
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_minhash_equals_brute_force(spark, docs, texts):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    more = {}
    for k in range(60):  # near copies on both sides of the bound
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(9999)}"
        more[1000 + k] = " ".join(w)
    more |= {2000: "one two", 2001: "One  two", 2002: "", 2003: " \n ", 2004: "one"}
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    for size, percent in ((3, 85), (5, 80)):
        want = brute_components(texts | more, size, percent)
        got = minhash.near_duplicates(frame, size, percent).collect()
        assert len(got) == len(want)
        assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_minhash_large_clusters(spark, monkeypatch):
    """A group of near copies over several blocks, at small block sizes, has the components of all pairs."""
    rng = random.Random(21)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = {}
    for k in range(150):
        w = list(base)
        for _ in range(rng.choice((1, 3, 6, 10, 14))):
            w[rng.randrange(len(w))] = f"v{rng.randrange(99999)}"
        texts[k * 3 + 1] = " ".join(w)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 20)
    monkeypatch.setattr(minhash, "HUBS", 3)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_components(texts, 3, 85)
    assert 1 < len({c for _, c in want.values()}) < 150
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(frame, 3, 85).collect()} == want


def test_minhash_pairs_beside_an_implausible_centre(spark, monkeypatch):
    """Near copies in one bucket with longer or unlike texts are joined whichever member is the centre."""
    rng = np.random.default_rng(17)
    signatures = []
    for bucket in range(6):
        planes = [[int(v) for v in rng.integers(0, 2**60, len(minhash.PLANES))] for _ in range(14)]
        kinds = [0, 0, 1, 1, 1, *range(2, 14), *range(2, 9)]  # the first two, the next three and seven pairs are near copies
        for kind in kinds:
            signatures.append((len(signatures) * 7 + 3, 57 if kind < 2 else 398 if kind < 9 else 60, *planes[kind], [bucket]))
    monkeypatch.setattr(minhash, "SIDE", 4)
    frame = spark.createDataFrame(signatures, "doc_id long, n_shingles long, " + "".join(f"{p} long, " for p in minhash.PLANES)
                                  + "bands array<long>")
    x, y = frame.alias("x"), frame.alias("y")
    every = (x.join(y, (F.col("x.bands") == F.col("y.bands")) & (F.col("x.doc_id") < F.col("y.doc_id")))
             .where(minhash._plausible("x", "y", 80)).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")))
    want = {tuple(r) for r in minhash.components(every).collect()}
    assert len(want) >= 6 * 19
    assert {tuple(r) for r in minhash.components(minhash.candidates(frame, 80)).collect()} == want


def test_block_counts_and_estimate():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000)).astype(np.uint64)) for _ in range(12)]
    got = minhash.common_counts(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]
    assert minhash.floor(85) < 0.85 and minhash.floor(80) < minhash.floor(85)


def test_estimate_is_corrected(spark):
    rng = np.random.default_rng(9)
    shared, a, b = (textops.mix(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (3000, 500, 500))
    rows = []
    for k, s in enumerate((np.concatenate([shared, a]), np.concatenate([shared, b]))):
        rows.append((k, *[int(x[0]) for x in minhash.pack(minhash.minima(np.unique(s))[None, :])]))
    f = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{p} long" for p in minhash.PLANES))
    x, y = f.where("doc_id = 0").alias("x"), f.where("doc_id = 1").alias("y")
    got = x.join(y, F.col("x.doc_id") < F.col("y.doc_id")).select(minhash.estimate("x", "y").alias("e")).first()["e"]
    assert abs(got - 0.75) < 0.2


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + k, 301 + k) for k in range(40)] + [(500, 500)]
    edges = [e for e in edges if e[0] != e[1]] + [(7, 7)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in edges[:-1]:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in list(root)}  # a loop names no pair
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash_edges(edge, empty):
    out = minhash.near_duplicates(edge).collect()
    assert len(out) == len(EDGE) and {r["component_id"] for r in out if r["doc_id"] in (3, 4)} == {3}
    assert [r["kept"] for r in out if r["doc_id"] is None] == [True]
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.unique_documents(edge)
    assert kept.columns == edge.columns and kept.where("doc_id = 4").count() == 0 and kept.where("doc_id is null").count() == 1


# 6 language


def test_language_of_documents_and_pages(spark, docs):
    train, test = docs.where("doc_id % 4 != 1"), docs.where("doc_id % 4 = 1")
    languages, table = langid.learn(train)
    records = test.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("content"), F.col("source").alias("host"))
    got = langid.identify(records, languages, table).join(test.select(F.col("doc_id").alias("id"), F.col("lang").alias("truth")), "id").toPandas()
    assert (got.lang == got.truth).mean() > 0.97
    pages = queries.op6_language(spark, DIR).where("page_id is not null").toPandas()
    assert len(pages) == spark.read.parquet(f"{DIR}/pages.parquet").count() and (pages.lang == pages.declared).mean() > 0.95


def test_language_evidence_fuses(spark, docs):
    """Without text of its own, a page takes its language from what it declares, then from its host."""
    languages, table = langid.learn(docs)
    french, german = (docs.where(f"lang = '{x}' and length(text) > 400").first()["text"] for x in ("fr", "de"))
    rows = [("page", k, f'<html lang="fr"><p>{french}</p>', "a.example.fr") for k in range(20)]
    rows += [("page", 100 + k, f'<html lang="de"><p>{german}</p>', "b.example.de") for k in range(20)]
    rows += [("page", 200, "", "a.example.fr"), ("page", 201, "", "c.example.de"), ("page", 202, '<html lang="de">', "z.example.com"),
             ("page", 203, None, None), ("page", None, french, "b.example.de")]
    got = {r["id"]: r for r in langid.identify(spark.createDataFrame(rows, "kind string, id long, content string, host string"), languages, table).collect()}
    assert [got[k]["lang"] for k in (0, 100, 200, 201, 202, None)] == ["fr", "de", "fr", "de", "de", "fr"]


def test_language_edges(spark, edge, empty):
    records = edge.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("content"), F.col("source").alias("host"))
    assert langid.identify(records, *langid.learn(edge)).count() == len(EDGE)
    assert {r["lang"] for r in langid.identify(records, *langid.learn(empty)).collect()} == {None}
    assert langid.identify(records.where("false"), *langid.learn(edge)).count() == 0


# 7 SpotSigs


def check_neighbours(rows, got):
    """rows: (doc_id, text) in order; got: the query's rows."""
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append(r)
    for k, (i, text) in enumerate(rows):
        nxt, text = rows[(k + 1) % len(rows)][1] or "", text or ""
        half = len(text) // 2
        edited = (text[:len(text) - half] + nxt[:half]).encode()
        one = [r for r in found[i] if r["edited_sha256"] == hashlib.sha256(edited).hexdigest() and r["n_chars"] == len(text)]
        assert one, (i, text[:40])
        a, b, c = spotsigs.spots(text.encode()), spotsigs.spots(edited), spotsigs.spots(nxt.encode())
        assert one[0]["fingerprint"] == spotsigs.encode(a) and one[0]["edited_fingerprint"] == spotsigs.encode(b)
        assert one[0]["near_edited"] == spotsigs.likeness(a, b) and one[0]["near_next"] == spotsigs.likeness(a, c)


def test_spotsigs_neighbours(spark, docs, texts, edge, empty):
    got = spotsigs.neighbours(docs).collect()
    assert len(got) == len(texts)
    check_neighbours(sorted(texts.items()), got)
    rows = sorted(((r[0], r[1]) for r in EDGE), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = spotsigs.neighbours(edge).collect()
    assert len(got) == len(EDGE)
    check_neighbours(rows, got)
    assert spotsigs.neighbours(empty).count() == 0
    one = spotsigs.neighbours(edge.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_spotsigs_sets_and_pairs(spark, docs, texts):
    assert len(spotsigs.spots(b"")) == 0 and len(spotsigs.spots(b"word")) == 1 and len(spotsigs.spots(b"!?")) == 1
    assert np.array_equal(spotsigs.decode(spotsigs.encode(spotsigs.spots(b"the cat of a house"))), spotsigs.spots(b"the cat of a house"))
    members, links = spotsigs.near_pairs(docs, 0.5)
    rep = {r["doc_id"]: r["rep"] for r in members.collect()}
    sets = {i: spotsigs.spots(t.encode()) for i, t in texts.items()}
    assert rep == {i: min(j for j in sets if np.array_equal(sets[i], sets[j])) for i in sets}
    reps = sorted(set(rep.values()))
    want = {(a, b) for a in reps for b in reps if a < b and len(sets[a]) and len(sets[b]) and spotsigs.likeness(sets[a], sets[b], 0.5) > 0}
    assert {(r["a"], r["b"]) for r in links.collect()} == want


# 8 rules


def plain_facts(text):
    w = words_of(text)
    windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    seen = {}
    for x in windows:
        seen[x] = seen.get(x, 0) + 1
    covered = {j for k, x in enumerate(windows) if seen[x] > 1 for j in range(k, k + 8)}
    full = [x for x in text.split("\n") if words_of(x)]
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(covered)]


def test_rule_facts_and_verdicts(spark, docs, texts, edge, empty):
    got = rules.judge(docs, facts=True).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [r[x] for x in rules.FACTS] == plain_facts(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not any(f(rules.Text(texts[r["doc_id"]].encode())) for f in rules.RULES.values()))
        assert not (r["base_failed"] and r["kept"])
    found = rules.judge(edge, facts=True).collect()
    assert sorted([r[x] for x in rules.FACTS] for r in found) == sorted(plain_facts(r[1] or "") for r in EDGE)
    assert rules.judge(empty, facts=True).count() == 0


def test_cascade_order():
    order = rules.cascade_order({"symbols": (1.0, 0.5), "capitals": (0.1, 0.1), "exclamations": (1.0, 0.0)})
    assert order[:2] == ["capitals", "symbols"] and sorted(order) == sorted(rules.RULES)
    calls = []
    table = {"a": lambda t: calls.append("a") or True, "b": lambda t: calls.append("b") or False}
    assert not rules.passes(rules.Text(b""), ["a", "b"], table) and calls == ["a"]


# 9 mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= set(over)
    return out


def test_mixing(spark, docs):
    rows = {r["doc_id"]: r for r in docs.collect()}
    got = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    sizes = {}
    for r in rows.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words_of(r["text"] or ""))
    want = plain_targets(sizes)
    for i, r in got.items():
        assert r["size"] == len(words_of(rows[i]["text"])) and r["source_size"] == sizes[rows[i]["source"]]
        assert r["target"] == pytest.approx(want[rows[i]["source"]])
        share = r["target"] / r["source_size"]
        assert int(share) <= r["copies"] <= min(2, int(share) + 1)
    assert {i: r["copies"] for i, r in got.items()} == {r["doc_id"]: r["copies"] for r in mixing.mix(docs.repartition(7)).collect()}


def test_mixing_of_many_documents(spark):
    """Taken words meet the targets, whatever the source's size, with several levels of blocks."""
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (1 + F.pmod(F.xxhash64("id"), F.lit(40))).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    got = mixing.mix(rows).join(rows.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("copies").alias("most")).collect()
    assert len(got) == 5
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 41 and r["most"] <= 2


def test_pivotal_draw_keeps_expected_copies(spark):
    """Over many draws a document is taken as often as its fraction says."""
    n = 4000
    rows = spark.range(n).select(F.col("id").alias("unit"), (F.col("id") % 500).cast("int").alias("rank"), F.lit(0).alias("class"),
                                 (1 + F.col("id") % 7).alias("size"), F.lit(1).cast("long").alias("blocks"))
    rows = rows.withColumn("mass", (F.col("size") * F.lit(0.3) * mixing._WORD).cast("long"))
    taken = mixing.draw(rows).count()
    assert abs(taken / n - 0.3) < 0.03


def test_mixing_edges(edge, empty):
    got = mixing.mix(edge).collect()
    assert len(got) == len(EDGE) and all(r["copies"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns


# 10 lines


def brute_lines(texts):
    """Kept text of each (doc_id, text), in order of doc_id."""
    seen, out = set(), {}
    for i, text in sorted(texts.items()):
        parts = text.split("\n")
        full = [(k, x.strip(" \t\r\x0b\x0c")) for k, x in enumerate(parts) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for k in range(len(full) - 2):
            key = tuple(x for _, x in full[k:k + 3])
            if key in seen:
                gone |= {j for j, _ in full[k:k + 3]}
            seen.add(key)
        out[i] = ("\n".join(x for k, x in enumerate(parts) if k not in gone), len(gone))
    return out


def test_lines_equal_brute_force(spark, docs, texts, edge, empty):
    rng = random.Random(6)
    more = {5000 + k: "\n".join(rng.choice(["a", "b ", " c", "", "d"]) for _ in range(rng.randrange(14))) for k in range(300)}
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    want = brute_lines(texts | more)
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.dedup_lines(frame).collect()} == want
    got = lines.dedup_lines(edge).collect()
    assert len(got) == len(EDGE) and [r["text"] for r in got if r["doc_id"] == 10] == ["a\nb\nc"]
    assert [r["text"] for r in got if r["doc_id"] == 1] == [None]
    assert lines.dedup_lines(empty).count() == 0 and lines.clean_documents(edge).columns == edge.columns


def test_lines_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DIR}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op10_line_windows"]).fetchall()
    got = queries.op10_line_windows(spark, DIR).select("doc_id", "n_lines", "n_removed", "removed", "text").collect()
    assert sorted(map(tuple, got)) == sorted(want)


# Pipeline


def test_pipeline_stages(spark, docs, texts):
    """Each stage keeps what the one before kept, but for what its operator decides."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    good = stage[names[0]](spark, docs, DIR).cache()
    assert good.columns == docs.columns and 0 < good.count() <= len(texts)
    clean = stage[names[1]](spark, good, DIR).cache()
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == {i: t for i, (t, _) in brute_lines(kept).items()}
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect())
    alone = stage[names[2]](spark, clean, DIR).cache()
    found = brute_components({r["doc_id"]: r["text"] for r in clean.collect()}, 5, 80)
    assert {r["doc_id"] for r in alone.collect()} == {i for i, (_, c) in found.items() if i == c}
    mixed = stage[names[3]](spark, alone, DIR).cache()
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in alone.collect()}
    out = stage[names[4]](spark, mixed, DIR).collect()
    assert len(out) == mixed.count() and all(len(r["ids"]) == 4 * r["n_tokens"] for r in out)
    assert sorted(r["decoded_sha256"] for r in out) == sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in mixed.collect())


def test_pipeline_run(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{DIR}/{name}.parquet").where("doc_id < 40").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for name in ("documents", "labels"):
        spark.read.parquet(f"{DIR}/{name}.parquet").where("false").write.mode("overwrite").parquet(str(tmp_path / "none" / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_stages_take_edge_rows(spark, edge, tmp_path):
    spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge, str(tmp_path))
        out.write.format("noop").mode("overwrite").save()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == edge.columns


def test_registered():
    import __spark_entry__ as entry
    names = list(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert json.dumps(sorted(entry.oracle_sql()))
