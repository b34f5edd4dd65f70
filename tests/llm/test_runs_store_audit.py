"""Periodic runs, the token store and the filter audit against brute force, the library and edge cases."""

import glob
import hashlib
import itertools
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import audit, queries, repeats, tokenstore
from ledgerlens.session import scratch_path

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (3, "one", "fr", "a", 3), (4, "one", "fr", "a", 3),
    (4, "one", "fr", "a", 3), (None, "no id here", "en", "a", 10), (5, "x" * 70_000, "de", "b", 70_000),
    (6, "word " * 20_000, "en", None, 100_000), (7, "\n\n\n", None, "b", 3), (8, "日本 語　テキスト", "ja", "c", 8),
    (9, "!!! ... ???", "en", "c", 11), (10, "a\nb\nc\na\nb\nc\na\nb\nc\na b c", "en", "c", 11), (None, "one", None, None, None)]
STORE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def edge(spark):
    rows = spark.createDataFrame(EDGE, DOC)
    for name in ("words", "part", "at", "n_tokens", "ids", "start", "runs", "best", "mask", "n", "h", "quality", "toxic", "row", "step"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# 11 periodic runs


def brute_runs(s):
    """Every maximal stretch of smallest period q and length >= max(6, 4q), by comparing all words q apart."""
    out = []
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            if s[i] == s[i + q]:
                j = i
                while j + q < len(s) and s[j] == s[j + q]:
                    j += 1
                n = j + q - i
                if n >= max(6, 4 * q) and not any(s[i:i + n - p] == s[i + p:i + n] for p in range(1, q)):
                    out.append((i, n, q))
                i = j
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found_in(texts):
    s, starts = repeats._number(texts)
    return repeats.runs(s, starts)


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            n, letters = rng.randrange(0, 70), rng.randrange(1, 5)
            w = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < .6:
                a = rng.randrange(n)
                p = 1 + (n - a) // (3 + rng.randrange(8))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(list(texts[0]) if texts and rng.random() < .2 else w)
        if any(texts):
            assert found_in(texts) == [brute_runs(w) for w in texts]


def test_runs_of_words_over_fibonacci_and_one_letter():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 3000:
        a, b = b, b + a
    assert found_in([b, [b"a"] * 5000, b * 4]) == [[], [(0, 5000, 1)], [(0, 4 * len(b), len(b))]]


def test_branching_tandems_are_exactly_those_squares():
    rng = random.Random(8)
    for _ in range(200):
        s = np.array([rng.randrange(2) for _ in range(rng.randrange(1, 40))])
        n, x = len(s), s.tolist()
        want = {(i, d) for d in range(1, n // 2 + 1) for i in range(n - 2 * d + 1)
                if x[i:i + d] == x[i + d:i + 2 * d] and (i + 2 * d == n or x[i + d] != x[i + 2 * d])}
        got = repeats.branching_tandems(s, least=2)
        assert set(zip(got[0].tolist(), got[1].tolist())) == want


def planted(doc_id, text):
    w = words_of(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check_runs(rows, got):
    want = []
    for doc_id, text in rows:
        w = planted(doc_id, text)
        found = brute_runs(w) if len(w) < 800 else found_in([[x.encode() for x in w]])[0]
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        want.append((doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_runs_query(spark, edge):
    rows = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    check_runs(rows, queries.op11_periodic_runs(spark, DIR).collect())
    found = repeats.find(edge.select("*", F.lit(1).alias("collapsed")))
    got = {(r["doc_id"], r["collapsed"], r["n_words"], len(r["runs"])) for r in found.collect()}
    assert (6, "word", 20_000, 1) in got and (10, "a b c", 12, 1) in got and (1, "", 0, 0) in got and (None, "no id here", 3, 0) in got
    assert found.count() == len(EDGE) and repeats.find(edge.where("false")).count() == 0


def test_planted_edges(edge):
    got = edge.select("doc_id", "text", repeats.planted(F.col("doc_id"), F.col("text")).alias("edited")).collect()
    for r in got:
        assert words_of(r["edited"]) == planted(r["doc_id"], r["text"])


# 12 token store


def library_rows(rows):
    """(doc_id, start, n_tokens, crc32) by the library, one text at a time."""
    t, at, out = Tokenizer.from_file(STORE), 0, []
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_store_query(spark):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(map(tuple, queries.op12_token_store(spark, DIR).collect())) == library_rows(rows)


def test_pieces_encode_as_whole_texts(monkeypatch):
    """Odd texts: marks after white space, sigmas, contractions, other white space, special tokens; with a full cache too."""
    monkeypatch.setattr(tokenstore, "CACHE", 300)
    rng = random.Random(2)
    bits = ["a", "É", "é", " ́", "Σ", "ΑΣ", "'s", "'LL", " ", " ", " ", "\u0085", "\x1c", "\n", "\r\n", "\t", "\x0b", "7", "٣",
            "日本", "ﬁ", "<|endoftext|>", "<|", "|>", "--", "​", "가", "x" * 90, "\0", "\x01", "😀", "İ", "ß"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 25))) for _ in range(3000)]
    t = Tokenizer.from_file(STORE)
    encoder, cuts = tokenstore.Encoder(t.to_str(), 2), 0
    for k in range(0, len(texts), 100):
        part = texts[k:k + 100]
        want = [np.array(x.ids + [2], dtype="<i4").tobytes() for x in t.encode_batch(part, add_special_tokens=False)]
        before = encoder.young
        assert encoder.encode([x.encode() for x in part]) == want
        cuts += encoder.young is not before
        assert all(len(p) <= tokenstore._LONGEST for p in encoder.young)
    assert cuts > 3


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_store_layout_and_selective_reads(spark, encoding):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").withColumn("row", F.lit("clash"))
    path = scratch_path(spark, "store-test")
    tokenstore.write(docs, path, STORE, 2, ids_encoding=encoding, file_bytes=200_000, row_group=1 << 16, page_rows=10)
    groups = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            columns = {c.path_in_schema: c for c in (meta.row_group(g).column(k) for k in range(meta.num_columns))}
            assert all(c.has_column_index and c.has_offset_index for c in columns.values())
            ids = columns["ids.list.element"]
            assert ids.has_dictionary_page == (encoding == "dictionary") and ("DELTA_BINARY_PACKED" in ids.encodings) == (encoding == "delta")
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["at"].encodings
    assert groups > 3
    t = Tokenizer.from_file(STORE)
    texts = sorted(tuple(r) for r in docs.select("doc_id", "text").collect())
    ids = {i: t.encode(x, add_special_tokens=False).ids + [2] for i, x in texts}
    index = tokenstore.read_index(spark, path)
    starts = dict(zip(ids, np.cumsum([0] + [len(x) for x in ids.values()]).tolist()))
    assert {tuple(r) for r in index.collect()} == {(i, starts[i], len(x)) for i, x in ids.items()}
    assert "ids" not in index._jdf.queryExecution().executedPlan().toString().split("ReadSchema", 1)[1].split(">")[0]
    some = tokenstore.read_documents(spark, path, 20, 60)
    assert {r["doc_id"]: r["ids"] for r in some.collect()} == {i: x for i, x in ids.items() if 20 <= i <= 60}
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,20)" in some._jdf.queryExecution().executedPlan().toString()
    whole = list(itertools.chain.from_iterable(ids.values()))
    for start, count in ((0, 1), (5000, 3000), (len(whole) - 7, 50), (12, 0), (len(whole) + 5, 9)):
        pieces = tokenstore.read_window(spark, path, start, count).orderBy("offset").collect()
        assert [x for r in pieces for x in r["ids"]] == whole[start:start + count]


def test_store_edges(spark, edge):
    got = sorted(map(tuple, tokenstore.round_trip(edge, STORE, 2).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 10]
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in library_rows([x[:2] for x in EDGE]))
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert tokenstore.round_trip(edge.where("false"), STORE, 2).count() == 0
    with pytest.raises(ValueError):
        tokenstore.write(edge, scratch_path(spark, "x"), STORE, ids_encoding="plain")


def test_hot_doc_id_is_spread(spark):
    """Rows equal in doc_id and text are cut like others; their starts are all different."""
    rows = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    path = scratch_path(spark, "store-hot")
    tokenstore.write(rows.repartition(8), path, STORE, 2, file_bytes=4000)
    parts = [r["n"] for r in spark.read.parquet(path).groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert len(parts) > 5 and max(parts) < 1500
    assert tokenstore.read_index(spark, path).select("start").distinct().count() == 3000


# 13 filter audit


def plain_audit(rows, labels):
    """Applies the filters document by document in each of the 120 orders."""
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc_id), doc_id)
    docs = []
    for doc_id, text, lang in rows:
        text = text or ""
        w = words_of(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and smallest[text] < doc_id}
        docs.append((lang or "", fails, *labels.get(doc_id, (None, None))))
    out = {}
    for part in {d[0] for d in docs}:
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                failing = [d for d in every if d[1][f]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(failing) - len(gone),
                                                   sum(sum(d[1].values()) == 1 for d in failing),
                                                   sum(d[2] == 1 for d in gone), sum(d[3] == 1 for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    got = queries.op13_filter_audit(spark, DIR).collect()
    assert {tuple(r) for r in got} == plain_audit(docs, labels) and len(got) == 600 * len({d["lang"] for d in docs})


def test_audit_edges(spark, edge):
    labels = [(3, 1, 0), (4, 1, 1), (4, 0, None), (6, None, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit("clash"))
    got = audit.audit(audit.failures(edge, frame)).collect()
    assert {tuple(r) for r in got} == plain_audit([(r[0], r[1], r[2]) for r in EDGE], {3: (1, 0), 4: (1, 1), 6: (None, 1)})
    assert audit.audit(audit.failures(edge.where("false"), frame)).count() == 0
    assert audit.audit(audit.failures(edge, frame.where("false"))).count() == len(got)


def test_min_plus_steps():
    positions = audit.position_matrix(3)
    mask = np.array([[(m >> f) & 1 for f in range(3)] for m in range(8)], dtype=bool)
    for o, order in enumerate(itertools.permutations(range(3))):
        for m in range(8):
            first = next((k for k, f in enumerate(order) if mask[m, f]), 3)
            assert audit.min_plus(mask, positions)[m, o] == first


def test_audit_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    got = queries.op13_filter_audit(spark, DIR)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op13_filter_audit']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
