"""Contracts of the mixing, disclosure and quality operators on repeated rows, long words and many matches."""

import math
import random
import re

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from ledgerlens.llm import langid, mixing, pii, quality, spotsigs

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, source string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# 9 mixing


def taken_by_source(spark, rows):
    """source -> (target, taken words), and the largest number of copies of a row."""
    frame = spark.createDataFrame(rows, DOC)
    units = mixing.mixed_units(frame)
    source = frame.select("source", mixing._unit("source", "doc_id", "text").alias("unit")).distinct()
    out = units.join(source, "unit").groupBy("source").agg(
        F.first("target").alias("t"), F.sum(F.col("size") * (F.col("n") * F.col("whole") + F.col("extra"))).alias("w")).collect()
    mix = mixing.mix(frame).agg(F.max("copies"), F.count("*"), F.sum(F.col("copies") * F.col("size"))).first()
    assert mix[1] == len(rows) and mix[2] == sum(r["w"] for r in out)
    return {r["source"]: (r["t"], r["w"]) for r in out}, mix[0]


def test_equal_rows_share_their_fraction(spark):
    """Thousands of equal rows beside others: the taken words stay within a document of the target."""
    text = "w " * 35
    rows = [(7, text, "a")] * 3000 + [(i, "v " * (1 + i % 40), "b") for i in range(1000, 3000)]
    got, most = taken_by_source(spark, rows)
    assert most <= 2
    for target, taken in got.values():
        assert abs(target - taken) <= 41


def test_one_document_under_two_sources(spark):
    rows = [(i, "w " * 20, s) for i in range(1000) for s in ("a", "b")] + [(i, "v " * 30, "c") for i in range(500)]
    got, most = taken_by_source(spark, rows)
    assert most <= 2
    for target, taken in got.values():
        assert abs(target - taken) <= 31


def test_equal_rows_are_spread_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 100)
    rows = spark.createDataFrame([(3, "a b c", "s")] * 1234 + [(4, "d e", None)] * 5 + [(5, None, "s")] * 3, DOC).withColumn("n", F.lit("x"))
    mix = mixing.mix(rows)
    assert mix.count() == 1242
    copies = {r["doc_id"]: r["c"] for r in mix.groupBy("doc_id").agg(F.sum("copies").alias("c")).collect()}
    mixed = mixing.mixed_documents(rows)
    assert mixed.columns == rows.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {i: c for i, c in copies.items() if c}
    assert copies[5] == 0


# 4 disclosure


def plain_form(word):
    core = regex.sub(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "", word)
    return core.lower() if regex.fullmatch(r"\p{L}[\p{L}\p{M}'’-]+", core) else ""


def plain_terms(texts, spans_of):
    """The telling (text, start, end) by the definition: contexts and texts are counted once however often they are copied."""
    distinct = set(texts)
    n_t = {}
    for t in distinct:
        for term in {plain_form(w) for w in regex.split(r"[^\p{L}\p{M}'’-]+", t.lower())} - {""}:
            n_t[term] = n_t.get(term, 0) + 1
    contexts, places = {}, []
    for t in distinct:
        words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        for kind, start, end in spans_of(t):
            left = [w for w in words if w[1] <= start][-pii.REACH:]
            right = [w for w in words if w[0] >= end][:pii.REACH]
            near = left + right
            entity = (kind, t[start:end].lower())
            contexts.setdefault(entity, {})[tuple(w[2] for w in near)] = {plain_form(w[2]) for w in near} - {""}
            places += [(t, entity, plain_form(w[2]), w[0], w[1]) for w in near]
    telling = {}
    for entity, own in contexts.items():
        for term in set().union(*own.values()):
            n_te = sum(term in c for c in own.values())
            if n_te >= pii.SUPPORT and len(own) < len(distinct):
                d = (math.log(n_te * len(distinct) / (max(n_t.get(term, 0), n_te) * len(own)))
                     / math.log(len(distinct) / len(own)))
                if d >= pii.GENERALISE:
                    telling[entity, term] = d
    return {(t, s, e) for t, entity, term, s, e in places if (entity, term) in telling}


def found_terms(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pii.find(rows).join(rows, "doc_id").select("text", F.explode("terms").alias("t")).collect()
    return {(r["text"], r["t"]["start"], r["t"]["end"]) for r in out}


def emails(text):
    pattern = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    return [("email", m.start(), m.end()) for m in re.finditer(pattern, text)]


def made_texts():
    rng = random.Random(4)
    common = [w for w in "the a of to in it is was he she we they you for on with as at by this that from or an be had".split()]

    def prose(n):
        return " ".join(rng.choice(common) for _ in range(n))
    texts = [prose(30) for _ in range(400)]
    url = "https://example.org/" + "x" * 90
    for k in range(8):  # a name beside an address, behind a word longer than any window
        texts.append(f"{prose(5 + k)} Zaphod Beeble {url}{k} president@galaxy.example {prose(6)} ok{k}")
    for k in range(6):
        texts.append(f"{prose(4)} (Trillian)\n\"d'Arc\" trillian@heart.example, {prose(7)} end{k}")
    texts.append("a@b.example,c@d.example " * 3 + "Arthur")
    return texts


def test_disclosure_equals_brute_force(spark):
    texts = made_texts()
    want = plain_terms(texts, emails)
    assert any(t[s:e] == "Zaphod" for t, s, e in want)
    assert found_terms(spark, texts) == want


def test_copies_make_a_term_neither_more_nor_less_telling(spark):
    texts = made_texts()
    want = plain_terms(texts, emails)
    copied = next(t for t in texts if "Zaphod" in t)
    assert found_terms(spark, texts + [copied] * 300) == want


def test_disclosure_on_documents_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    spans = {r["text"]: [(x["kind"], x["start"], x["end"]) for x in r["base"]] for r in pii.base_spans(docs).collect()}
    got = {(texts[r["doc_id"]], t["start"], t["end"]) for r in pii.find(docs).collect() for t in r["terms"]}
    assert got == plain_terms(list(texts.values()), spans.__getitem__)


def test_many_matches_in_one_text(spark):
    """50,000 addresses in one text: offsets and contexts in work that grows with the text."""
    text = " ".join(f"user{i}@mail{i}.com" for i in range(50_000))
    frame = spark.createDataFrame([(1, text), (2, ",".join(f"u{i}@m.de" for i in range(8000)))], "doc_id long, text string")
    words = pii.located(F.col("text"), r"[^\x20\x09-\x0D]+")
    out = pii.base_spans(frame).withColumn("near", pii._near(words, F.col("base"))).orderBy("doc_id").collect()
    assert [(x["start"], x["end"]) for x in out[0]["base"]] == [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    assert [w["value"] for w in out[0]["near"][5]] == [f"user{i}@mail{i}.com" for i in (1, 2, 3, 4, 6, 7, 8, 9)]
    assert len(out[1]["base"]) == 8000 and all(x == [] for x in out[1]["near"])


def test_running_sums_of_arrays(spark):
    rng = random.Random(1)
    arrays = [[rng.randrange(9) for _ in range(n)] for n in (0, 1, 63, 64, 65, 128, 1000)]
    got = spark.createDataFrame([(a,) for a in arrays], "a array<int>").select("a", pii.running(F.col("a")).alias("s")).collect()
    for r in got:
        assert r["s"] == [sum(r["a"][:k + 1]) for k in range(len(r["a"]))]


# 2 quality


@pytest.mark.parametrize("repeats", [3000])
def test_quality_sample_is_bounded_in_rows(spark, monkeypatch, repeats):
    """One repeated doc_id among the labels: what is fitted has one row for each doc_id."""
    rows = [(1, f"good text {i}", "a") for i in range(repeats)] + [(i, f"some text {i} " * 5, "a") for i in range(2, 50)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 50)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit_rows", lambda rows, y: seen.append(len(rows)))
    quality.fit(spark.createDataFrame(rows, DOC), labels)
    quality.fit(spark.createDataFrame(rows, DOC), labels, sample_rows=10)
    assert seen[0] <= 49 and seen[1] <= 10


# 7 pruned comparison


def test_pruned_likeness_equals_jaccard_from_the_bound_on():
    rng = random.Random(6)
    for _ in range(3000):
        bound = rng.choice([0.05, 0.3, 0.8])
        a = {rng.randrange(400) for _ in range(rng.choice([0, 1, 5, 40, 900]))}
        b = set(rng.sample(sorted(a), rng.randrange(len(a) + 1))) | {rng.randrange(5000) for _ in range(rng.choice([0, 3, 60, 3000]))}
        j = len(a & b) / len(a | b) if a | b else 1.0
        if bool(a) != bool(b):
            j = 0.0
        got = spotsigs.likeness(*(np.array(sorted(x), dtype=np.uint32) for x in (a, b)), bound)
        assert got == (j if j >= bound else 0.0)


def test_length_partitions_hold_all_that_reach_the_bound():
    for bound in (0.05, 0.5, 0.8):
        for n in range(1, 400):
            for m in range(n, int(n / bound) + 1):
                assert abs(spotsigs.partition(n, bound) - spotsigs.partition(m, bound)) <= 1


# 6 languages


def test_too_many_languages_are_refused_before_counting(spark, monkeypatch):
    monkeypatch.setattr(langid, "grams", lambda text: pytest.fail("counted"))
    rows = spark.range(2000).selectExpr("concat('l', id) as lang", "'text' as text")
    with pytest.raises(ValueError, match="languages"):
        langid.learn(rows)
