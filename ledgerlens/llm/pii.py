"""Personal data: pattern spans, and terms near them that reveal them.

Base spans (e-mail, IPv4, payment card, phone) are pattern matches, leftmost and non-overlapping
for each kind.  Their values are the protected entities.  The method then estimates from the whole
corpus how much a term discloses of an entity near which it stands:

    disclosure(term, entity) = PMI(term; entity) / IC(entity)
                             = log(n_te * N / (n_t * n_e)) / log(N / n_e)

N: distinct texts; n_t: distinct texts with the term; n_e: distinct contexts of the entity; n_te: those of them with
the term.  A context is the REACH whole words on either side, however long they are; the words that a span itself
touches are none of them.  Copies of a text count once on all four sides, so copying alone makes no term more or
less telling.  1 means that the term occurs with the
entity alone.  Terms with at least SUPPORT contexts and a disclosure from GENERALISE on are
spans as well, in the contexts of that entity: replaced by a class from GENERALISE on, removed
from REMOVE on.

Everything is DataFrame functions.  Patterns are possessive forms that match the same strings in linear time; offsets
are prefix sums in chunks, and the words around a span are found by sorting words and spans of a text together, so
the work for a text grows with its length (times a logarithm), however many matches it has.  What is shuffled: contexts,
the distinct words of each text once, to count copies of a text as one, and one count for each task and term.

Defined results: a null text counts as empty; offsets are code points, the end exclusive; a text without
matches has zero counts and empty span lists; rows equal in doc_id and text share their
(equal) spans; very long texts are searched whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

REACH = 4
_CHUNK = 64
SUPPORT = 2
GENERALISE, REMOVE = 0.8, 0.95
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# \G: where the last match ended, the one place within a run where a match may start.
_START = r"(?:\G|(?<![{0}]))"
PATTERNS = {
    "email": _START.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _START.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": _START.format("0-9") + r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to match at all.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_BYTE = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"


def _let(value: Column, body) -> Column:
    """body(value) with the value evaluated once, also where body uses it within other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(steps: Column, first: Column) -> Column:
    """Running sums of a short array, added to ``first``; the last element is the total."""
    start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        return F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"] + x)).alias("out"))
    return F.aggregate(steps, start, step)["out"]


def running(steps: Column) -> Column:
    """Inclusive running sums of an int array: within chunks, on top of the running sums of the chunks."""
    def within(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x))
        before = F.concat(F.array(F.lit(0)), _scan(totals, F.lit(0)))
        both = F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda p, c: F.struct(p.alias("p"), c.alias("c")))
        return F.flatten(F.transform(both, lambda z: _scan(z["p"], z["c"])))

    def cut(xs: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _CHUNK).cast("int")),
                             lambda c: F.slice(xs, c * _CHUNK + 1, F.lit(_CHUNK)))
        return F.when(F.size(xs) > 0, _let(chunks, within)).otherwise(F.array().cast("array<int>"))
    return _let(steps, cut)


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the matches of a pattern that matches no empty string."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def placed(values: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, m: F.length(g) + F.length(m))
        return F.zip_with(running(steps), values, lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")))
    return _let(found, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn's check: every second from the right doubled, sum divisible by 10."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(_BYTE))
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _checked(found: Column, number: int, kind: str) -> Column:
    """The matches of a kind that pass its check, as spans."""
    valid = F.filter(found, lambda x: _valid(kind, x["value"]))
    return F.transform(valid, lambda x: F.struct(
        x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"), x["value"].alias("value")))


def _count(number: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == number)).cast("long")


def base_spans(documents: DataFrame) -> DataFrame:
    """doc_id, row, text, base: array<struct<start, kind (number), end, value>> in order of start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(F.col("doc_id").alias("doc_id"), text.alias("text"))
    parts = []
    for k, kind in enumerate(KINDS):
        found = F.when(F.col("text").rlike(_HINTS[kind]), located(F.col("text"), PATTERNS[kind]))
        parts.append(F.coalesce(_checked(found, k, kind),
                                F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text",
                       F.array_sort(F.concat(*parts)).alias("base"))


def _near(words: Column, spans: Column) -> Column:
    """For each span the words within REACH of it, as array<struct<start, end, value>> in text offsets.

    Words and spans of a text are sorted together; running counts of words then tell each span how many words start
    before its start and before its end.
    """
    place = "struct<at:int,kind:int,span:int>"

    def events(ws: Column, xs: Column) -> Column:
        # at one offset, ends and starts of spans come before a word that starts there
        return F.array_sort(F.concat(
            F.transform(ws, lambda w: F.struct(w["start"].alias("at"), F.lit(2).alias("kind"), F.lit(0).alias("span")).cast(place)),
            F.transform(xs, lambda x, i: F.struct(x["start"].alias("at"), F.lit(0).alias("kind"), i.alias("span")).cast(place)),
            F.transform(xs, lambda x, i: F.struct(x["end"].alias("at"), F.lit(1).alias("kind"), i.alias("span")).cast(place))))

    def counts(every: Column) -> Column:
        seen = running(F.transform(every, lambda e: F.when(e["kind"] == 2, 1).otherwise(0)))
        return F.zip_with(every, seen, lambda e, n: F.struct(e["span"].alias("span"), e["kind"].alias("kind"), n.alias("n")))

    def of(counted: Column, kind: int) -> Column:
        return F.transform(F.array_sort(F.filter(counted, lambda e: e["kind"] == kind)), lambda e: e["n"])

    def around(ws: Column, xs: Column, counted: Column) -> Column:
        both = F.arrays_zip(xs.alias("x"), of(counted, 0).alias("low"), of(counted, 1).alias("high"))

        def one(z: Column) -> Column:
            # the last word that starts before the span may reach into it
            low = z["low"] - F.when(F.get(ws, z["low"] - 1)["end"] > z["x"]["start"], 1).otherwise(0)
            left = F.slice(ws, F.greatest(low - REACH + 1, F.lit(1)), F.least(F.lit(REACH), low))
            return F.concat(left, F.slice(ws, z["high"] + 1, F.lit(REACH)))
        return F.transform(both, one)
    return _let(words, lambda ws: _let(spans, lambda xs: _let(_let(events(ws, xs), counts), lambda c: around(ws, xs, c))))


def term_form(word: Column) -> Column:
    """A word as a term: without punctuation around it, in lower case; empty if it isn't made of letters."""
    core = F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.when(core.rlike(r"^\p{L}[\p{L}\p{M}'’-]++$"), F.lower(core)).otherwise("")


def _contexts(spans: DataFrame) -> DataFrame:
    """One row for each term near each base span of rows (row, base, near): row, entity, context (hash), term, start, end."""
    one = spans.where(F.size("base") > 0).select("row", F.explode(F.arrays_zip("base", "near")).alias("x"))
    entity = F.concat(F.col("x.base.kind").cast("string"), F.lit(":"), F.lower(F.col("x.base.value")))
    near = one.select("row", entity.alias("entity"), F.col("x.near").alias("near"))
    context = F.xxhash64(F.transform("near", lambda w: w["value"]))
    words = near.select("row", "entity", context.alias("context"), F.explode("near").alias("w"))
    return words.select("row", "entity", "context", term_form(F.col("w.value")).alias("term"),
                        F.col("w.start").alias("start"), F.col("w.end").alias("end"))


def disclosures(contexts: DataFrame, documents: DataFrame) -> DataFrame:
    """entity, term, disclosure of the pairs with enough contexts that reach the lower threshold."""
    seen = contexts.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("__n"))
    n_e = (seen.select("entity", "context").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")))
    pairs = (seen.where("term != ''").groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"))
             .where(F.col("n_te") >= SUPPORT))
    # The text count of each term over the corpus: copies of a text are made one before its words are counted.
    # What stands between two terms takes along the marks that ``term_form`` would strip.
    marks = r"[\p{M}'’-]*"
    spaced = F.concat(F.lit(" "), F.lower("text"), F.lit(" "))
    words = F.array_distinct(F.split(spaced, rf"{marks}(?:[^\p{{L}}\p{{M}}'’-]+{marks})+"))
    texts = (documents.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
             .select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"),
                     F.array_join(words, " ").alias("words")))
    texts = materialize(texts.groupBy("h1", "h2").agg(F.first("words").alias("words")), "pii-texts")
    n_t = (texts.select(F.explode(F.split("words", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_t")))
    n_t = n_t.select(term_form(F.col("word")).alias("term"), "n_t").groupBy("term").agg(F.sum("n_t").alias("n_t"))
    total = texts.count()
    ratio = (F.log(F.col("n_te") * F.lit(float(total)) / (F.greatest("n_t", "n_te") * F.col("n_e")))
             / F.log(F.lit(float(total)) / F.col("n_e")))
    return (pairs.join(n_e, "entity").join(n_t, "term")
            .where(F.col("n_e") < total).withColumn("disclosure", ratio)
            .where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure"))


def find(documents: DataFrame) -> DataFrame:
    """doc_id, row, base, terms: array<struct<start, kind, end, disclosure>> of every row."""
    spans = base_spans(documents)
    words = located(F.col("text"), r"[^\x20\x09-\x0D]+")
    near = F.when(F.size("base") > 0, _near(words, F.col("base"))).otherwise(
        F.array().cast("array<array<struct<start:int,end:int,value:string>>>"))
    narrow = materialize(spans.select("doc_id", "row", "base", near.alias("near")), "pii-spans")
    contexts = materialize(_contexts(narrow), "pii-contexts")
    narrow = narrow.drop("near")
    telling = disclosures(contexts, documents)
    hits = contexts.join(telling, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    terms = hits.groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("start", F.lit(len(KINDS)).alias("kind"), "end", "disclosure"))).alias("terms"))
    return narrow.join(terms, "row", "left").withColumn("terms", F.coalesce("terms", F.array().cast(
        "array<struct<start:int,kind:int,end:int,disclosure:double>>")))


def _label(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in (*KINDS, TERM)]), kind + 1)


def written(spans: Column) -> Column:
    """kind:start:end of spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", _label(x["kind"]), x["start"], x["end"])), ",")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms of every row."""
    found = find(documents)
    short = "array<struct<start:int,kind:int,end:int>>"
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    terms = F.transform("terms", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    counts = [_count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(base.cast(short)), 256).alias("base_sha256"),
                        written(F.array_sort(F.concat(base, terms))).alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def sanitise(documents: DataFrame) -> DataFrame:
    """doc_id, text of every row, base spans replaced by [kind], telling terms by [term] or by nothing.

    Where spans overlap, the first by start, then kind, wins and the others go with it.
    """
    found = find(documents).select("row", "base", "terms").dropDuplicates(["row"])
    rows = documents.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text")).join(found, "row")
    marks = F.concat(
        F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"),
                                               F.concat(F.lit("["), _label(x["kind"]), F.lit("]")).alias("by"))),
        F.transform("terms", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"),
                                                F.when(x["disclosure"] >= REMOVE, "").otherwise(f"[{TERM}]").alias("by"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, x["start"] - s["at"]), x["by"])
        return F.when(x["start"] < s["at"], F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out"))).otherwise(
            F.struct(x["end"].alias("at"), piece.alias("out")))
    done = F.aggregate(F.array_sort(marks), start, step)
    clean = F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text")))
    return rows.select("doc_id", clean.alias("text"))
