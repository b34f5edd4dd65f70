"""Language identification by Bayesian evidence fusion.

log P(l | all) = tempered log P(text | l) + log P(declared | l) + log P(l | host), normalised.

* Text: hashed byte 1- to 3-grams, multinomial, counted over every labelled document.  A
  text's evidence is its mean log likelihood times at most EFFECTIVE n-grams, as
  neighbouring n-grams aren't independent.
* Declared markup language: how often pages whose text reads as l declare each value, counted over
  all records, smoothed.
* Host: the share of each language on a host, smoothed towards that of its domain, that towards
  the address suffix's, that towards all records'; grouped sums of the text posteriors, the record's
  own share taken out of its host's.

Only a narrow row for each record is shuffled, never a text.  The counts (languages x SLOTS numbers) are
the one table that reaches the driver; languages are few, and more than MAX_LANGUAGES raise an error.

Defined results: a null or empty text has no evidence of its own; a missing declaration or host leaves
that evidence out; the language is null only if no labelled document exists; equal scores go to the
language first in order; documents without a label teach nothing; very long texts are counted whole; repeated rows count as often
as they occur; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textops import LOWER, as_bytes, column_bytes, small_batches

BITS = 16
SLOTS = (1 << BITS) + 256
EFFECTIVE = 60.0
SMOOTH_TEXT, SMOOTH_DECLARED, SMOOTH_HOST = 0.5, 5.0, 5.0
MAX_LANGUAGES = 256
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", re.I)
_UNSEEN = re.compile(r"<!--.*?-->|<(script|style|nav|footer|aside|form|template)\b.*?(?:</\1\s*>|\Z)|<[^>]*(?:>|\Z)", re.I | re.S)


def grams(text: bytes | None) -> np.ndarray:
    """Slots of the byte n-grams of a text, A-Z lower-cased."""
    b = LOWER[as_bytes(text)].astype(np.uint32)
    out = [b + np.uint32(1 << BITS)]
    if len(b) > 1:
        two = b[:-1] << np.uint32(8) | b[1:]
        out.append((two * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
        if len(b) > 2:
            three = two[:-1] << np.uint32(8) | b[2:]
            out.append((three * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return np.concatenate(out)


def learn(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log P(slot | language) as an array of slots x languages."""
    rows = documents.where(F.col("lang").isNotNull()).select(F.col("lang").alias("lang"), F.col("text").alias("text"))
    # before any task holds an array for each of them
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        waiting: dict[str, list[np.ndarray]] = {}  # grams of a few texts, counted together
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), column_bytes(batch.column("text"))):
                if lang not in sums:
                    sums[lang] = np.zeros(SLOTS, dtype=np.int64)
                waiting.setdefault(lang, []).append(grams(text))
            for lang in [k for k, parts in waiting.items() if sum(map(len, parts)) > 1 << 18]:
                sums[lang] += np.bincount(np.concatenate(waiting.pop(lang)), minlength=SLOTS)
        for lang, parts in waiting.items():
            sums[lang] += np.bincount(np.concatenate(parts), minlength=SLOTS)
        for lang, n in sums.items():
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot.astype(np.int32)),
                                              pa.array(n[slot])], ["lang", "slot", "n"])
    small_batches(documents.sparkSession)
    counts = rows.mapInArrow(run, "lang string, slot int, n long")
    total = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    packed = (total.groupBy("lang").agg(F.collect_list("slot").alias("slots"), F.collect_list("n").alias("ns"))
              .orderBy("lang").toArrow())
    languages = packed.column("lang").to_pylist()
    table = np.full((SLOTS, max(1, len(languages))), SMOOTH_TEXT)
    for k in range(len(languages)):
        table[np.array(packed.column("slots")[k].as_py()), k] += np.array(packed.column("ns")[k].as_py())
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def text_evidence(text: bytes | None, table: np.ndarray) -> np.ndarray:
    """The tempered log likelihood of a text in each language."""
    g = grams(text)
    if not len(g):
        return np.zeros(table.shape[1])
    mean = np.array([table[:, k][g].mean(dtype=np.float64) for k in range(table.shape[1])])
    return mean * min(len(g) / 3.0, EFFECTIVE)


def page_text(source: str) -> tuple[str, str | None]:
    """The readable text of a page, roughly, and the primary language that its markup declares."""
    m = _DECLARED.search(source)
    return references.unescape(_UNSEEN.sub(" ", source)), m[1].lower() if m else None


def evidence(records: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """kind, id, declared, host and the text evidence e0, e1, ... of records (kind, id, content, host).

    The content of kind "page" is HTML, that of every other kind is plain text.
    """
    columns = np.ascontiguousarray(table.T)
    held = records.sparkSession.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared, values = [], np.zeros((batch.num_rows, max(1, len(languages))))
            for i, (kind, content) in enumerate(zip(batch.column("kind").to_pylist(), column_bytes(batch.column("content")))):
                said = None
                if kind == "page" and content:
                    text, said = page_text(content.decode())
                    content = text.encode()
                declared.append(said)
                values[i] = text_evidence(content, held.value.T)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("id"), batch.column("host"), pa.array(declared, pa.string()),
                 *(pa.array(values[:, k]) for k in range(len(languages)))],
                ["kind", "id", "host", "declared", *(f"e{k}" for k in range(len(languages)))])
    small_batches(records.sparkSession)
    schema = "kind string, id long, host string, declared string" + "".join(f", e{k} double" for k in range(len(languages)))
    return records.select("kind", "id", "host", "content").mapInArrow(run, schema)


def _posterior(values: list[Column]) -> list[Column]:
    """exp of log scores, normalised to sum 1."""
    top = F.greatest(*values) if len(values) > 1 else values[0]
    each = [F.exp(v - top) for v in values]
    total = sum(each[1:], each[0])
    return [x / total for x in each]


def _domain(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """kind, id, host, declared, lang, confidence from the rows of ``evidence``."""
    n = len(languages)
    if not n:
        return rows.select("kind", "id", "host", "declared", F.lit(None).cast("string").alias("lang"),
                           F.lit(None).cast("double").alias("confidence"))
    rows = rows.select("*", F.when(F.col("host").contains("."), _domain(F.col("host"))).alias("domain"),
                       F.when(F.col("host").contains("."), F.regexp_extract("host", r"([^.]+)$", 1)).alias("suffix"),
                       *(p.alias(f"p{k}") for k, p in enumerate(_posterior([F.col(f"e{k}") for k in range(n)]))))
    rows = materialize(rows, "language-evidence")

    def sums(by: list[str], name: str) -> DataFrame:
        return rows.groupBy(*by).agg(*(F.sum(f"p{k}").alias(f"{name}{k}") for k in range(n)), F.count(F.lit(1)).alias(name))

    everything = rows.agg(*(F.coalesce(F.sum(f"p{k}"), F.lit(0.0)).alias(f"all{k}") for k in range(n)),
                          F.count(F.lit(1)).alias("all")).first()
    base = [(everything[f"all{k}"] + 1.0) / (everything["all"] + n) for k in range(n)]

    def smoothed(got: list[Column], count: Column, towards: list[Column]) -> list[Column]:
        """Shares of the level, drawn to the level above; where the level has no rows, the level above."""
        return [(F.coalesce(g, F.lit(0.0)) + SMOOTH_HOST * t) / (F.coalesce(count, F.lit(0)) + SMOOTH_HOST)
                for g, t in zip(got, towards)]

    # The levels nest, so each host's smoothed counts are worked out once, on small tables.
    host = sums(["host", "domain", "suffix"], "h").where("host is not null")
    domain = sums(["domain"], "d").where("domain is not null")
    suffix = sums(["suffix"], "s").where("suffix is not null")
    levels = host.join(domain, "domain", "left").join(suffix, "suffix", "left")
    prior = smoothed([F.col(f"s{k}") for k in range(n)], F.col("s"), [F.lit(b) for b in base])
    prior = smoothed([F.col(f"d{k}") for k in range(n)], F.col("d"), prior)
    levels = levels.select("host", "h", *(F.col(f"h{k}") for k in range(n)), *(p.alias(f"u{k}") for k, p in enumerate(prior)))

    said = sums(["declared"], "m").where("declared is not null")
    kinds = said.count()
    told = said.agg(*(F.coalesce(F.sum(f"m{k}"), F.lit(0.0)).alias(f"t{k}") for k in range(n))).first()
    said = said.select("declared", *(F.log((F.col(f"m{k}") + SMOOTH_DECLARED / max(1, kinds))
                                           / F.lit(told[f"t{k}"] + SMOOTH_DECLARED)).alias(f"m{k}") for k in range(n)))
    joined = rows.join(levels, "host", "left").join(said, "declared", "left")
    scores = []
    for k in range(n):
        own = (F.col(f"h{k}") - F.col(f"p{k}") + SMOOTH_HOST * F.col(f"u{k}")) / (F.col("h") - 1 + SMOOTH_HOST)
        share = F.when(F.col("host").isNotNull(), F.greatest(own, F.lit(1e-6))).otherwise(base[k])
        scores.append(F.col(f"e{k}") + F.coalesce(f"m{k}", F.lit(0.0)) + F.log(share))
    final = joined.select("kind", "id", "host", "declared", *(p.alias(f"f{k}") for k, p in enumerate(_posterior(scores))))
    top = F.greatest(*(F.col(f"f{k}") for k in range(n))) if n > 1 else F.col("f0")
    best = F.coalesce(*(F.when(F.col(f"f{k}") == top, F.lit(languages[k])) for k in range(n)))
    return final.select("kind", "id", "host", "declared", best.alias("lang"), top.alias("confidence"))


def host_of(url: str) -> Column:
    """The lower-cased host of a URL, null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def identify(records: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """kind, id, host, declared, lang, confidence of every record (kind, id, content, host)."""
    return fuse(evidence(records, languages, table), languages)
