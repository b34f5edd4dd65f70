"""Filter interaction audit: what each filter removes, in every order of the filters.

A document's failures are a 0/1 mask over the filters. In the order o, filter f stands at position P[o, f] (the
inverse of the permutation). The document is removed at

    step[doc, o] = min over the filters it fails of P[o, f]

a min-plus product of the mask matrix (0 where it fails, infinity where it passes) with the transposed position matrix.
Counts by (order, step), weighted by the number of documents with the same mask, are one scatter; a document that
fails f but is removed before P[o, f] makes f redundant there.

Documents are reduced first to one row for each (part, mask, quality, toxic) with its count, at most 9 * 2**filters
rows a part, so the matrices stay small however many documents there are; parts are spread over tasks.

Filters (words are maximal runs other than space, tab, \\n, \\v, \\f, \\r, case-sensitive):
A under MIN_WORDS words; B under half of the words distinct; C more than 3 % of the code points in A-Z; D any of
# $ % & * |; E equal to the text of any smaller doc_id, removed or not.

E needs no comparison of texts: texts are grouped by their SHA-256, with the smallest doc_id of each, combined before it
moves; every other document of the group fails. Rows are reduced to (text hash, doc_id, mask, part, labels) before they move
and joined on (hash, doc_id) alone, so a text that a third of the documents share is no hot key.

Defined results: a null text is an empty one and equals other empty ones; the part of a null lang is the empty
string; a null doc_id is smaller than none: it neither fails E nor makes others fail; rows of one doc_id do not make each
other fail; repeated rows count row by row; of repeated labels the highest counts, a missing one counts as
neither; very long texts are judged whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
_RESULT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
           "good_lost bigint, toxic_lost bigint, shapley bigint")


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: whether the text fails A, B, C, D."""
    def bits(x: Column) -> Column:
        n = F.size(x["words"])
        upper = F.length(F.regexp_replace(x["text"], "[^A-Z]", ""))
        fails = [n < MIN_WORDS,
                 100 * F.size(F.array_distinct(x["words"])).cast("long") < MIN_DISTINCT_PERCENT * n.cast("long"),
                 100 * upper.cast("long") > MAX_UPPER_PERCENT * F.length(x["text"]).cast("long"),
                 x["text"].rlike(r"[#$%&*|]")]
        return sum((F.when(fail, F.lit(1 << k)).otherwise(0) for k, fail in enumerate(fails)), F.lit(0))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # one element, so that the words are split once
    return F.get(F.transform(F.array(F.struct(text.alias("text"), words.alias("words"))), bits), F.lit(0))


def failures(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, quality, toxic, n: the documents by what they fail and their labels (-1: none)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), text_mask(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("h"))
    marks = labels.groupBy(F.col("doc_id").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    # one row for each document: its text is not read again
    rows = materialize(rows.join(marks, "doc_id", "left")
                       .withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(-1)) for c in ("quality", "toxic")}), "audit-rows")
    group = ["part", "mask", "quality", "toxic"]
    every = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    # E: all but the rows of each text's smallest doc_id
    first = rows.where("doc_id is not null").groupBy("h").agg(F.min("doc_id").alias("doc_id"))
    owned = rows.groupBy("h", "doc_id", *group).agg(F.count(F.lit(1)).alias("n"))
    owners = owned.join(first, ["h", "doc_id"]).unionByName(owned.where("doc_id is null")).groupBy(*group).agg(F.sum("n").alias("n"))
    bit = 1 << 4
    passing = owners.select(*group, "n", F.col("n").alias("less"))
    both = every.select(*group, "n", F.lit(0).cast("long").alias("less")).unionByName(
        passing.select(*group, F.lit(0).cast("long").alias("n"), "less"))
    split = both.groupBy(*group).agg(F.sum("n").alias("n"), F.sum("less").alias("less"))
    return (split.select(*group, "less", (F.col("n") - F.col("less")).alias("more"))
            .select("part", "quality", "toxic", F.explode(F.array(
                F.struct(F.col("mask").alias("mask"), F.col("less").alias("n")),
                F.struct((F.col("mask") + bit).alias("mask"), F.col("more").alias("n")))).alias("x"))
            .select("part", "x.mask", "quality", "toxic", "x.n"))


def position_matrix(filters: int) -> np.ndarray:
    """P[o, f]: where filter f stands (from 0) in the o-th permutation."""
    orders = np.array(list(permutations(range(filters))))
    return np.argsort(orders, axis=1)


def min_plus(mask: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """step[m, o]: the least position of a failed filter (the number of filters if it fails none)."""
    filters = positions.shape[1]
    cost = np.where(mask, 0, filters)[:, None, :] + positions[None, :, :]
    return np.minimum(cost.min(axis=2), filters)


def interactions(mask: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for each (order, step) from masks (rows x filters, bool) and their numbers of documents."""
    filters = mask.shape[1]
    positions = position_matrix(filters)
    orders = len(positions)
    step = min_plus(mask, positions)
    slot = np.arange(orders)[None, :] * (filters + 1) + step

    def scatter(weight: np.ndarray) -> np.ndarray:
        # whole numbers: np.add.at keeps them exact where bincount would go through doubles
        out = np.zeros(orders * (filters + 1), dtype=np.int64)
        np.add.at(out, slot, np.broadcast_to(weight[:, None], slot.shape))
        return out.reshape(orders, filters + 1)[:, :filters]

    removed = scatter(n)
    fails = mask.astype(np.int64).T @ n  # by filter
    only = ((mask.sum(axis=1) == 1)[:, None] & mask).astype(np.int64).T @ n
    at = np.argsort(positions, axis=1)  # the filter at each step
    shapley = np.zeros(filters, dtype=np.int64)
    np.add.at(shapley, at, removed)
    return {"filter": at, "removed": removed, "kept": n.sum() - np.cumsum(removed, axis=1), "redundant": fails[at] - removed,
            "unique_fails": only[at], "good_lost": scatter(np.where(good, n, 0)), "toxic_lost": scatter(np.where(toxic, n, 0)),
            "shapley": shapley[at]}


def audit(groups: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from (part, mask, quality, toxic, n)."""
    filters = len(names)

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        mask = (rows["mask"].to_numpy()[:, None] >> np.arange(filters) & 1).astype(bool)
        found = interactions(mask, rows["n"].to_numpy(np.int64), rows["quality"].to_numpy() == 1, rows["toxic"].to_numpy() == 1)
        order = ["".join(names[f] for f in o) for o in found["filter"]]
        out = {"part": rows["part"].iloc[0], "filter_order": np.repeat(order, filters),
               "step": np.tile(np.arange(1, filters + 1), len(order)).astype(np.int32)}
        return pd.DataFrame(out | {c: found[c].ravel() for c in (
            "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")})
    return groups.groupBy("part").applyInPandas(one, _RESULT)


#: The same rows by DuckDB, order by order over the documents' failures.
ORACLE = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM {documents}),
firsts AS (SELECT text, min(doc_id) AS first_id FROM words GROUP BY text),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM {labels} GROUP BY doc_id),
failing AS (
  SELECT part, len(w) < 200 AS A, 100 * list_unique(w) < 50 * len(w) AS B,
         100 * length(regexp_replace(words.text, '[^A-Z]', '', 'g')) > 3 * length(words.text) AS C,
         regexp_matches(words.text, '[#$%&*|]') AS D, coalesce(doc_id > first_id, false) AS E,
         coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM words JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
masks AS (
  SELECT part, [A, B, C, D, E] AS f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failing GROUP BY ALL),
letters AS (SELECT unnest(range(1, 6)) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o
  FROM letters a JOIN letters b ON b.k <> a.k JOIN letters c ON c.k NOT IN (a.k, b.k)
  JOIN letters d ON d.k NOT IN (a.k, b.k, c.k) JOIN letters e ON e.k NOT IN (a.k, b.k, c.k, d.k)),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
counts AS (
  SELECT part, o, step, o[step] AS letter,
         sum(CASE WHEN len(list_filter(o[1:step], lambda x: f[x])) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN f[o[step]] AND len(list_filter(o[1:step - 1], lambda x: f[x])) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN f[o[step]] AND len(list_filter(o[1:step - 1], lambda x: f[x])) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN f[o[step]] AND len(list_filter(f, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN f[o[step]] AND len(list_filter(o[1:step - 1], lambda x: f[x])) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN f[o[step]] AND len(list_filter(o[1:step - 1], lambda x: f[x])) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks CROSS JOIN steps GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') AS filter_order, step::INT AS step, kept::BIGINT AS kept,
       removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counts
"""
