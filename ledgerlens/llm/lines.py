"""Line dedup over overlapping three-line windows.

Every three consecutive non-blank lines of a text are one window.  A window that
occurred before (smaller doc_id, or earlier in the same text) is a repeat; the lines
that repeats cover are removed, the covered positions of overlapping repeats merge.
The first occurrence of every window stays, so each removed line remains in some
earlier place.

Windows are compared by 128 bits of hash over trimmed lines.  First occurrences are a
map-side combined minimum for each window, so a passage that many documents share is
one row for each map task; the join back to occurrences moves ids and positions only.

Defined results: lines are split at \\n and trimmed of spaces, tabs, \\r, \\v and \\f
for comparison, kept lines stay byte for byte; blank lines are in no window and are
never removed; very long texts are windowed whole; a text with fewer than three non-blank lines has no window and stays as
it is; a null text stays null with 0 lines, an empty one has one blank line; rows that
repeat both doc_id and text count as one occurrence, rows that share only the doc_id are
ordered by a hash of their text; null doc_ids come first; extra columns are ignored
by ``dedup_lines`` and carried by ``clean_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
_BLANKS = " \t\r\x0b\x0c"


def _windows(documents: DataFrame) -> DataFrame:
    """One row for each window: its hash (h1, h2) and its place (doc_id, row, at), at counting non-blank lines."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS))), lambda x: x != "")
    text = documents.select(F.col("doc_id").alias("doc_id"), _row("doc_id", "text").alias("row"), lines.alias("lines"))

    def window(i):
        part = F.slice("lines", i, WINDOW)
        return F.struct(i.alias("at"), F.xxhash64(part).alias("h1"), F.xxhash64(F.lit("second"), part).alias("h2"))
    found = text.where(F.size("lines") >= WINDOW).select(
        "doc_id", "row", F.explode(F.transform(F.sequence(F.lit(1), F.size("lines") - WINDOW + 1), window)).alias("w"))
    return found.select("doc_id", "row", "w.h1", "w.h2", "w.at")


def _row(doc_id: str, text: str):
    """A stand-in for the row: equal for rows equal in both columns."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def repeated_windows(documents: DataFrame) -> DataFrame:
    """doc_id, row, starts: the sorted positions of the windows of a text that occurred before."""
    windows = _windows(documents)
    firsts = (windows.groupBy("h1", "h2")
              .agg(F.min(F.struct("doc_id", "row", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("h1", "h2", "first"))
    later = (windows.join(firsts, ["h1", "h2"])
             .where(~F.struct("doc_id", "row", "at").eqNullSafe(F.col("first"))))
    return later.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("at")).alias("starts"))


def _cleaned(documents: DataFrame) -> DataFrame:
    """The rows with __lines, __removed (positions of removed lines, from 1) and __kept."""
    starts = repeated_windows(documents).select(F.col("row").alias("__row"), F.col("starts").alias("__starts"))
    # any share of the documents may have repeats: never broadcast
    rows = documents.withColumn("__row", _row("doc_id", "text")).join(starts.hint("merge"), "__row", "left")
    lines = F.split("text", "\n", -1)
    filled = F.filter(F.transform(lines, lambda x, i: F.when(F.btrim(x, F.lit(_BLANKS)) != "", i + 1)), lambda x: x.isNotNull())
    covered = F.array_distinct(F.flatten(F.transform("__starts", lambda s: F.slice("__filled", s, WINDOW))))
    return (rows.withColumn("__lines", lines)
            .withColumn("__filled", F.when(F.col("__starts").isNotNull(), filled))
            .withColumn("__removed", covered)
            .withColumn("__text", F.when(F.col("__starts").isNull(), F.col("text")).otherwise(F.array_join(
                F.transform(F.array_except(F.sequence(F.lit(1), F.size("__lines")), "__removed"),
                            lambda i: F.element_at("__lines", i)), "\n"))))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers from 1, comma-joined), text without those lines."""
    rows = _cleaned(documents.select("doc_id", "text"))
    return rows.select(
        "doc_id", F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.sort_array("__removed"), ","), F.lit("")).alias("removed"),
        F.col("__text").alias("text"))


def clean_documents(documents: DataFrame) -> DataFrame:
    """The same rows and columns, the text without repeated lines and n_chars (where there is one) to match."""
    rows = _cleaned(documents).withColumn("text", F.col("__text"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("__starts").isNull(), F.col("n_chars"))
                               .otherwise(F.length("__text").cast(kind)))
    return rows.select(*documents.columns)


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no
  FROM {documents}
), filled AS (
  SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), windows AS (
  SELECT doc_id, pos, line AS l1, lead(line, 1) OVER w AS l2, lead(line, 2) OVER w AS l3
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, pos) AS seen
  FROM windows WHERE l3 IS NOT NULL
), gone AS (
  SELECT DISTINCT f.doc_id, f.line_no FROM ranked r JOIN filled f
    ON f.doc_id = r.doc_id AND f.pos BETWEEN r.pos AND r.pos + 2
  WHERE r.seen > 1
), cut AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.line_no) AS n_removed,
         coalesce(string_agg(CAST(g.line_no AS VARCHAR), ',' ORDER BY l.line_no) FILTER (g.line_no IS NOT NULL), '') AS removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (g.line_no IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g USING (doc_id, line_no) GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed,
       coalesce(c.removed, '') AS removed, CASE WHEN d.text IS NOT NULL THEN c.text END AS text
FROM {documents} d LEFT JOIN cut c USING (doc_id)
"""
