"""Quality rules as a short-circuit cascade.

Each rule looks at one property of a text and may reject it; a text is kept if no rule
does.  Every rule's cost (seconds a text) and selectivity (share rejected) are measured
on a sample, and the rules then run in order of rejections per second, stopping at
the first rejection.  The order changes the time, never the verdict.

The sample is bounded by SAMPLE_ROWS (in expectation, by a hash of the row); only one row of
sums for each rule comes to the driver.

Defined results: a null text counts as empty; an empty text has zero counts and fails the word
count; repeated rows are judged row by row; very long texts are judged whole; an empty table gives an empty result
and the rules keep their written order; extra columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import SPACE, arrow_map, as_bytes, chain, column_bytes, small_batches, span_hashes, word_bounds

SAMPLE_ROWS = 2000
WINDOW = 8
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_BLANK = b" \t\n\x0b\x0c\r"


class Text:
    """The properties that rules look at, each computed when first asked for."""

    def __init__(self, text: bytes | None):
        self.raw = text or b""
        self.b = as_bytes(text)

    @cached_property
    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        return word_bounds(self.b)

    @cached_property
    def words(self) -> np.ndarray:
        return span_hashes(self.b, *self.bounds)

    @property
    def n_words(self) -> int:
        return len(self.bounds[0])

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that are neither white space nor continuation bytes."""
        return int(np.count_nonzero(~SPACE[self.b] & ((self.b & 0xC0) != 0x80)))

    @cached_property
    def n_symbols(self) -> int:
        return int(np.count_nonzero(_SYMBOL[self.b]))

    @cached_property
    def lines(self) -> list[bytes]:
        """The \\n-split lines that have a word."""
        return [x for x in self.raw.split(b"\n") if x.strip(_BLANK)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in WINDOW-word windows that the text has twice or more, the first included."""
        h = chain(self.words, WINDOW)
        if len(h) < 2:
            return 0
        _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        if not again.any():
            return 0
        step = np.zeros(self.n_words + 1, dtype=np.int64)
        at = np.flatnonzero(again)
        np.add.at(step, at, 1)
        np.add.at(step, at + WINDOW, -1)
        return int(np.count_nonzero(np.cumsum(step[:-1]) > 0))

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before."""
        return int(np.count_nonzero(self.words[1:] == self.words[:-1]))

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 20 or 100 * self.n_repeat_words > 30 * self.n_words

    @cached_property
    def capitals(self) -> tuple[int, int]:
        """ASCII capitals and ASCII letters."""
        upper = int(np.count_nonzero((self.b >= 65) & (self.b <= 90)))
        return upper, upper + int(np.count_nonzero((self.b >= 97) & (self.b <= 122)))

    @cached_property
    def letter_words(self) -> int:
        """Words with a letter (any character beyond ASCII counts as one)."""
        start, end = self.bounds
        seen = np.concatenate([[0], np.cumsum(_LETTER[self.b])])
        return int(np.count_nonzero(seen[end] > seen[start]))


#: name -> the text is rejected.  Shares are compared as whole numbers.
RULES: dict[str, Callable[[Text], bool]] = {
    "too few words": lambda t: t.n_words < 20,
    "repeated word windows": lambda t: 100 * t.n_repeat_words > 30 * t.n_words,
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "repeated lines": lambda t: 10 * t.n_dup_lines > 6 * len(t.lines),
    "stuttered words": lambda t: 10 * t.n_stutters > 3 * t.n_words,
    "word length": lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words,
    "capitals": lambda t: 2 * t.capitals[0] > t.capitals[1],
    "words without letters": lambda t: 10 * t.letter_words < 7 * t.n_words,
    "exclamations": lambda t: 10 * t.raw.count(b"!!") > t.n_words,
    "bullet lines": lambda t: 10 * sum(x.lstrip(_BLANK).startswith((b"-", b"*", b"\xe2\x80\xa2")) for x in t.lines) > 9 * len(t.lines),
    "cut lines": lambda t: 10 * sum(x.rstrip(_BLANK).endswith((b"...", b"\xe2\x80\xa6")) for x in t.lines) > 3 * len(t.lines),
}


def measure(documents: DataFrame, rules: dict[str, Callable[[Text], bool]] = RULES,
            sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """(seconds a text, share rejected) of each rule on a sample of about ``sample_rows`` rows."""
    total = documents.count()
    buckets = 1_000_000
    share = min(buckets, max(1, -(-sample_rows * buckets // max(1, total))))
    sample = documents.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, rejected, n = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            n += len(texts)
            for name, rule in rules.items():
                began = time.perf_counter()
                rejected[name] += sum(bool(rule(Text(t))) for t in texts)
                cost[name] += time.perf_counter() - began
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(list(rules)), pa.array(list(cost.values())),
                                              pa.array(list(rejected.values()), pa.int64()),
                                              pa.array([n] * len(rules), pa.int64())], ["rule", "cost", "rejected", "n"])
    small_batches(documents.sparkSession)
    sums = (sample.mapInArrow(run, "rule string, cost double, rejected long, n long").groupBy("rule")
            .agg(F.sum("cost").alias("cost"), F.sum("rejected").alias("rejected"), F.sum("n").alias("n")).collect())
    return {r["rule"]: (r["cost"] / r["n"], r["rejected"] / r["n"]) for r in sums}


def cascade_order(measured: dict[str, tuple[float, float]], rules: dict = RULES) -> list[str]:
    """Rule names by rejections per second, most first; rules without figures keep their order at the end."""
    place = {name: k for k, name in enumerate(rules)}

    def rank(name: str) -> tuple[float, int]:
        cost, rejected = measured.get(name, (1.0, 0.0))
        return -rejected / max(cost, 1e-12), place[name]
    return sorted(rules, key=rank)


def passes(text: Text, order: list[str], rules: dict[str, Callable[[Text], bool]] = RULES) -> bool:
    """Whether no rule rejects the text; stops at the first that does."""
    return not any(rules[name](text) for name in order)


FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(documents: DataFrame, order: list[str] | None = None, facts: bool = False) -> DataFrame:
    """doc_id and kept of every row; with ``facts`` also the base counts and base_failed."""
    order = order or cascade_order(measure(documents))
    rows = documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [Text(t) for t in column_bytes(batch.column("text"))]
        kept = pa.array([passes(t, order) for t in texts], pa.bool_())
        arrays, names = [batch.column("doc_id")], ["doc_id"]
        if facts:
            for name in FACTS:
                arrays.append(pa.array([getattr(t, name) for t in texts], pa.int64()))
                names.append(name)
            arrays.append(pa.array([t.base_failed for t in texts], pa.bool_()))
            names.append("base_failed")
        return pa.RecordBatch.from_arrays([*arrays, kept], [*names, "kept"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    more = "".join(f"{x} long, " for x in FACTS) + "base_failed boolean, " if facts else ""
    return arrow_map(rows, run, f"doc_id {kind}, {more}kept boolean")
