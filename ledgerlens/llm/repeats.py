"""Periodic runs: stretches of words that repeat with a fixed period, found by an enhanced suffix array.

The texts of an Arrow batch are numbered word by word, each text with numbers of its own, and sorted as
one string: suffix array, inverse (ISA) and the longest common prefixes (LCP) of neighbours.  A branching
tandem is a square w w at i with |w| = depth whose two suffixes i and i + depth part right after w.  Both lie
in the LCP interval of w, in different children, so one of them is outside the largest child: for each
interval, every suffix i of a smaller child looks whether ISA[i + depth] or ISA[i - depth] falls in another child
of the same interval.  No tree is built; a suffix is in smaller children at most log n times.

Each run of period q ends in exactly one branching tandem of that depth.  Rotating it to the left, word by word while
the words a period apart agree, gives the start of the run; tandems of a multiple of the period end where the
run of the period ends and are merged into it.

A run counts from EXPONENT periods on (and LEAST words), so w has at least four occurrences: classes of fewer
suffixes are left unsorted, which spares most of an ordinary text.

Memory of a task: the arrays of one batch, 4 bytes a word for each doubling of the longest repeat.  A batch holds at most
256 texts and about 16 MB of them (textops.BATCH_BYTES); a longer text is a batch of its own and is never cut.

Defined results: words are maximal runs other than space, tab, \\n, \\v, \\f, \\r; a null or empty text has no words
and no runs, its collapsed text is empty; repeated rows are judged row by row; a null doc_id stays null; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import arrow_map, column_bytes

LEAST, EXPONENT = 6, 4
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def enhanced_suffix_array(s: np.ndarray, least: int = EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, inverse and LCP array of whole numbers, by doubling.

    Classes of fewer than ``least`` suffixes with a common prefix are not sorted any further: the intervals of
    ``least`` suffixes or more, their depths and their children of that size are exact.
    """
    n = len(s)
    sa = np.argsort(s, kind="stable").astype(np.int64)
    rank = np.empty(n, dtype=np.int64)
    new = np.ones(n, dtype=bool)
    new[1:] = s[sa[1:]] != s[sa[:-1]]
    at = np.arange(n, dtype=np.int64)
    levels: list[np.ndarray] = []
    open_ = at  # positions of the suffix array whose class may still be split
    while len(open_):
        # class starts and sizes among the open positions
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(open_)))
        small = np.repeat(size < least, size)
        head = np.repeat(open_[first], size)
        rank[sa[open_]] = np.where(small, open_, head)
        levels.append(rank.astype(np.int32) if n < 1 << 31 else rank.copy())
        open_, head = open_[~small], head[~small]
        if not len(open_):
            break
        h = 1 << (len(levels) - 1)
        pos = sa[open_]
        after = pos + h
        key = np.full(len(pos), -1, dtype=np.int64)
        inside = after < n
        key[inside] = rank[after[inside]]
        order = np.lexsort((key, head))
        sa[open_] = pos[order]
        key = key[order]
        new = np.ones(len(open_), dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (key[1:] != key[:-1])
    isa = np.empty(n, dtype=np.int64)
    isa[sa] = at
    lcp = np.zeros(n, dtype=np.int64)
    pairs = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1 if n else at
    a, b = sa[pairs], sa[pairs - 1]
    common = np.zeros(len(pairs), dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        inside = (np.maximum(a, b) < n).nonzero()[0]
        same = inside[levels[j][a[inside]] == levels[j][b[inside]]]
        common[same] += 1 << j
        a[same] += 1 << j
        b[same] += 1 << j
    lcp[pairs] = common
    return sa, isa, lcp


def _bounds(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each k with lcp[k] > 0: the first and last position of the LCP interval that k divides."""
    left, right = np.zeros(len(lcp), dtype=np.int64), np.zeros(len(lcp), dtype=np.int64)
    values, stack, lows = lcp.tolist(), [], []
    for k, v in enumerate(values):
        low = k - 1  # where the interval of v starts, if nothing on the stack is as deep
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = k - 1
            low = lows.pop()
        if v:
            if stack and values[stack[-1]] == v:
                low = lows[-1]
            stack.append(k)
            lows.append(low)
            left[k] = low
    while stack:
        right[stack.pop()] = len(values) - 1
    return left, right


def branching_tandems(s: np.ndarray, least: int = EXPONENT) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (i, depth) with s[i:i+depth] == s[i+depth:i+2*depth], the suffixes i and i + depth parting after depth.

    All of those whose word of that depth occurs ``least`` times or more.
    """
    n = len(s)
    none = np.zeros(0, dtype=np.int64)
    sa, isa, lcp = enhanced_suffix_array(s, least)
    # Only classes of ``least`` equal first words or more hold such an interval.
    heads = np.flatnonzero(lcp == 0)
    sizes = np.diff(np.append(heads, n))
    keep = np.flatnonzero(np.repeat(sizes >= least, sizes))
    if not len(keep):
        return none, none
    depth = lcp[keep]  # the classes are whole, so neighbours stay neighbours
    left, right = _bounds(depth)
    cut = np.flatnonzero((depth > 0) & (right - left + 1 >= least))
    if not len(cut):
        return none, none
    # children: from each cut to the next of its interval, and from the interval's start to its first cut
    order = cut[np.lexsort((cut, right[cut], left[cut]))]
    lo, hi, d = left[order], right[order], depth[order]
    head = np.ones(len(order), dtype=bool)
    head[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    last = np.append(head[1:], True)
    tail = np.where(last, hi, np.append(order[1:], 0) - 1)
    begin = np.concatenate([order, lo[head]])
    end = np.concatenate([tail, order[head] - 1])
    which = np.cumsum(head) - 1
    owner = np.concatenate([which, which[head]])
    low, high, deep = lo[head], hi[head], d[head]
    size = end - begin + 1
    by_size = np.lexsort((-size, owner))
    smaller = np.ones(len(by_size), dtype=bool)
    smaller[by_size[np.flatnonzero(np.append(True, owner[by_size][1:] != owner[by_size][:-1]))]] = False
    begin, end, owner, size = begin[smaller], end[smaller], owner[smaller], size[smaller]
    # the suffixes of the smaller children, each with its child and interval
    child = np.repeat(np.arange(len(size)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[child]
    i, step = sa[keep[place]], deep[owner[child]]
    where = np.full(n, -1, dtype=np.int64)
    where[keep] = np.arange(len(keep))
    found = []
    for sign in (1, -1):
        other = i + sign * step
        ok = np.flatnonzero((other >= 0) & (other < n))
        t = where[isa[other[ok]]]
        c, o = child[ok], owner[child[ok]]
        member = (t >= low[o]) & (t <= high[o]) & ((t < begin[c]) | (t > end[c]))
        hit = ok[member]
        found.append((i[hit] if sign == 1 else other[hit], step[hit]))
    both = np.unique(np.concatenate([found[0][0], found[1][0]]) * np.int64(n + 1) + np.concatenate([found[0][1], found[1][1]]))
    return both // (n + 1), both % (n + 1)


def _rotations(s: np.ndarray, i: int, d: int) -> int:
    """How many words to the left of i agree with the word d later."""
    done, chunk = 0, 64
    while done < i:
        m = min(chunk, i - done)
        top = i - done
        differs = np.flatnonzero(s[top - m:top] != s[top - m + d:top + d])
        if len(differs):
            return done + m - 1 - int(differs[-1])
        done += m
        chunk *= 2
    return done


def runs(s: np.ndarray, starts: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, in order of start, then period.

    ``s`` are the numbered words of all texts, numbers of different texts different; ``starts`` where each text
    begins, and the end.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(starts) - 1)]
    i, d = branching_tandems(s)
    text = np.searchsorted(starts, i, side="right") - 1
    # a run of EXPONENT periods goes on to the left of its last square
    more = np.flatnonzero(i - (EXPONENT - 2) * d >= starts[text])
    i, d, text = i[more], d[more], text[more]
    more = np.flatnonzero((s[i - 1] == s[i - 1 + d]) & (s[i - (EXPONENT - 2) * d] == s[i]))
    ends: dict[int, list[tuple[int, int]]] = {}
    for k in more[np.argsort(d[more], kind="stable")].tolist():
        at, period, base = int(i[k]), int(d[k]), int(starts[text[k]])
        end = at + 2 * period
        known = ends.setdefault(end, [])
        if any(period % q == 0 and begin <= at for begin, q in known):
            continue
        begin = at - _rotations(s[base:], at - base, period)
        if end - begin >= EXPONENT * period:
            known.append((begin, period))
            if end - begin >= LEAST:
                out[text[k]].append((begin - base, end - begin, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for run in found:  # in order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not found:
        return b" ".join(words)
    over = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        over[start + period] += 1
        over[start + length] -= 1
    gone = np.cumsum(over)[:-1] > 0
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def _number(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as whole numbers, equal within a text if the words are, never equal between texts; and where texts start."""
    parts, base = [], 0
    for words in texts:
        distinct = dict.fromkeys(words)
        number = dict(zip(distinct, range(base, base + len(distinct))))
        parts.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
        base += len(distinct)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), starts


def find(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period), best (the strongest run, null if none), collapsed of every row."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        # split() of bytes cuts at exactly the six characters that are no word characters
        texts = [(t or b"").split() for t in column_bytes(batch.column("text"))]
        s, starts = _number(texts)
        found = runs(s, starts) if len(s) else [[] for _ in texts]
        flat = [r for x in found for r in x]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        columns = [pa.array([r[c] for r in flat], pa.int64()) for c in range(3)]
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_RUN)))
        best = pa.array([None if b is None else dict(zip(("start", "length", "period"), b)) for b in map(strongest, found)], _RUN)
        kept = pa.array([collapse(w, x) for w, x in zip(texts, found)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(w) for w in texts], pa.int64()), listed, best, kept],
            ["doc_id", "n_words", "runs", "best", "collapsed"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    run = "struct<start:bigint,length:bigint,period:bigint>"
    return arrow_map(rows, one, f"doc_id {kind}, n_words bigint, runs array<{run}>, best {run}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text of documents with crc32(doc_id as text) divisible by 10, its tail made periodic; other texts as they are.

    With h that number, g = floor(h / 10) and n words, word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def tail(x: Column) -> Column:
        n = F.size(x["words"]).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        again = F.transform(F.sequence(a, n - 1), lambda i: F.get(x["words"], (a + F.pmod(i - a, p)).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(x["words"], F.lit(1), a.cast("int")), again), " ")).otherwise("")
    # one element, so that the words are split once
    edited = F.get(F.transform(F.array(F.struct(words.alias("words"))), tail), F.lit(0))
    return F.when(F.pmod(h, F.lit(10)) == 0, edited).otherwise(text)
