"""Runs (maximal periodic stretches of words) by enumeration of maximal pairs.

A stretch of period q that cannot be extended is a pair of equal factors q words apart whose words before and after
differ, and the other way round. Such pairs come from the tree of LCP intervals, built bottom-up over the suffix array
of each document: where two intervals meet at a depth, positions of the one are paired with those of the other that
lie within the depth and have another word on their left. Only documents in which some stretch of words recurs within
twice its own length can hold a run; the others are sorted out by hashes of word sequences first.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import gram_hashes, group_starts, mix, texts_of, word_codes

SHORTEST = 12  # words of a run
HELD_WORDS = 500_000  # words that a task searches at a time, whole texts; results do not depend on it


def _suffixes(ids: np.ndarray) -> tuple:
    """Suffix array of a sequence, and the ranks of all factors of 1, 2, 4, ... words while any recurs."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    starts = group_starts(ids[order])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))  # a group's rank is its first place
    levels, step = [rank], 1
    while True:
        last = levels[-1]
        sorted_ranks = last[order]
        again = np.zeros(n, bool)
        again[1:] = sorted_ranks[1:] == sorted_ranks[:-1]
        again[:-1] |= again[1:]
        if not again.any():
            return order, levels
        places = np.flatnonzero(again)  # in the suffix array; each group fills neighbouring places
        at = order[places]
        follow = np.where(at + step < n, last[np.minimum(at + step, n - 1)] + 1, 0)
        inner = np.lexsort((follow, last[at]))
        at, follow = at[inner], follow[inner]
        order = order.copy()
        order[places] = at
        group = last[at]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        begins = np.flatnonzero(fresh)
        rank = last.copy()
        rank[at] = np.repeat(places[begins], np.diff(np.append(begins, len(at))))
        levels.append(rank)
        step *= 2


def _common(order: np.ndarray, levels: list) -> np.ndarray:
    """Length of the common beginning of each suffix and the one before it in the suffix array."""
    n = len(order)
    one, other = order[1:], order[:-1]
    found = np.zeros(max(0, n - 1), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = one + found, other + found
        inside = (a < n) & (b < n)
        same = inside & (levels[level][np.where(inside, a, 0)] == levels[level][np.where(inside, b, 0)])
        found += same.astype(np.int64) << level
    return found


def _pairs(small: list, large: list, depth: int, left: list, shortest: int, found: dict):
    """Runs from the maximal pairs between two intervals that meet at a depth; both lists are sorted.

    Occurrences of one factor within its length of each other step by its period, but for one at most at each end; all
    of them but the first have the same word on their left. So on the right the search goes on only while words
    differ, then looks at the last; on the left at the first two.
    """
    least = shortest - depth
    for p in small:
        own, middle = left[p], bisect_left(large, p)
        first, end = bisect_left(large, p - depth), bisect_right(large, p + depth)
        hits = [r for r in large[first : min(first + 2, middle)] if left[r] != own]
        k = middle
        while k < end and left[large[k]] != own:
            hits.append(large[k])
            k += 1
        if k < end - 1 and left[large[end - 1]] != own:
            hits.append(large[end - 1])
        for r in hits:
            start, period = (p, r - p) if p < r else (r, p - r)
            if period >= least:
                key = (start, start + period + depth)
                if found.get(key, period) >= period:  # a multiple of the period gives the same stretch
                    found[key] = period


def runs_of(ids: np.ndarray, shortest: int = SHORTEST) -> dict:
    """(start, end): smallest period, of each run in a sequence of word numbers; no number may stand in two documents."""
    found: dict = {}
    if len(ids) < 2:
        return found
    order, levels = _suffixes(ids)
    common = np.append(_common(order, levels), 0)
    del levels
    least = max(1, (shortest + 1) // 2)
    left = [-1, *ids[:-1].tolist()]
    deep = common >= least
    deep[1:] |= deep[:-1]
    stack: list = []  # (depth, positions): intervals still open, each deeper than the one below
    at = np.flatnonzero(deep)
    for position, depth in zip(order[at].tolist(), common[at].tolist()):
        own = [position]
        while stack and stack[-1][0] >= depth:
            deeper, large = stack.pop()
            small, large = (own, large) if len(own) <= len(large) else (large, own)
            _pairs(small, large, deeper, left, shortest, found)
            for p in small:
                insort(large, p)
            own = large
        if depth >= least:
            stack.append((depth, own))
    return found


def _candidates(codes: np.ndarray, doc: np.ndarray, ends: np.ndarray, shortest: int) -> np.ndarray:
    """Documents (numbers) in which some factor of g words recurs within 2 * g words, for one of the lengths g.

    A run of period q repeats max(q, shortest - q) words q words on; g is the largest of the lengths not above that.
    """
    length = max(1, (shortest + 1) // 2)
    at = np.arange(len(codes))
    at = at[at + length <= ends[doc]]
    hashes = gram_hashes(codes, at, length)
    full = np.zeros(len(codes), np.uint64)
    found = [np.zeros(0, np.int64)]
    while len(at):
        key = mix(hashes ^ mix(doc[at].astype(np.uint64) + np.uint64(1)))
        order = np.lexsort((at, key))
        key, at = key[order], at[order]
        same = np.zeros(len(at), bool)
        same[1:] = key[1:] == key[:-1]
        near = same.copy()
        near[1:] &= at[1:] - at[:-1] <= 2 * length
        found.append(doc[at[near]])
        same[:-1] |= same[1:]
        at, hashes = at[same], hashes[order][same]
        full[at] = hashes
        known = np.zeros(len(codes) + 1, bool)  # twice as long: both halves have to recur
        known[at] = True
        at = at[(at + 2 * length <= ends[doc[at]])]
        at = at[known[at + length]]
        hashes = mix(full[at] * np.uint64(0x9E3779B97F4A7C15) + full[at + length])
        length *= 2
    return np.unique(np.concatenate(found))


def _search(held: list, shortest: int):
    """Runs (start, length, period) of each text's words."""
    sizes = np.array([len(words) for words in held], np.int64)
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for words in held for w in words), np.int64, int(sizes.sum()))
    starts, ends = np.cumsum(sizes) - sizes, np.cumsum(sizes)
    doc = np.repeat(np.arange(len(held)), sizes)
    out = [[] for _ in held]
    wanted = _candidates(word_codes(list(known))[ids] if len(ids) else np.zeros(0, np.uint64), doc, ends, shortest)
    if len(wanted):
        picked = np.concatenate([np.arange(starts[d], ends[d]) for d in wanted])
        own = doc[picked] * len(known) + ids[picked]  # words of different documents differ
        for (start, end), period in runs_of(own, shortest).items():
            d = doc[picked[start]]
            out[d].append((int(picked[start] - starts[d]), end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list, runs: list) -> bytes:
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _finder(shortest: int, kept: list):
    def run(batches):
        def out(rows, held):
            found = _search(held, shortest)
            columns = [pa.concat_arrays([row.column(i) for row in rows]) for i in range(len(kept))]
            runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in found], RUNS)
            text = pa.array([_collapsed(words, own) for words, own in zip(held, found)], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(map(len, held)), pa.int64()), runs, text], names=[*kept, "n_words", "runs", "collapsed"])

        rows, held, size = [], [], 0
        for batch in batches:
            texts = texts_of(batch, "__text")
            begin = 0
            for i, text in enumerate(texts):
                held.append((text or b"").split())
                size += len(held[-1])
                if size > HELD_WORDS or i + 1 == len(texts):
                    rows.append(batch.slice(begin, i + 1 - begin))
                    begin = i + 1
                if size > HELD_WORDS:
                    yield out(rows, held)
                    rows, held, size = [], [], 0
        if held:
            yield out(rows, held)

    return run


def find_runs(docs: DataFrame, shortest: int = SHORTEST, text_col: str = "text") -> DataFrame:
    """All columns of docs but the text, and n_words, runs and collapsed.

    runs: start, length and smallest period of each stretch of at least max(shortest, 2 * period) words that no word
    beside it extends, by start, then period. collapsed: the text's words, joined by one space, without those that
    stand in a run after its first period. Words are parted by white space (ASCII) and compared byte by byte. A text
    is searched whole, in one task, in time near to proportional to its length; nothing is shuffled. A null or empty
    text has no words, no runs and an empty collapsed text. Repeated rows and rows without an id come back each; an
    empty table gives no rows. Columns of docs named n_words, runs or collapsed are replaced.
    """
    kept = [c for c in docs.columns if c not in (text_col, "n_words", "runs", "collapsed", "__text")]
    source = docs.select(*[F.col(c) for c in kept], F.col(text_col).alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    schema = ", ".join([*fields, "n_words long", "runs array<struct<start:long,length:long,period:long>>", "collapsed string"])
    return source.mapInArrow(_finder(shortest, kept), schema)
