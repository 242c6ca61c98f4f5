"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words that repeats with a period at least twice. Neighbours in the
suffix array of a text are joined by their longest common prefix (LCP), longest first.
At LCP m the joined classes hold the places that agree in m words; each keeps its places
in order. When two classes join, places that become neighbours at a distance of m or
less lie in a run of that period, and every run has such a pair at its smallest period.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchflow.llm.common import bind, whole_text, words

MIN_LENGTH = 12
BLOCK = 1024  # places in a block of an ordered set, at most twice as many


class Places:
    """An ordered set of numbers in blocks, so that adding one moves few others."""

    def __init__(self, first: int):
        self.blocks, self.tops, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Add x and return the places before and after it."""
        b = min(bisect_left(self.tops, x), len(self.tops) - 1)
        block = self.blocks[b]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.tops[b - 1] if b else None
        after = block[i] if i < len(block) else None  # only the last block ends below x
        block.insert(i, x)
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[b : b + 1] = [block[:BLOCK], block[BLOCK:]]
            self.tops[b : b + 1] = [block[BLOCK - 1], block[-1]]
        else:
            self.tops[b] = block[-1]
        return before, after


def codes(ws: list) -> np.ndarray:
    """Equal words get equal numbers."""
    of = {w: i for i, w in enumerate(dict.fromkeys(ws))}
    return np.fromiter(map(of.__getitem__, ws), np.int64, len(ws))


def shares(text: np.ndarray, width: int) -> bool:
    """Whether `width` consecutive words may occur twice: never False when they do."""
    if len(text) <= width:
        return False
    n = len(text) - width + 1
    mixed = np.zeros(n, np.uint64)
    mask = (1 << 64) - 1
    for i in range(width):
        mixed += (text[i : i + n].astype(np.uint64) + np.uint64(1)) * np.uint64(pow(0x9E3779B97F4A7C15, i + 1, mask + 1))
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and the LCP of every suffix with the one before it (first: 0), by doubled prefixes."""
    n = len(text)
    ranks, width = [np.unique(text, return_inverse=True)[1]], 1
    while width < n and ranks[-1].max() < n - 1:
        after = np.zeros(n, np.int64)
        after[:-width] = ranks[-1][width:] + 1
        ranks.append(np.unique(ranks[-1] * (n + 1) + after, return_inverse=True)[1])
        width *= 2
    order = np.argsort(ranks[-1])
    lcp = np.zeros(n, np.int64)
    # Greedy from the longest prefixes on; places past the end share nothing.
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        same = np.flatnonzero((a < n) & (b < n))
        same = same[(ranks[k][a[same]] == ranks[k][b[same]]) & (np.maximum(a[same], b[same]) + (1 << k) <= n)]
        lcp[same + 1] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, lcp


def _left(text: np.ndarray, start: int, period: int) -> int:
    """The smallest start from which the period holds up to `start`."""
    step = 16
    while start > 0:
        lo = max(0, start - step)
        differ = np.flatnonzero(text[lo:start] != text[lo + period : start + period])
        if len(differ):
            return lo + int(differ[-1]) + 1
        start, step = lo, step * 2
    return start


def seeds(text: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(place, period, end): pairs of places a period apart that become neighbours at an LCP of at least `least` and the period."""
    order, lcp = suffixes(text)
    joins = np.flatnonzero(lcp >= least)
    joins = joins[np.argsort(-lcp[joins], kind="stable")]
    above, sets = {}, {}

    def top(x: int) -> int:
        root = x
        while root in above:
            root = above[root]
        while x != root:
            above[x], x = root, above[x]
        return root

    for j, m in zip(joins.tolist(), lcp[joins].tolist(), strict=True):
        a, b = top(int(order[j - 1])), top(int(order[j]))
        large, small = sets.pop(a, None) or Places(a), sets.pop(b, None) or Places(b)
        if large.size < small.size:
            large, small, a, b = small, large, b, a
        added = set()
        for x in small:
            before, after = large.add(x)
            # Neighbours from one class met before; their common prefix may be longer than m.
            if before is not None and before not in added and x - before <= m:
                yield before, x - before, x + m
            if after is not None and after - x <= m:
                yield x, after - x, after + m
            added.add(x)
        above[b], sets[a] = a, large


def runs(text: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, sorted; text as numbers.

    Of a run of length n and period q, two places q apart share n - q words: half of the
    least length or more.
    """
    least = (min_length + 1) // 2
    if not shares(text, least):
        return []
    found: dict[tuple[int, int], int] = {}
    for place, period, end in seeds(text, least):
        # A run is known by its period and end.
        if (end, period) not in found:
            found[end, period] = _left(text, place, period)
    smallest: dict[tuple[int, int], int] = {}
    for (end, period), start in found.items():
        if end - start >= max(min_length, 2 * period):
            smallest[start, end] = min(period, smallest.get((start, end), period))
    return sorted((start, end - start, period) for (start, end), period in smallest.items())


def collapsed(ws: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not found:
        return ws
    depth = np.zeros(len(ws) + 1, np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [ws[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed): one row for each row of docs, without a shuffle.

    runs: array of (start, length, period) in order; a run has the smallest period that
    its words have, at least min_length words and two periods, and can't be made longer.
    collapsed: the words that are left when every run keeps its first period alone,
    joined by one space. Words are what lies between the blanks 9 to 13 and 32. Null and
    empty texts have no words; ids may repeat or be null; other columns of docs are not
    read; an empty table gives an empty result. A task holds one text and, for a text
    with repeats, its suffix ranks (8 bytes a word for each doubling).
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, every, left = [], [], []
            for text in b.column(1).cast(pa.binary()):
                # Bytes split at the blanks 9 to 13 and 32 alone.
                ws = text.as_py().split()
                found = runs(codes(ws), min_length)
                n.append(len(ws))
                every.append([{"start": s, "length": k, "period": p} for s, k, p in found])
                left.append(b" ".join(collapsed(ws, found)))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(every, run_type), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n_words", "runs", "collapsed"])

    lean = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    schema = f"id {id_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return lean.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def longest(found: Column) -> Column:
    """The run of greatest length; ties: smallest start, then period. Null without runs."""
    # Runs are in order, so the first of those with the greatest length.
    most = F.array_max(F.transform(found, lambda r: r["length"]))
    return F.get(F.filter(found, lambda r: r["length"] == most), F.lit(0))


def runs_text(found: Column) -> Column:
    """`start,length,period` and a line feed for every run."""
    return F.array_join(F.transform(found, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The text; for a tenth of the ids, by crc32, it goes on with a period from one of its words on.

    h = crc32(id), g = floor(h / 10); if h % 10 = 0, each word i >= a of n becomes word
    a + (i - a) % p with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Rows
    without an id stay as they are.
    """

    def periodic(ws: Column) -> Column:
        n, g = F.size(ws), F.floor(F.crc32(doc_id.cast("string")) / 10)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(ws, place(i))), " ")).otherwise(F.lit(""))

    return F.when(F.crc32(doc_id.cast("string")) % 10 == 0, bind(words(text), periodic)).otherwise(text)
