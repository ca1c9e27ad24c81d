"""Periodic runs of words: stretches that repeat themselves, found by longest common extensions.

A run is a stretch with smallest period q, at least `LEAST` words and three periods long, that cannot be extended.

1. A run of period p holds a stretch of at least `max(24, 3p) - p` words that equal the word p behind them, so one of them
   lies on the grid of that step. Over all periods the grids are a harmonic sum: about n log n / 2 points for n words.
2. From each point whose word repeats, the run extends forwards and backwards by the longest common extension (LCE) of the
   suffixes at the point and p behind it, and likewise of the reversed words.
3. An LCE takes the next place where both suffixes are sampled by a difference cover modulo `MODULUS` (one is always less
   than `MODULUS` words away), compares the words up to there, takes the number of equal blocks of `MODULUS` words behind
   it from the sorted samples, by a range minimum over the neighbours' common blocks, and compares the words of the last
   block. Only sampled suffixes are sorted, by doubling; the range minima are a sparse table.
4. A run whose stretch has a divisor of its period as a period is not the smallest one and goes.

Documents are worked on in slices of a few MB, all documents of a slice at once; words are 64-bit hashes. Nothing is
shuffled, and memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogeval.llm import batches

LEAST = 24
PERIODS = 3
# A difference cover: every difference modulo MODULUS is one between two of these.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)
# A point with fewer equal words on both sides is in no run: the shortest stretch has twice as many.
NEAR = 8
# Grid points worked on at a time.
POINTS = 1 << 20

SCHEMA = (
    "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>,"
    " best struct<start:bigint,length:bigint,period:bigint>, collapsed string"
)


def _first_of_cover() -> np.ndarray:
    """For each difference d the element c of the cover for which c + d is in the cover too."""
    first = np.full(MODULUS, -1)
    for c in COVER:
        first[(np.array(COVER) - c) % MODULUS] = c
    return first


FIRST = _first_of_cover()


class Extensions:
    """Longest common extensions of positions of one text of words in which no stretch crosses a unique mark."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * MODULUS, words.dtype)])
        sampled = np.isin(np.arange(n) % MODULUS, COVER)
        place = np.flatnonzero(sampled)
        at = np.full(n + MODULUS, -1, np.int64)
        at[place] = np.arange(len(place))
        behind = at[place + MODULUS]  # the sample one block later, or -1
        begin = place
        _, rank = np.unique(
            batches.run_hashes(self.words, begin, begin + MODULUS, 5), return_inverse=True
        )
        # ranks[k] orders samples by their next 2**k blocks; hops[k] is the sample so many blocks later.
        ranks, hops = [rank], [behind]
        while len(place) and ranks[-1].max() + 1 < len(place):
            rank, hop = ranks[-1], hops[-1]
            far = np.where(hop >= 0, rank[hop], -1)
            _, deeper = np.unique(rank.astype(np.int64) * (len(place) + 1) + far + 1, return_inverse=True)
            ranks.append(deeper)
            hops.append(np.where(hop >= 0, hop[hop], -1))
        self.at, self.rank = at, ranks[-1]
        order = np.argsort(self.rank)
        a, b = order[:-1], order[1:]
        common = np.zeros(len(a), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            both = np.flatnonzero((a >= 0) & (b >= 0))
            same = both[ranks[k][a[both]] == ranks[k][b[both]]]
            common[same] += 1 << k
            a, b = a.copy(), b.copy()
            a[same], b[same] = hops[k][a[same]], hops[k][b[same]]
        self.minima = [common]
        while 2 << (len(self.minima) - 1) <= len(common):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def _blocks(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal blocks behind the sampled positions i and j."""
        a, b = self.rank[self.at[i]], self.rank[self.at[j]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.log2(hi - lo).astype(np.int64)
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            table = self.minima[k]
            out[own] = np.minimum(table[lo[own]], table[hi[own] - (1 << k)])
        return out

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, up to `most`."""
        out = np.zeros(len(i), np.int64)
        left = np.flatnonzero(most > 0)
        while len(left):
            left = left[self.words[i[left] + out[left]] == self.words[j[left] + out[left]]]
            out[left] += 1
            left = left[out[left] < most[left]]
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and j > i on."""
        step = (FIRST[(j - i) % MODULUS] - i) % MODULUS
        out = self._compare(i, j, step)
        on = np.flatnonzero(out == step)
        x, y = i[on] + step[on], j[on] + step[on]
        jump = self._blocks(x, y) * MODULUS
        out[on] += jump + self._compare(x + jump, y + jump, np.full(len(on), MODULUS))
        return out


def _points(first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of grid points: row, period, word."""
    size = np.diff(first)
    rows = np.flatnonzero(size >= LEAST)
    most = size[rows] // PERIODS
    # Blocks of (row, period) pairs, so that their list stays small as well.
    upto = np.concatenate([[0], np.cumsum(most)])
    for begin in range(0, int(upto[-1]), POINTS):
        pair = np.arange(begin, min(begin + POINTS, int(upto[-1])))
        which = np.searchsorted(upto, pair, side="right") - 1
        row, period = rows[which], pair - upto[which] + 1
        step = np.maximum(LEAST, PERIODS * period) - period
        count = (size[row] - period - 1) // step + 1
        total = np.concatenate([[0], np.cumsum(count)])
        lo = 0
        while lo < len(pair):
            hi = max(int(np.searchsorted(total, total[lo] + POINTS, side="right")) - 1, lo + 1)
            many = count[lo:hi]
            k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            r = np.repeat(row[lo:hi], many)
            yield r, np.repeat(period[lo:hi], many), first[r] + k * np.repeat(step[lo:hi], many)
            lo = hi


def _equal_near(hashes: np.ndarray, first: np.ndarray, row, period, word) -> np.ndarray:
    """Which points have NEAR equal words from them on, or before and with them."""
    keep = np.zeros(len(word), bool)
    for way in (1, -1):
        left = np.arange(len(word))
        for t in range(NEAR):
            at = word[left] + way * t
            other = at + period[left]
            inside = other < first[row[left] + 1] if way > 0 else at >= first[row[left]]
            left, at, other = left[inside], at[inside], other[inside]
            left = left[hashes[at] == hashes[other]]
        keep[left] = True
    return keep


def _prime_factors(n: int) -> list[int]:
    found, f = [], 2
    while f * f <= n:
        if n % f == 0:
            found.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return found + [n] * (n > 1)


def find_runs(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(row, start, length, period) of all runs of the rows `hashes[first[r]:first[r + 1]]`, sorted."""
    rows, periods, places = [], [], []
    for row, period, word in _points(first):
        same = np.flatnonzero(hashes[word] == hashes[word + period])
        row, period, word = row[same], period[same], word[same]
        near = _equal_near(hashes, first, row, period, word)
        rows.append(row[near])
        periods.append(period[near])
        places.append(word[near])
    none = np.zeros((0, 4), np.int64)
    if not sum(map(len, rows)):
        return none
    row, period, word = (np.concatenate(x).astype(np.int64) for x in (rows, periods, places))

    # The rows in question, between marks that equal no word and no other mark.
    own, index = np.unique(row, return_inverse=True)
    size = first[own + 1] - first[own]
    begin = np.cumsum(size + 1) - size
    total = int((size + 1).sum()) + 1
    marks = np.append(begin - 1, total - 1)
    inside = np.ones(total, bool)
    inside[marks] = False
    take = np.arange(total - len(marks)) - np.repeat(begin - np.arange(len(own)) - 1 - first[own], size)
    # Words are numbered, marks go on behind them.
    _, numbered = np.unique(hashes[take], return_inverse=True)
    text = np.empty(total, np.uint64)
    text[inside] = numbered
    text[marks] = len(numbered) + 1 + np.arange(len(marks))
    i = begin[index] + word - first[row]
    ahead, back = Extensions(text), Extensions(text[::-1])

    found = []
    for lo in range(0, len(i), POINTS):
        at, p, k = i[lo : lo + POINTS], period[lo : lo + POINTS], index[lo : lo + POINTS]
        end = at + p + ahead.lce(at, at + p)
        start = at - back.lce(total - at - p, total - at)
        long = np.flatnonzero(end - start >= np.maximum(LEAST, PERIODS * p))
        found.append(np.unique(np.stack([k, start, end, p], 1)[long], axis=0))
    k, start, end, p = np.unique(np.concatenate(found), axis=0).T
    smallest = np.ones(len(p), bool)
    for q in np.unique(p).tolist():
        with_q = np.flatnonzero(p == q)
        for f in _prime_factors(q):
            d = q // f
            smallest[with_q] &= ahead.lce(start[with_q], start[with_q] + d) < end[with_q] - start[with_q] - d
    out = np.stack([own[k], start - begin[k], end - start, p], 1)[smallest]
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of the greatest exact length / period; of equal ones the first, then the one of the smallest period."""
    best = runs[0]
    for run in runs[1:]:
        ahead = run[1] * best[2] - best[1] * run[2]
        if ahead > 0 or ahead == 0 and (run[0], run[2]) < (best[0], best[2]):
            best = run
    return best


def _case_table() -> np.ndarray:
    table = batches.byte_table(batches.WHITE_SPACE)
    table[65:91] = np.arange(65, 91)
    return table


def _joined(data: np.ndarray, offsets: np.ndarray, found: batches.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(found.first))[keep]
    start, end = found.start[keep], found.end[keep]
    follows = np.zeros(len(row), bool)
    follows[:-1] = row[1:] == row[:-1]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    shown = np.cumsum(inside[:-1]).astype(bool)
    out = data.copy()
    # A word that another one follows has a separator behind it.
    out[end[follows]] = 32
    shown[end[follows]] = True
    ends = np.concatenate([[0], np.cumsum(shown)])[offsets]
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out[shown])]
    ).cast(pa.string())


def _scan(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, run = _case_table(), pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in stream:
        for lo, hi, data, offsets in batches.slices(batch.column(1)):
            found = batches.words(data, offsets, table)
            runs = find_runs(found.hashes, found.first)
            row, start, length, period = runs.T
            # A word goes that a run covers behind its first period.
            cover = np.zeros(len(found.hashes) + 1, np.int64)
            np.add.at(cover, found.first[row] + start + period, 1)
            np.add.at(cover, found.first[row] + start + length, -1)
            keep = np.cumsum(cover[:-1]) == 0
            bounds = np.searchsorted(row, np.arange(hi - lo + 1))
            best = [None] * (hi - lo)
            for r in np.unique(row).tolist():
                best[r] = dict(zip(("start", "length", "period"), _best([tuple(x) for x in runs[bounds[r] : bounds[r + 1], 1:].tolist()]), strict=True))
            values = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(run))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(np.diff(found.first)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values),
                    pa.array(best, run),
                    _joined(data, offsets, found, keep),
                ],
                ["doc_id", "n_words", "runs", "best", "collapsed"],
            )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its number of words, its runs by start and period, the best run, and the
    text without the words that a run repeats, joined by one space.

    Words are `[^\\x20\\x09-\\x0D]+` and compared as they are. The best run has the greatest length in periods; ties go to
    the smallest start, then period. NULL and empty texts have no words and no runs, and their collapsed text is empty.
    Repeated rows and NULL ids keep their rows. No documents give no rows. Other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_scan, SCHEMA)
