"""Periodic runs of words: every maximal stretch that repeats three times or more.

A run with period q covers two neighbouring points of the grid of multiples of q, so
testing words q apart on the grid of every q (n ln n points for n words) finds it.
Nearly all points fall at their first words.  At the others the lengths of equal words
forwards and backwards come from longest common extensions over a difference cover:
only suffixes at cover positions are sorted, by blocks of words; two places are moved by
a few compared words to positions both in the cover, their sorted suffixes have a block
length from a sparse table of range minima, and a few more words end it.  Texts stay
where they are read; many short ones are handled at once and nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm import tokens

LEAST_LENGTH = 24
LEAST_REPEATS = 3
#: Positions modulo 31 whose differences are all residues.
COVER_PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
#: Bytes of text handled at once (one text at least), and grid points at a time.
GROUP_BYTES = 1 << 21
GRID_POINTS = 1 << 19
#: Words compared at a grid point before its extension is looked up.
FIRST_WORDS = 6
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _shifts() -> np.ndarray:
    """Per two residues, the least shift that brings both into the cover."""
    inside = np.isin(np.arange(COVER_PERIOD), COVER)
    out = np.zeros((COVER_PERIOD, COVER_PERIOD), np.int64)
    for a in range(COVER_PERIOD):
        for b in range(COVER_PERIOD):
            steps = np.arange(COVER_PERIOD)
            both = inside[(a + steps) % COVER_PERIOD] & inside[(b + steps) % COVER_PERIOD]
            out[a, b] = int(both.argmax())
    return out


class Extensions:
    """Longest common extensions of positions of one word sequence.

    The last word must occur once, so no two suffixes are equal.
    """

    def __init__(self, words: np.ndarray) -> None:
        n, v = len(words), COVER_PERIOD
        self.shifts = _shifts()
        top = int(words.max()) + 1
        self.words = np.concatenate([words, np.arange(top, top + 2 * v)]).astype(np.int32)
        per_residue = [np.arange(r, n, v) for r in COVER]
        places = np.concatenate(per_residue)
        self.first = np.zeros(v, np.int64)
        self.first[list(COVER)] = np.cumsum([0, *map(len, per_residue)])[:-1]
        blocks = np.lib.stride_tricks.sliding_window_view(self.words, v)[places]
        rows = np.ascontiguousarray(blocks).view(np.dtype((np.void, 4 * v))).ravel()
        names = np.unique(rows, return_inverse=True)[1].ravel()
        self._sort(names.astype(np.int64))

    def _sort(self, names: np.ndarray) -> None:
        """Ranks of the sampled suffixes and range minima of their neighbours' blocks."""
        m = len(names)
        levels, step = [names], 1
        while int(levels[-1].max()) + 1 < m:
            behind = np.zeros(m, np.int64)
            behind[: m - step] = levels[-1][step:] + 1
            levels.append(np.unique(levels[-1] * (m + 1) + behind, return_inverse=True)[1].ravel())
            step *= 2
        self.rank = levels[-1]
        order = np.empty(m, np.int64)
        order[self.rank] = np.arange(m)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 1), np.int32)
        for k in reversed(range(len(levels) - 1)):
            inside = np.flatnonzero(np.maximum(a, b) < m)
            same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
            common[same] += 1 << k
            a[same] += 1 << k
            b[same] += 1 << k
        self.minima = [common]
        while 2 << (len(self.minima) - 1) <= len(common):
            half = 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))

    def _equal_words(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words are equal from ``i`` and ``j`` on, at most ``most``."""
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for _ in range(int(most.max()) if len(most) else 0):
            live = live[out[live] < most[live]]
            live = live[self.words[i[live] + out[live]] == self.words[j[live] + out[live]]]
            if not len(live):
                break
            out[live] += 1
        return out

    def query(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from each ``i`` and ``j`` on; they must differ."""
        v = COVER_PERIOD
        shift = self.shifts[i % v, j % v]
        out = self._equal_words(i, j, shift)
        far = np.flatnonzero(out == shift)
        x, y = i[far] + shift[far], j[far] + shift[far]
        # Beyond the last word nothing is sampled; the words themselves differ there.
        within = np.maximum(x, y) < len(self.words) - 2 * v
        far, x, y = far[within], x[within], y[within]
        a, b = self.rank[self.first[x % v] + x // v], self.rank[self.first[y % v] + y // v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        size = np.frexp((high - low).astype(np.float64))[1] - 1
        blocks = np.zeros(len(far), np.int64)
        for k in np.unique(size).tolist():
            at = np.flatnonzero(size == k)
            blocks[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - (1 << k)])
        out[far] += v * blocks
        rest = self._equal_words(x + v * blocks, y + v * blocks, np.full(len(far), v))
        out[far] += rest
        return out


def _grid(starts: np.ndarray, lengths: np.ndarray, least: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, period) of all grid points of texts of ``least`` words or more, in parts."""
    long = np.flatnonzero(lengths >= least)
    periods = lengths[long] // repeats
    text = np.repeat(long, periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (lengths[text] - 1) // period
    sums = np.concatenate([[0], np.cumsum(points)])
    low = 0
    while low < len(text):
        high = max(low + 1, int(np.searchsorted(sums, sums[low] + GRID_POINTS, "right")) - 1)
        for a in range(int(sums[low]), int(sums[high]), GRID_POINTS):
            b = min(a + GRID_POINTS, int(sums[high]))
            which = np.repeat(np.arange(low, high), points[low:high])[a - sums[low] : b - sums[low]]
            q = period[which]
            yield starts[text[which]] + (np.arange(a, b) - sums[which]) * q, q
        low = high


def _survivors(words: np.ndarray, i: np.ndarray, q: np.ndarray, least: int, repeats: int):
    """Grid points whose first words are equal to those one period later."""
    needed = np.maximum(least - 2 * q + 1, (repeats - 2) * q + 1)
    for t in range(FIRST_WORDS):
        last = len(words) - 1
        same = (words[np.minimum(i + t, last)] == words[np.minimum(i + q + t, last)]) | (t >= needed)
        i, q, needed = i[same], q[same], needed[same]
    return i, q, needed


def find(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int = LEAST_LENGTH, repeats: int = LEAST_REPEATS) -> np.ndarray:
    """Rows (start, length, period) of all runs of the texts, by start and period.

    ``words`` holds texts of ``lengths`` from ``starts`` on, each between words that
    occur nowhere else.  A run has the smallest period q, ``least`` words, ``repeats``
    periods, and no neighbouring word extends it.
    """
    hit = np.zeros(len(starts), bool)
    for i, q in _grid(starts, lengths, least, repeats):
        i, _, _ = _survivors(words, i, q, least, repeats)
        hit[np.searchsorted(starts, i, "right") - 1] = True
    if not hit.any():
        return np.zeros((0, 3), np.int64)
    # Only texts with repeats go on, side by side with their unique neighbours.
    kept = np.flatnonzero(hit)
    spans = lengths[kept] + 1
    begin = np.cumsum(spans) - spans
    from_place = np.repeat(starts[kept] - begin, spans) + np.arange(int(spans.sum()))
    own = np.concatenate([words[:1], words[from_place]])
    own = np.unique(own, return_inverse=True)[1].ravel()
    ahead, back = Extensions(own), Extensions(own[::-1])
    found = []
    for i, q in _grid(begin + 1, lengths[kept], least, repeats):
        i, q, needed = _survivors(own, i, q, least, repeats)
        after = ahead.query(i, i + q)
        enough = after >= needed
        i, q, after = i[enough], q[enough], after[enough]
        before = back.query(len(own) - i, len(own) - i - q)
        length = before + q + after
        # Of a run's grid points the first one reports it.
        run = (before < q) & (length >= np.maximum(least, repeats * q))
        found.append(np.stack([i[run] - before[run], length[run], q[run]], axis=1))
    out = np.concatenate(found)
    out = out[np.lexsort((out[:, 2], out[:, 1], out[:, 0]))]
    # The same stretch with a multiple of its smallest period is no run.
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1)
    out = out[fresh]
    text = np.searchsorted(begin + 1, out[:, 0], "right") - 1
    out[:, 0] += starts[kept][text] - begin[text] - 1
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _sequence(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of texts between unique words, with each text's start and length."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
    starts = np.cumsum(lengths + 1) - lengths
    words = np.empty(len(flat) + len(texts) + 1, np.int32)
    words[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(flat))] = flat
    words[np.concatenate([[0], starts + lengths])] = len(numbers) + np.arange(len(texts) + 1)
    return words, starts, lengths


def _scan(least: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, part in tokens.pieces(batch.column("text"), GROUP_BYTES):
                texts = [(t or b"").split() for t in part.cast(pa.large_binary()).to_pylist()]
                words, starts, lengths = _sequence(texts)
                runs = find(words, starts, lengths, least, repeats)
                covered = np.zeros(len(words) + 1, np.int64)
                np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
                np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
                kept = np.cumsum(covered) == 0
                text = np.searchsorted(starts, runs[:, 0], "right") - 1
                counts = np.bincount(text, minlength=len(texts))
                collapsed = [
                    b" ".join(compress(t, kept[s : s + n]) if c else t).decode()
                    for t, s, n, c in zip(texts, starts.tolist(), lengths.tolist(), counts.tolist(), strict=True)
                ]
                columns = [pa.array(runs[:, 0] - starts[text]), pa.array(runs[:, 1].copy()), pa.array(runs[:, 2].copy())]
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(texts)),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, ["start", "length", "period"])),
                        pa.array(collapsed, pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(docs: DataFrame, least: int = LEAST_LENGTH, repeats: int = LEAST_REPEATS) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every row of ``docs``.

    A word is a run of characters other than space and tab to carriage return; letter
    case counts.  ``runs`` holds (start, length, period) in words, by start and period:
    the maximal stretches with smallest period q, ``least`` words and ``repeats`` times q
    words (2 at least).  ``collapsed`` is the text's words joined by single spaces, without those a
    run covers after its first q words.  A null text has no words, no runs and an empty
    collapsed text, as one of white space; repeated rows and null ids are rows like
    others; other columns are ignored; an empty table gives an empty one.  Memory of a
    task grows with its longest text, by about 200 bytes a word.
    """
    if repeats < 2 or least < 2:
        raise ValueError("a run has two periods and two words at least")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(_scan(least, repeats), RUNS)
