"""Packing token sequences into windows by the sum-of-squares rule.

A document is tokenised and ended by one id; its full windows stand alone and the rest
is placed online: of all fill levels with room (and a new window), the one that leaves
the least sum of squared counts of partially filled windows, read off one array of
counts per level.  Each task packs the rows it reads and nothing is shuffled.  At its
end the windows still open fill each other up by cuts, and the last one is written
as sequences whose lengths are powers of two, so no window is padded.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm import tokens

WINDOW = 1024
END = 0
#: Open windows of a task; when there are more they fill each other up at once.
MOST_OPEN = 4096
#: Bytes of text tokenised at once; slots of the table of known chunks; ids it may hold.
SLICE = 1 << 22
SLOTS = 1 << 20
MOST_IDS = 1 << 23
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)

#: How byte-level tokenizer files cut a text before they merge bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes that such files write as themselves, others as 256 and up in order.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
# The last byte, and the one before, of white space beyond ASCII.
_LATE_BLANK, _BEFORE_BLANK = np.zeros(256, bool), np.zeros(256, bool)
_LATE_BLANK[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_BEFORE_BLANK[[0x80, 0x81, 0x9A, 0xC2]] = True
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _ranks(path: str) -> dict[bytes, int]:
    """Bytes and id of every token of a byte-level BPE file whose ids are merge ranks."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    if content["normalizer"] or content["pre_tokenizer"] != {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
    }:
        raise ValueError(f"not a plain byte-level tokenizer: {path}")
    rest = [b for b in range(256) if b not in set(PRINTED)]
    byte = {chr(b): b for b in PRINTED} | {chr(256 + k): b for k, b in enumerate(rest)}
    vocabulary = content["model"]["vocab"]
    merged = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
    places = [vocabulary["".join(pair)] for pair in merged]
    if any(a >= b for a, b in zip(places, places[1:], strict=False)):
        raise ValueError(f"ids are not in the order of merges: {path}")
    special = {token["content"] for token in content["added_tokens"]}
    return {bytes(byte[c] for c in token): k for token, k in vocabulary.items() if token not in special}


class Encoder:
    """Ids of texts by a tokenizer file; special tokens in a text are ordinary text.

    A text may be cut between a character that is no white space and a space, since the
    pattern cuts there whatever comes before and after.  The bytes of such a chunk, up
    to 16, are looked up as two integers in a table of chunks whose ids are known, all
    chunks of many texts at once; only those not found are merged byte by byte.
    """

    def __init__(self, path: str) -> None:
        ranks = _ranks(path)
        self.merge = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            self.widths[k] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.low, self.high = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.size, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.at = np.zeros(SLOTS, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _append(self, ids: np.ndarray) -> int:
        """Place of ``ids`` among all known ids."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        self.flat[at : self.used] = ids
        return at

    def _merge(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and counts of the ids of chunks that can be joined to one text."""
        sizes = ends - starts
        before = np.cumsum(sizes) - sizes
        joined = raw[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
        ids = np.array(self.merge.encode_ordinary(joined.tobytes().decode()), np.uint32)
        reached = np.concatenate([[0], np.cumsum(self.widths[ids])])
        first = np.searchsorted(reached, before)
        return self._append(ids) + first, np.diff(np.append(first, len(ids)))

    def _window(self, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all bytes, and per place in ``begins`` (the first is 0) the ids before it."""
        if self.used > MOST_IDS:
            self._forget()
        cut = _cuts(raw)
        cut[begins[begins < len(raw)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(raw))
        sizes = ends - starts
        padded = np.concatenate([raw, np.zeros(16, np.uint8)])
        eight = np.ndarray((len(raw) + 9,), "<u8", padded.tobytes(), strides=(1,))
        low = eight[starts] & _KEPT[np.minimum(sizes, 8)]
        high = eight[np.minimum(starts + 8, len(raw))] & _KEPT[np.clip(sizes - 8, 0, 8)]
        slot = (tokens.mix(low ^ tokens.mix(high + sizes.astype(np.uint64))) % np.uint64(SLOTS)).astype(np.int64)
        at, count = self.at[slot], self.count[slot]
        known = (self.low[slot] == low) & (self.high[slot] == high) & (self.size[slot] == sizes)
        plain = (raw[starts] == 32) & _solid(raw, ends - 1) & (sizes <= 16)

        fresh = np.flatnonzero(plain & ~known)
        order = fresh[np.lexsort((sizes[fresh], high[fresh], low[fresh]))]
        other = np.ones(len(order), bool)
        other[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0) | (np.diff(sizes[order]) != 0)
        first = order[other]
        if len(first):
            places, counts = self._merge(raw, starts[first], ends[first])
            which = np.cumsum(other) - 1
            at[order], count[order] = places[which], counts[which]
            into = slot[first]
            self.low[into], self.high[into], self.size[into] = low[first], high[first], sizes[first]
            self.at[into], self.count[into] = places, counts
            # Of several chunks with one slot, each column holds the last one's value.
        for i in np.flatnonzero(~plain).tolist():
            ids = self.merge.encode_ordinary(raw[starts[i] : ends[i]].tobytes().decode())
            at[i], count[i] = self._append(np.array(ids, np.uint32)), len(ids)
        total = np.concatenate([[0], np.cumsum(count)])
        place = np.repeat(at - total[:-1], count) + np.arange(int(total[-1]))
        return self.flat[place], total[np.searchsorted(starts, begins)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null is empty), and where each one's begin, and their end."""
        raw, offsets = tokens.text_bytes(texts)
        parts, bounds, low, held = [], np.zeros(len(offsets), np.int64), 0, 0
        while low < len(raw):
            high = _next_cut(raw, offsets, low + SLICE)
            inside = np.flatnonzero((offsets >= low) & (offsets < high))
            begins = np.append(offsets[inside], low) - low
            ids, before = self._window(raw[low:high], begins)
            bounds[inside] = held + before[:-1]
            parts.append(ids)
            held += len(ids)
            low = high
        bounds[offsets >= len(raw)] = held
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), bounds


def _solid(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bytes at ``at`` surely end a character that is no white space."""
    last, before = raw[at], raw[np.maximum(at - 1, 0)]
    return ~(_BLANK[last] | (_LATE_BLANK[last] & _BEFORE_BLANK[before]))


def _cuts(raw: np.ndarray) -> np.ndarray:
    """Whether a chunk may begin at each byte, a space behind something else."""
    out = raw == 32
    places = np.flatnonzero(out)
    places = places[places > 0]
    out[places] = _solid(raw, places - 1)
    out[:1] = True
    return out


def _next_cut(raw: np.ndarray, offsets: np.ndarray, at: int) -> int:
    """The next place from ``at`` on where a text ends or may be cut."""
    if at >= len(raw):
        return len(raw)
    end = int(offsets[np.searchsorted(offsets, at)])
    while at < end:
        found = np.flatnonzero(_cuts(raw[at - 4 : min(at + SLICE, end)])[4:])
        if len(found):
            return at + int(found[0])
        at = min(at + SLICE, end)
    return end


class Packer:
    """Windows of one task.  ``done`` collects the pieces of closed windows.

    A piece is (doc_id, start, ids, doc_tokens).
    """

    def __init__(self, window: int, first_id: int, most_open: int) -> None:
        self.window, self.next_id, self.most_open = window, first_id, most_open
        self.done: list[tuple] = []
        self.open: list[list[list[tuple]]] = [[] for _ in range(window)]
        self.count = 0
        # Change of the sum of squares when a window comes to a level, or leaves one.
        self.comes = np.ones(window + 1, np.int64)
        self.comes[window] = 0
        self.never = np.iinfo(np.int64).max // 4
        self.leaves = np.full(window + 1, self.never, np.int64)
        self.leaves[0] = 0

    def _changed(self, level: int, by: int) -> None:
        self.count += by
        n = len(self.open[level])
        self.comes[level] = 2 * n + 1
        self.leaves[level] = 1 - 2 * n if n else self.never

    def level_for(self, length: int) -> int:
        """The level to place ``length`` ids on, 0 a new window; the fullest of ties."""
        change = self.leaves[: self.window - length + 1] + self.comes[length:]
        return self.window - length - int(change[::-1].argmin())

    def close(self, pieces: list[tuple]) -> None:
        """A window is complete: its pieces get its id and their places."""
        offset = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, len(ids), ids.tobytes(), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def _keep(self, level: int, pieces: list[tuple]) -> None:
        self.open[level].append(pieces)
        self._changed(level, 1)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total = len(ids)
        rest = total - total % self.window
        for start in range(0, rest, self.window):
            self.close([(doc, start, ids[start : start + self.window], total)])
        if rest == total:
            return
        piece = (doc, rest, ids[rest:].copy(), total)
        level = self.level_for(total - rest)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self._changed(level, -1)
        pieces.append(piece)
        level += total - rest
        if level == self.window:
            self.close(pieces)
        else:
            self._keep(level, pieces)
            if self.count > self.most_open:
                self.fill_up()

    def fill_up(self) -> None:
        """The fullest open windows take the pieces of the emptiest; one stays open."""
        queue = [(level, p) for level in range(1, self.window) for p in self.open[level]]
        for level in range(1, self.window):
            held = len(self.open[level])
            self.open[level] = []
            self._changed(level, -held)
        low, high = 0, len(queue) - 1
        while low < high:
            level, pieces = queue[high]
            room = self.window - level
            while room and low < high:
                given, donor = queue[low]
                doc, start, ids, total = donor.pop()
                taken = ids[:room]
                pieces.append((doc, start, taken, total))
                room -= len(taken)
                if len(taken) < len(ids):
                    donor.append((doc, start + len(taken), ids[len(taken) :], total))
                queue[low] = (given - len(taken), donor)
                low += not donor
            if room:
                queue[high] = (self.window - room, pieces)
            else:
                self.close(pieces)
                high -= 1
        if low == high:
            self._keep(*queue[low])

    def finish(self) -> None:
        """The last open window becomes sequences whose lengths are powers of two."""
        self.fill_up()
        for pieces in (p for held in self.open for p in held):
            ids = np.concatenate([p[2] for p in pieces])
            at = 0
            for bit in reversed(range(len(ids).bit_length())):
                if len(ids) >> bit & 1:
                    self.close(_cut(pieces, at, at + (1 << bit)))
                    at += 1 << bit
        self.open = [[] for _ in range(self.window)]


def _cut(pieces: list[tuple], low: int, high: int) -> list[tuple]:
    """What lies from ``low`` to ``high`` of consecutive pieces."""
    out, at = [], 0
    for doc, start, ids, total in pieces:
        a, b = max(low - at, 0), min(high - at, len(ids))
        if a < b:
            out.append((doc, start + a, ids[a:b], total))
        at += len(ids)
    return out


def _pack(shared: Broadcast, path: str, window: int, end: int, most_open: int):
    """``shared`` is a broadcast dict, in which each Python worker keeps its encoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
             ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
        )
        encoder = shared.value.get(path) or shared.value.setdefault(path, Encoder(path))
        packer = Packer(window, TaskContext.get().partitionId() << 40, most_open)
        last = np.array([end], np.uint32)

        def ready() -> pa.RecordBatch:
            columns = zip(*packer.done, strict=True) if packer.done else [[]] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            packer.done = []
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, part in tokens.pieces(batch.column("text"), SLICE):
                ids, bounds = encoder.encode(part)
                for k in range(len(part)):
                    packer.add(names[first + k], np.concatenate([ids[bounds[k] : bounds[k + 1]], last]))
                yield ready()
        packer.finish()
        yield ready()

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END, most_open: int = MOST_OPEN
) -> DataFrame:
    """Pieces of sequences of at most ``window`` ids that hold all of ``docs``.

    Per piece: doc_id, start (ids of its document before it), length, ids (little-endian
    unsigned 32-bit), doc_tokens (with the id ``end`` behind every document),
    sequence_id and offset therein.  Each id lies in one piece and a sequence has no
    gaps; it is full, or its length is a power of two.  A null text is an empty one,
    which has just its end; repeated rows and null ids are packed as rows of their own;
    other columns are ignored; an empty table gives an empty result.

    ``tokenizer_path`` names a byte-level tokenizer file that exists on every
    executor.  Sequence ids hold the number of the task and are unique; rows read again
    in the same order are packed alike, so a task that is repeated after a lost executor
    gives the same pieces.  A task holds at most ``most_open`` open windows.
    """
    if window < 2:
        raise ValueError("a window holds two ids at least")
    shared = docs.sparkSession.sparkContext.broadcast({})
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(_pack(shared, tokenizer_path, window, end, most_open), PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids in order: a sequence's pieces joined, at most a window."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return pieces.groupBy("sequence_id").agg(ordered.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b""), lambda held, p: F.concat(held, p["ids"])).alias("ids"),
        F.transform("p", lambda p: p["doc_id"]).alias("doc_ids"),
    )
