"""Benchmark passages in documents, found by spaced seeds and verified with substitutions.

A seed is a fixed mask over consecutive words that ignores some positions, so a replaced
word there does not hide a passage.  Hashes of the words a mask keeps are joined between
benchmark items and documents; around each hit the two texts are laid side by side and
the best stretch is scored.

Words are runs of letters, digits and non-ASCII characters, with ``A`` to ``Z``
lower-cased: punctuation never separates a copy from its source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm import tokens
from loanlens.llm.sampling import unused
from loanlens.llm.store import Store

#: Kept (1) and ignored (0) word positions.  Every overlap with an item of 14 words or more
#: leaves a seed of these, whatever words differ.
MASKS = ("111111", "1101100101", "10010111011", "1110010001011", "11101011")
#: With these, every overlap with an item of 10 words or more does.
TWO_MISSES = ("1100011011", "10110111", "11110011")
#: Every overlap with an item of 5 words or more has 5 words of which one differs at most.
ONE_MISS = ("1111", "11011", "10111", "11101")
#: Matching words an overlap needs, or this share of a shorter item; and their share of it.
LEAST_WORDS = 12
LEAST_SHARE = 0.8
#: What a differing word costs against a matching one: a stretch has its share from a sum of 0.
PENALTY = 4
#: Up to so many words of benchmark (about 200 MB of tables) go to every task.
BROADCAST_WORDS = 1_000_000

_HITS = "doc_id long, item_id long, item_words long, matched_words long, doc_word long, item_word long, overlap_words long"
_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "item_id", "item_words", "matched_words", "doc_word", "item_word", "overlap_words")]
)


def masks_of(item_words: int) -> tuple[str, ...]:
    """The masks by which an item of so many words is found; below 5 words none may differ."""
    if item_words < 5:
        return ("1" * item_words,) if item_words else ()
    if item_words < 10:
        return ONE_MISS
    return MASKS if item_words >= LONG else MASKS + TWO_MISSES


#: Items from here on have the same masks.
LONG = 14


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash at every position, none in texts shorter than it."""
    kept = [i for i, c in enumerate(mask) if c == "1"]
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = tokens.stream(int(mask, 2) + 100, len(kept) + 1) | np.uint64(1)
    total = words[kept[0] : kept[0] + n] * factors[0]
    for j, at in enumerate(kept[1:], 1):
        total += words[at : at + n] * factors[j]
    total += factors[len(kept)]
    return tokens.mix(total)


def least_matches(item_words: int) -> int:
    return max(1, min(LEAST_WORDS, int(np.ceil(LEAST_SHARE * item_words))))


def best_stretch(same: np.ndarray, least: int) -> tuple[int, int, int] | None:
    """(start, stop, matches) of the stretch with most matches among all that are an overlap.

    Such a stretch has ``least`` matches and ``LEAST_SHARE`` of its words match; the shortest,
    then first of those with most.  For each end the earliest start whose sum is no larger.
    """
    at = np.flatnonzero(same)
    if len(at) < least:
        return None
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
    start = np.searchsorted(-np.minimum.accumulate(total), -total[at + 1], "left")
    first = np.searchsorted(at, start)
    matches = np.arange(1, len(at) + 1) - first
    if matches.max() < least:
        return None
    length = at + 1 - at[first]
    best = np.lexsort((length, -matches))[0]
    return int(at[first[best]]), int(at[best]) + 1, int(matches[best])


def overlaps(doc: np.ndarray, items: list[np.ndarray], hits: set[tuple[int, int]]) -> Iterator[tuple]:
    """The best verified overlap per item, from hits (item, document minus item position)."""
    best: dict[int, tuple] = {}
    for item, diagonal in sorted(hits):
        words = items[item]
        low, high = max(0, -diagonal), min(len(words), len(doc) - diagonal)
        if high <= low:
            continue
        same = doc[low + diagonal : high + diagonal] == words[low:high]
        found = best_stretch(same, least_matches(len(words)))
        if found is not None and (item not in best or found[2] > best[item][1]):
            start, stop, matches = found
            at = low + start
            best[item] = (len(words), matches, at + diagonal, at, stop - start)
    yield from best.items()


class Index:
    """Seeds of benchmark items in sorted arrays, with a bit table that most words fail.

    Every task holds the tables, as they come and unpacked, so they grow with the items:
    a bit table has 16 to 32 places a seed, at most ``BITS`` of them to the power of two.
    """

    BITS = 22

    def __init__(self, items: list[np.ndarray]) -> None:
        self.items = items
        lists: dict[str, tuple[list, list, list]] = {}
        for i, words in enumerate(items):
            for mask in masks_of(len(words)):
                found = seeds(words, mask)
                if len(found):
                    where = lists.setdefault(mask, ([], [], []))
                    for column, value in zip(where, (found, np.full(len(found), i), np.arange(len(found))), strict=True):
                        column.append(value)
        self.tables = {mask: self._table(where) for mask, where in lists.items()}

    def _table(self, where: tuple[list, list, list]):
        hashes, item, at = (np.concatenate(c) for c in where)
        order = np.argsort(hashes, kind="stable")
        size = min(self.BITS, 4 + len(hashes).bit_length())
        bits = np.zeros(1 << size, bool)
        bits[hashes >> np.uint64(64 - size)] = True
        return hashes[order], item[order], at[order], bits

    def hits(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position in ``words``, item, position in the item) of all equal seeds."""
        for mask, (hashes, item, at, bits) in self.tables.items():
            found = seeds(words, mask)
            size = len(bits).bit_length() - 1
            place = np.flatnonzero(bits[found >> np.uint64(64 - size)])
            low = np.searchsorted(hashes, found[place], "left")
            n = np.searchsorted(hashes, found[place], "right") - low
            if n.sum():
                entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                yield np.repeat(place, n), item[entry], at[entry]


def _scan(index: Index, ids: list):
    """Overlaps of whole documents with the items of an index that every task gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            doc_ids = batch.column("doc_id")
            for start, part in tokens.pieces(batch.column("text")):
                words, first = tokens.word_hashes(part, tokens.PUNCTUATION)
                per_doc: dict[int, set] = {}
                for place, item, at in index.hits(words):
                    doc = np.searchsorted(first, place, "right") - 1
                    rows = zip(doc.tolist(), item.tolist(), (place - first[doc] - at).tolist(), strict=True)
                    for d, i, diagonal in rows:
                        per_doc.setdefault(d, set()).add((i, diagonal))
                for d, hits in per_doc.items():
                    own = words[first[d] : first[d + 1]]
                    doc_id = doc_ids[start + d].as_py()
                    found += [(doc_id, ids[i], *rest) for i, rest in overlaps(own, index.items, hits)]
            yield _batch(found)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SCHEMA)


def _emit_seeds(key: str, out: str, masks: list[str] | None = None):
    """(seed, key, position) rows for the join by shuffle; by an item's own masks if none are given."""
    schema = pa.schema([("seed", pa.int64()), (out, pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            for start, part in tokens.pieces(batch.column("text")):
                words, first = tokens.word_hashes(part, tokens.PUNCTUATION)
                for d in range(len(part)):
                    own = words[first[d] : first[d + 1]]
                    for mask in masks_of(len(own)) if masks is None else masks:
                        found = seeds(own, mask)
                        if len(found):
                            arrays = [
                                pa.array(found.view(np.int64)),
                                pa.array(np.full(len(found), keys[start + d].as_py(), np.int64)),
                                pa.array(np.arange(len(found), dtype=np.int64)),
                            ]
                            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def _verify_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlaps for rows of one document, one item and all their diagonals."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            doc, _ = tokens.word_hashes(pa.array([row["text"]]), tokens.PUNCTUATION)
            item, _ = tokens.word_hashes(pa.array([row["item_text"]]), tokens.PUNCTUATION)
            hits = {(0, d) for d in row["diagonals"]}
            found += [(row["doc_id"], row["item_id"], *rest) for _, rest in overlaps(doc, [item], hits)]
        yield _batch(found)


def _by_shuffle(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same overlaps when the benchmark is too large for every task to hold."""
    store = Store(docs.sparkSession)
    docs = store.put("numbered", docs.withColumn("row", F.monotonically_increasing_id()))
    items = store.put("items", items.withColumn("item", F.monotonically_increasing_id()))
    lengths = items.select(F.least(_word_count(), F.lit(LONG)).alias("n")).distinct().collect()
    masks = sorted({mask for r in lengths for mask in masks_of(r["n"])})
    wanted = items.mapInArrow(_emit_seeds("item", "item"), "seed long, item long, at long")
    there = docs.mapInArrow(_emit_seeds("row", "row", masks), "seed long, row long, at long")
    hits = (
        there.withColumnRenamed("at", "doc_at").join(wanted, "seed")
        .groupBy("row", "item").agg(F.collect_set(F.col("doc_at") - F.col("at")).alias("diagonals"))
    )
    return (
        hits.join(docs, "row").join(items.withColumnRenamed("text", "item_text"), "item")
        .select("doc_id", "text", "item_id", "item_text", "diagonals")
        .mapInArrow(_verify_rows, _HITS)
    )


def _word_count() -> Column:
    return F.regexp_count("text", F.lit(r"[A-Za-z0-9\x80-\x{10FFFF}]+"))


def _index(benchmark: DataFrame, most_words: int) -> tuple[DataFrame, Index | None, list]:
    """The items with text, and their index if it is small enough for every task."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    words = items.agg(F.sum(_word_count())).first()[0]
    if (words or 0) > most_words:
        return items, None, []
    rows = items.collect()
    texts = pa.array([r["text"] for r in rows], pa.string())
    hashes, first = tokens.word_hashes(texts, tokens.PUNCTUATION)
    index = Index([hashes[first[i] : first[i + 1]] for i in range(len(rows))])
    return items, index, [r["item_id"] for r in rows]


def find_overlaps(docs: DataFrame, benchmark: DataFrame, most_words: int = BROADCAST_WORDS) -> DataFrame:
    """One row per document and benchmark item that overlap, the best overlap of each.

    doc_id, item_id, item_words, matched_words, and the overlap's first word in the
    document and in the item and its length (words from 0).  An overlap needs 12
    matching words, or 80 percent of a shorter item, in a stretch of which they make up
    80 percent.  Every such overlap is found: of a shorter item no word may differ below 5
    words, one from 5 to 9, two from 10 to 14.  Null and wordless texts on either side overlap with
    nothing; repeated rows give repeated rows; null ids are kept as null; other columns
    are ignored; empty tables give an empty result.

    Documents are read once and not shuffled while the benchmark has up to
    ``most_words`` words, counted first; beyond, both sides' seeds are joined by shuffle.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    items, index, ids = _index(benchmark, most_words)
    if index is None:
        return _by_shuffle(docs, items)
    return docs.mapInArrow(_scan(index, ids), _HITS)


def _clean(index: Index):
    """The rows whose text overlaps with no item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scan(index, [0] * len(index.items))
        for batch in batches:
            rows = pa.array(range(batch.num_rows), pa.int64())
            numbered = pa.RecordBatch.from_arrays([rows, batch.column("text")], names=["doc_id", "text"])
            keep = np.ones(batch.num_rows, bool)
            for found in scan([numbered]):
                keep[found.column("doc_id").to_numpy()] = False
            yield batch.filter(pa.array(keep))

    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, most_words: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, unchanged.

    Null and wordless texts overlap with nothing and stay; repeated rows stay or go
    together; all columns are kept, whatever their names; an empty benchmark removes
    nothing and an empty table stays empty.
    """
    items, index, _ = _index(benchmark, most_words)
    if index is not None:
        return docs.mapInArrow(_clean(index), docs.schema)
    row = unused("row", docs)
    numbered = Store(docs.sparkSession).put("rows", docs.withColumn(row, F.monotonically_increasing_id()))
    hit = _by_shuffle(numbered.select(F.col(row).alias("doc_id"), "text"), items)
    hit = hit.select(F.col("doc_id").alias(row)).distinct()
    return numbered.join(hit, row, "left_anti").select(*docs.columns)
