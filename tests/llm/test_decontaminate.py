import pickle
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from loanlens.llm import decontaminate, tokens

DOCS = "doc_id long, text string, item_id string, seed int"
ITEMS = "item_id long, text string, at string"


def test_a_row_column_survives_the_shuffle(spark):
    item = " ".join(f"word{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, 7, "x"), (2, "something else", 8, "y")], "doc_id long, text string, row int, _ROW string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for most in (10**6, 0):
        kept = decontaminate.remove_contaminated(docs, items, most)
        assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "something else", 8, "y")]


def data():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(n)), None) for i, n in enumerate([40, 25, 15, 9, 4, 1])]
    items += [(None, "only with null id " + " ".join(word() for _ in range(20)), None), (50, None, None), (51, "", None), (0, items[0][1], None)]
    filler = lambda n: " ".join(word() for _ in range(n))
    whole = items[0][1].split()
    edited = list(whole)
    for at in (6, 13, 20, 27, 34):
        edited[at] = "changed"
    docs = [
        (1, f"{filler(30)} {items[0][1]} {filler(30)}", None, 1),
        (2, f"{filler(5)} {' '.join(edited)} {filler(9)}", None, None),
        (3, f"{filler(80)} {items[2][1].upper().replace(' ', ', ')}!", "x", None),
        (4, filler(300), None, None),
        (5, " ".join(whole[:8]) + " " + filler(50), None, None),
        (6, None, None, None), (7, "", None, None), (8, filler(20) + " " + items[3][1], None, None),
        (None, f"{items[1][1]}", None, None), (1, f"{filler(3)} {items[0][1]}", None, None),
        (9, filler(30_000) + " " + items[1][1] + " " + filler(30_000), None, None),
        (10, " ".join(whole[10:24]), None, None),
    ]
    return docs, items


EXPECTED = {(1, 0), (2, 0), (3, 2), (8, 3), (None, 1), (9, 1), (10, 0)}


@pytest.mark.parametrize("most", [10**6, 0])
def test_overlaps(spark, most):
    docs, items = data()
    out = decontaminate.find_overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), most).collect()
    found = {(r.doc_id, r.item_id) for r in out}
    single = {p for p in found if p[1] != 5 and p[1] != 4}
    assert single == EXPECTED
    for r in out:
        assert r.matched_words >= decontaminate.least_matches(r.item_words)
        assert 0 <= r.overlap_words - r.matched_words <= r.matched_words / 4


@pytest.mark.parametrize("most", [10**6, 0])
def test_clean_rows_stay_unchanged(spark, most):
    docs, items = data()
    frame = spark.createDataFrame(docs, DOCS)
    bench = spark.createDataFrame([i for i in items if i[0] not in (4, 5)], ITEMS)
    kept = decontaminate.remove_contaminated(frame, bench, most)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == sorted((d[0], d[1]) for d in docs if d[0] in (4, 5))
    assert kept.where("text is null or text = ''").count() == 2


def test_empty_sides(spark):
    docs, items = data()
    no_docs, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert decontaminate.find_overlaps(no_docs, spark.createDataFrame(items, ITEMS)).count() == 0
    assert decontaminate.find_overlaps(spark.createDataFrame(docs, DOCS), no_items).count() == 0
    assert decontaminate.remove_contaminated(spark.createDataFrame(docs, DOCS), no_items).count() == len(docs)


def test_any_single_substitution_is_found(spark):
    words = [f"t{i}" for i in range(14)]
    hashes, _ = tokens.word_hashes(pa.array([" ".join(words)]), tokens.PUNCTUATION)
    index = decontaminate.Index([hashes])
    for at in range(14):
        changed = list(words)
        changed[at] = "other"
        doc, _ = tokens.word_hashes(pa.array([" ".join(["x"] * 5 + changed)]), tokens.PUNCTUATION)
        hits = {(int(i), int(p - q)) for place, item, pos in index.hits(doc) for p, i, q in zip(place, item, pos, strict=True)}
        assert list(decontaminate.overlaps(doc, [hashes], hits)), at


def test_stretch_equals_all_stretches():
    rng = np.random.default_rng(3)
    for _ in range(400):
        same = rng.random(rng.integers(1, 45)) < rng.choice([0.6, 0.75, 0.85, 0.95])
        least = int(rng.integers(1, 14))
        all_of = [(i, j, int(same[i:j].sum())) for i in range(len(same)) for j in range(i + 1, len(same) + 1)]
        fit = [(-m, j - i, i) for i, j, m in all_of if m >= least and 5 * m >= 4 * (j - i)]
        found = decontaminate.best_stretch(same, least)
        assert (found is None) == (not fit)
        if fit:
            assert (-found[2], found[1] - found[0], found[0]) == min(fit)


def test_exact_start_of_an_edited_passage_is_found(spark):
    words = [f"t{i}" for i in range(59)]
    text = " ".join("other" if i >= 20 and i % 3 == 1 else w for i, w in enumerate(words))
    docs, items = spark.createDataFrame([(1, text, None, None)], DOCS), spark.createDataFrame([(7, " ".join(words), None)], ITEMS)
    for most in (10**6, 0):
        row = decontaminate.find_overlaps(docs, items, most).first()
        assert row.item_id == 7 and row.matched_words >= 20 and row.matched_words >= 0.8 * row.overlap_words


def leaves_seed(same, masks):
    return any(all(same[s + i] for i, c in enumerate(m) if c == "1") for m in masks for s in range(len(same) - len(m) + 1))


@pytest.mark.parametrize("n", range(1, 17))
def test_every_allowed_pattern_leaves_a_seed(n):
    for misses in range(n - decontaminate.least_matches(n) + 1):
        for gone in combinations(range(n), misses):
            same = np.array([i not in gone for i in range(n)])
            if decontaminate.best_stretch(same, decontaminate.least_matches(n)):
                assert leaves_seed(same, decontaminate.masks_of(n)), gone


def test_no_stretch_of_a_long_item_is_without_a_seed():
    """The best sum of stretches without seeds, by length and last words; longer ones are put together of these."""
    keep = max(map(len, decontaminate.MASKS))
    state = np.arange(1 << keep)
    bad = np.zeros(1 << keep, bool)
    for mask in decontaminate.MASKS:
        bad |= state & int(mask, 2) == int(mask, 2)
    best = np.full(1 << keep, -10_000)
    best[0] = 0
    for length in range(1, 30):
        before = np.maximum(best[state >> 1], best[(state >> 1) | (1 << (keep - 1))])
        best = np.where(bad, -10_000, before + np.where(state & 1, 1, -decontaminate.PENALTY))
        if length >= 15:
            assert best.max() < 0
        elif length >= 12:
            assert (best.max() + 4 * length) / 5 < 12


@pytest.mark.parametrize("most", [10**6, 0])
def test_short_items_with_replaced_words_are_found(spark, most):
    items, docs, expected = [], [], set()
    for n, gone in ((5, [2]), (6, [3]), (7, [2]), (8, [4]), (9, [4]), (10, [2, 6]), (11, [3, 7]), (12, [3, 7])):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words), None))
        docs.append((n, "before " + " ".join("other" if i in gone else w for i, w in enumerate(words)) + " after", None, None))
        docs.append((100 + n, " ".join("other" if i in (0, n // 2, n - 1) else w for i, w in enumerate(words)), None, None))
        expected.add((n, n))
    out = decontaminate.find_overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), most).collect()
    assert {(r.doc_id, r.item_id) for r in out} == expected


def test_the_index_of_a_task_grows_with_the_items():
    rng = np.random.default_rng(5)
    items = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (60, 40, 12, 8, 5, 4, 2, 1)]
    index = decontaminate.Index(items)
    assert len(pickle.dumps(index)) < 200_000  # every task holds it twice while it is unpacked
    for i, words in enumerate(items):
        doc = np.concatenate([rng.integers(0, 1 << 63, 7).astype(np.uint64), words])
        found = {(int(p) - int(a), int(k)) for place, item, at in index.hits(doc) for p, k, a in zip(place, item, at)}
        assert (7, i) in found
    wide = decontaminate.Index([rng.integers(0, 1 << 63, 300_000).astype(np.uint64)])
    assert all(len(bits) == 1 << decontaminate.Index.BITS for *_, bits in wide.tables.values())
