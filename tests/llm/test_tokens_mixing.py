import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlens.llm import mixing, tokens

TEXTS = ["Hello World a", None, "", "  x\ty\x0bz ", "hello", "WORLD hello Écoute", " ", "a" * 9000, "b c " * 3000]


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_word_hashes_match_words():
    hashes, first = tokens.word_hashes(pa.array(TEXTS))
    names = {}
    for i, text in enumerate(TEXTS):
        own = hashes[first[i] : first[i + 1]].tolist()
        assert len(own) == len(words(text))
        for word, value in zip(words(text), own, strict=True):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("size", [1, 3, 5])
def test_shingle_sets_match_tuples(size):
    seen = {}
    for text, found in zip(TEXTS, tokens.shingle_sets(pa.array(TEXTS), size), strict=True):
        w = words(text)
        expected = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
        assert len(found) == len(expected) and (np.diff(found.astype(object)) > 0).all()
        for value in found.tolist():
            seen.setdefault(value, set())
    assert list(tokens.shingle_sets(pa.array([], pa.string()), size)) == []


def test_windows_do_not_depend_on_pieces(monkeypatch):
    texts = pa.array(["a b c d e", "f", "a b c", None] * 50)
    whole = [s.tolist() for s in tokens.shingle_sets(texts, 3)]
    monkeypatch.setattr(tokens, "WINDOW", 16)
    assert [s.tolist() for s in tokens.shingle_sets(texts, 3)] == whole


ROWS = "doc_id long, text string, source string, size string, target string"


def expected_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        free -= set(over)
    return target


def test_targets_and_copies(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 5}", None, "x") for i in range(400)]
    rows += [(None, "a b", None, "9", "y"), (3, "w w w", "s3", None, None), (900, None, "only null", None, None)]
    out = mixing.mix(mixing.with_sizes(spark.createDataFrame(rows, ROWS))).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in out:
        assert r["size"] == len(words(r.text)) and 0 <= r.taken <= 2 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    target = expected_targets(sizes)
    for r in out:
        assert math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-9)
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (math.floor(rate), math.floor(rate) + 1)
    taken = {s: sum(r.taken for r in out if r.source == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= 0.35 * target[s] + 2 for s in sizes)
    again = mixing.mix(mixing.with_sizes(spark.createDataFrame(rows, ROWS).repartition(7))).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_rows_without_id_draw_for_themselves(spark):
    rows = [(None, f"a b {i}", "s", None, None) for i in range(600)] + [(5, f"c d {i}", "t", None, None) for i in range(600)]
    rows += [(10_000 + i, "w " * 30, "u", None, None) for i in range(200)]
    out = mixing.mix(mixing.with_sizes(spark.createDataFrame(rows, ROWS))).collect()
    for source in ("s", "t"):
        taken = sum(r.taken for r in out if r.source == source)
        target = next(r.target for r in out if r.source == source)
        assert abs(taken - target) < 0.1 * target


def test_columns_of_any_name_stay_in_the_mix(spark):
    rows = spark.createDataFrame([(1, "a b", "s", "p", "q", 3)], "doc_id long, text string, source string, _source string, Source_Key string, copy int")
    out = mixing.emit(mixing.mix(mixing.with_sizes(rows)))
    assert [r._source for r in out.collect()] and {"_source", "Source_Key"} <= set(out.columns)
    assert out.columns.count("copy") == 1


def test_emit_repeats(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "doc_id long, copies long")
    assert sorted((r.doc_id, r["copy"]) for r in mixing.emit(rows).collect()) == [(2, 1), (3, 1), (3, 2)]


def test_empty_mix(spark):
    empty = spark.createDataFrame([], ROWS)
    assert mixing.mix(mixing.with_sizes(empty)).count() == 0


def test_shares_agree_with_and_without_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "w " * (i % 9), f"s{i % 40}", None, None) for i in range(500)], ROWS)
    first = mixing.mix(mixing.with_sizes(rows)).groupBy().agg(F.sum("taken")).first()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert mixing.mix(mixing.with_sizes(rows)).groupBy().agg(F.sum("taken")).first() == first


def test_native_plan(spark):
    rows = spark.createDataFrame([(1, "a", "s", None, None)], ROWS)
    plan = mixing.mix(mixing.with_sizes(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
