import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.llm import forest

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(rows, queries, k):
    valid = [
        (i, np.array(v, dtype=np.float64)) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, v in ((i, v) for i, v in valid if i in queries):
        scored = [(-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), i) for i, w in valid if i != q and len(w) == len(v)]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def vectors(n=600, width=12, seed=2):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, width)).astype(np.float32)
    points[n // 2 :] = points[: n - n // 2] + rng.normal(scale=0.02, size=(n - n // 2, width)).astype(np.float32)
    return [(i, [float(x) for x in p]) for i, p in enumerate(points)]


def test_small_blocks_are_searched_whole(spark):
    rows = vectors()
    rows += [(700, None), (701, [0.0] * 12), (702, [float("nan")] * 12), (703, [None] + [1.0] * 11), (704, [float("inf")] + [0.0] * 11)]
    rows += [(None, rows[0][1]), (710, [1.0, 2.0]), (711, [2.0, 4.1]), (705, rows[0][1]), (706, rows[0][1]), (750, [float(np.float32(3 * x)) for x in rows[50][1]])]
    frame = spark.createDataFrame([(i, v, "x", None) for i, v in rows], SCHEMA)
    out = forest.search(frame, frame.where("vec_id % 50 = 0 or vec_id in (705, 710)"), block_rows=200, block_queries=3).collect()
    queries = {i for i, _ in rows if i is not None and (i % 50 == 0 or i in (705, 710))}
    expected = brute(rows, queries, 5)
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    assert set(found) == {q for q, near in expected.items() if near}
    for q, near in found.items():
        assert [i for i, _ in near] == [i for i, _ in expected[q]]
        assert np.allclose([s for _, s in near], [s for _, s in expected[q]], atol=1e-12)


def test_recall_with_partial_candidates(monkeypatch):
    monkeypatch.setattr(forest, "LEAST", 1)
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3000, 48))
    ids = np.arange(3000)
    out = forest.nearest(points[:60], ids[:60], points, ids, 5)
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    hits = 0
    for q in range(60):
        score = unit @ unit[q]
        score[q] = -2
        hits += len(set(np.argsort(-score)[:5]) & set(out[out["query_id"] == q]["vec_id"]))
    assert hits >= 0.9 * 300


def test_ascent_is_common_to_all_trees():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(500, 8))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    trees = forest.Forest(unit, unit.mean(axis=0), 4, 16, 3)
    keys = trees.strings(unit[:20])
    low, high = trees.runs(keys, 60)
    every = trees.strings(unit)
    for q in range(20):
        lengths = [n for n in range(17) if sum((every[:, t] >> (16 - n) == keys[q, t] >> (16 - n)).sum() for t in range(4)) >= 60]
        n = max(lengths)
        assert [(every[:, t] >> (16 - n) == keys[q, t] >> (16 - n)).sum() for t in range(4)] == (high - low)[q].tolist()


def test_repeated_query_ids_keep_five_neighbours(spark):
    rows = vectors(300)
    repeated = [*rows, rows[50], rows[50], rows[33], (100, rows[7][1])]
    frame = spark.createDataFrame([(i, v, "x", None) for i, v in repeated], SCHEMA)
    out = forest.search(frame, frame.where("vec_id in (50, 100)")).collect()
    expected = brute(rows + [rows[33], (100, rows[7][1])], {50, 100}, 5)
    asked = sorted((r["rank"], r.vec_id) for r in out if r.query_id == 50)
    assert asked == [(k + 1, i) for k, (i, _) in enumerate(expected[50])]
    assert sorted(r["rank"] for r in out if r.query_id == 100) == sorted([1, 2, 3, 4, 5] * 2)
    assert all(r.vec_id != r.query_id for r in out)


def test_recall_of_the_forest_on_the_table(spark, monkeypatch):
    """Without the floor under the share, so that prefixes decide in blocks of 2,000 rows."""
    monkeypatch.setattr(forest, "LEAST", 1)
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    ids, points = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    asked = np.flatnonzero(ids % 50 == 0)
    whole, held = forest.Forest.candidates, []

    def counted(self, unit, want):
        for found in whole(self, unit, want):
            held.append(len(found) / self.n)
            yield found

    monkeypatch.setattr(forest.Forest, "candidates", counted)
    out = forest.nearest(points[asked], ids[asked], points, ids, 5)
    expected = brute(rows, set(ids[asked].tolist()), 5)
    hits = [len(set(out[out["query_id"] == q]["vec_id"]) & {i for i, _ in expected[q]}) for q in ids[asked].tolist()]
    assert np.mean(hits) >= 4.5 and 0.2 < np.mean(held) < 0.6


def test_empty_and_lonely(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(0, [1.0, 0.0], None, None)], SCHEMA)
    assert forest.search(empty, empty).collect() == []
    assert forest.search(one, one).collect() == []
    assert forest.search(one, empty).collect() == []


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_on_the_tables(spark, sf):
    frame = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    out = forest.search(frame, frame.where("vec_id % 50 = 0")).groupBy("query_id").agg(F.collect_set("vec_id").alias("v")).collect()
    rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    expected = brute(rows, {r.query_id for r in out}, 5)
    hits = [len(set(r.v) & {i for i, _ in expected[r.query_id]}) / 5 for r in out]
    assert len(out) == sum(i % 50 == 0 for i, _ in rows) and np.mean(hits) >= 0.9
