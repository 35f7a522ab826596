"""Periodic runs against brute force: extensions, runs, and the operator's rows."""

import random
import re

import numpy as np
import pytest

from loanlens.llm import runs


def brute_runs(words, least=24, repeats=3):
    """All maximal stretches by their definition, smallest periods only."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - i
            if length >= max(least, repeats * q):
                found.setdefault((i, length), q)
            i = end
    return sorted((s, m, q) for (s, m), q in found.items())


def brute_collapse(words, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts(seed, count):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        words = []
        for _ in range(rng.randrange(1, 6)):
            unit = rng.choices("abcd" if rng.random() < 0.7 else "ab", k=rng.randrange(1, 12))
            words += unit * rng.randrange(1, 14) + rng.choices("abcd", k=rng.randrange(4))
        out.append(" ".join(words))
    return out


def test_cover_has_all_differences():
    differences = {(a - b) % runs.COVER_PERIOD for a in runs.COVER for b in runs.COVER}
    assert differences == set(range(runs.COVER_PERIOD))


@pytest.mark.parametrize("letters,n", [(1, 300), (2, 700), (3, 64), (1, 2), (40, 500)])
def test_extensions_are_those_of_a_plain_loop(letters, n):
    rng = np.random.default_rng(letters)
    words = np.append(rng.integers(0, letters, n - 1), letters + 5)
    if letters == 2:
        words[200:500] = np.tile(words[:50], 6)
    i, j = rng.integers(0, n, 3000), rng.integers(0, n, 3000)
    i, j = i[i != j], j[i != j]

    def common(a, b):
        k = 0
        while max(a, b) + k < n and words[a + k] == words[b + k]:
            k += 1
        return k

    assert runs.Extensions(words).query(i, j).tolist() == [common(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True)]


@pytest.mark.parametrize("least,repeats", [(24, 3), (2, 2), (5, 4), (24, 2)])
def test_runs_equal_brute_force(monkeypatch, least, repeats):
    monkeypatch.setattr(runs, "GRID_POINTS", 97)
    rows = [split(t) for t in texts(least * repeats, 150)] + [[], ["a"], ["a"] * 200, ["a", "b"] * 100]
    rows = [[w.encode() for w in r] for r in rows]
    words, starts, lengths = runs._sequence(rows)
    found = runs.find(words, starts, lengths, least, repeats)
    expected = [(s + int(o), m, q) for r, o in zip(rows, starts, strict=True) for s, m, q in brute_runs(r, least, repeats)]
    assert [tuple(r) for r in found.tolist()] == expected and expected


def test_operator_rows(spark, monkeypatch):
    rows = [(k, t, "x") for k, t in enumerate(texts(9, 60))]
    rows += [(None, "é É " * 40 + "end", None), (5, None, ""), (6, "", "y"), (6, " \t\n", "y"), (7, "b " * 20000, "z"), (7, "b " * 20000, "z")]
    rows += [(8, "x y z\n" * 9 + "A a\x0bA a b", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    monkeypatch.setattr(runs, "GROUP_BYTES", 300)
    out = sorted(runs.find_runs(docs).collect(), key=str)
    expected = []
    for doc, text, _ in rows:
        words = split(text)
        found = brute_runs(words) if len(words) < 5000 else [(0, len(words), 1)]
        expected.append((doc, len(words), found, brute_collapse(words, found)))
    actual = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out]
    assert sorted(actual, key=str) == sorted(expected, key=str)


def test_empty_table_and_wrong_parameters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert runs.find_runs(empty).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(empty, repeats=1)
