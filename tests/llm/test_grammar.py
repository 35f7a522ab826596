import hashlib
import random
import re
import time

import numpy as np
import pytest

from loanlens.llm import grammar

DOCS = "doc_id long, text string, n_chars long, spans string"
HEX = "0123456789abcdef"


def base(text):
    found = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def rows():
    rng = random.Random(4)
    draw = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    letters = grammar.LOWER + grammar.UPPER + grammar.DIGITS
    texts = [f'Wort é {draw("abcdefgh", 9)} token = "{draw(HEX, 40)}" ende' for _ in range(60)]
    texts += [
        None, "", "PassWord: 'abcdefgh'", "password=short", "api_key=12345678 APIKEY:abc.def-ghi toKen='", "AKIA" + "A" * 12, "AKIAABC",
        "a" * 32, "f" * 31 + "g", f"ſecret=abcdefgh to\u212aen=abcdefgh", "key ghp_" + draw(letters, 36) + " end", "x=ghp_" + draw(letters, 36),
        "thisisaverylongordinarywordindeed " * 400 + "secret: zzzzzzzzz", "tokentoken=aaaaaaaaaaaa=token:bbbbbbbbb", draw(HEX, 700),
        "https://example.com/some/ordinary/path/of/words", "plain text",
    ]
    return [(i, t, None if t is None else len(t), "x") for i, t in enumerate(texts)] + [(3, texts[3], 1, None), (None, texts[0], None, None)]


@pytest.fixture(scope="module")
def model(spark):
    return grammar.train(spark.createDataFrame(rows(), DOCS))


def test_base_spans_equal_the_patterns(spark, model):
    out = grammar.find(spark.createDataFrame(rows(), DOCS), model).collect()
    expected = {(r[0], r[1]): base(r[1] or "") for r in rows()}
    assert len(out) == len(rows())
    texts = {r[0]: r[1] for r in rows()}
    for r in out:
        spans = expected[r.doc_id, texts[r.doc_id]]
        names = [f"{grammar.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("grammar")] == names


def test_learned_formats_are_found_and_words_are_not(model):
    rng = random.Random(8)
    letters = grammar.LOWER + grammar.UPPER + grammar.DIGITS
    draw = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    hit = [f"ghp_{draw(letters, 36)}" for _ in range(100)] + [f"sk_live_{draw(letters, 24)}" for _ in range(100)]
    assert sum(grammar.spans_of(f"see {s} here", model) != [] for s in hit) >= 190
    words = [draw(grammar.LOWER, rng.randint(16, 45)) for _ in range(300)]
    assert sum(grammar.spans_of(f"see {w} here", model) != [] for w in words) <= 3


def test_automata_learn_lengths():
    automaton = grammar.infer(grammar.drawn()["format7"])
    assert automaton.likelihood("0123456789" * 4) > automaton.likelihood("0123456789" * 3) == float("-inf")
    loop = grammar.infer(["ab" * n for n in range(1, 10) for _ in range(1024 >> n)])
    assert loop.likelihood("ab" * 20) > float("-inf") and len(loop.step) < 16


def test_redaction(spark, model):
    out = grammar.redact(spark.createDataFrame(rows(), DOCS), model).collect()
    assert len(out) == len(rows())
    for r in out:
        assert not base(r.text or "") and r.n_chars == (len(r.text) if r.text is not None else r.n_chars)
    assert grammar.redacted("token=abcdefgh1 and token=abcdefgh2", None) == "[secret] and [secret]"


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert grammar.find(empty, grammar.train(empty)).collect() == []
    assert grammar.redact(empty, None).collect() == []


def test_credentials_joined_to_fixed_finds_are_found(model):
    rng = random.Random(12)
    letters = grammar.LOWER + grammar.UPPER + grammar.DIGITS
    draw = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    bases = [lambda: "AKIA" + draw(grammar.UPPER + grammar.DIGITS, 16), lambda: draw(HEX, 40)]
    others = [lambda: "ghp_" + draw(letters, 36), lambda: "glpat-" + draw(letters, 20), lambda: "npm_" + draw(letters, 36), lambda: "sk_live_" + draw(letters, 24)]
    found, total = 0, 0
    for joint in ("/", ".", "=", "-", "_", "+", "--", "=-"):
        for first in bases:
            for other in others:
                for _ in range(4):
                    secret, fixed, last = other(), first(), other()
                    text = f"see {fixed}{joint}{secret} and {last}{joint}{first()} end"
                    spans = grammar.spans_of(text, model)
                    assert sum(kind != grammar.GRAMMAR for *_, kind in spans) == 2
                    found += sum((text.index(s), text.index(s) + len(s), grammar.GRAMMAR) in spans for s in (secret, last))
                    total += 2
    assert found >= 0.9 * total
    assert grammar.spans_of(f"see {draw(HEX, 40)}/ordinarywordsofsomelength end", model)[1:] == []


@pytest.mark.parametrize("joiner", ["-", "_", "-=", "-/_"])
def test_long_rows_of_joiners_take_little_time(model, joiner):
    key = "AKIA" + "B7" * 8
    text = f"{key}{joiner * (100_000 // len(joiner))}{key} end"
    start = time.perf_counter()
    spans = grammar.spans_of(text, model)
    assert [s[:2] for s in spans if s[2] == "access"] == [(0, 20), (len(text) - 24, len(text) - 4)]
    assert time.perf_counter() - start < 3


def test_many_finds_take_linear_time(model):
    text = " ".join(["AKIA" + "C3" * 8] * 60_000)
    start = time.perf_counter()
    assert len(grammar.spans_of(text, model)) == 60_000
    assert time.perf_counter() - start < 6


def test_long_tokens_count_as_ordinary(spark):
    token = "ab/c-" * 300
    pairs = np.zeros((grammar.END + 1, grammar.END + 1))
    grammar.count_pairs(pairs, token)
    frame = spark.createDataFrame([(1, f"x {token} y", None, None)], DOCS)
    assert np.array_equal(grammar.train(frame).rest.pair, grammar.ordinary(pairs).pair)


def test_every_ordinary_token_counts(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice(grammar.LOWER + "/-") for _ in range(20)) + "g" for _ in range(30)]
    texts = [f"a {w} b {w} c" for w in words]
    pairs = np.zeros((grammar.END + 1, grammar.END + 1))
    for text in texts:
        for (a, b), *_ in grammar._candidates(text, []):
            grammar.count_pairs(pairs, text[a:b])
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], DOCS).repartition(5)
    assert pairs.sum() >= 60 * 22 and np.array_equal(grammar.train(docs).rest.pair, grammar.ordinary(pairs).pair)
