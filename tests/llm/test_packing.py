"""Packing: exact round trip, the rule against its definition, and the table's query."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loanlens.llm import catalog, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "Hello  World \n x", "it's  we'll\t\x1c. \x1cé  b　c  ", ".\x1c", "a \x1c .\x1c", "<|endoftext|> <|end oftext|>",
    "x" * 5000, "long " * 3000, "\n\n \n a\n\n b", "日本語 テキスト。" * 300, " lead and trail ", "1 22 333 4444a b5 'tis 's",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, plain, window):
    """Every id once, sequences without gaps, full or of a power of two."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(texts)
    for doc, pieces in docs.items():
        ids = [*plain(texts[doc]), 0]
        pieces.sort(key=lambda r: r.start)
        assert all(r.doc_tokens == len(ids) for r in pieces)
        assert [r.start for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
        assert b"".join(bytes(r.ids) for r in pieces) == np.array(ids, "<u4").tobytes()
        assert all(r.length * 4 == len(r.ids) > 0 for r in pieces)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
        total = sum(r.length for r in pieces)
        assert total == window or (total < window and total & (total - 1) == 0)


@pytest.mark.parametrize("window", [2, 16, 1024])
def test_round_trip(spark, plain, window):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, sequence_id int").repartition(3)
    check(packing.pack(docs, PATH, window).collect(), {r[0]: r[1] for r in rows}, plain, window)


def encoded(encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    assert bounds[-1] == len(ids) and len(bounds) == len(texts) + 1
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@pytest.mark.parametrize("slice_bytes,slots,most_ids", [(1 << 22, 1 << 20, 1 << 23), (64, 16, 50), (500, 1, 1 << 23)])
def test_ids_are_those_of_the_tokenizer(plain, monkeypatch, slice_bytes, slots, most_ids):
    monkeypatch.setattr(packing, "SLICE", slice_bytes)
    monkeypatch.setattr(packing, "SLOTS", slots)
    monkeypatch.setattr(packing, "MOST_IDS", most_ids)
    encoder = packing.Encoder(PATH)
    rng = random.Random(5)
    alphabet = "ab' .\n\t\x00\x1c\x85\u00a0\u1680\u2003\u2028\u202f\u205f\u3000  é9,日à٣"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(60)) for _ in range(200)]
    expected = [plain(t) for t in texts]
    assert encoded(encoder, texts) == expected
    assert encoded(encoder, texts[::-1]) == expected[::-1]  # with what is known by now
    assert encoded(encoder, []) == [] and encoded(encoder, [None, "", None]) == [[], [], []]


def test_other_kinds_of_tokenizer_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))


def test_level_minimises_the_sum_of_squares():
    rng = np.random.default_rng(3)
    packer = packing.Packer(12, 0, 10_000)
    for k in range(2000):
        counts = [len(held) for held in packer.open]
        length = int(rng.integers(1, 12))
        options = []
        for level in range(12 - length + 1):
            if level and not counts[level]:
                continue
            after = counts[:]
            after[level] -= level > 0
            if level + length < 12:
                after[level + length] += 1
            options.append((sum(n * n for n in after[1:]), -level))
        assert packer.level_for(length) == -min(options)[1]
        packer.add(k, np.zeros(length, np.uint32))
    assert packer.count == sum(len(held) for held in packer.open)
    packer.finish()
    assert sum(row[2] for row in packer.done) == sum({row[0]: row[4] for row in packer.done}.values())


def test_few_open_windows_are_kept(spark, plain):
    rows = [(i, "w " * (i % 50)) for i in range(400)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH, 64, most_open=3)
    check(pieces.collect(), dict(rows), plain, 64)


def test_sequences_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema), PATH).collect() == []
    pieces = packing.pack(spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], schema).coalesce(1), PATH)
    rows = pieces.collect()
    assert sum(r.length for r in rows) == 3 + 3 + 1
    whole = packing.sequences(pieces).collect()
    assert sorted(len(r.ids) // 4 for r in whole) == [1, 2, 4] and sum(len(r.doc_ids) for r in whole) == len(rows)
    with pytest.raises(ValueError):
        packing.pack(pieces, PATH, 1)


def test_query_packs_the_whole_table(spark, plain):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in catalog.table(spark, sf, "documents").collect()}
    rows = catalog.op12_square_packing(spark, sf).collect()
    assert set(rows[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    for r in rows:
        ids = np.array([*plain(texts[r.doc_id]), 0], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sum(used.values()) == sum(len(plain(t)) + 1 for t in texts.values())
    # Few windows hold cut documents only because the tasks are few.
    assert sum(n == 1024 for n in used.values()) >= 0.8 * len(used)
