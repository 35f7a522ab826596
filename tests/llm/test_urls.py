import math
import random
import re

import pytest
from pyspark.sql import functions as F

from loanlens.llm import urls

SEEDS = ("spam", "farm", "cheap", "pills", "casino")
SCHEMA = "page_id long, url string, html string, host string, verdict string"
CASES = [
    "http://Www.A.net/x?q#f", "https://b.example.net/en/1", "http://example.net/en/", "http://notexample.net/en/", "http://c.example.com/de/?a://b/",
    "http://c.example.com/de", "http://org/fr/x", "http://x.org/FR/x", "http://net", "http://net/", "http://a.net?x", "nothing", "", None, "://h/p", "a\nb://Host.É.org/fr/\n#x",
    "http://cheappills.example.com/en/casino", "http://www.spamfarm.example.org/en/1", "http://good.example.org/fr/2", "http://x.example.com/" + "long" * 5000,
]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_rules_and_verdicts(spark):
    rows = [(i, u, "<p>cheap pills spam farm good words</p>" * 20, None, "x") for i, u in enumerate(CASES)] + [(3, CASES[3], None, None, None), (None, CASES[0], None, None, None)]
    out = urls.judge(spark.createDataFrame(rows, SCHEMA), seeds=SEEDS).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r for r in out}
    for i, url in enumerate(CASES):
        assert (by[i].host, by[i].path) == parts(url), url
        name, verdict = rule(*parts(url))
        assert by[i]["rule"] == name and by[i].verdict == (verdict or ("block" if by[i].score >= 0.5 else "allow"))
        assert 0 <= by[i].score <= 1
    cheap, spam = CASES.index("http://cheappills.example.com/en/casino"), CASES.index("http://www.spamfarm.example.org/en/1")
    good = CASES.index("http://good.example.org/fr/2")
    assert by[cheap].score > by[good].score and by[spam].score > by[good].score


def test_viterbi_equals_all_splits():
    counts = {"ab": 5, "a": 3, "b": 2, "abc": 1, "ca": 9, "c": 1}
    segmenter = urls.Segmenter(counts)

    def every(text):
        if not text:
            yield []
        for n in range(1, len(text) + 1):
            yield from ([text[:n], *rest] for rest in every(text[n:]))

    for text in ("abcab", "cabca", "zzab", "abcabcab"):
        best = max(sum(map(segmenter.cost, words)) for words in every(text))
        found = segmenter.split(text)
        assert "".join(found) == text and abs(sum(map(segmenter.cost, found)) - best) < 1e-9


def test_word_counts_and_odds(spark):
    frame = spark.createDataFrame([(1, "http://ab.cd.com/ef?gh", "<b>Ab</b> x ab", None, None), (2, None, None, None, None)], SCHEMA)
    assert urls.word_counts(frame) == {"ab": 3, "cd": 1, "ef": 1}
    decided = spark.createDataFrame([("bad.x.com", "/a", "block")] * 30 + [("ok.x.com", "/a", "allow")] * 30, "host string, path string, verdict string")
    odds = urls.learn(decided, {"bad": 5, "ok": 5}, SEEDS)
    assert odds["h:bad"] > 1 > 0 > odds["h:ok"] and abs(odds["p:a"]) < 0.1 and odds[""] == 0
    assert odds["h:spam"] > 0


def test_odds_are_those_of_a_plain_count(spark):
    rng = random.Random(9)
    hosts, paths = ["good.ab.com", "badbad.cd.com", "x1.ef.com"], ["/en/a/12", "/de/bad", "/"]
    rows = [(rng.choice(hosts), rng.choice(paths), rng.choice(["block", "allow", None])) for _ in range(300)]
    decided = spark.createDataFrame(rows, "host string, path string, verdict string")
    words = {"good": 4, "bad": 6, "ab": 1, "cd": 1, "ef": 1, "en": 2, "de": 2}
    segmenter, counts = urls.Segmenter(words), {"block": {}, "allow": {}}
    for host, path, verdict in rows:
        for place, run in urls.runs_of(host, path) if verdict else ():
            for word in segmenter.split(run) if run.isalpha() else [run]:
                counts[verdict][place + word] = counts[verdict].get(place + word, 0) + 1
    odds = urls.learn(decided, words)
    names = counts["block"].keys() | counts["allow"].keys()
    assert odds.keys() == names | {""}
    for name in names:
        mine = {t for t in names if t[:2] == name[:2]}
        share = [(c.get(name, 0) + 1) / (sum(c.get(t, 0) for t in mine) + len(mine) + 1) for c in (counts["block"], counts["allow"])]
        assert abs(odds[name] - math.log(share[0] / share[1])) < 1e-9
    n = [sum(r[2] == v for r in rows) for v in ("block", "allow")]
    assert abs(odds[""] - math.log((n[0] + 1) / (n[1] + 1))) < 1e-9


def test_held_out_verdicts(spark):
    """Urls that the rules decide, learned from two thirds: right on nine of ten others."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    named = pages.select("page_id", urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path"))
    decided = named.withColumn("verdict", urls.rule_of(F.col("host"), F.col("path"))[1]).where("verdict is not null")
    held = F.crc32(F.col("page_id").cast("string")) % 3 == 0
    words = urls.word_counts(pages)
    assert max(map(len, words)) < urls.LONGEST_WORD
    odds, segmenter = urls.learn(decided.where(~held), words), urls.Segmenter(words)

    def score(host, path):
        parts = [(p, w) for p, r in urls.runs_of(host, path) for w in (segmenter.split(r) if r.isascii() and r.isalpha() else [r])]
        return odds[""] + sum(odds.get(p + w, 0.0) for p, w in parts)

    rows = decided.where(held).collect()
    right = [(score(r.host, r.path) >= 0) == (r.verdict == "block") for r in rows]
    assert len(rows) > 300 and sum(right) >= 0.9 * len(rows)


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spark.range(1).select(urls.host_of(F.lit(None).cast("string"))).first()[0] == ""


@pytest.mark.parametrize("held", [urls.HELD_BYTES, 0])
def test_rare_words_and_tokens_count(spark, held):
    """60,000 words and tokens more frequent than those that decide."""
    rng = random.Random(2)
    many = ["".join(rng.choice("abcdefghijklm") for _ in range(9)) for _ in range(60_000)]
    rows = [(i, f"http://x{i}.org/fr/" + "/".join(many[i * 100 : i * 100 + 100]), " ".join(many[i * 100 : i * 100 + 100]), None, None) for i in range(600)]
    rows += [(1000, "http://a.net/zzqwert/", "zzqwert", None, None), *((1001 + i, "http://b.org/fr/yyqwert/", "yyqwert", None, None) for i in range(4))]
    rows += [(2000, "http://c.example.com/" + "zzqwert" * 4, None, None, None), (2001, "http://c.example.com/" + "yyqwert" * 4, None, None, None), (2002, "http://c.example.com/", None, None, None)]
    out = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, SCHEMA), held_bytes=held).collect()}
    assert len(out) == len(rows)
    assert out[2000].score > out[2002].score > out[2001].score


def test_joined_odds_equal_held_ones(spark):
    rows = [(i, u, "<p>cheap pills spam farm good words</p>", None, "x") for i, u in enumerate(CASES * 3)] + [(None, None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (-1 if r.page_id is None else r.page_id)
    one, two = (sorted(urls.judge(frame, held_bytes=b).collect(), key=key) for b in (urls.HELD_BYTES, 0))
    assert [r[:5] for r in one] == [r[:5] for r in two]
    assert all(abs(a.score - b.score) < 1e-9 for a, b in zip(one, two, strict=True))
