"""URL filters: rules first, then words found in the host and path, weighed by naive Bayes.

A host label such as ``cheappills`` is split into words by Viterbi's search over a
unigram model of all the pages' own words.  The words of host and path are scored by a
multinomial naive Bayes model, learned from the urls the rules decide and, if a user gives
any, from seed words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.store import Store
from loanlens.operators import joins

#: (verdict, host, path): a rule fits its host and all subdomains, where the path starts so.
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
#: The share of the blocked hosts' words that each given seed word counts for.
SEED_SHARE = 0.02
#: Odds of runs that every task gets, in bytes; beyond, they are joined to the pages' runs.
HELD_BYTES = 16_000_000
#: Longer runs of letters are no words, and no segment of a run is longer.
LONGEST_WORD = 24
SMOOTHING = 1.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(the longest fitting rule, its verdict), null where none fits; ties go to the first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, name, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


class Segmenter:
    """Splits a run of letters into the likeliest words."""

    def __init__(self, counts: dict[str, int], total: int | None = None) -> None:
        self.total = max(1, sum(counts.values()) if total is None else total)
        self.logs = {w: math.log(n / self.total) for w, n in counts.items()}

    def cost(self, word: str) -> float:
        """Log probability of a word; an unknown one's falls tenfold with each letter."""
        known = self.logs.get(word)
        return known if known is not None else math.log(10 / self.total) - len(word) * math.log(10)

    def split(self, text: str) -> list[str]:
        """The words of a run of letters, by Viterbi's search; every letter is kept."""
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            options = ((best[start] + self.cost(text[start:end]), start) for start in range(max(0, end - LONGEST_WORD), end))
            score, start = max(options, key=lambda o: (o[0], -o[1]))
            best.append(score)
            back.append(start)
        words, end = [], len(text)
        while end:
            words.append(text[back[end] : end])
            end = back[end]
        return words[::-1]


_LETTERS = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def runs_of(host: str, path: str) -> list[tuple[str, str]]:
    """(place, run) of the host's labels but the last, and of the path; numbers are ``#``."""
    found = [("h:", r) for label in host.split(".")[:-1] for r in _LETTERS.findall(label)]
    found += [("p:", r) for r in _LETTERS.findall(path.lower())]
    return [(place, "#" if run.isascii() and run.isdigit() else run) for place, run in found]


def word_table(pages: DataFrame) -> DataFrame:
    """(word, n): all runs of 2 to 24 letters in urls and html, with their counts."""
    text = F.concat_ws(" ", path_of(F.col("url")), F.regexp_replace(host_of(F.col("url")), r"\.[^.]*$", ""), F.col("html"))
    found = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(r"(?<![a-z])[a-z]{2,24}(?![a-z])"), 0)
    return pages.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def word_counts(pages: DataFrame) -> dict[str, int]:
    """``word_table`` of a small table, collected."""
    return {r["word"]: r["n"] for r in word_table(pages).collect()}


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for host, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "verdict")), strict=True):
            counts.update((place, run, verdict) for place, run in runs_of(host, path))
        rows = [(*key, n) for key, n in counts.items()]
        arrays = [pa.array([r[i] for r in rows], pa.string() if i < 3 else pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(arrays, names=["place", "run", "verdict", "n"])


def _substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, word) for all parts of a run of letters that could be a word."""
    for batch in batches:
        for number, run in zip(batch.column("id").to_pylist(), batch.column("run").to_pylist(), strict=True):
            for low in range(0, len(run), 4096):
                starts = range(low, min(low + 4096, len(run)))
                words = sorted({run[i:j] for i in starts for j in range(i + 2, min(i + LONGEST_WORD, len(run)) + 1)})
                arrays = [pa.array([number] * len(words), pa.int64()), pa.array(words, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "word"])


def _split(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for text, known in zip(batch.column("run").to_pylist(), batch.column("known").to_pylist(), strict=True):
                letters = text.isascii() and text.isalpha()
                words.append(Segmenter(dict(known or []), total).split(text) if letters else [text])
            columns = [batch.column(c) for c in ("id", "place", "block", "allow")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.list_(pa.string()))], names=["id", "place", "block", "allow", "words"])

    return run


def _tokens(store: Store, runs: DataFrame, words: DataFrame) -> DataFrame:
    """(id, token, block, allow): the words of every run, which only gets the counts of its parts."""
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = runs.where(F.col("run").rlike("^[a-z]{2}")).select("id", "run").mapInArrow(_substrings, "id long, word string").distinct()
    known = parts.join(words, "word").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))
    split = runs.join(known, "id", "left").select("id", "place", "block", "allow", "run", "known")
    split = split.mapInArrow(_split(total), "id long, place string, block long, allow long, words array<string>")
    each = split.select("id", "place", "block", "allow", F.explode("words").alias("word"))
    return store.put("tokens", each.select("id", F.concat("place", "word").alias("token"), "block", "allow"))


def _odds(store: Store, decided: DataFrame, words: DataFrame, seeds: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame, float]:
    """All (place, run), their tokens, the log odds of block against allow per token, and the prior's.

    ``decided`` has host, path and verdict, null where no rule fits.  Each seed word
    counts as a share of the blocked hosts' words.  Host and path words have
    distributions of their own, so that seeds do not thin the path's.
    """
    of = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v)
    runs = decided.select("host", "path", "verdict").mapInArrow(_count_runs, "place string, run string, verdict string, n long")
    runs = runs.groupBy("place", "run").agg(of("block"), of("allow"))
    runs = store.put("runs", runs.withColumn("id", F.monotonically_increasing_id()))
    tokens = _tokens(store, runs, words)
    counts = tokens.groupBy("token").agg(*(F.sum(v).cast("double").alias(v) for v in ("block", "allow")))
    counts = store.put("counts", counts.where("block + allow > 0"))
    weight = max(1.0, SEED_SHARE * (counts.where("token like 'h:%'").agg(F.sum("block")).first()[0] or 0.0))
    schema = "token string, block double, allow double"
    planted = decided.sparkSession.createDataFrame([(f"h:{w}", weight, 0.0) for w in seeds], schema)
    summed = counts.unionByName(planted).groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    odds = store.put("summed", summed.withColumn("place", F.substring("token", 1, 2)))
    value = F.lit(0.0)
    for r in odds.groupBy("place").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("n")).collect():
        more = SMOOTHING * (r["n"] + 1)
        log = F.log((F.col("block") + SMOOTHING) / (r["block"] + more)) - F.log((F.col("allow") + SMOOTHING) / (r["allow"] + more))
        value = F.when(F.col("place") == r["place"], log).otherwise(value)
    verdicts = Counter({r["verdict"]: r["count"] for r in decided.groupBy("verdict").count().collect()})
    prior = math.log((verdicts["block"] + SMOOTHING) / (verdicts["allow"] + SMOOTHING))
    return runs, tokens, odds.select("token", value.alias("odds")), prior


def learn(decided: DataFrame, words: dict[str, int], seeds: Sequence[str] = ()) -> dict[str, float]:
    """Per token the log odds of block against allow; '' holds the prior's.  For small tables: collected."""
    store = Store(decided.sparkSession)
    table = decided.sparkSession.createDataFrame(list(words.items()), "word string, n long")
    *_, odds, prior = _odds(store, decided, table, seeds)
    return {r["token"]: r["odds"] for r in odds.collect()} | {"": prior}


def _score(known: dict[tuple[str, str], float], prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            totals = [prior + sum(known.get(r, 0.0) for r in runs_of(host, path)) for host, path in pairs]
            columns = [batch.column(n) for n in ("page_id", "host", "path", "rule", "verdict")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "total"])

    return run


def _page_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = zip(*(batch.column(c).to_pylist() for c in ("row", "host", "path")), strict=True)
        rows = [(row, *r, n) for row, host, path in columns for r, n in Counter(runs_of(host, path)).items()]
        arrays = [pa.array([r[i] for r in rows], pa.string() if i in (1, 2) else pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "place", "run", "n"])


def _totals(store: Store, ruled: DataFrame, runs: DataFrame, prior: float, held_bytes: int) -> DataFrame:
    """The pages with the sum of their runs' odds and the prior's."""
    if joins.stored_bytes(runs) <= held_bytes:
        known = {(r["place"], r["run"]): r["odds"] for r in runs.collect()}
        return ruled.mapInArrow(_score(known, prior), "page_id long, host string, path string, rule string, verdict string, total double")
    there = store.put("page_runs", ruled.mapInArrow(_page_runs, "row long, place string, run string, n long"))
    found = joins.lookup(there, runs, ["place", "run"], held_bytes)
    sums = found.groupBy("row").agg(F.sum(F.col("n") * F.col("odds")).alias("sum"))
    return ruled.join(sums, "row", "left").withColumn("total", F.coalesce("sum", F.lit(0.0)) + prior)


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, seeds: Sequence[str] = (), held_bytes: int = HELD_BYTES
) -> DataFrame:
    """page_id, host, path, rule, verdict and score (of block) for every page.

    The longest fitting rule decides; where none fits, the model does: block from 0.5.
    A null url, or one without ``://``, has an empty host and path and is judged by the
    prior alone.  Repeated rows are judged alike; other columns are ignored; an empty
    table gives an empty one; without decided urls the seed words alone are known, if any.
    Rules are a short list that every task gets; no row is dropped.  All words of the
    pages and all tokens of decided urls count: words are joined to the parts of the
    urls' distinct runs of letters, odds are summed per run.  Pages stay where they are
    while the runs' odds have up to ``held_bytes`` bytes, counted first; beyond, they
    are joined to the pages' runs by shuffle, without the rows of frequent runs.
    """
    named = pages.select(
        F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    store = Store(pages.sparkSession)
    ruled = named.withColumns({"rule": rule, "verdict": verdict, "row": F.monotonically_increasing_id()})
    ruled = store.put("ruled", ruled)
    words = store.put("words", word_table(pages))
    runs, tokens, odds, prior = _odds(store, ruled, words, seeds)
    sums = tokens.join(odds, "token").groupBy("id").agg(F.sum("odds").alias("odds"))
    scores = store.put("scores", runs.join(sums, "id").select("place", "run", "odds"))
    store.drop("words", "runs", "tokens", "counts", "summed")
    total = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col("total")))
    scored = _totals(store, ruled, scores, prior, held_bytes).withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score",
    )
