"""Secret scans: fixed patterns, and credential formats learned as automata.

The formats of labelled credentials are inferred: a prefix tree of each kind's strings is
generalised by merging states whose outgoing and stopping frequencies agree within
Hoeffding's bound, which leaves a probabilistic automaton per kind.  Every candidate in a
text, what the fixed patterns' finds leave of a run of credential characters, is scored by
each automaton against an automaton-free model of ordinary tokens.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.store import Store

KINDS = ("assign", "access", "hex")
GRAMMAR = "grammar"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_KEYWORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_PIECE = re.compile(r"[A-Za-z0-9+_-]{16,}")
#: Characters of a candidate; and those that join pieces, though credentials may hold them.
LEAST = 16
_JOINERS = "+_-"
MOST_JOINERS = 4

#: Publicly documented credential formats, fixed values: prefix, alphabet, length of the rest.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FORMATS = (
    ("AKIA", UPPER + DIGITS, 16),
    ("ghp_", LOWER + UPPER + DIGITS, 36),
    ("glpat-", LOWER + UPPER + DIGITS + "_-", 20),
    ("AIza", LOWER + UPPER + DIGITS + "_-", 35),
    ("sk_live_", LOWER + UPPER + DIGITS, 24),
    ("npm_", LOWER + UPPER + DIGITS, 36),
    ("", "0123456789abcdef", 32),
    ("", "0123456789abcdef", 40),
    ("", "0123456789abcdef", 64),
)
#: Strings drawn per format, and at most so many strings per kind found in documents.
DRAWN = 200
SAMPLE = 1000
#: Confidence of the merge test, and the share of own strings an automaton may miss.
ALPHA = 0.05
MISSED = 0.02
#: Longer strings are not learned from.
LONGEST = 512
#: A candidate must be so much likelier as a credential, in natural logarithms.
MARGIN = 8.0

#: Character groups of the comparison model.
_GROUPS = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-")
_GROUP = {c: k for k, group in enumerate(_GROUPS) for c in group}
_WITHIN = [-math.log(len(group)) for group in _GROUPS]
END = len(_GROUPS)
#: A character at this many positions is filler, at fewer a mark of the format's structure.
SPREAD = 5
FILLER = "*"
#: Added to a filler character's count in each state.
SMOOTH = 0.05


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's place, end, value) of the fixed patterns' finds, in order.

    Each kind's finds are leftmost and do not overlap; those too short are dropped.
    """
    found = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        for m in _ASSIGN.finditer(text):
            if len(m.group(2)) >= 8:
                found.append((m.start(), 0, m.end(), m.group(2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in _ACCESS.finditer(text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end(), m.group()) for m in _HEX.finditer(text)]
    return sorted(found)


@dataclass
class Automaton:
    """A deterministic probabilistic automaton.

    Its transitions read a structural character or any filler; each state has its own
    distribution of characters and of stopping.
    """

    filler: frozenset[str]
    step: list[dict[str, int]]
    seen: list[Counter]
    least: float = -math.inf

    def likelihood(self, text: str) -> float:
        """Log probability of a string; minus infinity if the format cannot be so."""
        state, total = 0, 0.0
        for c in text:
            symbol = FILLER if c in self.filler else c
            if symbol not in self.step[state]:
                return -math.inf
            total += self._chance(state, c, symbol)
            state = self.step[state][symbol]
        stops = self.seen[state][""]
        return total + math.log(stops / self.seen[state].total()) if stops else -math.inf

    def _chance(self, state: int, c: str, symbol: str) -> float:
        extra = SMOOTH if symbol == FILLER else 0.0
        count = self.seen[state]
        return math.log((count[c] + extra) / (count.total() + extra * len(self.filler)))


def _differ(n1: int, f1: int, n2: int, f2: int, bound: float) -> bool:
    """Whether two frequencies differ by more than Hoeffding's bound allows."""
    return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


def infer(strings: list[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of a set of strings: prefix tree, then merges of states that agree.

    Characters found at many positions are filler and share a branch of the tree, so
    that random parts keep the counts that tell their length.  States are visited
    breadth first; each is merged into the first earlier one whose character and
    stopping frequencies, and those of all states after them, agree.
    """
    places: dict[str, set[int]] = {}
    for text in strings:
        for i, c in enumerate(text):
            places.setdefault(c, set()).add(i)
    filler = frozenset(c for c, at in places.items() if len(at) >= SPREAD)
    step: list[dict[str, int]] = [{}]
    seen: list[Counter] = [Counter()]
    for text in strings:
        state = 0
        for c in text:
            symbol = FILLER if c in filler else c
            seen[state][c] += 1
            if symbol not in step[state]:
                step[state][symbol] = len(step)
                step.append({})
                seen.append(Counter())
            state = step[state][symbol]
        seen[state][""] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def agree(a: int, b: int) -> bool:
        todo, done = [(a, b)], set()
        while todo:
            x, y = todo.pop()
            done.add((x, y))
            n, m = seen[x].total(), seen[y].total()
            if any(_differ(n, seen[x][c], m, seen[y][c], bound) for c in {*seen[x], *seen[y]}):
                return False
            pairs = [(step[x][s], step[y][s]) for s in step[x].keys() & step[y].keys()]
            todo += [p for p in pairs if p[0] != p[1] and p not in done]
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            seen[x] += seen[y]
            for s, far in step[y].items():
                if s not in step[x]:
                    step[x][s] = far
                elif step[x][s] != far:
                    todo.append((step[x][s], far))

    red = [0]
    while blue := [(r, s) for r in red for s in sorted(step[r]) if step[r][s] not in red]:
        parent, symbol = blue[0]
        state = step[parent][symbol]
        for old in red:
            if agree(old, state):
                step[parent][symbol] = old
                fold(old, state)
                break
        else:
            red.append(state)
    place = {state: i for i, state in enumerate(red)}
    return Automaton(filler, [{s: place[f] for s, f in step[r].items()} for r in red], [seen[r] for r in red])


@dataclass
class Ordinary:
    """How likely a string is among ordinary tokens: pairs of character groups, smoothed."""

    pair: np.ndarray

    def likelihood(self, text: str) -> float:
        before, total = END, 0.0
        for c in text:
            symbol = _GROUP[c]
            total += self.pair[before, symbol] + _WITHIN[symbol]
            before = symbol
        return total + self.pair[before, END]


def count_pairs(counts: np.ndarray, text: str) -> None:
    """Adds a token's pairs of character groups, with its start and end, to ``counts``."""
    before = END
    for c in text:
        counts[before, _GROUP[c]] += 1
        before = _GROUP[c]
    counts[before, END] += 1


def ordinary(pairs: np.ndarray) -> Ordinary:
    """The model of counted pairs, each counted once more."""
    counts = pairs + 1.0
    return Ordinary(np.log(counts / counts.sum(axis=1, keepdims=True)))


@dataclass
class Model:
    automata: list[Automaton]
    rest: Ordinary

    def is_secret(self, text: str) -> bool:
        """Whether a candidate fits a learned format, and clearly better than ordinary text."""
        scores = ((a.likelihood(text), a.least * len(text)) for a in self.automata)
        best = max((x for x, least in scores if x >= least), default=-math.inf)
        return best > -math.inf and best - self.rest.likelihood(text) >= MARGIN


def drawn(seed: int = 11) -> dict[str, list[str]]:
    """Strings of the documented formats, the same ones every time."""
    rng = np.random.default_rng(seed)
    out = {}
    for k, (prefix, alphabet, size) in enumerate(FORMATS):
        letters = np.array(list(alphabet))
        out[f"format{k}"] = [prefix + "".join(rng.choice(letters, size)) for _ in range(DRAWN)]
    return out


def learn(labelled: dict[str, list[str]], pairs: np.ndarray) -> Model:
    """One automaton per kind; every fifth string sets what the automaton must accept.

    ``pairs`` are the pair counts of ordinary tokens.
    """
    automata = []
    for kind in sorted(labelled):
        strings = [s for s in sorted(set(labelled[kind])) if s and len(s) <= LONGEST and all(c in _GROUP for c in s)]
        if len(strings) < 20:
            continue
        kept = strings[::5]
        automaton = infer([s for i, s in enumerate(strings) if i % 5])
        fits = [x for s in kept if (x := automaton.likelihood(s) / len(s)) > -math.inf]
        if len(fits) >= (1 - 5 * MISSED) * len(kept):
            automaton.least = float(np.quantile(fits, MISSED)) - 0.2
            automata.append(automaton)
    return Model(automata, ordinary(pairs))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Formats of the documented kinds and of the values found in documents.

    Per kind at most ``sample`` distinct values of the fixed patterns are collected, those
    with the smallest hashes.  Pairs of character groups are counted in the tasks, over
    all other tokens of 16 or more characters as often as they stand in all documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            pairs = np.zeros((END + 1, END + 1), np.int64)
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                found |= {(KINDS[k], v, 0) for _, k, _, v in spans if len(v) <= LONGEST}
                for (a, b), *_ in _candidates(text, spans):
                    count_pairs(pairs, text[a:b])
            rows = sorted(found) + [("pair", str(i), int(n)) for i, n in enumerate(pairs.flat) if n]
            arrays = [pa.array([r[i] for r in rows], pa.int64() if i == 2 else pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(arrays, names=["kind", "value", "n"])

    seen = docs.select("text").mapInArrow(run, "kind string, value string, n long")
    store = Store(docs.sparkSession)
    seen = store.put("tokens", seen.groupBy("kind", "value").agg(F.sum("n").alias("n")))
    labelled: dict[str, list[str]] = {}
    for kind in KINDS:
        rows = seen.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(sample).collect()
        labelled[kind] = [r["value"] for r in rows]
    pairs = np.zeros((END + 1) ** 2)
    for r in seen.where("kind = 'pair'").collect():
        pairs[int(r["value"])] = r["n"]
    store.drop("tokens")
    return learn(labelled | drawn(), pairs.reshape(END + 1, END + 1))


def _rests(start: int, stop: int, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int, bool, bool]]:
    """What fixed finds leave of a run, and whether one of them ends before or starts after it."""
    out, at, cut = [], start, False
    for x, _, y, _ in spans:
        if start < y and x < stop and y > at:
            if x > at:
                out.append((at, x, cut, True))
            at, cut = y, True
    return [*out, (at, stop, cut, False)] if at < stop else out


def _trimmed(text: str, a: int, b: int, left: bool, right: bool) -> Iterator[tuple[int, int]]:
    """A part, then the part without joining characters beside fixed finds.

    Of a row of joining characters the whole is tried, and the nearest ones to the rest, up
    to ``MOST_JOINERS``, in each number: so many a credential itself may begin or end with.
    """
    value = text[a:b]
    most = len(value) - len(value.lstrip(_JOINERS)) if left else 0
    last = len(value) - len(value.rstrip(_JOINERS)) if right else 0
    for i in {0: None} | dict.fromkeys(range(max(0, most - MOST_JOINERS), most + 1)):
        for j in {0: None} | dict.fromkeys(range(max(0, last - MOST_JOINERS), last + 1)):
            if b - j - a - i >= LEAST:
                yield a + i, b - j


def _candidates(text: str, spans: list[tuple[int, int, int, str]]) -> Iterator[list[tuple[int, int]]]:
    """Runs of credential characters, or what fixed finds leave of them, and their pieces.

    A run is followed by its pieces between ``=``, ``/`` and ``.``, if it has any.  Each is
    a list: itself, then, beside a fixed find, itself without the characters that join them.
    """
    low = 0
    for m in _RUN.finditer(text):
        while low < len(spans) and spans[low][2] <= m.start():
            low += 1
        high = low
        while high < len(spans) and spans[high][0] < m.end():
            high += 1
        near = spans[low:high]
        for start, stop, left, right in _rests(*m.span(), near):
            if stop - start < LEAST:
                continue
            yield list(_trimmed(text, start, stop, left, right))
            for p in _PIECE.finditer(text, start, stop):
                if p.span() != (start, stop):
                    first, last = not text[start : p.start()].strip("=/."), not text[p.end() : stop].strip("=/.")
                    yield list(_trimmed(text, *p.span(), left and first, right and last))


def spans_of(text: str | None, model: Model | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all finds in one text, in order."""
    if not text:
        return []
    base = base_spans(text)
    found = [(a, k, b) for a, k, b, _ in base]
    if model is not None:
        done = 0
        for forms in _candidates(text, base):
            for a, b in forms:
                if a >= done and model.is_secret(text[a:b]):
                    found.append((a, len(KINDS), b))
                    done = b
    names = (*KINDS, GRAMMAR)
    return [(a, b, names[k]) for a, k, b in sorted(found)]


def _scan(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, joined = [[], [], []], [], []
            for text in batch.column("text"):
                spans = spans_of(text.as_py(), model)
                parts = [f"{kind}:{a}:{b}" for a, b, kind in spans]
                base = [p for p, s in zip(parts, spans, strict=True) if s[2] != GRAMMAR]
                for column, kind in zip(counts, KINDS, strict=True):
                    column.append(sum(s[2] == kind for s in spans))
                digests.append(hashlib.sha256(",".join(base).encode()).hexdigest())
                joined.append(",".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``docs``.

    Spans are ``kind:start:end`` in code points, by start, then kind, joined by commas;
    a learned format's is of kind ``grammar``.  A null text counts as empty: no spans and
    the digest of the empty string.  Rows are neither moved nor dropped, repeated rows
    are scanned alike, other columns are ignored, an empty table gives an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_scan(model), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None, model: Model | None, mark: str = "[secret]") -> str | None:
    """The text with every find, or chain of touching finds, replaced by ``mark``."""
    spans = spans_of(text, model)
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with all finds in ``text`` replaced, and ``n_chars``, if there, counted anew.

    A null text stays null with its ``n_chars``; repeated rows are changed alike; rows are
    neither moved nor dropped; other columns stay as they are; an empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array((redacted(t.as_py(), model) for t in batch.column("text")), pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out
