"""Language identification from averaged embeddings of hashed subwords.

A text's vector is the mean embedding of its subwords: byte runs of one to four bytes
within words, the space before and after a word included, hashed into a table.  A linear
softmax over that mean gives the language.  Embeddings and softmax are trained together
by stochastic gradient descent in numpy.  Probabilities are calibrated by a temperature
on documents kept out of the training, which also set the level below which a prediction
is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens import scratch
from loanlens.llm import sampling, tokens

#: Subwords are hashed into so many embeddings of so many numbers.
BUCKET_BITS = 16
WIDTH = 16
SIZES = (2, 3, 4)
#: At most so many documents are learned from, shared evenly by the languages; of them
#: every fifth is kept for calibration.
SAMPLE = 2400
EPOCHS = 6
RATE = 0.3
#: Share of correct predictions that the rejection level may refuse.
REFUSED = 0.01
UNKNOWN = "und"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[_LETTER] = np.arange(256, dtype=np.uint8)[_LETTER]
_PLAIN[65:91] += 32


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id's text leaves the remainder ``fold``; a null id doesn't."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def subwords(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per subword size the hashed subwords of all rows, and the first of each row."""
    raw, offsets = tokens.text_bytes(texts)
    n = len(texts)
    # One space before each row and after the last keeps rows apart.
    padded = np.full(len(raw) + n + 1, 32, np.uint8)
    row = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(raw)) + row + 1] = _PLAIN[raw]
    begin = offsets[:-1] + np.arange(n)
    letter = padded != 32
    packed = padded.astype(np.uint32)
    for size in SIZES:
        count = len(padded) - size + 1
        if count <= 0:
            yield np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
            continue
        value, inner = packed[:count].copy(), np.ones(count, bool)
        for j in range(1, size):
            value = (value << np.uint32(8)) | packed[j : j + count]
            if j < size - 1:
                inner &= letter[j : j + count]
        if size == 2:
            inner = letter[:count] | letter[1 : 1 + count]
        at = np.flatnonzero(inner)
        buckets = (value[at] * np.uint32(2654435761 + 2 * size)) >> np.uint32(32 - BUCKET_BITS)
        yield buckets.astype(np.int64), np.append(np.searchsorted(at, begin), len(at))


def _sums(table: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per row the sum of the table's rows over all its subwords, and their number."""
    total, seen = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts), np.int64)
    for buckets, first in subwords(texts):
        n = np.diff(first)
        filled = n > 0
        if not filled.any():
            continue
        start = first[:-1][filled]
        for k in range(table.shape[1]):
            total[filled, k] += np.add.reduceat(table[:, k][buckets], start)
        seen += n
    return total, seen


def _long_sums(table: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    totals, counts = [np.zeros((0, table.shape[1]))], [np.zeros(0, np.int64)]
    for _, part in tokens.pieces(texts, tokens.WINDOW // 2):
        total, seen = _sums(table, part)
        totals.append(total)
        counts.append(seen)
    return np.concatenate(totals), np.concatenate(counts)


@dataclass
class Model:
    """Languages, per bucket their scores or an embedding, and the last layer."""

    languages: list[str]
    table: np.ndarray
    last: np.ndarray
    bias: np.ndarray
    temperature: float
    level: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """One row per text; a text without subwords gets the bias alone."""
        total, seen = _long_sums(self.table, texts)
        mean = total / np.maximum(seen, 1)[:, None]
        return softmax((mean @ self.last + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row its distinct subwords and their shares."""
    for _, part in tokens.pieces(texts, tokens.WINDOW // 2):
        lists = list(subwords(part))
        for i in range(len(part)):
            own = np.concatenate([b[f[i] : f[i + 1]] for b, f in lists])
            names, counts = np.unique(own, return_counts=True)
            yield names.astype(np.int32), (counts / max(1, len(own))).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, classes: int, seed: int = 7):
    """(embeddings, last layer, bias) by stochastic gradient descent, one text a step."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (1 << BUCKET_BITS, WIDTH)).astype(np.float32) / WIDTH
    last, bias = np.zeros((WIDTH, classes), np.float32), np.zeros(classes, np.float32)
    last += rng.normal(0, 0.1, last.shape)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            names, share = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(names):
                continue
            mean = share @ table[names]
            scores = mean @ last + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[label[i]] -= 1
            # The mean of many subwords moves little; their step is scaled by its spread.
            table[names] -= (rate * (share / np.sqrt(share @ share)))[:, None] * (last @ error)
            last -= rate * np.outer(mean, error) * WIDTH
            bias -= 0.1 * rate * error
    return table, last, bias


def _temperature(scores: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least log loss, from a fixed grid."""
    grid = np.exp(np.linspace(np.log(0.5), np.log(20), 75))
    rows = np.arange(len(label))
    return float(min(grid, key=lambda t: -np.log(softmax(scores / t)[rows, label] + 1e-12).mean()))


def train(docs: DataFrame, sample: int = SAMPLE, folds: int = 3, fold: int = 1) -> Model | None:
    """A model from text and lang of documents outside the held-out fold; None without any.

    Learned from are at most ``sample`` documents with text and lang, or one per language
    if there are more languages, an equal number of each at most, chosen by hash of doc_id;
    an id counts once, with one of its texts.  Their subword counts reach the driver.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), folds, fold)
    )
    languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    if not languages:
        return None
    chosen = sampling.draw_ids(known, max(1, sample // len(languages)), ["lang"])
    texts = sampling.one_text_each(known, scratch.materialise(chosen), ["doc_id", "lang"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("place", pa.int32()), ("lang", pa.string()), ("names", pa.binary()), ("shares", pa.binary())])
        for batch in batches:
            found = list(bags(batch.column("text")))
            columns = [
                batch.column("place"), batch.column("lang"),
                pa.array([n.tobytes() for n, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = texts.select("place", "lang", "text").mapInArrow(run, "place int, lang string, names binary, shares binary").collect()
    rows = sorted((r.place, r.lang, r.names, r.shares) for r in rows)
    if not rows:
        return None
    bag = [(np.frombuffer(r[2], np.int32), np.frombuffer(r[3], np.float32)) for r in rows]
    label = np.array([languages.index(r[1]) for r in rows])
    kept = np.array([r[0] % 5 == 0 for r in rows])
    if not kept.any() or kept.all():
        kept[:] = False
    learn = np.flatnonzero(~kept)
    table, last, bias = fit([bag[i] for i in learn], label[learn], len(languages))
    probe = np.flatnonzero(kept) if kept.any() else learn
    scores = np.stack([(s @ table[n] if len(n) else np.zeros(WIDTH)) @ last + bias for n, s in (bag[i] for i in probe)])
    temperature = _temperature(scores, label[probe])
    sure = softmax(scores / temperature)
    right = sure.argmax(axis=1) == label[probe]
    level = float(np.quantile(sure.max(axis=1)[right], REFUSED)) if right.any() else 0.0
    if len(languages) <= WIDTH:
        table, last = table @ last, np.eye(len(languages), dtype=np.float32)
    return Model(languages, np.asarray(table, np.float32), last, bias, temperature, level)


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            if model is None or not batch.num_rows:
                names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
                accepted = np.zeros(batch.num_rows, bool)
            else:
                sure = model.probabilities(batch.column("text"))
                score = np.where(lettered, sure.max(axis=1), 0.0)
                names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(sure.argmax(axis=1), lettered, strict=True)]
                accepted = lettered & (score >= model.level)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return run


def predict(docs: DataFrame, model: Model | None, folds: int = 3, fold: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted for every row of ``docs``.

    ``score`` is the calibrated probability of ``lang_pred``, over the whole text;
    ``accepted`` is false where it lies below the model's level.  A null text and one
    without a letter are ``und`` with score 0, as is every text if there is no model.
    Repeated rows are predicted alike, other columns are ignored, an empty table gives
    an empty one.  Rows are neither moved nor dropped.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), "text",
        held_out(F.col("doc_id"), folds, fold).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")
