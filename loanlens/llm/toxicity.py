"""Toxicity scores by non-negative positive-unlabelled learning.

Documents labelled toxic are the positives, any other documents the unlabelled rest,
toxic ones among them included.  A linear model over the distinct words of a text is
fitted in numpy to the class-prior-corrected risk, whose estimate of the negatives' part
is kept from falling below zero.  The margin from which a text counts as toxic has the
least error corrected in the same way: labels of clean documents serve to estimate the
class prior and for nothing else.
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

#: Words are hashed into so many features.
FEATURE_BITS = 20
#: At most so many labelled and so many unlabelled documents are learned from, those with
#: the smallest hashes of their ids.
SAMPLE = 8000
#: A word counts as noise until it moves the risk by so many standard errors.
NOISE = 3.0
ROUNDS = 200
#: Least and greatest slope of the map from margin to score.
SLOPES = (1.0, 50.0)
RATE = 0.1
FOLDS = 5


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = 0) -> Column:
    """Whether crc32 of the id's text leaves the remainder ``fold``; a null id doesn't."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct word features per row; none for null or wordless texts."""
    for _, part in tokens.pieces(texts):
        words, first = tokens.word_hashes(part, tokens.PUNCTUATION)
        buckets = (words >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)
        for i in range(len(part)):
            yield np.unique(buckets[first[i] : first[i + 1]])


@dataclass
class Model:
    """Weights of the features that matter, and the map from margin to probability."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


class _Rows:
    """Sparse 0/1 rows over compact columns."""

    def __init__(self, rows: list[np.ndarray], kept: np.ndarray) -> None:
        flat = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        at = np.minimum(np.searchsorted(kept, flat), max(0, len(kept) - 1))
        known = kept[at] == flat if len(kept) else np.zeros(len(flat), bool)
        self.n, self.width = len(rows), len(kept)
        self.owner, self.column = owner[known], at[known]

    def margins(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.owner, weights[self.column], minlength=self.n)

    def pull(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, per_row[self.owner], minlength=self.width)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) that minimise the non-negative risk.

    The risk is ``prior * loss(P as 1) + max(0, loss(U as 0) - prior * loss(P as 0))``;
    where the second part is negative its gradient is turned round.  The steps are
    Adam's with soft thresholds: a weight stays 0 while its gradient is within ``NOISE``
    standard errors of chance.
    """
    every = positive + unlabelled
    names, seen = np.unique(np.concatenate([*every, np.zeros(0, np.int32)]), return_counts=True)
    kept = names[seen >= 3].astype(np.int64)
    p, u = _Rows(positive, kept), _Rows(unlabelled, kept)
    share = (np.bincount(u.column, minlength=len(kept)) + np.bincount(p.column, minlength=len(kept))) / len(every)
    threshold = NOISE * prior * np.sqrt(share * (1 / p.n + 1 / u.n))
    weights, bias = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for turn in range(1, ROUNDS + 1):
        gp, gu = p.margins(weights, bias), u.margins(weights, bias)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        as_one, as_zero = -_sigmoid(-gp) * prior / p.n, _sigmoid(gp) * prior / p.n
        rest = _sigmoid(gu) / u.n
        if negative >= 0:
            on_p, on_u = as_one - as_zero, rest
        else:
            on_p, on_u = as_zero, -rest
        gradient = np.append(p.pull(on_p) + u.pull(on_u), on_p.sum() + on_u.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        scale = RATE / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
        step = scale * m / (1 - 0.9**turn)
        weights = weights - step[:-1]
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - scale[:-1] * threshold)
        bias -= step[-1]
    live = weights != 0
    return kept[live], weights[live], float(bias)


def calibrate(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset of the logistic map from margin to score, without negative labels.

    The score is 0.5 at the margin with the least class-prior-corrected error: missed
    positives weigh ``prior``, and wrongly found are the unlabelled rows found beyond
    the positives expected among them.  Of equal margins the largest is taken.  The slope
    brings the mean score of the unlabelled rows as near to ``prior`` as it can.
    """
    levels = np.unique(np.concatenate([positive, unlabelled]))
    missed = np.searchsorted(np.sort(positive), levels) / max(1, len(positive))
    found = 1 - np.searchsorted(np.sort(unlabelled), levels) / max(1, len(unlabelled))
    error = prior * missed + np.maximum(0.0, found - prior * (1 - missed))
    best = len(error) - 1 - int(error[::-1].argmin())
    cut = (levels[best] + levels[max(0, best - 1)]) / 2
    slopes = np.geomspace(*SLOPES, 40)
    means = np.array([_sigmoid(k * (unlabelled - cut)).mean() for k in slopes])
    slope = float(slopes[np.abs(means - prior).argmin()])
    return slope, -slope * float(cut)


def _sampled(docs: DataFrame, ids: DataFrame) -> list:
    """(kind, label, features) of the documents named in a small table of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("label", pa.int32()), ("words", pa.binary())])
        for batch in batches:
            words = [f.tobytes() for f in features(batch.column("text"))]
            columns = [batch.column("kind"), batch.column("label"), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = sampling.one_text_each(docs, ids, ["doc_id"]).select("text", "kind", "label")
    return rows.mapInArrow(run, "kind int, label int, words binary").collect()


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> Model | None:
    """A model from labels of documents outside fold 0; None without both kinds of label.

    Learned from are at most ``sample`` labelled and ``sample`` other documents, chosen
    by hash of doc_id; an id counts once, with one of its texts and its greatest label.
    Only their word features (a few kB each) reach the driver.
    """
    open_rows = lambda df: df.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds))
    valid = open_rows(labels.select("doc_id", "toxic")).where("toxic in (0, 1)")
    marked = (
        valid.join(F.broadcast(scratch.materialise(sampling.draw_ids(valid, sample))), "doc_id")
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
        .select("doc_id", F.lit(0).alias("kind"), "label")
    )
    others = sampling.draw_ids(open_rows(docs.select("doc_id")), sample).select(
        "doc_id", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("label")
    )
    drawn = scratch.materialise(marked.unionByName(others))
    rows = sorted(
        ((r.kind, r.label, r.words) for r in _sampled(docs.select("doc_id", "text"), drawn)),
        key=lambda r: (r[0], r[1] or 0, r[2]),
    )
    words = [np.frombuffer(r[2], np.int32) for r in rows]
    label = np.array([-1 if r[1] is None else r[1] for r in rows])
    known = label >= 0
    if not known.any() or not 0 < label[known].mean() < 1:
        return None
    pick = lambda mask: [words[i] for i in np.flatnonzero(mask)]
    prior = float(label[known].mean())
    positive, unlabelled = pick(label == 1), pick(~known) or pick(known)
    kept, weights, bias = fit(positive, unlabelled, prior)
    margin = lambda rows: _Rows(rows, kept).margins(weights, bias)
    return Model(kept, weights, bias, *calibrate(margin(positive), margin(unlabelled), prior))


def _scorer(model: Model | None, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << FEATURE_BITS)
        if model is not None:
            table[model.kept] = model.weights
        for batch in batches:
            out = [np.zeros(0)]
            for _, part in tokens.pieces(batch.column("text")):
                words, first = tokens.word_hashes(part, tokens.PUNCTUATION)
                buckets = (words >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
                at = np.flatnonzero(table[buckets])
                row = np.searchsorted(first, at, "right") - 1
                pairs = np.unique(row << FEATURE_BITS | buckets[at])
                sums = np.bincount(pairs >> FEATURE_BITS, table[pairs & (1 << FEATURE_BITS) - 1], minlength=len(part))
                if model is None:
                    out.append(np.zeros(len(part)))
                else:
                    out.append(model.probability(model.bias + sums))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns[name] = pa.array(np.concatenate(out))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def score(docs: DataFrame, model: Model | None, column: str = "score") -> DataFrame:
    """``docs`` with the probability of the toxic label of each whole text.

    Null and empty texts get the score of a text without any known word; without a
    model every score is 0.  Repeated rows score alike; a column of the new name is
    replaced; an empty table stays empty.  Rows are neither moved nor dropped.
    """
    docs = docs.drop(column)
    name = sampling.unused("score", docs)
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(_scorer(model, name), f"{fields}, `{name}` double").withColumnRenamed(name, column)


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns.

    Null and empty texts stay unless texts without any known word are rejected; without
    a model every row stays; repeated rows stay or go together; an empty table stays
    empty.
    """
    name = sampling.unused("toxic_score", docs)
    return score(docs, train(docs, labels), name).where(F.col(name) < threshold).drop(name)
