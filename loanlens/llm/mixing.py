"""Mixing sources to target weights, with DataFrame operations only.

Words are counted per source; each source gets a target share of the whole budget and
a repetition rate; a document is then emitted ``floor(rate)`` times, plus once more
with probability equal to the fraction, decided by a seeded hash of its id, source and
text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens import scratch
from loanlens.llm.sampling import unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix"
#: Up to so many sources the table of targets goes to every task, else it is joined by shuffle.
BROADCAST_SOURCES = 100_000

#: Columns the operator adds; columns of these names in its input are replaced.
ADDED = ("size", "draw", "source_size", "target", "copies", "taken", "copy")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and tab to carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from rows with ``source`` and ``size``.

    The sources in code point order, null last, have ``weights`` in turn and share
    ``share`` of all sizes.  No target exceeds ``most`` times its source's size: with
    the sources in order of limit per weight, the common level is the largest quotient
    of what remains and the weight that remains.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1)
    limit = F.col("source_size") * F.lit(float(most))
    rising = Window.orderBy(limit / F.col("weight"), "place")
    left = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)) - (
        F.sum(limit).over(rising.rowsBetween(Window.unboundedPreceding, 0)) - limit
    )
    heavy = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    level = F.max("quotient").over(Window.partitionBy())
    return (
        sources.withColumn("place", place)
        .withColumn("weight", turn)
        .withColumn("quotient", left / heavy)
        .withColumn("target", F.least(limit, level * F.col("weight")))
        .select("source", "source_size", "target")
    )


def uniform(*keys: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on ``keys`` and ``seed`` only; null counts as ''."""
    texts = [F.coalesce(key.cast("string"), F.lit("")) for key in keys]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *texts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def with_sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with the word count of ``text`` as ``size``, and a number that decides.

    ``draw`` hashes id, source and text: rows that share an id, or have none, draw for
    themselves unless they are alike in all three.
    """
    draw = uniform(F.col("doc_id"), F.col("source"), F.col("text"), seed=seed)
    return docs.drop(*ADDED).withColumns({"size": word_count(F.col("text")), "draw": draw})


def mix(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """Every row of ``sized`` (doc_id, source, size, draw, ...) with the mix's decision.

    Adds source_size, target, ``copies`` (how often the mix holds the row) and
    ``taken`` (the words it takes thereby).  A null size counts as 0, as does a null draw;
    null is a source of its own, the last one; rows alike in id, source and text get one
    decision; a source without words has target 0 and rate 0; an empty table gives an
    empty one.  Columns named like an added one are replaced, all others are kept.

    Per-source sums are combined before the shuffle, so a source with most rows costs
    one row per task; the sources themselves (one row each) are ranked in one task.
    """
    rows = sized.drop(*ADDED[2:]).withColumn("size", F.coalesce("size", F.lit(0)).cast("long"))
    key = unused("source_key", sized)
    targets = scratch.materialise(
        source_targets(rows.select("source", "size"), weights, share, most)
    ).withColumnRenamed("source", key)
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    extra = F.coalesce("draw", F.lit(0.0)) < rate - F.floor(rate)
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col(key)))
        .drop(key)
        .withColumn("copies", F.floor(rate) + extra.cast("long"))
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, numbered from 1 in ``copy``, which is replaced.

    Rows with no copies, or null, are left out; repeated rows are repeated each; an
    empty table gives an empty one.
    """
    return (
        mixed.where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
