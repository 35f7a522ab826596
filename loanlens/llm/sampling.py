"""Bounded samples of documents by hash of their ids, and column names nobody uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until no column is called so in any case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def draw_ids(rows: DataFrame, each: int, group: Sequence[str] = ()) -> DataFrame:
    """(group columns, doc_id, place): per group the ``each`` distinct ids of least hash.

    An id counts once, however many rows have it; null is none.  Only a share of the ids,
    a little more than is needed, is ranked; groups that this leaves short, since
    few ids have most of their rows, are ranked whole.
    """
    ids = rows.select(*group, "doc_id").where(F.col("doc_id").isNotNull())
    sizes = ids.groupBy(*group).count().collect()
    order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")

    def ranked(some: DataFrame) -> DataFrame:
        places = some.distinct().withColumn("place", F.row_number().over(order))
        return places.where(F.col("place") <= each)

    limit, short = F.lit(0), []
    for row in sizes:
        share = min(1.0, (2 * each + 100) / max(1, row["count"]))
        mine = F.lit(True)
        for c in group:
            mine = mine & F.col(c).eqNullSafe(F.lit(row[c]))
        limit = F.when(mine, F.lit(int(share * (1 << 30)))).otherwise(limit)
        short += [mine] if share < 1 else []
    found = ranked(ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < limit))
    if not short:
        return found
    # One row per group, as many as were counted above.
    have = found.groupBy(*group).count().where(F.col("count") >= each).collect()
    full = F.lit(False)
    for row in have:
        mine = F.lit(True)
        for c in group:
            mine = mine & F.col(c).eqNullSafe(F.lit(row[c]))
        full = full | mine
    if len(have) == len(sizes):
        return found
    return found.where(full).unionByName(ranked(ids.where(~full)))


def one_text_each(docs: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    """(columns of ``ids``, text): for each drawn row one text of its id, that of least hash.

    ``ids`` is a bounded sample and goes to every task; of an id with many rows each
    task sends one text.
    """
    texts = docs.join(F.broadcast(ids), list(on))
    best = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return texts.groupBy(*ids.columns).agg(best)
