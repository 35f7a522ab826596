"""Dense surrogate keys that do not depend on how the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.scratch import materialise

# monotonically_increasing_id holds the partition above its 33 row bits.
_ROW_BITS = 33


def dense_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``name`` = position of the row in the order of ``order``, from 0.

    The order must be total.  Rows are range-partitioned, sorted and written to
    reliable storage; what crosses the driver is one count per partition.  No task
    sees more than its own range.
    """
    placed = materialise(df.orderBy(*order)).withColumn(
        "_slot", F.monotonically_increasing_id()
    )
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).count().collect()
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        starts.append((row["_part"], total))
        total += row["count"]
    schema = T.StructType(
        [T.StructField("_part", T.LongType()), T.StructField("_start", T.LongType())]
    )
    # One row per partition of the range shuffle: bounded by the partition count.
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, schema))
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .select((F.col("_start") + row).alias(name), *df.columns)
    )


def attach_dense_key(df: DataFrame, unique: str, name: str) -> DataFrame:
    """Adds the dense key of the unique column ``unique`` to a wide table.

    Only that column is sorted and stored; the wide rows are shuffled once, on
    evenly spread values.
    """
    keys = dense_key(df.select(unique), [unique], name)
    keys = keys.withColumnRenamed(unique, "_unique")
    joined = df.join(keys, F.col(unique).eqNullSafe(F.col("_unique")), "left")
    return joined.select(name, *df.columns)
