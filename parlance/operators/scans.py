"""A global order in ranges of bounded size, and prefix computations over it.

Spark's own window over one key puts the key into one task. Here rows are range-sorted first, whatever the key,
and only what crosses a border of two ranges, a row or two of each range, is brought together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.sources.shared import by_range, width, written


def same_as_before(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """For each row but the first, whether its value equals the one before; two nulls are equal."""
    now, before = column.slice(1), column.slice(0, max(0, len(column) - 1))
    both_null = pc.and_(pc.is_null(now), pc.is_null(before))
    return np.asarray(pc.or_(both_null, pc.fill_null(pc.equal(now, before), False)))


def in_ranges(rows: DataFrame, order: list[Column | str], name: str = "ranges", within: str | None = None) -> DataFrame:
    """rows with part, the number of their range, and k, their place in it: (part, k) sorts by `order`.

    Written once, so that readers agree on the borders. Null keys come first. `order` should tell rows apart.
    within names the column `order` begins with; k then is the place among the rows of the range with its value.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("k", T.LongType())])
    ranges = rows.repartitionByRange(width(rows.sparkSession), *order).sortWithinPartitions(*order)

    def place(batches):
        part, k, last = TaskContext.get().partitionId(), 0, None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            at = np.arange(k, k + n)
            if within:
                key = b.column(within)
                new = np.concatenate([[last is None or not same_as_before(pa.concat_arrays([last, key.slice(0, 1)]))[0]], ~same_as_before(key)])
                starts = np.flatnonzero(new)
                begins = np.concatenate([[0], starts])[np.cumsum(new)]
                at = np.arange(n) - begins + np.where(np.cumsum(new) == 0, k, 0)
                last = key.slice(n - 1, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * n, pa.int32()), pa.array(at, pa.int64())], names=[*b.schema.names, "part", "k"])
            k = int(at[-1]) + 1

    return written(ranges.mapInArrow(place, schema), name)


def numbered_within(rows: DataFrame, entity: str, order: list[Column | str], as_name: str) -> DataFrame:
    """rows with their number within the entity, from 1, in the given order, which begins with the entity.

    Rows are numbered where the ranges put them; an entity that goes on from the range before adds what it had
    there. Only keys are shuffled for that.
    """
    placed = in_ranges(rows, order, within=entity)
    sizes = placed.groupBy("part", entity).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(entity).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # an entity is consecutive, so only the first of a range has been in another before: one row a range
    going_on = sizes.withColumn("_before", F.sum("_n").over(before)).where(F.col("_before") > 0).select(F.col("part").alias("_p"), F.col(entity).alias("_e"), "_before")
    out = placed.join(by_range(going_on), (F.col("part") == F.col("_p")) & F.col(entity).eqNullSafe(F.col("_e")), "left")
    return out.select(*rows.columns, (F.col("k") + 1 + F.coalesce("_before", F.lit(0))).alias(as_name))


def filled_forward(rows: DataFrame, order: list[Column | str], value: str, as_name: str) -> DataFrame:
    """rows with the last value that isn't null at or before them in the given order; an as-of lookup without a key."""
    placed = in_ranges(rows, order)
    here = Window.partitionBy("part").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    last = placed.where(F.col(value).isNotNull()).groupBy("part").agg(F.max_by(value, "k").alias("_last"))
    parts = placed.select("part").distinct().join(last, "part", "left")
    # one row a range, with a value of any length: Spark decides by its size how to join it
    carried = parts.withColumn("_carry", F.last("_last", ignorenulls=True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", "_carry")
    out = placed.withColumn("_here", F.last(value, ignorenulls=True).over(here)).join(carried, "part")
    return out.select(*rows.columns, F.coalesce("_here", "_carry").alias(as_name))
