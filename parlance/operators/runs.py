"""Runs of consecutive rows: local encoding of range-sorted chunks and a merge across their borders."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.operators.scans import same_as_before
from parlance.sources.shared import by_range, width, written

INNER, HEAD, TAIL, WHOLE = range(4)
FIELDS = ["part", "kind", "k", "entity", "label", "first_pos", "last_pos", "n", "s", "last_e", "e", "weight", "text"]
SCHEMA = "part int, kind int, k bigint, entity string, label string, first_pos bigint, last_pos bigint, n bigint, s double, last_e double, e double, weight bigint, text string"


def local_runs(batch: pa.RecordBatch, max_gap: float) -> dict:
    """The runs of one sorted batch, as columns."""
    s, e, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("s", "e", "weight"))
    breaks = ~(same_as_before(batch.column("entity")) & same_as_before(batch.column("label")) & (s[1:] - e[:-1] <= max_gap))
    at = np.concatenate([[0], np.flatnonzero(breaks) + 1])
    last = np.append(at[1:], len(s)) - 1
    take = lambda c, i: batch.column(c).take(pa.array(i)).to_pylist()
    texts = batch.column("text").to_pylist() if "text" in batch.schema.names else None
    joined = [None] * len(at) if texts is None else [" ".join(t for t in texts[a : b + 1] if t is not None) for a, b in zip(at.tolist(), last.tolist())]
    return {
        "entity": take("entity", at), "label": take("label", at), "first_pos": take("pos", at), "last_pos": take("pos", last), "n": (last - at + 1).tolist(),
        "s": s[at].tolist(), "last_e": e[last].tolist(), "e": np.maximum.reduceat(e, at).tolist(), "weight": np.add.reduceat(w, at).tolist(), "text": joined,
    }


def encoder(max_gap: float):
    """A function for mapInArrow: the runs of a range, its first and last marked. Holds one batch and one open run."""

    def encode(batches):
        part = TaskContext.get().partitionId()
        names = FIELDS[3:]
        opened, seen = None, 0
        entity, k = None, -1

        def out(rows: list[tuple], kinds: list[int]) -> pa.RecordBatch:
            nonlocal entity, k
            places = []
            for row in rows:
                k = k + 1 if k >= 0 and row[0] == entity else 0
                entity = row[0]
                places.append(k)
            cols = list(zip(*rows))
            types = [pa.string(), pa.string(), *[pa.int64()] * 3, *[pa.float64()] * 3, pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), pa.array(kinds, pa.int32()), pa.array(places, pa.int64()), *(pa.array(c, t) for c, t in zip(cols, types))], names=FIELDS)

        for batch in batches:
            if not batch.num_rows:
                continue
            runs = local_runs(batch, max_gap)
            rows = list(zip(*(runs[c] for c in names)))
            if opened is not None and follows(opened, rows[0], max_gap):
                rows[0] = combined(opened, rows[0])
            elif opened is not None:
                rows.insert(0, opened)
            opened = rows.pop()
            if rows:
                yield out(rows, [HEAD if not seen and not k else INNER for k in range(len(rows))])
                seen += len(rows)
        if opened is not None:
            yield out([opened], [TAIL if seen else WHOLE])

    return encode


def follows(a: tuple, b: tuple, max_gap: float) -> bool:
    return a[0] == b[0] and a[1] == b[1] and b[5] - a[6] <= max_gap


def combined(a: tuple, b: tuple) -> tuple:
    """The associative sum of two neighbouring summaries of one run."""
    return (*a[:3], b[3], a[4] + b[4], a[5], b[6], max(a[7], b[7]), a[8] + b[8], b[9] if a[9] is None else f"{a[9]} {b[9]}")


def merged_runs(rows: DataFrame, max_gap: float, numbered: bool = False) -> DataFrame:
    """Longest runs of rows that follow each other within an entity, have one label, and of which each starts
    at most max_gap after the end of the one before.

    rows: (entity, label, pos, s, e, weight) and perhaps text, s and e without nulls; null entities and labels are keys of
    their own. Gives (entity, label, first_pos, last_pos, n, s, last_e, e, weight, text, no, part): last_e is the end of
    the last row, e the latest, text the texts joined by blanks, no, if numbered, the run's number within the
    entity, from 1, by which (part, no) sorts them. No rows for none. Rows with equal s and pos come in order of e, label and weight.

    Rows are range-sorted by entity, s and pos, so a long entity spreads over many ranges. Each range encodes
    and numbers its runs; its first and last, two rows a range at most, are merged with their neighbours', and what
    an entity had in the ranges before is added to its numbers, one row a range. No text moves for that.
    """
    order = ["entity", "s", "pos", "e", "label", "weight"]
    told = ["text"] if "text" in rows.columns else []
    ranges = rows.select("entity", "label", "pos", "s", "e", F.col("weight").cast("bigint").alias("weight"), *told).repartitionByRange(width(rows.sparkSession), *order).sortWithinPartitions(*order)
    found = written(ranges.mapInArrow(encoder(max_gap), SCHEMA), "runs")
    w = Window.partitionBy("entity").orderBy("part", "kind")
    edges = found.where(F.col("kind") != INNER)
    joins = F.col("label").eqNullSafe(F.lag("label").over(w)) & (F.lag("part").over(w) < F.col("part")) & (F.col("s") - F.lag("last_e").over(w) <= max_gap)
    edges = edges.withColumn("fresh", F.when(joins, 0).otherwise(1)).withColumn("g", F.sum("fresh").over(w)).withColumn("at", F.struct("part", "kind"))
    # an entity is consecutive, so at most the first of a range has been in another before: one row a range
    goes_on = edges.where(F.col("fresh") == 0).select(F.col("part").alias("_p"), F.col("entity").alias("_e"), F.lit(1).alias("goes_on"))
    same = (F.col("part") == F.col("_p")) & F.col("entity").eqNullSafe(F.col("_e"))
    sizes = found.groupBy("part", "entity").agg((F.max("k") + 1).alias("n")).join(by_range(goes_on), same, "left").withColumn("goes_on", F.coalesce("goes_on", F.lit(0))).drop("_p", "_e")
    before = F.sum(F.col("n") - F.col("goes_on")).over(Window.partitionBy("entity").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offset = sizes.withColumn("offset", F.coalesce(before, F.lit(0)) - F.col("goes_on")).where(F.col("offset") != 0).select(F.col("part").alias("_p"), F.col("entity").alias("_e"), "offset")

    def with_no(rows: DataFrame) -> DataFrame:
        if not numbered:
            return rows.withColumn("no", F.lit(None).cast("bigint"))
        told = rows.join(by_range(offset), same, "left")
        return told.withColumn("no", F.col("k") + 1 + F.coalesce("offset", F.lit(0)))

    across = with_no(edges).groupBy("entity", "g").agg(F.first("label").alias("label"), F.min_by("first_pos", "at").alias("first_pos"), F.max_by("last_pos", "at").alias("last_pos"), F.sum("n").alias("n"), F.min_by("s", "at").alias("s"), F.max_by("last_e", "at").alias("last_e"), F.max("e").alias("e"), F.sum("weight").alias("weight"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), " ").alias("text"), F.min("no").alias("no"), F.min("part").alias("part"))
    names = [*FIELDS[3:], "no", "part"]
    return with_no(found.where(F.col("kind") == INNER)).select(*names).unionByName(across.select(*names))
