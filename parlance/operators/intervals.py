"""Continuous periods and gaps of overlapping intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.operators.scans import same_as_before
from parlance.sources.shared import by_range, width, written

INNER, HEAD, TAIL, WHOLE, GAP, SUM = range(6)
SCHEMA = "part int, kind int, sure int, entity string, label string, s double, e double, n bigint, net bigint, low bigint"


def sweep(batches):
    """Sums the events of one sorted range and gives its stretches.

    The count is known to be 0 where a key begins. At the start of the range it isn't: there it is taken to be
    the smallest that never falls below 0, which is right whenever the range sees a point of silence. If the
    first key fills the whole range, both readings go out (sure 1: as taken; 2: one stretch without silence),
    and the sums of the ranges before decide.
    """
    part = TaskContext.get().partitionId()
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    t, d = rows["t"].to_numpy(), rows["d"].to_numpy().astype(np.int64)
    change = ~(same_as_before(rows["entity"]) & same_as_before(rows["label"]))
    first = np.concatenate([[0], np.flatnonzero(change) + 1])
    total = np.cumsum(d)
    end_of_first = int(first[1]) if len(first) > 1 else len(d)
    low = max(0, -int(total[:end_of_first].min()))
    base = np.concatenate([[-low], total[first[1:] - 1]])
    count = total - np.repeat(base, np.diff(np.append(first, len(d))))
    opens = np.zeros(len(d), bool)
    opens[first] = True
    opens[1:] |= count[:-1] == 0
    at = np.flatnonzero(opens)
    last = np.append(at[1:], len(d)) - 1
    n = np.add.reduceat((d > 0).astype(np.int64), at)
    kind = np.full(len(at), INNER)
    kind[0], kind[-1] = HEAD, TAIL
    if len(at) == 1:
        kind[0] = WHOLE
    sure = np.zeros(len(at), int)
    alone = len(first) == 1
    if alone:
        sure[:] = 1
    entity, label = rows["entity"].take(pa.array(at)), rows["label"].take(pa.array(at))
    next_same = same_as_before(entity) & same_as_before(label)
    g = np.flatnonzero(next_same)

    def out(kind, sure, entity, label, s, e, n, net=0, low=0):
        size = len(s)
        ints = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), size).astype(np.int64)).cast(t)
        text = lambda x: (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x).cast(pa.string())
        return pa.RecordBatch.from_arrays([ints(part, pa.int32()), ints(kind, pa.int32()), ints(sure, pa.int32()), text(entity), text(label), pa.array(s, pa.float64()), pa.array(e, pa.float64()), ints(n, pa.int64()), ints(net, pa.int64()), ints(low, pa.int64())], names=["part", "kind", "sure", "entity", "label", "s", "e", "n", "net", "low"])

    yield out(kind, sure, entity, label, t[at], t[last], n)
    if len(g):
        yield out(GAP, sure[g], entity.take(pa.array(g)), label.take(pa.array(g)), t[last[g]], t[at[g + 1]], 0)
    one = lambda c: rows[c].slice(0, 1)
    if alone:
        yield out(WHOLE, [2], one("entity"), one("label"), t[:1], t[-1:], [int((d > 0).sum())])
    yield out(SUM, [1 if alone else 0], one("entity"), one("label"), t[:1], t[-1:], 0, int(total[-1]), low)


def periods_and_gaps(intervals: DataFrame, entity: str, label: str, start: str, end: str, tie: str | None = None) -> DataFrame:
    """(entity, label, kind, s, e, n): every longest stretch covered without silence, with its number of
    intervals n, and every gap between neighbouring stretches of one entity and label (n 0).

    Intervals that touch are one stretch. Rows with a null, NaN or non-positive extent must be filtered out
    before. Null entities and labels are keys of their own. Empty input gives no rows. tie names a column that
    tells intervals of equal times apart, so that any number of these may be split over ranges too.

    Sweep line: each interval becomes a plus and a minus event, the events are range-sorted by key and time,
    and counts are prefix sums: within each range by numpy, over the ranges by a sum of one row per range. A
    key's events may fill any number of ranges, so no key has to fit a task.
    """
    spark = intervals.sparkSession
    events = intervals.select(F.col(entity).alias("entity"), F.col(label).alias("label"), F.explode(F.array(F.struct(F.col(start).cast("double").alias("t"), F.lit(1).cast("tinyint").alias("d")), F.struct(F.col(end).cast("double").alias("t"), F.lit(-1).cast("tinyint").alias("d")))).alias("x"), *([F.col(tie).alias("tie")] if tie else [])).select("entity", "label", "x.t", "x.d", *(["tie"] if tie else []))
    order = [F.col("entity"), F.col("label"), F.col("t"), F.col("d").desc(), *([F.col("tie")] if tie else [])]
    ranges = events.repartitionByRange(width(spark), *order).sortWithinPartitions(*order)
    found = written(ranges.mapInArrow(sweep, SCHEMA), "stretches")

    # one row per range: its number is bounded by the partitions of the shuffle, whatever the input
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = found.where(F.col("kind") == SUM).select("part", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("carry"), "low").withColumn("right", F.col("carry") == F.col("low"))
    rows = found.where(F.col("kind") != SUM).drop("net", "low").join(by_range(carry.drop("low")), "part")
    rows = rows.where((F.col("sure") == 0) | ((F.col("sure") == 1) & F.col("right")) | ((F.col("sure") == 2) & ~F.col("right")))

    inner = rows.where(F.col("kind").isin(INNER, GAP)).select("entity", "label", F.when(F.col("kind") == GAP, "gap").otherwise("period").alias("kind"), "s", "e", "n")

    # first and last stretch of each range, two rows per range at most, joined across the borders
    w = Window.partitionBy("entity", "label").orderBy("part", "kind")
    edges = rows.where(F.col("kind").isin(HEAD, TAIL, WHOLE)).withColumn("fresh", (F.col("kind") == TAIL) | (F.col("carry") == 0))
    edges = edges.withColumns({"g": F.sum(F.col("fresh").cast("int")).over(w), "before_e": F.lag("e").over(w), "before_part": F.lag("part").over(w)})
    joined = edges.groupBy("entity", "label", "g").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n")).select("entity", "label", F.lit("period").alias("kind"), "s", "e", "n")
    across = edges.where(F.col("fresh") & (F.col("before_part") < F.col("part"))).select("entity", "label", F.lit("gap").alias("kind"), F.col("before_e").alias("s"), F.col("s").alias("e"), F.lit(0).cast("bigint").alias("n"))
    return inner.unionByName(joined).unionByName(across)


def speaker_periods(segments: DataFrame) -> DataFrame:
    """periods_and_gaps of every session and stored label, over usable segments delivered once."""
    from parlance.operators.segments import delivered_once, stored_label, usable

    once = delivered_once(segments, F.col("start_s"), F.col("end_s"), stored_label(F.col("speaker")).alias("label"))
    return periods_and_gaps(once.where(usable()), "session_id", "label", "start_s", "end_s", tie="pos")


def found_periods(segments: DataFrame, max_gap_s: float = 600.0) -> DataFrame:
    """Periods of two or more segments and gaps of at most max_gap_s, in milliseconds."""
    from parlance.operators.segments import milliseconds

    all_of = speaker_periods(segments)
    gap = F.col("kind") == "gap"
    kept = all_of.where((~gap & (F.col("n") >= 2)) | (gap & (F.col("e") - F.col("s") <= max_gap_s)))
    return kept.select(F.col("entity").alias("session_id"), F.col("label").alias("speaker"), "kind", milliseconds(F.col("s")).alias("start_ms"), milliseconds(F.col("e")).alias("end_ms"))
