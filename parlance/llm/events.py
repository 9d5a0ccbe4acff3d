"""Problem 3: repeated consecutive events of a sequence collapsed into runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators.runs import merged_runs
from parlance.operators.segments import delivered_once, milliseconds, split_label, unified, usable
from parlance.sources.shared import written


def speaker_runs(segments: DataFrame, speaker_names: DataFrame, max_gap_s: float = 5.0) -> DataFrame:
    """Longest runs of usable segments of one unified speaker, single segments included.

    Gives (session_id, speaker, first_pos, last_pos, n_events, start_s, end_s); end_s is the latest end.
    Repeated deliveries count once; null or empty speakers are UNKNOWN; a null session is one of its own;
    segments without usable times are left out. Equal starts are ordered by pos. No rows for no segments.
    """
    once = delivered_once(segments, F.col("start_s"), F.col("end_s"), *split_label(F.col("speaker"))).where(usable())
    rows = unified(once, speaker_names).select(F.col("session_id").alias("entity"), F.col("speaker").alias("label"), "pos", F.col("start_s").alias("s"), F.col("end_s").alias("e"), F.lit(1).alias("weight"))
    # written before it is range-sorted, as the borders are sampled from it
    runs = merged_runs(written(rows, "labelled"), max_gap_s)
    return runs.select(F.col("entity").alias("session_id"), F.col("label").alias("speaker"), "first_pos", "last_pos", F.col("n").alias("n_events"), F.col("s").alias("start_s"), F.col("e").alias("end_s"))


def found_runs(segments: DataFrame, speaker_names: DataFrame, max_gap_s: float = 5.0) -> DataFrame:
    """Runs of two or more segments with their number and duration."""
    runs = speaker_runs(segments, speaker_names, max_gap_s).where(F.col("n_events") >= 2)
    return runs.select("session_id", "first_pos", "last_pos", "n_events", (milliseconds(F.col("end_s")) - milliseconds(F.col("start_s"))).alias("duration_ms"))
