"""Queries of the training-data problems, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import events, leaks, mixing, packing, pairs, pii, quality, splitting, turns
from parlance.llm.limits import limit
from parlance.operators.segments import milliseconds
from parlance.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return events.found_runs(table(spark, folder, "segments"), table(spark, folder, "speaker_names"))


@query
def p3_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every run, single segments included, with its speaker."""
    runs = events.speaker_runs(table(spark, folder, "segments"), table(spark, folder, "speaker_names"))
    return runs.select("session_id", "speaker", "first_pos", "last_pos", "n_events", milliseconds(F.col("start_s")).alias("start_ms"), milliseconds(F.col("end_s")).alias("end_ms"))


@query
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return turns.found_turns(table(spark, folder, "segments"), table(spark, folder, "speaker_names"))


@query
def p4_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The clean turns with their text."""
    return turns.turns_with_text(table(spark, folder, "segments"), table(spark, folder, "speaker_names"))


@query
def p2_containers(spark: SparkSession, folder: str) -> DataFrame:
    size, _ = limit(table(spark, folder, "size_limits"), "container")
    return packing.containers(packing.pack_chunks(table(spark, folder, "chunk_index"), size), size)


@query
def p2_chunks(spark: SparkSession, folder: str) -> DataFrame:
    size, _ = limit(table(spark, folder, "size_limits"), "container")
    return packing.pack_chunks(table(spark, folder, "chunk_index"), size).drop("speaker_span")


@query
def p2_small_containers(spark: SparkSession, folder: str) -> DataFrame:
    size, _ = limit(table(spark, folder, "size_limits"), "container_small")
    return packing.containers(packing.pack_chunks(table(spark, folder, "chunk_index"), size), size)


@query
def p2_checks(spark: SparkSession, folder: str) -> DataFrame:
    size, _ = limit(table(spark, folder, "size_limits"), "container")
    return packing.checked(packing.pack_chunks(table(spark, folder, "chunk_index"), size), size)


@query
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.found_oversized(table(spark, folder, "chunk_index"), *limit(table(spark, folder, "size_limits"), "split"))


@query
def p6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_oversized(table(spark, folder, "chunk_index"), *limit(table(spark, folder, "size_limits"), "split")).drop("longest_stretch")


@query
def p6_checks(spark: SparkSession, folder: str) -> DataFrame:
    size, overlap = limit(table(spark, folder, "size_limits"), "split")
    return splitting.checked(splitting.split_oversized(table(spark, folder, "chunk_index"), size, overlap), size)


@query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.found_defects(table(spark, folder, "chunk_index"), table(spark, folder, "chunk_summaries"))


@query
def p5_defects(spark: SparkSession, folder: str) -> DataFrame:
    """Every defect that was triggered, one row each."""
    rows = pairs.pair_defects(table(spark, folder, "chunk_index"), table(spark, folder, "chunk_summaries"))
    return rows.select("session_id", "chunk_id", F.explode("defects").alias("defect"))


@query
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.found_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


@query
def p8_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Leaks with small edits too, with the extent and the edits of the best alignment."""
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


@query
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return quality.found_classes(table(spark, folder, "documents"))


@query
def p10_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return quality.statistics(table(spark, folder, "documents"), of=quality.shares_of, names=quality.STATISTICS[:5]).select("doc_id", *quality.STATISTICS[:5])


@query
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return pii.found_types(table(spark, folder, "segments"), table(spark, folder, "chunk_index"), table(spark, folder, "known_names"))


@query
def p7_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return pii.redacted_texts(table(spark, folder, "segments"), table(spark, folder, "chunk_index"), table(spark, folder, "known_names"))


@query
def p7_checks(spark: SparkSession, folder: str) -> DataFrame:
    return pii.kept_texts(table(spark, folder, "segments"), table(spark, folder, "chunk_index"), table(spark, folder, "known_names"))


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return mixing.replicated(table(spark, folder, "documents"), table(spark, folder, "mix_plans"))


@query
def p9_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """Every repeat of every document a plan takes, a row each, in the order of the shuffle."""
    return mixing.shuffled(_mixed(spark, folder)[0])


@query
def p9_chosen(spark: SparkSession, folder: str) -> DataFrame:
    """The documents each plan takes, with their repeats."""
    return _mixed(spark, folder)[0]


@query
def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)[1]


@query
def p9_checks(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.checked(*_mixed(spark, folder))
