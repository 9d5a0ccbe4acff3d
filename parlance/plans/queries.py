"""Queries of the core, by name: each takes a session and a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.config import ChunkConfig
from parlance.functions import text
from parlance.operators import chunks, intervals, sessions, summarize, turns
from parlance.operators.segments import delivered_once, milliseconds
from parlance.sources import sinks, transcripts
from parlance.sources.shared import place
from parlance.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.found_periods(table(spark, folder, "segments"))


def p1_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Every stretch, single segments included, and every gap of any length."""
    rows = intervals.speaker_periods(table(spark, folder, "segments"))
    return rows.select(F.col("entity").alias("session_id"), F.col("label").alias("speaker"), "kind", milliseconds(F.col("s")).alias("start_ms"), milliseconds(F.col("e")).alias("end_ms"), F.col("n").alias("n_segments"))


#: The test tables hold short sessions, so chunks are small here.
CONFIG = ChunkConfig(target_words=120, max_words=200, max_gap_s=5.0, tail_merge_words=45)


def segments_normalized(spark: SparkSession, folder: str) -> DataFrame:
    return turns.normalized(table(spark, folder, "segments"))


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", text.count_words(F.col("text")).alias("n_words"))


def format_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "segments").where(F.col("start_s").isNotNull()).select("seg_id", text.clock(F.col("start_s")).alias("clock"))


def turns_merged(spark: SparkSession, folder: str) -> DataFrame:
    return turns.merged(table(spark, folder, "segments"), CONFIG).drop("part")


def oversized_split(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as turns, cut into pieces."""
    rows = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return turns.pieces(rows, CONFIG)


def speaker_transcript(spark: SparkSession, folder: str) -> DataFrame:
    return turns.speaker_paragraphs(table(spark, folder, "segments"))


def _chunk_rows(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.chunk_turns(table(spark, folder, "segments"), CONFIG)


def chunk_assign(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces with their chunk before tails are merged."""
    return chunks.packed(turns.pieces(turns.merged(table(spark, folder, "segments"), CONFIG), CONFIG), CONFIG)


def tail_merge(spark: SparkSession, folder: str) -> DataFrame:
    rows = chunks.assigned(turns.pieces(turns.merged(table(spark, folder, "segments"), CONFIG), CONFIG), CONFIG)
    return rows.groupBy("session_id", "chunk_id").agg(F.count(F.lit(1)).alias("n_pieces"))


def chunk_records(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.records(_chunk_rows(spark, folder))


def speaker_span(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_records(spark, folder).select("session_id", "chunk_id", "speaker_span", "speaker_count", "chunk_type")


def chunk_markdown(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.markdown(_chunk_rows(spark, folder))


def chunk_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.manifest(table(spark, folder, "chunk_index").select("session_id", "chunk_id").distinct())


def session_slug(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sessions").select("log_id", text.session_slug(F.col("title")).alias("slug"))


def session_id(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.started(table(spark, folder, "sessions").select("log_id", "user_label", "title", "started_at")).select("log_id", "slug", "session_id")


def _spelled(rows: DataFrame) -> DataFrame:
    """Timestamps as text in UTC, so that results compare across engines."""
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c, kind in rows.dtypes if kind == "timestamp"})


def session_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _spelled(sessions.latest(table(spark, folder, "sessions")))


def session_current(spark: SparkSession, folder: str) -> DataFrame:
    return _spelled(sessions.current(table(spark, folder, "sessions")))


def session_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.latest(table(spark, folder, "sessions"))
    return rows.select("session_id", "state", sessions.is_active().alias("is_active"), sessions.blocks_start().alias("blocks_start"), sessions.badge().alias("badge"))


def session_stops(spark: SparkSession, folder: str) -> DataFrame:
    """What a stop request with the session named in a document gets, asked of the document's session."""
    known = sessions.latest(table(spark, folder, "sessions")).select(F.col("session_id").alias("sid"), F.lit(True).alias("known"))
    rows = table(spark, folder, "documents").select("doc_id", "session_id").join(known, F.col("session_id") == F.col("sid"), "left")
    return rows.select("doc_id", sessions.stop_outcome(F.coalesce("known", F.lit(False)), F.when(F.col("doc_id") % 3 == 0, "another").when(F.col("doc_id") % 3 == 1, F.col("session_id")), F.col("sid")).alias("outcome"))


def session_changes(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.broken_changes(table(spark, folder, "sessions"))


def metadata_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The first records written of each session, brought up to date."""
    log = table(spark, folder, "sessions")
    first = log.where(F.col("state") == "starting").select("log_id", "session_id", "slug", "title", "url", "state")
    return sessions.refreshed(first, log)


def metadata_artefacts(spark: SparkSession, folder: str) -> DataFrame:
    """Sidecars of the sessions that have a folder of chunks."""
    rows = sessions.latest(table(spark, folder, "sessions")).select("session_id", "state")
    made = sessions.overlaid(rows, F.concat("session_id", F.lit(".wav")), F.col("session_id"))
    return sessions.with_artefacts(made, table(spark, folder, "chunk_index").select(F.col("session_id").alias("transcript_dir")))


def latest_recording(spark: SparkSession, folder: str) -> DataFrame:
    """Stopped sessions with the newest document made by then, taken as their recording."""
    stops = sessions.latest(table(spark, folder, "sessions")).select("session_id", "slug", "stopped_at").where(F.col("stopped_at").isNotNull())
    made = table(spark, folder, "documents").select(F.concat(F.lit("rec-"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("name"), F.col("created_at").alias("at"))
    return _spelled(sessions.with_recording(stops, made))


def newest_file(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "chunk_index").select("file_name", F.col("end_time").alias("end_s"))
    return sessions.newest(files.where(F.col("end_s").isNotNull()).distinct(), "end_s", "file_name")


def file_parts(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.lit("/data/out/"), "file_name")
    rows = table(spark, folder, "chunk_index").where(F.col("file_name").isNotNull()).select("session_id", "chunk_id", name.alias("p")).distinct()
    return rows.select("session_id", "chunk_id", text.base_name(F.col("p")).alias("base"), text.stem(F.col("p")).alias("stem"), text.with_suffix(F.col("p"), ".metadata.json").alias("sidecar"))


def url_trimmed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sessions").select("log_id", text.trim_slashes(F.concat("url", F.lit("//"))).alias("url"))


def session_extra(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sessions").select("log_id", text.parsed_json(F.col("extra")).alias("extra"))


def redacted_command(spark: SparkSession, folder: str) -> DataFrame:
    command = F.concat(F.lit("transcribe --hf_token "), F.md5("session_id"), F.lit(" --language en "), F.coalesce("url", F.lit("")))
    return table(spark, folder, "sessions").select("log_id", text.redacted(command).alias("command"))


def status_outcome(spark: SparkSession, folder: str) -> DataFrame:
    has = lambda name, to: table(spark, folder, name).select("session_id").distinct().withColumn(to, F.lit(True))
    made = table(spark, folder, "chunk_index").groupBy("session_id").agg(F.count_distinct("chunk_id").alias("n_chunks"))
    rows = sessions.latest(table(spark, folder, "sessions")).select("session_id").join(has("segments", "t"), "session_id", "left").join(made, "session_id", "left").join(has("chunk_summaries", "s"), "session_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    failed = (F.coalesce("n_chunks", F.lit(0)) > 0) & ~yes("s")
    return rows.select("session_id", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), sessions.outcome(yes("t"), F.col("n_chunks"), failed).alias("outcome"), sessions.deletion(yes("s"), yes("t"), F.col("n_chunks").isNotNull()).alias("deleted"))


def _index(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "chunk_index").distinct()


def prompt_render(spark: SparkSession, folder: str) -> DataFrame:
    return _index(spark, folder).select("session_id", "chunk_id", summarize.chunk_prompt().alias("prompt"))


def map_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return summarize.map_stage(_index(spark, folder), summarize.first_words()).select("session_id", "chunk_id", "chunk_label", "file_name", "summary")


def reduce_input(spark: SparkSession, folder: str) -> DataFrame:
    return summarize.reduce_input(table(spark, folder, "chunk_summaries"))


def reduce_outputs(spark: SparkSession, folder: str) -> DataFrame:
    return summarize.reduce_stage(table(spark, folder, "chunk_summaries"), "lesson", summarize.first_words())


def reduce_meeting(spark: SparkSession, folder: str) -> DataFrame:
    return summarize.reduce_stage(table(spark, folder, "chunk_summaries"), "meeting", summarize.first_words())


def transcript_files(spark: SparkSession, folder: str) -> DataFrame:
    return turns.transcript_files(table(spark, folder, "segments"))


def status_log(spark: SparkSession, folder: str) -> DataFrame:
    """The status of every session as if it were a lesson, and as if it were a meeting."""
    rows = status_outcome(spark, folder)
    return sessions.status_lines(rows, "lesson").withColumn("profile", F.lit("lesson")).unionByName(sessions.status_lines(rows, "meeting").withColumn("profile", F.lit("meeting")))


def transcripts_read(spark: SparkSession, folder: str) -> DataFrame:
    """Segments, each once, written as one JSON document a session and read again."""
    rows = delivered_once(table(spark, folder, "segments"), F.col("start_s"), F.col("end_s"), F.col("speaker"), F.col("text"))
    at = place(spark, "transcripts")
    sinks.write_documents_of_segments(rows, at)
    return transcripts.read_transcripts(spark, at)


def index_read_json(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk index written as JSON lines and read again."""
    at = place(spark, "index-json")
    sinks.write_index(_index(spark, folder), at)
    return transcripts.read_chunk_index(spark, at)


def index_read_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk index written as CSV and read again; CSV has no text that is empty but not null."""
    at = place(spark, "index-csv")
    names = [f.name for f in transcripts.RECORD.fields]
    sinks.write_index(_index(spark, folder).select(*names), at, "csv")
    return transcripts.read_chunk_table(spark, at)


def summaries_read(spark: SparkSession, folder: str) -> DataFrame:
    """The map stage's rows written as JSON lines and read again."""
    at = place(spark, "summaries")
    made = summarize.map_stage(_index(spark, folder), summarize.first_words())
    sinks.write_summaries(made, at)
    return spark.read.schema(made.schema).json(at).select("session_id", "chunk_id", "file_name", "summary")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        p1_found, p1_timeline, segments_normalized, word_count, format_timestamp, turns_merged, oversized_split, speaker_transcript, chunk_assign, tail_merge,
        chunk_records, speaker_span, chunk_markdown, chunk_manifest, session_slug, session_id, session_latest, session_current, session_conflicts, session_stops,
        session_changes, metadata_lookup, metadata_artefacts, latest_recording, newest_file, file_parts, url_trimmed, session_extra, redacted_command, status_outcome,
        prompt_render, map_summaries, reduce_input, reduce_outputs, reduce_meeting, transcript_files, status_log, transcripts_read, index_read_json, index_read_csv, summaries_read,
    )
}
