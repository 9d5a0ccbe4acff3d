"""Readers of transcript documents, chunk indexes and session records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("text", T.StringType()), T.StructField("speaker", T.StringType())])
DOCUMENT = T.StructType([T.StructField("segments", T.ArrayType(SEGMENT))])
RECORD = T.StructType([T.StructField(n, t()) for n, t in (("session_id", T.StringType), ("file_name", T.StringType), ("chunk_id", T.LongType), ("chunk_type", T.StringType), ("speaker_span", T.StringType), ("speaker_count", T.LongType), ("start_time", T.DoubleType), ("end_time", T.DoubleType), ("word_count", T.LongType), ("text", T.StringType))])
SESSION = T.StructType([T.StructField(n, t()) for n, t in (("session_id", T.StringType), ("slug", T.StringType), ("title", T.StringType), ("url", T.StringType), ("source", T.StringType), ("user_label", T.StringType), ("started_at", T.TimestampType), ("stopped_at", T.TimestampType), ("extra", T.StringType), ("state", T.StringType))])
#: Metadata beside a transcript, which isn't one although its name ends alike.
NO_TRANSCRIPT = "session-metadata.json"


class NoChunks(ValueError):
    """A chunk index without rows."""


def segments_of(documents: DataFrame) -> DataFrame:
    """(session_id, pos, start_s, end_s, speaker, text) of documents (path, segments): the session is the file's
    stem, pos the place in the file; a missing list has no segments."""
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"\.[^.]*$", "")
    rows = documents.select(stem.alias("session_id"), F.posexplode("segments").alias("pos", "s"))
    return rows.select("session_id", F.col("pos").cast("bigint").alias("pos"), F.col("s.start").alias("start_s"), F.col("s.end").alias("end_s"), F.col("s.speaker").alias("speaker"), F.col("s.text").alias("text"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Segments of all transcript documents under path, one JSON document a file; metadata files are passed over."""
    found = spark.read.schema(DOCUMENT).option("multiLine", True).json(path).withColumn("path", F.col("_metadata.file_path"))
    return segments_of(found.where(~F.col("path").endswith("/" + NO_TRANSCRIPT)))


def read_chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """A chunk index of JSON lines; blank lines are skipped, a bad line fails the read, no rows raise NoChunks."""
    found = spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)
    if found.isEmpty():  # reads up to the first record
        raise NoChunks(f"no chunks in {path}")
    return found


def read_chunk_table(spark: SparkSession, path: str) -> DataFrame:
    """A chunk index of CSV files with headers, quotes doubled; an empty cell is null, a quoted one an empty text."""
    return spark.read.schema(RECORD).option("header", True).option("escape", '"').option("multiLine", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("mode", "FAILFAST").csv(path)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Session records, one JSON document a file; a broken file becomes a row of nulls. extra stays JSON text."""
    return spark.read.schema(SESSION).option("multiLine", True).json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata sidecars, one JSON document a file: a session's fields and where its recording, transcript and
    summary lie. A broken file becomes a row of nulls."""
    more = [T.StructField(n, T.StringType()) for n in ("recording_file", "transcript_dir", "summary_dir")]
    return spark.read.schema(T.StructType([*SESSION.fields, *more])).option("multiLine", True).json(path)


def read_pointer(spark: SparkSession, path: str) -> DataFrame:
    """(target, name): what pointer files, each one path as text, point to; blank files give no row."""
    found = spark.read.option("wholetext", True).text(path).select(F.trim(F.regexp_replace("value", r"\s+$", "")).alias("target"))
    return found.where(F.col("target") != "").select("target", F.regexp_extract("target", r"([^/]*)/*$", 1).alias("name"))


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, at) of the files of a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("modificationTime").alias("at"))
