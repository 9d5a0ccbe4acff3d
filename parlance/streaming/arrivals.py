"""Transcripts that arrive as files, and sessions as a stream of states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parlance.config import ChunkConfig
from parlance.operators.chunks import chunk_turns, records
from parlance.sources.shared import scratch
from parlance.sources.transcripts import DOCUMENT, NO_TRANSCRIPT, segments_of


def chunk_arrivals(spark: SparkSession, source: str, sink: str, checkpoint: str, config: ChunkConfig = ChunkConfig(), once: bool = True) -> StreamingQuery:
    """Chunk records of every new transcript file under source, appended to the Parquet table sink.

    A file is a whole session, so each batch runs the plan of the batch engine; the checkpoint sees to it that
    a file is processed once. A batch replaces its own folder, so its repetition after a failure does no harm.
    once processes what is there and ends; else a new batch begins every minute.
    """
    found = spark.readStream.schema(DOCUMENT).option("multiLine", True).option("recursiveFileLookup", True).json(source).withColumn("path", F.col("_metadata.file_path"))

    def process(batch: DataFrame, number: int) -> None:
        segments = segments_of(batch.where(~F.col("path").endswith("/" + NO_TRANSCRIPT)))
        with scratch():
            records(chunk_turns(segments, config)).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    writer = found.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def latest_states(log: DataFrame) -> DataFrame:
    """The latest state per session of a stream of states, for the output mode `update`: the state kept per
    session is one row."""
    return log.groupBy("session_id").agg(F.max_by(F.struct("state", "stopped_at", "written_at"), F.struct("written_at", "log_id")).alias("x")).select("session_id", "x.*")
