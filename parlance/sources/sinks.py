"""Writers of chunk files, indexes, transcripts and documents."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.sources.shared import is_local, shared_dir


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of its file system, the session's default one if it names none. A folder on local
    disk is refused off a single machine, unless it lies in the shared folder, which is mounted everywhere."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = re.sub(r"^file:/+", "file:///", system.makeQualified(path).toString())
    if found.startswith("file:") and not is_local(spark):
        shared = re.sub(r"^(?:file:)?/+", "file:///", shared_dir(spark))
        if not found.startswith(shared + "/"):
            raise ValueError(f"{folder} is on each executor's own disk; name a folder on shared storage")
    return found


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> int:
    """Each row's content as a file of its own below the folder, written by the executors through the file system
    of its address; names may hold sub-folders. A file is put in place under its name only when it is whole, so
    a repeated task does no harm. Null names or contents write nothing. Returns the number of files."""
    target = qualified(rows.sparkSession, folder)

    def put(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(target)
        made: set[str] = set()
        for batch in batches:
            n = 0
            for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at is None or text is None:
                    continue
                place = f"{root.rstrip('/')}/{at}"
                above = place.rsplit("/", 1)[0]
                if above not in made:
                    system.create_dir(above, recursive=True)
                    made.add(above)
                part = f"{above}/.{uuid.uuid4().hex}.part"
                with system.open_output_stream(part) as out:
                    out.write(text.encode())
                system.move(part, place)
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return rows.select(name, content).mapInArrow(put, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_chunk_files(markdown: DataFrame, records: DataFrame, folder: str) -> int:
    """<session>/chunks/<file_name> for every chunk."""
    named = markdown.join(records.select("session_id", "chunk_id", "file_name"), ["session_id", "chunk_id"])
    return write_files(named.select(F.concat("session_id", F.lit("/chunks/"), "file_name").alias("name"), "content"), folder)


def write_index(records: DataFrame, path: str, kind: str = "json") -> None:
    """The chunk index as JSON lines, non-ASCII as it is, or as CSV with a header, quotes doubled; replaces what is
    there. Files are split by ranges of session and chunk, each sorted, not brought into one task."""
    ordered = records.orderBy("session_id", "chunk_id")
    if kind == "json":
        ordered.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    elif kind == "csv":
        ordered.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        raise ValueError(f"no such kind of index: {kind}")


def write_summaries(summaries: DataFrame, path: str) -> None:
    """The chunk summaries as JSON lines in order of session and chunk. What map_stage gives was written after the
    last call had succeeded, so a failed call leaves no file here."""
    write_index(summaries, path)


def write_documents(outputs: DataFrame, folder: str) -> int:
    """<session>/<output_name> of the reduce stage."""
    return write_files(outputs.select(F.concat("session_id", F.lit("/"), "output_name").alias("name"), "content"), folder)


def write_transcripts(files: DataFrame, folder: str) -> int:
    """<session>/<session>.speaker.txt of turns.transcript_files."""
    return write_files(files.select(F.concat("session_id", F.lit("/"), "name").alias("name"), "content"), folder)


def write_documents_of_segments(segments: DataFrame, folder: str) -> int:
    """<session>.json with the list of its segments, in order of pos: what read_transcripts reads. A file is one
    document, so a session is one value here."""
    item = F.struct("pos", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "text", "speaker")
    listed = F.transform(F.array_sort(F.collect_list(item)), lambda x: x.dropFields("pos"))
    made = segments.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(listed.alias("segments"))
    return write_files(made.select(F.concat("session_id", F.lit(".json")).alias("name"), F.to_json(F.struct("segments"), {"ignoreNullFields": "false"}).alias("content")), folder)


def manifest(records: DataFrame) -> DataFrame:
    """(session_id, n_chunks, content) of the note beside the chunk files."""
    counted = records.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    return counted.withColumn("content", F.concat(F.lit("# Chunks of "), "session_id", F.lit("\n\nChunks written: "), F.col("n_chunks").cast("string"), F.lit("\n")))


def append(rows: DataFrame, path: str) -> None:
    """Rows added to a log, such as that of session states."""
    rows.write.mode("append").parquet(path)
