"""Segments to turns, oversized turns to pieces, and the plain speaker rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.config import ChunkConfig
from parlance.functions.text import count_words, strip, tokens
from parlance.operators.runs import merged_runs
from parlance.operators.segments import delivered_once, stored_label


def normalized(segments: DataFrame) -> DataFrame:
    """(session_id, pos, start_s, end_s, speaker, text), a row per segment with something said.

    Null or empty speakers are UNKNOWN (blanks are a label), texts are stripped of any white space, null or
    blank ones drop out; a null time is 0. Repeated deliveries count once.
    """
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    text = strip(F.coalesce("text", F.lit("")))
    once = delivered_once(segments, zero("start_s"), zero("end_s"), stored_label(F.col("speaker")).alias("speaker"), text.alias("text")) if "seg_id" in segments.columns else segments.select("session_id", "pos", zero("start_s"), zero("end_s"), stored_label(F.col("speaker")).alias("speaker"), text.alias("text"))
    return once.where(F.col("text") != "")


def merged(segments: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """(session_id, turn_no, speaker, start_s, end_s, n_segments, text, part): segments in order of start and pos that
    have one speaker and begin at most max_gap_s after the one before ended are one turn. part numbers the range a
    turn begins in; it and turn_no sort the turns of a session.

    A turn starts where its first and ends where its last segment does, even if an earlier one ended later.
    """
    rows = normalized(segments).select(F.col("session_id").alias("entity"), F.col("speaker").alias("label"), "pos", F.col("start_s").alias("s"), F.col("end_s").alias("e"), F.lit(1).alias("weight"), "text")
    runs = merged_runs(rows, config.max_gap_s, numbered=True)
    return runs.select(F.col("entity").alias("session_id"), F.col("label").alias("speaker"), F.col("s").alias("start_s"), F.col("last_e").alias("end_s"), F.col("n").alias("n_segments"), "text", F.col("no").alias("turn_no"), "part")


def pieces(turns: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """turns with piece_no and n_words: turns of more than max_words tokens are cut every target_words tokens.

    Each piece keeps the speaker and the times of its whole turn. White space inside pieces is single blanks;
    turns that aren't cut stay as they are, as piece 0.
    """
    step = config.target_words
    # tokens are made only of texts that are long enough, and once: a token and its blank take two characters
    long = F.length("text") >= 2 * config.max_words + 1
    cut = F.transform(F.sequence(F.lit(0), F.size("_words") - 1, F.lit(step)), lambda i: F.array_join(F.slice("_words", i + 1, step), " "))
    parts = F.when(F.size("_words") > config.max_words, cut).otherwise(F.array("text"))
    told = turns.withColumn("_words", F.when(long, tokens(F.col("text"))))
    out = told.select(*[c for c in turns.columns if c != "text"], F.posexplode(parts).alias("piece_no", "text"))
    return out.withColumn("piece_no", F.col("piece_no").cast("bigint")).withColumn("n_words", count_words(F.col("text")))


def speaker_paragraphs(segments: DataFrame) -> DataFrame:
    """(session_id, paragraph_no, paragraph): "[speaker] text" per run of one speaker, in file order, that is by
    pos, without a rule on gaps."""
    rows = normalized(segments)
    at = F.col("pos").cast("double")
    runs = merged_runs(rows.select(F.col("session_id").alias("entity"), F.col("speaker").alias("label"), "pos", at.alias("s"), at.alias("e"), F.lit(1).alias("weight"), "text"), float("inf"), numbered=True)
    return runs.select(F.col("entity").alias("session_id"), F.format_string("[%s] %s", "label", "text").alias("paragraph"), F.col("no").alias("paragraph_no"))


def transcript_files(segments: DataFrame) -> DataFrame:
    """(session_id, name, content): <session>.speaker.txt of every session, its paragraphs separated by blank lines.

    A file is one value, so a transcript has to fit memory here; speaker_paragraphs gives the same in rows.
    """
    rows = speaker_paragraphs(segments).groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("paragraph_no", "paragraph"))).alias("x"))
    content = F.concat(F.array_join(F.transform("x", lambda p: p["paragraph"]), "\n\n"), F.lit("\n"))
    return rows.select("session_id", F.concat("session_id", F.lit(".speaker.txt")).alias("name"), content.alias("content"))
