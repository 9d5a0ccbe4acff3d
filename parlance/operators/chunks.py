"""Greedy packing of turn pieces into chunks, the merge of short tails, and chunk records."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.config import ChunkConfig
from parlance.functions.text import clock, count_words, padded_id, slug
from parlance.operators import turns as turn_ops
from parlance.operators.scans import in_ranges
from parlance.sources.shared import by_range, written

EDGE = "part int, session_id string, fresh_open bigint, fresh_breaks bigint, opens array<int>, breaks array<int>, first boolean"
ENTRY = "part int, entry bigint, closed bigint"


class Packing:
    """The fold over the word counts of consecutive pieces, as jumps from one chunk's start to the next.

    A chunk that begins at i takes pieces until it has target words, or until the next would lift it above most.
    """

    def __init__(self, words: np.ndarray, target: int, most: int):
        self.n, self.target, self.most = len(words), target, most
        self.sums = np.concatenate([[0], np.cumsum(words)])
        at = np.arange(self.n)
        full = np.searchsorted(self.sums, self.sums[:-1] + target, "left")
        over = np.searchsorted(self.sums, self.sums[:-1] + most, "right") - 1
        self.next = np.minimum(np.maximum(np.minimum(full, over), at + 1), self.n)

    def entered(self, opened: np.ndarray) -> np.ndarray:
        """Where the first chunk begins if one with so many words is open; n if it takes all pieces."""
        full = np.searchsorted(self.sums, self.target - opened, "left")
        over = np.searchsorted(self.sums, self.most - opened, "right") - 1
        return np.clip(np.minimum(full, over), 0, self.n)

    def starts(self, entry: int) -> list[int]:
        """The pieces that begin a chunk; entry is the number of words open before, -1 for none."""
        i = 0 if entry < 0 else int(self.entered(np.array([entry]))[0])
        out = []
        while i < self.n:
            out.append(i)
            i = int(self.next[i])
        return out

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """For each start the words of the chunk open at the end, and the chunks begun after that start."""
        left, more = np.zeros(self.n + 1, np.int64), np.zeros(self.n + 1, np.int64)
        follow, total, sums = self.next.tolist(), int(self.sums[-1]), self.sums.tolist()
        for i in range(self.n - 1, -1, -1):
            j = follow[i]
            left[i], more[i] = (total - sums[i], 0) if j == self.n else (left[j], more[j] + 1)
        return left, more

    def summary(self) -> tuple[np.ndarray, np.ndarray]:
        """For every number of words that may be open before: the words open after, and the chunks begun."""
        opened = np.arange(self.most + 1)
        at = self.entered(opened)
        left, more = self.ends()
        stays = at == self.n
        return np.where(stays, opened + self.sums[-1], left[at]), np.where(stays, 0, more[at] + 1)


def _by_part(frames, work):
    """work(frame of one part) over frames sorted by part, one part in memory at a time."""
    held = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        part = frame["part"].to_numpy()
        at = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()]
        yield from (work(frame[a:b]) for a, b in zip(at, at[1:]))
        held = frame[at[-1] :]
    if held is not None and len(held):
        yield work(held)


def _sessions(frame: pd.DataFrame) -> list[tuple[int, int]]:
    key = frame["session_id"].map(lambda x: "\0" if x is None else x).to_numpy()
    at = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    return list(zip(at, at[1:]))


def packed(pieces: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """(session_id, turn_no, piece_no, n_words, chunk_no): chunks numbered from 1 before the merge of tails.

    The fold has a state, the words of the open chunk, that takes max_words + 1 values. So each range of the
    sorted pieces gives its effect as a table from the state before to the state after; the tables of the few
    ranges a session spans are chained, and then each range packs its pieces knowing its entry.
    """
    target, most = config.target_words, config.max_words
    keys = ["session_id", "turn_no", "piece_no"]
    # turns come in ranges already; only keys and counts are written and move
    rows = written(pieces.select(*keys, "n_words", "part"), "pieces") if "part" in pieces.columns else in_ranges(pieces.select(*keys, "n_words"), keys, "pieces").drop("k")
    sort = ["part", F.col("session_id").asc_nulls_first(), "turn_no", "piece_no"]
    ordered = rows.repartition("part").sortWithinPartitions(*sort)

    def effect(frame: pd.DataFrame) -> pd.DataFrame:
        spans, out = _sessions(frame), []
        for a, b in {spans[0], spans[-1]}:
            p = Packing(frame["n_words"].to_numpy()[a:b], target, most)
            left, more = p.ends()
            opens, breaks = p.summary() if a == 0 else ([], [])
            out.append((int(frame["part"].iloc[0]), frame["session_id"].iloc[a], int(left[0]), int(more[0]) + 1, list(map(int, opens)), list(map(int, breaks)), a == 0))
        return pd.DataFrame(out, columns=["part", "session_id", "fresh_open", "fresh_breaks", "opens", "breaks", "first"])

    edges = ordered.mapInPandas(lambda frames: _by_part(frames, effect), EDGE)

    def chain(frames):
        # sorted by session and range: what is held is the state, not the tables
        session, opened, closed, begun = None, -1, 0, False
        for held in frames:
            rows = []
            for part, name, fresh_open, fresh_breaks, opens, breaks, first in zip(*(held[c] for c in ("part", "session_id", "fresh_open", "fresh_breaks", "opens", "breaks", "first"))):
                if not begun or name != session or opened < 0:
                    session, opened, closed, begun = name, -1, 0, True
                if first and opened >= 0:
                    rows.append((part, opened, closed))
                    opened, closed = int(opens[opened]), closed + int(breaks[opened])
                else:
                    opened, closed = int(fresh_open), int(fresh_breaks)
            yield pd.DataFrame(rows, columns=["part", "entry", "closed"])

    # two rows a range at most, each with max_words + 1 numbers, of fixed size whatever the input
    entries = edges.repartition("session_id").sortWithinPartitions(F.col("session_id").asc_nulls_first(), "part", F.col("first").desc()).mapInPandas(chain, ENTRY)
    told = rows.join(by_range(entries), "part", "left").repartition("part").sortWithinPartitions(*sort)

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        number = np.zeros(len(frame), np.int64)
        entry = frame["entry"].iloc[0]
        for a, b in _sessions(frame):
            known = a == 0 and not pd.isna(entry)
            begins = np.zeros(b - a, np.int64)
            begins[Packing(frame["n_words"].to_numpy()[a:b], target, most).starts(int(entry) if known else -1)] = 1
            number[a:b] = np.cumsum(begins) + (int(frame["closed"].iloc[0]) if known else 0)
        return frame[["session_id", "turn_no", "piece_no", "n_words"]].assign(chunk_no=number)

    return told.mapInPandas(lambda frames: _by_part(frames, assign), "session_id string, turn_no bigint, piece_no bigint, n_words bigint, chunk_no bigint")


def assigned(pieces: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """(session_id, turn_no, piece_no, n_words, chunk_id): packed, with a last chunk of at most tail_merge_words put to the
    one before it if both together keep to max_words."""
    rows = written(packed(pieces, config), "packed")
    sums = rows.groupBy("session_id", "chunk_no").agg(F.sum("n_words").alias("words"))
    last = sums.groupBy("session_id").agg(F.max(F.struct("chunk_no", "words")).alias("x")).select(F.col("session_id").alias("sid"), F.col("x.chunk_no").alias("last_no"), F.col("x.words").alias("tail"))
    before = last.join(sums, F.col("sid").eqNullSafe(F.col("session_id")) & (F.col("last_no") - 1 == F.col("chunk_no")))
    merged = before.where((F.col("tail") <= config.tail_merge_words) & (F.col("words") + F.col("tail") <= config.max_words)).select("sid", "last_no")
    out = rows.join(merged, F.col("session_id").eqNullSafe(F.col("sid")) & (F.col("chunk_no") == F.col("last_no")), "left")
    return out.select("session_id", "turn_no", "piece_no", "n_words", F.when(F.col("last_no").isNotNull(), F.col("chunk_no") - 1).otherwise(F.col("chunk_no")).alias("chunk_id"))


def chunk_turns(segments: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Every piece of every turn with its chunk: (session_id, chunk_id, turn_no, piece_no, speaker, start_s, end_s, n_words, text)."""
    parts = turn_ops.pieces(turn_ops.merged(segments, config), config)
    of = assigned(parts, config)
    same = F.col("p.session_id").eqNullSafe(F.col("c.session_id")) & (F.col("p.turn_no") == F.col("c.turn_no")) & (F.col("p.piece_no") == F.col("c.piece_no"))
    return parts.alias("p").join(of.alias("c"), same).select("p.session_id", "c.chunk_id", "p.turn_no", "p.piece_no", "p.speaker", "p.start_s", "p.end_s", "c.n_words", "p.text")


def _listed(rows: DataFrame) -> DataFrame:
    """A row per chunk with its pieces in order; a chunk is at most max_words long, so it fits a row."""
    return rows.groupBy("session_id", "chunk_id").agg(F.array_sort(F.collect_list(F.struct("turn_no", "piece_no", "speaker", "start_s", "end_s", "text"))).alias("t"))


def records(chunk_rows: DataFrame) -> DataFrame:
    """Chunk records: file_name, chunk_type, speaker_span, speaker_count, start_time, end_time, word_count and text
    per session_id and chunk_id. word_count counts the labels in the text too."""
    speakers = F.array_sort(F.array_distinct(F.transform("t", lambda x: x["speaker"])))
    labels = F.transform("t", lambda x: x["speaker"])
    span = F.array_join(F.filter("labels", lambda s, i: (i == 0) | (s != F.element_at("labels", i))), " -> ")
    text = F.array_join(F.transform("t", lambda x: F.format_string("[%s] %s", x["speaker"], x["text"])), "\n")
    d = _listed(chunk_rows).withColumns({"speakers": speakers, "labels": labels, "text": text})
    kind = F.when(F.size("speakers") == 1, "single_speaker").otherwise("discussion")
    name = F.concat(padded_id(F.col("chunk_id")), F.lit("-"), kind, F.lit("-"), slug(span), F.lit(".md"))
    return d.select("session_id", name.alias("file_name"), "chunk_id", kind.alias("chunk_type"), span.alias("speaker_span"), F.size("speakers").cast("bigint").alias("speaker_count"), F.element_at("t", 1)["start_s"].alias("start_time"), F.element_at("t", -1)["end_s"].alias("end_time"), count_words(F.col("text")).alias("word_count"), "text")


def markdown(chunk_rows: DataFrame) -> DataFrame:
    """(session_id, chunk_id, content): a heading with times, speakers and type, and a section per piece. The
    headings are fixed values of the format."""
    d = _listed(chunk_rows).withColumn("speakers", F.array_sort(F.array_distinct(F.transform("t", lambda x: x["speaker"]))))
    kind = F.when(F.size("speakers") == 1, "single_speaker").otherwise("discussion")
    span = lambda a, b: F.concat(clock(a), F.lit(" → "), clock(b))
    head = F.concat(F.lit("# Transcript Chunk "), padded_id(F.col("chunk_id")), F.lit("\n\n- Time range: "), span(F.element_at("t", 1)["start_s"], F.element_at("t", -1)["end_s"]), F.lit("\n- Speakers: "), F.array_join("speakers", ", "), F.lit("\n- Chunk type: "), kind, F.lit("\n\n"))
    body = F.array_join(F.transform("t", lambda x: F.concat(F.lit("## ["), x["speaker"], F.lit("] "), span(x["start_s"], x["end_s"]), F.lit("\n\n"), x["text"])), "\n\n")
    return d.select("session_id", "chunk_id", F.concat(head, body, F.lit("\n")).alias("content"))
