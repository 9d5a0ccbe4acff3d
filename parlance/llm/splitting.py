"""Problem 6: oversized texts cut at natural boundaries, with an overlap."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import count_words
from parlance.operators.segments import delivered_once

PIECES = "session_id string, chunk_id bigint, piece_no bigint, n_words bigint, n_overlap bigint, cut string, longest_stretch bigint, text string"
WORD = re.compile(r"\S*\w\S*")
LINE_END = re.compile(r"[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
SENTENCE_END = re.compile(r"[.!?…](?=\s)")
STRENGTH = ("sentence", "line")


def boundaries(text: str, starts: list[int], ends: list[int]) -> dict[str, list[int]]:
    """Per kind the numbers of words before which a line or a sentence begins, in order.

    A cut before word i lies between the ends of word i - 1 and its start; a line end there counts as a line
    end only. The last character of a word counts for its sentence end.
    """
    line = {bisect_left(starts, m.end()) for m in LINE_END.finditer(text)}
    sentence = {bisect_left(starts, m.end()) for m in SENTENCE_END.finditer(text)} - line
    inside = lambda s: sorted(i for i in s if 0 < i < len(starts))
    return {"line": inside(line), "sentence": inside(sentence)}


def nearest(positions: list[int], low: int, high: int, middle: float) -> int | None:
    """The position in [low, high] nearest to middle, the smaller of two."""
    i = bisect_left(positions, middle)
    near = [p for p in positions[max(0, i - 1) : i + 1] if low <= p <= high]
    if not near:
        a, b = bisect_left(positions, low), bisect_right(positions, high)
        near = [positions[a], positions[b - 1]] if a < b else []
    return min(near, key=lambda p: (abs(p - middle), p), default=None)


def bisected(n: int, bounds: dict[str, list[int]], room: int) -> list[tuple[int, str]]:
    """The cuts of n words, each with its kind, in order; no stretch between two cuts is longer than room.

    A stretch too long is cut at the strongest boundary in its middle half, the nearest to the midpoint of
    equals; without any there at the nearest boundary of the stretch; without that at the midpoint.
    """
    cuts, todo = [], [(0, n)]
    while todo:
        a, b = todo.pop()
        if b - a <= room:
            continue
        middle, quarter = (a + b) / 2, (b - a) // 4
        for low, high in ((a + max(1, quarter), b - max(1, quarter)), (a + 1, b - 1)):
            found = next(((p, k) for k in ("line", "sentence") if (p := nearest(bounds[k], low, high, middle)) is not None), None)
            if found:
                break
        cut, kind = found or ((a + b) // 2, "hard")
        cuts.append((cut, kind))
        todo += [(a, cut), (cut, b)]
    return sorted(cuts)


def split_text(text: str, max_words: int, overlap: int) -> list[tuple[int, int, str, str]]:
    """Pieces of a text as (words, words shared with the piece before, kind of the cut at its start, text).

    Pieces have at most max_words words, overlap included, and hold the text between their first word and the
    next piece's own first word unchanged; without the overlaps they concatenate to the text. Shorter texts
    are one piece.
    """
    found = list(WORD.finditer(text))
    starts, ends = [m.start() for m in found], [m.end() for m in found]
    n = len(found)
    if n <= max_words:
        return [(n, 0, "start", text)]
    cuts = bisected(n, boundaries(text, starts, ends), max_words - overlap)
    at = [0, *(c for c, _ in cuts), n]
    kinds = ["start", *(k for _, k in cuts)]
    pieces = []
    for a, b, kind in zip(at, at[1:], kinds):
        first = max(0, a - overlap)
        begin = 0 if first == 0 else starts[first]
        end = len(text) if b == n else starts[b]
        pieces.append((b - first, a - first, kind, text[begin:end]))
    return pieces


def longest_stretch(text: str) -> int:
    """The most words between two line ends or sentence ends."""
    found = list(WORD.finditer(text))
    starts = [m.start() for m in found]
    bounds = boundaries(text, starts, [])
    at = sorted({0, len(found), *bounds["line"], *bounds["sentence"]})
    return max((b - a for a, b in zip(at, at[1:])), default=0)


def split_oversized(chunks: DataFrame, max_words: int, overlap: int) -> DataFrame:
    """The pieces of every chunk with more than max_words words, see split_text; piece_no from 0.

    cut is the kind of boundary a piece begins at: start, line, sentence or hard. longest_stretch, the same
    for all pieces of a chunk, is the most words of it without a natural boundary. Words are counted in the
    text, labels included; word_count isn't used. Repeated rows of a key count once; null or empty texts have
    no words. The filter runs before any text is shuffled, so only oversized texts leave the JVM.
    """
    if not 0 <= overlap < max_words:
        raise ValueError("overlap must lie between 0 and max_words - 1")
    over = chunks.where(count_words(F.col("text")) > max_words).select("session_id", F.col("chunk_id").cast("bigint").alias("chunk_id"), F.col("text"), F.lit(0).alias("v"))
    once = delivered_once(over, F.col("text"), key=("session_id", "chunk_id"), version="v")

    def cut(frames):
        for frame in frames:
            rows = [(s, k, i, *p[:3], most, p[3]) for s, k, t in zip(frame["session_id"], frame["chunk_id"], frame["text"]) for most in [longest_stretch(t)] for i, p in enumerate(split_text(t, max_words, overlap))]
            yield pd.DataFrame(rows, columns=["session_id", "chunk_id", "piece_no", "n_words", "n_overlap", "cut", "longest_stretch", "text"])

    return once.mapInPandas(cut, PIECES)


def found_oversized(chunks: DataFrame, max_words: int, overlap: int) -> DataFrame:
    """Each chunk that was cut: hard if some stretch of it has more words than the limit, else soft."""
    first = split_oversized(chunks, max_words, overlap).where(F.col("piece_no") == 0)
    return first.select("session_id", "chunk_id", F.when(F.col("longest_stretch") > max_words, "hard").otherwise("soft").alias("cut"))


def checked(pieces: DataFrame, max_words: int) -> DataFrame:
    """(session_id, chunk_id, n_words, n_over, in_order): the words of a chunk that its pieces hold beyond their
    overlaps, the pieces of an oversized chunk over the limit, and whether they are numbered from 0 without a gap."""
    own = F.sum(F.col("n_words") - F.col("n_overlap")).alias("n_words")
    return pieces.groupBy("session_id", "chunk_id").agg(own, F.sum((F.col("n_words") > max_words).cast("bigint")).alias("n_over"), (F.max("piece_no") == F.count(F.lit(1)) - 1).alias("in_order"))
