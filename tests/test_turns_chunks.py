import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.config import ChunkConfig
from parlance.operators import chunks, turns
from parlance.operators.runs import merged_runs
from parlance.operators.scans import filled_forward, numbered_within
from tests.conftest import SEGMENTS, rows

SMALL = ChunkConfig(target_words=12, max_words=20, tail_merge_words=5)


def seg(*items):
    return [(i, "s", i, float(a), float(b), who, text) for i, (who, a, b, text) in enumerate(items)]


def merged(spark, *items):
    return [tuple(r) for r in turns.merged(spark.createDataFrame(seg(*items), SEGMENTS)).orderBy("turn_no").select("speaker", "start_s", "end_s", "text").collect()]


def test_gap_is_inclusive(spark):
    assert merged(spark, ("A", 0, 10, "a"), ("A", 15, 16, "b")) == [("A", 0.0, 16.0, "a b")]
    assert len(merged(spark, ("A", 0, 10, "a"), ("A", 15.5, 16, "b"))) == 2


def test_end_is_that_of_the_last_segment(spark):
    assert merged(spark, ("A", 0, 10, "a"), ("A", 2, 4, "b")) == [("A", 0.0, 4.0, "a b")]


def test_blank_segments_break_nothing(spark):
    assert len(merged(spark, ("A", 0, 1, "a"), ("B", 1, 2, " \u2003"), ("A", 2, 3, "b"))) == 1


def test_speaker_defaults(spark):
    assert [m[0] for m in merged(spark, (None, 0, 1, "a"), (" ", 1, 2, "b"), ("", 2, 3, "c"))] == ["UNKNOWN", " ", "UNKNOWN"]


def test_ties_keep_file_order(spark):
    assert [m[0] for m in merged(spark, ("B", 5, 6, "b"), ("A", 5, 6, "a"))] == ["B", "A"]


def test_rendering_keeps_file_order(spark):
    d = spark.createDataFrame(seg(("A", 5, 6, "late"), ("A", 1, 2, "early"), ("B", 0, 1, "x")), SEGMENTS)
    assert [tuple(r)[1:] for r in turns.speaker_paragraphs(d).orderBy("paragraph_no").select("session_id", "paragraph_no", "paragraph").collect()] == [(1, "[A] late early"), (2, "[B] x")]


def test_oversized_split_boundary(spark):
    d = spark.createDataFrame([(1, " ".join(["w"] * 2200)), (2, " ".join(["w"] * 2201)), (3, " ".join(["w"] * 700 + ["--"] + ["w"] * 1500))], "id int, text string")
    got = turns.pieces(d).orderBy("id", "piece_no").select("id", "piece_no", "n_words").collect()
    assert [tuple(r) for r in got] == [(1, 0, 2200), (2, 0, 1400), (2, 1, 801), (3, 0, 1399), (3, 1, 801)]


def fold(words, target, most):
    out, cur, no = [], None, 0
    for w in words:
        if cur is None or cur + w > most or cur >= target:
            no, cur = no + 1, w
        else:
            cur += w
        out.append(no)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_packing_jumps(seed):
    r = np.random.default_rng(seed)
    words = r.integers(0, 21, r.integers(1, 80))
    p = chunks.Packing(words, 12, 20)
    begins = np.zeros(len(words), int)
    begins[p.starts(-1)] = 1
    assert np.cumsum(begins).tolist() == fold(words.tolist(), 12, 20)
    opens, breaks = p.summary()
    for w in range(21):
        no = fold([w, *words.tolist()], 12, 20)
        cur = 0
        for x, n in zip([w, *words.tolist()], no):
            cur = cur + x if n == no[-1] else 0
        assert (int(opens[w]), int(breaks[w])) == (cur, no[-1] - 1)


@pytest.mark.parametrize("partitions", [1, 4, 11])
def test_packing_over_ranges(spark, partitions):
    r = random.Random(3)
    data = [(s, t, 0, r.randint(0, 20)) for s, n in (("hot", 500), ("a", 20), (None, 9), ("z", 1)) for t in range(1, n + 1)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {(x.session_id, x.turn_no): x.chunk_no for x in chunks.packed(spark.createDataFrame(data, "session_id string, turn_no bigint, piece_no bigint, n_words bigint"), SMALL).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 5)
    for s in {d[0] for d in data}:
        mine = [d for d in data if d[0] == s]
        assert [got[s, d[1]] for d in mine] == fold([d[3] for d in mine], 12, 20)


@pytest.mark.parametrize(("words", "want"), [([1000, 1200], [2200]), ([1400, 10, 500], [1400, 510]), ([1400, 300], [1700]), ([2000, 300], [2000, 300])])
def test_tail_cases(spark, words, want):
    d = spark.createDataFrame([("s", i + 1, 0, w) for i, w in enumerate(words)], "session_id string, turn_no bigint, piece_no bigint, n_words bigint")
    of = {r.turn_no: r.chunk_id for r in chunks.assigned(d).collect()}
    sums = {}
    for i, w in enumerate(words):
        sums[of[i + 1]] = sums.get(of[i + 1], 0) + w
    assert [sums[k] for k in sorted(sums)] == want


def test_records(spark):
    d = spark.createDataFrame(seg(("S_0", 0, 1, "hi there"), ("S_0", 20, 21, "again"), ("S_1", 21, 22, "yes"), ("S_0", 22, 23, "bye")), SEGMENTS)
    part = chunks.chunk_turns(d)
    r = chunks.records(part).first()
    assert (r.file_name, r.speaker_span, r.speaker_count, r.chunk_type) == ("001-discussion-s-0-s-1-s-0.md", "S_0 -> S_1 -> S_0", 2, "discussion")
    assert r.text == "[S_0] hi there\n[S_0] again\n[S_1] yes\n[S_0] bye" and r.word_count == 9
    assert (r.start_time, r.end_time) == (0.0, 23.0)
    assert chunks.markdown(part).first().content.startswith("# Transcript Chunk 001\n\n- Time range: 00:00:00 → 00:00:23\n- Speakers: S_0, S_1\n- Chunk type: discussion\n\n## [S_0] 00:00:00 → 00:00:01\n\nhi there\n\n## [S_0]")


def test_no_segments(spark):
    assert rows(chunks.records(chunks.chunk_turns(spark.createDataFrame([], SEGMENTS)))) == []


def test_properties(spark):
    r = random.Random(9)
    data = [(i, r.choice(["a", "hot", "hot"]), i, r.randint(0, 4000) / 8, r.randint(0, 4000) / 8, r.choice("ABC"), " ".join(["w"] * r.randint(0, 30))) for i in range(300)]
    d = spark.createDataFrame(data, SEGMENTS)
    part = chunks.chunk_turns(d, SMALL).cache()
    assert part.agg(F.sum("n_words")).first()[0] == sum(len(x[6].split()) for x in data)
    sums = part.groupBy("session_id", "chunk_id").agg(F.sum("n_words").alias("w")).collect()
    assert max(s.w for s in sums) <= 20
    for s in ("a", "hot"):
        assert sorted(x.chunk_id for x in sums if x.session_id == s) == list(range(1, 1 + sum(x.session_id == s for x in sums)))


def test_runs_over_ranges_with_text(spark):
    data = [("s", "A", i, float(i), i + 0.5, 1, f"t{i}") for i in range(200)] + [("s", "B", 200, 200.0, 201.0, 1, "b")]
    got = rows(merged_runs(spark.createDataFrame(data, "entity string, label string, pos bigint, s double, e double, weight int, text string"), 5.0).select("label", "first_pos", "last_pos", "n", "text"))
    assert got == [("A", 0, 199, 200, " ".join(f"t{i}" for i in range(200))), ("B", 200, 200, 1, "b")]


def test_scans(spark):
    d = spark.createDataFrame([("h" if i % 10 else "c", i, i if i % 37 == 5 else None) for i in range(500)], "e string, i bigint, v bigint")
    n = {(r.e, r.i): r.n for r in numbered_within(d, "e", ["e", "i"], "n").collect()}
    assert all(n["h", i] == i - i // 10 for i in range(500) if i % 10) and n["c", 490] == 50
    last = None
    got = {r.i: r.f for r in filled_forward(d, ["i"], "v", "f").collect()}
    for i in range(500):
        last = i if i % 37 == 5 else last
        assert got[i] == last


def test_numbers_over_batches_and_ranges(spark):
    data = [(e, i) for e, n in ((None, 7), ("a", 1), ("hot", 900), ("z", 30)) for i in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    try:
        got = numbered_within(spark.createDataFrame(data, "e string, i bigint").repartition(3), "e", ["e", "i"], "n").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(data) and all(r.n == r.i + 1 for r in got)
