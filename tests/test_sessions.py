import datetime as dt

import pytest

from pyspark.sql import functions as F

from parlance.operators import sessions, summarize
from tests.conftest import rows

LOG = "log_id bigint, session_id string, slug string, title string, url string, state string, stopped_at timestamp, written_at timestamp"
T = lambda m: dt.datetime(2024, 1, 1, 10, m)


def log(spark):
    return spark.createDataFrame([(1, "a", "x", None, None, "starting", None, T(0)), (3, "a", "x", "t", None, "recording", None, T(2)), (2, "a", "x", None, None, "recording", None, T(1)), (4, "b", None, None, None, "stopped", T(9), T(9)), (4, "b", None, None, None, "stopped", T(9), T(9))], LOG)


def test_latest_and_conflict(spark):
    got = {r.session_id: (r.log_id, r.blocks, r.active) for r in sessions.latest(log(spark)).withColumns({"blocks": sessions.blocks_start(), "active": sessions.is_active()}).collect()}
    assert got == {"a": (3, True, True), "b": (4, False, False)}
    assert sessions.current(log(spark)).first().session_id == "b"
    assert rows(sessions.current(spark.createDataFrame([], LOG))) == []


def test_changes(spark):
    assert rows(sessions.broken_changes(log(spark))) == [("b", None, "stopped", 1)]


def test_stop(spark):
    d = spark.createDataFrame([(False, None, None), (True, "a", "a"), (True, "", "a"), (True, "b", "a")], "h boolean, asked string, s string")
    assert [r[0] for r in d.select(sessions.stop_outcome(F.col("h"), F.col("asked"), F.col("s"))).collect()] == [404, 200, 200, 409]


def test_recording(spark):
    stops = spark.createDataFrame([("a", " ", T(5)), ("b", "b", T(0)), ("c", "c", None)], "session_id string, slug string, stopped_at timestamp")
    made = spark.createDataFrame([("one", T(1)), ("two", T(5)), ("three", T(6)), ("none", None)], "name string, at timestamp")
    got = {r.session_id: (r.recording, r.stored_as) for r in sessions.with_recording(stops, made).collect()}
    assert got == {"a": ("two", "lesson-2024-01-01-100500.wav"), "b": (None, "b-2024-01-01-100000.wav"), "c": (None, None)}


def test_outcomes(spark):
    d = spark.createDataFrame([(False, 0, False), (True, 0, False), (True, 3, True), (True, 3, False)], "t boolean, c bigint, f boolean")
    assert [r[0] for r in d.select(sessions.outcome(F.col("t"), F.col("c"), F.col("f"))).collect()] == ["no_transcript", "no_speech", "failed", "yes"]


def test_status_lines(spark):
    d = spark.createDataFrame([("a", "yes", "no"), ("b", "no_speech", "skipped"), ("c", "no_transcript", "already missing"), ("d", "failed", "yes")], "session_id string, outcome string, deleted string")
    of = lambda profile: {s: [r.line for r in sorted(sessions.status_lines(d, profile).collect(), key=lambda r: r.line_no) if r.session_id == s] for s in "abcd"}
    lesson, meeting = of("lesson"), of("meeting")
    assert lesson["a"] == ["Source audio deleted after transcription: no", "Chunking: yes", "Summaries: yes"] == meeting["a"]
    assert lesson["b"][1:] == ["Chunking: no speech detected", "Summaries: skipped (no chunks)"] and meeting["b"][1:] == ["Chunking: yes", "Summaries: no chunks found"]
    assert lesson["c"][1:] == ["Chunking: no JSON found"] and meeting["c"][2] == "Summaries: no chunks found" and meeting["d"][2] == "Summaries: failed"


def test_unknown_profile_names_the_known(spark):
    with pytest.raises(ValueError, match="lesson, meeting"):
        summarize.reduce_prompts(spark.createDataFrame([], "session_id string, combined string"), "other")


def test_one_call_per_chunk(spark):
    calls = spark.sparkContext.accumulator(0)

    def model():
        def ask(prompt):
            calls.add(1)
            return prompt[-3:]

        return ask

    d = spark.createDataFrame([("s", i, "f", "k", "A", 0.0, 1.0, f"text {i}") for i in range(7)], "session_id string, chunk_id bigint, file_name string, chunk_type string, speaker_span string, start_time double, end_time double, text string")
    found = summarize.map_stage(d, model, calls=3)
    assert summarize.reduce_stage(found, "meeting", summarize.first_words()).count() == 3
    assert found.count() == 7 and calls.value == 7
