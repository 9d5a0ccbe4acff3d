import csv
import glob
import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from parlance.config import ChunkConfig, ModelConfig, exit_code
from parlance.operators import chunks, summarize, turns
from parlance.sources import shared, sinks, transcripts
from parlance.sources.templates import read_profile, read_prompts
from parlance.streaming.arrivals import chunk_arrivals, latest_states
from tests.conftest import rows

CONFIG = ChunkConfig(target_words=5, max_words=9, tail_merge_words=2)


@pytest.fixture
def folder(tmp_path):
    for name, segments in (("one", [{"start": 0, "end": 1, "text": "hé, wörld", "speaker": "A"}, {"start": 9.5, "end": 12, "text": 'say "hi"\nnow'}]), ("two", [{"start": 3, "text": "x y z", "speaker": ""}, {"text": None}])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"segments": segments, "language": "en"}))
    (tmp_path / "none.json").write_text("{}")
    (tmp_path / "session-metadata.json").write_text(json.dumps({"segments": [{"text": "no"}]}))
    return tmp_path


def test_index_round_trip(spark, folder, tmp_path):
    segments = transcripts.read_transcripts(spark, str(folder / "*.json"))
    assert segments.count() == 4
    part = chunks.chunk_turns(segments, CONFIG)
    made = chunks.records(part)
    out = tmp_path / "out"
    sinks.write_index(made, str(out / "j"))
    assert rows(transcripts.read_chunk_index(spark, str(out / "j")).select(*made.columns)) == rows(made)
    assert "wörld" in "".join(open(f, encoding="utf-8").read() for f in glob.glob(str(out / "j" / "*.json")))
    sinks.write_index(made, str(out / "c"), "csv")
    read = [r for f in glob.glob(str(out / "c" / "*.csv")) for r in csv.DictReader(open(f, encoding="utf-8", newline=""))]
    assert {r["text"] for r in read} == {r.text for r in made.collect()}
    sinks.write_chunk_files(chunks.markdown(part), made, str(out / "files"))
    assert len(glob.glob(str(out / "files" / "*" / "chunks" / "*.md"))) == made.count()
    assert sinks.manifest(made).count() == 2


def test_bad_index(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n\n")
    with pytest.raises(transcripts.NoChunks):
        transcripts.read_chunk_index(spark, str(tmp_path / "a.json"))
    (tmp_path / "b.json").write_text('{"chunk_id": 1}\n\n{bad\n')
    with pytest.raises(Exception):  # noqa: B017
        transcripts.read_chunk_index(spark, str(tmp_path / "b.json")).collect()


def test_stream_gives_what_the_batch_gives(spark, folder, tmp_path):
    args = (spark, str(folder), str(tmp_path / "sink"), str(tmp_path / "ck"), CONFIG)
    chunk_arrivals(*args).awaitTermination()
    want = rows(chunks.records(chunks.chunk_turns(transcripts.read_transcripts(spark, str(folder / "*.json")), CONFIG)))
    read = lambda: rows(spark.read.parquet(str(tmp_path / "sink")).drop("batch"))
    assert read() == want
    (folder / "three.json").write_text(json.dumps({"segments": [{"start": 1, "end": 2, "text": "more", "speaker": "B"}]}))
    chunk_arrivals(*args).awaitTermination()
    assert len(read()) == len(want) + 1


def test_latest_states_as_stream(spark, tmp_path):
    log = spark.createDataFrame([(1, "a", "starting", 1), (2, "a", "recording", 2), (3, "b", "starting", 3)], "log_id bigint, session_id string, state string, at int").select("log_id", "session_id", "state", F.lit(None).cast("timestamp").alias("stopped_at"), F.timestamp_seconds("at").alias("written_at"))
    log.write.parquet(str(tmp_path / "log"))
    q = latest_states(spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))).writeStream.outputMode("complete").format("memory").queryName("states").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.session_id: r.state for r in spark.table("states").collect()} == {"a": "recording", "b": "starting"}


def test_templates(tmp_path):
    (tmp_path / "notes.txt").write_text("Write: {chunk_summaries}", encoding="utf-8")
    (tmp_path / "quiz.txt").write_text("Ask.", encoding="utf-8")
    assert read_profile(str(tmp_path), ["notes.md"]) == [("notes.md", "Write: {chunk_summaries}")]
    with pytest.raises(ValueError):
        read_profile(str(tmp_path), ["quiz.md"])
    with pytest.raises(FileNotFoundError):
        read_profile(str(tmp_path), ["cards.md"])


def test_prompts_of_a_profile(tmp_path):
    here = tmp_path / "lesson"
    here.mkdir()
    for name, text in (("chunk_system", " Be brief. \n"), ("reduce_system", "Be whole."), ("chunk_prompt", "{chunk_text}"), ("notes", "{chunk_summaries}")):
        (here / f"{name}.txt").write_text(text)
    got = read_prompts(str(tmp_path), "lesson", ["notes.md"])
    assert (got.chunk_system, got.reduce_system, got.outputs) == ("Be brief.", "Be whole.", [("notes.md", "{chunk_summaries}")])
    (here / "reduce_system.txt").unlink()
    for profile in ("lesson", "meeting"):
        with pytest.raises(FileNotFoundError) as error:
            read_prompts(str(tmp_path), profile, ["notes.md"])
        assert exit_code(error.value) == 2
    assert exit_code(None) == 0 and exit_code(ValueError()) == 2 and exit_code(RuntimeError()) == 1


@pytest.fixture
def server():
    """A model server that keeps what it was sent; a prompt with `fail` fails, one with `silent` has no answer."""
    got = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            got.append((self.path, body))
            self.send_response(500 if "fail" in body["prompt"] else 200)
            self.end_headers()
            self.wfile.write(json.dumps({} if "silent" in body["prompt"] else {"response": " é " + body["prompt"][-3:] + "\n"}).encode())

        def log_message(self, *args):
            pass

    made = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}/", got
    made.shutdown()


INDEX = "session_id string, chunk_id bigint, file_name string, chunk_type string, speaker_span string, start_time double, end_time double, text string"


def test_model_call(server):
    url, got = server
    ask = summarize.http_model(ModelConfig(url=url, model="m", num_ctx=7, temperature=0.5), "sys")()
    assert ask("one") == "é one" and ask("silent") == ""
    assert got[0] == ("/api/generate", {"model": "m", "prompt": "one", "system": "sys", "stream": False, "keep_alive": "30m", "options": {"temperature": 0.5, "num_ctx": 7}})
    summarize.http_model(ModelConfig(url=url))()("two")
    assert "num_ctx" not in got[-1][1]["options"]
    with pytest.raises(Exception):  # noqa: B017
        ask("fail")
    with pytest.raises(Exception):  # noqa: B017
        summarize.http_model(ModelConfig(url="http://127.0.0.1:9", timeout_s=1))()("x")


def test_summaries_over_http(spark, server, tmp_path):
    url, got = server
    index = spark.createDataFrame([("s", None, None, None, None, 5.0, 9.0, "abc"), ("s", 4, "f", "k", "A", 0.0, 1.0, "xyz"), ("s", None, "g", "k", "B", 2.0, 3.0, "uvw")], INDEX)
    found = summarize.map_stage(index, summarize.http_model(ModelConfig(url=url)), text="{chunk_text}")
    by = {r.chunk_label: (r.chunk_id, r.file_name, r.speaker_span, r.summary) for r in found.collect()}
    assert by == {"4": (4, "f", "A", "é xyz"), "chunk-002": (None, "g", "B", "é uvw"), "chunk-003": (None, "s", "", "é abc")} and len(got) == 3
    assert summarize.reduce_input(found).first().n_chunks == 3
    sinks.write_summaries(found, str(tmp_path / "out"))
    lines = [json.loads(x) for f in glob.glob(str(tmp_path / "out" / "*.json")) for x in open(f, encoding="utf-8")]
    assert len(lines) == 3 and all("summary" in x for x in lines)
    with pytest.raises(Exception):  # noqa: B017
        summarize.map_stage(index.withColumn("text", F.lit("fail")), summarize.http_model(ModelConfig(url=url)), text="{chunk_text}")


def test_documents_and_transcripts_as_files(spark, tmp_path):
    segments = spark.createDataFrame([("a", 0, 0.0, 1.0, "X", "one"), ("a", 1, 1.0, 2.0, "Y", "two"), ("b", 0, 0.0, 1.0, None, "é")], "session_id string, pos bigint, start_s double, end_s double, speaker string, text string")
    assert sinks.write_transcripts(turns.transcript_files(segments), str(tmp_path)) == 2
    assert (tmp_path / "a" / "a.speaker.txt").read_text() == "[X] one\n\n[Y] two\n"
    outputs = spark.createDataFrame([("a", "notes.md", "x\n"), ("a", "quiz.md", None), (None, "quiz.md", "y")], "session_id string, output_name string, content string")
    assert sinks.write_documents(outputs, f"file://{tmp_path}/docs") == 1
    assert (tmp_path / "docs" / "a" / "notes.md").read_text() == "x\n" and not list(tmp_path.glob("**/*.part"))
    assert sinks.write_documents_of_segments(segments, str(tmp_path / "json")) == 2
    assert rows(transcripts.read_transcripts(spark, str(tmp_path / "json")).select(*segments.columns)) == rows(segments)


def test_logs_pointers_and_sidecars(spark, tmp_path):
    for state in ("starting", "recording"):
        sinks.append(spark.createDataFrame([("a", state)], "session_id string, state string"), str(tmp_path / "log"))
    assert rows(spark.read.parquet(str(tmp_path / "log"))) == [("a", "recording"), ("a", "starting")]
    (tmp_path / "last.txt").write_text("/data/rec/one.wav\n")
    (tmp_path / "none.txt").write_text(" \n")
    assert rows(transcripts.read_pointer(spark, str(tmp_path / "*.txt"))) == [("/data/rec/one.wav", "one.wav")]
    record = {"session_id": "a", "slug": "s", "title": "t", "url": None, "source": "x", "started_at": "2024-01-01T00:00:00Z", "state": "stopped", "extra": {"k": [1]}, "recording_file": "a.wav", "transcript_dir": "a", "summary_dir": "a"}
    (tmp_path / "a.metadata.json").write_text(json.dumps(record, indent=2))
    (tmp_path / "b.metadata.json").write_text("{broken")
    got = {r.session_id: (r.recording_file, r.extra and json.loads(r.extra)) for r in transcripts.read_metadata(spark, str(tmp_path / "*.metadata.json")).collect()}
    assert got == {"a": ("a.wav", {"k": [1]}), None: (None, None)}
    assert {r.session_id: r.state for r in transcripts.read_sessions(spark, str(tmp_path / "*.metadata.json")).collect()} == {"a": "stopped", None: None}


class Elsewhere:
    """A session as far as the shared folder asks it, on a cluster."""

    def __init__(self, spark, folder):
        self.sparkContext, self.conf = type("C", (), {"master": "spark://host:7077", "_jvm": spark.sparkContext._jvm, "_jsc": spark.sparkContext._jsc})(), type("F", (), {"get": lambda _, key, default: folder})()


def test_shared_storage_on_a_cluster(spark, tmp_path):
    with pytest.raises(ValueError):
        shared.shared_dir(Elsewhere(spark, None))
    there = Elsewhere(spark, f"file://{tmp_path}/shared")
    assert shared.shared_dir(there) == f"file://{tmp_path}/shared"
    assert sinks.qualified(there, f"{tmp_path}/shared/out") == f"file://{tmp_path}/shared/out"
    with pytest.raises(ValueError):
        sinks.qualified(there, f"{tmp_path}/own/out")


def test_tables_are_removed(spark):
    import os

    with shared.scratch():
        made = shared.written(spark.range(3), "few")
        place = made.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(place) and made.count() == 3
    assert not os.path.exists(place)
