"""Map and reduce over chunks by a pluggable model."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.config import ModelConfig
from parlance.functions.text import padded_id, rstrip, template
from parlance.operators.scans import numbered_within
from parlance.sources.shared import written

#: The names of the outputs of each profile, in order. The templates are our own.
PROFILES: dict[str, list[tuple[str, str]]] = {
    "meeting": [("summary.md", "Give the meeting a title, an overview and its main points.\n\n{chunk_summaries}"), ("action-items.md", "List who has to do what, one line each.\n\n{chunk_summaries}"), ("minutes-draft.md", "Draft minutes of the meeting.\n\n{chunk_summaries}")],
    "lesson": [("lesson-notes.md", "Write notes of the lesson.\n\n{chunk_summaries}"), ("flashcards.md", "Make question and answer cards.\n\n{chunk_summaries}"), ("quiz.md", "Make a quiz with its key.\n\n{chunk_summaries}"), ("review-sheet.md", "Make a sheet for review.\n\n{chunk_summaries}")],
}
CHUNK_TEMPLATE = "Chunk {chunk_id} ({chunk_type}), speakers {speaker_span}, {start_time} to {end_time}:\n\n{chunk_text}"


class Summarizer(Protocol):
    """What answers prompts; made once per partition by a function that is sent to the executors."""

    def __call__(self, prompt: str) -> str: ...


def first_words(n: int = 12) -> Callable[[], Summarizer]:
    """A deterministic model: the first n white-space tokens of the prompt's last paragraph."""
    return lambda: lambda prompt: " ".join(prompt.rsplit("\n\n", 1)[-1].split()[:n])


def http_model(config: ModelConfig, system: str = "") -> Callable[[], Summarizer]:
    """A model behind HTTP: one call per prompt, not streamed, not repeated; no answer is an empty string."""

    def make() -> Summarizer:
        from urllib.request import Request, urlopen  # here, so that workers have it

        def ask(prompt: str) -> str:
            options = {"temperature": config.temperature} | ({"num_ctx": config.num_ctx} if config.num_ctx is not None else {})
            body = {"model": config.model, "prompt": prompt, "system": system, "stream": False, "keep_alive": config.keep_alive, "options": options}
            request = Request(config.url.rstrip("/") + "/api/generate", json.dumps(body).encode(), {"Content-Type": "application/json"})
            with urlopen(request, timeout=config.timeout_s) as answer:
                return (json.loads(answer.read()).get("response") or "").strip()

        return ask

    return make


def answered(rows: DataFrame, prompt: str, answer: str, model: Callable[[], Summarizer], calls: int | None = None) -> DataFrame:
    """rows with the model's answer to their prompt column.

    calls bounds the calls at a time, to spare the model's host. The result is written once before it is read:
    nothing downstream asks again, and a failed call leaves no partial result.
    """
    schema = rows.withColumn(answer, F.lit("")).schema

    def ask(frames):
        one = model()
        for frame in frames:
            yield frame.assign(**{answer: [one(p) for p in frame[prompt]]})

    spread = rows.repartition(calls) if calls else rows
    return written(spread.mapInPandas(ask, schema), "answers")


def chunk_prompt(text: str = CHUNK_TEMPLATE) -> Column:
    return template(text, chunk_id=F.col("chunk_id"), chunk_type=F.col("chunk_type"), speaker_span=F.col("speaker_span"), start_time=F.col("start_time"), end_time=F.col("end_time"), chunk_text=F.col("text"))


def labelled(records: DataFrame) -> DataFrame:
    """records with chunk_label: the chunk_id as text, or for a missing one `chunk-` and the record's place in its
    session, by start_time and file_name, with three digits."""
    known = F.col("chunk_id").isNotNull()
    missing = records.where(~known)
    plain = records.where(known).withColumn("chunk_label", F.col("chunk_id").cast("string"))
    if missing.isEmpty():
        return plain
    order = ["session_id", "start_time", "file_name"]
    places = numbered_within(records.select(*order, "chunk_id"), "session_id", [*order, "chunk_id"], "no").where(~known)
    place = places.groupBy(*order).agg(F.min("no").alias("no")).select(*[F.col(c).alias("_" + c) for c in order], "no")
    same = F.lit(True)
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col("_" + c))
    return plain.unionByName(missing.join(place, same).withColumn("chunk_label", summary_file(F.col("no"))).select(*plain.columns))


def map_stage(records: DataFrame, model: Callable[[], Summarizer], calls: int | None = None, text: str = CHUNK_TEMPLATE) -> DataFrame:
    """Chunk summaries: one call per chunk. A missing file_name is the session's id, for a missing chunk_id see
    labelled(); other missing fields of the summary row are null or empty."""
    prompts = labelled(records).withColumn("_prompt", chunk_prompt(text))
    found = answered(prompts, "_prompt", "summary", model, calls)
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return found.select("session_id", "chunk_id", "chunk_label", F.coalesce("file_name", "session_id").alias("file_name"), "start_time", "end_time", empty("speaker_span"), empty("chunk_type"), "summary")


def block(label: Column) -> Column:
    """What the reduce stage reads of one chunk; its headings are fixed values of the format."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.concat(F.lit("# Chunk "), F.coalesce(label, F.lit("")), F.lit("\n- File: "), value("file_name"), F.lit("\n- Time range: "), value("start_time"), F.lit(" to "), value("end_time"), F.lit("\n- Speaker span: "), value("speaker_span"), F.lit("\n\n"), value("summary"))


def reduce_input(summaries: DataFrame) -> DataFrame:
    """(session_id, n_chunks, combined): the blocks of a session in order of chunk_id, separated by blank lines.

    Repeated rows of a key count once; the key is chunk_label where there is one, else chunk_id. The model reads a session as one prompt, so it is one value here.
    """
    label = F.col("chunk_label") if "chunk_label" in summaries.columns else F.col("chunk_id").cast("string")
    once = summaries.groupBy("session_id", "chunk_id", label.alias("label")).agg(F.min(F.struct("file_name", "start_time", "end_time", "speaker_span", "summary")).alias("x")).select("session_id", "chunk_id", "label", "x.*")
    blocks = once.select("session_id", "chunk_id", "label", block(F.col("label")).alias("block"))
    listed = F.array_sort(F.collect_list(F.struct("chunk_id", "label", "block")))
    return blocks.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.array_join(F.transform(listed, lambda x: x["block"]), "\n\n").alias("combined"))


def reduce_prompts(combined: DataFrame, profile: str, profiles: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """(session_id, profile, ord, output_name, prompt): every session with every output of the profile, whose
    templates are those of PROFILES if none are given."""
    profiles = PROFILES if profiles is None else profiles
    if profile not in profiles:
        raise ValueError(f"no profile {profile}; there are {', '.join(sorted(profiles))}")
    outputs = [F.struct(F.lit(i).cast("bigint").alias("ord"), F.lit(name).alias("output_name"), template(text, chunk_summaries=F.col("combined")).alias("prompt")) for i, (name, text) in enumerate(profiles[profile], 1)]
    return combined.select("session_id", F.lit(profile).alias("profile"), F.explode(F.array(*outputs)).alias("o")).select("session_id", "profile", "o.ord", "o.output_name", "o.prompt")


def reduce_stage(summaries: DataFrame, profile: str, model: Callable[[], Summarizer], calls: int | None = None, profiles: dict[str, list[tuple[str, str]]] | None = None) -> DataFrame:
    """(session_id, profile, ord, output_name, content): one call per session and output; contents end with one
    line end."""
    found = answered(reduce_prompts(reduce_input(summaries), profile, profiles), "prompt", "content", model, calls)
    return found.select("session_id", "profile", "ord", "output_name", F.concat(rstrip(F.col("content")), F.lit("\n")).alias("content"))


def summary_file(number: Column) -> Column:
    """The name of a chunk that has no id."""
    return F.concat(F.lit("chunk-"), padded_id(number))
