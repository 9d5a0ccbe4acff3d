"""Session records: the log of states, its latest rows, predicates, and what hangs on a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import first_filled, session_id, session_slug, stamp
from parlance.operators.scans import filled_forward

ACTIVE = ("starting", "recording", "stopping")
#: Allowed changes of state; a stopped session may be stopped again.
NEXT = {None: ("starting",), "starting": ("recording", "start_failed"), "recording": ("stopping",), "stopping": ("stopped", "stop_failed"), "stopped": ("stopping",), "stop_failed": ("stopping",), "start_failed": ()}


def latest(log: DataFrame, version: tuple[str, ...] = ("written_at", "log_id")) -> DataFrame:
    """The last written row of every session; of equal times the higher log_id. Nulls count as first. Rows
    written twice, late or out of order don't matter."""
    rest = [c for c in log.columns if c != "session_id"]
    best = F.max_by(F.struct(*rest), F.struct(*version)).alias("_x")
    return log.groupBy("session_id").agg(best).select(*[F.col("session_id") if c == "session_id" else F.col(f"_x.{c}") for c in log.columns])


def current(log: DataFrame, version: tuple[str, ...] = ("written_at", "log_id")) -> DataFrame:
    """The one row written last of all; none for an empty log."""
    return log.agg(F.max_by(F.struct(*log.columns), F.struct(*version)).alias("_x")).where(F.col("_x").isNotNull()).select("_x.*")


def is_active() -> Column:
    return F.coalesce(F.col("state").isin(*ACTIVE), F.lit(False))


def blocks_start() -> Column:
    """Only a session that records and hasn't stopped blocks a new start."""
    return F.coalesce(F.col("state") == "recording", F.lit(False)) & F.col("stopped_at").isNull()


def stop_outcome(has_session: Column, asked: Column, of: Column) -> Column:
    """404 without a session, 409 if another one is asked for by a filled id, else 200."""
    return F.when(~has_session, 404).when(asked.isNotNull() & (asked != "") & ~asked.eqNullSafe(of), 409).otherwise(200).cast("bigint")


def badge() -> Column:
    return F.when(F.col("state") == "recording", "REC").when(F.col("state").isin("starting", "stopping"), "...").otherwise("")


def started(requests: DataFrame) -> DataFrame:
    """requests with slug and session_id: the slug of user_label, else of the title, else `lesson`."""
    made = requests.withColumn("slug", session_slug(first_filled(F.col("user_label"), F.col("title"), "lesson")))
    return made.withColumn("session_id", session_id(F.col("started_at"), F.col("slug")))


def broken_changes(log: DataFrame) -> DataFrame:
    """(session_id, state, next_state, n): changes of state, in order of writing, that a session may not make.

    A session has a handful of states, so its log is one array.
    """
    rows = log.groupBy("session_id").agg(F.array_sort(F.array_distinct(F.collect_list(F.struct("written_at", "log_id", "state")))).alias("x"))
    pairs = rows.select("session_id", F.explode(F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), F.slice(F.transform("x", lambda r: r["state"]), 1, F.greatest(F.size("x") - 1, F.lit(0)))).alias("state"), F.transform("x", lambda r: r["state"]).alias("next_state"))).alias("p")).select("session_id", "p.state", "p.next_state")
    allowed = F.lit(False)
    for a, after in NEXT.items():
        here = F.col("state").isNull() if a is None else F.coalesce(F.col("state") == a, F.lit(False))
        allowed = allowed | (here & (F.coalesce(F.col("next_state").isin(*after), F.lit(False)) if after else F.lit(False)))
    same = F.col("state").eqNullSafe(F.col("next_state"))
    return pairs.where(~allowed & ~same).groupBy("session_id", "state", "next_state").agg(F.count(F.lit(1)).alias("n"))


def refreshed(metadata: DataFrame, log: DataFrame, keys: tuple[str, ...] = ("slug", "title", "url", "state")) -> DataFrame:
    """metadata with `keys` from the latest record of its session where there is one that isn't null."""
    of = latest(log).select("session_id", *[F.col(k).alias("_" + k) for k in keys])
    return metadata.join(of, "session_id", "left").select(*[F.coalesce("_" + c, c).alias(c) if c in keys else F.col(c) for c in metadata.columns])


def overlaid(sessions: DataFrame, recording: Column, name: Column) -> DataFrame:
    """Metadata sidecars: the session's fields with recording_file, transcript_dir and summary_dir."""
    return sessions.withColumns({"recording_file": recording, "transcript_dir": name, "summary_dir": name})


def with_artefacts(sidecars: DataFrame, folders: DataFrame, name: str = "transcript_dir") -> DataFrame:
    """Only the sidecars whose folder exists; folders: one column of that name, repeated names allowed."""
    return sidecars.join(folders.select(name), name, "left_semi")


def with_recording(stops: DataFrame, recordings: DataFrame) -> DataFrame:
    """stops (session_id, slug, stopped_at) with recording, the newest of recordings (name, at) at or before
    stopped_at, and stored_as, the slug, or `lesson` for a blank one, and the time of the stop.

    No key joins the two, so both are put into one order of time and the last recording is carried forward.
    Of recordings of one time the last by name counts. A null time has no recording.
    """
    a = stops.select("session_id", "slug", F.col("stopped_at").alias("at"), F.lit(None).cast("string").alias("name"), F.lit(1).alias("side"))
    b = recordings.where(F.col("at").isNotNull()).select(F.lit(None).cast("string").alias("session_id"), F.lit(None).cast("string").alias("slug"), "at", "name", F.lit(0).alias("side"))
    both = filled_forward(a.unionByName(b), ["at", "side", "name", "session_id", "slug"], "name", "recording").where(F.col("side") == 1)
    stored = F.concat(first_filled(F.trim("slug"), "lesson"), F.lit("-"), stamp(F.col("at")), F.lit(".wav"))
    return both.select("session_id", "slug", F.col("at").alias("stopped_at"), F.when(F.col("at").isNotNull(), F.col("recording")).alias("recording"), stored.alias("stored_as"))


def newest(files: DataFrame, at: str, name: str) -> DataFrame:
    """The newest file, the last by name of equals; none for no files."""
    return files.agg(F.max_by(F.struct(*files.columns), F.struct(at, name)).alias("_x")).where(F.col("_x").isNotNull()).select("_x.*")


def outcome(transcript: Column, chunks: Column, failed: Column) -> Column:
    """How the processing of a session ended; no speech counts as success for every kind of session."""
    return F.when(~transcript, "no_transcript").when(failed, "failed").when(F.coalesce(chunks, F.lit(0)) == 0, "no_speech").otherwise("yes")


def deletion(wanted: Column, transcript: Column, source: Column) -> Column:
    """What becomes of the source audio: the deletion itself isn't done here."""
    return F.when(~wanted, "no").when(~transcript, "skipped").when(source, "yes").otherwise("already missing")


def status_lines(rows: DataFrame, profile: str) -> DataFrame:
    """(session_id, line_no, line) of the status of rows (session_id, outcome, deleted), as outcome() and deletion()
    give them. The texts are fixed values of the format; a lesson tells that nothing was said, a meeting that
    there are no chunks."""
    silent = ("no speech detected", "skipped (no chunks)") if profile == "lesson" else ("yes", "no chunks found")
    of = F.col("outcome")
    ending = F.when(F.col("deleted") == "skipped", "skipped (no transcript JSON found)").when(F.col("deleted") == "already missing", "source already missing").otherwise(F.col("deleted"))
    chunking = F.when(of == "no_transcript", "no JSON found").when(of == "no_speech", silent[0]).otherwise("yes")
    summaries = F.when(of == "no_transcript", None if profile == "lesson" else silent[1]).when(of == "no_speech", silent[1]).when(of == "failed", "failed").otherwise("yes")
    lines = F.array(F.concat(F.lit("Source audio deleted after transcription: "), ending), F.concat(F.lit("Chunking: "), chunking), F.concat(F.lit("Summaries: "), summaries))
    told = rows.select("session_id", F.posexplode(F.array_compact(lines)).alias("line_no", "line"))
    return told.withColumn("line_no", F.col("line_no").cast("bigint") + 1)
