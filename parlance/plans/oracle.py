"""SQL twins of the core's queries, for DuckDB."""

from __future__ import annotations

_STRETCHES = """WITH once AS (
  SELECT session_id, CASE WHEN speaker IS NULL OR speaker = '' THEN 'UNKNOWN' ELSE speaker END AS speaker, start_s, end_s
  FROM segments QUALIFY row_number() OVER (PARTITION BY session_id, pos ORDER BY seg_id) = 1),
u AS (SELECT * FROM once WHERE end_s > start_s),
r AS (SELECT *, max(end_s) OVER (PARTITION BY session_id, speaker ORDER BY start_s, end_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM u),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY session_id, speaker ORDER BY start_s, end_s ROWS UNBOUNDED PRECEDING) AS k FROM r),
p AS (SELECT session_id, speaker, k, min(start_s) AS s, max(end_s) AS e, count(*) AS n FROM g GROUP BY ALL),
q AS (SELECT *, lead(s) OVER (PARTITION BY session_id, speaker ORDER BY k) AS next_s FROM p)
"""

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_WORD = rf"[^{_WS[1:-1]}]*[\p{{L}}\p{{N}}_][^{_WS[1:-1]}]*"
_COUNT = lambda x: f"len(regexp_extract_all({x}, '{_WORD}'))"
_STRIP = lambda x: f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"
_TOKENS = lambda x: f"list_filter(regexp_split_to_array({x}, '{_WS}+'), lambda t: t <> '')"
_CLOCK = lambda x: f"printf('%02d:%02d:%02d', CAST(trunc({x}) AS BIGINT) // 3600, CAST(trunc({x}) AS BIGINT) // 60 % 60, CAST(trunc({x}) AS BIGINT) % 60)"
_SLUG = lambda x: f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"
#: What some signs stand for under compatibility decomposition, which DuckDB doesn't have.
_COMPAT = lambda x: f"replace(replace(replace(replace(replace({x}, '½', '12'), '№', 'No'), 'ﬁ', 'fi'), '²', '2'), 'Ⅳ', 'IV')"
_FOLDED = lambda x: f"coalesce(nullif(left({_SLUG(f"regexp_replace(strip_accents({_COMPAT(x)}), '[^\\x00-\\x7f]', '', 'g')")}, 80), ''), 'lesson')"
_TIME = lambda c: f"strftime({c} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S.%f')"
_TIMES = ", ".join(f"{_TIME(c)} AS {c}" for c in ("started_at", "stopped_at", "written_at"))
_LATEST = "(SELECT * FROM sessions QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY written_at DESC NULLS LAST, log_id DESC) = 1)"

_NORMAL = f"""n AS (
  SELECT session_id, pos, coalesce(start_s, 0) AS start_s, coalesce(end_s, 0) AS end_s, CASE WHEN speaker IS NULL OR speaker = '' THEN 'UNKNOWN' ELSE speaker END AS speaker, {_STRIP("coalesce(text, '')")} AS text
  FROM (SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY session_id, pos ORDER BY seg_id) = 1)
  WHERE {_STRIP("coalesce(text, '')")} <> '')"""
_TURNS = f"""{_NORMAL},
f AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER w AND start_s - lag(end_s) OVER w <= 5 THEN 0 ELSE 1 END AS fresh FROM n WINDOW w AS (PARTITION BY session_id ORDER BY start_s, pos)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY start_s, pos ROWS UNBOUNDED PRECEDING) AS turn_no FROM f),
turns AS (SELECT session_id, CAST(turn_no AS BIGINT) AS turn_no, any_value(speaker) AS speaker, min(start_s) AS start_s, arg_max(end_s, (start_s, pos)) AS end_s, count(*) AS n_segments, string_agg(text, ' ' ORDER BY start_s, pos) AS text FROM g GROUP BY session_id, turn_no)"""
_CUT = lambda x: f"CASE WHEN len({_TOKENS(x)}) > 200 THEN list_transform(range(0, len({_TOKENS(x)}), 120), lambda i: array_to_string({_TOKENS(x)}[i + 1:i + 120], ' ')) ELSE [{x}] END"
_PIECES = f"""{_TURNS},
cut AS (SELECT *, {_CUT("text")} AS parts FROM turns),
pieces AS (SELECT session_id, turn_no, speaker, start_s, end_s, unnest(generate_series(0, len(parts) - 1)) AS piece_no, unnest(parts) AS text FROM cut),
seq AS (SELECT *, {_COUNT("text")} AS n_words, row_number() OVER (PARTITION BY session_id ORDER BY turn_no, piece_no) AS i FROM pieces)"""
_PACKED = f"""{_PIECES},
fold AS (
  SELECT session_id, i, CAST(1 AS BIGINT) AS chunk_no, n_words AS cur FROM seq WHERE i = 1
  UNION ALL
  SELECT s.session_id, s.i, CASE WHEN r.cur + s.n_words > 200 OR r.cur >= 120 THEN r.chunk_no + 1 ELSE r.chunk_no END, CASE WHEN r.cur + s.n_words > 200 OR r.cur >= 120 THEN s.n_words ELSE r.cur + s.n_words END
  FROM fold r JOIN seq s ON s.session_id = r.session_id AND s.i = r.i + 1)"""
_CHUNKS = f"""{_PACKED},
p AS (SELECT seq.*, chunk_no FROM seq JOIN fold USING (session_id, i)),
sums AS (SELECT session_id, chunk_no, sum(n_words) AS words FROM p GROUP BY ALL),
tails AS (SELECT *, lag(words) OVER (PARTITION BY session_id ORDER BY chunk_no) AS before, max(chunk_no) OVER (PARTITION BY session_id) AS last_no FROM sums),
tail AS (SELECT session_id, last_no FROM tails WHERE chunk_no = last_no AND last_no > 1 AND words <= 45 AND before + words <= 200),
c AS (SELECT p.*, chunk_no - CASE WHEN tail.last_no IS NULL THEN 0 ELSE 1 END AS chunk_id FROM p LEFT JOIN tail ON tail.session_id = p.session_id AND tail.last_no = p.chunk_no)"""
_RECORDS = f"""{_CHUNKS},
sp AS (SELECT session_id, chunk_id, string_agg(speaker, ' -> ' ORDER BY i) AS speaker_span FROM (SELECT *, lag(speaker) OVER (PARTITION BY session_id, chunk_id ORDER BY i) AS b FROM c) WHERE b IS NULL OR b <> speaker GROUP BY ALL),
a AS (SELECT session_id, chunk_id, CAST(count(DISTINCT speaker) AS BIGINT) AS speaker_count, arg_min(start_s, i) AS start_time, arg_max(end_s, i) AS end_time, string_agg('[' || speaker || '] ' || text, chr(10) ORDER BY i) AS text, array_to_string(list_sort(list(DISTINCT speaker)), ', ') AS speakers,
  string_agg('## [' || speaker || '] ' || {_CLOCK("start_s")} || ' → ' || {_CLOCK("end_s")} || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY i) AS body FROM c GROUP BY ALL),
rec AS (SELECT session_id, printf('%03d', chunk_id) || '-' || kind || '-' || coalesce(nullif(left({_SLUG("speaker_span")}, 50), ''), 'chunk') || '.md' AS file_name, chunk_id, kind AS chunk_type, speaker_span, speaker_count, start_time, end_time, {_COUNT("text")} AS word_count, text, speakers, body
  FROM (SELECT *, CASE WHEN speaker_count = 1 THEN 'single_speaker' ELSE 'discussion' END AS kind FROM a JOIN sp USING (session_id, chunk_id)))"""
_TEXT = lambda c: f"coalesce(CAST({c} AS VARCHAR), '')"
_PROMPT = f"'Chunk ' || {_TEXT('chunk_id')} || ' (' || {_TEXT('chunk_type')} || '), speakers ' || {_TEXT('speaker_span')} || ', ' || {_TEXT('start_time')} || ' to ' || {_TEXT('end_time')} || ':' || chr(10) || chr(10) || {_TEXT('text')}"
_FIRST = lambda x: f"array_to_string(({_TOKENS(f'string_split({x}, chr(10) || chr(10))[-1]')})[1:12], ' ')"
_BLOCKS = f"""b AS (SELECT DISTINCT session_id, chunk_id, '# Chunk ' || {_TEXT('chunk_id')} || chr(10) || '- File: ' || {_TEXT('file_name')} || chr(10) || '- Time range: ' || {_TEXT('start_time')} || ' to ' || {_TEXT('end_time')} || chr(10) || '- Speaker span: ' || {_TEXT('speaker_span')} || chr(10) || chr(10) || {_TEXT('summary')} AS block FROM chunk_summaries),
r AS (SELECT session_id, count(*) AS n_chunks, string_agg(block, chr(10) || chr(10) ORDER BY chunk_id) AS combined FROM b GROUP BY session_id)"""
_OUTPUTS = " UNION ALL ".join(f"SELECT {i} AS ord, '{n}' AS output_name" for i, n in enumerate(("lesson-notes.md", "flashcards.md", "quiz.md", "review-sheet.md"), 1))

_STATUS = f"WITH l AS (SELECT session_id FROM {_LATEST}), m AS (SELECT session_id, count(DISTINCT chunk_id) AS n FROM chunk_index GROUP BY 1), x AS (SELECT l.session_id, l.session_id IN (SELECT session_id FROM segments WHERE session_id IS NOT NULL) AS t, m.n, l.session_id IN (SELECT session_id FROM chunk_summaries WHERE session_id IS NOT NULL) AS s FROM l LEFT JOIN m USING (session_id)) SELECT session_id, coalesce(n, 0) AS n_chunks, CASE WHEN NOT t THEN 'no_transcript' WHEN coalesce(n, 0) > 0 AND NOT s THEN 'failed' WHEN coalesce(n, 0) = 0 THEN 'no_speech' ELSE 'yes' END AS outcome, CASE WHEN NOT s THEN 'no' WHEN NOT t THEN 'skipped' WHEN n IS NOT NULL THEN 'yes' ELSE 'already missing' END AS deleted FROM x"
_DELETED = "'Source audio deleted after transcription: ' || CASE deleted WHEN 'skipped' THEN 'skipped (no transcript JSON found)' WHEN 'already missing' THEN 'source already missing' ELSE deleted END"
_LINES = {
    "lesson": ("CASE outcome WHEN 'no_transcript' THEN 'no JSON found' WHEN 'no_speech' THEN 'no speech detected' ELSE 'yes' END", "CASE outcome WHEN 'no_speech' THEN 'skipped (no chunks)' WHEN 'failed' THEN 'failed' ELSE 'yes' END"),
    "meeting": ("CASE outcome WHEN 'no_transcript' THEN 'no JSON found' ELSE 'yes' END", "CASE outcome WHEN 'no_transcript' THEN 'no chunks found' WHEN 'no_speech' THEN 'no chunks found' WHEN 'failed' THEN 'failed' ELSE 'yes' END"),
}
_LOG = " UNION ALL ".join(
    f"SELECT session_id, '{k}' AS profile, CAST(1 AS BIGINT) AS line_no, {_DELETED} AS line FROM st UNION ALL SELECT session_id, '{k}', 2, 'Chunking: ' || {c} FROM st UNION ALL SELECT session_id, '{k}', 3, 'Summaries: ' || {m} FROM st" + (" WHERE outcome <> 'no_transcript'" if k == "lesson" else "")
    for k, (c, m) in _LINES.items()
)
_COLUMNS = "session_id, file_name, chunk_id, chunk_type, speaker_span, speaker_count, start_time, end_time, word_count"
_MEETING = " UNION ALL ".join(f"SELECT {i} AS ord, '{n}' AS output_name" for i, n in enumerate(("summary.md", "action-items.md", "minutes-draft.md"), 1))
_PARAGRAPHS = f"WITH {_NORMAL}, f AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY session_id ORDER BY pos) THEN 0 ELSE 1 END AS fresh FROM n), g AS (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS k FROM f) SELECT session_id, CAST(k AS BIGINT) AS paragraph_no, '[' || any_value(speaker) || '] ' || string_agg(text, ' ' ORDER BY pos) AS paragraph FROM g GROUP BY session_id, k"

ORACLE: dict[str, str] = {
    "p1_found": _STRETCHES
    + """SELECT session_id, speaker, 'period' AS kind, CAST(round(s * 1000) AS BIGINT) AS start_ms, CAST(round(e * 1000) AS BIGINT) AS end_ms FROM q WHERE n >= 2
UNION ALL
SELECT session_id, speaker, 'gap', CAST(round(e * 1000) AS BIGINT), CAST(round(next_s * 1000) AS BIGINT) FROM q WHERE next_s - e <= 600""",
    "p1_timeline": _STRETCHES
    + """SELECT session_id, speaker, 'period' AS kind, CAST(round(s * 1000) AS BIGINT) AS start_ms, CAST(round(e * 1000) AS BIGINT) AS end_ms, n AS n_segments FROM q
UNION ALL
SELECT session_id, speaker, 'gap', CAST(round(e * 1000) AS BIGINT), CAST(round(next_s * 1000) AS BIGINT), 0 FROM q WHERE next_s IS NOT NULL""",
    "segments_normalized": f"WITH {_NORMAL} SELECT * FROM n",
    "word_count": f"SELECT doc_id, coalesce({_COUNT('text')}, 0) AS n_words FROM documents",
    "format_timestamp": f"SELECT seg_id, {_CLOCK('start_s')} AS clock FROM segments WHERE start_s IS NOT NULL",
    "turns_merged": f"WITH {_TURNS} SELECT * FROM turns",
    "oversized_split": f"WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), cut AS (SELECT doc_id, {_CUT('text')} AS parts FROM d), p AS (SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS piece_no, unnest(parts) AS text FROM cut) SELECT doc_id, piece_no, text, {_COUNT('text')} AS n_words FROM p",
    "speaker_transcript": _PARAGRAPHS,
    "transcript_files": f"SELECT session_id, session_id || '.speaker.txt' AS name, string_agg(paragraph, chr(10) || chr(10) ORDER BY paragraph_no) || chr(10) AS content FROM ({_PARAGRAPHS}) GROUP BY session_id",
    "chunk_assign": f"WITH RECURSIVE {_PACKED} SELECT session_id, turn_no, piece_no, n_words, chunk_no FROM seq JOIN fold USING (session_id, i)",
    "tail_merge": f"WITH RECURSIVE {_CHUNKS} SELECT session_id, chunk_id, count(*) AS n_pieces FROM c GROUP BY ALL",
    "chunk_records": f"WITH RECURSIVE {_RECORDS} SELECT session_id, file_name, chunk_id, chunk_type, speaker_span, speaker_count, start_time, end_time, word_count, text FROM rec",
    "speaker_span": f"WITH RECURSIVE {_RECORDS} SELECT session_id, chunk_id, speaker_span, speaker_count, chunk_type FROM rec",
    "chunk_markdown": f"WITH RECURSIVE {_RECORDS} SELECT session_id, chunk_id, '# Transcript Chunk ' || printf('%03d', chunk_id) || chr(10) || chr(10) || '- Time range: ' || {_CLOCK('start_time')} || ' → ' || {_CLOCK('end_time')} || chr(10) || '- Speakers: ' || speakers || chr(10) || '- Chunk type: ' || chunk_type || chr(10) || chr(10) || body || chr(10) AS content FROM rec",
    "chunk_manifest": "SELECT session_id, count(DISTINCT chunk_id) AS n_chunks, '# Chunks of ' || session_id || chr(10) || chr(10) || 'Chunks written: ' || count(DISTINCT chunk_id) || chr(10) AS content FROM chunk_index GROUP BY session_id",
    "session_slug": f"SELECT log_id, {_FOLDED('title')} AS slug FROM sessions",
    "session_id": f"SELECT log_id, slug, strftime(started_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H-%M-%SZ') || '-' || slug AS session_id FROM (SELECT log_id, started_at, {_FOLDED("coalesce(nullif(user_label, ''), nullif(title, ''), 'lesson')")} AS slug FROM sessions)",
    "session_latest": f"SELECT * REPLACE ({_TIMES}) FROM {_LATEST}",
    "session_current": f"SELECT * REPLACE ({_TIMES}) FROM (SELECT * FROM sessions ORDER BY written_at DESC NULLS LAST, log_id DESC LIMIT 1)",
    "session_conflicts": f"SELECT session_id, state, coalesce(state IN ('starting', 'recording', 'stopping'), false) AS is_active, coalesce(state = 'recording', false) AND stopped_at IS NULL AS blocks_start, CASE WHEN state = 'recording' THEN 'REC' WHEN state IN ('starting', 'stopping') THEN '...' ELSE '' END AS badge FROM {_LATEST}",
    "session_stops": f"SELECT doc_id, CAST(CASE WHEN s.session_id IS NULL THEN 404 WHEN doc_id % 3 = 0 THEN 409 ELSE 200 END AS BIGINT) AS outcome FROM documents d LEFT JOIN (SELECT DISTINCT session_id FROM sessions) s ON d.session_id = s.session_id",
    "session_changes": "WITH d AS (SELECT DISTINCT session_id, written_at, log_id, state FROM sessions), p AS (SELECT session_id, lag(state) OVER (PARTITION BY session_id ORDER BY written_at, log_id, state) AS state, state AS next_state FROM d) SELECT session_id, state, next_state, count(*) AS n FROM p WHERE state IS DISTINCT FROM next_state AND (coalesce(state, '-'), coalesce(next_state, '-')) NOT IN (('-', 'starting'), ('starting', 'recording'), ('starting', 'start_failed'), ('recording', 'stopping'), ('stopping', 'stopped'), ('stopping', 'stop_failed'), ('stopped', 'stopping'), ('stop_failed', 'stopping')) GROUP BY ALL",
    "metadata_lookup": f"SELECT m.log_id, m.session_id, coalesce(l.slug, m.slug) AS slug, coalesce(l.title, m.title) AS title, coalesce(l.url, m.url) AS url, coalesce(l.state, m.state) AS state FROM sessions m LEFT JOIN {_LATEST} l ON l.session_id = m.session_id WHERE m.state = 'starting'",
    "metadata_artefacts": f"SELECT session_id, state, session_id || '.wav' AS recording_file, session_id AS transcript_dir, session_id AS summary_dir FROM {_LATEST} WHERE session_id IN (SELECT session_id FROM chunk_index)",
    "latest_recording": f"WITH s AS (SELECT session_id, slug, stopped_at FROM {_LATEST} WHERE stopped_at IS NOT NULL), d AS (SELECT created_at AS at, max('rec-' || doc_id || '.wav') AS name FROM documents WHERE created_at IS NOT NULL GROUP BY created_at) SELECT session_id, slug, {_TIME('stopped_at')} AS stopped_at, d.name AS recording, coalesce(nullif(trim(slug), ''), 'lesson') || '-' || strftime(stopped_at AT TIME ZONE 'UTC', '%Y-%m-%d-%H%M%S') || '.wav' AS stored_as FROM s ASOF LEFT JOIN d ON s.stopped_at >= d.at",
    "newest_file": "SELECT DISTINCT file_name, end_time AS end_s FROM chunk_index WHERE end_time IS NOT NULL ORDER BY end_s DESC, file_name DESC NULLS LAST LIMIT 1",
    "file_parts": "SELECT DISTINCT session_id, chunk_id, file_name AS base, regexp_replace(file_name, '\\.[^.]*$', '') AS stem, '/data/out/' || regexp_replace(file_name, '\\.[^.]*$', '') || '.metadata.json' AS sidecar FROM chunk_index WHERE file_name IS NOT NULL",
    "url_trimmed": "SELECT log_id, regexp_replace(url, '/+$', '') AS url FROM sessions",
    "session_extra": "SELECT log_id, CASE WHEN extra IS NULL OR json_valid(extra) THEN extra ELSE CAST(json_object('raw', extra) AS VARCHAR) END AS extra FROM sessions",
    "redacted_command": "SELECT log_id, 'transcribe --hf_token [REDACTED] --language en ' || coalesce(url, '') AS command FROM sessions WHERE session_id IS NOT NULL UNION ALL SELECT log_id, NULL FROM sessions WHERE session_id IS NULL",
    "status_outcome": _STATUS,
    "prompt_render": f"SELECT session_id, chunk_id, {_PROMPT} AS prompt FROM (SELECT DISTINCT * FROM chunk_index)",
    "map_summaries": f"SELECT session_id, chunk_id, CAST(chunk_id AS VARCHAR) AS chunk_label, coalesce(file_name, session_id) AS file_name, {_FIRST(_PROMPT)} AS summary FROM (SELECT DISTINCT * FROM chunk_index)",
    "reduce_input": f"WITH {_BLOCKS} SELECT * FROM r",
    "reduce_outputs": f"WITH {_BLOCKS}, o AS ({_OUTPUTS}) SELECT session_id, 'lesson' AS profile, CAST(ord AS BIGINT) AS ord, output_name, {_FIRST('combined')} || chr(10) AS content FROM r, o",
    "reduce_meeting": f"WITH {_BLOCKS}, o AS ({_MEETING}) SELECT session_id, 'meeting' AS profile, CAST(ord AS BIGINT) AS ord, output_name, {_FIRST('combined')} || chr(10) AS content FROM r, o",
    "status_log": f"WITH st AS ({_STATUS}) {_LOG}",
    "transcripts_read": "SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY pos) - 1 AS pos, start_s, end_s, speaker, text FROM (SELECT * FROM segments WHERE session_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY session_id, pos ORDER BY seg_id) = 1)",
    "index_read_json": "SELECT DISTINCT * FROM chunk_index",
    "index_read_csv": f"SELECT DISTINCT {_COLUMNS}, nullif(text, '') AS text FROM chunk_index",
    "summaries_read": f"SELECT session_id, chunk_id, coalesce(file_name, session_id) AS file_name, {_FIRST(_PROMPT)} AS summary FROM (SELECT DISTINCT * FROM chunk_index)",
}
