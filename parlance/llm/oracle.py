"""SQL twins of the training-data queries, for DuckDB, where SQL can say them."""

from __future__ import annotations

from parlance.llm import quality, turns

_NAMES = r"""
nm AS (SELECT DISTINCT session_id, lower(split_part(trim(display_name), ' ', 1)) AS given, lower(split_part(trim(display_name), ' ', -1)) AS family, speaker AS unified FROM speaker_names WHERE display_name IS NOT NULL),
forms AS (
  SELECT session_id, given || ' ' || family AS form, unified FROM nm UNION
  SELECT session_id, family || ', ' || given, unified FROM nm UNION
  SELECT session_id, given[1] || '. ' || family, min(unified) FROM nm GROUP BY ALL HAVING count(DISTINCT given) = 1),
u AS (SELECT *, regexp_extract(label, '(?i)^\W*(?:speaker|spk)[\W_]*?0*(\d+)\W*$', 1) AS digits,
  trim(regexp_replace(regexp_replace(lower(label), '\(.*$', ''), '\s+', ' ', 'g')) AS form FROM rows_in),
l AS (SELECT u.*, CASE WHEN label IS NULL OR label = '' THEN 'UNKNOWN' WHEN digits <> '' THEN 'SPEAKER_' || CASE WHEN length(digits) < 2 THEN lpad(digits, 2, '0') ELSE digits END ELSE coalesce(f.unified, u.form) END AS who
  FROM u LEFT JOIN forms f ON f.session_id = u.session_id AND f.form = u.form),
g AS (SELECT *, CASE WHEN who = lag(who) OVER w AND start_s - lag(end_s) OVER w <= 5 THEN 0 ELSE 1 END AS fresh FROM l WINDOW w AS (PARTITION BY session_id ORDER BY start_s, pos)),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY start_s, pos ROWS UNBOUNDED PRECEDING) AS run FROM g)
"""
_P3 = (
    """WITH rows_in AS (SELECT session_id, pos, start_s, end_s, speaker AS label FROM (SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY session_id, pos ORDER BY seg_id) = 1) WHERE end_s > start_s),"""
    + _NAMES
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _p4(with_text: bool = False) -> str:
    white = "translate(coalesce(text, ''), " + " || ".join(f"chr({ord(c)})" for c in turns.WHITE) + ", " + _text(" " * len(turns.WHITE)) + ")"
    n = lambda x: f"len(regexp_extract_all({x}, {_text(turns.WORDS)}))"
    left = lambda k: f"regexp_replace(regexp_replace(regexp_replace(x, '\\s+', '  ', 'g'), {_text(turns.HESITATION[k])}, '\\1\\2\\3', 'g'), {_text(turns.PHRASE[k])}, ' ', 'g')"
    votes = " ".join(f"WHEN w IN ({', '.join(map(_text, v))}) THEN '{k}'" for k, v in turns.VOTES.items())
    words = " ".join(f"WHEN lang = '{k}' THEN {n(left(k))}" for k in turns.LANGUAGES[1:])
    wordy = " ".join(f"WHEN lang = '{k}' THEN {left(k)}" for k in turns.LANGUAGES[1:])
    clean = f"trim(regexp_replace(CASE WHEN NOT regexp_matches(x, {_text(turns.FILLERS)}) THEN x {wordy} ELSE {left('en')} END, {_text(r'^[\s,]+|\s+(?:,\s+)?')}, ' ', 'g'))"
    told = f", {clean} AS clean" if with_text else ""
    digits = " || ".join(f"coalesce(regexp_extract(white, {_text(turns.OPENING_LABEL)}, {g}), '')" for g in (1, 2, 3))
    return f"""WITH once AS (SELECT session_id, pos, start_s, end_s, speaker, {white} AS white FROM segments QUALIFY row_number() OVER (PARTITION BY session_id, pos ORDER BY seg_id) = 1),
s AS (SELECT *, regexp_replace(regexp_replace(white, {_text(turns.OPENING)}, ' '), {_text(turns.NOISE)}, ' ', 'g') AS x, {digits} AS opening FROM once WHERE end_s > start_s),
v AS (SELECT session_id, CASE {votes} END AS vote FROM (SELECT session_id, lower(regexp_extract(x, {_text(turns.VOTE)}, 1)) AS w FROM s)),
c AS (SELECT session_id, vote, count(*) AS n FROM v WHERE vote IS NOT NULL GROUP BY ALL),
lg AS (SELECT session_id, arg_max(vote, (n, vote)) AS lang FROM c GROUP BY session_id),
rows_in AS (SELECT s.session_id, pos, start_s, end_s, CASE WHEN coalesce(speaker, '') = '' THEN CASE WHEN opening <> '' THEN 'SPEAKER_' || opening END ELSE speaker END AS label,
  CASE {words} ELSE {n(left("en"))} END AS n{told} FROM s LEFT JOIN lg USING (session_id) WHERE n > 0),""" + _NAMES


_P6_LINE = "[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"
_P6 = f"""WITH t AS (SELECT DISTINCT session_id, chunk_id, translate(text, {" || ".join(f"chr({ord(c)})" for c in turns.WHITE if c not in "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029")}, {_text(" " * (len(turns.WHITE) - 10))}) AS x FROM chunk_index),
w AS (SELECT *, len(regexp_extract_all(regexp_replace(x, {_text(_P6_LINE)}, ' ', 'g'), {_text(turns.WORDS)})) AS n FROM t),
s AS (SELECT session_id, chunk_id, unnest(regexp_split_to_array(x, {_text(_P6_LINE + "|[.!?…] ")})) AS stretch FROM w, (SELECT max_words FROM size_limits WHERE purpose = 'split') WHERE n > max_words)
SELECT session_id, chunk_id, CASE WHEN max(len(regexp_extract_all(stretch, {_text(turns.WORDS)}))) > any_value(max_words) THEN 'hard' ELSE 'soft' END AS cut FROM s, (SELECT max_words FROM size_limits WHERE purpose = 'split') GROUP BY session_id, chunk_id"""

_P8_GRAMS = lambda t, i: f"(SELECT {i}, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) AS g FROM (SELECT {i}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {t}))"
_P8 = f"""WITH d AS {_P8_GRAMS("documents", "doc_id")}, e AS {_P8_GRAMS("eval_items", "item_id")}
SELECT DISTINCT doc_id, item_id FROM d JOIN e USING (g)"""

_SYMBOL = r"""[^\p{L}\p{N}_\s.,;:!?'"()\-。、，！？：；「」『』（）《》·…’“”«»¿¡–—]"""
_ENDED = r"""[.!?…:。！？：]["'”’»)\]」』）]*\s*$"""
_WHITE = " || ".join(f"chr({ord(c)})" for c in turns.WHITE if c != "\n")
_P10 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, translate(coalesce(text, ''), {_WHITE}, {_text(" " * (len(turns.WHITE) - 1))}) AS x FROM documents),
e AS (SELECT *, list_filter(regexp_split_to_array(x, '\\s+'), lambda w: w <> '') AS tokens, list_filter(string_split(x, chr(10)), lambda l: trim(l) <> '') AS lines, regexp_extract_all(lower(t), '[\\p{{L}}]+') AS letters FROM d),
f AS (SELECT *, length(regexp_replace(x, '\\s', '', 'g')) AS visible FROM e)
SELECT doc_id, len(regexp_extract_all(x, {_text(turns.WORDS)})) AS n_words,
  CASE WHEN len(tokens) > 0 THEN CAST(visible AS DOUBLE) / len(tokens) ELSE 0 END AS mean_word_len,
  CASE WHEN visible > 0 THEN CAST(len(regexp_extract_all(x, {_text(_SYMBOL)})) AS DOUBLE) / visible ELSE 0 END AS symbol_ratio,
  CASE WHEN len(lines) > 0 THEN CAST(len(list_filter(lines, lambda l: regexp_matches(l, {_text(_ENDED)}))) AS DOUBLE) / len(lines) ELSE 0 END AS end_punct_share,
  CASE WHEN len(letters) > 0 THEN CAST(len(list_filter(letters, lambda w: w IN ({", ".join(_text(w) for w in sorted(quality.COMMON))}))) AS DOUBLE) / len(letters) ELSE 0 END AS common_share FROM f"""

_RUN = "arg_min(pos, (start_s, pos)) AS first_pos"
_MS = lambda x: f"CAST(round({x} * 1000) AS BIGINT)"

_N_WORDS = f"len(regexp_extract_all(translate(text, {' || '.join(f'chr({ord(c)})' for c in turns.WHITE)}, {_text(' ' * len(turns.WHITE))}), {_text(turns.WORDS)}))"
_SOURCE = "nullif(regexp_replace(trim(lower(regexp_replace(source, '[\\s_-]+', ' ', 'g'))), ' ', '_', 'g'), '')"

ORACLE: dict[str, str] = {
    # what must hold of a result, where SQL can't make the result itself
    "p2_checks": f"SELECT session_id, count(*) AS n_chunks, CAST(sum(w) AS BIGINT) AS words, CAST(0 AS BIGINT) AS n_over, true AS thrifty FROM (SELECT session_id, chunk_id, min(coalesce({_N_WORDS}, greatest(word_count, 0), 0)) AS w FROM chunk_index GROUP BY ALL) GROUP BY session_id",
    "p6_checks": f"SELECT session_id, chunk_id, w AS n_words, CAST(0 AS BIGINT) AS n_over, true AS in_order FROM (SELECT DISTINCT session_id, chunk_id, {_N_WORDS} AS w FROM chunk_index), (SELECT max_words FROM size_limits WHERE purpose = 'split') WHERE w > max_words",
    "p7_checks": "SELECT DISTINCT 'segments' AS source_table, session_id, pos AS item_no, true AS kept FROM segments WHERE text IS NOT NULL UNION ALL SELECT DISTINCT 'chunk_index', session_id, chunk_id, true FROM chunk_index WHERE text IS NOT NULL",
    "p9_checks": f"SELECT plan_name, {_SOURCE} AS source, min(coalesce(max_repeats, 0)) AS max_repeats, true AS within_cap, true AS whole FROM mix_plans WHERE plan_name IS NOT NULL AND source IS NOT NULL GROUP BY ALL",
    "p3_found": _P3 + f"SELECT session_id, {_RUN}, arg_max(pos, (start_s, pos)) AS last_pos, count(*) AS n_events, {_MS('max(end_s)')} - {_MS('min(start_s)')} AS duration_ms FROM k GROUP BY session_id, run HAVING count(*) >= 2",
    "p3_events": _P3 + f"SELECT session_id, any_value(who) AS speaker, {_RUN}, arg_max(pos, (start_s, pos)) AS last_pos, count(*) AS n_events, {_MS('min(start_s)')} AS start_ms, {_MS('max(end_s)')} AS end_ms FROM k GROUP BY session_id, run",
    "p6_found": _P6,
    "p8_found": _P8,
    "p10_statistics": _P10,
    "p4_found": _p4() + f"SELECT session_id, {_RUN}, any_value(who) AS speaker, {_MS('min(start_s)')} AS start_ms, {_MS('arg_max(end_s, (start_s, pos))')} AS end_ms, CAST(sum(n) AS BIGINT) AS n_words FROM k GROUP BY session_id, run",
    "p4_turns": _p4(True) + f"SELECT session_id, {_RUN}, any_value(who) AS speaker, {_MS('min(start_s)')} AS start_ms, {_MS('arg_max(end_s, (start_s, pos))')} AS end_ms, CAST(sum(n) AS BIGINT) AS n_words, string_agg(clean, ' ' ORDER BY start_s, pos) AS text FROM k GROUP BY session_id, run",
}
