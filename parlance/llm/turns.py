"""Problem 4: speech transcripts into clean speaker turns.

The patterns hold for Java and RE2 alike, so the SQL twin shares them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import WHITE, spaced
from parlance.operators.runs import merged_runs
from parlance.operators.segments import delivered_once, milliseconds, split_label, unified, usable
from parlance.sources.shared import written

#: Sounds a transcriber notes down, alone within brackets, asterisks or notes.
SOUNDS = "applause|background noise|beep|beeping|breathing|cheering|clears throat|coughing|coughs|cross ?talk|door closes|door opens|inaudible|indistinct|laughing|laughs|laughter|music|music playing|noise|pause|phone ringing|sighing|sighs|silence|sneezes|sniffs|static|unintelligible"
#: Hesitation sounds by language, each letter as often as the speaker drew it out.
HESITATIONS = {"de": "[äÄ]+h+m*|[öÖ]+h+m*|h+m+", "en": "u+m+|u+h+m*|e+r+m*|h+m+|m+m+", "es": "e+h+m*|e+m+|m+m+", "fr": "e+u+h+|h+e+u+|h+u+m+"}
#: Phrases without meaning when commas set them off.
PHRASES = {"de": "weißt du|wisst ihr|sozusagen|sag ich mal", "en": "you know|i mean|kind of|sort of|you see", "es": "o sea|digamos|sabes|sab[éÉ]is", "fr": "tu vois|vous voyez|disons|vous savez|tu sais"}
#: Frequent words that the other languages here don't have.
COMMON = {"en": "the|and|of|that|with|from|for|you|we|are|is", "de": "der|die|das|ist|nicht|und|wird|wir|ich|dass|den", "fr": "est|une|vous|nous|pas|cela|le|il|ce|sur|au", "es": "el|los|por|una|est[áÁ]|del|hay|lo|fue|se|al"}
LANGUAGES = ("en", "de", "fr", "es")

_CLOCK = r"\d{1,5}:\d\d(?::\d\d)?(?:[.,]\d+)?"
_SPAN = r"\d{1,3}:\d\d:\d\d[.,]\d+(?:\s*-->\s*\d{1,3}:\d\d:\d\d[.,]\d+)?"
_NOISE = rf"[\[({{<*]\s*(?:{SOUNDS})(?:\s+{_CLOCK})?\s*[\])}}>*]|♪[^♪]*♪|\[\s*{_CLOCK}\s*\]|<\s*{_CLOCK}\s*>|{_SPAN}"
_NUMBER = r"(?:speaker|spk)[\s_-]*(\d+)"
_LABEL = rf"(?:>>\s*)?(?:\[\s*{_NUMBER}\s*\]:?|{_NUMBER}\s*:|{_NUMBER}\s+[-–—](?:\s|$))"
_OPENING_TIME = rf"\(\s*{_CLOCK}\s*\)|\d{{1,3}}:\d\d:\d\d\s+[-–—](?:\s|$)"
#: Everything at the opening that wasn't said.
OPENING = rf"(?i)^(?:\s*(?:{_NOISE}|{_OPENING_TIME}|{_LABEL}))+"
#: The same up to the first label; one of its three groups is the number.
OPENING_LABEL = rf"(?i)^(?:\s*(?:{_NOISE}|{_OPENING_TIME}))*\s*{_LABEL}"
NOISE = rf"(?i){_NOISE}"
#: A word from its first letter, digit or underscore on; nothing to go back on.
WORDS = r"[\p{L}\p{N}_]\S*"
_SPOKEN = {k: v.replace(" ", r"\s+") for k, v in PHRASES.items()}
#: Wants doubled spaces, as a hesitation may follow another; keeps a comma, which may set off a phrase.
HESITATION = {k: rf"(?i)(^|\s)[\"'(…-]*(?:{v})[.…!?;:-]*(,?)[.…]*(\s|$)" for k, v in HESITATIONS.items()}
PHRASE = {k: rf"(?i)(?:^|,)\s*(?:{v})\s*," for k, v in _SPOKEN.items()}
#: Whether a text needs the replacements of any language.
FILLERS = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])(?:{'|'.join([*HESITATIONS.values(), *_SPOKEN.values()])})(?:$|[^\p{{L}}\p{{N}}])"
#: What a text of ASCII signs has in which OPENING or NOISE finds something, or white space other than blanks.
NOTED = r"[\[({<*:>\t-\r\x1c-\x1f]|^ *[sS][pP]"
#: The first common word of a text, its group 1; no word stands in two languages.
VOTE = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])({'|'.join(COMMON.values())})(?:$|[^\p{{L}}\p{{N}}])"
VOTES = {k: [w.replace("[áÁ]", "á") for w in v.split("|")] for k, v in COMMON.items()}


def said(text: Column) -> Column:
    """The text without time marks, sound annotations and opening labels; its fillers stay."""
    return F.regexp_replace(F.regexp_replace(spaced(text), OPENING, " "), NOISE, " ")


def without_fillers(text: Column, lang: str) -> Column:
    """What said() gives, without the fillers of one language."""
    wide = F.regexp_replace(text, r"\s+", "  ")
    return F.regexp_replace(F.regexp_replace(wide, HESITATION[lang], "$1$2$3"), PHRASE[lang], " ")


def opening_label(text: Column) -> Column:
    """SPEAKER_ and the number of the label the text opens with; null without one."""
    x = spaced(text)
    digits = F.concat(*[F.regexp_extract(x, OPENING_LABEL, k) for k in (1, 2, 3)])
    return F.when(digits != "", F.concat(F.lit("SPEAKER_"), digits))


def tidy(text: Column) -> Column:
    """Single blanks, and none or a comma left at the ends where something was taken out."""
    return F.trim(F.regexp_replace(text, r"^[\s,]+|\s+(?:,\s+)?", " "))


def clean_text(text: Column, lang: Column) -> Column:
    """The clean text, given its session's language (en where it is null or unknown)."""
    x = said(text)
    return tidy(F.when(x.rlike(FILLERS), by_language(x, lang)).otherwise(x))


def vote(text: Column) -> Column:
    """The language of the first common word of a text; null for none."""
    word = F.lower(F.regexp_extract(text, VOTE, 1))
    out = F.when(word == "", None)
    for k, words in VOTES.items():
        out = out.when(word.isin(words), k)
    return out


def session_languages(rows: DataFrame, by: str = "vote") -> DataFrame:
    """(session_id, lang): the language most rows of the session vote for, the last by name of equals."""
    counts = rows.where(F.col(by).isNotNull()).groupBy("session_id", by).count()
    return counts.groupBy("session_id").agg(F.max_by(by, F.struct("count", F.col(by))).alias("lang"))


def with_language(rows: DataFrame, languages: DataFrame, salts: int = 16) -> DataFrame:
    """rows with the language of their session, null for none. The rows of a session are spread over `salts`
    keys, and its one language is repeated for each, so a large session isn't one task."""
    told = languages.select(F.col("session_id").alias("_s"), "lang", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt_of"))
    spread = rows.withColumn("_salt", F.pmod(F.hash("pos"), F.lit(salts)))
    return spread.join(told, F.col("session_id").eqNullSafe(F.col("_s")) & (F.col("_salt") == F.col("_salt_of")), "left").drop("_s", "_salt", "_salt_of")


def by_language(text: Column, lang: Column) -> Column:
    """The text without the fillers of its language, en where that is null or unknown."""
    out = None
    for k in LANGUAGES[1:]:
        out = (F if out is None else out).when(lang == k, without_fillers(text, k))
    return out.otherwise(without_fillers(text, "en"))


def measured(segments: DataFrame, keep_text: bool = False) -> DataFrame:
    """(session_id, pos, start_s, end_s, speaker, label, vote, n, rest) per usable segment: speaker and label as of
    split_label, n words, and in rest what was said where a filler may have to go; with keep_text also text, the
    clean text where none has to.

    Texts are read once, where they lie. Most have no sign that OPENING or NOISE needs and are only tested for
    fillers and counted; only those with fillers are shuffled, unless texts are kept.
    """
    text = F.coalesce("text", F.lit(""))
    label = F.when(F.col("speaker").isNull() | (F.col("speaker") == ""), opening_label(F.col("text"))).otherwise(F.col("speaker"))
    base = segments.select("session_id", "pos", "seg_id", "start_s", "end_s", label.alias("label"), F.when((F.octet_length(text) != F.length(text)) | text.rlike(NOTED), said(text)).otherwise(text).alias("x"))
    base = base.withColumn("filled", F.col("x").rlike(FILLERS))
    kept = [F.when(~F.col("filled"), tidy(F.col("x"))).alias("text")] if keep_text else []
    once = delivered_once(base, F.col("start_s"), F.col("end_s"), *split_label(F.col("label")), vote(F.col("x")).alias("vote"), F.regexp_count("x", F.lit(WORDS)).cast("int").alias("n"), F.when(F.col("filled"), F.col("x")).alias("rest"), *kept)
    return once.where(usable())


def counted(rows: DataFrame, languages: DataFrame) -> DataFrame:
    """rows with n, and text if there is one, less the fillers of the session's language; rows without a word are
    left out."""
    kept = [c for c in rows.columns if c not in ("rest", "vote")]
    less = with_language(rows.where(F.col("rest").isNotNull()), languages).withColumn("rest", by_language(F.col("rest"), F.col("lang")))
    less = less.withColumns({"n": F.regexp_count("rest", F.lit(WORDS)).cast("int"), "text": tidy(F.col("rest"))})
    return rows.where(F.col("rest").isNull()).select(*kept).unionByName(less.select(*kept)).where(F.col("n") > 0)


def clean_turns(segments: DataFrame, speaker_names: DataFrame, max_gap_s: float = 5.0, keep_text: bool = False) -> DataFrame:
    """(session_id, first_pos, last_pos, speaker, start_s, end_s, n_segments, n_words) per clean turn, and with
    keep_text its text, the clean texts of its segments joined by blanks.

    Repeated deliveries count once, segments without usable times or without a word left drop out, a null text
    has no word. Null speakers take the label the text opens with, else UNKNOWN. end_s is that of the turn's
    last segment; names of one speaker are clustered among those of all usable segments of the session, see
    cluster_names. A turn's text is one
    value, so one turn, a speaker's run without a pause, must fit memory.
    """
    rows = written(measured(segments, keep_text), "measured")
    told = ["text"] if keep_text else []
    known = counted(unified(rows, speaker_names), session_languages(rows)).select(F.col("session_id").alias("entity"), F.col("speaker").alias("label"), "pos", F.col("start_s").alias("s"), F.col("end_s").alias("e"), F.col("n").alias("weight"), *told)
    # written before it is range-sorted, as the borders are sampled from it
    runs = merged_runs(written(known, "labelled"), max_gap_s)
    return runs.select(F.col("entity").alias("session_id"), "first_pos", F.col("label").alias("speaker"), F.col("s").alias("start_s"), F.col("last_e").alias("end_s"), "last_pos", F.col("n").alias("n_segments"), F.col("weight").alias("n_words"), *told)


def found_turns(segments: DataFrame, speaker_names: DataFrame, max_gap_s: float = 5.0, keep_text: bool = False) -> DataFrame:
    """(session_id, first_pos, speaker, start_ms, end_ms, n_words) per clean turn, and with keep_text its text."""
    turns = clean_turns(segments, speaker_names, max_gap_s, keep_text)
    return turns.select("session_id", "first_pos", "speaker", milliseconds(F.col("start_s")).alias("start_ms"), milliseconds(F.col("end_s")).alias("end_ms"), "n_words", *(["text"] if keep_text else []))


def turns_with_text(segments: DataFrame, speaker_names: DataFrame, max_gap_s: float = 5.0) -> DataFrame:
    return found_turns(segments, speaker_names, max_gap_s, keep_text=True)
