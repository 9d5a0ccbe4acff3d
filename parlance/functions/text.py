"""Scalar functions on text, as Column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Every character that counts as white space, as in Unicode and Python's str.split().
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same as a class of Java's regular expressions.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Of text with only blanks as white space: what a stretch has from its first letter, digit or underscore on, one
#: match a word. A class of every white-space character takes many times as long to match.
WORD = r"[\p{L}\p{N}_]\S*"


def spaced(text: Column) -> Column:
    """Every white-space character as U+0020."""
    return F.translate(text, WHITE, " " * len(WHITE))


def strip(text: Column) -> Column:
    """Both ends without any white space; null stays null."""
    return F.regexp_replace(text, rf"^{WS}+|{WS}+$", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, rf"{WS}+$", "")


def tokens(text: Column) -> Column:
    """Stretches without white space, in order; an array, empty for blank text."""
    return F.filter(F.split(spaced(text), " +"), lambda t: t != "")


def count_words(text: Column) -> Column:
    """Stretches with at least one word character, as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(spaced(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column | str) -> Column:
    """The first value that is neither null nor empty; strings are literals."""
    return F.coalesce(*[F.lit(v) if isinstance(v, str) else blank_to_null(v) for v in values])


def slug(text: Column, size: int = 50, default: str = "chunk") -> Column:
    """ASCII letters and digits in lower case, everything else as single hyphens, no accent folding, cut at size."""
    made = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.left(first_filled(made, default), F.lit(size))


@F.pandas_udf(T.StringType())
def ascii_folded(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without any non-ASCII character. Spark has no built-in for it."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def session_slug(text: Column, size: int = 80, default: str = "lesson") -> Column:
    """As slug, but accents are folded first and the cut may leave a hyphen at the end.

    Of plain ASCII text, the usual case, Python sees nulls only.
    """
    plain = F.octet_length(text) == F.length(text)
    folded = F.when(plain, text).otherwise(ascii_folded(F.when(~plain, text)))
    made = F.regexp_replace(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return first_filled(F.left(made, F.lit(size)), default)


def session_id(started: Column, of_slug: Column) -> Column:
    return F.concat(F.date_format(started, "yyyy-MM-dd'T'HH-mm-ss'Z'"), F.lit("-"), of_slug)


def clock(seconds: Column) -> Column:
    """HH:MM:SS of whole seconds, cut and not rounded; hours may pass 99."""
    s = seconds.cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def padded_id(number: Column) -> Column:
    return F.format_string("%03d", number.cast("bigint"))


def stamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd-HHmmss")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """The base name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]*$", "")


def with_suffix(path: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(path, r"(?<=[^./])\.[^./]*$", ""), F.lit(suffix))


def trim_slashes(url: Column) -> Column:
    return F.regexp_replace(url, "/+$", "")


def parsed_json(text: Column) -> Column:
    """The JSON text as it is; text that is no JSON as {"raw": text}; null stays null."""
    return F.when(text.isNull() | F.try_parse_json(text).isNotNull(), text).otherwise(F.to_json(F.struct(text.alias("raw"))))


def redacted(command: Column, option: str = "--hf_token") -> Column:
    """The command with the value after the option replaced, whether joined by a space or an equals sign."""
    return F.regexp_replace(command, rf"({re.escape(option)}[ =]+)[^ ]+", "$1[REDACTED]")


def template(text: str, **values: Column) -> Column:
    """The template with each {name} replaced by its column.

    One pass on the driver: names that aren't given stay as they stand, and what is inserted isn't looked
    through again. A null value becomes an empty string.
    """
    parts: list[Column] = []
    for k, piece in enumerate(re.split(r"\{(\w+)\}", text)):
        if k % 2 == 0:
            parts += [F.lit(piece)] if piece else []
        else:
            parts.append(F.coalesce(values[piece].cast("string"), F.lit("")) if piece in values else F.lit("{" + piece + "}"))
    return F.concat(*parts) if parts else F.lit("")
