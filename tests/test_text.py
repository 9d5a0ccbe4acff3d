import pytest
from pyspark.sql import functions as F

from parlance.config import ChunkConfig, ModelConfig, require
from parlance.functions import text as X


def value(spark, make, **given):
    d = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in given.items()))
    return d.select(make(*[F.col(k) for k in given])).first()[0]


@pytest.mark.parametrize(("t", "n"), [("foo--bar, (baz)!", 2), ("--", 0), ("don't stop", 2), ("[SPEAKER_00] hi", 2), ("a\u00a0b\u2003c\u0085d", 4), ("½ ² _", 3), ("", 0), (None, 0)])
def test_count_words(spark, t, n):
    assert value(spark, X.count_words, t=t) == n


@pytest.mark.parametrize(("t", "s"), [("straße", "strae"), ("½", "12"), ("!!!", "lesson"), ("Übung: Café", "ubung-cafe"), ("a" * 79 + " b", "a" * 79 + "-"), (None, "lesson")])
def test_session_slug(spark, t, s):
    assert value(spark, X.session_slug, t=t) == s


@pytest.mark.parametrize(("t", "s"), [("SPEAKER_00 -> SPEAKER_01", "speaker-00-speaker-01"), ("é", "chunk"), ("", "chunk"), ("x" * 60, "x" * 50)])
def test_slug(spark, t, s):
    assert value(spark, X.slug, t=t) == s


def test_clock_and_ids(spark):
    assert value(spark, X.clock, s=3661.9) == "01:01:01"
    assert value(spark, X.clock, s=360000.0) == "100:00:00"
    assert value(spark, X.padded_id, s=7.0) == "007"
    assert value(spark, X.padded_id, s=1234.0) == "1234"


def test_template_is_one_pass(spark):
    make = lambda a: X.template("{a} {unknown} {a}", a=a)
    assert value(spark, make, a="{unknown} {a}") == "{unknown} {a} {unknown} {unknown} {a}"
    assert value(spark, make, a=None) == " {unknown} "


def test_paths_urls_json_and_secrets(spark):
    assert value(spark, X.stem, p="/a/b.c/d.tar.gz") == "d.tar"
    assert value(spark, X.base_name, p="/a/b/") == "b"
    assert value(spark, lambda p: X.with_suffix(p, ".metadata.json"), p="/a.b/c.wav") == "/a.b/c.metadata.json"
    assert value(spark, X.trim_slashes, u="http://x//") == "http://x"
    assert value(spark, X.parsed_json, j='{"a": 1}') == '{"a": 1}'
    assert value(spark, X.parsed_json, j="{broken") == '{"raw":"{broken"}'
    assert value(spark, X.redacted, c="run --hf_token abc --x 1") == "run --hf_token [REDACTED] --x 1"
    assert value(spark, X.strip, t="\u2003 a b\x85") == "a b"


def test_configuration():
    assert ChunkConfig.from_env({"PARLANCE_MAX_WORDS": "1500", "PARLANCE_TARGET_WORDS": " "}).max_words == 1500
    assert ModelConfig.from_env({"PARLANCE_MODEL_NUM_CTX": "16384"}).num_ctx == 16384
    with pytest.raises(ValueError):
        ChunkConfig(target_words=10, max_words=5)
    with pytest.raises(ValueError, match="token"):
        require(path="x", token=" ")
