import random

import pytest

from parlance.llm import events, turns
from parlance.operators.segments import cluster_names, numbered
from pyspark.sql import functions as F
from tests.conftest import NAMES, SEGMENTS, rows


def runs_of(items, gap=5.0):
    """items: (start, pos, end, speaker) of one session."""
    out = []
    for s, p, e, who in sorted(items):
        if out and out[-1]["who"] == who and s - out[-1]["end"] <= gap:
            out[-1].update(end=e, last=p, n=out[-1]["n"] + 1, late=max(out[-1]["late"], e))
        else:
            out.append({"who": who, "first": p, "last": p, "n": 1, "s": s, "end": e, "late": e})
    return out


@pytest.mark.parametrize("partitions", [1, 6])
def test_runs_against_plain(spark, partitions):
    r = random.Random(2)
    data, labels = [], ["SPEAKER_1", "speaker 01", "[Speaker_2]", None, "", "spk_2"]
    of = dict(zip(labels, ["SPEAKER_01", "SPEAKER_01", "SPEAKER_02", "UNKNOWN", "UNKNOWN", "SPEAKER_02"]))
    for i in range(300):
        a = r.randint(0, 3000) / 8
        data.append((i, r.choice(["a", "b", "b", "b"]), i, a, a + r.randint(1, 40) / 8, r.choice(labels), "x"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = rows(events.found_runs(spark.createDataFrame(data, SEGMENTS), spark.createDataFrame([], NAMES)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 5)
    want = [(s, x["first"], x["last"], x["n"], round(1000 * (x["late"] - x["s"]))) for s in ("a", "b") for x in runs_of([(d[3], d[2], d[4], of[d[5]]) for d in data if d[1] == s]) if x["n"] > 1]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize(("label", "want"), [("SPEAKER-0", "SPEAKER_00"), (" Speaker_07 ", "SPEAKER_07"), ("spk12:", "SPEAKER_12"), ("[SPEAKER_100]", "SPEAKER_100"), ("", "UNKNOWN"), (None, "UNKNOWN"), ("June Moss", None), ("Speakerine 4b", None)])
def test_numbered(spark, label, want):
    assert spark.createDataFrame([(label,)], "l string").select(numbered(F.col("l"))).first()[0] == want


def test_clusters():
    labels = ["June Sarnel", "june  sarnel", "Sarnel, June", "J. Sarnel", "June Sarnel (chair)", "June Sarneel", "R. Varn", "Rose Varn", "Rolf Varn", "Odd One", "ODD ONE", "Solo"]
    known = ["SPEAKER_03"] + [None] * 6 + ["SPEAKER_01", "SPEAKER_02"] + [None] * 3
    got = dict(zip(labels, cluster_names(labels, known)))
    assert {got[x] for x in labels[:6]} == {"SPEAKER_03"}
    assert got["R. Varn"] == "R. Varn" and got["Rose Varn"] == "SPEAKER_01" and got["Rolf Varn"] == "SPEAKER_02"
    assert got["Odd One"] == got["ODD ONE"] and got["Solo"] == "Solo"


def test_many_names_of_one_block():
    """Names that differ by a letter meet as all pairs would, without making them."""
    from parlance.operators.segments import alike, shortened

    r = random.Random(4)
    words = ["".join(r.choices("abc", k=r.choice([5, 6, 7, 8, 13, 14, 15]))) for _ in range(250)]
    words += [w[:3] + r.choice(["", "b"]) + w[4:] for w in words[:120]]
    for a in words:
        for b in words:
            if alike(a, b):
                assert shortened(a) & shortened(b)
    many = [f"Corinna Vel{i:05d}moor" for i in range(0, 30000, 7)]
    assert len(set(cluster_names(many, [None] * len(many)))) < len(many)


CASES = [
    ("en", "[00:01:02] SPEAKER_00: Um, we meet at 14:30 [laughs] (second draft), you know, um uh today", "we meet at 14:30 (second draft) today"),
    ("en", ">> Speaker 3: uh... kind of nice", "kind of nice"),
    ("en", "00:01:02,003 --> 00:01:05,100 ♪ music ♪ so, Um, you know, fine", "so, fine"),
    ("en", "SPEAKER 04 - [inaudible 00:01:02]", ""),
    ("de", "Ähm, er kommt um drei, sozusagen, an", "er kommt um drei an"),
    ("fr", "euh Le projet, tu vois, est simple", "Le projet est simple"),
    ("es", "eh El plan, o sea, está listo", "El plan está listo"),
]


@pytest.mark.parametrize(("lang", "text", "want"), CASES)
def test_clean(spark, lang, text, want):
    assert spark.createDataFrame([(text, lang)], "t string, l string").select(turns.clean_text(F.col("t"), F.col("l"))).first()[0] == want


def test_turns(spark):
    data = [(1, "s", 0, 0.0, 1.0, None, "[SPEAKER_02] the plan is"), (2, "s", 1, 1.0, 2.0, "x", "[music]"), (3, "s", 2, 6.0, 9.0, "Speaker 2", "um fine and good"), (4, "s", 3, 6.5, 8.0, "spk_02", "yes"), (5, "s", 4, 13.5, 14.0, "SPEAKER_2", "later"), (6, "s", 5, 14.0, 15.0, None, None), (7, "s", 5, 1.0, 2.0, "A", "ignored")]
    d = spark.createDataFrame(data, SEGMENTS)
    none = spark.createDataFrame([], NAMES)
    got = rows(turns.found_turns(d, none))
    assert got == [("s", 0, "SPEAKER_02", 0, 8000, 7), ("s", 4, "SPEAKER_02", 13500, 14000, 1)]
    assert [r.text for r in turns.turns_with_text(d, none).orderBy("first_pos").collect()] == ["the plan is fine and good yes", "later"]


def test_empty_and_nulls(spark):
    none = spark.createDataFrame([], NAMES)
    for make in (events.found_runs, turns.found_turns, turns.turns_with_text):
        assert rows(make(spark.createDataFrame([], SEGMENTS), none)) == []
        make(spark.createDataFrame([(None,) * 7, (1, None, None, 0.0, 1.0, "Ann Lee", "a" * 100_000), (1, None, None, 0.0, 1.0, "Ann Lee", "hi")], SEGMENTS), spark.createDataFrame([(None, None, None), (None, "SPEAKER_1", "Ann Lee"), ("s", None, "")], NAMES)).collect()
    clash = spark.createDataFrame([(1, "s", 1, 0.0, 1.0, "A", "hi there", "z", 3)], SEGMENTS + ", label string, n int")
    assert rows(turns.found_turns(clash, none))[0][-1] == 2


def test_turn_over_many_ranges(spark):
    data = [(i, "s", i, float(i), i + 1.0, "SPEAKER_0", f"the word{i}") for i in range(400)]
    got = turns.turns_with_text(spark.createDataFrame(data, SEGMENTS), spark.createDataFrame([], NAMES)).collect()
    assert len(got) == 1 and got[0].text == " ".join(f"the word{i}" for i in range(400)) and got[0].n_words == 800
