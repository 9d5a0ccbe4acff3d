import pytest

from parlance.llm import pairs
from tests.conftest import CHUNKS, rows
from tests.llm.refusals import REFUSED, SOUND

TEXT = "[SPEAKER_00] We said on Monday that the roster would be quiet by then and that the pump is fine.\n[SPEAKER_01] Could planning tell us whether the draft is final or whether it was moved to the next week?"
GERMAN = "Der Bericht und der Vertrag wurden am Freitag besprochen. Zum Antrag bleibt noch eine Frage."
FULL = "## A\n- The roster was looked at again.\n\n## B\n- Nothing noted.\n\n## C\n- The draft is with us.\n\n## D\n- More work is needed on the pump."

CASES = [
    (FULL, []), ("The roster was looked at again. Nobody was sorry that they cannot help the vendor.", []),
    (None, ["empty"]), ("  \n", ["empty"]), ("N/A", ["empty"]), ("```\n```", ["empty"]), ("## A\n\n## B\n-", ["empty"]), ("\u200b", ["empty"]), ("(empty)", ["empty"]), ("Here is the summary.", ["empty"]),
    ("I’m sorry, but I can’t help with that conversation.", ["refusal"]), ("Lo siento, pero no puedo resumir esta conversación.", ["refusal"]), ("Es tut mir leid, das geht nicht.", ["refusal"]), ("Je ne suis pas en mesure de traiter ce texte.", ["refusal"]), ("No transcript seems to have been attached. Could you paste the text again?", ["refusal"]),
    (FULL[:-12], ["truncated"]), ("The roster was looked at again. The draft", ["truncated"]), ("The roster (and the pump was looked at again.", ["truncated"]), ("The draft was moved to\n```", ["truncated"]),
    (TEXT.replace("[SPEAKER_00] ", ""), ["copy"]), ("One speaker said: Could planning tell us whether the draft is final or whether it was moved to the next week? The roster was looked at again and the group agreed that more work is needed on the pump.", []),
    (GERMAN, ["language"]), ("Доклад был рассмотрен, и группа решила вернуться к нему.", ["language"]), ('The term "Zeitplan" came up twice as a label. The roster is with us.', []),
]


@pytest.mark.parametrize(("answer", "want"), CASES)
def test_defects(answer, want):
    got = pairs.defects_of(answer, TEXT)
    assert got == want or (want and got[0] == want[0])
    if not want or want == ["truncated"]:
        assert got == want


def test_reworded_refusals():
    found = [pairs.refuses(pairs.parts_of(t)[1]) for t in REFUSED]
    print([t for t, f in zip(REFUSED, found) if not f])
    assert len(REFUSED) >= 60 and sum(found) >= 0.9 * len(REFUSED)
    assert [t for t in SOUND if pairs.refuses(pairs.parts_of(t)[1])] == []


SOUND_SECTIONS = [
    "# Overview\nThe roster was looked at again and the pump is fine.", "# Overview\nThe pump is fine.\n\n# Next steps\nPlanning will look at the draft.",
    "# Points\nThe pump is fine.\n\n# Steps\nThey wait.\n\n# Rest\nNothing is left to do.", "Points that came up:\n- the roster\n- the pump\n- the draft for planning",
]


@pytest.mark.parametrize("answer", SOUND_SECTIONS)
def test_sound_sections(answer):
    assert pairs.defects_of(answer, TEXT, frozenset({"other"})) == []


def test_other_languages():
    for answer in ("De groep heeft het rooster bekeken en er is nog een vraag over de pomp.", "Il gruppo ha rivisto il piano e resta ancora una domanda sulla pompa.", "O grupo já viu o plano e ainda há uma pergunta sobre a bomba."):
        assert pairs.defects_of(answer, TEXT) == ["language"]


def test_sections_that_are_missing(spark):
    whole = "## A\n- One thing.\n\n## B\n- Another thing."
    answers = spark.createDataFrame([("s", i, whole) for i in range(20)] + [("s", 20, "## A\n- One thing."), ("s", 21, "## C\n- One thing."), ("s", 22, None)], "session_id string, chunk_id bigint, summary string")
    assert pairs.sections_that_go_on(answers) == {"a"}
    chunks = spark.createDataFrame([("s", i, None, 0, TEXT) for i in range(22)], CHUNKS)
    assert rows(pairs.found_defects(chunks, answers)) == [("s", 20, "truncated")]


def test_rare_and_late_sections(spark):
    """Sections that one answer in 500 or fewer has, and those after the sixteenth, are missed like any others."""
    rare, late = ["## A\n- One thing.", "## B\n- Another thing."], [f"## S{i}\n- One thing." for i in range(20)]
    answers = [rare] * 8 + [rare[:1]] + [late] * 8 + [late[:16], late[:17], late[:19]]
    few = spark.createDataFrame([("s", i, "\n\n".join(a)) for i, a in enumerate(answers)], "session_id string, chunk_id bigint, summary string")
    table = few.union(spark.range(100, 5100).selectExpr("'s'", "id", "'It went well.'"))
    assert pairs.sections_that_go_on(table) == {"a"} | {f"s{i}" for i in range(19)}
    chunks = spark.createDataFrame([("s", i, None, 0, TEXT) for i in range(200)], CHUNKS)
    assert rows(pairs.found_defects(chunks, table)) == sorted([("s", i, "truncated") for i in (8, 17, 18, 19)], key=repr)


def test_table(spark):
    kind = "session_id string, chunk_id bigint, summary string"
    chunks = spark.createDataFrame([("s", i, None, 0, TEXT) for i in range(4)] + [("s", 0, None, 0, TEXT), (None, None, None, None, None), ("s", 9, None, 0, "")], CHUNKS)
    answers = spark.createDataFrame([("s", 0, "null"), ("s", 0, "null"), ("s", 1, FULL), ("s", 2, None), ("other", 1, ""), (None, None, "x" * 50_000), ("s", 9, "Fine.")], kind)
    assert rows(pairs.found_defects(chunks, answers)) == sorted([("s", 0, "empty"), ("s", 2, "empty"), (None, None, "truncated")], key=repr)
    assert rows(pairs.found_defects(spark.createDataFrame([], CHUNKS), spark.createDataFrame([], kind))) == []
    assert pairs.pair_defects(chunks.withColumnRenamed("word_count", "summary"), answers.selectExpr("*", "'z' AS text", "1 AS s")).count() == 5
