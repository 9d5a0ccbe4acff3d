import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parlance.llm import packing, splitting
from parlance.llm.limits import limit
from tests.conftest import CHUNKS, rows


def first_fit(sizes, capacity):
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        k = next((k for k, room in enumerate(bins) if room >= sizes[i]), len(bins))
        if k == len(bins):
            bins.append(capacity)
        bins[k] -= sizes[i]
        out[i] = k
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60))
def test_tree_is_first_fit(sizes):
    assert packing.first_fit_decreasing(sizes, 50) == first_fit(sizes, 50)


@pytest.mark.parametrize("group", [4096, 266, 265, 40])
def test_packing(spark, group):
    r = random.Random(4)
    data = [("hot" if i % 3 else None if i % 2 else "b", i, "A -> B", 7, " ".join(["w"] * r.randint(0, 130))) for i in range(400)]
    d = spark.createDataFrame(data + data[:20], CHUNKS)
    placed = packing.pack_chunks(d, 100, group).collect()
    words = {}
    for p in placed:
        words.setdefault((p.session_id, p.container_no), []).append(p.words)
    assert all(sum(w) <= 100 for w in words.values())
    assert sum(map(sum, words.values())) == sum(len(x[4].split()) for x in data)
    by = {}
    for p in placed:
        by.setdefault((p.session_id, p.chunk_id), []).append(p.words)
    for s, i, _, _, t in data:
        n = len(t.split())
        assert sorted(by[s, i], reverse=True) == ([n] if n <= 100 else [100, n - 100])
    for s in ("hot", "b", None):
        mine = [sum(w) for k, w in words.items() if k[0] == s]
        assert len(mine) <= 11 / 9 * sum(mine) / 100 + 6 * (-(-400 // group))
    c = packing.containers(spark.createDataFrame(placed, packing.PLACED), 100).collect()
    assert len(c) == len(words) and all(0 <= x.fill <= 1 for x in c)


def test_packing_edges(spark):
    assert rows(packing.pack_chunks(spark.createDataFrame([], CHUNKS), 10)) == []
    d = spark.createDataFrame([("s", 1, None, 5, None), ("s", 2, "A", None, None), ("s", 3, "A -> B", -4, None), (None, None, None, None, ""), ("s", 4, "B -> C", 1, "a b c")], CHUNKS)
    got = {r.chunk_id: r.words for r in packing.pack_chunks(d, 10).collect()}
    assert got == {1: 5, 2: 0, 3: 0, None: 0, 4: 3}
    one = {(r.session_id): r.speaker_span for r in packing.containers(packing.pack_chunks(d, 10), 10).collect()}
    assert one["s"] == "A -> B -> C"
    with pytest.raises(ValueError):
        packing.pack_chunks(d, 0)


WORDS = st.text(alphabet="ab .\n!?…-\t ", max_size=400)


@settings(max_examples=200, deadline=None)
@given(WORDS, st.integers(2, 12), st.data())
def test_split_round_trip(text, most, data):
    overlap = data.draw(st.integers(0, most - 1))
    pieces = splitting.split_text(text, most, overlap)
    words = splitting.WORD.findall(text)
    assert sum(n - o for n, o, _, _ in pieces) == len(words)
    if len(words) > most:
        assert all(n <= most for n, _, _, _ in pieces)
        assert all(o == min(overlap, i) for (_, o, _, _), i in zip(pieces, [sum(n - p for n, p, _, _ in pieces[:k]) for k in range(len(pieces))]))
    whole = pieces[0][3]
    for n, o, _, t in pieces[1:]:
        assert splitting.WORD.findall(t)[:o] == splitting.WORD.findall(whole)[-o:] if o else True
        found = list(splitting.WORD.finditer(t))
        whole += t[found[o].start() :]
    assert whole == text


def test_split_prefers_lines(spark):
    text = "a b c d.\n" * 3 + "e f g h. i j k l"
    pieces = splitting.split_text(text, 10, 0)
    assert [k for _, _, k, _ in pieces][1:] == ["line"] * (len(pieces) - 1)


def test_found_cut(spark):
    d = spark.createDataFrame([("s", 1, None, 0, "w " * 9), ("s", 2, None, 0, "w w w w.\nw w w w w w"), ("s", 3, None, 0, "w " * 11), ("s", 3, None, 0, "w " * 11), ("s", 4, None, 0, None), (None, None, None, None, "w. " * 12)], CHUNKS)
    assert rows(splitting.found_oversized(d, 9, 2)) == sorted([("s", 2, "soft"), ("s", 3, "hard"), (None, None, "soft")], key=repr)
    assert rows(splitting.split_oversized(spark.createDataFrame([], CHUNKS), 9, 2)) == []
    long = spark.createDataFrame([("s", 1, None, 0, "word " * 200_000)], CHUNKS)
    assert splitting.split_oversized(long, 220, 20).count() >= 1000
    with pytest.raises(ValueError):
        splitting.split_oversized(d, 9, 9)


def test_limits(spark):
    d = spark.createDataFrame([("split", 220, 20), ("container", 1000, None)], "purpose string, max_words bigint, overlap_words bigint")
    assert limit(d, "split") == (220, 20) and limit(d, "container") == (1000, 0)
    with pytest.raises(ValueError):
        limit(d, "other")
