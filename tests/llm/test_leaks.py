import random

import numpy as np

from parlance.llm import leaks
from tests.conftest import rows

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
WORDS = "alpha beta gamma delta roster pump cable memo draft index a b é ñandú x1 42".split()


def plain(docs, items, n=12):
    grams = lambda t: {tuple(w[i : i + n]) for w in [leaks.normalized(t).split()] for i in range(len(w) - n + 1)}
    known = {i: grams(t) for i, t in items}
    return sorted({(d, i) for d, t in docs for i, g in known.items() if g & grams(t)}, key=repr)


def corpus(seed=1):
    r = random.Random(seed)
    items = [(i, " ".join(r.choices(WORDS, k=r.randint(5, 40)))) for i in range(30)]
    docs = []
    for d in range(200):
        body = r.choices(WORDS, k=r.randint(0, 80))
        if d % 3 == 0:
            w = items[r.randrange(30)][1].split()
            a = r.randint(0, max(0, len(w) - 10))
            body[len(body) // 2 : len(body) // 2] = w[a : a + r.randint(10, 14)]
        docs.append((d, r.choice([" ", ", ", "\n", " - "]).join(body) if d % 5 else " ".join(body).upper()))
    return docs, items


def test_against_plain(spark):
    docs, items = corpus()
    got = rows(leaks.found_leaks(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)))
    assert got == plain(docs, items) and got


def test_shortest_words_and_blocks(spark):
    one = "a b c d e f g h i j k l"
    docs, items = [(1, "z " * 40 + one + " z" * 40), (2, one[:-2]), (3, None), (4, ""), (5, "long " * 300_000 + one)], [(1, one), (2, "other words " * 9), (3, None), (4, ""), (None, one), (6, one)]
    make = lambda size: rows(leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_bytes=size).where("n_words > 0").select("doc_id", "item_id"))
    assert make(1 << 20) == make(30) == [(1, 1), (1, 6), (5, 1), (5, 6)]
    assert rows(leaks.found_leaks(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS))) == []
    assert rows(leaks.found_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS))) == []


def test_small_edits_are_regions(spark):
    r = random.Random(8)
    item = " ".join("".join(r.choices("abcdefghijklmnop", k=7)) for _ in range(40))
    worn = list(item)
    for k in (40, 95, 150, 210, 260, 300):
        worn[k] = "z"
    del worn[120]
    docs = [(1, "before " * 20 + "".join(worn) + " after" * 20), (2, "nothing of it " * 30)]
    got = leaks.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(7, item)], ITEMS)).collect()
    assert [(g.doc_id, g.item_id) for g in got] == [(1, 7)]
    assert got[0].n_chars > 250 and got[0].n_edits <= 8


def worn(r, text, rate):
    """The text with so many changed, lost and added bytes a byte."""
    out = []
    for c in text:
        x = r.random()
        out += [c] if x > rate else ["z"] if x > 2 / 3 * rate else [] if x > rate / 3 else [c, "z"]
    return "".join(out)


def test_recall_of_edited_passages():
    """Passages of 60 to 400 bytes with up to 4 % of edits, within other text, whole short items among them."""
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwy", k=r.randint(2, 9)))
    items = [(i, " ".join(word() for _ in range(r.choice([6, 8, 15, 60, 90])))) for i in range(60)]
    index = leaks.Index(items, 12)
    texts, want = [], []
    for _ in range(400):
        k = r.randrange(len(items))
        whole = items[k][1]
        size = min(len(whole), r.randint(60, 400))
        a = r.randint(0, len(whole) - size)
        texts.append(" ".join(word() for _ in range(30)) + " " + worn(r, whole[a : a + size], r.choice([0.01, 0.02, 0.03, 0.04])) + " " + " ".join(word() for _ in range(30)))
        want.append(k)
    got = {(d, i) for d, i, *_ in leaks.regions(index, list(range(400)), texts, 0.05)}
    assert sum((d, k) in got for d, k in enumerate(want)) >= 0.9 * 400
    assert sum(k != want[d] for d, k in got) <= 4


def test_long_items(spark):
    """Runs of twelve words anywhere in an item of many pieces are found, in a long document too."""
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwy", k=r.randint(2, 9)))
    words = [word() for _ in range(4000)]
    assert [w for k, p in enumerate(leaks.pieces(" ".join(words), 64)) for w in p.split(" ")[64 * (k > 0) :]] == words
    docs = [(i, " ".join([word() for _ in range(300 if i else 30_000)] + words[a : a + 12] + [word() for _ in range(20)])) for i, a in enumerate(range(0, 3988, 311))]
    docs += [(99, " ".join(words[5:16]))]
    got = leaks.found_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, " ".join(words)), (2, "x" * 9000)], ITEMS))
    assert rows(got) == sorted([(i, 1) for i in range(13)], key=repr)


def test_size_of_the_index():
    r = random.Random(2)
    items = [(i, " ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(300))) for i in range(400)]
    index = leaks.Index(items, 12)
    held = sum(x.nbytes for x in (index.grams, index.first, index.items, index.places)) + index.seen.nbytes
    assert held < 24 * sum(len(t) for _, t in items) + (1 << 23)


def test_slices_lose_nothing(monkeypatch):
    docs, items = corpus(3)
    index = leaks.Index([(i, leaks.normalized(t)) for i, t in items], 12)
    text = leaks.normalized(" zz ".join(t for _, t in docs))
    whole = leaks.candidates(index, [text, text])
    monkeypatch.setattr(leaks, "HITS", 1500)
    assert leaks.candidates(index, [text, text]) == whole and whole


def test_windows_and_alignment():
    data = np.frombuffer(b"abcdefghij", np.uint8)
    assert [int(x).to_bytes(8, "little") for x in leaks.windows(data)] == [b"abcdefgh", b"bcdefghi", b"cdefghij"]
    assert leaks.aligned([b"xx the quick brown fox jumps over", b"the quick brwn foxx jumps"], [b"the quick brown fox jumps", b"zz the quick brown fox jumps"], [0, -32]) == [(25, 0), (25, 2)]
