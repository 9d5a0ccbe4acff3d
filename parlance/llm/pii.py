"""Problem 7: personal data in free text, by a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import functools
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.pii_table import CALENDAR, COMMON_GIVEN, MARKED, PLACE_WORDS, STREET_ENDS, STREET_WORDS, TITLES, UNMARKED, Filler
from parlance.llm.turns import HESITATIONS, PHRASES
from parlance.operators.segments import LAST, delivered_once

#: Labels; the first stands for everything else.
LABELS = ("other", "email", "phone", "id_number", "address", "name")
SLOTS = {"email": 1, "phone": 2, "id": 3, "address": 4, "foreign": 4, "name": 5, "given": 5, "titled": 5, "reversed": 5, "initial": 5, "label": 5, "spelled": 1}
#: A plain word; an address of mail; a time of day; digits in groups, perhaps with a plus or in brackets; any other
#: word; an empty phrase set off by commas; any other sign. Each is one token, so that a number is judged by its whole form.
TOKEN = re.compile(r"[^\W\d_]++(?![\w.+\-@])|\w++(?:[.+\-]\w++)*+@\w++(?:[.\-]\w++)*\.[^\W\d_]{2,}+|\d++(?::\d\d)++(?:[.,]\d++)?+|\(?(?:\+\d{1,3}\)?[ \-]?)?\(?\d++(?:\)[ \-]?\d++|(?: +|[.\-/,])\d++)*+(?!\w)|\w++|,\s*+(?i:" + "|".join(p.replace(" ", r"\s+") for p in PHRASES.values()) + r")\s*+,|[^\w\s]")
#: Stands between texts; a token of its own that is never personal.
BORDER = "\x01"
REACH = 2
STOPS = (",", ".", "…")
_NUMBER_WORDS = frozenset("zero oh one two three four five six seven eight nine".split())
_COMMON = frozenset(x.lower() for x in COMMON_GIVEN)
_TITLES = frozenset(TITLES)
#: Small words of the language that writes every noun with a capital, so that an unknown capital tells less there.
_GERMAN = frozenset("der die das den dem des ein eine einen einer im am zum zur und ist sind hat haben wird wir ich nicht bitte für mit von vom aus bei nach seit auf".split())
#: The words the sentences of the table are made of; any other word is new to the field.
_PLAIN = frozenset(w.lower() for row in (*MARKED, *UNMARKED) for w in re.findall(r"[^\W\d_]+", re.sub(r"\{\w+\}", " ", row)))
HESITATION = re.compile("|".join(HESITATIONS.values()))
_FILLERS = ["um", "uh", "äh", "Um,", "Uh,", "um,", "Euh,", "Hmm...", "uh...", ", you know,", ", sort of,"]


def form_of(token: str) -> str:
    """What counts of a token: words as they are, addresses of mail by that alone, of others with digits each
    digit as 9, but a 0 or 1 at the start."""
    if token.isalpha():
        return token
    if "@" in token and len(token) > 1:
        return "\x02mail"
    if any(c.isdigit() for c in token):
        lead = next(c for c in token if c.isdigit())
        return "\x02" + (lead if lead in "01" else "9") + re.sub(r"[^\W\d_]", lambda m: "X" if m[0].isupper() else "x", re.sub(r"\d", "9", token))
    return token


def fills(form: str) -> bool:
    """Whether a token is a hesitation or an empty phrase: nothing that was said."""
    return form[0] == "," and len(form) > 1 or form.isalpha() and HESITATION.fullmatch(form.lower()) is not None


def unfilled(tokens: list[str]) -> list[int]:
    """The places of tokens that were said: no fillers, and none of the three stops at most that follow one."""
    kept, after = [], 4
    for i, t in enumerate(tokens):
        after = 0 if fills(form_of(t)) else after + 1 if t in STOPS else 4
        if after > 3:
            kept.append(i)
    return kept


def shape(token: str) -> str:
    """Letters by case, other signs as they are."""
    if token.isalpha():
        return "x" if token.islower() else "X" if len(token) == 1 else f"XX{min(len(token), 4)}" if token.isupper() else "Xx"
    return re.sub(r"(.)\1+", r"\1", token)


class Features:
    """The names of what is seen of one token; those of its neighbours are the same with their distance."""

    def __init__(self, given: frozenset[str], family: frozenset[str]):
        self.given, self.family = given, family
        self.names = given | family | _COMMON

    def __call__(self, form: str) -> list[str]:
        if form == "\x02mail":
            return ["s=mail"]
        if form[0] == "\x02":
            lead, body = form[1], form[2:]
            n, letters = body.count("9"), re.sub(r"[^Xx]", "", body)[:2]
            if ":" in body:
                return ["s=clock"]
            signs = "".join(sorted(set(body) - set("9Xx")))
            body = re.sub(r" +", " ", body)
            groups = re.sub(r"9+", lambda m: str(min(len(m[0]), 9)), body)
            return ["s=number", f"n={min(n, 15)}", f"n={min(n, 15)}{signs}{letters}", "g=" + groups, "d=" + signs + letters, "l=" + lead + letters, f"r={'small' if n < 4 else 'zip' if n < 6 else 'long'}{letters}"]
        low, looks = form.lower(), shape(form)
        out = ["s=" + looks, "w=" + low]
        if len(low) > 4 and form.isalpha():
            out += ["3=" + low[-3:], "4=" + low[-4:]]
        known = ("g" if low in self.given else "") + ("f" if low in self.family else "") + ("c" if low in _COMMON else "")
        if known:
            out += ["k=" + known, "k=" + known + looks]
        elif low not in _PLAIN:
            out += ["novel", "novel" + looks]
        for name, words in (("number", _NUMBER_WORDS), ("title", _TITLES), ("calendar", CALENDAR), ("street", STREET_WORDS), ("place", PLACE_WORDS)):
            if low in words:
                out += [name, name + looks]
        if len(low) > 5 and low.endswith(STREET_ENDS):
            out += ["streetend", "streetend" + looks]
        return out


class Model:
    """Weights of a trained field. The score of a token is a sum over it and its neighbours within REACH, so
    for each distinct token one vector per distance is kept. lean is what a capitalised word that is
    new to the field gains as a name: a name missed costs more than a word marked too much."""

    def __init__(self, features: Features, names: dict[str, int], weights: np.ndarray, transitions: np.ndarray, lean: float = 0.5):
        self.features, self.names, self.weights, self.transitions, self.lean = features, names, weights, transitions, lean
        self.cache: dict[str, int] = {}
        self.vectors = np.zeros((1024, 2 * REACH + 1, len(LABELS)), np.float32)
        self.filler = np.zeros(1024, bool)
        t = transitions
        # what a label gains over `other` by the step to it and from it, at most, for each set of labels, as bits,
        # that its neighbour may have
        sets = (np.arange(1 << len(LABELS))[:, None] >> np.arange(len(LABELS))) & 1 > 0
        best = lambda gain: np.where(sets[:, :, None], gain[None], -np.inf).max(1).astype(np.float32)
        with np.errstate(invalid="ignore"):
            self.before, self.after = best(t - t[:, :1]), best((t - t[:1]).T)
        self.before[0] = self.after[0] = 0

    def __getstate__(self):
        return self.features, self.names, self.weights, self.transitions, self.lean

    def __setstate__(self, state):
        self.__init__(*state)

    def number(self, token: str) -> int:
        """The place of a token's vectors; tokens of one form share it, and only words are kept as they are."""
        key = form_of(token)
        at = self.cache.get(key)
        if at is None:
            at = len(self.cache)
            if at == len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                self.filler = np.concatenate([self.filler, np.zeros_like(self.filler)])
            self.filler[at] = fills(key)
            for d in range(-REACH, REACH + 1):
                rows = [self.names[n] for f in self.features(key) if (n := f"{d}{f}") in self.names]
                self.vectors[at, d + REACH] = self.weights[rows].sum(0) if rows else 0
            if key.isalpha() and shape(key) == "Xx" and key.lower() not in _PLAIN and key.lower() not in CALENDAR:
                self.vectors[at, REACH, LABELS.index("name")] += self.lean
            self.cache[key] = at
        return at

    def numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self.cache) > 400_000:
            self.cache.clear()
        get, number = self.cache.get, self.number
        return np.array([i if (i := get(t)) is not None else number(t) for t in tokens], np.int64)

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        scores = np.zeros((len(ids), len(LABELS)), np.float32)
        border = ids == self.number(BORDER)
        for d in range(-REACH, REACH + 1):
            # the vector of distance d holds what a token says of the one d places after it, unless a border
            # lies between
            part = self.vectors[:, d + REACH]
            n = len(ids) - abs(d)
            if n <= 0:
                continue
            source = slice(0, n) if d > 0 else slice(-d, None)
            target = slice(d, None) if d > 0 else slice(0, n)
            said = part[ids[source]]
            for k in range(1, abs(d)):
                said[border[k : k + n]] = 0
            scores[target] += said
        return scores

    def decode(self, tokens: list[str]) -> np.ndarray:
        """The best label of every token; fillers and the stops after them are passed over, so that what
        stands around them meets, and are `other`.

        A label that `other` beats at a token by more than the steps from and to any label its neighbours may have
        can make up isn't on the best path; leaving it out may rule out others beside it. Tokens that may have
        `other` alone cut the text into short stretches, each decoded by Viterbi on its own, all stretches of
        a length at once.
        """
        labels = np.zeros(len(tokens), np.int8)
        if not tokens:
            return labels
        ids = self.numbers(tokens)
        filler, stops = self.filler[ids], np.isin(ids, [self.number(c) for c in STOPS])
        for _ in range(3):
            filler[1:] |= filler[:-1] & stops[1:]
        said = np.flatnonzero(~filler)
        ids = ids[said]
        out = np.zeros(len(ids), np.int8)
        e = self.emissions(ids)
        e -= e[:, :1].copy()
        bits = (1 << np.arange(len(LABELS))).astype(np.int16)
        may = np.full(len(ids) + 2, bits.sum(), np.int16)  # with `other` on either side
        may[0] = may[-1] = 1
        may[1:-1][ids == self.number(BORDER)] = 1
        todo = np.flatnonzero(may[1:-1] > 1)
        shrinks = True
        while shrinks:
            possible = e[todo] + self.before[may[todo]] + self.after[may[todo + 2]] >= 0
            possible[:, 0] = True
            left = possible @ bits
            may[todo + 1] = left
            shrinks = 0.97 * len(todo) > (left > 1).sum()
            todo = todo[left > 1]
        edge = np.diff(np.concatenate([[0], (may[1:-1] > 1).astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lengths = ends - starts
        # stretches of similar length go together, the shorter ones filled up with tokens that are `other`
        step = np.maximum(1, 2 ** np.maximum(0, np.floor(np.log2(np.maximum(lengths, 1))).astype(int) - 2))
        sizes = -(-lengths // step) * step
        e = np.concatenate([e, np.array([[0] + [-1e6] * (len(LABELS) - 1)], np.float32)])
        for n in np.unique(sizes):
            some = np.flatnonzero(sizes == n)
            for part in np.array_split(some, -(-len(some) * int(n) // (1 << 19))):
                at = starts[part, None] + np.arange(n)
                inside = np.arange(n) < lengths[part, None]
                found = self.viterbi(e[np.where(inside, at, len(ids))])
                out[at[inside]] = found[inside]
        labels[said] = out
        return labels

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best paths through scores of shape (stretches, length, labels), `other` before and after."""
        t = self.transitions.astype(np.float32)
        score = e[:, 0] + t[0]
        back = np.zeros((e.shape[1], e.shape[0], e.shape[2]), np.int8)
        for i in range(1, e.shape[1]):
            step = score[:, :, None] + t
            back[i] = step.argmax(1)
            score = step.max(1) + e[:, i]
        path = np.zeros(e.shape[:2], np.int8)
        path[:, -1] = (score + t[:, 0]).argmax(1)
        for i in range(e.shape[1] - 1, 0, -1):
            path[:, i - 1] = back[i, np.arange(len(path)), path[:, i]]
        return path


# ---------------------------------------------------------------- training


def pieces_of(row: str, fill: Filler) -> list[tuple[str, int]]:
    """A sentence of the table as (text, label) pieces, its slots filled."""
    return [(piece if k % 2 == 0 else fill.slot(piece), SLOTS.get(piece, 0) if k % 2 else 0) for k, piece in enumerate(re.split(r"\{(\w+)\}", row)) if piece]


def varied(pieces: list[tuple[str, int]], fill: Filler) -> list[tuple[str, int]]:
    """The sentence as transcripts have it: with a label or mark before it, in lower case and without signs, with a
    filler in it, cut off within a sentence, or with words in it that no list knows."""
    r = fill.r
    if r.random() < 0.12:
        plain = [(t if k and r.random() < 0.5 else t.lower() if k else re.sub(r"[.,?!¿¡]", "", t).lower(), k) for t, k in pieces]
        pieces = [p for p in plain if p[0]]
    out = []
    for text, k in pieces:
        words = re.split(r"(\s+)", text) if not k else [text]
        if not k and r.random() < 0.6:
            german = any(w in _GERMAN for w in words)
            words = [(fill.syllables().lower() if w.islower() else fill.syllables()) if w.isalpha() and (w.islower() or german or not i) and w not in _GERMAN and r.random() < 0.3 else w for i, w in enumerate(words)]
        if not k and len(words) > 1 and r.random() < 0.25:
            at = 2 * r.randrange((len(words) + 1) // 2)
            words[at:at] = [r.choice(_FILLERS) if r.random() < 0.55 else fill.sound(), " "]
        out.append(("".join(words), k))
    x = r.random()
    if x < 0.1 and not out[-1][1]:
        words = out[-1][0].split(" ")
        out[-1] = (" ".join(words[: r.randint(1, len(words))]), 0)
    elif x < 0.2 and not out[0][1]:
        words = out[0][0].split(" ")
        out[0] = (" ".join(words[r.randrange(len(words)) :]), 0)
    x = r.random()
    if x < 0.12:
        out = [("[", 0), (fill.label(), 5), (r.choice(["] ", "] ", "] ", f" ({r.choice(['chair', 'host', 'guest', 'notes', 'teacher'])})] ", ": "]), 0), *out]
    elif x < 0.34:
        out = [(fill.opening() + " ", 0), *out]
    return out


def labelled(given: list[str], family: list[str], rounds: int = 12, seed: int = 7, table: tuple[str, ...] = (*MARKED, *UNMARKED)) -> list[tuple[list[str], list[int]]]:
    """The table with its slots filled `rounds` times, as tokens with their labels; every third text is of two
    sentences."""
    fill = Filler(given, family, seed)
    out = []
    for _ in range(rounds):
        for row in table:
            pieces = varied(pieces_of(row, fill), fill)
            if fill.r.random() < 0.33:
                pieces = [*pieces, (" ", 0), *varied(pieces_of(fill.r.choice(table), fill), fill)]
            text = "".join(t for t, _ in pieces)
            ends = np.cumsum([len(t) for t, _ in pieces])
            found = list(TOKEN.finditer(text))
            labels = [pieces[int(np.searchsorted(ends, m.start() + (m[0][0] in "(+" and len(m[0]) > 1), side="right"))][1] for m in found]
            out.append(([BORDER, *(m[0] for m in found), BORDER], [0, *labels, 0]))
    return out


@functools.lru_cache(maxsize=4)
def train(given: tuple[str, ...], family: tuple[str, ...], known_given: frozenset[str], known_family: frozenset[str], rounds: int = 18, steps: int = 120, penalty: float = 5e-5, least: int = 3) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam over the whole table; forward and backward sums in
    batches of equal length. given and family fill the table, known_given and known_family are what is looked up.
    The table bounds the training: rounds times its rows. Features seen fewer than `least` times are left out."""
    data = [([t[i] for i in at], [y[i] for i in at]) for t, y in labelled(list(given), list(family), rounds) for at in [unfilled(t)]]
    data.sort(key=lambda x: len(x[0]))
    features = Features(known_given, known_family)
    names: dict[str, int] = {}
    of_token = {t: features(form_of(t)) for t in {t for tokens, _ in data for t in tokens}}
    seen = Counter(f for tokens, _ in data for t in tokens for f in of_token[t])
    of_token = {t: [f for f in fs if seen[f] >= least] for t, fs in of_token.items()}
    rows, cols = [], []
    n = 0
    for tokens, _ in data:
        for i in range(len(tokens)):
            for d in range(-REACH, REACH + 1):
                j = i - d
                if 0 <= j < len(tokens):
                    for f in of_token[tokens[j]]:
                        rows.append(n)
                        cols.append(names.setdefault(f"{d}{f}", len(names)))
            n += 1
    rows, cols = np.array(rows), np.array(cols)
    bounds = np.searchsorted(rows, np.arange(n))
    k = len(LABELS)
    gold = np.concatenate([np.array(x) for _, x in data])
    lengths = np.array([len(t) for t, _ in data])
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    w, t = np.zeros((len(names), k)), np.zeros((k, k))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    gold_t = np.zeros((k, k))
    for a, b in zip(first, first + lengths):
        np.add.at(gold_t, (gold[a : b - 1], gold[a + 1 : b]), 1)
    for step in range(1, steps + 1):
        e = np.add.reduceat(w[cols], bounds, axis=0)
        grad_e, grad_t = np.zeros_like(e), gold_t.copy()
        grad_e[np.arange(n), gold] = 1
        for size in np.unique(lengths):
            at = first[lengths == size][:, None] + np.arange(size)
            x = np.exp(e[at] - e[at].max(2, keepdims=True))
            m = np.exp(t)
            alpha = np.zeros_like(x)
            beta = np.ones_like(x)
            alpha[:, 0] = x[:, 0] / x[:, 0].sum(1, keepdims=True)
            for i in range(1, size):
                alpha[:, i] = (alpha[:, i - 1] @ m) * x[:, i]
                alpha[:, i] /= alpha[:, i].sum(1, keepdims=True)
            for i in range(size - 2, -1, -1):
                beta[:, i] = (beta[:, i + 1] * x[:, i + 1]) @ m.T
                beta[:, i] /= beta[:, i].sum(1, keepdims=True)
            p = alpha * beta
            grad_e[at] -= p / p.sum(2, keepdims=True)
            for i in range(size - 1):
                pair = alpha[:, i, :, None] * m * (x[:, i + 1] * beta[:, i + 1])[:, None, :]
                grad_t -= (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        grad_w = np.stack([np.bincount(cols, grad_e[rows, y], len(names)) for y in range(k)], 1)
        for value, grad, m1, m2 in ((w, grad_w / n - penalty * w, moments[0], moments[1]), (t, grad_t / n - penalty * t, moments[2], moments[3])):
            m1 += 0.1 * (grad - m1)
            m2 += 0.02 * (grad**2 - m2)
            value += 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.98**step)) + 1e-8)
    return Model(features, names, w.astype(np.float32), t)


def trained(known_names: DataFrame, fill_names: int = 5000, most_names: int = 2_000_000, seed: int = 7) -> Model:
    """The field trained with the list of names. All of the list is looked up in texts; a sample of fill_names of
    each kind, drawn with the seed, fills the labelled table. The list goes to the executors with the weights, so
    one of more than most_names raises an error and nothing is left out."""
    rows = known_names.where(F.col("name").isNotNull() & F.col("kind").isin("given", "family")).select("name", "kind").distinct()
    found = rows.limit(most_names + 1).collect()
    if len(found) > most_names:
        raise ValueError(f"more than {most_names} names; give most_names if the executors can hold them")
    lists = {k: sorted(r[0] for r in found if r[1] == k) for k in ("given", "family")}
    fill = {k: tuple(random.Random(seed).sample(v, min(fill_names, len(v)))) for k, v in lists.items()}
    known = {k: frozenset(x.lower() for x in v) for k, v in lists.items()}
    return train(fill["given"], fill["family"], known["given"], known["family"])


# ---------------------------------------------------------------- application

_MAIL = re.compile(r"(?i)@|\bat\b|\bdot\b")


def plausible(label: int, tokens: list[str], names: frozenset[str] = frozenset()) -> bool:
    """Whether a passage can be what it is taken for: an address of mail has its sign, numbers their digits, and a name
    a capital or a word of the lists."""
    text = " ".join(tokens)
    digits = sum(c.isdigit() for c in text)
    if label == 1:
        return "@" in text or len(tokens) >= 3 and bool(_MAIL.search(text))
    if label == 2:
        return digits >= 7 or sum(t.lower() in _NUMBER_WORDS for t in tokens) >= 6
    if label == 3:
        return digits >= 6
    if label == 4:
        return digits >= 1 and any(t.isalpha() for t in tokens)
    return any(t.isalpha() and len(t) > 2 and (t[0].isupper() or t.lower() in names) for t in tokens)


def passages(labels: np.ndarray) -> list[tuple[int, int, int]]:
    """(begin, end, label) of the runs of one label other than `other`."""
    if not len(labels):
        return []
    change = np.flatnonzero(np.diff(labels)) + 1
    cuts = np.concatenate([[0], change, [len(labels)]])
    kinds = labels[cuts[:-1]]
    return [(int(a), int(b), int(k)) for a, b, k in zip(cuts[:-1][kinds > 0], cuts[1:][kinds > 0], kinds[kinds > 0])]


def marks(model: Model, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Per text its passages, as numbers of tokens."""
    joined = f" {BORDER} ".join(["", *(t.replace(BORDER, " ") for t in texts), ""])
    tokens = TOKEN.findall(joined)
    labels = model.decode(tokens)
    # the whole form of an address of mail is one, whatever stands around it
    labels[[i for i, t in enumerate(tokens) if "@" in t and len(t) > 1]] = 1
    begins = np.array([i + 1 for i, t in enumerate(tokens) if t == BORDER])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b, k in passages(labels):
        if plausible(k, tokens[a:b], model.features.names):
            text = int(np.searchsorted(begins, a, side="right")) - 1
            out[text].append((a - int(begins[text]), b - int(begins[text]), k))
    return out


def redacted(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each passage replaced by its type in brackets; a full stop or comma at its end stays."""
    if not found:
        return text
    spans = [m.span() for m in TOKEN.finditer(text.replace(BORDER, " "))]
    out, at = [], 0
    for a, b, k in found:
        while b - a > 1 and text[spans[b - 1][0] : spans[b - 1][1]] in ".,;:!?":
            b -= 1
        out += [text[at : spans[a][0]], f"[{LABELS[k].upper()}]"]
        at = spans[b - 1][1]
    return "".join(out) + text[at:]


def _batches(frame: pd.DataFrame, size: int = 1 << 21):
    """Slices of a frame of about `size` characters of text each; a longer text is a slice of its own."""
    ends = frame["text"].map(lambda t: len(t) if isinstance(t, str) else 0).cumsum().to_numpy()
    a = 0
    while a < len(frame):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size)))
        yield frame[a:b]
        a = b


def tagged(texts: DataFrame, model: Model, keep_all: bool = False) -> DataFrame:
    """texts: (source_table, session_id, item_no, version, text). Adds types, a sum of 1 << label for the
    labels found, and drops the text; with keep_all the text stays, redacted."""
    schema = "source_table string, session_id string, item_no bigint, version bigint, types int" + (", text string" if keep_all else "")

    def tag(frames):
        for frame in frames:
            for part in _batches(frame):
                raw = [t if isinstance(t, str) else "" for t in part["text"]]
                found = marks(model, raw)
                out = part.drop(columns="text").assign(types=[sum({1 << k for _, _, k in f}) for f in found])
                if keep_all:
                    out["text"] = [redacted(t, f) if isinstance(t, str) else None for t, f in zip(part["text"], found)]
                yield out

    return texts.mapInPandas(tag, schema)


def texts_of(segments: DataFrame, chunks: DataFrame) -> DataFrame:
    a = segments.select(F.lit("segments").alias("source_table"), "session_id", F.col("pos").alias("item_no"), F.coalesce("seg_id", F.lit(LAST)).alias("version"), "text")
    b = chunks.select(F.lit("chunk_index").alias("source_table"), "session_id", F.col("chunk_id").cast("bigint").alias("item_no"), F.lit(0).cast("bigint").alias("version"), "text")
    return a.unionByName(b)


def found_types(segments: DataFrame, chunks: DataFrame, known_names: DataFrame) -> DataFrame:
    """(source_table, session_id, item_no, pii_type) for every record and type of personal data in its text.

    Texts are tagged where they lie, only types are shuffled. Of segments delivered repeatedly the one with
    the smallest seg_id counts, of repeated chunks any. Null and empty texts have none; null keys are keys.
    """
    rows = tagged(texts_of(segments, chunks), trained(known_names))
    once = delivered_once(rows, F.col("types"), key=("source_table", "session_id", "item_no"), version="version")
    names = F.array(*[F.when(F.col("types").bitwiseAND(1 << k) != 0, F.lit(v)) for k, v in enumerate(LABELS) if k])
    return once.where(F.col("types") > 0).select("source_table", "session_id", "item_no", F.explode(F.array_compact(names)).alias("pii_type"))


def redacted_texts(segments: DataFrame, chunks: DataFrame, known_names: DataFrame) -> DataFrame:
    """(source_table, session_id, item_no, text): every text once, personal data replaced by [EMAIL], [PHONE],
    [ID_NUMBER], [ADDRESS] or [NAME], all else unchanged; null stays null."""
    rows = tagged(texts_of(segments, chunks), trained(known_names), keep_all=True)
    return delivered_once(rows, F.col("text"), key=("source_table", "session_id", "item_no"), version="version")


def kept_texts(segments: DataFrame, chunks: DataFrame, known_names: DataFrame) -> DataFrame:
    """(source_table, session_id, item_no, kept) per record with a text: whether the redacted text is the text with
    placeholders for some of it, all else unchanged and in order."""
    texts = texts_of(segments, chunks).where(F.col("text").isNotNull())
    once = delivered_once(texts, F.col("text"), key=("source_table", "session_id", "item_no"), version="version")
    model = trained(known_names)
    placeholder = re.compile(r"\[(?:" + "|".join(x.upper() for x in LABELS[1:]) + r")\]")

    def compare(frames):
        for frame in frames:
            kept = []
            for text, found in zip(frame["text"], marks(model, frame["text"].tolist())):
                at = 0
                for part in placeholder.split(redacted(text, found)):
                    at = text.find(part, at) + len(part) if at >= 0 and text.find(part, at) >= 0 else -1
                kept.append(at >= 0)
            yield frame.drop(columns="text").assign(kept=kept)

    return once.mapInPandas(compare, "source_table string, session_id string, item_no bigint, kept boolean")
