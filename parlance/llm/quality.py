"""Problem 10: statistics of texts, and a Gaussian mixture that tells prose from lists, tables and junk."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.quality_examples import LOOKED_AT
from parlance.sources.shared import width, written

#: Common words of written languages.
COMMON = frozenset("the of and to in is that it was for on are with as be at this have from or by but not we they us our you i will would can could so if then than has an a more no one which how who what still before after every der die das und ist nicht den dem dass wie wird noch auch wenn bis von wir ich es ein eine zu mit für aus hat am weil le la est que un une du pas vous sur au il je ce cela pour nous ne y encore par et même si el los por lo del se está una al fue para qué hay de di il che è per non con sono più come alla nel anche gli della o os da do em não na uma ao mais foi het een van en dat te op met voor niet zijn er maar i w na nie się z że jest do po och att det som på är av inte ett ja on ei se и в не на что он с как это по но из за то от у для а все так его".split())
#: Common characters of languages written without blanks between words.
DENSE_COMMON = frozenset("的一是不了在人有我他这中大来上个们到说为子和你地出道也时年のはをにがでともたしてるなかいう은는이가을를에의도ที่และการเป็น")
CLASSES = ("prose", "list", "table", "junk")
#: Of every document; the first five are what p10_statistics reports.
STATISTICS = ("n_words", "mean_word_len", "symbol_ratio", "end_punct_share", "common_share", "digits", "cells", "short_lines", "per_entry", "no_vowel", "richness", "broken_chars", "mixed", "long_tokens", "repeats")
FEATURES = STATISTICS

_WORD_SIGN = re.compile(r"\w")
_LETTERS = re.compile(r"[^\W\d_]+")
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()\-。、，！？：；「」『』（）《》·…’“”«»¿¡–—]")
_PLAIN_ASCII = {c: None for c in range(128) if not _SYMBOL.fullmatch(chr(c))}
_ENDED = re.compile(r"[.!?…:。！？：][\"'”’»)\]」』）]*\s*$")
_BULLET = re.compile(r"^\s*(?:[-*•+–]|\d{1,4}[.)]|[^\W\d_][.)])\s+")
_CELL = re.compile(r"\t|;|\||\",\"| {2,}")
_ENTRY = "\n,;.!?|»\t。、，！？；"
_NO_VOWEL = re.compile(r" [bcdfghjklmnpqrstvwxz]{3,}(?= )")
_BROKEN = re.compile(r"[ÂÃ€\ufffd�§¬°™]|â€")
_MIXED = re.compile(r"[\d|;:!~^§°¬�+/]+(?=[^\W\d_])")
_PARTS = re.compile(r"[\n|»]")
#: Addresses of pages and files and names in code, which prose on technical matters holds.
_LINK = re.compile(r"\b(?:https?|ftp)://[^\s)>\]]+[^\s)>\].,;:!?]|\bwww\.[^\s)>\]]+|(?<![\w/])(?:/[\w.-]+){2,}/?")
_CODE = re.compile(r"`[^`\n]{1,80}`")
#: Scripts that put no blanks between words; a word there is two signs long on the average.
_DENSE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
_DENSE_WORD = re.compile(rf"({_DENSE.pattern}{{2}})(?={_DENSE.pattern})")


def _ends(line: str) -> bool:
    """Whether a line ends in punctuation, quotes and brackets after it aside."""
    last = line.rstrip()[-1:]
    return last in ".!?…:。！？：" or last in "\"'”’»)]」』）" and _ENDED.search(line) is not None


def _shares(text: str, tokens: list[str], visible: int, letters: list[str], ended: list[bool]) -> tuple[int, float, float, float, float]:
    n, common = len(tokens), COMMON
    empty = sum(not t.isalnum() and not _WORD_SIGN.search(t) for t in tokens)
    symbols = len(text.translate(_PLAIN_ASCII)) if text.isascii() else len(_SYMBOL.findall(text))
    return n - empty, visible / n, symbols / visible, sum(ended) / len(ended), sum([w in common for w in letters]) / len(letters) if letters else 0.0


def shares_of(text: str) -> tuple[int, float, float, float, float]:
    """What p10 reports of a text: its words; the mean length of its tokens; symbols by visible characters; the
    share of its lines that end in punctuation; common words by runs of letters."""
    tokens = text.split()
    if not tokens:
        return 0, 0.0, 0.0, 0.0, 0.0
    return _shares(text, tokens, sum(map(len, tokens)), _LETTERS.findall(text.lower()), [_ends(x) for x in text.split("\n") if x.strip()])


def statistics_of(text: str) -> tuple:
    """STATISTICS of a text: what shares_of gives, and what shows cells in equal columns, short entries, unreadable
    or damaged words, and repetition."""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return (0,) + (0.0,) * (len(STATISTICS) - 1)
    lengths = list(map(len, tokens))
    visible = sum(lengths)
    lower = text.lower()
    letters = _LETTERS.findall(lower)
    lines = [x for x in text.split("\n") if x.strip()]
    ended = [_ends(x) for x in lines]
    cells = [len(_CELL.findall(x)) for x in lines] if "\t" in text or ";" in text or "|" in text or "  " in text or '","' in text else [0]
    even = sum(a == b and a >= 2 for a, b in zip(cells, cells[1:]))
    short = sum(not e and len(_BULLET.sub("", x).split()) <= 6 for x, e in zip(lines, ended))
    parts = [x for x in (p.strip() for p in _PARTS.split(lower)) if x]
    return (
        *_shares(text, tokens, visible, letters, ended),
        sum(map(text.count, "0123456789")) / visible,
        even / max(1, len(lines) - 1),
        short / len(lines),
        n / (1 + sum(map(text.count, _ENTRY))),
        len(_NO_VOWEL.findall(f" {' '.join(letters)} ")) / n,
        len(set(lower.split())) / math.sqrt(n),
        0.0 if text.isascii() else len(_BROKEN.findall(text)) / visible,
        sum(m.start() > 0 and text[m.start() - 1].isalpha() for m in _MIXED.finditer(text)) / n,
        24 * sum([k >= 24 for k in lengths]) / visible if max(lengths) >= 24 else 0.0,
        1 - len(set(parts)) / len(parts) if parts else 0.0,
    )


def plain(text: str) -> str:
    """The text as the mixture sees it, so that technical prose and other scripts aren't taken for junk: a link or piece of code is one word, and scripts without blanks get one
    after every two signs."""
    if "/" in text or "www." in text or "`" in text:
        text = _CODE.sub("code", _LINK.sub("link", text))
    return text if text.isascii() or not _DENSE.search(text) else _DENSE_WORD.sub(r"\1 ", text)


def features_of(text: str) -> tuple:
    """statistics_of what the mixture sees; in scripts without blanks common signs count as common words."""
    seen = plain(text)
    out = statistics_of(seen)
    if seen is not text and not seen.isascii() and (dense := _DENSE.findall(text)):
        share = min(1.0, 2 * sum(c in DENSE_COMMON for c in dense) / len(dense))
        out = (*out[:4], max(out[4], share), *out[5:])
    return out


def statistics(documents: DataFrame, id_col: str = "doc_id", of=statistics_of, names: tuple[str, ...] = STATISTICS) -> DataFrame:
    """(doc_id, one column per name) of what `of` gives, a row per row of documents; zeros for null and empty texts.

    One pass in Python over Arrow batches: measured on this corpus it takes an eighth of the time of the same
    in array functions of the JVM, which run their lambdas interpreted.
    """

    def measure(frames):
        for frame in frames:
            rows = [of(t if isinstance(t, str) else "") for t in frame["text"]]
            yield pd.DataFrame(rows, columns=list(names)).assign(**{id_col: frame[id_col].to_numpy()})

    kinds = ", ".join(f"{c} {'bigint' if c == 'n_words' else 'double'}" for c in names)
    return documents.select(id_col, "text").mapInPandas(measure, f"{kinds}, {id_col} bigint")


def vectors(frame: pd.DataFrame) -> np.ndarray:
    """FEATURES of the mixture: the statistics, long tails drawn in."""
    x = frame[list(FEATURES)].to_numpy(float).copy()
    at = FEATURES.index
    for c in ("n_words", "per_entry", "richness"):
        x[:, at(c)] = np.log1p(x[:, at(c)])
    for c, most in (("mean_word_len", 20.0), ("symbol_ratio", 0.3), ("broken_chars", 0.2), ("mixed", 1.0), ("long_tokens", 1.0)):
        x[:, at(c)] = np.minimum(x[:, at(c)], most)
    return x


# ---------------------------------------------------------------- inspected examples

#: Small vocabularies for the examples, by language: things, qualities, sentence frames.
_THINGS = {"en": "draft badge cable roster memo sensor permit outline".split(), "de": "Antrag Bericht Kurs Termin Vertrag Server".split(), "fr": "projet dossier contrat budget rapport devis".split(), "es": "plan informe curso registro pedido plazo".split()}
_LOOKS = {"en": "quiet final broad early shared".split(), "de": "neue alte offene späte".split(), "fr": "simple interne ancien complet".split(), "es": "nuevo breve interno simple".split()}
_FRAMES = {
    "en": ["We said on Monday that the {t} would be {l} by then.", "Could planning tell us whether the {t} is {l}?", "The {l} {t} was moved by mistake, and nobody looked at it again.", "There is a {l} {t} under the {u}, so we keep it for two more weeks.", "If you have a {l} {t}, you can use it to find the {u} in six steps.", "I think the {t} should stay with us until the {u} is {l}."],
    "de": ["Der {t} wurde am Freitag von der Abteilung geprüft und ist nun {l}.", "Ich denke, dass der {t} bis zum Montag fertig sein muss.", "Bitte schickt mir den {t}, sobald er mit dem {u} verglichen ist."],
    "fr": ["Le {t} est {l} et nous devons encore le vérifier avant lundi.", "Il y a trois questions sur le {t} et une sur le {u}.", "Je pense que le {t} doit rester {l} jusqu'à la semaine prochaine."],
    "es": ["El {t} fue revisado por el equipo y está {l} desde el lunes.", "Hay tres preguntas sobre el {t} y una sobre el {u}.", "Creo que el {t} debe quedar {l} hasta la próxima semana."],
}


def inspected_examples(per_kind: int = 12, seed: int = 5) -> list[tuple[str, str, str]]:
    """(class, kind, text) of texts whose class is plain to see: those of LOOKED_AT, and per_kind made by rule of
    each kind that is long or follows a format. The kinds seed the mixture and name its components."""
    r = random.Random(seed)
    out: list[tuple[str, str, str]] = list(LOOKED_AT)
    for k in range(per_kind):
        g = ("en", "en", "de", "fr", "en", "es")[k % 6]
        thing = lambda: r.choice(_THINGS[g])  # noqa: B023, E731
        look = lambda: r.choice(_LOOKS[g])  # noqa: B023, E731
        sentence = lambda: r.choice(_FRAMES[g]).format(t=thing(), u=thing(), l=look())  # noqa: B023, E731
        paragraph = lambda n: " ".join(sentence() for _ in range(n))
        size = (2, 5, 9, 25)[k % 4]
        long = "\n\n".join(paragraph(r.randint(2, 5)) for _ in range(size))
        plain = long.lower().translate({ord(c): "" for c in ".,?"})

        def wrapped(text: str) -> str:
            words, lines = text.split(), [""]
            for w in words:
                if len(lines[-1]) + len(w) > 60:
                    lines.append("")
                lines[-1] = (lines[-1] + " " + w).strip()
            return "\n".join(lines)

        entry = lambda: r.choice([f"{look()} {thing()}", thing(), f"{look()} {thing()}", f"{thing()} {thing()}", f"{look()} {thing()}, {r.choice(['two', 'six', 'nine'])} copies", f"{thing()} for planning"])
        entries = [entry() for _ in range(8 + 3 * k)]
        head = r.choice(["", "", "Terms\n", "Keywords:\n", "Agenda\n"])
        tail = r.choice(["", "", "\n" + sentence()])
        columns = 3 + k % 4
        cell = lambda c: thing() if c % 3 == 0 else str(r.randint(100, 9999)) if c % 3 == 1 else r.choice(["yes", "no", "-", "", f"{r.randint(10, 23)}:{r.randint(10, 59)}", f"{r.random() * 90:.1f}"])
        rows = [["owner", "code", "room", "count", "status", "hours"][:columns]] + [[cell(c + k) for c in range(columns)] for _ in range(6 + 3 * k)]
        lead = r.choice(["", "", sentence() + "\n"])
        noise = lambda abc, n: "".join(r.choice(abc) for _ in range(n))
        nav = r.choices(["Home", "Menu", "Sign in", "Next >", "< Back", "Loading...", "Share", "0:00 / 0:00", "© 0000", "Skip to content"], k=20 + 6 * k)
        one = r.choice(["yes", "okay", "the the", "so", "no no"])
        damaged = "".join(r.choice("°§¬|!;:~^10") if c != "\n" and r.random() < 0.3 else c for c in paragraph(6))
        garbled = paragraph(4).replace("e", "Ã©").replace("o", "â€™").replace("a", "�")
        speech = "\n".join(f"[{r.randint(10, 59)}:{r.randint(10, 59)}] SPEAKER_0{r.randint(0, 4)}: {paragraph(2)}" for _ in range(size + 1))
        asked = "\n\n".join(f"Q: {sentence()}\nA: {paragraph(2)}" for _ in range(size))
        pointed = "\n".join(f"- {paragraph(2)}" for _ in range(size + 1))
        out += [("prose", kind, t) for kind, t in (("plain", long), ("plain", sentence()), ("bare", plain), ("wrapped", wrapped(long)), ("wrapped", f"{sentence()[:12]}\n\n{wrapped(paragraph(2 + k % 3))}"), ("bare", sentence().lower().strip(".?")), ("broken", paragraph(3).replace(" ", "\n", 1 + k % 4) + wrapped(paragraph(1 + k % 2)).replace(". ", ".\n\n")), ("spoken", speech), ("asked", asked), ("pointed", pointed), ("mixed", long + "\n" + "\n".join("- " + x for x in entries[:3])))]
        out += [("list", kind, t) for kind, t in (("marked", head + "\n".join(("- ", "* ", "• ")[k % 3] + x for x in entries) + tail), ("marked", head + "\n".join(f"{i}. {x}" for i, x in enumerate(entries, 1))), ("lines", head + "\n".join(x.capitalize() for x in entries)), ("commas", head + "\n".join(", ".join(entries[i : i + 6]) for i in range(0, len(entries), 6)) + tail))]
        out += [("table", kind, lead + t) for kind, t in (("tabs", "\n".join("\t".join(x) for x in rows)), ("tabs", "\n".join(";".join(x) for x in rows)), ("quoted", "\n".join(",".join(f'"{c}"' for c in x) for x in rows)), ("piped", "\n".join("| " + " | ".join(x) + " |" for x in [rows[0], ["---"] * columns, *rows[1:]])), ("aligned", "\n".join("".join(c.ljust(14) for c in x).rstrip() for x in rows)))]
        out += [("junk", kind, t) for kind, t in (("letters", " ".join(noise("bcdfghjklmnpqrstvwxz", r.randint(2, 10)) for _ in range(40 + 9 * k))), ("encoded", "\n".join(noise("ABCDEFGHIJKLMNabcdefghijklmnopqrstuvwxyz0123456789+/", 76) for _ in range(4 + k))), ("dumped", "\n".join(f"{i * 16:08x}: " + " ".join(noise("0123456789abcdef", 4) for _ in range(8)) for i in range(6 + 2 * k))), ("symbols", "".join(noise("<>(){}[]#%&*+-/=?@^_|~.,:;$ \n", 60 + 20 * k))), ("repeated", (" ", "\n", ". ")[k % 3].join([one] * (40 + 10 * k))), ("page", ("\n", " | ", " » ")[k % 3].join(nav)), ("damaged", damaged), ("garbled", garbled))]
    return out


# ---------------------------------------------------------------- mixture


def log_densities(x: np.ndarray, weights: np.ndarray, means: np.ndarray, variances: np.ndarray) -> np.ndarray:
    """Log of weight times density, a row per point, a column per component; diagonal covariances."""
    constant = np.log(weights) - 0.5 * (np.log(2 * math.pi * variances)).sum(1)
    return constant - 0.5 * ((x**2) @ (1 / variances).T - 2 * x @ (means / variances).T + (means**2 / variances).sum(1))


def responsibilities(x: np.ndarray, model: tuple) -> np.ndarray:
    d = log_densities(x, *model)
    d = np.exp(d - d.max(1, keepdims=True))
    return d / d.sum(1, keepdims=True)


def fit(points: DataFrame, mean: np.ndarray, scale: np.ndarray, start: tuple, prior: tuple, most_rounds: int, floor: float, gain: float = 5e-3) -> tuple[tuple, list[float]]:
    """Expectation-maximization over all points, until a round lifts the mean log-likelihood by less than `gain`, or
    most_rounds; returns the mixture and the log-likelihood before each round. A round is one pass that sends
    back one row of sums a task.

    prior: (strength, weights, means, variances): pseudo-points that hold a component near what its examples
    look like where the corpus has hardly any of its kind.
    """
    model, reached = start, []
    strength, _, m0, v0 = prior
    size = m0.shape
    for _ in range(most_rounds):
        current = model

        def sums(frames, current=current):
            total, n, s, q = 0.0, np.zeros(size[0]), np.zeros(size), np.zeros(size)
            for frame in frames:
                x = (vectors(frame) - mean) / scale
                d = log_densities(x, *current)
                top = d.max(1, keepdims=True)
                r = np.exp(d - top)
                whole = r.sum(1, keepdims=True)
                total += float((top + np.log(whole)).sum())
                r /= whole
                n, s, q = n + r.sum(0), s + r.T @ x, q + r.T @ x**2
            yield pd.DataFrame({"x": [[total, *n, *s.ravel(), *q.ravel()]]})

        found = gathered(points.mapInPandas(sums, _SUMS), 1 + size[0] + 2 * size[0] * size[1])
        n, s, q = found[1 : 1 + size[0]], found[1 + size[0] : 1 + size[0] + m0.size].reshape(size), found[1 + size[0] + m0.size :].reshape(size)
        full = n + strength
        means = (s + strength * m0) / full[:, None]
        variances = (q + strength * (v0 + m0**2)) / full[:, None] - means**2
        model = (full / full.sum(), means, np.maximum(variances, floor))
        reached.append(found[0] / max(1.0, n.sum()))
        if len(reached) > 1 and reached[-1] - reached[-2] < gain:
            break
    return model, reached


_SUMS = "x array<double>"


def gathered(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of rows of `size` numbers, one row per task of the pass before. They are added up on the way: a
    square root of the shuffle partitions of tasks each streams through its share, and the driver adds theirs."""

    def add(frames):
        total = np.zeros(size)
        for frame in frames:
            for row in frame["x"]:
                total += row
        yield pd.DataFrame({"x": [total.tolist()]})

    few = max(1, math.isqrt(width(parts.sparkSession)))
    return np.sum([np.zeros(size), *(np.array(r[0]) for r in parts.repartition(few).mapInPandas(add, _SUMS).collect())], axis=0)


def moments(points: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """Number, mean and deviation of all vectors."""

    def sums(frames):
        n, s, q = 0, np.zeros(len(FEATURES)), np.zeros(len(FEATURES))
        for frame in frames:
            x = vectors(frame)
            n, s, q = n + len(x), s + x.sum(0), q + (x**2).sum(0)
        yield pd.DataFrame({"x": [[float(n), *s, *q]]})

    found = gathered(points.mapInPandas(sums, _SUMS), 1 + 2 * len(FEATURES))
    n, s, q = found[0], found[1 : 1 + len(FEATURES)], found[1 + len(FEATURES) :]
    mean = s / max(1.0, n)
    return n, mean, np.sqrt(np.maximum(q / max(1.0, n) - mean**2, 0.0))


def train(points: DataFrame, most_rounds: int = 30, strength: float = 20.0, floor: float = 0.02, per_kind: int = 12) -> tuple:
    """(mean, scale, model, class per component). Means and deviations come from all points.

    One component per kind of inspected example, started at its examples; after the fit each component takes
    the class that most of the examples it answers for have. per_kind bounds the examples; see
    inspected_examples.
    """
    _, mean, deviation = moments(points)
    examples = inspected_examples(per_kind)
    x = vectors(pd.DataFrame([features_of(t) for _, _, t in examples], columns=list(STATISTICS)))
    scale = np.maximum(deviation, np.maximum(0.25 * x.std(0), 1e-3))
    x = (x - mean) / scale
    which = [e[:2] for e in examples]
    kinds = sorted(set(which))
    of = np.array([kinds.index(w) for w in which])
    means = np.array([x[of == k].mean(0) for k in range(len(kinds))])
    variances = np.array([np.maximum(x[of == k].var(0), 0.1) for k in range(len(kinds))])
    weights = np.full(len(kinds), 1 / len(kinds))
    model, _ = fit(points, mean, scale, (weights, means, variances), (strength, weights, means, variances), most_rounds, floor)
    r = responsibilities(x, model)
    votes = np.array([[r[[w[0] == c for w in which], k].sum() for c in CLASSES] for k in range(len(kinds))])
    classes = [CLASSES[int(v.argmax())] if v.sum() > 0.5 else kinds[k][0] for k, v in enumerate(votes)]
    return mean, scale, model, classes


def classified(documents: DataFrame, id_col: str = "doc_id", most_rounds: int = 30) -> DataFrame:
    """(doc_id, doc_class, certainty) of every document with a text; certainty is the share of the class's
    components in the density.

    Null and empty texts, and texts of white space only, have no class and no row. Repeated ids keep a row
    each. No rows for no documents.
    """
    points = written(statistics(documents.where(F.col("text").isNotNull() & F.col("text").rlike(r"\S")), id_col, features_of).where(F.col("mean_word_len") > 0), "statistics")
    mean, scale, model, classes = train(points, most_rounds)
    columns = np.array([[c == k for c in CLASSES] for k in classes], float)

    def judge(frames):
        for frame in frames:
            p = responsibilities((vectors(frame) - mean) / scale, model) @ columns
            k = p.argmax(1) if len(p) else np.zeros(0, int)
            yield pd.DataFrame({id_col: frame[id_col].to_numpy(), "doc_class": [CLASSES[i] for i in k], "certainty": p[np.arange(len(k)), k]})

    return points.mapInPandas(judge, f"{id_col} bigint, doc_class string, certainty double")


def found_classes(documents: DataFrame) -> DataFrame:
    """Documents that are no prose, with their class."""
    return classified(documents).where(F.col("doc_class") != "prose").select("doc_id", "doc_class").distinct()
