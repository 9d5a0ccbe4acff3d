"""Segments of a transcript: one row per delivery, defaults, speakers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import first_filled

LAST = 2**63 - 1
#: A label that names a speaker by number, in any spelling; RE2 reads it in the same way.
NUMBERED = r"(?i)^\W*(?:speaker|spk)[\W_]*?0*(\d+)\W*$"


def delivered_once(segments: DataFrame, *payload: Column, key=("session_id", "pos"), version: str = "seg_id") -> DataFrame:
    """One row per key with the payload of the smallest version; the rest of the columns go.

    Of rows with equal versions the smallest payload counts, of null versions any other comes first; null
    keys form keys of their own. The partial minimum runs before the shuffle, on keys that hold a row each.
    """
    best = F.min(F.struct(F.coalesce(F.col(version), F.lit(LAST)).alias("_v"), *payload)).alias("_best")
    return segments.groupBy(*key).agg(best).select(*key, "_best.*").drop("_v")


def usable() -> Column:
    """Both times given and the end after the start; NaN is no time."""
    s, e = F.col("start_s"), F.col("end_s")
    return s.isNotNull() & e.isNotNull() & ~F.isnan(s) & ~F.isnan(e) & (e > s)


def stored_label(speaker: Column) -> Column:
    return first_filled(speaker, "UNKNOWN")


def milliseconds(seconds: Column) -> Column:
    return F.round(seconds * 1000).cast("bigint")


def number_label(digits: Column) -> Column:
    """SPEAKER_ and the number with at least two digits."""
    return F.concat(F.lit("SPEAKER_"), F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits))


def numbered(label: Column) -> Column:
    """The unified label of a numbered one, UNKNOWN for null or empty, null for labels that are names."""
    digits = F.regexp_extract(label, NUMBERED, 1)
    return F.when(label.isNull() | (label == ""), F.lit("UNKNOWN")).when(digits != "", number_label(digits))


def name_parts(text: str) -> tuple[str, str] | None:
    """Given and family part of a name in lower case; "Family, Given", roles in brackets and initials are understood."""
    bare = text.split("(")[0].lower()
    if "," in bare:
        family, _, given = bare.partition(",")
        words = [*given.split(), *family.split()]
    else:
        words = bare.split()
    words = [w.strip("[]:;.\"'") for w in words]
    words = [w for w in words if w]
    return (words[0], words[-1]) if len(words) > 1 else None


def room(longer: int) -> int:
    """The letters two spellings of a name may differ in, by the longer one's length: one in seven, two at most;
    none in names of more than forty letters."""
    return min(2, longer // 7) if longer <= 40 else 0


def alike(a: str, b: str) -> bool:
    """Equal, or no more letters changed, added or lost than there is room for."""
    if a == b:
        return True
    most = room(max(len(a), len(b)))
    if not most or abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1] <= most


def shortened(word: str) -> set[str]:
    """The word and what is left of it without as many letters as it has room for. Two words that are alike share
    one of these, since each loses what the other lacks."""
    out = {word}
    for _ in range(room(len(word))):
        out |= {w[:i] + w[i + 1 :] for w in out for i in range(len(w))}
    return out


class Clusters:
    """Union-find in which a cluster takes the number of one known speaker at most."""

    def __init__(self, numbers: list[str | None]):
        self.parent, self.number = list(range(len(numbers))), list(numbers)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j and (self.number[i] is None or self.number[j] is None or self.number[i] == self.number[j]):
            i, j = min(i, j), max(i, j)
            self.parent[j] = i
            self.number[i] = self.number[i] or self.number[j]


def cluster_names(labels: list[str], numbers: list[str | None]) -> list[str]:
    """For each label of one transcript the speaker it belongs to.

    labels are distinct spellings, numbers the known speaker of those that are display names. Spellings meet
    only others with the same initials: first equal ones, then abbreviations that fit one given name alone,
    then names that differ by a letter, which meet where they share a shortened form and not pair by pair. A
    cluster without a known speaker is named by its longest spelling.
    """
    parts = [name_parts(x) for x in labels]
    clusters = Clusters(numbers)
    blocks: dict[tuple[str, str], dict[tuple[str, str], list[int]]] = {}
    same: dict[str, list[int]] = {}
    for i, p in enumerate(parts):
        if p is None:
            same.setdefault(" ".join(labels[i].lower().split()), []).append(i)
        else:
            blocks.setdefault((p[0][0], p[1][0]), {}).setdefault(p, []).append(i)
    for group in [*same.values(), *(g for b in blocks.values() for g in b.values())]:
        for i in group[1:]:
            clusters.join(group[0], i)
    for block in blocks.values():
        full = [p for p in block if len(p[0]) > 1]
        by_family: dict[str, list[tuple[str, str]]] = {}
        for q in full:
            by_family.setdefault(q[1], []).append(q)
        for p in block:
            if len(p[0]) == 1 and len(fits := by_family.get(p[1], [])) == 1:
                clusters.join(block[fits[0]][0], block[p][0])
        near: dict[tuple[str, str], list[int]] = {}
        pairs = set()
        for k, p in enumerate(full):
            for given in shortened(p[0]):
                for family in shortened(p[1]):
                    met = near.setdefault((given, family), [])
                    pairs.update((j, k) for j in met)
                    met.append(k)
        for j, k in sorted(pairs):
            if alike(full[j][0], full[k][0]) and alike(full[j][1], full[k][1]):
                clusters.join(block[full[j]][0], block[full[k]][0])
    longest: dict[int, str] = {}
    for i, x in enumerate(labels):
        root, tidy = clusters.find(i), " ".join(x.split())
        if (len(tidy), tidy) > (len(longest.get(root, "")), longest.get(root, "")):
            longest[root] = tidy
    return [clusters.number[clusters.find(i)] or longest[clusters.find(i)] for i in range(len(labels))]


def name_table(labelled: DataFrame, speaker_names: DataFrame) -> DataFrame:
    """(session_id, label, speaker) for every label that is a name; labelled needs session_id and label, null where
    the label is none.

    Distinct labels only are shuffled, and a task streams through sorted transcripts, one at a time in
    memory: its distinct spellings, whose number follows its speakers and not its rows.
    """
    names = labelled.where(F.col("label").isNotNull()).select("session_id", "label").distinct()
    known = speaker_names.where(F.col("display_name").isNotNull() & (F.trim("display_name") != "")).groupBy("session_id", F.col("display_name").alias("label")).agg(F.min(numbered(F.col("speaker"))).alias("speaker"))
    both = names.withColumn("known", F.lit(None).cast("string")).withColumn("asked", F.lit(True)).unionByName(known.withColumnRenamed("speaker", "known").withColumn("asked", F.lit(False)))
    ordered = both.repartition("session_id").sortWithinPartitions("session_id", "known", "label")

    def solve(frames):
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            key = frame["session_id"].fillna("\0").to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if cut:
                yield from (named(g) for _, g in frame[:cut].groupby(key[:cut], sort=False))
            held = frame[cut:]
        if held is not None and len(held):
            yield named(held)

    def named(group: pd.DataFrame) -> pd.DataFrame:
        known_by = {x: n for x, n, asked in zip(group["label"], group["known"], group["asked"]) if not asked and isinstance(n, str)}
        distinct = sorted(set(group["label"]))
        of = dict(zip(distinct, cluster_names(distinct, [known_by.get(x) for x in distinct])))
        asked = group[group["asked"]]
        return pd.DataFrame({"session_id": asked["session_id"], "label": asked["label"], "speaker": asked["label"].map(of)})

    return ordered.mapInPandas(solve, "session_id string, label string, speaker string")


def split_label(label: Column) -> list[Column]:
    """The columns speaker, the unified label of a numbered one, and label, the label where it is a name; one of
    them is null. Read once, where the rows lie."""
    speaker = numbered(label)
    return [speaker.alias("speaker"), F.when(speaker.isNull(), label).alias("label")]


def unified(rows: DataFrame, speaker_names: DataFrame) -> DataFrame:
    """rows with speaker and label of split_label; then with speaker alone: SPEAKER_nn, UNKNOWN, or for names nobody
    knows their longest spelling.

    Only rows whose label is a name meet the name table; numbered labels, nearly all rows, aren't shuffled.
    """
    found = name_table(rows, speaker_names)
    rest = [c for c in rows.columns if c not in ("speaker", "label")]
    met = rows.where(F.col("speaker").isNull()).alias("r").join(found.alias("n"), F.col("r.session_id").eqNullSafe(F.col("n.session_id")) & (F.col("r.label") == F.col("n.label")), "left").select(*[f"r.{c}" for c in rest], F.coalesce("n.speaker", "r.label").alias("speaker"))
    return rows.where(F.col("speaker").isNotNull()).drop("label").unionByName(met)
