import random

import pytest

from parlance.operators.intervals import found_periods, speaker_periods
from tests.conftest import SEGMENTS, rows


def plain(segments):
    """Periods and gaps by sorting, one key after the other."""
    once = {}
    for s in segments:
        k = (s[1], s[2])
        if k not in once or s[0] < once[k][0]:
            once[k] = s
    keys = {}
    for s in once.values():
        if s[3] is not None and s[4] is not None and s[4] > s[3]:
            keys.setdefault((s[1], s[5] or "UNKNOWN"), []).append((s[3], s[4]))
    out = []
    for (entity, label), spans in keys.items():
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]), merged[-1][2] + 1)
            else:
                merged.append((a, b, 1))
        out += [(entity, label, "period", *m) for m in merged]
        out += [(entity, label, "gap", x[1], y[0], 0) for x, y in zip(merged, merged[1:])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("partitions", [1, 7])
def test_against_plain(spark, seed, partitions):
    r = random.Random(seed)
    data = []
    for i in range(400):
        start = r.randint(0, (60, 400, 4000, 9)[seed]) / 8
        data.append((i, "hot" if r.random() < 0.7 else r.choice(["a", None]), r.randint(0, 350), r.choice([start, start, start, None]), start + r.randint(-8, 60) / 8, r.choice(["A", "B", "", None]), "x"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows(speaker_periods(spark.createDataFrame(data, SEGMENTS))) == plain(data)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 5)


def test_one_long_interval_over_many_ranges(spark):
    data = [(0, "s", 0, 0.0, 10_000.0, "A", "x")] + [(i, "s", i, float(i), i + 0.5, "A", "x") for i in range(1, 300)]
    assert rows(speaker_periods(spark.createDataFrame(data, SEGMENTS))) == [("s", "A", "period", 0.0, 10_000.0, 300)]


def test_found_and_edges(spark):
    data = [(1, "s", 1, 0.0, 1.0, "A", None), (2, "s", 2, 1.0, 2.0, "A", None), (3, "s", 3, 602.0, 603.0, "A", None), (4, "s", 4, 1204.0, 1205.0, "A", None), (5, "s", 4, 2.0, 700.0, "A", None)]
    got = rows(found_periods(spark.createDataFrame(data, SEGMENTS)))
    assert got == [("s", "A", "gap", 2000, 602000), ("s", "A", "period", 0, 2000)]
    assert rows(found_periods(spark.createDataFrame([], SEGMENTS))) == []


def test_clashing_columns(spark):
    d = spark.createDataFrame([(1, "s", 1, 0.0, 1.0, None, None, "z", 1)], SEGMENTS + ", label string, part int")
    assert rows(speaker_periods(d)) == [("s", "UNKNOWN", "period", 0.0, 1.0, 1)]


def test_ties_over_many_ranges(spark):
    data = [(i, "s", i, 1.0, 2.0, "A", "x") for i in range(500)] + [(i, "s", i, 2.0, 3.0, "A", "x") for i in range(500, 900)]
    assert rows(speaker_periods(spark.createDataFrame(data, SEGMENTS))) == [("s", "A", "period", 1.0, 3.0, 900)]
