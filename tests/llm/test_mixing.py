import random

from pyspark.sql import functions as F

from parlance.llm import mixing
from tests.conftest import rows

DOCS, PLANS = "doc_id bigint, source string, text string", "plan_name string, source string, target_share double, max_repeats bigint"


def corpus(spark, n=3000):
    r = random.Random(6)
    return spark.createDataFrame([(i, r.choice(["big", "BIG ", "mid size", "mid_size", "Mid-Size"]) if i % 60 else "small", "word " * r.randint(1, 30)) for i in range(n)], DOCS)


def test_shares_and_caps(spark):
    d = corpus(spark)
    plans = spark.createDataFrame([("even", "big", 0.4, 1), ("even", "mid_size", 0.4, 2), ("even", "small", 0.2, 4), ("even", "gone", 0.0, 1), ("large", "small", 0.5, 1), ("large", "big", 0.5, 1), ("large", "missing", 0.3, 9)], PLANS)
    chosen, shares = mixing.replicated(d, plans)
    got = {(r.plan_name, r.source): r for r in shares.collect()}
    assert all(abs(got["even", s].share - t) < 0.01 for s, t in (("big", 0.4), ("mid_size", 0.4), ("small", 0.2), ("gone", 0.0)))
    assert abs(got["large", "big"].share - 0.5) < 0.01 and got["large", "missing"].taken_tokens == 0
    assert got["even", "small"].taken_tokens == 4 * got["even", "small"].source_tokens
    most = {(r.plan_name, r.source): r.m for r in chosen.groupBy("plan_name", "source").agg(F.max("repeats").alias("m")).collect()}
    assert most["even", "big"] == 1 and most["even", "small"] == 4
    assert rows(chosen) == rows(mixing.replicated(d.repartition(7), plans)[0])
    out = mixing.shuffled(chosen).collect()
    assert len(out) == chosen.agg(F.sum("repeats")).first()[0]
    firsts = [x.source for x in out if x.plan_name == "even"][:200]
    assert len(set(firsts)) == 3


def test_size_of_a_mixture(spark):
    plans = spark.createDataFrame([("p", "big", 0.5, 3), ("p", "mid_size", 0.5, 3)], PLANS)
    shares = mixing.replicated(corpus(spark), plans, most_tokens=5000)[1].collect()
    assert abs(sum(r.taken_tokens for r in shares) - 5000) < 100 and all(abs(r.share - 0.5) < 0.02 for r in shares)
    checks = mixing.checked(*mixing.replicated(corpus(spark), plans)).collect()
    assert len(checks) == 2 and all(r.within_cap and r.whole for r in checks)


def test_vocabulary_travels():
    import pickle

    with open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb") as f:
        known = pickle.loads(pickle.dumps(mixing.Vocabulary(f.read())))
    assert known.sizes(["Hello world", "", "a"]) == [2, 0, 1]


def test_counts_are_poisson():
    import numpy as np

    bins = np.ones(4096)
    rate = mixing.rate_for(bins, 0.7 * 4096, 9)
    assert abs(rate - 0.7) < 0.01
    cuts = mixing.thresholds(rate, 9)
    assert abs(cuts[0] - np.exp(-rate)) < 1e-12 and cuts == sorted(cuts)
    assert mixing.rate_for(bins, 5 * 4096, 5) == float("inf") and mixing.rate_for(bins, 0, 5) == 0


def test_edges(spark):
    plans = spark.createDataFrame([("p", "a", 1.0, 1), ("p", "a", 0.5, 1), (None, "a", 1.0, 1), ("p", None, 1.0, 1), ("q", "b", None, None)], PLANS)
    d = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, None, "x"), (3, "a", None), (4, "a", ""), (None, "A", "y z"), (5, "a", "long " * 200_000)], DOCS)
    chosen, shares = mixing.replicated(d.withColumn("tokens", F.lit(1)).withColumn("u", F.lit(2)), plans)
    assert {r.doc_id for r in chosen.collect()} == {1, None, 5} and shares.count() == 2
    chosen, shares = mixing.replicated(spark.createDataFrame([], DOCS), plans)
    assert rows(chosen) == [] and all(r.share == 0 for r in shares.collect())
    chosen, shares = mixing.replicated(d, spark.createDataFrame([], PLANS))
    assert rows(chosen) == [] and rows(shares) == []
