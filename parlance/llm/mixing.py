"""Problem 9: sources mixed to target shares of all tokens, by Poisson replication."""

from __future__ import annotations

import base64
import math
import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.sources.shared import written

#: Where the vocabulary files of public tokenizers lie.
TOKENIZERS = "/opt/tokenizers"
#: Bins of the uniform numbers of a source.
BINS = 4096


#: Fixed value: the published pattern that splits a text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary:
    """A byte-level tokenizer from the bytes of a file of ranks, which the driver reads and broadcasts, so that
    executors need no such file. Built when first asked, once a worker."""

    def __init__(self, raw: bytes):
        self.raw, self.made = raw, None

    def __getstate__(self):
        return self.raw

    def __setstate__(self, raw):
        self.__init__(raw)

    def sizes(self, texts: list[str]) -> list[int]:
        if self.made is None:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.raw.splitlines())}
            self.made = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return [len(self.made.encode_ordinary(t)) for t in texts]


def source_name(source: Column) -> Column:
    """The source in lower case, its parts joined by single underscores; null for null or blank."""
    tidy = F.regexp_replace(F.trim(F.lower(F.regexp_replace(source, r"[\s_-]+", " "))), " ", "_")
    return F.when(tidy != "", tidy)


def counted(documents: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, source, tokens): the size of every text in tokens of a public tokenizer, 0 for null and empty."""
    with open(os.path.join(tokenizers, vocabulary), "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(Vocabulary(f.read()))

    def count(frames):
        for frame in frames:
            n = shared.value.sizes([t if isinstance(t, str) else "" for t in frame["text"]])
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "source": frame["source"], "tokens": n})

    return documents.select("doc_id", source_name(F.col("source")).alias("source"), "text").mapInPandas(count, "doc_id bigint, source string, tokens bigint")


def tokens_above(bins: np.ndarray, x: float) -> float:
    """The tokens of texts whose uniform number is at least x, within a bin in proportion."""
    at = min(max(x, 0.0), 1.0) * len(bins)
    k = min(int(at), len(bins) - 1)
    return float(bins[k + 1 :].sum() + bins[k] * (k + 1 - at))


def rate_for(bins: np.ndarray, target: float, most: int) -> float:
    """The Poisson rate at which the texts, each repeated by its own uniform number and `most` times at most,
    come to the target; infinite where nothing less is enough."""
    if target <= 0:
        return 0.0
    if target >= most * bins.sum() * (1 - 1e-9):
        return math.inf
    taken = lambda rate: sum(tokens_above(bins, x) for x in thresholds(rate, most))
    low, high = 0.0, 1.0
    while taken(high) < target and high < 700:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if taken(middle) < target else (low, middle)
    return (low + high) / 2


def thresholds(rate: float, most: int) -> list[float]:
    """P(count <= k) for k below `most`: a uniform number has as many repeats as it has thresholds at or below it."""
    if math.isinf(rate):
        return [0.0] * most
    p, below, out = math.exp(-rate), 0.0, []
    for k in range(most):
        below += p
        out.append(min(below, 1.0))
        p *= rate / (k + 1)
    return out


def plan_rates(bins: dict[str, np.ndarray], plan: list[tuple[str, float, int]], most_tokens: float = math.inf) -> dict[str, list[float]]:
    """The thresholds per source of a plan of (source, target share, most repeats).

    The mixture is as large as every source can have its share without more repeats than it may, and has
    most_tokens tokens at most. Shares are
    taken relative to their sum. A source with a share but without any tokens is left out, its share missed.
    """
    whole = sum(max(0.0, s) for _, s, _ in plan)
    shares = [(n, s / whole, m) for n, s, m in plan if s > 0 and m > 0 and n in bins] if whole > 0 else []
    total = min((bins[n].sum() * m / s for n, s, m in shares), default=0.0)
    total = min(total, most_tokens)
    out: dict[str, list[float]] = {n: [] for n, _, _ in plan}
    for n, s, m in shares:
        out[n] = thresholds(rate_for(bins[n], total * s, m), m)
    return out


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from a hash, the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(p) if isinstance(p, str) else p for p in parts]), 11) / F.lit(float(1 << 53))


def replicated(documents: DataFrame, plans: DataFrame, seed: int = 17, tokenizers: str = TOKENIZERS, most_rows: int = 1000, most_tokens: float = math.inf) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares). chosen: (plan_name, doc_id, source, tokens, repeats) of the documents taken, with the
    number of times; shares: (plan_name, source, target_share, max_repeats, source_tokens, taken_tokens, share).

    Each document is repeated a Poisson number of times, cut off at max_repeats, by inverting the distribution
    at a uniform number from a hash of seed and doc_id, so that a rerun chooses the same. The rate of a source
    is the one at which its own documents, with their numbers, come to the target: it is solved on the tokens
    per bin of the numbers, summed over all documents, so the share is met and not on average alone.
    max_repeats 1 uses each document once at most, and a source at its limit is used whole.

    Spellings of a source are one, see source_name; a null source is in no plan; texts without a token are
    taken by no plan; plan rows of one plan and source beyond the first by max_repeats are ignored, as are
    null names; null shares and repeats are 0. Rows with equal ids are taken or left together. plans is a
    small fixed table, and more than most_rows rows raise an error; most_tokens bounds a mixture; the sizes gathered are one number per source of a plan.
    """
    spark = documents.sparkSession
    rows = plans.where(F.col("plan_name").isNotNull() & F.col("source").isNotNull()).groupBy("plan_name", source_name(F.col("source")).alias("source")).agg(F.min(F.struct(F.coalesce("max_repeats", F.lit(0)).alias("m"), F.coalesce("target_share", F.lit(0.0)).alias("s"))).alias("x")).select("plan_name", "source", "x.s", "x.m").limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows in the plans")
    wanted = sorted({r[1] for r in rows})
    texts = written(counted(documents, tokenizers).where(F.col("source").isin(wanted) & (F.col("tokens") > 0)), "sizes") if wanted else counted(documents, tokenizers).where(F.lit(False))
    u = uniform(F.lit(seed), "doc_id")
    texts = texts.withColumn("u", u)
    # one number per source of a plan and bin: bounded by most_rows times BINS, whatever the corpus
    bins: dict[str, np.ndarray] = {}
    for source, k, n in texts.groupBy("source", F.floor(F.col("u") * BINS).cast("int")).agg(F.sum("tokens")).collect():
        bins.setdefault(source, np.zeros(BINS))[k] = n
    table = []
    for name in sorted({r[0] for r in rows}):
        plan = [(r[1], float(r[2]), int(r[3])) for r in rows if r[0] == name]
        cuts = plan_rates(bins, plan, most_tokens)
        table += [(name, n, t, m, int(bins[n].sum()) if n in bins else 0, cuts[n]) for n, t, m in plan]
    rates = spark.createDataFrame(table, "plan_name string, source string, target_share double, max_repeats bigint, source_tokens bigint, thresholds array<double>")
    # as many rows as the plans have, a fixed small table
    told = texts.join(F.broadcast(rates.select("plan_name", "source", "thresholds").where(F.size("thresholds") > 0)), "source")
    chosen = told.withColumn("repeats", F.size(F.filter("thresholds", lambda p: p <= F.col("u"))).cast("bigint")).where(F.col("repeats") > 0).select("plan_name", "doc_id", "source", "tokens", "repeats")
    taken = chosen.groupBy("plan_name", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("taken_tokens"))
    sums = taken.groupBy("plan_name").agg(F.sum("taken_tokens").alias("all_tokens"))
    shares = rates.drop("thresholds").join(taken, ["plan_name", "source"], "left").join(sums, "plan_name", "left").select("plan_name", "source", "target_share", "max_repeats", "source_tokens", F.coalesce("taken_tokens", F.lit(0)).alias("taken_tokens"), F.coalesce(F.col("taken_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("share"))
    return chosen, shares


def shuffled(chosen: DataFrame, seed: int = 17) -> DataFrame:
    """Every repeat a row (plan_name, doc_id, source, tokens, repeat_no, shuffle_key), in the order of a hash over
    the whole mixture: ranges of the key are written by different tasks, so no task holds a plan."""
    rows = chosen.withColumn("repeat_no", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).drop("repeats").withColumn("repeat_no", F.col("repeat_no").cast("bigint"))
    return rows.withColumn("shuffle_key", F.xxhash64(F.lit(seed + 1), "plan_name", "doc_id", "repeat_no")).orderBy("plan_name", "shuffle_key", "doc_id")


def checked(chosen: DataFrame, shares: DataFrame) -> DataFrame:
    """(plan_name, source, max_repeats, within_cap, whole): whether no document is repeated more often than it may,
    and whether the shares of a plan that takes anything sum to 1."""
    most = chosen.groupBy("plan_name", "source").agg(F.max("repeats").alias("most"))
    sums = shares.groupBy("plan_name").agg(F.sum("share").alias("sum"))
    rows = shares.join(most, ["plan_name", "source"], "left").join(sums, "plan_name")
    return rows.select("plan_name", "source", "max_repeats", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_cap"), (F.abs(F.col("sum") - 1) < 1e-9).alias("whole"))
