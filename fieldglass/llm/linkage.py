"""Probabilistic record linkage of two sources without a common key.

Records that agree in every attribute are one profile with a count. Profiles
are compared only where one of several blocking keys agrees. Each compared pair
becomes a vector of agreement levels, one per attribute; the vectors' counts
(few, whatever the number of pairs) are all that expectation maximisation needs
to estimate how often matches and non-matches agree. The posterior of a pair's
vector is its confidence. Pairs are then settled one to one, mutual best first.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.session import cut


def profiles(records: DataFrame, attributes: list[str], parts: int = 64) -> tuple[DataFrame, DataFrame]:
    """(profiles, members): distinct attribute values as `id`, the attributes and `n`; and (id, member, rank) of the records, `member` being their own `id`.

    Ranks run from 0 within a profile in `parts` hashed slices, so a profile may
    hold any share of the records. Array attributes must be sorted.
    """
    keyed = records.select(F.xxhash64(*attributes).alias("id"), F.col("id").alias("member"), *attributes)
    one = keyed.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in attributes])
    slim = keyed.select("id", "member", F.pmod(F.xxhash64("member"), F.lit(parts)).alias("part"))
    before = Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = slim.groupBy("id", "part").agg(F.count(F.lit(1)).alias("c")).withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("id", "part").orderBy("member")) - 1
    members = slim.withColumn("r", rank).join(offset.select("id", "part", "offset"), ["id", "part"]).select("id", "member", (F.col("r") + F.col("offset")).alias("rank"))
    return one, members


def _meet(left: DataFrame, right: DataFrame, key: Column) -> DataFrame:
    """Pairs of equal key, the attributes with the suffixes _a and _b."""
    side = lambda df, tag: df.withColumn("_k", key).select("_k", F.col("id").alias(tag), *[F.col(c).alias(f"{c}_{tag}") for c in df.columns if c not in ("id", "keys")])
    return side(left, "a").join(side(right, "b"), "_k").drop("_k")


def candidate_pairs(left: DataFrame, right: DataFrame, compare: Callable[[DataFrame], DataFrame], levels: list[str]) -> DataFrame:
    """(a, b, n_a, n_b and the levels) of pairs that share a blocking key, once each, however many keys they share.

    left and right have `id`, `n`, `keys` (array of bigint) and attributes;
    compare adds the levels to pairs with these attributes' suffixed columns.
    """
    met = compare(_meet(left, right, F.explode("keys"))).select("a", "b", "n_a", "n_b", *levels)
    return met.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("n_a", "n_b", *levels)])  # all rows of a pair are equal


def random_pairs(left: DataFrame, right: DataFrame, compare: Callable[[DataFrame], DataFrame], per_record: int = 8) -> DataFrame:
    """The levels of each left record with about `per_record` right ones that hashing throws together. Linear in the records."""
    buckets = max(1, right.count() // per_record)
    return compare(_meet(left, right, F.pmod(F.xxhash64("id"), F.lit(buckets))))


def fit(candidates: list[tuple[tuple[int, ...], float]], others: list[tuple[tuple[int, ...], float]], sizes: list[int], start: list[list[float]], all_pairs: float, rounds: int = 500) -> dict[tuple[int, ...], float]:
    """Posterior of a match for every vector of agreement levels among the candidates.

    candidates: vectors of the compared pairs with their counts; others: those
    of random pairs, which stand for all pairs that were not compared and get
    the weight of these; sizes: levels by attribute; start: what the matches'
    level probabilities start from; those of non-matches start from the random
    pairs. The level probabilities of both classes and the share of matches are
    re-estimated from all pairs until the posteriors settle.
    """
    x = np.array([p for p, _ in [*candidates, *others]], dtype=int).reshape(-1, len(sizes))
    n, w = len(candidates), np.array([c for _, c in [*candidates, *others]], dtype=float)
    if others:
        w[n:] *= max(all_pairs - w[:n].sum(), 1.0) / w[n:].sum()
    count = lambda j, weights: np.bincount(x[:, j], weights=weights, minlength=sizes[j]) + 0.5
    m = [np.array(s, dtype=float) / sum(s) for s in start]
    apart = np.concatenate([np.zeros(n), np.ones(len(others))]) * w
    u = [count(j, apart) / count(j, apart).sum() for j in range(len(sizes))]
    share = min(0.5, w[:n].sum() / 2 / max(w.sum(), 1))
    post = np.zeros(len(w))
    for _ in range(rounds):
        evidence = sum(np.log(m[j][x[:, j]]) - np.log(u[j][x[:, j]]) for j in range(len(u)))
        new = 1 / (1 + np.exp(-np.clip(evidence + np.log(share) - np.log(1 - share), -700, 700)))
        settled = np.abs(new - post).max(initial=0) < 1e-9
        post = new
        if settled:
            break
        share = float(np.clip((w * post).sum() / max(w.sum(), 1), 1e-15, 0.5))
        for j in range(len(u)):
            a, b = count(j, w * post), count(j, w * (1 - post))
            m[j], u[j] = a / a.sum(), b / b.sum()
    return {tuple(int(v) for v in row): float(q) for row, q in zip(x[:n], post[:n], strict=True)}


def score(compared: DataFrame, by_chance: DataFrame, attributes: dict[str, list[float]], all_pairs: float) -> DataFrame:
    """Adds `confidence` to compared pairs.

    Both tables hold agreement levels 0, 1, .. in the attribute columns, for
    candidate and for random pairs; attributes maps each column to what the
    matches' level probabilities start from. Without candidates no rows.
    """
    names = list(attributes)
    vectors = lambda df: [(tuple(r[n] for n in names), r["_n"]) for r in df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).collect()]
    found = vectors(compared)
    post = fit(found, vectors(by_chance), [len(v) for v in attributes.values()], list(attributes.values()), all_pairs) if found else {}
    schema = ", ".join(f"{n} int" for n in names) + ", confidence double"
    known = compared.sparkSession.createDataFrame([(*k, v) for k, v in post.items()], schema)
    return compared.join(F.broadcast(known), names)  # as many rows as there are vectors of levels


def settle(scored: DataFrame, order: list[str]) -> DataFrame:
    """(a, b, confidence, from_a, from_b, pairs): again and again, pairs that are the best of both their profiles are taken and what is used up dropped.

    scored: a, b, n_a, n_b (records of each profile), `confidence` and the order
    columns, which rank pairs of equal confidence, ascending; a hash of the two
    decides the rest, which settles chains of ties in few rounds, and the result
    does not depend on the order of rows. A pair taken links `pairs` records of
    either side, those of rank from_a and from_b on. Every round takes at least
    one pair, so rounds end by themselves.
    """
    best = F.struct("confidence", *[(-F.col(c)).alias(c) for c in order], F.xxhash64("a", "b").alias("h"), "a", "b")
    mine = lambda c: F.max("_r").over(Window.partitionBy(c)) == F.col("_r")
    mark = lambda df: cut(df.withColumn("_r", best).withColumn("_x", mine("a")).withColumn("_y", mine("b")).withColumn("taken", F.col("_x") & F.col("_y")).drop("_r", "_x", "_y"))
    marked = mark(scored.select("a", "b", "confidence", *order, F.col("n_a").alias("left_a"), F.col("n_b").alias("left_b"), F.lit(0).cast("bigint").alias("from_a"), F.lit(0).cast("bigint").alias("from_b")))
    out = ["a", "b", "confidence", "from_a", "from_b", F.least("left_a", "left_b").alias("pairs")]
    done = marked.filter("taken").select(*out)
    while True:
        used = marked.filter("taken").select("a", "b", F.least("left_a", "left_b").alias("t"))
        rest = marked.filter("not taken").join(used.select("a", F.col("t").alias("t_a")), "a", "left").join(used.select("b", F.col("t").alias("t_b")), "b", "left").fillna(0, ["t_a", "t_b"])
        rest = rest.withColumns({"left_a": F.col("left_a") - F.col("t_a"), "left_b": F.col("left_b") - F.col("t_b"), "from_a": F.col("from_a") + F.col("t_a"), "from_b": F.col("from_b") + F.col("t_b")}).drop("t_a", "t_b", "taken")
        marked = mark(rest.filter("left_a > 0 and left_b > 0"))
        if marked.isEmpty():
            return done
        done = done.unionByName(marked.filter("taken").select(*out))


def linked(settled: DataFrame, members_a: DataFrame, members_b: DataFrame) -> DataFrame:
    """(a, b, confidence) of records, from settled profiles and their members."""
    s = settled.withColumn("_link", F.xxhash64("a", "b"))
    a = members_a.select(F.col("id").alias("a"), F.col("member").alias("_ma"), F.col("rank")).join(s, "a").filter((F.col("rank") >= F.col("from_a")) & (F.col("rank") < F.col("from_a") + F.col("pairs")))
    a = a.select("b", (F.col("rank") - F.col("from_a") + F.col("from_b")).alias("rank"), "_ma", "confidence")
    return a.join(members_b.select(F.col("id").alias("b"), F.col("member").alias("_mb"), "rank"), ["b", "rank"]).select(F.col("_ma").alias("a"), F.col("_mb").alias("b"), "confidence")
