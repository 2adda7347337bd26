"""Variant spellings of names: a pigeonhole segment join.

A name is a bag of words; which words are common, may be left out or are short
for others is learned from the names (vocabulary). Two names are near if all
their words but one agree and that one differs by up to k typing errors, so the
words beside it are its frame and the join runs within frames. The word is cut
into k+1 segments: k errors leave one of them whole, so every word within k
errors shares a segment, near the same place, with the word it was typed for.
The segments are an inverted index (with the characters on either side of a cut
also swapped, since one swap across a cut harms two segments); probes are the
substrings at shifted positions. Words cut off by a dot probe the same index,
in which words are also filed by their beginnings. Candidates are verified by a
banded edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.llm import vocabulary
from fieldglass.llm.components import components, forest_roots
from fieldglass.llm.editdistance import banded
from fieldglass.llm.names import words
from fieldglass.session import cut


def with_words(names: DataFrame, column: str = "name") -> DataFrame:
    """Adds words (sorted array) and side of the name column."""

    @F.pandas_udf("struct<words:array<string>,side:string>")
    def split(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([words(x) for x in s], columns=["words", "side"])

    return names.withColumn("_p", split(F.col(column))).select("*", "_p.*").drop("_p")


def cuts(size: int, k: int) -> list[tuple[int, int]]:
    """(start, length) of the k+1 segments of a text of that size; the later ones take the rest."""
    n = k + 1
    short, longer = size // n, size % n
    out, at = [], 0
    for i in range(n):
        length = short + (i >= n - longer)
        out.append((at, length))
        at += length
    return out


def index_keys(stem: str, k: int) -> list[str]:
    """Keys under which a word is filed: its length, segment number and segment, plain and with characters swapped across a cut; and its beginnings."""
    where = cuts(len(stem), k)
    keys = {f"{len(stem)}:{i}:{stem[s : s + n]}" for i, (s, n) in enumerate(where)}
    for i in range(1, len(where)):
        c = where[i][0]
        if 0 < c < len(stem):
            swapped = stem[: c - 1] + stem[c] + stem[c - 1] + stem[c + 1 :]
            keys |= {f"{len(stem)}:{j}:{swapped[where[j][0] : where[j][0] + where[j][1]]}" for j in (i - 1, i)}
    return sorted(keys | {f".:{stem[:i]}" for i in range(1, len(stem))})


def probe_keys(stem: str, k: int) -> list[str]:
    """Keys a word looks up: for every length up to k below its own, substrings at the places errors can shift a segment to; one that ends in a dot looks up what it begins."""
    if stem.endswith("."):
        return [f".:{stem[:-1]}"]
    keys = set()
    for size in range(max(0, len(stem) - k), len(stem) + 1):
        gap = len(stem) - size
        for i, (s, n) in enumerate(cuts(size, k)):
            for shift in range(-((k - gap) // 2), (k + gap) // 2 + 1):
                at = s + shift
                if 0 <= at and at + n <= len(stem):
                    keys.add(f"{size}:{i}:{stem[at : at + n]}")
    return sorted(keys)


def near_pairs(stems: DataFrame, k: int = 2, slice_rows: int = 2_000) -> DataFrame:
    """(node_a, node_b, distance) of words of one `frame` within k typing errors, each pair once; distance is -1 where node_b's word, which ends in a dot, begins node_a's.

    stems: distinct `node`, `frame`, `stem`, and optionally `common`: two common
    words are never paired. Short words have empty segments and so meet all
    words of their frame that are as short; equal words are not paired. Nulls
    are ignored. The postings of a key with more than slice_rows of them are
    cut into slices, each with a copy of the key's probes.
    """
    common = F.col("common") if "common" in stems.columns else F.lit(False)
    stems = stems.select("node", "frame", "stem", common.alias("common")).dropna()

    def keyed(make, rows: DataFrame) -> DataFrame:  # noqa: ANN001
        @F.pandas_udf("array<string>")
        def f(s: pd.Series) -> pd.Series:
            return s.map(lambda t: make(t, k))

        return rows.withColumn("key", F.explode(f("stem"))).withColumn("key", F.xxhash64("frame", "key"))

    filed = keyed(index_keys, stems.filter(~F.endswith("stem", F.lit(".")))).select("key", F.col("node").alias("node_a"), F.col("stem").alias("stem_a"), F.col("frame").alias("frame_a"), F.col("common").alias("common_a"))
    asked = keyed(probe_keys, stems).select("key", F.col("node").alias("node_b"), F.col("stem").alias("stem_b"), F.col("frame").alias("frame_b"), F.col("common").alias("common_b"))
    hot = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows).select("key", F.ceil(F.col("n") / slice_rows).cast("int").alias("slices"))
    filed = filed.join(hot, "key", "left").withColumn("slice", F.coalesce(F.pmod(F.xxhash64("node_a"), "slices"), F.lit(0)).cast("int")).drop("slices")
    asked = asked.join(hot, "key", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))).drop("slices")
    begun = F.endswith("stem_b", F.lit("."))
    once = begun | (F.length("stem_a") < F.length("stem_b")) | ((F.length("stem_a") == F.length("stem_b")) & (F.col("stem_a") < F.col("stem_b")))
    pairs = filed.join(asked, ["key", "slice"]).filter((F.col("frame_a") == F.col("frame_b")) & once & ~(F.col("common_a") & F.col("common_b")))
    pairs = pairs.groupBy("node_a", "node_b").agg(F.first("stem_a").alias("stem_a"), F.first("stem_b").alias("stem_b"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            short = b.stem_b.str.endswith(".")
            d = pd.Series(banded(b.stem_a.tolist(), b.stem_b.tolist(), k), index=b.index)
            begins = [x.startswith(y[:-1]) for x, y in zip(b.stem_a, b.stem_b, strict=True)]
            d = d.where(~short, pd.Series([-1 if z else k + 1 for z in begins], index=b.index, dtype="int64"))
            yield pd.DataFrame({"node_a": b.node_a, "node_b": b.node_b, "distance": d})[d <= k]

    return pairs.mapInPandas(verify, "node_a bigint, node_b bigint, distance int")


def node_of(scope: Column, side: Column, bag: Column) -> Column:
    """A name's normal form as a 64-bit number."""
    return F.xxhash64(scope, side, bag)


def normal_forms(names: DataFrame) -> DataFrame:
    """Adds bag (sorted words, optional ones left out, short ones written out) and node to names with `scope`, `words`, `side`."""
    known = vocabulary.learn(names)
    each = names.withColumn("_id", F.xxhash64("scope", "name")).select("_id", F.explode("words").alias("word")).withColumn("bare", F.rtrim(F.col("word"), F.lit(".")))
    each = each.join(known.withColumnRenamed("word", "bare"), "bare", "left")
    meant = F.coalesce("meant", "word")
    bags = each.groupBy("_id").agg(F.collect_list(F.when(~F.coalesce("optional", F.lit(False)), F.struct(meant.alias("word"), F.coalesce("common", F.lit(False)).alias("common")))).alias("firm"), F.collect_list(F.struct(meant.alias("word"), F.coalesce("common", F.lit(False)).alias("common"))).alias("every"))
    bag = F.array_sort(F.when(F.size("firm") > 0, F.col("firm")).otherwise(F.col("every")))
    out = names.withColumn("_id", F.xxhash64("scope", "name")).join(bags.select("_id", bag.alias("bag")), "_id", "left").drop("_id", "words")
    return out.withColumn("text", F.coalesce(F.array_join("bag.word", " "), F.lit(""))).withColumn("node", F.when(F.col("text") == "", F.xxhash64("scope", "name", F.lit("="))).otherwise(node_of(F.col("scope"), F.col("side"), F.col("text"))))


def name_classes(names: DataFrame, aliases: DataFrame, k: int = 2, minimum: int = 4) -> DataFrame:
    """(scope, name, side, text, node, root, n): names of one scope with equal root mean the same entity.

    names: `scope`, `name`, `n` (how often), distinct by scope and name.
    aliases: `scope`, `name`, `other`: two names of one entity. Names without
    words stay alone. A word of fewer than `minimum` letters must agree exactly, and
    two common words never mean the same, near as they may be.

    Every normal form is linked to the best near one that is more frequent (nearest,
    then most frequent), so that a spelling goes to one entity only; one with a word
    cut off by a dot is linked where all forms with a word it begins belong together. A name that
    aliases give to several entities is linked to none.
    """
    al = aliases.filter("scope is not null and name is not null and other is not null")
    every = names.select("scope", "name", "n").unionByName(al.select("scope", "name", F.lit(0).cast("bigint").alias("n"))).unionByName(al.select("scope", F.col("other").alias("name"), F.lit(0).cast("bigint").alias("n")))
    every = cut(with_words(every.groupBy("scope", "name").agg(F.sum("n").alias("n"))))
    every = cut(normal_forms(every))
    forms = every.groupBy("node").agg(F.sum("n").alias("n"), F.first("scope").alias("scope"), F.first("side").alias("side"), F.first("bag").alias("bag"))
    each = forms.filter(F.size("bag") > 0).select("node", "n", "scope", "side", "bag", F.posexplode("bag").alias("_i", "_w"))
    frame = F.concat_ws("|", "scope", "side", F.expr("array_join(transform(filter(bag, (x, i) -> i <> _i), x -> x.word), ' ')"))
    stems = each.select("node", frame.alias("frame"), F.col("_w.word").alias("stem"), F.col("_w.common").alias("common"))
    pairs = cut(near_pairs(stems.filter((F.length("stem") >= minimum) | F.endswith("stem", F.lit("."))), k))
    weight = forms.select("node", "n")
    typed = pairs.filter("distance >= 0")
    both = typed.unionByName(typed.select(F.col("node_b").alias("node_a"), F.col("node_a").alias("node_b"), "distance"))
    both = both.join(weight.select(F.col("node").alias("node_a"), F.col("n").alias("n_a")), "node_a").join(weight.select(F.col("node").alias("node_b"), F.col("n").alias("n_b")), "node_b")
    up = both.filter((F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("node_b") < F.col("node_a"))))
    best = up.groupBy("node_a").agg(F.max_by("node_b", F.struct(-F.col("distance"), "n_b", "node_b")).alias("b")).select(F.col("node_a").alias("node"), "b")
    base = forest_roots(weight.select("node").join(best, "node", "left").select("node", F.coalesce("b", "node").alias("parent")))

    # words cut off by a dot
    short = pairs.filter("distance < 0").join(base.select(F.col("node").alias("node_a"), "root"), "node_a")
    short = short.groupBy(F.col("node_b").alias("node")).agg(F.min("root").alias("b"), F.max("root").alias("c")).filter("b = c").select("node", "b")
    labels = cut(base.join(short, "node", "left").select("node", F.coalesce("b", "root").alias("root")))

    # aliases: root to root, unless a name has several targets
    node = every.select("scope", "name", "node").join(labels, "node").select("scope", "name", "root")
    told = al.select("scope", "name", "other").join(node, ["scope", "name"]).join(node.select("scope", F.col("name").alias("other"), F.col("root").alias("b")), ["scope", "other"])
    told = told.groupBy("root").agg(F.min(F.when(F.col("b") != F.col("root"), F.col("b"))).alias("b"), F.max(F.when(F.col("b") != F.col("root"), F.col("b"))).alias("c")).filter("b = c").select(F.col("root").alias("a"), "b")
    joined = components(told).select(F.col("node").alias("root"), F.col("root").alias("top"))
    final = labels.join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return every.filter("n > 0").join(final, "node").select("scope", "name", "side", "text", "node", "root", "n")


def met_as(sightings: DataFrame, minimum_share: float = 0.6) -> DataFrame:
    """(root, meant): names that are another's, judged by whom they meet and when.

    sightings: `source`, `slot` (opponent, time and role), `side`, `root`. If
    one source has a name in a slot where another source has an entity of the
    same side, itself included, that is one vote; the one other entity with at
    least `minimum_share` of the name's votes is meant. Names without votes, or
    torn between entities, get no row; null slots don't count. Of two names
    that mean each other the one with fewer sightings is the other's.
    """
    s = sightings.filter("slot is not null").groupBy("source", "slot", "side", "root").agg(F.count(F.lit(1)).alias("n"))
    a = s.select("slot", "side", F.col("source").alias("s1"), "root")
    b = s.select("slot", "side", F.col("source").alias("s2"), F.col("root").alias("meant"))
    votes = a.join(b, ["slot", "side"]).filter("s1 <> s2").groupBy("root", "meant").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("root").agg(F.sum("n").alias("all"), F.max_by("meant", F.struct("n", "meant")).alias("meant"), F.max("n").alias("top"))
    best = best.filter((F.col("meant") != F.col("root")) & (F.col("top") >= F.col("all") * minimum_share)).select("root", "meant")
    much = s.groupBy("root").agg(F.sum("n").alias("n"))
    best = best.join(much, "root").join(much.select(F.col("root").alias("meant"), F.col("n").alias("m")), "meant")
    return best.filter((F.col("m") > F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("meant") < F.col("root")))).select("root", "meant")


def class_pairs(classes: DataFrame) -> DataFrame:
    """(scope, name_a, name_b): all pairs of different texts of one class, the lesser by code point first."""
    c = classes.select("scope", "root", "name").distinct()
    return c.join(c.select("scope", "root", F.col("name").alias("name_b")), ["scope", "root"]).filter(F.col("name") < F.col("name_b")).select("scope", F.col("name").alias("name_a"), "name_b")
