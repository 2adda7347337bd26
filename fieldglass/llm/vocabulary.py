"""What the words of names mean, learned from the names: which are common, which may be left out, which are short for others.

A word is judged by its contexts: the other words of the names it stands in,
by scope. Nothing is listed by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.session import cut

#: A common word stands in so many contexts of so many scopes, or in so many contexts of any.
CONTEXTS, SCOPES, MANY = 4, 3, 30
#: A common word may be left out if at least this share of its contexts (of so many at least) are names as well.
OPTIONAL_SHARE, OPTIONAL_CONTEXTS = 0.03, 8
#: A word is short for a more frequent one found in at least this share of its contexts.
SHORT_SHARE = 0.15


def bag_text(words: Column) -> Column:
    return F.array_join(F.array_sort(words), " ")


def contexts(bags: DataFrame) -> DataFrame:
    """(scope, word, rest, dotted): each word of each distinct bag of words with what stands beside it, and whether it ends in a dot whenever it does."""
    each = bags.select("scope", "words").distinct().select("scope", "words", F.posexplode("words").alias("_i", "word"))
    rest = F.expr("array_join(filter(words, (x, i) -> i <> _i), ' ')")
    return each.select("scope", F.rtrim(F.col("word"), F.lit(".")).alias("word"), rest.alias("rest"), F.endswith("word", F.lit(".")).alias("dotted")).groupBy("scope", "word", "rest").agg(F.min("dotted").alias("dotted"))


def learn(bags: DataFrame) -> DataFrame:
    """(word, common, optional, meant) of the words that are common or short for a common one.

    bags: `scope`, `words` (sorted array). meant: the common word it is short
    for or a misspelling of, itself for most. A short form begins with the same
    letter and has its letters in the same order; a misspelling is within two
    edits (one if it is common itself or has but five letters). The common word
    found in most of its contexts counts, if these are SHORT_SHARE of them and
    twice as many as those of the next. No names give no rows.
    """
    seen = cut(contexts(bags))
    by_scope = seen.groupBy("word", "scope").agg(F.count_if(~F.col("dotted")).alias("n"))
    count = by_scope.groupBy("word").agg(F.sum("n").alias("contexts"), F.count_if(F.col("n") > 0).alias("scopes"))
    common = ((F.col("contexts") >= CONTEXTS) & (F.col("scopes") >= SCOPES)) | (F.col("contexts") >= MANY)  # words cut off by a dot are not
    names = bags.select("scope", F.array_join("words", " ").alias("rest")).distinct()
    alone = seen.filter("rest <> ''").join(names, ["scope", "rest"], "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("alone"))
    optional = common & (F.coalesce("alone", F.lit(0)) >= F.col("contexts") * OPTIONAL_SHARE) & (F.col("contexts") >= OPTIONAL_CONTEXTS)
    known = cut(count.join(alone, "word", "left").select("word", common.alias("common"), optional.alias("optional")))

    # short forms: words in the contexts of common ones, optional words aside
    spare = known.filter("optional").agg(F.collect_list("word").alias("_o"))  # one row: legal affixes and the like
    kept = F.expr("filter(transform(split(rest, ' '), x -> rtrim('.', x)), x -> not array_contains(_o, x))")
    firm = seen.join(known.filter("not optional").select("word", "common"), "word").crossJoin(F.broadcast(spare))
    firm = firm.select("scope", "word", "common", F.array_join(kept, " ").alias("rest"), F.substring("word", 1, 1).alias("initial")).distinct()
    sizes = firm.groupBy("word").agg(F.count(F.lit(1)).alias("size"))
    short, full = firm.withColumnsRenamed({"word": "s", "common": "frequent"}), firm.filter("common").select("scope", "rest", "initial", F.col("word").alias("w"))
    inside = F.expr("w like concat(array_join(split(s, ''), '%'), '%')") & (F.length("s") < F.length("w"))
    typed = ((F.length("s") >= 5) & (F.levenshtein("s", "w", 1) == 1)) | (~F.col("frequent") & (F.length("s") >= 6) & (F.levenshtein("s", "w", 2) == 2))
    votes = short.join(full, ["scope", "rest", "initial"]).filter("s <> w").filter(inside | typed).groupBy("s", "w").agg(F.count(F.lit(1)).alias("votes"))
    size = lambda c: sizes.select(F.col("word").alias(c), F.col("size").alias(f"size_{c}"))
    votes = votes.join(size("s"), "s").join(size("w"), "w").filter(F.col("size_w") > F.col("size_s"))
    best = votes.groupBy("s", "size_s").agg(F.max_by("w", F.struct("votes", "size_w", "w")).alias("w"), F.sort_array(F.collect_list("votes"), asc=False).alias("v"))  # at most as many as there are common words
    best = cut(best.filter((F.col("v")[0] >= F.col("size_s") * SHORT_SHARE) & (F.col("v")[0] >= 2 * F.coalesce(F.get("v", F.lit(1)), F.lit(0)))).select("s", "w"))
    chain = best.join(best.select(F.col("s").alias("w"), F.col("w").alias("v")), "w", "left").select(F.col("s").alias("word"), F.coalesce("v", "w").alias("w"))
    return cut(known.join(chain, "word", "left").filter("common or w is not null").select("word", "common", "optional", F.coalesce("w", "word").alias("meant")))
