"""Joins with a policy. Join keys never match on null; the optimizer picks the strategy, and adaptive execution splits skewed keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pair_join(left: DataFrame, right: DataFrame, first: str, second: str, columns: list[str]) -> DataFrame:
    """Left outer join on a pair of keys, plus right rows whose second key is blank on the first key alone. `columns` are taken from the right."""
    r = right.select(first, second, *columns)
    both = left.join(r, [first, second])
    one = left.join(r.filter(F.coalesce(F.col(second), F.lit("")) == "").drop(second), first).filter(F.coalesce(F.col(second), F.lit("")) != "")
    hit = both.unionByName(one)
    keys = r.select(first, second).distinct()
    none = left.join(keys, [first, second], "left_anti").join(keys.filter(F.coalesce(F.col(second), F.lit("")) == "").select(first), first, "left_anti")
    return hit.unionByName(none, allowMissingColumns=True)


def margin_match(scored: DataFrame, left_id: str, right_id: str, score: str, *, least: float, margin: float, keep: int = 3) -> DataFrame:
    """Of scored candidates the best per left row: `status` is matched, ambiguous (two different right rows within the margin) or below.

    Equal scores go to the smaller right id; `candidates` lists the best few.
    """
    best = scored.groupBy(left_id, right_id).agg(F.max(score).alias(score))
    w = Window.partitionBy(left_id).orderBy(F.desc(score), F.asc(right_id))
    ranked = best.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.lead(score).over(w)).filter(F.col("_n") <= keep)
    out = ranked.groupBy(left_id).agg(
        F.min_by(right_id, "_n").alias(right_id), F.min_by(score, "_n").alias(score), F.min_by("_next", "_n").alias("_next"), F.transform(F.array_sort(F.collect_list(F.struct("_n", right_id))), lambda x: x[right_id]).alias("candidates")
    )
    status = F.when(F.col(score) < least, "below").when(F.col(score) - F.col("_next") < margin, "ambiguous").otherwise("matched")
    return out.withColumn("status", status).drop("_next")


def nearest_match(rows: DataFrame, row_id: str, keys: list[str], value: str, out: str, *, most: float, margin: float) -> DataFrame:
    """For each row the row of equal keys nearest in value: row_id, `out` (its id), `gap` and `status`, which is matched, ambiguous (the second nearest is less than the margin further) or below (the gap exceeds `most`).

    The answer of margin_match over all pairs of rows of equal keys, without the
    pairs: the rows of a value are its three least ids, and each value meets the
    two values on either side in the order of values. Where rounding or values
    that are no finite number leave the order of gaps open beyond these, the
    value meets all others of its keys. Equal gaps go to the smaller id, gaps of
    NaN and then of null come last; rows alone with their keys, and null keys,
    have no match. Ids must be unique.
    """
    own = rows.select(F.col(row_id).alias("_id"), *keys, F.col(value).alias("_v")).filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys], F.col("_id").isNotNull()))
    levels = own.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_v").orderBy("_id"))).filter("_n <= 3").groupBy(*keys, "_v").agg(F.array_sort(F.collect_list("_id")).alias("_ids"))

    def gap(level: Column) -> Column:
        d = F.abs(F.col("_v") - level["_v"])
        return F.struct(d.isNull().alias("none"), d.alias("gap"))

    def candidates(level: Column) -> Column:
        g = gap(level)
        return F.when(level.isNotNull(), F.transform(level["_ids"], lambda i: F.struct(g["none"].alias("none"), g["gap"].alias("gap"), i.alias("id"))))

    w = Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_last())
    level = F.struct("_v", "_ids")
    near = levels.withColumn("_0", level).withColumns({f"_{side.__name__}{i}": side(level, i).over(w) for side in (F.lag, F.lead) for i in (1, 2, 3)})
    near = near.withColumn("_open", reduce(lambda a, b: a | b, [F.coalesce(gap(F.col(f"_{s}3")) <= gap(F.col(f"_{s}1")), F.lit(False)) & F.col(f"_{s}3").isNotNull() for s in ("lag", "lead")]))
    close = F.flatten(F.filter(F.array(*[candidates(F.col(c)) for c in ("_0", "_lag1", "_lag2", "_lead1", "_lead2")]), lambda c: c.isNotNull()))
    some = near.filter("not _open").select(*keys, "_v", F.slice(F.array_sort(close), 1, 3).alias("_c"))
    wide = near.filter("_open").select(*keys, "_v").join(levels.select(*keys, level.alias("_other")), keys).select(*keys, "_v", F.explode(candidates(F.col("_other"))).alias("_c"))
    wide = wide.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_v").orderBy("_c"))).filter("_n <= 3").groupBy(*keys, "_v").agg(F.array_sort(F.collect_list("_c")).alias("_c"))
    found = some.unionByName(wide).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_v").alias("_w"), "_c")
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)], F.col("_v").eqNullSafe(F.col("_w")))
    others = own.join(found, same).select("_id", F.filter("_c", lambda c: c["id"] != F.col("_id")).alias("_c")).select("_id", F.get("_c", F.lit(0)).alias("_one"), F.get("_c", F.lit(1))["gap"].alias("_next")).filter("_one is not null")
    status = F.when(F.col("_one.gap") > most, "below").when(F.col("_next") - F.col("_one.gap") < margin, "ambiguous").otherwise("matched")
    return others.select(F.col("_id").alias(row_id), F.col("_one.id").alias(out), F.col("_one.gap").alias("gap"), status.alias("status"))


def lookup(left: DataFrame, right: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left join to a dimension with unique keys; missing attributes get their default."""
    joined = left.join(right.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def tiered_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[tuple[str, Column, Column]], last: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Tries equality of each tier's key (name, of the left, of the right) in order.

    A left row takes the first tier with exactly one right row. If an earlier
    or equal tier had several, the row is ambiguous; without any match it is
    unresolved. `last` is a further tier given as its (left_id, right_id) pairs,
    such as those of similar names. Gives left_id, right_id, tier, status, n_candidates (over all tiers tried).

    Right rows are counted by key before they meet the left, so a key shared by
    many rows of both sides makes no pairs; only left ids with several keys in a
    tier meet each right row of these, as a right id counts once.
    """
    found = None
    counts = [F.count_distinct(right_id).alias("_n"), F.min(right_id).alias(right_id)]
    each = left.filter(F.col(left_id).isNotNull()).groupBy(left_id).agg(*[F.collect_set(a).alias(f"_k{n}") for n, (_, a, _) in enumerate(tiers)]) if tiers else None
    for n, (name, _, b) in enumerate(tiers):
        keyed = right.select(right_id, b.alias("_k")).filter(F.col(right_id).isNotNull() & F.col("_k").isNotNull())
        keys = F.col(f"_k{n}")
        one = each.filter(F.size(keys) == 1).select(left_id, F.explode(keys).alias("_k")).join(keyed.groupBy("_k").agg(*counts), "_k")
        several = each.filter(F.size(keys) > 1).select(left_id, F.explode(keys).alias("_k")).join(keyed, "_k").groupBy(left_id).agg(*counts)
        part = one.select(left_id, "_n", right_id).unionByName(several).withColumns({"_t": F.lit(n), "tier": F.lit(name)})
        found = part if found is None else found.unionByName(part)
    if last is not None:
        part = last[1].groupBy(left_id).agg(*counts).withColumns({"_t": F.lit(len(tiers)), "tier": F.lit(last[0])})
        found = part if found is None else found.unionByName(part)
    single = F.when(F.col("_n") == 1, F.col("_t"))
    per = found.groupBy(left_id).agg(F.min_by(right_id, single).alias(right_id), F.min_by("tier", single).alias("tier"), F.min(single).alias("_one"), F.min(F.when(F.col("_n") > 1, F.col("_t"))).alias("_many"), F.sum("_n").alias("n_candidates"))
    clash = F.col("_many").isNotNull() & (F.col("_one").isNull() | (F.col("_many") < F.col("_one")))
    out = left.select(left_id).join(per, left_id, "left")
    return out.select(left_id, F.when(~F.coalesce(clash, F.lit(False)), F.col(right_id)).alias(right_id), F.when(~F.coalesce(clash, F.lit(False)), F.col("tier")).alias("tier"), F.when(clash, "ambiguous").when(F.col("_one").isNotNull(), "matched").otherwise("unresolved").alias("status"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))


def outer_with_status(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join with `join_status`: both, left_only or right_only."""
    joined = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), key, "full_outer")
    return joined.withColumn("join_status", F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("both")).drop("_l", "_r")


def merge_feeds(feeds: list[DataFrame], key: str, base: list[str], maps: list[str]) -> DataFrame:
    """One row per key over several feeds: base columns take the last non-blank value in feed order, map columns are merged key by key, later feeds winning."""
    every = None
    for n, f in enumerate(feeds):
        part = f.withColumn("_f", F.lit(n))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    out = every.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col("_f"))).alias(c) for c in base])
    for m in maps:
        entries = every.select(key, "_f", F.explode(m).alias("_mk", "_mv")).groupBy(key, "_mk").agg(F.max_by("_mv", "_f").alias("_mv"))
        out = out.join(entries.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_mk", "_mv")))).alias(m)), key, "left")
    return out


def or_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: list[tuple[str, str]], out: str) -> DataFrame:
    """Right ids that agree in any of the key pairs, as a sorted array per left row: a union of equi-joins, each pair once."""
    found = None
    for a, b in keys:
        pairs = left.select(left_id, F.col(a).alias("_k")).join(right.select(right_id, F.col(b).alias("_k")), "_k").select(left_id, right_id)
        found = pairs if found is None else found.unionByName(pairs)
    lists = found.distinct().groupBy(left_id).agg(F.array_sort(F.collect_list(right_id)).alias(out))
    return left.select(left_id).join(lists, left_id, "left").withColumn(out, F.coalesce(out, F.array().cast("array<bigint>")))


def exact_then_fuzzy(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str, order: str, fuzzy: DataFrame, score: str, least: float) -> DataFrame:
    """Exact key first (the last right row by order wins), else the best fuzzy candidate of at least that score, else unmatched. fuzzy: left_id, right_id, score."""
    last = right.groupBy(key).agg(F.max_by(right_id, order).alias("_exact"))
    best = fuzzy.filter(F.col(score) >= least).groupBy(left_id).agg(F.max_by(right_id, F.struct(score, (-F.col(right_id)).alias("_n"))).alias("_fuzzy"))
    out = left.join(last, key, "left").join(best, left_id, "left")
    return out.select(left_id, F.coalesce("_exact", "_fuzzy").alias(right_id), F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_fuzzy").isNotNull(), "fuzzy").otherwise("unmatched").alias("how"))


def attach_merged(left: DataFrame, right: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """Left rows with the columns of the right rows of their key, merged from the most complete row on; `missing_feature` tells that there is none."""
    from fieldglass.operators.dedup import coalesce_merge

    merged = coalesce_merge(right.filter(F.col(key).isNotNull()), [key], columns, order, by_completeness=True).withColumn("_hit", F.lit(True))
    return left.join(merged, key, "left").withColumn("missing_feature", F.col("_hit").isNull()).drop("_hit")


def attach_first(left: DataFrame, right: DataFrame, key: str, order: list[str], columns: list[str], *, last: bool = False, inner: bool = False) -> DataFrame:
    """Left rows with the columns of the first right row of their key by order (the last on request); rows without one stay with nulls, or go with inner."""
    pick = F.max_by if last else F.min_by
    one = right.filter(F.col(key).isNotNull()).groupBy(key).agg(pick(F.struct(*columns), F.struct(*order)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in columns])
    return left.join(one, key, "inner" if inner else "left")


def attach_kinds(links: DataFrame, pages: DataFrame, key: str, kind: str, kinds: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One pass over pages for all kinds: columns `<kind>_<column>` of the last page of that key and kind, and `<kind>_collected`. Equal to a left join per kind."""
    picks = [F.max_by(c, F.when(F.col(kind) == k, F.struct(*order))).alias(f"{k}_{c}") for k in kinds for c in columns]
    had = [F.coalesce(F.bool_or(F.col(kind) == k), F.lit(False)).alias(f"{k}_collected") for k in kinds]
    out = links.join(pages.filter(F.col(key).isNotNull()).groupBy(key).agg(*picks, *had), key, "left")
    return out.fillna(False, [f"{k}_collected" for k in kinds])


def linked_or_self(rows: DataFrame, links: DataFrame, path: str, target: str) -> DataFrame:
    """Rows with `target` from the link of their path (the least, if it has several), else the path itself."""
    one = links.filter(F.col(path).isNotNull()).groupBy(path).agg(F.min(target).alias("_t"))
    return rows.drop(target).join(one, path, "left").withColumn(target, F.coalesce("_t", path)).drop("_t")


def in_families(taxonomy: DataFrame, entries: DataFrame, family: str, score: str, order: list[str], ok: Column) -> DataFrame:
    """Every family of the taxonomy with its number of entries and its representative: of those for which `ok` holds the one of greatest score (the first by order among equals), else the first other one."""
    e = entries.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    rank = F.struct((~F.col("_ok")).cast("int").alias("f"), F.when(F.col("_ok"), -F.col(score)).otherwise(0).alias("s"), *order)
    per = e.groupBy(family).agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct(*order), rank).alias("representative"), F.bool_or("_ok").alias("any_ok"))
    return taxonomy.join(per, family, "left").fillna(0, ["n"]).fillna(False, ["any_ok"])
