"""Schemas that drift between files: rescue-column ingestion and a list of changes.

Ingestion enforces a target schema; fields that are unknown or of another type
stay, as JSON, in a rescue column, so that typed columns and rescue column
together hold the inventory of every line. Changes from file to file are read
off that inventory, and so is which paths carry the values of which target
field; these are approved and promoted by replaying the rescued values into
typed columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.functions.ids import uuid_hex


def read_objects(lines: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds `fields` (map of name to variant): null where the line is no JSON object."""
    parsed = F.try_parse_json(F.col(payload))
    shaped = F.schema_of_variant(F.col("_v")).startswith("OBJECT")
    return lines.withColumn("_v", parsed).withColumn("fields", F.when(shaped, F.expr("cast(_v as map<string, variant>)"))).drop("_v")


def json_type(v: Column) -> Column:
    """string, number, boolean, object, array or null of a variant."""
    s = F.schema_of_variant(v)
    return F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "VOID", "null").otherwise("number")


def _fitting(v: Column, path: str, kind: str) -> Column:
    """The value at a path as `kind`, null where it does not cast; objects and arrays are no plain values (their cast to string would give JSON text)."""
    value = F.try_variant_get(v, path, kind)
    if kind.lower().startswith(("array", "map", "struct", "variant")):
        return value
    return F.when(~json_type(F.try_variant_get(v, path, "variant")).isin("object", "array"), value)


def _without(v: Column, steps: list[str | int]) -> Column:
    """The variant less what the steps (names, list positions) lead to, siblings kept; null if nothing is left."""
    if not steps:
        return F.lit(None).cast("variant")
    first, rest = steps[0], steps[1:]
    if isinstance(first, int):
        kept = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: F.when(i == first, _without(x, rest)).otherwise(x)), lambda x: x.isNotNull())
    else:
        kept = F.map_filter(F.transform_values(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, x: F.when(k == first, _without(x, rest)).otherwise(x)), lambda _, x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.to_variant_object(kept))


def kind_of(type_name: str) -> str:
    """The JSON type whose values a column of that type takes as they are."""
    name = type_name.lower().split("(")[0].split("<")[0]
    return {"string": "string", "boolean": "boolean", "array": "array", "map": "object", "struct": "object"}.get(name, "string" if name in ("date", "timestamp", "timestamp_ntz", "binary") else "number")


def ingest(lines: DataFrame, target: dict[str, str], *, payload: str = "payload", rescue: str = "_rescued") -> DataFrame:
    """One typed table: the other columns of `lines`, the target's columns, and the rescue column.

    target maps a field to its type. A field the target does not know, or a
    value of another JSON type or one that does not cast, is kept as JSON in
    the rescue column (an object of field to value, null if nothing was
    rescued), and so is a JSON null, whose typed column is null: no value is
    lost, nor that a field was there. An unreadable line gives nulls in all
    typed columns and the raw text under the key `_unreadable`; a null line
    gives nulls only. Columns of `lines` whose names clash with target fields
    are replaced by the latter.
    """
    df = read_objects(lines, payload).withColumn("_bad", F.col("fields").isNull() & F.col(payload).isNotNull())
    value = lambda f: F.element_at("fields", F.lit(f))
    typed = {f: F.when(json_type(value(f)) == kind_of(t), F.try_variant_get(value(f), "$", t)) for f, t in target.items()}
    df = df.drop(*target).withColumns(typed)
    fitting = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in target])) if target else F.array().cast("array<string>")
    keep = F.map_filter("fields", lambda k, _: ~F.array_contains("_fitting", k))
    saved = F.when(F.size("_keep") > 0, F.to_json("_keep")).when(F.col("_bad"), F.to_json(F.create_map(F.lit("_unreadable"), F.col(payload))))
    return df.withColumn("_fitting", fitting).withColumn("_keep", keep).withColumn(rescue, saved).drop("fields", "_fitting", "_keep", "_bad", payload)


def promote(table: DataFrame, column: str, kind: str, paths: list[str], *, rescue: str = "_rescued") -> DataFrame:
    """Replays rescued values into `column` (created if absent) and takes what was replayed out of the rescue column.

    paths are JSON paths into the rescued object (`$.a`, `$.a.b`, `$.a[0]`), tried
    in order where the column is null; a value that does not cast stays rescued,
    and so do the siblings of a value inside an object or list.
    """
    v = F.try_parse_json(F.col(rescue))
    had = F.col(column) if column in table.columns else F.lit(None).cast(kind)
    tries = [_fitting(F.col("_rv"), p, kind) for p in paths]
    df = table.withColumn("_rv", v).withColumn("_had", had)
    df = df.withColumn("_from", F.when(F.col("_had").isNull(), F.coalesce(*[F.when(t.isNotNull(), F.lit(p)) for t, p in zip(tries, paths, strict=True)])))
    df = df.withColumn(column, F.coalesce(F.col("_had"), *tries))
    rest = F.coalesce(*[F.when(F.col("_from") == p, _without(F.col("_rv"), [int(n) if n else k for k, n in re.findall(r"\.([^.\[]+)|\[(\d+)\]", p)])) for p in paths])
    return df.withColumn(rescue, F.when(F.col("_from").isNull(), F.col(rescue)).otherwise(F.to_json(rest))).drop("_rv", "_had", "_from")


def inventory(table: DataFrame, target: dict[str, str], *, rescue: str = "_rescued", plain: bool = False) -> DataFrame:
    """Adds `held`, the fields of each line of an ingested table: an array of (field, kind, value), value being a hash.

    It is null for unreadable and null lines. With plain, fields inside objects
    and first elements of lists count by their paths (`a.b`, `a[0]`), and only
    strings, numbers and booleans count.
    """
    v = F.try_parse_json(F.col(rescue))
    entry = lambda name, kind, text: F.struct(name.alias("field"), kind.alias("kind"), F.when(kind != "null", F.xxhash64(kind, text)).alias("value"))
    text = lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x))
    typed = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), entry(F.lit(f), F.lit(kind_of(t)), F.col(f).cast("string") if kind_of(t) in ("string", "boolean", "number") else F.to_json(f))) for f, t in target.items()]))
    df = table.withColumn("_v", v)
    df = df.withColumn("_m", F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.expr("cast(_v as map<string, variant>)")))
    saved = F.transform(F.map_entries("_m"), lambda e: entry(e["key"], json_type(e["value"]), text(e["value"])))
    if plain:
        inside = lambda e: F.transform(F.map_entries(F.try_variant_get(e["value"], "$", "map<string,variant>")), lambda i: entry(F.concat(e["key"], F.lit("."), i["key"]), json_type(i["value"]), text(i["value"])))
        first = lambda e: F.array(entry(F.concat(e["key"], F.lit("[0]")), json_type(F.try_variant_get(e["value"], "$[0]", "variant")), text(F.try_variant_get(e["value"], "$[0]", "variant"))))
        under = lambda e: F.when(json_type(e["value"]) == "object", inside(e)).when(json_type(e["value"]) == "array", first(e)).otherwise(F.array(entry(e["key"], json_type(e["value"]), text(e["value"]))))
        saved = F.filter(F.flatten(F.transform(F.map_entries("_m"), under)), lambda e: e["kind"].isin("string", "number", "boolean"))
    bad = F.coalesce(F.map_contains_key("_m", F.lit("_unreadable")), F.lit(False))
    held = F.when(~bad & (F.col("_m").isNotNull() | (F.size("_t") > 0)), F.concat("_t", F.coalesce(saved, F.array())))
    return df.withColumn("_t", typed).withColumn("held", held).drop("_v", "_m", "_t")


def _moves(held: DataFrame, *, feed: str, run: str, order: str, key: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(files, added, removed, retyped) and the pairs of vanished and new fields with equal values, from lines with `held`."""
    from fieldglass.session import cut

    base = held.filter(F.col(feed).isNotNull() & F.col(run).isNotNull()).select(F.col(feed).alias("feed"), F.col(run).alias("run_no"), F.col(order).alias("_line"), key_text(F.col(key)).alias("k"), "held")
    base = cut(base)
    files = base.select("feed", "run_no").distinct()
    files = files.withColumn("pos", F.row_number().over(Window.partitionBy("feed").orderBy("run_no"))).withColumn("last", F.max("pos").over(Window.partitionBy("feed")))
    files = cut(files)
    shown = base.select("feed", "run_no", F.explode("held").alias("h")).groupBy("feed", "run_no", F.col("h.field").alias("field"))
    fields = shown.agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("h.kind") != "null", F.col("h.kind")))), "+").alias("kinds")).join(files, ["feed", "run_no"])
    fields = fields.withColumn("kinds", F.when(F.col("kinds") != "", F.col("kinds")))
    w = Window.partitionBy("feed", "field").orderBy("pos")
    fields = fields.withColumn("fresh", F.coalesce(F.lag("pos").over(w) < F.col("pos") - 1, F.lit(True))).withColumn("streak", F.sum(F.col("fresh").cast("int")).over(w))
    before = Window.partitionBy("feed", "field", "streak").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    fields = cut(fields.withColumn("was", F.last("kinds", ignorenulls=True).over(before)).withColumn("next", F.lead("pos").over(w)).select("feed", "pos", "last", "field", "kinds", "was", "fresh", "next"))
    added = fields.filter("fresh and pos > 1").select("feed", "pos", "field")
    removed = fields.filter("pos < last and (next is null or next > pos + 1)").select("feed", (F.col("pos") + 1).alias("pos"), "field")
    retyped = fields.filter("not fresh and kinds <> was").select("feed", "pos", "field")

    # one fingerprint of a field's values by key, over the keys both files hold; equal fingerprints are equal values
    wanted = removed.groupBy("feed", "pos").agg(F.collect_set("field").alias("f")).join(added.groupBy("feed", "pos").agg(F.collect_set("field").alias("g")), ["feed", "pos"])
    touched = wanted.select("feed", "pos").unionByName(wanted.select("feed", (F.col("pos") - 1).alias("pos"))).distinct().join(files.select("feed", "pos", "run_no"), ["feed", "pos"])
    records = base.filter("held is not null and k is not null").join(touched, ["feed", "run_no"]).groupBy("feed", "pos", "k").agg(F.min_by("held", "_line").alias("held"))
    b = records.join(wanted.select("feed", "pos", "f", "g"), ["feed", "pos"])
    both = records.select("feed", (F.col("pos") + 1).alias("pos"), "k", F.col("held").alias("a")).join(b, ["feed", "pos", "k"])
    some = lambda side, names: F.transform(F.filter(side, lambda h: F.array_contains(names, h["field"]) & h["value"].isNotNull()), lambda h: F.struct(F.lit(side).alias("side"), h["field"].alias("field"), F.xxhash64("k", h["value"]).alias("x")))
    told = both.withColumnRenamed("held", "b").select("feed", "pos", F.explode(F.concat(some("a", "f"), some("b", "g"))).alias("e"))
    prints = told.groupBy("feed", "pos", "e.side", "e.field").agg(F.bit_xor("e.x").alias("print"), F.count(F.lit(1)).alias("n"))
    same = prints.filter("side = 'a'").select("feed", "pos", "print", "n", F.col("field").alias("f")).join(prints.filter("side = 'b'").select("feed", "pos", "print", "n", F.col("field").alias("g")), ["feed", "pos", "print", "n"])
    rank = lambda c: F.row_number().over(Window.partitionBy("feed", "pos", c).orderBy(F.desc("n"), "f", "g"))
    renamed = cut(same.withColumn("_a", rank("f")).withColumn("_b", rank("g")).filter("_a = 1 and _b = 1").select("feed", "pos", "f", "g", "n"))
    return files, added, removed, retyped, renamed


def key_text(c: Column) -> Column:
    """A record's key: a UUID however written, else the text itself."""
    return F.coalesce(uuid_hex(c), c)


def changes(table: DataFrame, target: dict[str, str], *, feed: str = "feed", run: str = "run_no", order: str = "line_no", key: str = "match_id", rescue: str = "_rescued") -> DataFrame:
    """(feed, run_no, change, field_before, field_after) of an ingested table against the feed's previous file.

    A file has a field if a readable line has it, in a typed column or rescued;
    its type is the set of JSON types of its non-null values, and a file with
    nulls only keeps the type the field had in the run of files before.
    `renamed` needs a vanished and a new field whose values are equal for all
    keys both files hold, an absent field counting as null, with at least one
    value that is not null; of several candidates the one with most values
    wins, and a name is used once. Unreadable lines count for the existence of
    a file only; of repeated keys in a file the first line counts; rows with a
    null feed or run are left out. The key is a target field.
    """
    files, added, removed, retyped, renamed = _moves(inventory(table, target, rescue=rescue), feed=feed, run=run, order=order, key=key)
    change = lambda df, name, f, g: df.select("feed", "pos", F.lit(name).alias("change"), f.alias("field_before"), g.alias("field_after"))
    added = added.join(renamed.select("feed", "pos", F.col("g").alias("field")), ["feed", "pos", "field"], "left_anti")
    removed = removed.join(renamed.select("feed", "pos", F.col("f").alias("field")), ["feed", "pos", "field"], "left_anti")
    out = change(renamed, "renamed", F.col("f"), F.col("g")).unionByName(change(removed, "removed", F.col("field"), F.lit(""))).unionByName(change(added, "added", F.lit(""), F.col("field"))).unionByName(change(retyped, "retyped", F.col("field"), F.col("field")))
    return out.join(files.select("feed", "run_no", "pos"), ["feed", "pos"]).select("feed", "run_no", "change", "field_before", "field_after")


def approved(table: DataFrame, target: dict[str, str], *, feed: str = "feed", run: str = "run_no", order: str = "line_no", key: str = "match_id", rescue: str = "_rescued", most: int = 100_000) -> dict[str, list[str]]:
    """For each target field the paths under which its values were seen to travel, from an ingested table.

    Where a plain path vanishes from one file to the next and another appears
    with the same values, these two are one field; so `a` becomes `b`, `a.at`
    or `a[0]`. A path is given to the target field that most of its pairs lead
    to, if these are twice those of the next. There are as many pairs as field
    names; more than `most` raise ValueError.
    """
    *_, renamed = _moves(inventory(table, target, rescue=rescue, plain=True), feed=feed, run=run, order=order, key=key)
    rows = renamed.groupBy("f", "g").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} pairs of field names")
    beside: dict[str, dict[str, int]] = {}
    for r in rows:
        for x, y in ((r.f, r.g), (r.g, r.f)):
            beside.setdefault(x, {})[y] = beside.get(x, {}).get(y, 0) + r.n
    owner = {f: f for f in target}
    while True:
        found = {}
        for path in sorted(beside.keys() - owner.keys()):
            votes: dict[str, int] = {}
            for other, n in beside[path].items():
                if other in owner:
                    votes[owner[other]] = votes.get(owner[other], 0) + n
            ranked = sorted(votes.items(), key=lambda v: (-v[1], v[0]))
            if ranked and (len(ranked) == 1 or ranked[0][1] >= 2 * ranked[1][1]):
                found[path] = ranked[0][0]
        if not found:
            break
        owner |= found
    return {f: sorted(p for p, o in owner.items() if o == f) for f in target}
