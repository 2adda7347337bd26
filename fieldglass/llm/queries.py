"""Queries of the problems tagged llm, over the whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.functions.ids import uuid_hex, uuid_text
from fieldglass.llm import leakage, linkage, packing, splitting, survivors, variants
from fieldglass.operators import timestamps
from fieldglass.session import cut, table


def team_classes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(classes, rows): names of matches by country with the team they mean (`root`), and the match rows with instants."""
    matches = table(spark, d, "matches").withColumn("source", F.element_at(F.map_keys("source_urls"), 1))
    rows = cut(timestamps.to_instant(matches.select("match_id", "source", "country", "home_team", "away_team", "competition", "scheduled_kickoff", "timezone", "updated_at", "match_row"), "scheduled_kickoff", F.col("timezone")))  # parsed once, used by the fixtures below and by p2
    sides = F.explode(F.array("home_team", "away_team")).alias("name")
    names = matches.select(F.col("country").alias("scope"), sides).filter("scope is not null and name is not null").groupBy("scope", "name").agg(F.count(F.lit(1)).alias("n"))
    aliases = table(spark, d, "team_aliases").select(F.col("country").alias("scope"), F.col("alias").alias("name"), F.col("team").alias("other"))
    classes = cut(variants.name_classes(names, aliases))
    # a nickname, or a name typed past recognition, is settled by the fixtures it appears in
    seen = with_classes(rows.filter("instant_s is not null"), classes, ["root", "side"])
    slot = lambda role, other: F.xxhash64(F.lit(role), "instant_s", other)
    role = lambda r, own, other: F.struct(F.when(F.col(f"{other}_root").isNotNull(), slot(r, f"{other}_root")).alias("slot"), F.col(f"{own}_root").alias("root"), F.col(f"{own}_side").alias("side"))
    sightings = seen.select("source", F.explode(F.array(role("h", "home", "away"), role("a", "away", "home"))).alias("x")).select("source", "x.*")
    settled = variants.met_as(sightings)
    classes = classes.join(settled, "root", "left").withColumn("root", F.coalesce("meant", "root")).drop("meant")
    return cut(classes.select("scope", "name", "side", "text", "root")), rows


def with_classes(rows: DataFrame, classes: DataFrame, columns: list[str]) -> DataFrame:
    """Adds home_ and away_ copies of the class columns to match rows."""
    for side in ("home", "away"):
        own = classes.select(F.col("scope").alias("country"), F.col("name").alias(f"{side}_team"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        rows = rows.join(own, ["country", f"{side}_team"], "left")
    return rows


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    classes, _ = team_classes(spark, d)
    return variants.class_pairs(classes).withColumnRenamed("scope", "country")


def beginnings(c: F.Column) -> F.Column:
    """The first three letters of a text's words, sorted, without numbers and single letters."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"([a-z]{2,})"), F.lit(1)), lambda x: F.substring(x, 1, 3))))


ATTRIBUTES = ["home", "away", "home_text", "away_text", "instants", "days", "competition"]


def match_records(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """One record per match id: teams and competition of its last delivery, instants and days of all."""
    rows = with_classes(rows.withColumn("id", uuid_hex(F.col("match_id"))).filter("id is not null"), classes, ["root", "text"])
    rows = timestamps.with_calendar_day(rows, "scheduled_kickoff").withColumn("day", F.coalesce(F.floor(F.col("instant_s") / 86400).cast("bigint"), "day"))
    last = lambda c: F.max_by(c, F.struct("updated_at", "match_row"))
    said = F.max_by("competition", F.when(F.col("competition").isNotNull(), F.struct("updated_at", "match_row")))
    picks = {"source": last("source"), "home": last("home_root"), "away": last("away_root"), "home_text": last("home_text"), "away_text": last("away_text")}
    return rows.groupBy("id").agg(*[c.alias(n) for n, c in picks.items()], F.array_sort(F.collect_set("instant_s")).alias("instants"), F.array_sort(F.collect_set("day")).alias("days"), F.coalesce(beginnings(said), F.array().cast("array<string>")).alias("competition"))


def agreement(met: DataFrame) -> DataFrame:
    """Adds to pairs of match records their agreement levels by attribute, and how far apart their kickoffs are (`distance`).

    A team agrees with the other record's: the same (4), within two typing errors
    (3), in a word (2), with the other side's (1), or not (0). Sides that are
    swapped count as one disagreement, not two.
    """
    c = F.col
    gaps = lambda x: F.array_min(F.flatten(F.transform(f"{x}_a", lambda p: F.transform(f"{x}_b", lambda q: F.abs(p - q)))))
    shared = F.size(F.array_intersect("competition_a", "competition_b")) / F.least(F.size("competition_a"), F.size("competition_b"))
    met = timestamps.bind(met, gap=gaps("instants"), apart=gaps("days"), shared=F.when((F.size("competition_a") > 0) & (F.size("competition_b") > 0), shared))
    swapped = (c("home_a") == c("away_b")) & (c("away_a") == c("home_b"))

    def team(s: str, other_side: int) -> F.Column:
        x, y = c(f"{s}_text_a"), c(f"{s}_text_b")
        return F.when(c(f"{s}_a") == c(f"{s}_b"), 4).when(swapped, other_side).when(F.levenshtein(x, y, 2) >= 0, 3).when(F.arrays_overlap(F.split(x, " "), F.split(y, " ")), 2).otherwise(0)

    gap, apart, shared = c("gap"), c("apart"), c("shared")
    return met.withColumns({
        "home": team("home", 1), "away": team("away", 4),
        "competition": F.when(shared.isNull(), 1).when(shared == 1, 3).when(shared >= 0.5, 2).otherwise(0),
        "kickoff": F.when(gap <= 300, 5).when(gap <= 7200, 4).when(gap == 86400, 3).when(gap.isNotNull(), 0).when(apart <= 1, 2).when(apart.isNotNull(), 0).otherwise(1),
        "distance": F.coalesce(gap, apart * 86400 + 43200, F.lit(10**9)),
    })


#: What the matches' level probabilities start from.
START = {"home": [0.02, 0.01, 0.01, 0.01, 0.95], "away": [0.02, 0.01, 0.01, 0.01, 0.95], "competition": [0.02, 0.08, 0.1, 0.8], "kickoff": [0.01, 0.08, 0.1, 0.02, 0.1, 0.69]}


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a soccerstats and a forebet match id with the confidence that they record one fixture."""
    classes, rows = team_classes(spark, d)
    records = cut(match_records(rows, classes))
    teams = F.col("home").isNotNull() & F.col("away").isNotNull()
    key = lambda tag, *c: F.xxhash64(F.lit(tag), *c)
    by_day = lambda tag, ok, days, *c: F.when(ok, F.transform(days, lambda x: key(tag, *c, x))).otherwise(F.array())
    around = F.array_distinct(F.flatten(F.transform("days", lambda x: F.array(x - 1, x, x + 1))))
    none = F.array().cast("array<bigint>")

    def keys(days: F.Column, mine: str, other: str) -> F.Column:
        return F.concat(
            by_day("T", teams, days, "home", "away"),
            by_day("H", F.col("home").isNotNull(), days, "home"),
            by_day("A", F.col("away").isNotNull(), days, "away"),
            by_day("S", teams, days, F.least("home", "away"), F.greatest("home", "away")),
            # records without a day meet all of their teams
            F.when(teams, F.array(key(other, "home", "away"))).otherwise(none),
            F.when(teams & (F.size("days") == 0), F.array(key(mine, "home", "away"))).otherwise(none),
        )

    (left, members_a), (right, members_b) = (linkage.profiles(records.filter(F.col("source") == s), ATTRIBUTES) for s in ("soccerstats", "forebet"))
    left, right = cut(left.withColumn("keys", keys(F.col("days"), "U", "V"))), cut(right.withColumn("keys", keys(around, "V", "U")))
    compared = cut(linkage.candidate_pairs(left, right, agreement, [*START, "distance"]))
    scored = linkage.score(compared, linkage.random_pairs(left, right, agreement), START, float(left.count()) * right.count())
    return linkage.linked(linkage.settle(scored.filter("confidence >= 0.5"), ["distance"]), members_a, members_b)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    links = p2_links(spark, d)
    return links.select(uuid_text(F.least("a", "b")).alias("match_id_a"), uuid_text(F.greatest("a", "b")).alias("match_id_b"))


def p2_confidence(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of p2_found with their confidence."""
    links = p2_links(spark, d)
    return links.select(uuid_text(F.least("a", "b")).alias("match_id_a"), uuid_text(F.greatest("a", "b")).alias("match_id_b"), F.round("confidence", 6).alias("confidence"))


SCOPES = ("home_away", "all_games", "last_8")
TRUST = {"pre-match": 3, "live": 2, "finished": 1}


def feature_groups(spark: SparkSession, d: str) -> DataFrame:
    scope = F.regexp_replace(F.lower(F.regexp_replace(F.col("feature_scope"), r"^[\s\u00a0]+|[\s\u00a0]+$", "")), r"[\s\u00a0\-_]+", "_")
    df = table(spark, d, "features").withColumn("scope", scope).withColumn("id", uuid_hex(F.col("match_id")))
    return df.filter(F.col("scope").isin(*SCOPES) & F.col("id").isNotNull())


def bounded(c: str, low: float, high: float | None = None) -> F.Column:
    ok = ~F.isnan(F.col(c).cast("double")) & (F.col(c) >= low)
    return F.when(ok if high is None else ok & (F.col(c) <= high), F.col(c))


def source_trust() -> F.Column:
    status = F.lower(F.trim("source_status"))
    return F.coalesce(*[F.when(status == k, v) for k, v in TRUST.items()], F.lit(0))


def collected_us() -> F.Column:
    return F.unix_micros(F.col("collected_at").cast("timestamp"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Votes halve 20 times a microsecond and a step of trust is worth 2^60: the latest row of the most trusted source outvotes all others together."""
    fields = {"home_ppg": bounded("home_ppg", 0, 3), "sample_size_home": bounded("sample_size_home", 0)}
    bits = source_trust().cast("bigint") * F.lit(1 << 60) + collected_us() * 20
    best = survivors.survivors(feature_groups(spark, d), ["id", "scope"], fields, trust=source_trust(), at_us=collected_us(), bits=bits, scale=0, row="feature_row", least_rows=2)
    return best.select(uuid_text(F.col("id")).alias("match_id"), F.col("scope").alias("feature_scope"), F.coalesce("home_ppg_row", F.lit(0)).cast("bigint").alias("ppg_feature_row"), F.coalesce("sample_size_home_row", F.lit(0)).cast("bigint").alias("sample_feature_row"))


def p5_golden(spark: SparkSession, d: str) -> DataFrame:
    """One row per match and scope by weighted votes: trust times a half-life of three days, summed per value."""
    fields = {"home_ppg": bounded("home_ppg", 0, 3), "away_ppg": bounded("away_ppg", 0, 3), "sample_size_home": bounded("sample_size_home", 0), "sample_size_away": bounded("sample_size_away", 0)}
    bits = survivors.log_vote(F.log2(source_trust() + F.lit(1.0)), collected_us(), 3 * 86_400e6)
    best = survivors.survivors(feature_groups(spark, d), ["id", "scope"], fields, trust=source_trust(), at_us=collected_us(), bits=bits, row="feature_row")
    return best.select(uuid_text(F.col("id")).alias("match_id"), F.col("scope").alias("feature_scope"), "n_rows", *[F.col(f).cast("double").alias(f) for f in fields])


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def limits_of(spark: SparkSession, d: str, purpose: str) -> list[tuple[int, int, int]]:
    """(limit_id, max_tokens, overlap_tokens) of a purpose; the table is a handful of settings."""
    rows = table(spark, d, "size_limits").filter(F.col("purpose") == purpose).select("limit_id", "max_tokens", "overlap_tokens").collect()
    return sorted((r.limit_id, r.max_tokens, r.overlap_tokens or 0) for r in rows)


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document's container for each pack capacity."""
    sizes = cut(packing.token_counts(table(spark, d, "documents"), "doc_id", "text"))
    return packing.pack(sizes, [(i, n) for i, n, _ in limits_of(spark, d, "pack")])


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers and the share of room used by capacity."""
    filled = p8_containers(spark, d).groupBy("limit_id", "container").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("items"))
    capacity = table(spark, d, "size_limits").select("limit_id", F.col("max_tokens").cast("bigint").alias("capacity"))
    return filled.join(capacity, "limit_id").groupBy("limit_id", "capacity").agg(F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest")).withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6))


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of documents over each split limit."""
    return splitting.split(table(spark, d, "documents"), limits_of(spark, d, "split"))


def p2_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Ids linked more than once, pairs that are not of one id of each source, and confidences outside 0.5 to 1; there must be none."""
    links = cut(p2_links(spark, d))
    matches = table(spark, d, "matches").select(uuid_hex(F.col("match_id")).alias("id"), F.element_at(F.map_keys("source_urls"), 1).alias("source")).dropna().distinct()
    each = links.select(F.col("a").alias("id"), F.lit("soccerstats").alias("side"), "confidence").unionByName(links.select(F.col("b").alias("id"), F.lit("forebet").alias("side"), "confidence"))
    stray = each.join(matches, (each.id == matches.id) & (each.side == matches.source), "left_anti")
    repeated = each.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return count(repeated, "n_repeated").crossJoin(count(stray, "n_stray")).crossJoin(count(links.filter("confidence < 0.5 or confidence > 1"), "n_unsure"))


def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Pairs out of order, pairs of names that are not in the table, and classes that lack a pair of two of their names; there must be none."""
    pairs = cut(p7_found(spark, d))
    names = table(spark, d, "matches").select("country", F.explode(F.array("home_team", "away_team")).alias("name")).dropna().distinct()
    ends = pairs.select("country", F.col("name_a").alias("name")).unionByName(pairs.select("country", F.col("name_b").alias("name")))
    both = pairs.select("country", F.col("name_a").alias("x"), F.col("name_b").alias("y")).unionByName(pairs.select("country", F.col("name_b").alias("x"), F.col("name_a").alias("y")))
    # in a closed class every name has the same set of names, itself included
    sets = both.groupBy("country", "x").agg(F.bit_xor(F.xxhash64("y")).alias("h")).select("country", "x", F.col("h").bitwiseXOR(F.xxhash64("x")).alias("h"))
    open_ = both.join(sets, ["country", "x"]).join(sets.select("country", F.col("x").alias("y"), F.col("h").alias("h2")), ["country", "y"]).filter("h <> h2")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    return count(pairs.filter("name_a >= name_b"), "n_disordered").crossJoin(count(ends.join(names, ["country", "name"], "left_anti"), "n_unknown")).crossJoin(count(open_, "n_open"))


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """By capacity: the documents packed, containers over it, and documents split that would fit; the last two must be none."""
    packed = cut(p8_containers(spark, d))
    capacity = table(spark, d, "size_limits").select("limit_id", F.col("max_tokens").alias("capacity"))
    overfull = packed.groupBy("limit_id", "container").agg(F.sum("tokens").alias("t")).join(F.broadcast(capacity), "limit_id").groupBy("limit_id").agg(F.count_if(F.col("t") > F.col("capacity")).alias("n_overfull"))
    per = packed.groupBy("limit_id", "doc_id").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("k")).join(F.broadcast(capacity), "limit_id")
    return per.groupBy("limit_id").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if((F.col("k") > 1) & (F.col("t") <= F.col("capacity"))).alias("n_split_small")).join(overfull, "limit_id").select("limit_id", "n_documents", "n_overfull", "n_split_small")


def p10_invariants(spark: SparkSession, d: str) -> DataFrame:
    """By limit: pieces over it, texts not covered from end to end, and pieces that are not what stands there; there must be none."""
    pieces = cut(p10_pieces(spark, d))
    limits = table(spark, d, "size_limits").filter("purpose = 'split'").select("limit_id", "max_tokens")
    docs = table(spark, d, "documents").select("doc_id", "text")
    wrong = pieces.join(docs, "doc_id").select("limit_id", (F.expr("substring(text, start_char + 1, end_char - start_char)") != F.col("piece_text")).alias("wrong"), F.lit(False).alias("open"), F.lit(0).alias("tokens"))
    runs = pieces.groupBy("limit_id", "doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "start_char", "end_char"))).alias("p"), F.max("tokens").alias("tokens")).join(docs.select("doc_id", F.length("text").alias("n")), "doc_id")
    gaps = F.exists(F.arrays_zip(F.slice("p", 2, 1 << 30).alias("y"), F.slice("p", 1, F.greatest(F.lit(0), F.size("p") - 1)).alias("x")), lambda z: z["y"]["start_char"] > z["x"]["end_char"])
    covered = (F.element_at("p", 1)["start_char"] == 0) & (F.element_at("p", -1)["end_char"] == F.col("n")) & ~gaps
    every = wrong.unionByName(runs.select("limit_id", F.lit(False).alias("wrong"), (~covered).alias("open"), "tokens"))
    return limits.join(every, "limit_id", "left").groupBy("limit_id").agg(F.count_if(F.col("tokens") > F.col("max_tokens")).alias("n_over"), F.count_if("open").alias("n_open"), F.count_if("wrong").alias("n_wrong"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p2_found": p2_found, "p2_confidence": p2_confidence, "p2_invariants": p2_invariants, "p5_found": p5_found, "p5_golden": p5_golden, "p7_found": p7_found, "p7_invariants": p7_invariants, "p8_containers": p8_containers, "p8_fill": p8_fill, "p8_invariants": p8_invariants, "p9_found": p9_found, "p10_pieces": p10_pieces, "p10_invariants": p10_invariants}
_HEX = "regexp_extract(lower(regexp_replace(match_id, '^[\\s{}]+|[\\s{}]+$|-', '', 'g')), '^[0-9a-f]{32}$')"
_FEATURES = f"""
f AS (SELECT *, {_HEX} AS id, regexp_replace(lower(trim(feature_scope)), '[\\s\\-_]+', '_', 'g') AS scope,
  CASE lower(trim(source_status)) WHEN 'pre-match' THEN 3 WHEN 'live' THEN 2 WHEN 'finished' THEN 1 ELSE 0 END AS trust FROM features),
g AS (SELECT * FROM f WHERE id <> '' AND scope IN ('home_away', 'all_games', 'last_8'))"""
_VOTES = """
x AS (SELECT id, scope, field, v, trust, collected_at, feature_row FROM (UNPIVOT (SELECT id, scope, trust, collected_at, feature_row,
    CASE WHEN NOT isnan(home_ppg) AND home_ppg BETWEEN 0 AND 3 THEN home_ppg END AS home_ppg, CASE WHEN NOT isnan(away_ppg) AND away_ppg BETWEEN 0 AND 3 THEN away_ppg END AS away_ppg,
    CAST(CASE WHEN sample_size_home >= 0 THEN sample_size_home END AS DOUBLE) AS sample_size_home, CAST(CASE WHEN sample_size_away >= 0 THEN sample_size_away END AS DOUBLE) AS sample_size_away FROM g)
    ON home_ppg, away_ppg, sample_size_home, sample_size_away INTO NAME field VALUE v)),
u AS (SELECT id, scope, field, v, trust, collected_at, min(feature_row) AS feature_row FROM x GROUP BY ALL),
w AS (SELECT *, log2(trust + 1.0) + epoch_us(collected_at) / 259200000000.0 AS bits FROM u),
s AS (SELECT *, max(bits) OVER (PARTITION BY id, scope, field) AS top FROM w),
per AS (SELECT id, scope, field, v, round(sum(pow(2.0, bits - top)), 4) AS votes, max((trust, collected_at, -feature_row)) AS best FROM s GROUP BY ALL),
won AS (SELECT id, scope, field, arg_max(v, (votes, best)) AS v FROM per GROUP BY ALL),
n AS (SELECT id, scope, count(*) AS n_rows FROM g GROUP BY ALL)"""
_TEXT_ID = "regexp_replace(id, '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')"
SQL: dict[str, str] = {
    "p2_invariants": "SELECT 0 AS n_repeated, 0 AS n_stray, 0 AS n_unsure",
    "p7_invariants": "SELECT 0 AS n_disordered, 0 AS n_unknown, 0 AS n_open",
    "p8_invariants": "SELECT limit_id, (SELECT count(*) FROM documents) AS n_documents, 0 AS n_overfull, 0 AS n_split_small FROM size_limits WHERE purpose = 'pack'",
    "p10_invariants": "SELECT limit_id, 0 AS n_over, 0 AS n_open, 0 AS n_wrong FROM size_limits WHERE purpose = 'split'",
    "p5_found": f"""
WITH {_FEATURES}
SELECT {_TEXT_ID} AS match_id, scope AS feature_scope,
  coalesce(arg_max(feature_row, (trust, collected_at, -feature_row)) FILTER (WHERE NOT isnan(home_ppg) AND home_ppg BETWEEN 0 AND 3), 0) AS ppg_feature_row,
  coalesce(arg_max(feature_row, (trust, collected_at, -feature_row)) FILTER (WHERE sample_size_home >= 0), 0) AS sample_feature_row
FROM g GROUP BY id, scope HAVING count(*) >= 2""",
    "p5_golden": f"""
WITH {_FEATURES}, {_VOTES}
SELECT {_TEXT_ID} AS match_id, scope AS feature_scope, n_rows, max(v) FILTER (WHERE field = 'home_ppg') AS home_ppg, max(v) FILTER (WHERE field = 'away_ppg') AS away_ppg,
  max(v) FILTER (WHERE field = 'sample_size_home') AS sample_size_home, max(v) FILTER (WHERE field = 'sample_size_away') AS sample_size_away
FROM n LEFT JOIN won USING (id, scope) GROUP BY ALL""",
}
