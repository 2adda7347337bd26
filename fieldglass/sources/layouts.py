"""Layouts of fixture, feature, result and record pages as DataFrame expressions over table rows and texts (see pages)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.operators.timestamps import bind

# Names of columns in the order pages show them.
INDEX_METRICS = "gp win fts cs btts tg gf ga over15 over25 over35 ppg".split()
PREVIEW_METRICS = "gp w d l gf ga win_pct draw_pct loss_pct avg_gf avg_ga avg_tg ppg".split()
RATES = "over_15 over_25 over_35 tg btts".split()
SCOPE_LABELS = ("home", "away", "total", "last 8")
PREVIEW_TIME = r"(?i)(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+(\d{1,2}\s+\w+\s+\d{4})\s*\|\s*(\d{1,2}:\d{2})\s*UTC"
BY_TIME = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+(\d{1,2}\s+\w+)\s+(\d{2}:\d{2})$"
DETAIL_PAGES = r"round_details\.asp|pmatch\.asp|h2h\.asp|leagueview_team\.asp"
STATS = {"ball_possession": r"Ball possession\s+(\d+)%\s+(\d+)%", "corners": r"Corners\s+(\d+)\s+(\d+)", "time_leading": r"% of time leading\s+(\d+)%\s+(\d+)%", "domination_index": r"Domination Index\s+(\d+)%\s+(\d+)%"}
OBSERVED = [
    ("1x2", "1", "home"), ("1x2", "X", "draw"), ("1x2", "2", "away"), ("double_chance", "1X", "dc_1x"), ("double_chance", "X2", "dc_x2"), ("double_chance", "12", "dc_12"), ("over25", "Over 2.5", "over_25"), ("over25", "Under 2.5", "under_25"),
    ("btts", "Yes", "btts_yes"), ("btts", "No", "btts_no"), ("ht_ft", "HT/1", "ht_home"), ("ht_ft", "HT/X", "ht_draw"), ("ht_ft", "HT/2", "ht_away"), ("corners", "home", "corners_home"), ("corners", "draw", "corners_draw"), ("corners", "away", "corners_away"),
]


def number(c: Column) -> Column:
    """A text such as '72%' or ' 1.5 ' as double, null if it is none."""
    return F.trim(F.replace(F.trim(c), F.lit("%"), F.lit(""))).try_cast("double")


def _at(values: Column, i: int | Column) -> Column:
    return F.get(values, F.lit(i) if isinstance(i, int) else i)


def legacy_index(rows: DataFrame, key: str) -> DataFrame:
    """(key, row, competition, time_text, home, away, status, href) of the table `btable`: class trow3 names the competition of the trow8 rows after it, `Unknown` before any."""
    t = rows.filter("table_id = 'btable'")
    head = F.when(F.array_contains(F.split("row_class", " "), "trow3"), F.nullif(_at(F.col("cells"), 0)["bold"], F.lit("")))
    w = Window.partitionBy(key, "tbl").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("competition", F.coalesce(F.last(head, ignorenulls=True).over(w), F.lit("Unknown"))).filter(F.array_contains(F.split("row_class", " "), "trow8") & (F.size("tds") >= 5))
    time = _at(F.col("tds"), 0)
    status = F.when(time.contains("P-P"), "postponed").when(time.contains("'") | (time == "HT"), "live").when(time == "FT", "finished").otherwise("pre-match")
    td = F.filter("cells", lambda c: c["tag"] == "td")
    return t.select(key, "row", "competition", time.alias("time_text"), _at(F.col("tds"), 1).alias("home"), _at(F.col("tds"), 3).alias("away"), status.alias("status"), F.coalesce(F.get(_at(td, 4)["links"], F.lit(0)), F.lit("")).alias("href"))


def by_time_index(rows: DataFrame, key: str) -> DataFrame:
    """(key, tbl, row, day_text, clock, country, home, score, away, href, league) of rows that begin with a day and a time; the country is the first of the first five cells of two or three capitals, else the third."""
    t = rows.filter((F.size("tds") >= 5) & _at(F.col("tds"), 0).rlike(BY_TIME))
    spots = F.filter(F.sequence(F.lit(0), F.least(F.lit(4), F.size("tds") - 1)), lambda i: F.get("tds", i).rlike("^[A-Z]{2,3}$"))
    t = t.withColumn("_i", F.coalesce(F.get(spots, F.lit(0)), F.lit(2)))
    links = F.flatten(F.transform("cells", lambda c: c["links"]))
    cell = lambda n: F.get("tds", F.col("_i") + n)
    first = lambda pattern: F.coalesce(F.get(F.filter(links, lambda x: x.rlike(pattern)), F.lit(0)), F.lit(""))
    out = t.select(
        key, "tbl", "row", F.regexp_extract(_at(F.col("tds"), 0), BY_TIME, 1).alias("day_text"), F.regexp_extract(_at(F.col("tds"), 0), BY_TIME, 2).alias("clock"),
        cell(0).alias("country"), cell(1).alias("home"), cell(2).alias("score"), cell(3).alias("away"), first(DETAIL_PAGES).alias("href"),
        F.regexp_extract(first(r"latest\.asp.*league="), r"[?&]league=([^&#]+)", 1).alias("league"),
    )
    return out.filter("home <> '' and away <> ''")


def metric_vector(values: Column) -> Column:
    """Map of the twelve index metrics that follow the first scope label of a row; null unless all are numbers."""
    labels = F.transform(values, lambda v: F.lower(v).isin(*SCOPE_LABELS))
    at = F.array_position(labels, F.lit(True)).cast("int")
    raw = F.transform(F.slice(F.filter(F.slice(values, at + 1, F.greatest(F.lit(0), F.size(values) - at)), lambda v: v != ""), 1, 12), number)
    return F.when((at > 0) & (F.size(raw) == 12) & F.forall(raw, lambda x: x.isNotNull()), F.map_from_arrays(F.array(*[F.lit(m) for m in INDEX_METRICS]), raw))


def index_features(rows: DataFrame, matches: DataFrame, key: str, side: str = "home") -> DataFrame:
    """The metric vectors of rows whose first cell names a pre-match fixture's team of that side (raw texts; of repeated fixtures the last counts)."""
    last = matches.filter("status = 'pre-match'").groupBy(key, side).agg(F.max_by(F.struct("home", "away"), "row").alias("_m"))
    named = rows.select(key, _at(F.col("values"), 0).alias(side), metric_vector(F.col("values")).alias("metrics")).filter("metrics is not null")
    return named.join(last, [key, side]).select(key, "_m.home", "_m.away", "metrics")


def preview_time(text: Column) -> Column:
    """The kickoff a preview page states, as timestamp; null if it states none or no valid one."""
    at = F.concat_ws(" ", F.regexp_replace(F.regexp_extract(text, PREVIEW_TIME, 1), r"\s+", " "), F.regexp_extract(text, PREVIEW_TIME, 2))
    return F.try_to_timestamp(F.initcap(at), F.lit("d MMM yyyy H:mm"))


def not_late(kickoff: Column, collected_at: Column) -> Column:
    """True unless the page states a kickoff and was collected at or after it."""
    return kickoff.isNull() | (collected_at < kickoff)


def goal_rates(rows: DataFrame, key: str) -> DataFrame:
    """(key, home, away): maps of the five rates after the two `Total` cells of the first such row in a table that shows 1.5+, 2.5+, 3.5+ and BTS."""
    shown = rows.groupBy(key, "tbl").agg(F.array_join(F.flatten(F.collect_list("values")), " ").alias("_all"))
    shown = shown.filter(reduce(lambda a, b: a & b, [F.col("_all").contains(x) for x in ("1.5+", "2.5+", "3.5+", "BTS")])).select(key, "tbl")
    spots = F.filter(F.sequence(F.lit(0), F.size("values") - 1), lambda i: F.lower(F.get("values", i)) == "total")
    t = bind(rows.join(shown, [key, "tbl"]).filter(F.size("values") > 0), _s=spots).filter("size(_s) = 2 and get(_s, 1) - get(_s, 0) >= 6 and size(values) >= get(_s, 1) + 6")
    part = lambda n: F.transform(F.slice("values", F.get("_s", F.lit(n)) + 2, 5), number)
    t = t.select(key, "tbl", "row", part(0).alias("h"), part(1).alias("a")).filter("forall(h, x -> x is not null) and forall(a, x -> x is not null)")
    name = lambda c: F.map_from_arrays(F.array(*[F.lit(r) for r in RATES]), F.col(c)).alias({"h": "home", "a": "away"}[c])
    return t.groupBy(key).agg(F.min_by("h", F.struct("tbl", "row")).alias("h"), F.min_by("a", F.struct("tbl", "row")).alias("a")).select(key, name("h"), name("a"))


def preview_tables(rows: DataFrame, key: str) -> DataFrame:
    """(key, home, away): maps of the thirteen preview metrics from the two rows under the first header P W D L GF GA W%, both of them numbers after a name."""
    cells = lambda r: F.filter(r, lambda v: v != "")
    per = rows.filter("direct").groupBy(key, "tbl").agg(F.array_sort(F.collect_list(F.struct("row", "values"))).alias("_r")).filter("size(_r) >= 3")
    line = lambda n: cells(F.get("_r", F.lit(n))["values"])
    per = per.filter(F.slice(line(0), 1, 7) == F.array(*[F.lit(x) for x in ("P", "W", "D", "L", "GF", "GA", "W%")]))
    nums = lambda n: F.transform(F.slice(line(n), 2, 1000), number)
    per = bind(per, _h=nums(1), _a=nums(2)).filter("size(_h) >= 13 and size(_a) >= 13 and forall(_h, x -> x is not null) and forall(_a, x -> x is not null)")
    name = lambda c: F.map_from_arrays(F.array(*[F.lit(m) for m in PREVIEW_METRICS]), F.slice(c, 1, 13))
    return per.groupBy(key).agg(F.min_by("_h", "tbl").alias("h"), F.min_by("_a", "tbl").alias("a")).select(key, name("h").alias("home"), name("a").alias("away"))


def scoring_tables(rows: DataFrame, key: str) -> DataFrame:
    """(key, home, away): maps of label to the HOME number of the first and the AWAY number of the second table headed SCORING HOME AWAY ALL; pages with fewer give none."""
    head = F.upper(F.array_join("values", " ")) == "SCORING HOME AWAY ALL"
    which = rows.filter((F.col("row") == 1) & head).select(key, "tbl").withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("tbl"))).filter("_n <= 2")
    t = rows.join(which, [key, "tbl"]).filter(F.size("tds") >= 3)
    t = t.select(key, "_n", "row", F.lower(_at(F.col("tds"), 0)).alias("label"), F.when(F.col("_n") == 1, number(_at(F.col("tds"), 1))).otherwise(number(_at(F.col("tds"), 2))).alias("value"))
    t = t.groupBy(key, "_n", "label").agg(F.max_by("value", "row").alias("value"))
    side = lambda n: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("_n") == n, F.struct("label", "value")))))
    return t.groupBy(key).agg(side(1).alias("home"), side(2).alias("away"), F.count_distinct("_n").alias("_k")).filter("_k = 2").drop("_k")


def sortable_pairs(rows: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """(key, side, one column per label): the name and number pairs of the first two tables of class sortable, pivoted; home is the first, away the second."""
    which = rows.filter(F.array_contains(F.split("table_class", " "), "sortable")).select(key, "tbl").distinct().withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("tbl"))).filter("_n <= 2")
    t = rows.join(which, [key, "tbl"]).filter(F.size("tds") == 2)
    t = t.select(key, F.when(F.col("_n") == 1, "home").otherwise("away").alias("side"), "row", _at(F.col("tds"), 0).alias("label"), number(_at(F.col("tds"), 1)).alias("value")).filter("value is not null")
    return t.groupBy(key, "side").pivot("label", labels).agg(F.max_by("value", "row"))


def core_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which all of the core numbers are there."""
    return df.dropna(subset=columns)


def page_state(content: Column) -> Column:
    """finished_post_match, live, pre_match or unknown by the words of a page, in this order of rules."""
    t = F.lower(content)
    return (
        F.when(t.contains("full-time") | (t.contains("ft") & t.contains("final")) | t.rlike(r"final score[:\s]*\d+[-:]\d+"), "finished_post_match")
        .when(t.rlike("ht |ht:|in play|live score") & ~t.contains("pre-match"), "live")
        .when(t.rlike(r"\d{1,2}[':]\d{2}") & t.rlike("pre-match|scheduled"), "pre_match")
        .when(t.rlike("pre-match|points per game|scoring home away all"), "pre_match")
        .otherwise("unknown")
    )


def truncated(content: Column) -> Column:
    """True where a page says that it lists ten matches only."""
    return F.coalesce(content.contains("MAXIMUM OF 10 MATCHES") | content.contains("Only listing a maximum of 10 matches"), F.lit(False))


def lossless_tables(pages: DataFrame, key: str) -> DataFrame:
    """(key, tables): number and rows of every table, rows right under the table that have any text only, tables without such rows left out but counted."""
    t = rows_with_text(pages, key).groupBy(key, "tbl").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "values"))), lambda x: x["values"]).alias("rows"))
    return t.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("tbl").alias("table_index"), "rows"))).alias("tables"))


def rows_with_text(pages: DataFrame, key: str) -> DataFrame:
    from fieldglass.sources.pages import rows_of

    return rows_of(pages, key).filter("direct and exists(values, v -> v <> '')")


def result_summary(df: DataFrame, text: str, home: str, away: str) -> DataFrame:
    """Adds the match facts a result page states: final and half-time score, total goals, whether both scored (false without a score), paired statistics and the surprise level. Team names are matched literally; the first mention counts."""
    quoted = lambda c: F.regexp_replace(F.col(c), r"([\\.\[\]{}()*+?^$|])", r"\\$1")
    pattern = F.concat(F.lit("(?i)"), quoted(home), F.lit(r"\s+(\d+)\s*(?::|\s)\s*(\d+)\s+"), quoted(away))
    got = lambda p, i: F.regexp_extract(F.col(text), p, i).try_cast("int")
    two = lambda p: F.when(got(p, 1).isNotNull(), F.struct(got(p, 1).alias("home"), got(p, 2).alias("away")))
    score = lambda i: F.call_function("regexp_extract", F.col(text), F.col("_p"), F.lit(i)).try_cast("int")
    df = bind(df, _p=pattern)
    df = bind(df, final_score=F.when(score(1).isNotNull(), F.struct(score(1).alias("home"), score(2).alias("away"))))
    total = F.col("final_score.home") + F.col("final_score.away")
    both = F.coalesce((F.col("final_score.home") > 0) & (F.col("final_score.away") > 0), F.lit(False))
    return df.drop("_p").withColumns({"half_time_score": two(r"(?i)Half-time score:\s*\(\s*(\d+)\s*[-:]\s*(\d+)\s*\)"), "total_goals": total, "btts": both, **{n: two("(?i)" + p) for n, p in STATS.items()}, "surprise_level": F.regexp_extract(F.col(text), r"(?i)(?:Outcome )?Surprise-Level:\s*(\d+(?:\.\d+)?)%", 1).try_cast("double")})


def records_of(payload: Column) -> Column:
    """Array of the records of a JSON payload: `[rows, meta]`, a bare list (its objects), or an object with `rows`; else empty."""
    v = F.try_parse_json(payload)
    listed, rows = F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$.rows", "array<variant>")
    is_list, is_object = F.schema_of_variant(F.get(listed, F.lit(0))).startswith("ARRAY"), lambda x: F.schema_of_variant(x).startswith("OBJECT")
    return F.coalesce(F.when(F.schema_of_variant(v).startswith("ARRAY"), F.when(is_list, F.try_variant_get(F.get(listed, F.lit(0)), "$", "array<variant>")).otherwise(F.filter(listed, is_object))), rows, F.array().cast("array<variant>"))


def record_matches(records: DataFrame) -> DataFrame:
    """Records with both teams, `competition` and `country` `Unknown` where they are missing or blank, and a confidence of 0.95 with a source URL, else 0.7."""
    filled = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("Unknown")).alias(c)
    others = [c for c in records.columns if c not in ("competition", "country")]
    kept = records.filter("coalesce(home, '') <> '' and coalesce(away, '') <> ''")
    return kept.select(*others, filled("competition"), filled("country"), F.when(F.coalesce("source_url", F.lit("")) != "", 0.95).otherwise(0.7).alias("identity_confidence"))


def record_observations(records: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, market, selection, probability): the map `probs` of records with both teams unpivoted, null numbers left out, and a `pick` row of the greatest of 1, X, 2 (the earlier of equals)."""
    p = lambda k: F.element_at("probs", F.lit(k))
    row = lambda m, s, v: F.struct(F.lit(m).alias("market"), s.alias("selection"), v.alias("probability"))
    best = F.array_max(F.array(*[F.when(p(k).isNotNull(), F.struct(p(k).alias("v"), F.lit(-i).alias("o"), F.lit(s).alias("s"))) for i, (s, k) in enumerate((("1", "home"), ("X", "draw"), ("2", "away")))]))
    every = F.array(*[row(m, F.lit(s), p(k)) for m, s, k in OBSERVED], row("pick", best["s"], best["v"]))
    kept = records.filter("coalesce(home, '') <> '' and coalesce(away, '') <> ''")
    return kept.select(*keys, F.explode(every).alias("x")).select(*keys, "x.*").filter("probability is not null")


def named_pairs(text: Column, most: int = 21) -> Column:
    """Array of (home, away) a text names as `Name vs Name`, each of 3 to 30 characters; at most `most` (the feature of this fallback)."""
    pattern = r"([A-Z][a-z]+(?:\s[A-Z][a-z]+)*)\s+vs\s+([A-Z][a-z]+(?:\s[A-Z][a-z]+)*)"
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("home"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("away"))
    return F.slice(F.filter(found, lambda x: F.length(x["home"]).between(3, 30) & F.length(x["away"]).between(3, 30)), 1, most)


def first_layout(pages: DataFrame, key: str, layouts: list[DataFrame]) -> DataFrame:
    """The rows of the first layout, in the order given, that gives a page any; layouts share their columns. Pages no layout reads give none."""
    tagged = [d.withColumn("_l", F.lit(i)) for i, d in enumerate(layouts)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    best = every.groupBy(key).agg(F.min("_l").alias("_l"))
    return every.join(best, [key, "_l"]).drop("_l").join(pages.select(key).distinct(), key, "left_semi")
