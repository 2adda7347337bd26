"""Queries of the relational and scalar operators over the general tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.functions import ids, similarity, text, urls
from fieldglass.operators import crawl, dedup, joins, metrics, names, timestamps
from fieldglass.session import table
from fieldglass.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name, with the SQL that must give the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


EDGES = [0.0, 0.3, 0.4, 0.45, 0.5, 0.55, 0.6, 0.7, 1.01]
_CASE = "CASE " + " ".join(f"WHEN p >= {a} AND p < {b} THEN '[{a:g},{b:g})'" for a, b in zip(EDGES, EDGES[1:], strict=False)) + " END"


def graded(spark: SparkSession, d: str) -> DataFrame:
    """Line items as graded rows: won if returned, unresolved while status is open and flag is N."""
    li = table(spark, d, "lineitem")
    won = F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False)
    p = F.round(F.col("l_discount") * 100).cast("int")
    return li.select("l_returnflag", "l_linestatus", "l_partkey", won.alias("won"), p.alias("p100"), F.when(won.isNotNull(), F.pow(p - F.when(won, 100).otherwise(0), 2).cast("bigint")).alias("error"))


_GRADED = "g AS (SELECT l_returnflag, l_linestatus, l_partkey, CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS won, CAST(round(l_discount * 100) AS INT) AS p100 FROM lineitem), e AS (SELECT *, CASE WHEN won IS NOT NULL THEN CAST((p100 - CASE WHEN won THEN 100 ELSE 0 END) AS BIGINT) * (p100 - CASE WHEN won THEN 100 ELSE 0 END) END AS error FROM g)"
_AGGS = "count(*) AS n, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE NOT won) AS losses, count(*) FILTER (WHERE won IS NULL) AS unresolved, count(*) FILTER (WHERE won) / nullif(count(won), 0) AS hit_rate, sum(p100) / nullif(count(won), 0) AS avg_probability, count(*) FILTER (WHERE won) / nullif(count(won), 0) - sum(p100) / nullif(count(won), 0) AS calibration_error, sum(error) / nullif(count(error), 0) AS mean_error"


@query(f"WITH {_GRADED} SELECT l_linestatus, {_AGGS} FROM e GROUP BY l_linestatus")
def outcome_metrics(spark, d):  # noqa: ANN001, ANN201
    return graded(spark, d).groupBy("l_linestatus").agg(*metrics.outcome_aggregates("won", "p100", "error"))


@query(f"WITH {_GRADED} SELECT grouping_id(l_returnflag, l_linestatus) AS grouping, l_returnflag, l_linestatus, {_AGGS} FROM e GROUP BY GROUPING SETS ((), (l_returnflag), (l_linestatus), (l_returnflag, l_linestatus))")
def grouping_sets_audit(spark, d):  # noqa: ANN001, ANN201
    return metrics.by_grouping_sets(graded(spark, d), [["l_returnflag", "l_linestatus"], ["l_returnflag"], ["l_linestatus"], []], metrics.outcome_aggregates("won", "p100", "error"))


@query(f"SELECT bucket, n, mean_predicted, hit_rate, hit_rate - mean_predicted AS gap FROM (SELECT {_CASE} AS bucket, count(*) AS n, sum(pi) / count(*) / 25 AS mean_predicted, count(*) FILTER (WHERE hit) / count(*) AS hit_rate FROM (SELECT l_quantity / 50 AS p, l_quantity / 2 AS pi, l_returnflag = 'R' AS hit FROM lineitem) GROUP BY 1) WHERE bucket IS NOT NULL")
def calibration_buckets(spark, d):  # noqa: ANN001, ANN201
    rows = table(spark, d, "lineitem").select((F.col("l_quantity") / 50).alias("p"), (F.col("l_quantity") / 2).alias("pi"), (F.col("l_returnflag") == "R").alias("hit"))
    out = metrics.calibration(rows.withColumn("pq", F.col("p")), "p", "hit", EDGES)
    return out.select("bucket", "n", "mean_predicted", "hit_rate", "gap")


@query("SELECT floor(o_totalprice / 100000 * 20) / 20 AS bucket, count(*) AS n FROM orders GROUP BY 1")
def equal_width_histogram(spark, d):  # noqa: ANN001, ANN201
    return metrics.histogram(table(spark, d, "orders").select((F.col("o_totalprice") / 100000).alias("x")), "x", 20)


@query("SELECT event_type, count(*) FILTER (WHERE value > 50) AS high, count(*) FILTER (WHERE value IS NULL) AS missing, count(*) AS every FROM events GROUP BY 1")
def conditional_counts(spark, d):  # noqa: ANN001, ANN201
    return metrics.conditional_counts(table(spark, d, "events"), ["event_type"], {"high": F.col("value") > 50, "missing": F.col("value").isNull(), "every": F.lit(True)})


@query("SELECT CAST(l_quantity > 25 AS INT) + CAST(l_discount > 0.05 AS INT) + CAST(l_tax > 0.04 AS INT) AS agreeing, count(*) AS n FROM lineitem GROUP BY 1")
def consensus_count(spark, d):  # noqa: ANN001, ANN201
    return metrics.consensus(table(spark, d, "lineitem"), [F.col("l_quantity") > 25, F.col("l_discount") > 0.05, F.col("l_tax") > 0.04])


@query("SELECT count(probability) AS n, min(probability) AS least, round(avg(probability), 6) AS mean, count(*) FILTER (WHERE probability < 0.5) AS n_below FROM report_predictions")
def score_summary(spark, d):  # noqa: ANN001, ANN201
    return metrics.score_summary(table(spark, d, "report_predictions"), "probability", 0.5).withColumn("mean", F.round("mean", 6))


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_wins(spark, d):  # noqa: ANN001, ANN201
    return dedup.first_wins(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def last_wins(spark, d):  # noqa: ANN001, ANN201
    return dedup.last_wins(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, ts, event_id) = 1")
def prefer_status(spark, d):  # noqa: ANN001, ANN201
    return dedup.prefer(table(spark, d, "events"), ["user_id"], F.col("event_type") == "purchase", ["ts", "event_id"]).select("event_id", "user_id")


_MERGE = "first_value({c} IGNORE NULLS) OVER (PARTITION BY match_id ORDER BY {o}feature_row ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS {c}"
_COLS = ["home_ppg", "away_ppg", "home_win_rate"]
_N = "-(" + " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in _COLS) + "), "


@query(f"SELECT DISTINCT match_id, {', '.join(_MERGE.format(c=c, o='') for c in _COLS)} FROM features")
def coalesce_merge(spark, d):  # noqa: ANN001, ANN201
    return dedup.coalesce_merge(table(spark, d, "features"), ["match_id"], _COLS, ["feature_row"])


@query(f"SELECT DISTINCT match_id, {', '.join(_MERGE.format(c=c, o=_N) for c in _COLS)} FROM features")
def coalesce_by_completeness(spark, d):  # noqa: ANN001, ANN201
    return dedup.coalesce_merge(table(spark, d, "features"), ["match_id"], _COLS, ["feature_row"], by_completeness=True)


@query("SELECT match_id, coalesce(arg_min(kickoff_confidence, link_row) FILTER (WHERE kickoff_confidence NOT LIKE 'unverified%'), arg_min_null(kickoff_confidence, link_row)) AS kickoff_confidence, list_sort(list(DISTINCT scope)) AS scopes FROM fixture_links GROUP BY match_id")
def refine_sentinels(spark, d):  # noqa: ANN001, ANN201
    return dedup.refine(table(spark, d, "fixture_links"), ["match_id"], ["kickoff_confidence"], ["unverified_league_page", "unverified_index_time"], ["link_row"], {"scopes": "scope"})


@query("SELECT link_row, CASE WHEN detail_url IS NOT NULL AND row_number() OVER (PARTITION BY detail_url ORDER BY link_row) > 1 THEN 'duplicate' ELSE status END AS status FROM fixture_links")
def duplicate_marking(spark, d):  # noqa: ANN001, ANN201
    return dedup.mark_duplicates(table(spark, d, "fixture_links"), "detail_url", ["link_row"], "status", "duplicate").select("link_row", "status")


@query("SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) = 1")
def representative_max(spark, d):  # noqa: ANN001, ANN201
    return dedup.representative(table(spark, d, "lineitem"), ["l_orderkey"], F.col("l_extendedprice"), ["l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, o_orderkey) = 1")
def preference_pick(spark, d):  # noqa: ANN001, ANN201
    return dedup.best_by_preference(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", ["1-URGENT", "2-HIGH"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, rank FROM (SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS INT) AS rank FROM lineitem) WHERE rank <= 3")
def top_k_per_group(spark, d):  # noqa: ANN001, ANN201
    return dedup.top_k(table(spark, d, "lineitem"), ["l_orderkey"], [F.desc("l_extendedprice"), F.asc("l_linenumber")], 3).select("l_orderkey", "l_linenumber", "rank")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS signup FROM events")
def fill_forward(spark, d):  # noqa: ANN001, ANN201
    e = table(spark, d, "events").withColumn("s", F.when(F.col("event_type") == "signup", F.col("event_id")))
    return dedup.fill_forward(e, ["user_id"], ["ts", "event_id"], "s", "signup").select("event_id", "signup")


@query("SELECT event_id, CASE WHEN nt = 'purchase' THEN ne END AS next_event_id FROM (SELECT event_id, event_type, lead(event_type) OVER w AS nt, lead(event_id) OVER w AS ne FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'view'")
def row_pairing(spark, d):  # noqa: ANN001, ANN201
    return dedup.pair_rows(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "view", F.col("event_type") == "purchase", ["event_id"]).select("event_id", "next_event_id")


@query("SELECT m.match_row, l.link_row FROM matches m LEFT JOIN fixture_links l ON m.home_team = l.home_team AND m.away_team = l.away_team")
def exact_pair_join(spark, d):  # noqa: ANN001, ANN201
    return joins.pair_join(table(spark, d, "matches").select("match_row", "home_team", "away_team"), table(spark, d, "fixture_links"), "home_team", "away_team", ["link_row"]).select("match_row", "link_row")


@query("SELECT s_suppkey, coalesce(n_name, 'Unknown') AS n_name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey")
def left_lookup_default(spark, d):  # noqa: ANN001, ANN201
    nations = table(spark, d, "nation").filter("n_regionkey < 3").withColumnRenamed("n_nationkey", "s_nationkey")
    return joins.lookup(table(spark, d, "supplier"), nations, "s_nationkey", {"n_name": "Unknown"}).select("s_suppkey", "n_name")


_TIERED = """
WITH p AS (SELECT * FROM fixture_links WHERE lifecycle_state = 'scheduled'), r AS (SELECT * FROM fixture_links WHERE lifecycle_state = 'finished'),
c AS (SELECT p.link_row AS pre, 0 AS t, 'detail' AS tier, r.link_row AS res FROM p JOIN r ON p.detail_url = r.detail_url
  UNION ALL SELECT p.link_row, 1, 'pair', r.link_row FROM p JOIN r ON lower(p.home_team) || '|' || lower(p.away_team) = lower(r.home_team) || '|' || lower(r.away_team)),
g AS (SELECT pre, t, tier, count(DISTINCT res) AS n, min(res) AS res FROM c GROUP BY ALL),
a AS (SELECT pre, arg_min(res, t) FILTER (WHERE n = 1) AS res, arg_min(tier, t) FILTER (WHERE n = 1) AS tier, min(t) FILTER (WHERE n = 1) AS one, min(t) FILTER (WHERE n > 1) AS many, sum(n) AS n_candidates FROM g GROUP BY pre),
b AS (SELECT *, many IS NOT NULL AND (one IS NULL OR many < one) AS clash FROM a)
SELECT p.link_row AS pre, CASE WHEN NOT clash THEN res END AS res, CASE WHEN NOT clash THEN tier END AS tier,
  CASE WHEN clash THEN 'ambiguous' WHEN one IS NOT NULL THEN 'matched' ELSE 'unresolved' END AS status, CAST(coalesce(n_candidates, 0) AS BIGINT) AS n_candidates
FROM p LEFT JOIN b ON b.pre = p.link_row"""


@query(_TIERED)
def tiered_join(spark, d):  # noqa: ANN001, ANN201
    links = table(spark, d, "fixture_links")
    pre, res = links.filter("lifecycle_state = 'scheduled'").withColumnRenamed("link_row", "pre"), links.filter("lifecycle_state = 'finished'").withColumnRenamed("link_row", "res")
    pair = F.concat(F.lower("home_team"), F.lit("|"), F.lower("away_team"))
    return joins.tiered_join(pre, res, "pre", "res", [("detail", F.col("detail_url"), F.col("detail_url")), ("pair", pair, pair)])


@query("SELECT coalesce(m.match_id, l.match_id) AS match_id, CASE WHEN m.match_id IS NULL THEN 'right_only' WHEN l.match_id IS NULL THEN 'left_only' ELSE 'both' END AS join_status, n FROM (SELECT DISTINCT match_id FROM matches WHERE match_id IS NOT NULL) m FULL JOIN (SELECT match_id, count(*) AS n FROM fixture_links WHERE match_id IS NOT NULL GROUP BY 1) l ON m.match_id = l.match_id")
def outer_with_status(spark, d):  # noqa: ANN001, ANN201
    m = table(spark, d, "matches").select("match_id").dropna().distinct()
    links = table(spark, d, "fixture_links").filter("match_id is not null").groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))
    return joins.outer_with_status(m, links, "match_id").select("match_id", "join_status", "n")


@query("WITH f AS (SELECT 0 AS f, user_id AS id, max(event_type) AS last_type, 'view' AS k, count(*) AS v FROM events WHERE event_type = 'view' GROUP BY user_id UNION ALL SELECT 1, user_id, max(event_type), 'purchase', count(*) FROM events WHERE event_type = 'purchase' GROUP BY user_id) SELECT id, arg_max(last_type, f) AS last_type, max(v) FILTER (WHERE k = 'view') AS views, max(v) FILTER (WHERE k = 'purchase') AS purchases FROM f GROUP BY id")
def market_merge(spark, d):  # noqa: ANN001, ANN201
    e = table(spark, d, "events")
    feed = lambda t: e.filter(F.col("event_type") == t).groupBy(F.col("user_id").alias("id")).agg(F.max("event_type").alias("last_type"), F.create_map(F.lit(t), F.count(F.lit(1))).alias("counts"))
    out = joins.merge_feeds([feed("view"), feed("purchase")], "id", ["last_type"], ["counts"])
    return out.select("id", "last_type", F.col("counts")["view"].alias("views"), F.col("counts")["purchase"].alias("purchases"))


@query("WITH p AS (SELECT m.match_row, l.link_row FROM matches m JOIN fixture_links l ON m.match_id = l.match_id UNION SELECT m.match_row, l.link_row FROM matches m JOIN fixture_links l ON m.home_team = l.home_team) SELECT m.match_row, coalesce(len(list(p.link_row) FILTER (WHERE p.link_row IS NOT NULL)), 0) AS n_links, min(p.link_row) AS first_link FROM matches m LEFT JOIN p USING (match_row) GROUP BY 1")
def or_join_collect(spark, d):  # noqa: ANN001, ANN201
    m, links = table(spark, d, "matches"), table(spark, d, "fixture_links")
    out = joins.or_join(m, links, "match_row", "link_row", [("match_id", "match_id"), ("home_team", "home_team")], "links")
    return out.select("match_row", F.size("links").cast("bigint").alias("n_links"), F.array_min("links").alias("first_link"))


@query("""WITH s AS (SELECT a.p_partkey AS a, b.p_partkey AS b, abs(a.p_retailprice - b.p_retailprice) AS gap FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey <> b.p_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY gap, b) AS n, lead(gap) OVER (PARTITION BY a ORDER BY gap, b) AS nxt FROM s)
SELECT a, b, gap, CASE WHEN gap > 50 THEN 'below' WHEN nxt - gap < 5 THEN 'ambiguous' ELSE 'matched' END AS status FROM r WHERE n = 1""")
def margin_topk(spark, d):  # noqa: ANN001, ANN201
    out = joins.nearest_match(table(spark, d, "part"), "p_partkey", ["p_brand", "p_type"], "p_retailprice", "b", most=50.0, margin=5.0)
    return out.select(F.col("p_partkey").alias("a"), "b", "gap", "status")


@query("SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS open, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS full FROM lineitem GROUP BY 1")
def pivot_counts(spark, d):  # noqa: ANN001, ANN201
    out = table(spark, d, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).count().fillna(0)
    return out.select("l_returnflag", F.col("O").alias("open"), F.col("F").alias("full"))


@query("SELECT feature_row, 'home' AS side, home_ppg AS ppg FROM features WHERE home_ppg IS NOT NULL AND NOT isnan(home_ppg) UNION ALL SELECT feature_row, 'away', away_ppg FROM features WHERE away_ppg IS NOT NULL AND NOT isnan(away_ppg)")
def unpivot_measures(spark, d):  # noqa: ANN001, ANN201
    """One row per side that has a number; what is no number is no measure."""
    number = lambda c: F.when(~F.isnan(c), F.col(c))
    f = table(spark, d, "features").select("feature_row", number("home_ppg").alias("home"), number("away_ppg").alias("away"))
    return f.unpivot(["feature_row"], ["home", "away"], "side", "ppg").filter("ppg is not null")


@query("SELECT 'both' AS kind, c_nationkey AS nationkey FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'either', n FROM (SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'customers', c_nationkey FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_nationkey < 10)")
def set_operations(spark, d):  # noqa: ANN001, ANN201
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    kind = lambda n, x: x.select(F.lit(n).alias("kind"), "nationkey")
    return kind("both", c.intersect(s)).unionByName(kind("either", c.union(s).distinct())).unionByName(kind("customers", c.distinct().join(s.filter("nationkey < 10"), "nationkey", "left_anti")))


@query("SELECT match_row, m AS market FROM matches a, (VALUES ('1x2'), ('double_chance'), ('over25'), ('btts')) v(m) WHERE NOT EXISTS (SELECT 1 FROM report_predictions r WHERE r.match_id = a.match_id)")
def completion(spark, d):  # noqa: ANN001, ANN201
    idle = table(spark, d, "matches").join(table(spark, d, "report_predictions").select("match_id"), "match_id", "left_anti")
    return idle.select("match_row", F.explode(F.array(*[F.lit(m) for m in ("1x2", "double_chance", "over25", "btts")])).alias("market"))


@query("WITH o AS (SELECT match_id, 0 AS g, observed_at_utc AS seen_at, link_row AS r, lifecycle_state FROM fixture_links UNION ALL SELECT match_id, 1, updated_at, match_row, status FROM matches), k AS (SELECT *, row_number() OVER (PARTITION BY match_id, g ORDER BY seen_at DESC, r DESC) AS n, max(g) OVER (PARTITION BY match_id) AS top FROM o WHERE match_id IS NOT NULL) SELECT match_id, lifecycle_state AS state FROM k WHERE n = 1 AND g = top")
def upsert_replace(spark, d):  # noqa: ANN001, ANN201
    """States of the matches on index pages, replaced by those of the match records."""
    at = lambda c, r: (F.col(c).alias("at"), F.col(r).alias("r"))
    old = dedup.last_wins(table(spark, d, "fixture_links").filter("match_id is not null").select("match_id", F.col("lifecycle_state").alias("state"), *at("observed_at_utc", "link_row")), ["match_id"], ["at", "r"])
    new = table(spark, d, "matches").filter("match_id is not null").select("match_id", F.col("status").alias("state"), *at("updated_at", "match_row"))
    return sinks.upserted(old, new, ["match_id"], ["at", "r"]).select("match_id", "state")


@query("SELECT feature_row, CASE WHEN match_id IS NULL THEN 'match_id' WHEN home_ppg IS NULL OR NOT (home_ppg BETWEEN 0 AND 3) THEN 'home_ppg' WHEN sample_size_home IS NULL OR sample_size_home < 0 THEN 'sample_size_home' END AS reason FROM features")
def validate_quarantine(spark, d):  # noqa: ANN001, ANN201
    rules = [("match_id", F.col("match_id").isNotNull()), ("home_ppg", F.col("home_ppg").between(0, 3)), ("sample_size_home", F.col("sample_size_home") >= 0)]
    return sinks.validated(table(spark, d, "features"), rules).select("feature_row", "reason")


@query("SELECT link_row FROM fixture_links WHERE observed_at_utc < TIMESTAMP '2025-01-01' AND is_from_bytime")
def pushed_filter(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "fixture_links").filter(F.col("is_from_bytime") & (F.col("observed_at_utc") < F.lit("2025-01-01").cast("timestamp_ntz"))).select("link_row")


@query("SELECT f.feature_row FROM features f JOIN (SELECT match_id, min(match_kickoff) AS ko FROM features GROUP BY 1) k ON k.match_id = f.match_id WHERE f.collected_at < k.ko")
def leakage_filter(spark, d):  # noqa: ANN001, ANN201
    f = table(spark, d, "features")
    return f.join(f.groupBy("match_id").agg(F.min("match_kickoff").alias("ko")), "match_id").filter("collected_at < ko").select("feature_row")


@query("SELECT DISTINCT url, replace(regexp_replace(url, '^https://', 'https://www.'), '?', '?b=2&') AS normal, regexp_extract(url, '^https://([^/]*)', 1) AS host, nullif(regexp_extract(url, '[?&]m=([^&#]*)', 1), '') AS m, true AS fetchable, false AS restricted FROM snapshots")
def url_normal_form(spark, d):  # noqa: ANN001, ANN201
    s = table(spark, d, "snapshots").select("url").distinct()
    messy = F.concat(F.regexp_replace("url", "^https://", "HTTPS://WWW."), F.lit("&b=2&a=#x"))
    return s.select("url", urls.normal_form(messy).alias("normal"), urls.host(messy).alias("host"), urls.parameter(F.col("url"), "m").alias("m"), urls.fetchable_scheme(messy).alias("fetchable"), urls.restricted(messy, ["pdf", "zip"], ["/members/"], ["login.asp"]).alias("restricted"))


@query("SELECT url, CASE WHEN lower(url) LIKE '%pmatch_preview%' THEN 'preview' WHEN lower(url) LIKE '%result%' THEN 'result' WHEN lower(url) LIKE '%pmatch%' THEN 'match' ELSE 'unknown' END AS family, count(*) AS n FROM snapshots GROUP BY ALL")
def url_families(spark, d):  # noqa: ANN001, ANN201
    rules = [("pmatch_preview", "preview"), ("result", "result"), ("pmatch", "match")]
    return table(spark, d, "snapshots").groupBy("url", urls.first_rule(F.col("url"), rules, "unknown").alias("family")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS content_hash, trim(regexp_replace(regexp_replace(lower(coalesce(source, '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug FROM documents")
def hash_ids(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"), text.slug(F.coalesce("source", F.lit(""))).alias("slug"))


@query("SELECT match_row, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS named FROM (SELECT match_row, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('match:' || home_team)) AS h FROM matches)")
def name_based_ids(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "matches").select("match_row", ids.uuid5(F.concat(F.lit("match:"), F.col("home_team"))).alias("named"))


@query("SELECT n_nationkey, sha256('{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}') AS h FROM nation")
def canonical_hash(spark, d):  # noqa: ANN001, ANN201
    return table(spark, d, "nation").select("n_nationkey", text.canonical_hash(["n_nationkey", "n_name", "n_regionkey"]).alias("h"))


@query("SELECT part, CASE WHEN mod(part, 10) > 5 THEN 'x' END AS none_or_x, replace(CAST(part AS VARCHAR), '1', '') AS digits, p100 / 100.0 AS share FROM (SELECT p_partkey AS part, p_size AS p100 FROM part)")
def number_texts(spark, d):  # noqa: ANN001, ANN201
    p = table(spark, d, "part")
    pct = F.concat(F.col("p_size").cast("string"), F.lit("%"))
    return p.select(F.col("p_partkey").alias("part"), F.when(F.col("p_partkey") % 10 > 5, "x").alias("none_or_x"), F.replace(F.col("p_partkey").cast("string"), F.lit("1"), F.lit("")).alias("digits"), text.percent(pct).alias("share"))


@query("SELECT n.n_nationkey, r.r_name, count(*) AS n, min(s_acctbal) AS low FROM supplier JOIN nation n ON s_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey GROUP BY ALL")
def dimension_rollup(spark, d):  # noqa: ANN001, ANN201
    n = table(spark, d, "nation").withColumnRenamed("n_nationkey", "s_nationkey").withColumnRenamed("n_regionkey", "r_regionkey")
    out = table(spark, d, "supplier").join(n, "s_nationkey").join(table(spark, d, "region"), "r_regionkey")
    return out.groupBy(F.col("s_nationkey").alias("n_nationkey"), "r_name").agg(F.count(F.lit(1)).alias("n"), F.min("s_acctbal").alias("low"))


@query()
def fuzzy_similarity(spark, d):  # noqa: ANN001, ANN201
    """Distinct team names of one source with those of the other that share a normalised word and the country: score and verdict."""
    m = table(spark, d, "matches").withColumn("src", F.element_at(F.map_keys("source_urls"), 1))
    names = m.select("src", "country", F.explode(F.array("home_team", "away_team")).alias("name")).distinct().withColumn("norm", similarity.normalized_name("name"))
    blocks = names.withColumn("word", F.explode(F.array_distinct(F.split("norm", " ")))).filter("word <> ''")
    a, b = blocks.filter("src = 'soccerstats'"), blocks.filter("src <> 'soccerstats'")
    # a frequent word's block is cut into slices of about 1,000 names, each with a copy of the other side
    slices = a.groupBy("country", "word").agg(F.ceil(F.count(F.lit(1)) / 1000).alias("n"))
    a = a.join(slices, ["country", "word"]).select("country", "word", F.pmod(F.xxhash64("name"), "n").alias("slice"), F.col("name").alias("a"))
    b = b.join(slices, ["country", "word"]).select("country", "word", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("slice"), F.col("name").alias("b"))
    pairs = a.join(b, ["country", "word", "slice"]).select("country", "a", "b").distinct()
    return pairs.withColumn("c", similarity.compare_names("a", "b")).select("country", "a", "b", "c.*")


@query("SELECT CAST(julian(CAST(o_orderdate AS DATE)) - 2440588 AS BIGINT) AS day, count(*) AS n FROM orders GROUP BY 1")
def day_arithmetic(spark, d):  # noqa: ANN001, ANN201
    at = F.col("o_orderdate")
    day = timestamps.days_from_civil(F.year(at).cast("bigint"), F.month(at).cast("bigint"), F.day(at).cast("bigint"))
    return table(spark, d, "orders").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))


# Literal cases: inputs and what must come out, worked out by hand from the rules.
_CASES = [
    ("FC Roma", "Rome", True, 1.0, "exact"), ("Rosenborg", "Rosenborgs", True, 0.823, "similar"), ("Barcelona", "Barcelona B", False, 0.0, "reserve_mismatch"), ("Sporting CP", "Sporting GD", False, 0.64, "short_remainder"),
    ("Milan", "Inter Milan", True, 0.874, "similar"), ("West Ham", "West Ham United", True, 0.972, "similar"), ("Bristol City", "Bristol FB", False, 0.784, "ambiguous"), ("", "Roma", False, 0.0, "empty"),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', {str(ok).lower()}, CAST({x} AS DOUBLE), '{why}')" for a, b, ok, x, why in _CASES) + ") t(a, b, accepted, score, reason)")
def similarity_cases(spark, d):  # noqa: ANN001, ANN201
    df = spark.createDataFrame([c[:2] for c in _CASES], "a string, b string").withColumn("c", similarity.compare_names("a", "b"))
    return df.select("a", "b", "c.accepted", F.round("c.score", 3).alias("score"), "c.reason")


@query("""SELECT link_row, family, CASE WHEN family = 'unknown' THEN 'unknown' ELSE 'known' END AS category, scope FROM (SELECT link_row,
  CASE WHEN index_url LIKE '%matches.asp%' THEN 'matches' WHEN index_url LIKE '%results.asp%' THEN 'results' ELSE 'unknown' END AS family,
  coalesce(map {'0': 'results', '1': 'home_away', '2': 'home_away', '6': 'by_time_home_away', '100': 'results_all_games', '101': 'all_games', '102': 'all_games', '106': 'by_time_all_games', '200': 'results_last_8', '201': 'last_8', '202': 'last_8', '206': 'by_time_last_8'}[regexp_extract(index_url, '[?&]matchday=([^&#]*)', 1)], 'unknown_' || regexp_extract(index_url, '[?&]matchday=([^&#]*)', 1)) AS scope FROM fixture_links WHERE index_url IS NOT NULL)""")
def index_pages(spark, d):  # noqa: ANN001, ANN201
    links = table(spark, d, "fixture_links").filter("index_url is not null")
    url = F.col("index_url")
    links = timestamps.bind(links, kind=urls.family_a(url))
    links = timestamps.bind(links, told=urls.outcome(url, "index-a.example", F.col("kind")))
    told = F.col("told")
    return links.select("link_row", told["family"].alias("family"), told["category"].alias("category"), urls.scope_label(url).alias("scope"))


@query("SELECT m.match_row, arg_min(f.home_ppg, (k, feature_row)) FILTER (WHERE f.home_ppg IS NOT NULL) AS home_ppg, arg_min(f.sample_size_home, (k, feature_row)) FILTER (WHERE f.sample_size_home IS NOT NULL) AS sample_size_home, count(f.feature_row) = 0 AS missing_feature FROM matches m LEFT JOIN (SELECT *, -(CAST(home_ppg IS NOT NULL AS INT) + CAST(sample_size_home IS NOT NULL AS INT)) AS k FROM features) f ON f.match_id = m.match_id GROUP BY m.match_row")
def feature_attach(spark, d):  # noqa: ANN001, ANN201
    out = joins.attach_merged(table(spark, d, "matches").select("match_row", "match_id"), table(spark, d, "features"), "match_id", ["home_ppg", "sample_size_home"], ["feature_row"])
    return out.select("match_row", "home_ppg", "sample_size_home", "missing_feature")


@query("SELECT m.match_row, arg_min(r.report_row, (r.report_row)) AS report_row FROM matches m LEFT JOIN report_predictions r ON r.match_id = m.match_id GROUP BY 1")
def prediction_attach(spark, d):  # noqa: ANN001, ANN201
    return joins.attach_first(table(spark, d, "matches").select("match_row", "match_id"), table(spark, d, "report_predictions").select("match_id", "report_row"), "match_id", ["report_row"], ["report_row"]).select("match_row", "report_row")


@query("SELECT url, count(*) FILTER (WHERE extraction_method IS NOT NULL) AS n, arg_max(snapshot_id, (requested_at, snapshot_id)) FILTER (WHERE source = 'soccerstats') AS soccerstats_snapshot_id, arg_max(snapshot_id, (requested_at, snapshot_id)) FILTER (WHERE source = 'forebet') AS forebet_snapshot_id, bool_or(source = 'forebet') AS forebet_collected FROM snapshots WHERE url IS NOT NULL GROUP BY url")
def page_kinds(spark, d):  # noqa: ANN001, ANN201
    s = table(spark, d, "snapshots").filter("url is not null")
    each = s.groupBy("url").agg(F.count("extraction_method").alias("n"))
    out = joins.attach_kinds(each, s, "url", "source", ["soccerstats", "forebet"], ["snapshot_id"], ["requested_at", "snapshot_id"])
    return out.select("url", "n", "soccerstats_snapshot_id", "forebet_snapshot_id", "forebet_collected")


@query("WITH e AS (SELECT source AS family, content_length, snapshot_id, coalesce(response_status < 400, false) AS ok FROM snapshots), t AS (SELECT DISTINCT source AS family FROM documents WHERE source IS NOT NULL UNION SELECT DISTINCT source FROM snapshots WHERE source IS NOT NULL) SELECT t.family, count(e.snapshot_id) AS n, arg_min(snapshot_id, (CASE WHEN ok THEN 0 ELSE 1 END, CASE WHEN ok THEN -coalesce(content_length, 0) ELSE 0 END, snapshot_id)) AS representative, coalesce(bool_or(ok), false) AS any_ok FROM t LEFT JOIN e USING (family) GROUP BY 1")
def family_bucketing(spark, d):  # noqa: ANN001, ANN201
    s = table(spark, d, "snapshots")
    taxonomy = table(spark, d, "documents").select(F.col("source").alias("family")).union(s.select("source")).dropna().distinct()
    e = s.select(F.col("source").alias("family"), F.coalesce("content_length", F.lit(0)).alias("size"), "snapshot_id", F.col("response_status"))
    out = joins.in_families(taxonomy, e, "family", "size", ["snapshot_id"], F.col("response_status") < 400)
    return out.select("family", "n", F.col("representative.snapshot_id").alias("representative"), "any_ok")


@query("SELECT link_row, path, page_type FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY link_row, k) AS n FROM (SELECT link_row, preview_snapshot_path AS path, 'preview' AS page_type, 0 AS k FROM fixture_links UNION ALL SELECT link_row, result_snapshot_path, 'result', 1 FROM fixture_links UNION ALL SELECT link_row, detail_snapshot_path, 'detail', 2 FROM fixture_links) WHERE coalesce(path, '') <> '') WHERE n = 1")
def detail_pages(spark, d):  # noqa: ANN001, ANN201
    from fieldglass.sources import readers

    return readers.first_pages(table(spark, d, "fixture_links"), ["preview", "result", "detail"], "link_row").select("link_row", "path", "page_type")


@query("SELECT market, confidence_grade, CASE WHEN probability < 0.5 THEN '<50%' WHEN probability < 0.6 THEN '50-60%' WHEN probability < 0.7 THEN '60-70%' WHEN probability < 0.8 THEN '70-80%' WHEN probability < 0.9 THEN '80-90%' WHEN probability IS NOT NULL THEN '90%+' END AS class, count(*) AS n FROM report_predictions GROUP BY GROUPING SETS ((market), (confidence_grade), (class), (market, confidence_grade), ())")
def five_way_counts(spark, d):  # noqa: ANN001, ANN201
    r = table(spark, d, "report_predictions").select("market", "confidence_grade", metrics.probability_class(F.col("probability")).alias("class"))
    return metrics.by_grouping_sets(r, [["market"], ["confidence_grade"], ["class"], ["market", "confidence_grade"], []], [F.count(F.lit(1)).alias("n")]).select("market", "confidence_grade", "class", "n")


@query("SELECT regexp_replace(http_error, '0x[0-9a-fA-F]+', '0x..', 'g') AS error, count(*) AS n FROM snapshots WHERE http_error IS NOT NULL GROUP BY 1")
def failure_counts(spark, d):  # noqa: ANN001, ANN201
    return metrics.failure_histogram(table(spark, d, "snapshots"), "http_error")


@query("SELECT feature_row, home_ppg - away_ppg AS ss_ppg_diff, home_ppg + away_ppg AS ss_ppg_sum, (home_ppg + away_ppg) / 2 AS ss_ppg_avg, CASE WHEN home_ppg > away_ppg THEN '1' WHEN home_ppg < away_ppg THEN '2' WHEN home_ppg = away_ppg THEN 'X' END AS ss_ppg_fav, CASE WHEN sample_size_home IS NOT NULL AND sample_size_away IS NOT NULL THEN least(sample_size_home, sample_size_away) END AS ss_sample_min FROM features WHERE home_ppg IS NOT NULL AND away_ppg IS NOT NULL AND NOT isnan(home_ppg) AND NOT isnan(away_ppg)")
def flat_features(spark, d):  # noqa: ANN001, ANN201
    from fieldglass.sources import layouts

    f = layouts.core_numbers(table(spark, d, "features"), ["home_ppg", "away_ppg"])
    fields = metrics.paired_columns({"ppg": (F.col("home_ppg"), F.col("away_ppg"))}) | {"sample_min": text.least_of_both(F.col("sample_size_home"), F.col("sample_size_away"))}
    return metrics.flattened(f, {"row": F.col("feature_row"), **fields}, "ss").withColumnRenamed("ss_row", "feature_row")


@query("SELECT match_row, map_keys(source_urls)[1] AS first_source, octet_length(encode(coalesce(home_team, ''))) AS n_bytes, len(regexp_extract_all(coalesce(away_team, ''), '[A-Za-z]+')) AS n_words, created_at + INTERVAL 150 MINUTE AS due, date_trunc('day', created_at) + INTERVAL 1170 MINUTE AS evening FROM matches")
def scalar_texts(spark, d):  # noqa: ANN001, ANN201
    m = table(spark, d, "matches")
    return m.select("match_row", text.first_key(F.col("source_urls")).alias("first_source"), text.byte_length(F.col("home_team")).alias("n_bytes"), F.size(text.find_all(F.coalesce("away_team", F.lit("")), "[A-Za-z]+")).alias("n_words"), text.plus_minutes(F.col("created_at"), 150).alias("due"), text.at_clock(F.col("created_at"), F.lit("19:30")).cast("timestamp_ntz").alias("evening"))


@query("SELECT report_row, probability FROM report_predictions ORDER BY probability DESC NULLS LAST, report_row LIMIT 40")
def most_probable(spark, d):  # noqa: ANN001, ANN201
    """A report of the 40 most probable selections; the row number breaks ties."""
    return table(spark, d, "report_predictions").select("report_row", "probability").orderBy(F.col("probability").desc_nulls_last(), "report_row").limit(40)


@query("SELECT bucket, n, hit_rate, gap FROM (SELECT " + _CASE + " AS bucket, count(*) AS n, count(*) FILTER (WHERE hit) / count(*) AS hit_rate, count(*) FILTER (WHERE hit) / count(*) - avg(p) AS gap FROM (SELECT l_quantity / 50 AS p, l_quantity > 30 AS hit FROM lineitem) GROUP BY 1) WHERE bucket IS NOT NULL AND n >= 10 AND abs(gap) < 0.45 AND hit_rate > 0.5")
def trusted_buckets(spark, d):  # noqa: ANN001, ANN201
    rows = table(spark, d, "lineitem").select((F.col("l_quantity") / 50).alias("p"), (F.col("l_quantity") > 30).alias("hit"))
    return metrics.trusted(metrics.calibration(rows, "p", "hit", EDGES), gap=0.45).select("bucket", "n", "hit_rate", "gap")


@query("""WITH RECURSIVE s AS (SELECT DISTINCT url, collection_run_id AS run FROM snapshots WHERE url IS NOT NULL AND collection_run_id IS NOT NULL), o AS (SELECT run, min(url) AS first FROM s GROUP BY 1), links AS (SELECT DISTINCT o.first AS src, s.url AS dst FROM s JOIN o USING (run)),
w(url, depth) AS (SELECT first, 0 FROM o UNION SELECT l.dst, w.depth + 1 FROM w JOIN links l ON l.src = w.url WHERE w.depth < 2), d AS (SELECT url, min(depth) AS depth FROM w GROUP BY 1)
SELECT d.url, CAST(d.depth AS INT) AS depth, min(p.url) AS found_from FROM d LEFT JOIN links l ON l.dst = d.url LEFT JOIN d p ON p.url = l.src AND p.depth = d.depth - 1 GROUP BY ALL""")
def stored_crawl(spark, d):  # noqa: ANN001, ANN201
    """Pages reached in two steps from the first page of every run, a page leading to all of its run's."""
    s = table(spark, d, "snapshots").select("url", F.col("collection_run_id").alias("run")).dropna().distinct()
    order = s.groupBy("run").agg(F.min("url").alias("first"))
    links = s.join(order, "run").select(F.col("first").alias("url"), F.col("url").alias("target"))
    return crawl.crawl(links, order.select(F.col("first").alias("url")), max_depth=2)


# Literal tables for the joins on names and the page layouts, and what must come out.
_LEFT = [(1, "d", "u1", "FC Roma", "Lazio"), (2, "d", "u2", "Rosenborg", "Molde"), (3, "d", None, "Lazio", "Roma"), (4, "e", None, "Roma", "Lazio"), (5, "d", None, None, "Lazio"), (6, "d", "u9", "Nowhere", "Elsewhere"), (7, "d", "x", "West Ham", "Molde")]
_RIGHT = [(10, "d", "u1", "Rome", "Lazio", 1), (11, "d", "y", "Roma", "Lazio", 2), (12, "d", "z", "Rosenborgs", "Molde", 3), (13, "d", None, "Nobody", None, 4), (14, "d", None, "West Ham United", "Molde", 5)]


def _sides(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame(_LEFT, "l int, day string, url string, home_team string, away_team string"), spark.createDataFrame(_RIGHT, "r int, day string, url string, home_team string, away_team string, o int")


def _values(rows: list[tuple], columns: str) -> str:
    text = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows) + f") t({columns})"


@query(_values([(1, 11, "exact"), (2, 12, "fuzzy"), (3, None, "unmatched_result"), (4, None, "unmatched_result"), (5, None, "unmatched_result"), (6, None, "unmatched_result"), (7, 14, "fuzzy")], "l, r, how"))
def result_reconciliation(spark, d):  # noqa: ANN001, ANN201
    return names.reconcile(*_sides(spark), "l", "r", ["day"], "o")


@query(_values([(1, "ambiguous"), (2, "matched"), (3, "ambiguous"), (4, "none"), (5, "none"), (6, "none"), (7, "matched")], "l, status"))
def permissive_match(spark, d):  # noqa: ANN001, ANN201
    """Two right rows are Roma and Lazio, so row 1, and row 3 with its sides exchanged, are torn between them."""
    return names.match_with_margin(*_sides(spark), "l", "r", ["day"], swap=True).select("l", "status")


@query(_values([(1, 10, "exact"), (1, 11, "exact"), (2, 12, "fuzzy"), (3, None, "left_only"), (4, None, "left_only"), (5, None, "left_only"), (6, None, "left_only"), (7, 14, "fuzzy"), (None, 13, "right_only")], "l, r, join_status"))
def research_join(spark, d):  # noqa: ANN001, ANN201
    return names.outer_with_margin(*_sides(spark), "l", "r", ["day"])


@query(_values([(1, 10, "url", "matched"), (2, None, None, "unresolved"), (3, None, None, "unresolved"), (4, None, None, "unresolved"), (5, None, None, "unresolved"), (6, None, None, "unresolved"), (7, 14, "similar", "matched")], "l, r, tier, status"))
def cross_run_tiers(spark, d):  # noqa: ANN001, ANN201
    """Equal URL, then day and both normal forms, then day and a similarity of 0.85 on both sides."""
    left, right = _sides(spark)
    a, b = names.with_forms(left), names.with_forms(right)
    pair = F.when((F.col("_h") != "") & (F.col("_a") != ""), F.concat_ws("|", "day", "_h", "_a"))
    similar = names.scored_pairs(left, right, "l", "r", ["day"], both_least=0.85).filter("accepted")
    return joins.tiered_join(a, b, "l", "r", [("url", F.col("url"), F.col("url")), ("pair", pair, pair)], last=("similar", similar)).select("l", "r", "tier", "status")


_PAGES = [
    "<table id=btable><tr class=trow3><td><b>A - One</b></td></tr><tr class=trow8><td>19:30</td><td>X</td><td>-</td><td>Y</td><td><a href=p1>s</a></td></tr><tr class=trow8><td>FT</td><td>V</td><td></td><td>W</td><td></td></tr></table>",
    "<table><tbody><tr><td>Thu 23 Jul 01:00</td><td></td><td>ECU</td><td>Manta</td><td>1:1</td><td>LDU</td><td><a href=pmatch.asp?x>d</a></td></tr></tbody></table>",
    "Alpha Beta vs Gamma, Delta vs Epsilon and Al vs Bo", None,
]


@query(_values([(0, "A - One", "X", "Y", "pre-match", "p1"), (0, "A - One", "V", "W", "finished", ""), (1, "ECU", "Manta", "LDU", "1:1", "pmatch.asp?x"), (2, None, "Alpha Beta", "Gamma", None, None), (2, None, "Delta", "Epsilon", None, None)], "k, competition, home, away, status, href"))
def page_fixtures(spark, d):  # noqa: ANN001, ANN201
    """The fixtures of literal pages by the first layout that reads any: legacy, by time, named pairs."""
    from fieldglass.sources import layouts, pages

    p = pages.page_rows(spark.createDataFrame(list(enumerate(_PAGES)), "k bigint, html string"), "k", "html")
    rows = pages.rows_of(p, "k")
    timed = layouts.by_time_index(rows, "k").select("k", F.col("country").alias("competition"), "home", "away", F.col("score").alias("status"), "href")
    named = p.select("k", F.explode(layouts.named_pairs(F.col("text"))).alias("x")).select("k", "x.home", "x.away")
    legacy = layouts.legacy_index(rows, "k").select("k", "competition", "home", "away", "status", "href")
    return layouts.first_layout(p, "k", [legacy, timed, named])
