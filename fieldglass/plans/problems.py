"""Queries of the core training-data problems, over the whole tables, with production parameters, and their SQL.

Timestamps without zone mean UTC; the session's time zone must be UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.functions.ids import no_id, uuid_hex
from fieldglass.operators import asof, drift, references, timestamps
from fieldglass.session import table

#: States of a record that no longer exists (fixed values).
GONE = ("deleted", "removed", "purged")
#: The target schema of the link files.
LINK_FIELDS = {
    "match_id": "string", "competition": "string", "home_team": "string", "away_team": "string", "status": "string", "detail_url": "string", "scope": "string", "kickoff_utc": "string", "kickoff_confidence": "string",
    "lifecycle_state": "string", "pre_match_eligible": "boolean", "preview_collected": "boolean", "result_collected": "boolean", "result_snapshot_id": "string", "detail_snapshot_path": "string",
}


def micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def gone(c: str) -> Column:
    return F.coalesce(F.lower(F.trim(F.col(c))).isin(*GONE), F.lit(False))


def _references(df: DataFrame, name: str, row: str, at: str, fields: list[str]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("src_field"), F.col(f).alias("id")) for f in fields])).alias("x")
    df = df.select(F.lit(name).alias("src_table"), F.col(row).alias("src_row"), F.date_format(at, "yyyy-MM").alias("period"), micros(at).alias("ref_us"), each)
    df = df.select("src_table", "x.src_field", "src_row", "period", "ref_us", "x.id").filter(~no_id(F.col("id")))
    return df.withColumn("key_hex", uuid_hex(F.col("id"))).drop("id")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    carry = ["src_table", "src_field", "src_row", "period"]
    to_match = _references(table(spark, d, "report_predictions"), "report_predictions", "report_row", "created_at", ["match_id"])
    to_page = _references(table(spark, d, "fixture_links"), "fixture_links", "link_row", "observed_at_utc", ["preview_snapshot_id", "result_snapshot_id"])
    matches = table(spark, d, "matches").select(uuid_hex(F.col("match_id")).alias("key_hex"), micros("created_at").alias("seen_us"), micros("updated_at").alias("order_us"), F.col("match_row").alias("order_row"), gone("status").alias("gone"))
    pages = table(spark, d, "snapshots").select(uuid_hex(F.col("snapshot_id")).alias("key_hex"), micros("requested_at").alias("seen_us"), micros("requested_at").alias("order_us"), F.lit(0).cast("bigint").alias("order_row"), gone("validation_status").alias("gone"))
    return references.failing_references(to_match, matches, carry=carry).unionByName(references.failing_references(to_page, pages, carry=carry))


def p1_by_period(spark: SparkSession, d: str) -> DataFrame:
    return references.miss_counts(p1_found(spark, d), ["src_table", "src_field", "period"])


def scope_key(c: Column) -> Column:
    """A scope however spelled, as home_away, all_games, last_8 or another lower-case name."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), r"[\s \-_]+", "_")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "fixture_links").select(uuid_hex(F.col("match_id")).alias("entity"), F.col("link_row").alias("event_id"), micros("observed_at_utc").alias("t"))
    rows = table(spark, d, "features").filter((scope_key(F.col("feature_scope")) == "home_away") & (F.col("feature_cutoff") <= F.col("match_kickoff")))
    rows = rows.select(uuid_hex(F.col("match_id")).alias("entity"), F.col("feature_row").alias("version_id"), micros("feature_cutoff").alias("valid"), micros("collected_at").alias("recorded"))
    return asof.as_of(links, rows).select(F.col("event_id").alias("link_row"), F.col("version_id").alias("feature_row"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    matches = table(spark, d, "matches").select(F.lit("matches").alias("src_table"), F.col("match_row").alias("src_row"), F.col("scheduled_kickoff").alias("text"), F.col("timezone").alias("zone"))
    links = table(spark, d, "fixture_links").select(F.lit("fixture_links").alias("src_table"), F.col("link_row").alias("src_row"), F.col("kickoff_utc").alias("text"), F.when(F.col("kickoff_confidence") == "explicit_pmatch_utc", "UTC").alias("zone"))
    rows = matches.unionByName(links).filter(F.col("text").rlike(r"[^\s ]"))
    rows = timestamps.to_instant(rows, "text", F.col("zone"))
    return rows.select("src_table", "src_row", F.coalesce(timestamps.iso_text(F.col("instant_s")), F.lit("unresolved")).alias("kickoff_instant"))


def link_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.ingest(table(spark, d, "link_lines"), LINK_FIELDS, rescue="rescued")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(link_table(spark, d), LINK_FIELDS, rescue="rescued").select("feed", "run_no", "change", "field_before", "field_after")


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    """All link lines as one typed table; values no column holds stay in `rescued`."""
    df = link_table(spark, d)
    for column, paths in drift.approved(df, LINK_FIELDS, rescue="rescued").items():
        df = drift.promote(df, column, LINK_FIELDS[column], [f"$.{p}" for p in paths], rescue="rescued")
    return df.select("line_id", "feed", "run_no", *LINK_FIELDS, "rescued")


def p6_kept(spark: SparkSession, d: str) -> DataFrame:
    """By file, how many plain values its readable lines hold in the typed table, in columns or rescued: as many as in the raw lines."""
    df = p6_table(spark, d)
    typed = sum((F.col(c).isNotNull().cast("int") for c in LINK_FIELDS), F.lit(0))
    left = F.when(~F.coalesce(F.col("rescued").startswith('{"_unreadable"'), F.lit(False)), F.regexp_count("rescued", F.lit(r'(?:[:\[,])(?:"(?:[^"\\\\]|\\\\.)*"(?=[,}\]])|true|false|-?[0-9])')))
    return df.groupBy("feed", "run_no").agg(F.sum(typed + F.coalesce(left, F.lit(0))).cast("bigint").alias("n_values"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": p1_found, "p1_by_period": p1_by_period, "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found, "p6_table": p6_table, "p6_kept": p6_kept}

_HEX = "lower(regexp_replace({}, '^[\\s{{}}]+|[\\s{{}}]+$|-', '', 'g'))"
_ID = "nullif(regexp_extract(" + _HEX + ", '^[0-9a-f]{{32}}$'), '')"
_HAS = "{0} IS NOT NULL AND lower(trim({0}, ' \t\r\n')) NOT IN ('', 'null', 'none', 'n/a')"
_P1 = f"""
WITH m AS (SELECT {_ID.format('match_id')} AS k, arg_max(lower(trim(status)), (updated_at, match_row)) AS st, min(created_at) AS seen FROM matches GROUP BY 1),
s AS (SELECT {_ID.format('snapshot_id')} AS k, arg_max(lower(trim(validation_status)), requested_at) AS st, min(requested_at) AS seen FROM snapshots GROUP BY 1),
r AS (
  SELECT 'report_predictions' AS src_table, 'match_id' AS src_field, report_row AS src_row, created_at AS at, match_id AS id FROM report_predictions WHERE {_HAS.format('match_id')}
  UNION ALL SELECT 'fixture_links', 'preview_snapshot_id', link_row, observed_at_utc, preview_snapshot_id FROM fixture_links WHERE {_HAS.format('preview_snapshot_id')}
  UNION ALL SELECT 'fixture_links', 'result_snapshot_id', link_row, observed_at_utc, result_snapshot_id FROM fixture_links WHERE {_HAS.format('result_snapshot_id')}),
p AS (SELECT 'match_id' AS f, * FROM m UNION ALL SELECT 'page', * FROM s),
j AS (
  SELECT r.src_table, r.src_field, r.src_row, strftime(r.at, '%Y-%m') AS period,
    CASE WHEN p.k IS NULL THEN 'missing' WHEN p.st IN ('deleted', 'removed', 'purged') THEN 'deleted' WHEN p.seen > r.at THEN 'late' END AS reason
  FROM r LEFT JOIN p ON p.k = {_ID.format('r.id')} AND p.f = CASE WHEN r.src_field = 'match_id' THEN 'match_id' ELSE 'page' END),
found AS (SELECT * FROM j WHERE reason IS NOT NULL)
"""
_P6 = """
WITH objs AS (SELECT feed, run_no, line_no, CAST(payload AS JSON) AS o FROM link_lines WHERE json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload END) = 'OBJECT'),
files AS (SELECT feed, run_no, row_number() OVER (PARTITION BY feed ORDER BY run_no) AS pos, count(*) OVER (PARTITION BY feed) AS n FROM (SELECT DISTINCT feed, run_no FROM link_lines)),
x AS (SELECT feed, run_no, line_no, json_extract_string(o, '$.match_id') AS k, unnest(json_keys(o)) AS field, o FROM objs),
v AS (SELECT f.feed, f.pos, x.line_no, x.k, x.field, json_type(x.o, '$.' || x.field) AS t, CAST(json_extract(x.o, '$.' || x.field) AS VARCHAR) AS val FROM x JOIN files f USING (feed, run_no)),
h AS (SELECT feed, pos, field, nullif(string_agg(DISTINCT CASE WHEN t IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT') THEN 'number' ELSE t END, '+' ORDER BY CASE WHEN t IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT') THEN 'number' ELSE t END) FILTER (WHERE t <> 'NULL'), '') AS kinds FROM v GROUP BY ALL),
h2 AS (SELECT *, coalesce(lag(pos) OVER w < pos - 1, true) AS fresh, lead(pos) OVER w AS nxt FROM h WINDOW w AS (PARTITION BY feed, field ORDER BY pos)),
h3 AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY feed, field ORDER BY pos) AS streak FROM h2),
h4 AS (SELECT *, last_value(kinds IGNORE NULLS) OVER (PARTITION BY feed, field, streak ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM h3),
added AS (SELECT feed, pos, field FROM h4 WHERE fresh AND pos > 1),
removed AS (SELECT h4.feed, h4.pos + 1 AS pos, field FROM h4 JOIN files f ON f.feed = h4.feed AND f.pos = h4.pos WHERE h4.pos < f.n AND (nxt IS NULL OR nxt > h4.pos + 1)),
firsts AS (SELECT feed, pos, k, min(line_no) AS line_no FROM v WHERE k IS NOT NULL GROUP BY ALL),
vals AS (SELECT v.feed, v.pos, v.k, v.field, v.val FROM v JOIN firsts USING (feed, pos, k, line_no) WHERE v.t <> 'NULL'),
pairs AS (SELECT r.feed, r.pos, r.field AS f, a.field AS g, p.k FROM removed r JOIN added a ON a.feed = r.feed AND a.pos = r.pos JOIN firsts p ON p.feed = r.feed AND p.pos = r.pos - 1 JOIN firsts q ON q.feed = r.feed AND q.pos = r.pos AND q.k = p.k),
same AS (SELECT p.feed, p.pos, p.f, p.g, count(a.val) AS n FROM pairs p LEFT JOIN vals a ON a.feed = p.feed AND a.pos = p.pos - 1 AND a.k = p.k AND a.field = p.f LEFT JOIN vals b ON b.feed = p.feed AND b.pos = p.pos AND b.k = p.k AND b.field = p.g GROUP BY ALL HAVING count(*) FILTER (WHERE a.val IS DISTINCT FROM b.val) = 0 AND count(a.val) > 0),
renamed AS (SELECT * FROM same QUALIFY row_number() OVER (PARTITION BY feed, pos, f ORDER BY n DESC, f, g) = 1 AND row_number() OVER (PARTITION BY feed, pos, g ORDER BY n DESC, f, g) = 1),
c AS (
  SELECT feed, pos, 'renamed' AS change, f AS field_before, g AS field_after FROM renamed
  UNION ALL SELECT feed, pos, 'removed', field, '' FROM removed r WHERE NOT EXISTS (SELECT 1 FROM renamed q WHERE q.feed = r.feed AND q.pos = r.pos AND q.f = r.field)
  UNION ALL SELECT feed, pos, 'added', '', field FROM added r WHERE NOT EXISTS (SELECT 1 FROM renamed q WHERE q.feed = r.feed AND q.pos = r.pos AND q.g = r.field)
  UNION ALL SELECT feed, pos, 'retyped', field, field FROM h4 WHERE NOT fresh AND kinds <> was)
SELECT c.feed, f.run_no, c.change, c.field_before, c.field_after FROM c JOIN files f USING (feed, pos)
"""
SQL: dict[str, str] = {
    "p1_found": _P1 + "SELECT src_table, src_field, src_row, period, reason FROM found",
    "p1_by_period": _P1 + "SELECT src_table, src_field, period, reason, count(*) AS n_refs FROM found GROUP BY ALL",
    "p3_found": f"""
WITH v AS (SELECT {_ID.format('match_id')} AS k, feature_row, feature_cutoff, collected_at FROM features WHERE regexp_replace(lower(trim(feature_scope)), '[\\s\\-_]+', '_', 'g') = 'home_away' AND feature_cutoff <= match_kickoff)
SELECT l.link_row, arg_max(v.feature_row, (v.feature_cutoff, v.collected_at, -v.feature_row)) AS feature_row
FROM fixture_links l JOIN v ON v.k = {_ID.format('l.match_id')} AND v.collected_at <= l.observed_at_utc AND v.feature_cutoff <= l.observed_at_utc GROUP BY l.link_row""",
    "p6_found": _P6,
    "p6_kept": "SELECT feed, run_no, count(t.atom) FILTER (WHERE t.type NOT IN ('NULL', 'OBJECT', 'ARRAY')) AS n_values FROM link_lines LEFT JOIN LATERAL (SELECT atom, type FROM json_tree(CASE WHEN json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload END) = 'OBJECT' THEN payload END)) t ON true GROUP BY ALL",
}
