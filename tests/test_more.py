import random

import pytest
from pyspark.sql import functions as F

from fieldglass.functions import text, urls
from fieldglass.operators import crawl, dedup, metrics
from fieldglass.sources import readers, sinks


def test_crawl_caps_hold_within_the_walk(spark):
    links = spark.createDataFrame([("s", "a1", "A"), ("s", "a2", "A"), ("s", "b1", "B"), ("a2", "deep", "B"), ("a1", "b2", "B"), ("b1", "c", None)], "url string, target string, family string")
    seeds = spark.createDataFrame([("s",), (None,)], "url string")
    run = lambda **k: sorted((r.url, r.depth, r.found_from) for r in crawl.crawl(links, seeds, max_depth=3, **k).collect())
    assert [r[0] for r in run()] == ["a1", "a2", "b1", "b2", "c", "deep", "s"]
    assert [r[0] for r in run(per_family=1)] == ["a1", "b1", "c", "s"]  # a2 is over its family's cap, so deep is never found; b2 comes after b1
    assert run(max_pages=3) == [("a1", 1, "s"), ("a2", 1, "s"), ("s", 0, None)]
    assert crawl.crawl(links, seeds.limit(0), max_depth=2).count() == 0


def test_ordered_reductions_over_ranges(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot", "hot", "hot", "x", None]), i, rnd.choice([None, None, i]), rnd.choice("ab")) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, v int, kind string")
    last, want = {}, {}
    for k, t, v, _ in rows:
        last[k] = v if v is not None else last.get(k)
        want[t] = last[k]
    assert {r.t: r.out for r in dedup.fill_forward(df, ["k"], ["t"], "v", "out").collect()} == want
    nxt, pairs = {}, {}
    for k, t, _, kind in reversed(rows):
        if kind == "a":
            pairs[t] = nxt[k][1] if k in nxt and nxt[k][0] == "b" else None
        nxt[k] = (kind, t)
    assert {r.t: r.next_t for r in dedup.pair_rows(df, ["k"], ["t"], F.col("kind") == "a", F.col("kind") == "b", ["t"]).collect()} == pairs
    assert dedup.fill_forward(df.limit(0), ["k"], ["t"], "v", "out").count() == 0
    top = {(r.k, r.t): r["rank"] for r in dedup.top_k(df.filter("k is not null").repartition(7), ["k"], [F.desc("t")], 3).collect()}
    assert top == {(k, t): n + 1 for k in ("hot", "x") for n, t in enumerate(sorted((t for q, t, *_ in rows if q == k), reverse=True)[:3])}
    marked = {r.t: r.kind for r in dedup.mark_duplicates(df, "k", ["t"], "kind", "dup").collect()}
    firsts = {k: t for k, t, *_ in reversed(rows) if k}
    assert marked == {t: kind if k is None or firsts[k] == t else "dup" for k, t, _, kind in rows}


def test_urls(spark):
    cases = [
        ("https://www.a.com/matches.asp?matchday=2&ms=b", "matches", "unknown", "known", "home_away_expanded_b", True), ("https://a.com/formtable.asp", "form_table", "unknown", "known", "unknown_", True), ("https://a.com/", "homepage", "unknown", "known", "unknown_", True),
        ("https://a.com/table.asp?x=projected", "projected_points", "unknown", "known", "unknown_", True), ("ftp://a.com/x", "unknown", "unknown", "restricted", "unknown_", False), ("https://b.com/x", "unknown", "unknown", "external", "unknown_", False), ("https://a.com/x.pdf?y=.asp", "unknown", "unknown", "restricted", "unknown_", False),
        ("https://a.com/en/football-predictions/spain", "unknown", "country_page", "unknown", "unknown_", True), ("https://a.com/en/football-predictions/spain/liga", "unknown", "competition_page", "unknown", "unknown_", True), ("https://a.com/football-match-previews/12-x-y", "unknown", "match_preview_article", "unknown", "unknown_", True),
        ("https://a.com/football-match-previews", "unknown", "match_preview_index", "unknown", "unknown_", True), ("https://a.com/value-bets", "unknown", "values_or_odds", "unknown", "unknown_", True),
    ]
    df = spark.createDataFrame([c[:1] for c in cases], "u string")
    u = F.col("u")
    got = df.select(u, urls.family_a(u), urls.family_b(u), urls.outcome(u, "a.com", urls.family_a(u))["category"], urls.scope_label(u), urls.allowed(u, "a.com")).collect()
    assert [tuple(r) for r in got] == cases
    one = df.limit(1).select(urls.market_urls("http://x", F.lit("2025-01-01"), ["uo", "nope", "1x2"], ["1x2", "uo"]).alias("m"), urls.directory(F.array(*map(F.lit, ["/l?league=b", "/l?league=a&x=1", "/l?league=b", "/x"])), "league").alias("d"), urls.family_a(F.lit(None).cast("string")).alias("n")).first()
    assert [m.market for m in one.m] == ["uo", "1x2"] and one.m[0].url.startswith("http://x?ln=en&tp=uo&in=2025-01-01") and one.d == ["a", "b"] and one.n is None
    assert urls.seeds({"s": ["x"]}, "s") == ["x"] and urls.seeds({"s": ["x"]}, "s", ["y"]) == ["y"] and urls.seeds({}, "s") == []


def test_texts(spark):
    values = [0.00005, 0.00015, 0.12345, 2.5, 1.00005, -0.00025, 0.30001, 2.675, None]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "v double").select(text.half_even(F.col("v"), 4).alias("x")).collect()]
    assert got == [None if v is None else round(v, 4) for v in values]
    a = spark.createDataFrame([(1, "x", "r1"), (2, None, "r2")], "match_id int, v string, run_id string")
    b = spark.createDataFrame([(2, None, "r9"), (1, "x", "r9")], "match_id int, v string, run_id string")
    c = spark.createDataFrame([(2, "", "r9"), (1, "x", "r9")], "match_id int, v string, run_id string")
    h = [text.list_hash(x, "match_id").first().list_hash for x in (a, b, c)]
    assert h[0] == h[1] != h[2]
    df = spark.sql("select named_struct('b', named_struct('c', cast(null as int))) a, map('k', 1) m, cast(null as map<string,int>) e")
    assert tuple(df.select(text.with_default(F.col("a"), "b.c", 7), text.first_key(F.col("m")), text.first_key(F.col("e"), "none")).first()) == (7, "k", "none")


def test_reports_and_sinks(spark, tmp_path):
    (tmp_path / "run1").mkdir()
    good = '{"result_pages":[{"match_id":"m","home_team":"A","away_team":"B","summary":{"final_score":{"home":1,"away":0},"total_goals":1}},{"match_id":"n","summary":{"final_score":{"home":1}}},{"match_id":"o","summary":null}]}'
    for name, body in (("details_1.json", good), ("details_2.json", "{broken"), ("report_2025-01-01.json", "{}")):
        (tmp_path / name).write_text(body)
    got = readers.result_reports(spark, f"{tmp_path}/details_*.json").collect()
    assert [(r.match_id, r.home_score, r.away_score, r.source_report) for r in got] == [("m", 1, 0, "details_1.json")]
    assert readers.result_reports(spark, f"{tmp_path}/none_*.json").count() == 0
    assert readers.probed_run(spark, [str(tmp_path / "x"), str(tmp_path)], "run1").endswith("run1")
    for bad in (lambda: readers.probed_run(spark, [str(tmp_path)], "run2"), lambda: readers.frozen_report(spark, str(tmp_path), "2025-01-02", "a int")):
        with pytest.raises(FileNotFoundError):
            bad()
    df = spark.createDataFrame([("a", True), ("b", None), ("a", False)], "family string, won boolean")
    row = sinks.freeze_with_summary(df, str(tmp_path / "frozen"), {"n": F.lit(True), "wins": F.col("won")}).first()
    assert (row.n, row.wins) == (3, 1) and row.frozen_at is not None
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.freeze(df, str(tmp_path / "frozen"))
    assert sinks.markdown_summary(df, "T", "family", {"Run": 1}).splitlines() == ["# T", "", "Run: 1", "", "| family | count |", "|-|-|", "| a | 2 |", "| b | 1 |"]
    for _ in range(2):
        sinks.create_tables(spark, {"t_one": "a int, b string"})
    assert spark.table("default.t_one").columns == ["a", "b"]
    assert [tuple(r) for r in df.agg(metrics.hit_rate("won").alias("h")).collect()] == [(0.5,)] and df.limit(0).agg(metrics.hit_rate("won")).first()[0] == 0
    status = spark.createDataFrame([(200, "x"), (404, "x"), (200, ""), (200, None), (None, "x")], "s int, c string")
    assert [r[0] for r in status.select(sinks.page_status(F.col("s"), F.col("c"))).collect()] == ["unparsed", "error", "error", "error", "unparsed"]
    scores = spark.createDataFrame([(1, 0), (2, 2), (0, 3), (None, 1)], "h int, a int")
    got = [tuple(r) for r in scores.select(*[c.alias(n) for n, c in metrics.score_columns(F.col("h"), F.col("a")).items()]).collect()]
    assert got == [("1", 1, "no", "under"), ("X", 4, "yes", "over"), ("2", 3, "no", "over"), (None, None, None, None)]
