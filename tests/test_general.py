import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldglass.functions import similarity as sim
from fieldglass.functions import text, urls
from fieldglass.operators import crawl, dedup, joins, metrics
from fieldglass.sources import html, readers, sinks
from fieldglass.streaming import sightings


def test_reductions(spark):
    df = spark.createDataFrame([("a", 1, None, "x"), ("a", 2, 5.0, None), ("b", 1, None, None), (None, 3, 1.0, "y")], "k string, o int, v double, w string")
    assert {(r.k, r.o) for r in dedup.first_wins(df, ["k"], ["o"]).collect()} == {("a", 1), ("b", 1), (None, 3)}
    assert {(r.k, r.o) for r in dedup.last_wins(df, ["k"], ["o"]).collect()} == {("a", 2), ("b", 1), (None, 3)}
    assert {tuple(r) for r in dedup.coalesce_merge(df, ["k"], ["v", "w"], ["o"]).collect()} == {("a", 5.0, "x"), ("b", None, None), (None, 1.0, "y")}
    assert dedup.first_wins(df.limit(0), ["k"], ["o"]).count() == 0


def test_joins(spark):
    left = spark.createDataFrame([(1, "h", "a"), (2, "h", "z"), (3, None, "a")], "id int, h string, a string")
    right = spark.createDataFrame([("h", "a", 10), ("h", "", 11), ("h", None, 12)], "h string, a string, r int")
    assert {(r.id, r.r) for r in joins.pair_join(left, right, "h", "a", ["r"]).collect()} == {(1, 10), (1, 11), (1, 12), (2, 11), (2, 12), (3, None)}
    scored = spark.createDataFrame([(1, 5, 0.9), (1, 5, 0.9), (1, 6, 0.88), (2, 5, 0.9), (3, 5, 0.2)], "l int, r int, s double")
    assert {(r.l, r.r, r.status) for r in joins.margin_match(scored, "l", "r", "s", least=0.8, margin=0.05).collect()} == {(1, 5, "ambiguous"), (2, 5, "matched"), (3, 5, "below")}
    a, b = spark.createDataFrame([(1, "u", "p"), (2, "v", "p"), (3, "w", "q"), (4, None, None)], "a int, x string, y string"), spark.createDataFrame([(9, "u", "p"), (8, "n", "p"), (7, "w2", "q")], "b int, x string, y string")
    got = {(r.a, r.b, r.tier, r.status) for r in joins.tiered_join(a, b, "a", "b", [("x", F.col("x"), F.col("x")), ("y", F.col("y"), F.col("y"))]).collect()}
    assert got == {(1, 9, "x", "matched"), (2, None, None, "ambiguous"), (3, 7, "y", "matched"), (4, None, None, "unresolved")}


def test_metrics(spark):
    df = spark.createDataFrame([(True, 60, 1600), (False, 60, 3600), (True, 40, 3600), (None, 50, None)], "won boolean, p int, e int")
    r = df.agg(*metrics.outcome_aggregates("won", "p", "e")).first()
    assert (r.n, r.wins, r.losses, r.unresolved) == (4, 2, 1, 1) and math.isclose(r.hit_rate, 2 / 3) and math.isclose(r.avg_probability, 70)
    assert df.limit(0).agg(*metrics.outcome_aggregates("won", "p", "e")).first().hit_rate is None


def test_names():
    assert [sim.normalized(x) for x in ("Man Utd", "FC Köln", "Bayern Munich", "PSG")] == ["manchester united", "koln", "bayern munchen", "paris saint germain"]
    assert sim.same_entity("Nottingham F.", "Nottingham Forest")[0] and sim.same_entity("Hebei Kungfu", "Hebei Kung Fu")[0] and sim.same_entity("Shaanxi Union", "Shaanxi Changan Union")[0]
    assert not sim.same_entity("Manchester City", "Manchester United")[0]
    assert not sim.same_entity("Lyon", "Lyon U21")[0] and not sim.same_entity("Lyon", "Lyon Women")[0]
    assert sim.similarity(None, "x") == 0.0 and sim.same_pair("A B", "C D", "A B", "C D") == (True, 1.0)


def test_text_and_urls(spark):
    r = spark.range(1).select(
        text.slug(F.lit(" A--b ")).alias("slug"), text.percent(F.lit("72%")).alias("pct"), text.leading_int(F.lit("8th")).alias("n"), text.last_of(F.array(*map(F.lit, "wdlww")), 3).alias("last"),
        text.argmax({"1": F.lit(0.4), "X": F.lit(0.4), "2": F.lit(None)}).alias("best"), urls.normal_form(F.lit("HTTP://Www.A.com:80?b=1&a=2&c=#f")).alias("u"), urls.normal_form(F.lit("nothing")).alias("none"),
        urls.fetchable_scheme(F.lit("//x")).alias("s"), urls.same_domain(F.lit("https://www.a.com:8/x"), "a.com").alias("d"), urls.restricted(F.lit("https://a.com/x/file.PDF"), ["pdf"], [], []).alias("p"),
        text.split_once(F.lit("a vs b vs c"), " vs ")[1].alias("rest"),
    ).first()
    assert (r.slug, r.pct, r.n, r.last, r.best) == ("a_b", 0.72, 8, list("lww"), "1")
    assert (r.u, r.none, r.s, r.d, r.p, r.rest) == ("http://www.a.com/?a=2&b=1", None, False, True, True, "b vs c")


def test_html(spark):
    page = "<title>T</title><h1>H <b>x</b></h1><a href='/p'>l</a><a href='#x'>n</a><table><tr><td>1<td>2</tr><tr><th>a <i>b</i></th></table><script>var a='<table>';</script><table><tr><td>open"
    r = html.pages_to_rows(spark.createDataFrame([(1, page), (2, None), (3, "")], "id bigint, html string"), "id", "html").orderBy("id").collect()
    assert r[0].title == "T" and r[0].headings == ["H x"] and r[0].links == ["/p"] and [t.rows for t in r[0].tables] == [[["1", "2"], ["a b"]], [["open"]]]
    assert r[1].tables == [] and r[2].n_links == 0


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r/a.jsonl").write_text('{"id": 1}\n\n{"id": \n{"id": 3}\n')
    assert sorted(r.id for r in readers.json_lines(spark, f"{tmp_path}/r/*.jsonl", "id int").collect() if r.id) == [1, 3]
    assert readers.json_lines(spark, f"{tmp_path}/none.jsonl", "id int").count() == 0
    assert readers.files(spark, f"{tmp_path}/r", "jsonl").count() == 1 and readers.latest(spark, f"{tmp_path}/r/*").endswith("a.jsonl")
    with pytest.raises(ValueError):
        readers.run_root("/x", "../y")
    with pytest.raises(ValueError):
        readers.source("nope")
    df = spark.createDataFrame([(1, "a", 1)], "id int, v string, o int")
    sinks.freeze(df, f"{tmp_path}/frozen")
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.freeze(df, f"{tmp_path}/frozen")
    sinks.upsert_table(spark, f"{tmp_path}/t", df, ["id"], ["o"])
    last = sinks.upsert_table(spark, f"{tmp_path}/t", spark.createDataFrame([(1, "b", 1), (1, "c", 2), (2, "d", 1)], "id int, v string, o int"), ["id"], ["o"])
    assert sorted(tuple(r) for r in spark.read.parquet(last).select("id", "v").collect()) == [(1, "c"), (2, "d")]
    stored = spark.createDataFrame([], "content_hash string")
    assert sinks.new_contents(stored, spark.createDataFrame([("x",), ("x",), ("y",)], "content string")).count() == 2
    assert sinks.csv_projection(df, ["v", "zz"]).first().asDict() == {"v": "a", "zz": ""}


def test_crawl(spark):
    links = spark.createDataFrame([("s", "a"), ("s", "b"), ("a", "c"), ("b", "c"), ("c", "s"), ("c", "d"), (None, "x")], "url string, target string")
    got = {(r.url, r.depth, r.found_from) for r in crawl.crawl(links, spark.createDataFrame([("s",)], "url string"), max_depth=2).collect()}
    assert got == {("s", 0, None), ("a", 1, "s"), ("b", 1, "s"), ("c", 2, "a")}


def test_stream(spark, tmp_path):
    rows = [(1, "v", datetime(2024, 1, 1, 0, 1), 1.0), (1, "v", datetime(2024, 1, 1, 0, 2), 1.0), (2, "v", datetime(2024, 1, 1, 0, 7), 3.0)]
    spark.createDataFrame(rows, "id int, kind string, ts timestamp, value double").write.parquet(f"{tmp_path}/in")
    stream = sightings.read_folder(spark, f"{tmp_path}/in", "id int, kind string, ts timestamp, value double")
    q = sightings.append_to(sightings.first_sightings(stream, ["id"], "ts"), f"{tmp_path}/out", f"t{tmp_path.name}")
    q.awaitTermination(60)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]
