from datetime import datetime

from pyspark.sql import functions as F

from fieldglass.sources import html, layouts, pages

LEGACY = "<table id=btable><tr class=trow3><td><b>A - One</b></td></tr><tr class=trow8><td>19:30</td><td>X</td><td>-</td><td>Y</td><td><a href='p?1'>s</a></td></tr><tr class='trow8 odd'><td>P-P</td><td>V</td><td></td><td>W</td><td></td></tr><tr class=trow8><td>1</td></tr></table>"
TIMED = "<table><tbody><tr><td>Thu 23 Jul 01:00</td><td></td><td>ECU</td><td>Manta</td><td>1:1</td><td>LDU</td><td><a href='round_details.asp?x=1'>d</a></td><td><a href='latest.asp?league=ecuador'>l</a></td></tr><tr><td>no day</td><td></td><td>ECU</td><td>a</td><td>b</td><td>c</td></tr></tbody></table>"
NUMS = "".join(f"<td>{i}</td>" for i in range(13))
PREVIEW = f"Thu 23 Jul 2026 | 19:30 UTC<table><tr>{''.join(f'<th>{x}</th>' for x in 'P W D L GF GA W%'.split())}</tr><tr><td>X</td>{NUMS}</tr><tr><td>Y</td>{NUMS.replace('<td>3<', '<td>33%<')}</tr></table><table><tr><td>1.5+ 2.5+ 3.5+ BTS</td></tr><tr><td>Total</td>{''.join(f'<td>{x}%</td>' for x in (80, 60, 30, 2, 50))}<td>Total</td>{''.join(f'<td>{x}</td>' for x in (70, 50, 20, 1, 40))}</tr></table>"
SCORING = "".join(f"<table><tr><th>Scoring</th><th>Home</th><th>Away</th><th>All</th></tr><tr><td>GF per  match</td><td>{a}</td><td>{b}</td><td>0</td></tr></table>" for a, b in ((1.5, 1.1), (2.5, 2.1)))
SORTED = "<table class='sortable x'><tr><td>GF</td><td>1.5</td></tr><tr><td>PPG</td><td>n/a</td></tr></table><table class=sortable><tr><td>GF</td><td>2</td></tr></table>"
RESULT = "<p>Old (B) 2 : 1 New. Half-time score: (1 - 0) Corners 4 5 Surprise-Level: 12.5% Alpha Beta vs Gamma vs Delta Al vs Bo</p><table><tr><td>a</td></tr><tr><td> </td></tr></table><table><tbody><tr><td>b</td></tr></tbody></table>"
METRICS = "<table><tr><td>X</td><td>Home</td>" + "".join(f"<td>{i}%</td>" for i in range(12)) + "</tr></table>"


def test_layouts(spark):
    docs = spark.createDataFrame(list(enumerate([LEGACY, TIMED, PREVIEW, SCORING, SORTED, RESULT, METRICS, None, "", "<table><tr><td>open"])), "k bigint, html string")
    p = pages.page_rows(docs, "k", "html").cache()
    rows = pages.rows_of(p, "k").cache()
    one = lambda df: [tuple(r) for r in df.collect()]
    assert sorted(one(layouts.legacy_index(rows, "k"))) == [(0, 2, "A - One", "19:30", "X", "Y", "pre-match", "p?1"), (0, 3, "A - One", "P-P", "V", "W", "postponed", "")]
    assert one(layouts.by_time_index(rows, "k")) == [(1, 1, 1, "23 Jul", "01:00", "ECU", "Manta", "1:1", "LDU", "round_details.asp?x=1", "ecuador")]
    (k, home, away) = one(layouts.preview_tables(rows, "k"))[0]
    assert (k, home["gp"], home["ppg"], away["l"]) == (2, 0.0, 12.0, 33.0)
    assert one(layouts.goal_rates(rows, "k")) == [(2, {"over_15": 80.0, "over_25": 60.0, "over_35": 30.0, "tg": 2.0, "btts": 50.0}, {"over_15": 70.0, "over_25": 50.0, "over_35": 20.0, "tg": 1.0, "btts": 40.0})]
    assert one(layouts.scoring_tables(rows, "k")) == [(3, {"gf per match": 1.5}, {"gf per match": 2.1})]
    assert sorted(one(layouts.sortable_pairs(rows, "k", ["GF", "PPG"]))) == [(4, "away", 2.0, None), (4, "home", 1.5, None)]
    times = {r.k: r.t for r in p.select("k", layouts.preview_time(F.col("text")).alias("t")).collect()}
    assert times[2] == datetime(2026, 7, 23, 19, 30) and times[0] is None
    assert one(layouts.lossless_tables(p.filter("k = 5"), "k")) == [(5, [(1, [["a"]])])]
    r = layouts.result_summary(p.filter("k = 5").select("text", F.lit("Old (B)").alias("h"), F.lit("New").alias("a")), "text", "h", "a").first()
    assert (tuple(r.final_score), tuple(r.half_time_score), r.total_goals, r.btts, tuple(r.corners), r.ball_possession, r.surprise_level) == ((2, 1), (1, 0), 3, True, (4, 5), None, 12.5)
    assert [tuple(x) for x in p.filter("k = 5").select(layouts.named_pairs(F.col("text")).alias("p")).first().p] == [("Alpha Beta", "Gamma")]
    matches = spark.createDataFrame([(6, 1, "X", "Q", "pre-match"), (6, 2, "X", "Z", "pre-match"), (6, 3, "X", "L", "live")], "k bigint, row int, home string, away string, status string")
    (f,) = one(layouts.index_features(rows, matches, "k"))
    assert f[:3] == (6, "X", "Z") and f[3]["gp"] == 0.0 and f[3]["ppg"] == 11.0
    both = layouts.first_layout(p, "k", [layouts.legacy_index(rows, "k"), layouts.by_time_index(rows, "k")])
    assert sorted(r.k for r in both.collect()) == [0, 0, 1]
    states = [("Full-Time", "finished_post_match"), ("HT 1-0", "live"), ("Pre-match 19:30", "pre_match"), ("points per game", "pre_match"), ("x", "unknown"), ("final score: 2-1", "finished_post_match")]
    assert [r.s for r in spark.createDataFrame(states, "t string, w string").select(layouts.page_state(F.col("t")).alias("s")).collect()] == [w for _, w in states]
    assert spark.createDataFrame([("x MAXIMUM OF 10 MATCHES",), ("y",), (None,)], "t string").select(layouts.truncated(F.col("t")).alias("x")).collect() == [(True,), (False,), (False,)]
    p.unpersist()


def test_records(spark):
    payloads = ['[[{"home":"A","away":"B","probs":{"home":0.4,"draw":0.4,"away":null,"over_25":0.6}},{"home":"","away":"B"}], {}]', '[{"home":"C","away":"D"}, 5]', '{"rows":[{"home":"E","away":"F"}]}', "5", "broken", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string")
    recs = df.select("i", F.explode(layouts.records_of(F.col("p"))).alias("v"))
    recs = recs.select("i", *[F.try_variant_get("v", f"$.{c}", "string").alias(c) for c in ("home", "away", "competition", "country", "source_url")], F.try_variant_get("v", "$.probs", "map<string,double>").alias("probs"))
    assert sorted((r.i, r.home, r.country, r.identity_confidence) for r in layouts.record_matches(recs).collect()) == [(0, "A", "Unknown", 0.7), (1, "C", "Unknown", 0.7), (2, "E", "Unknown", 0.7)]
    got = sorted(tuple(r) for r in layouts.record_observations(recs, ["i"]).collect())
    assert got == [(0, "1x2", "1", 0.4), (0, "1x2", "X", 0.4), (0, "over25", "Over 2.5", 0.6), (0, "pick", "1", 0.4)]


def test_diagnostics(spark):
    df = spark.createDataFrame([(1, "<title>T</title><a href='/x?league=b'>x</a><a href='/x?league=a'>y</a><form></form>")], "k bigint, html string")
    r = html.pages_to_rows(df, "k", "html").first()
    assert (r.title, r.n_links, r.n_forms) == ("T", 2, 1)
