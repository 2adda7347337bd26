"""Joins whose work must not grow with the square of the rows that share a key."""

import math
import random

from pyspark.sql import functions as F

from fieldglass.operators import joins
from fieldglass.plans import reference


def most_rows(df):
    """Collects `df`; its rows, and the most rows any operator gave out."""
    rows, most, todo = df.collect(), 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        made = plan.metrics().get("numOutputRows")
        most = max(most, made.get().value() if made.isDefined() else 0)
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        else:
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return rows, most


def nearest(rows, most, margin):
    """Plain version: gaps of NaN after all numbers, then of null; equal gaps by id."""
    out = set()
    for a, k, v in rows:
        others = [(v is None or u is None, 0 if v is None or u is None else abs(v - u), b) for b, j, u in rows if k is not None and j == k and b != a]
        others = sorted(others, key=lambda o: (o[0], math.isnan(o[1]), 0 if math.isnan(o[1]) else o[1], o[2]))
        if others:
            none, gap, b = others[0]
            more = others[1] if others[1:] else (True, 0, None)
            status = "matched" if none else "below" if math.isnan(gap) or gap > most else "ambiguous" if not more[0] and more[1] - gap < margin else "matched"
            out.add((a, b, None if none else repr(gap), status))
    return out


def test_nearest_match_equals_all_pairs(spark):
    r = random.Random(5)
    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e308, -1e308, 0.1, 0.1 + 2**-56, 1e16, 5e-324]
    values = {"cents": lambda: r.randrange(9000, 9999) / 10, "few": lambda: float(r.randrange(4)), "odd": lambda: r.choice(odd), "mixed": lambda: r.choice([*odd, r.random() * 9]), "tiny": lambda: r.choice([1e16, r.random()]), "same": lambda: 7.0, "none": lambda: None, "nan": lambda: math.nan, None: r.random}
    rows = [(i, k, values[k]()) for i, k in enumerate([k for k in values for _ in range(60)])] + [(9000, "one", 1.0), (9001, "two", 1.0), (9002, "two", 3.0), (9003, "three", math.inf), (9004, "three", math.inf), (9005, "three", 1.0)]
    r.shuffle(rows)
    got = joins.nearest_match(spark.createDataFrame(rows, "id bigint, k string, v double"), "id", ["k"], "v", "b", most=50.0, margin=0.5).collect()
    assert len(got) == len({x.id for x in got}) and {(x.id, x.b, x.gap if x.gap is None else repr(x.gap), x.status) for x in got} == nearest(rows, 50.0, 0.5)


def test_margin_topk_makes_no_pairs_of_a_large_group(spark, tmp_path):
    n = 3000
    rows = [(i, "b", "t", ((i * 7919) % n) * 0.25) for i in range(n)]
    spark.createDataFrame(rows, "p_partkey bigint, p_brand string, p_type string, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    got, most = most_rows(reference.margin_topk(spark, str(tmp_path)))
    assert {x.gap for x in got} == {0.25} and len(got) == n and most < 20 * n


def tiered(left, right, tiers):
    """Plain version over all pairs: (left id, right id, tier, status, candidates) of each left row."""
    out = []
    for a, *_ in left:
        per = [{b for i, *ks in left for b, *js in right if a is not None and i == a and ks[t] is not None and ks[t] == js[t]} - {None} for t in range(tiers)]
        one = next((t for t in range(tiers) if len(per[t]) == 1), None)
        many = next((t for t in range(tiers) if len(per[t]) > 1), None)
        clash = many is not None and (one is None or many < one)
        hit = not clash and one is not None
        out.append((a, min(per[one]) if hit else None, f"t{one}" if hit else None, "ambiguous" if clash else "matched" if hit else "unresolved", sum(map(len, per))))
    return sorted(out, key=repr)


def test_tiered_join_counts_each_right_id_once(spark):
    r = random.Random(8)
    rows = lambda n, ids: [(r.choice([None, *range(ids)]), r.choice([None, *"abcdef"]), r.choice([None, *"uvwxyz", *"123456789"])) for _ in range(n)]
    for left, right in ((rows(60, 40), rows(12, 9)), (rows(30, 9), rows(30, 9)), ([(i, "a", str(i)) for i in range(9)], [(i, "abc"[i % 3], str(i)) for i in range(7)])):
        a, b = spark.createDataFrame(left, "a bigint, x string, y string"), spark.createDataFrame(right, "b bigint, x string, y string")
        got = joins.tiered_join(a, b, "a", "b", [("t0", F.col("x"), F.col("x")), ("t1", F.col("y"), F.col("y"))]).collect()
        assert sorted(map(tuple, got), key=repr) == tiered(left, right, 2)


def test_tiered_join_makes_no_pairs_of_a_large_key(spark, tmp_path):
    n = 1000
    rows = [(i, s, "", f"H{i % 5}", None if i % 5 == 4 else "A") for i, s in enumerate(["scheduled"] * n + ["finished"] * n)] + [(2 * n, "scheduled", "d", "h4", None), (2 * n + 1, "scheduled", "e", "H9", "A")]
    spark.createDataFrame(rows, "link_row bigint, lifecycle_state string, detail_url string, home_team string, away_team string").write.parquet(str(tmp_path / "fixture_links.parquet"))
    got, most = most_rows(reference.tiered_join(spark, str(tmp_path)))
    want = {(i, None, None, "ambiguous", n + (0 if i % 5 == 4 else n // 5)) for i in range(n)} | {(i, None, None, "unresolved", 0) for i in (2 * n, 2 * n + 1)}
    assert {tuple(x) for x in got} == want and len(got) == n + 2 and most < 20 * n
