import random

import pytest

from fieldglass.operators.asof import as_of

E, V = "entity string, event_id bigint, t bigint, version_id int", "entity string, version_id bigint, valid bigint, recorded bigint, t string"


def brute(events, versions):
    out = []
    for ent, eid, t, _ in events:
        ok = [v for v in versions if v[0] == ent and None not in (ent, t, *v[:4]) and v[2] <= t and v[3] <= t]
        if ok:
            out.append((eid, max(ok, key=lambda v: (v[2], v[3], -v[1]))[1]))
    return sorted(out)


@pytest.mark.parametrize("hot", [10**6, 40])
def test_against_brute_force(spark, hot):
    rnd = random.Random(hot)
    who = lambda: rnd.choice(["hot"] * 6 + list("abcdef") + [None])
    events = [(who(), i, rnd.choice([None, *range(60)]), 1) for i in range(400)]
    events += events[:20]
    versions = [(who(), i, rnd.choice([None, *range(60)]), rnd.choice([None, *range(60)]), "x") for i in range(400)]
    got = as_of(spark.createDataFrame(events, E), spark.createDataFrame(versions, V), block_rows=50, hot_rows=hot)
    assert sorted(map(tuple, got.collect())) == brute(events, versions)


def test_hot_entity_at_one_moment(spark):
    events = [("h", i, 5, 0) for i in range(300)]
    versions = [("h", i, 5 - i % 2, 3, "") for i in range(300)]
    got = as_of(spark.createDataFrame(events, E), spark.createDataFrame(versions, V), block_rows=50, hot_rows=40)
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(300)]


def test_empty(spark):
    ev, ve = spark.createDataFrame([("a", 1, 1, 0)], E), spark.createDataFrame([], V)
    assert as_of(ev, ve).count() == 0 and as_of(ev.limit(0), ve).count() == 0
