import random

from fieldglass.functions.ids import no_id, uuid5, uuid_hex, uuid_text
from fieldglass.operators.references import failing_references, miss_counts
from pyspark.sql import functions as F

REFS = "key_hex string, ref_us bigint, src_row bigint, period string, reason_code int"
PARENTS = "key_hex string, seen_us bigint, order_us bigint, order_row bigint, gone boolean"


def brute(refs, parents):
    out = []
    for k, at, row, period, _ in refs:
        own = [p for p in parents if p[0] == k and k is not None]
        if not own:
            out.append((row, period, "missing"))
        elif max(own, key=lambda p: (p[2] is not None, p[2] or 0, p[3]))[4]:
            out.append((row, period, "deleted"))
        elif min((p[1] for p in own if p[1] is not None), default=-1) > (at if at is not None else 10**18):
            out.append((row, period, "late"))
    return sorted(out, key=repr)


def test_against_brute_force_with_a_hot_key_and_many_ranges(spark):
    rnd = random.Random(3)
    ids = [f"{rnd.getrandbits(128):032x}" for _ in range(120)]
    parents = [(rnd.choice(ids[:80]), rnd.randint(0, 99), rnd.randint(0, 9), i, rnd.random() < 0.3) for i in range(200)] + [(None, 1, 1, 999, False)]
    refs = [(ids[5] if i % 3 == 0 else rnd.choice(ids), rnd.choice([None, *range(100)]), i, "2024-01", 0) for i in range(900)] + [(None, 5, 5000, None, 0)] * 2
    got = failing_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), carry=["src_row", "period"], rows_per_range=10, refs_per_block=50)
    rows = sorted([tuple(r) for r in got.collect()], key=repr)
    assert rows == brute(refs, parents)
    counts = {(r.period, r.reason): r.n_refs for r in miss_counts(got, ["period"]).collect()}
    assert sum(counts.values()) == len(rows)


def test_empty_tables(spark):
    refs, parents = spark.createDataFrame([("0" * 32, 1, 1, "p", 0)], REFS), spark.createDataFrame([], PARENTS)
    assert [r.reason for r in failing_references(refs, parents, carry=["src_row"]).collect()] == ["missing"]
    assert failing_references(refs.limit(0), parents, carry=["src_row"]).count() == 0


def test_ids(spark):
    u = "31890758-ab63-54fd-a59d-6d923b31ba6c"
    texts = [u, u.upper(), "{" + u + "}", "  " + u, u.replace("-", ""), u[:-1], "", None, "null", " N/A ", "None"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", uuid_text(uuid_hex(F.col("t"))).alias("u"), no_id(F.col("t")).alias("none")).orderBy("i").collect()
    assert [r.u for r in df] == [u] * 5 + [None] * 6
    assert [r.none for r in df] == [False] * 6 + [True] * 5
    import uuid

    assert spark.range(1).select(uuid5(F.lit("match:é")).alias("u")).first().u == str(uuid.uuid5(uuid.NAMESPACE_URL, "match:é"))
