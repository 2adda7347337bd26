import random
from collections import Counter as Bag
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import components, editdistance, leakage, linkage, names, packing, splitting, survivors, tokens, variants

EVAL = "one sullen boot outside this derby sketched their jagged fixture and loosely praised each scarf inside their ornate corner flag sharply"


def osa(a, b):
    d = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def stems(n, seed):
    rnd = random.Random(seed)
    out = set()
    while len(out) < n:
        s = "".join(rnd.choice("abc") for _ in range(rnd.randint(4, 9)))
        out.add(s)
    return sorted(out)


def test_banded_distance():
    s = stems(60, 1) + [""]
    pairs = [(a, b) for a in s for b in s]
    got = editdistance.banded([a for a, _ in pairs], [b for _, b in pairs], 2)
    assert got.tolist() == [min(3, osa(a, b)) for a, b in pairs]


def test_segment_join_finds_every_near_pair(spark):
    s = stems(120, 2)
    at = {i: x for i, x in enumerate(s)}
    got = variants.near_pairs(spark.createDataFrame([(i, "f", x) for i, x in at.items()] + [(None, "f", "aaaa"), (500, "g", "aaaa"), (501, "f", "abc.")], "node bigint, frame string, stem string")).collect()
    want = {frozenset((a, b)): osa(at[a], at[b]) for a, b in combinations(at, 2) if osa(at[a], at[b]) <= 2} | {frozenset((i, 501)): -1 for i, x in at.items() if x.startswith("abc")}
    assert {frozenset((r.node_a, r.node_b)): r.distance for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("a,b", [("A.C. Quilbafeld Rangers", " AC QUILBAFELD, rangers"), ("Union-Nesxitov", "Nesxitov Union"), ("Drimxizen Town (II)", "Drimxizen Town B team"), ("X Dynamo U-21", "x Dynamo under 21"), ("X Athletic Ladies", "X Athletic (W)"), ("KF Gimxiese", "Gimxiesë KF")])
def test_same_words(a, b):
    assert names.words(a) == names.words(b)


def test_different_sides():
    assert len({names.words(x)[1] for x in ("X City", "X City II", "X City U21", "X City U19", "X City (W)", "X City U21 B")}) == 6
    assert names.words(None) == names.words("") == ([], "") and names.words("Ashgan. City") == (["ashgan.", "city"], "")


def clubs():
    """Names of three scopes in which words are used as people use them."""
    town = [a + b for a in ("Ash", "Bral", "Corv", "Drim", "Efte", "Falm", "Gloz", "Hov") for b in ("ganton", "lebury", "mishult")]
    for scope in "cde":
        for i, x in enumerate(town):
            for w in ("City", "Town", "United", "Northern"):
                yield scope, f"{x} {w}", 9
                yield scope, f"FC {x} {w}", 3
            yield scope, f"{x} {('Cty', 'Utd.', 'Twn', 'Unted')[i % 4]}", 1


def test_vocabulary(spark):
    from fieldglass.llm import vocabulary

    bags = variants.with_words(spark.createDataFrame(list(clubs()), "scope string, name string, n bigint"))
    got = {r.word: (r.optional, r.meant) for r in vocabulary.learn(bags).collect()}
    assert got["fc"] == (True, "fc") and got["city"] == (False, "city") and got["northern"] == (False, "northern")
    assert {w: got[w][1] for w in ("cty", "utd", "twn", "unted")} == {"cty": "city", "utd": "united", "twn": "town", "unted": "united"}
    assert vocabulary.learn(bags.limit(0)).count() == 0


def test_name_classes(spark):
    rows = [*clubs(), ("c", "Ashgantno City", 2), ("c", "Ashgan. City", 1), ("c", "Ashganton City B", 4), ("c", "Ashganton Nothern", 1), ("c", "Ashganton Coty", 1), ("c", "The Tin Smiths", 3), ("c", "The Tin Smtihs", 1), ("c", "The Two Faces", 3), ("c", "---", 1), ("c", "", 1)]
    al = [("c", "The Tin Smiths", "ASHGANTON TOWN"), ("c", "The Two Faces", "Ashganton Town"), ("c", "The Two Faces", "Ashganton City"), (None, "x", "y")]
    classes = variants.name_classes(spark.createDataFrame(rows, "scope string, name string, n bigint"), spark.createDataFrame(al, "scope string, name string, other string"))
    roots = {r.name: r.root for r in classes.filter("scope = 'c'").collect()}
    same = [("Ashganton City", "FC Ashganton City", "Ashgantno City", "Ashgan. City", "Ashganton Coty", "Ashganton Cty"), ("Ashganton Northern", "Ashganton Nothern"), ("Ashganton Town", "FC Ashganton Town", "The Tin Smiths", "The Tin Smtihs"), ("Ashganton United",), ("Ashganton City B",), ("The Two Faces",), ("---",), ("",), ("Bralganton City",)]
    assert [len({roots[n] for n in group}) for group in same] == [1] * len(same) and len({roots[g[0]] for g in same}) == len(same)
    none = variants.name_classes(spark.createDataFrame([], "scope string, name string, n bigint"), spark.createDataFrame([], "scope string, name string, other string"))
    assert none.count() == 0


def test_hot_keys_lose_no_pair(spark):
    s = stems(150, 3)
    df = spark.createDataFrame([(i, "f", x) for i, x in enumerate(s)], "node bigint, frame string, stem string")
    a, b = ({tuple(r) for r in variants.near_pairs(df, slice_rows=n).collect()} for n in (2, 10**6))
    assert a == b and a


def test_met_as(spark):
    rows = [("a", 1, "", 10), ("b", 1, "", 20), ("a", 2, "", 10), ("b", 2, "", 20), ("a", 3, "", 20), ("b", 3, "", 20), ("a", 3, "r", 30), ("b", 4, "", 40), ("a", None, "", 50), ("b", None, "", 20), ("a", 5, "", 60), ("b", 5, "", 20), ("a", 6, "", 60), ("b", 6, "", 70)]
    df = spark.createDataFrame(rows, "source string, slot bigint, side string, root bigint")
    assert {tuple(r) for r in variants.met_as(df).collect()} == {(10, 20), (70, 60)}  # 60 itself is torn between two


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


def test_linkage(spark):
    rnd = random.Random(5)
    rows = [(i, i + 1000, 1 if rnd.random() < 0.95 else 0, 1 if rnd.random() < 0.9 else 0) for i in range(200)] + [(i, (i + 7) % 200 + 1000, 0, rnd.random() < 0.1) for i in range(200)]
    compared = spark.createDataFrame([(a, b, 1, 1, int(x), int(y)) for a, b, x, y in rows], "a bigint, b bigint, n_a bigint, n_b bigint, name int, time int")
    chance = spark.createDataFrame([(int(rnd.random() < 0.01), int(rnd.random() < 0.05)) for _ in range(3000)], "name int, time int")
    scored = linkage.score(compared, chance, {"name": [0.1, 0.9], "time": [0.2, 0.8]}, 40000.0).withColumn("distance", F.lit(0))
    got = linkage.settle(scored.filter("confidence >= 0.5"), ["distance"]).collect()
    assert len({r.a for r in got}) == len({r.b for r in got}) == len(got) and all(r.pairs == 1 and not r.from_a + r.from_b for r in got)
    assert sum(r.b == r.a + 1000 for r in got) >= 150 and sum(r.b != r.a + 1000 for r in got) <= 2
    assert linkage.settle(scored.limit(0), ["distance"]).count() == 0


def test_equal_records_are_linked_in_one_step(spark):
    left = spark.createDataFrame([(f"l{i:03}", 7) for i in range(50)] + [("l900", 8)], "id string, x int")
    right = spark.createDataFrame([(f"r{i:03}", 7) for i in range(41)] + [("r900", 8)], "id string, x int")
    (a, in_a), (b, in_b) = linkage.profiles(left, ["x"]), linkage.profiles(right, ["x"])
    assert a.count() == b.count() == 2
    both = a.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "x").join(b.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "x"), "x").withColumn("confidence", F.lit(0.9)).withColumn("distance", F.lit(0))
    got = linkage.linked(linkage.settle(both, ["distance"]), in_a, in_b).collect()
    assert len(got) == 42 == len({r.a for r in got}) == len({r.b for r in got}) and {(r.a[1:], r.b[1:]) for r in got} >= {("900", "900")}


def test_tied_profiles_settle(spark):
    """40 by 40 pairs of equal confidence: no limit of rounds, every record once."""
    scored = spark.range(40).select(F.col("id").alias("a")).crossJoin(spark.range(100, 140).select(F.col("id").alias("b"))).select("*", F.lit(1).cast("bigint").alias("n_a"), F.lit(1).cast("bigint").alias("n_b"), F.lit(0.8).alias("confidence"), F.lit(0).alias("distance"))
    got = linkage.settle(scored, ["distance"]).collect()
    assert len(got) == 40 == len({r.a for r in got}) == len({r.b for r in got})


def test_survivors(spark):
    rows = [("m", 1, "live", 5.0, 10), ("m", 2, "pre", None, 9), ("m", 3, "pre", 7.0, 3), ("m", 4, "pre", 8.0, 3), ("m", 5, "x", 5.0, 99), ("m", 10, "pre", 8.0, 3), ("n", 6, None, None, None), ("n", 7, None, None, 1), ("o", 8, "pre", 1.0, 1), (None, 9, "pre", 1.0, 1)]
    df = spark.createDataFrame(rows, "k string, r bigint, s string, v double, t bigint")
    trust = F.when(F.col("s") == "pre", 2).when(F.col("s") == "live", 1).otherwise(0)
    strict = dict(trust=trust, at_us=F.col("t"), row="r", scale=0, bits=trust.cast("bigint") * F.lit(1 << 60) + F.col("t") * 20)
    # 7.0 and 8.0 are as trusted and as late; the copy of 8.0 doesn't vote twice, so the lowest row decides
    assert {(r.k, r.v_row, r.n_rows) for r in survivors.survivors(df, ["k"], {"v": F.col("v")}, least_rows=2, **strict).collect()} == {("m", 3, 6), ("n", None, 2)}
    soft = dict(trust=trust, at_us=F.col("t"), row="r", bits=survivors.log_vote(F.log2(trust + F.lit(2.0)), F.col("t"), 86_400e6))
    got = {r.k: r.v for r in survivors.survivors(df, ["k"], {"v": F.col("v")}, **soft).collect()}
    assert got["m"] == "5.0" and got["n"] is None  # two votes for 5.0
    assert survivors.survivors(df.limit(0), ["k"], {"v": F.col("v")}, **strict).count() == 0


@pytest.mark.parametrize("capacity,n,seed", [(512, 3000, 1), (50, 400, 2), (7, 1, 3), (64, 0, 4)])
def test_plan(capacity, n, seed):
    rnd = random.Random(seed)
    want = Bag(min(capacity, int(rnd.lognormvariate(3, 1)) + 1) for _ in range(n))
    used, seen = Bag(), set()
    for first, count, bag in packing.plan(dict(want), capacity):
        assert count > 0 and sum(k * v for k, v in bag.items()) <= capacity and not seen & set(range(first, first + count))
        seen |= set(range(first, first + count))
        used += Bag({k: v * count for k, v in bag.items()})
    assert used == want
    if n > 100:
        assert len(seen) <= 1.05 * sum(k * v for k, v in want.items()) / capacity + 1


def test_pack(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice([0, None, 300, 300, 300, 700, 2500, rnd.randint(1, 512)]), "x") for i in range(500)] + [(None, 5, "x"), (3, 300, "x")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, tokens bigint, piece string"), [(1, 512), (2, 1024)], rows_per_bucket=100).toPandas()
    for limit, cap in ((1, 512), (2, 1024)):
        own = got[got.limit_id == limit]
        assert own.groupby("container").tokens.sum().max() <= cap and own.tokens.sum() == sum(r[1] or 0 for r in rows)
        assert len(own) == sum(max(1, -(-(r[1] or 0) // cap)) for r in rows)
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, tokens bigint"), [(1, 512)]).count() == 0


def test_token_counts():
    c = tokens.counter(tokens.default_path())
    for t in ("", "Hello  world\n\n it's 12²½ ⅷ", "a b _x_\x1c y" + " " * 50 + "é日本", "x" * 3000):
        assert c.count(t) == len(c.encoding.encode_ordinary(t))


def check_pieces(text, found, limit, overlap, c):
    assert found[0][0] == 0 and found[-1][1] == len(text)
    for k, (a, b, n) in enumerate(found):
        assert n <= limit and len(c.encoding.encode_ordinary(text[a:b])) <= limit
        if k:
            shared = len(c.encoding.encode_ordinary(text[a : found[k - 1][1]]))
            assert a <= found[k - 1][1] and (shared == 0 if not overlap else overlap <= shared <= overlap + max(4, (limit - overlap) // 8) + 4)


@pytest.mark.parametrize("limit,overlap", [(256, 0), (512, 64), (40, 30), (8, 0)])
def test_split(limit, overlap):
    rnd, c = random.Random(limit), tokens.counter(tokens.default_path())
    sentence = lambda: " ".join(rnd.choice("goal match the referee of an evening corner".split()) for _ in range(rnd.randint(3, 30))).capitalize() + "."
    texts = [" ".join(sentence() for _ in range(80)), "\n\n".join(" ".join(sentence() for _ in range(5)) for _ in range(20)), "word " * 3000, "x1" * 4000, " " * 5000, "short.", "https://example.org/" + "q7x-" * 900, "日本語のテキスト" * 300, "a \n\n\n  b " * 400]
    most = max(4, (limit - overlap) // 8)
    prepared = [splitting.Prepared(i, t, c, most) for i, t in enumerate(texts)]
    assert [p.whole for p in prepared] == [c.count(t) for t in texts]
    found = splitting.pieces(len(texts), prepared, limit, overlap)
    for t, f in zip(texts, found, strict=True):
        assert bool(f) == (c.count(t) > limit)
        if f:
            check_pieces(t, f, limit, overlap, c)
    if limit > 200:
        assert {texts[1][b - 1] for _, b, _ in found[1][:-1]} <= {"\n", "."}


def test_split_dynamic_programming_is_best():
    rnd = random.Random(4)
    for _ in range(20):
        ends = np.concatenate([[0], np.cumsum([rnd.randint(1, 9) for _ in range(9)])])
        cost = np.array([0.0] + [rnd.choice([0, 1, 4]) for _ in range(8)] + [0.0])
        (cuts,) = splitting.solve([ends], [ends], [cost], 20, 0)
        target = ends[-1] / max(1, -(-ends[-1] // 20))
        price = lambda c: sum(cost[j] + splitting.BALANCE * ((ends[j] - ends[i]) / target - 1) ** 2 for i, j in zip([0, *c], c, strict=False)) if all(ends[j] - ends[i] <= 20 for i, j in zip([0, *c], c, strict=False)) else np.inf  # noqa: E731, B023
        best = min(price([*c, 9]) for r in range(9) for c in combinations(range(1, 9), r))
        assert abs(price(cuts) - best) < 1e-9


def test_split_rows(spark):
    docs = spark.createDataFrame([(1, "word " * 400, 9), (2, None, 9), (3, "", 9), (1, "word " * 400, 9)], "doc_id bigint, text string, piece int")
    got = splitting.split(docs, [(4, 256, 0)]).collect()
    assert len(got) == 4 and {r.doc_id for r in got} == {1} and "".join(r.piece_text for r in got[:2]) == "word " * 400
    assert splitting.split(docs.limit(0), [(4, 256, 0)]).count() == 0


def test_leaks(spark):
    w = EVAL.split()
    filler = "rain fell on the ground while nobody looked at all"
    docs = [
        (1, f"{filler} {' '.join(w[2:16])} {filler}"),
        (2, f"{filler} {' '.join(w[2:10])} {filler}"),  # eight words
        (3, " ".join(w[:8]) + f" {filler} " + " ".join(w[8:16])),
        (4, " ".join(x if i != 5 else "other" for i, x in enumerate(w[:14]))),
        (5, " ".join(x if i % 4 else "other" for i, x in enumerate(w))),
        (6, "<p>" + "</b> <b>".join(x.upper() for x in w[:13]).replace("O", "О") + "</p>"),
        (7, "­".join(" ".join(w[:6])) + " " + "​".join(" ".join(w[6:13]))),
        (8, " ".join(w[:7] + ["then"] + w[7:14])),
        (9, " ".join(w[:7] + w[8:15])),
        (10, None), (11, ""), (1, f"{filler} {' '.join(w[2:16])} {filler}"), (12, " ".join(w[:11])),
    ]
    items = [(1, EVAL), (2, None), (3, ""), (4, "too short to leak"), (5, EVAL)]
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(d, e).collect()}
    assert got == {(k, i) for k in (1, 4, 6, 7, 8, 9) for i in (1, 5)}
    assert leakage.leaks(d.limit(0), e).count() == 0 and leakage.leaks(d, e.limit(0)).count() == 0
