from fieldglass.functions import similarity
from fieldglass.plans import reference


def test_fuzzy_similarity_compares_all_pairs_that_share_a_word(spark, tmp_path):
    rows = [
        ("soccerstats", "X", "Rudfelbek Dynamo", "Dunnev. Albion"), ("soccerstats", "X", "Zollomvik City KF", "FC"), ("soccerstats", "Y", "Oxo Town", "Longtown Wanderers"), ("soccerstats", "X", "Oxo Town", None),
        ("forebet", "X", "Rxdfelbek Dynamo", "Dunev Albion"), ("forebet", "X", "Zollmivk City KF", "AC"), ("forebet", "Y", "Oxo Twon", "Wanderers Longtwn"), ("forebet", "Y", "Dunnev Albion", "Else"),
    ]
    rows += [(s, "Z", f"{p}{i} Town", f"{p}{i} City") for s, p, n in (("soccerstats", "a", 1100), ("forebet", "b", 3)) for i in range(n)]
    spark.createDataFrame([({s: "u"}, *r) for s, *r in rows], "source_urls map<string,string>, country string, home_team string, away_team string").write.parquet(str(tmp_path / "matches.parquet"))
    names = {(s, c, n) for s, c, *both in rows for n in both}
    words = {n: set(similarity.normalized(n).split()) for _, _, n in names}
    want = {(c, n, m) for s, c, n in names if s == "soccerstats" for t, e, m in names if t == "forebet" and c == e and words[n] & words[m]}
    got = reference.fuzzy_similarity(spark, str(tmp_path)).collect()
    assert {("X", "Rudfelbek Dynamo", "Rxdfelbek Dynamo"), ("X", "Dunnev. Albion", "Dunev Albion"), ("Y", "Oxo Town", "Oxo Twon")} <= want and len(want) > 6600
    assert len(got) == len(want) and {(r.country, r.a, r.b): (r.accepted, r.score, r.reason) for r in got} == {(c, n, m): similarity.same_entity(n, m) for c, n, m in want}
