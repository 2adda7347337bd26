import pytest

from fieldglass.functions import similarity as s
from fieldglass.operators import names


@pytest.mark.parametrize("a,b,accepted,reason", [
    ("", "Roma", False, "empty"), ("FC Roma", "Rome", True, "exact"), ("Barcelona", "Barcelona B", False, "reserve_mismatch"),
    ("Rosenborg", "Rosenborgs", True, "similar"),  # one begins the other: no guard
    ("Rosenborg", "Rosanborg", False, "prefix_guard"),  # differ within the shorter, under 0.9
    ("Lech aa Poznan", "Lech bb Poznan", True, "similar"),  # a long word follows: no guard of short rests
    ("Sporting CP", "Sporting GD", False, "short_remainder"),
])
def test_guards(a, b, accepted, reason):
    got = s.same_entity(a, b)
    assert (got[0], got[2]) == (accepted, reason)


def test_aliases_map_normal_forms():
    assert s.same_entity("Old Boys", "Novi", {"old boys": "novi"}) == (True, 1.0, "alias") == s.same_entity("Novi", "Old Boys", {"old boys": "novi"})


def test_alignment():
    assert s.aligned(["kung", "fu"], ["kungfu"]) == (["kungfu"], ["kungfu"])
    assert s.aligned(["ab", "cd", "ef"], ["abcd", "ef"]) == (["abcd", "ef"], ["abcd", "ef"])  # two before three
    assert s.aligned(["a", "b"], ["ab"]) == (["a", "b"], ["ab"])  # under four letters
    assert s.aligned(["nottingham", "f"], ["nottingham", "forest"])[0] == ["nottingham", "forest"]
    assert s.aligned(["1", "munich"], ["1860", "munich"])[0] == ["1", "munich"]  # a digit is no initial


def test_penalties():
    assert s.token_set_ratio(["bristol", "city"], ["bristol", "fb"]) == pytest.approx(14 / 17 - 0.04)  # short own words on one side: the soft penalty
    assert s.token_set_ratio(["manchester", "city"], ["manchester", "united"]) < 0.5
    assert s.token_set_ratio(["milan"], ["inter", "milan"]) == pytest.approx(1 - 0.18)
    assert s.token_set_ratio(["west", "ham"], ["west", "ham", "united"]) == pytest.approx(1 - 0.04)
    assert s.prefix_recall(["guangzhou"], ["guangzhou", "power"]) == 1.0 and s.prefix_recall(["ab"], ["abc"]) == 0.0
    assert s.same_pair("Roma", "Lazio", "Lazio", "Roma")[0] is False


@pytest.fixture(scope="module")
def sides(spark):
    left = [(1, "d", "FC Roma", "Lazio"), (2, "d", "Rosenborg", "Molde"), (3, "d", "Lazio", "Roma"), (4, "e", "Roma", "Lazio"), (5, "d", None, "Lazio"), (6, "d", "Nowhere", "Elsewhere")]
    right = [(10, "d", "Rome", "Lazio", 1), (11, "d", "Roma", "Lazio", 2), (12, "d", "Rosenborgs", "Molde", 3), (13, "d", "Nobody", None, 4)]
    return spark.createDataFrame(left, "l int, day string, home_team string, away_team string"), spark.createDataFrame(right, "r int, day string, home_team string, away_team string, o int")


def test_reconcile(sides):
    got = {r.l: (r.r, r.how) for r in names.reconcile(*sides, "l", "r", ["day"], "o").collect()}
    assert got == {1: (11, "exact"), 2: (12, "fuzzy"), **{i: (None, "unmatched_result") for i in (3, 4, 5, 6)}}


def test_margin_and_swap(sides):
    plain = {r.l: (r.r, r.status) for r in names.match_with_margin(*sides, "l", "r", ["day"]).collect()}
    assert plain[2] == (12, "matched") and plain[1][1] == "ambiguous" and plain[4] == plain[5] == (None, "none") and plain[3][1] != "matched"
    left, right = sides
    swapped = {r.l: (r.r, r.swapped, r.status) for r in names.match_with_margin(left, right.filter("r <> 11"), "l", "r", ["day"], swap=True).collect()}
    assert swapped[3] == (10, True, "matched") and swapped[1] == (10, False, "matched")


def test_outer(sides):
    got = {tuple(r) for r in names.outer_with_margin(*sides, "l", "r", ["day"]).collect()}
    assert got == {(1, 10, "exact"), (1, 11, "exact"), (2, 12, "fuzzy"), (3, None, "left_only"), (4, None, "left_only"), (5, None, "left_only"), (6, None, "left_only"), (None, 13, "right_only")}
    left, right = sides
    assert names.outer_with_margin(left.limit(0), right, "l", "r", ["day"]).count() == 4
