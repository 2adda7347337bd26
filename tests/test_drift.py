import json

from fieldglass.operators.drift import approved, changes, ingest, promote

L = "feed string, run_no int, line_no int, payload string, status string"


def lines(files):
    return [("f", run, i, p if isinstance(p, str) or p is None else json.dumps(p), "s") for run, rows in files.items() for i, p in enumerate(rows)]


TARGET = {"match_id": "string", "a": "bigint"}


def changed(spark, files, target=TARGET):
    rows = files if isinstance(files, list) else lines(files)
    return changes(ingest(spark.createDataFrame(rows, L), target), target)


def test_changes(spark):
    files = {
        1: [{"match_id": "m1", "a": 1, "k": None}, {"match_id": "m2", "a": 2}, "# end", None, "[1]"],
        2: [{"match_id": "m1", "b": 1, "k": "x"}, {"match_id": "m2", "b": 2}, {"match_id": "m2", "b": 9}, {"match_id": "m9", "b": 7}],
        4: [{"match_id": "m1", "b": "1", "k": None}, {"match_id": "m2", "b": "2"}],
        5: [{"match_id": "m1", "b": "1", "k": 3}, {"match_id": "m2", "c": None, "b": "2"}],
        6: ["broken {"],
        7: [{"match_id": "m1"}],
    }
    got = {tuple(r)[1:] for r in changed(spark, files).collect()}
    assert got == {
        (2, "renamed", "a", "b"), (4, "retyped", "b", "b"), (5, "retyped", "k", "k"), (5, "added", "", "c"),
        (6, "removed", "b", ""), (6, "removed", "c", ""), (6, "removed", "k", ""), (6, "removed", "match_id", ""), (7, "added", "", "match_id"),
    }


def test_no_rename_without_values(spark):
    files = {1: [{"match_id": "m", "a": None}], 2: [{"match_id": "m", "b": None}]}
    assert {tuple(r)[2] for r in changed(spark, files).collect()} == {"added", "removed"}


def test_empty(spark):
    assert changed(spark, []).count() == 0
    assert changed(spark, [(None, 1, 1, "{}", ""), ("f", None, 1, "{}", "")]).count() == 0


def test_ingest_keeps_every_value(spark):
    files = {1: [{"ok": "true", "n": 5, "extra": {"x": [1, None]}, "status": "late"}, {"ok": {"at": 1}, "n": None}, "oops", None]}
    df = ingest(spark.createDataFrame(lines(files), L), {"ok": "boolean", "n": "int", "status": "string"})
    a, b, c, e = df.orderBy("line_no").collect()
    assert (a.ok, a.n, a.status, json.loads(a._rescued)) == (None, 5, "late", {"ok": "true", "extra": {"x": [1, None]}})  # a text is no boolean until it is promoted
    assert (b.ok, b.n, json.loads(b._rescued)) == (None, None, {"ok": {"at": 1}, "n": None})
    assert [r.ok for r in promote(df, "ok", "boolean", ["$.ok"]).orderBy("line_no").collect()] == [True, None, None, None]
    assert json.loads(c._rescued) == {"_unreadable": "oops"} and e._rescued is None
    again = promote(df, "ok_at", "int", ["$.missing", "$.ok.at"]).orderBy("line_no").collect()
    assert [r.ok_at for r in again] == [None, 1, None, None] and json.loads(again[1]._rescued) == {"n": None} and again[0]._rescued == a._rescued


def test_paths_are_approved_where_values_travel(spark):
    rec = lambda f: [{"match_id": f"m{i}", **f(f"v{i}")} for i in range(4)]
    files = {1: rec(lambda v: {"a": v, "n": 1}), 2: rec(lambda v: {"a": {"at": v, "zone": "UTC"}, "n": 1}), 3: rec(lambda v: {"b": {"at": v, "zone": "UTC"}, "n": 1}), 4: rec(lambda v: {"c": [v], "n": 1}), 5: rec(lambda v: {"c": v, "n": 1})}
    target = {"match_id": "string", "a": "string"}
    df = ingest(spark.createDataFrame(lines(files), L), target)
    paths = approved(df, target)
    assert paths == {"match_id": ["match_id"], "a": ["a", "a.at", "b.at", "c", "c[0]"]}
    got = promote(df, "a", "string", [f"$.{p}" for p in paths["a"]]).collect()
    assert {r.a for r in got} == {f"v{i}" for i in range(4)} and {r._rescued for r in got if r.run_no == 3} == {'{"b":{"zone":"UTC"},"n":1}'}
    assert approved(df.limit(0), target) == {"match_id": ["match_id"], "a": ["a"]}


def test_a_hundred_fields_come_and_go(spark):
    rec = lambda tag: [{"match_id": f"m{i}"} | {f"{tag}{n}": i * 1000 + n for n in range(100)} for i in range(20)]
    got = changed(spark, {1: rec("x"), 2: rec("y")}).collect()
    assert {(r.field_before, r.field_after, r.change) for r in got} == {(f"x{n}", f"y{n}", "renamed") for n in range(100)}
