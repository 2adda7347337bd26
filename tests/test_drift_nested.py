import json

from fieldglass.operators.drift import ingest, promote
from fieldglass.plans.problems import LINK_FIELDS

PATHS = {
    "kickoff_utc": ["kickoff_utc.at", "kickoffUtc", "start_at", "start_at.at"],
    "lifecycle_state": ["lifecycle_state.state", "fixture_state", "state_now.state"],
    "result_snapshot_id": ["result_snapshot_id.id", "res_snap[0]", "resultSnapshotId[0]"],
    "detail_snapshot_path": ["detail_snapshot_path[0]", "detail_file", "detail_file[0]"],
}


def test_nested_values_are_rescued_and_promoted(spark):
    payloads = [
        {"match_id": "m", "kickoff_utc": {"at": "x", "zone": "UTC"}, "lifecycle_state": {"state": "late"}, "result_snapshot_id": {"id": "i"}, "detail_snapshot_path": ["p"]},
        {"start_at": {"at": "x", "zone": "UTC"}, "state_now": {"state": "late"}, "res_snap": ["i", "j"], "detail_file": ["p"], "pre_match_eligible": {"a": None}},
        {"kickoff_utc": "x", "start_at": {"at": "y"}, "result_snapshot_id": [], "lifecycle_state": {"other": 1}, "home_team": ["a", 1]},
        {"resultSnapshotId": [None], "kickoffUtc": {"zone": "UTC", "at": None}, "detail_file": "p", "fixture_state": "late"},
    ]
    rows = [(i, "f", 1, json.dumps(p)) for i, p in enumerate(payloads)]
    df = ingest(spark.createDataFrame(rows, "line_id bigint, feed string, run_no int, payload string"), LINK_FIELDS, rescue="rescued")
    for column, paths in PATHS.items():
        df = promote(df, column, "string", [f"$.{p}" for p in paths], rescue="rescued")
    got = df.orderBy("line_id").collect()
    assert [(r.kickoff_utc, r.lifecycle_state, r.result_snapshot_id, r.detail_snapshot_path, r.home_team) for r in got] == [("x", "late", "i", "p", None), ("x", "late", "i", "p", None), ("x", None, None, None, None), (None, "late", None, "p", None)]
    assert [json.loads(r.rescued) for r in got] == [
        {"kickoff_utc": {"zone": "UTC"}},
        {"start_at": {"zone": "UTC"}, "res_snap": ["j"], "pre_match_eligible": {"a": None}},
        {"start_at": {"at": "y"}, "result_snapshot_id": [], "lifecycle_state": {"other": 1}, "home_team": ["a", 1]},
        {"resultSnapshotId": [None], "kickoffUtc": {"zone": "UTC", "at": None}},
    ]


def test_structured_targets_and_deep_paths(spark):
    df = spark.createDataFrame([(json.dumps({"tags": ["a"], "x": {"y": [{"z": 1, "w": 2}, 3]}}),)], "payload string")
    row = promote(ingest(df, {"tags": "array<string>"}), "z", "int", ["$.x", "$.x.y[0].z"]).first()
    assert row.tags == ["a"] and row.z == 1 and json.loads(row._rescued) == {"x": {"y": [{"w": 2}, 3]}}
