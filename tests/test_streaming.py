import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

from fieldglass.streaming import sightings

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import sys
from fieldglass.session import local_session
from fieldglass.streaming import sightings
spark = local_session(2, **{"spark.sql.shuffle.partitions": "2", "spark.ui.showConsoleProgress": "false"})
folder, lo = sys.argv[1], int(sys.argv[2])
spark.range(lo, lo + 10).write.mode("append").parquet(folder + "/in")
sightings.append_to(sightings.read_folder(spark, folder + "/in", "id bigint"), folder + "/out").awaitTermination()
"""


def test_a_second_session_goes_on(spark, tmp_path):
    for lo in (0, 10):
        subprocess.run([sys.executable, "-c", RUN, str(tmp_path), str(lo)], check=True, cwd=ROOT, env={**os.environ, "PYTHONPATH": str(ROOT)}, capture_output=True)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(20))


def test_state_changes(spark, tmp_path):
    at = lambda h: datetime(2025, 1, 1 + h // 24, h % 24)
    batches = [
        [("m", at(1), "scheduled", at(10)), ("m", at(2), "scheduled", None), ("n", at(1), None, None), (None, at(1), "x", None), ("q", None, "x", None)],
        [("m", at(3), "live", None), ("z", at(30), "scheduled", at(40))],
        [("z", at(60), "scheduled", None)],
    ]
    schema = "k string, t timestamp, status string, due timestamp"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = sightings.append_to(sightings.state_changes(sightings.read_folder(spark, str(tmp_path / "in"), schema), "k", "t", "status", "due", delay="1 hour"), str(tmp_path / "out"))
        q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("m", at(1), "scheduled"), ("n", at(1), None), ("m", at(3), "live"), ("m", at(10), "overdue"), ("z", at(30), "scheduled"), ("z", at(40), "overdue")}
