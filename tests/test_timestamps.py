import random

import pytest
from brute import kickoff
from pyspark.sql import functions as F

from fieldglass.operators import timestamps

CASES = [
    ("2024-08-01 06:30", "UTC", "2024-08-01T06:30:00Z"),
    ("31/07/2024 21:00", "Europe/Berlin", "2024-07-31T19:00:00Z"),
    ("01.08.24, 14:30", "Asia/Kathmandu", "2024-08-01T08:45:00Z"),
    ("20240801T175000", "+05:45", "2024-08-01T12:05:00Z"),
    ("1722525300", None, "2024-08-01T15:15:00Z"),
    ("1722540600999", "x", "2024-08-01T19:30:00Z"),
    ("Aug 1, 2024 15:00", "GMT-03:00", "2024-08-01T18:00:00Z"),
    ("1 Aug 2024 12:05 AM", "GMT", "2024-08-01T00:05:00Z"),
    ("1 Aug 2024 12:05 PM", "GMT", "2024-08-01T12:05:00Z"),
    ("1 Aug 2024 13:05 PM", "GMT", "unresolved"),
    ("Thu, 01 Aug 2024 17:00:00 +0200", "Asia/Tokyo", "2024-08-01T15:00:00Z"),
    ("2024-08-01 16:00:00+09", None, "2024-08-01T07:00:00Z"),
    ("2024-08-01T10:15:00.853246+00:00", None, "2024-08-01T10:15:00Z"),
    ("2024-08-01 18:00 utc", "Asia/Tokyo", "2024-08-01T18:00:00Z"),
    ("01.08.2024 21:30 CEST", None, "2024-08-01T19:30:00Z"),
    ("2024-10-27 02:30", "Europe/Berlin", "unresolved"),  # happens twice
    ("2024-03-31 02:30", "Europe/Berlin", "unresolved"),  # never happens
    ("2024-10-27 02:30 CET", "Europe/Berlin", "2024-10-27T01:30:00Z"),
    ("2024-02-30 10:00", "UTC", "unresolved"),
    ("2023-02-29 10:00", "UTC", "unresolved"),
    ("2024-02-29 10:00", "UTC", "2024-02-29T10:00:00Z"),
    ("2026-13-40 25:61", "UTC", "unresolved"),
    ("2024-08-01", "UTC", "unresolved"),
    ("TBD", "UTC", "unresolved"),
    ("2024-08-01 06:30", None, "unresolved"),
    ("2024-08-01 06:30", "local", "unresolved"),
    ("2024-08-01 06:30", "", "unresolved"),
    ("x" * 5000, "UTC", "unresolved"),
    ("", "UTC", "unresolved"),
    (None, "UTC", "unresolved"),
]


def run(spark, rows):
    df = spark.createDataFrame(rows, "n int, text string, zone string, y int")  # y: a column the operator has a slot for
    out = timestamps.to_instant(df, "text", F.col("zone"))
    assert out.columns == ["n", "text", "zone", "y", "instant_s"]
    return {r.n: r.t for r in out.select("n", F.coalesce(timestamps.iso_text(F.col("instant_s")), F.lit("unresolved")).alias("t")).collect()}


def test_cases(spark):
    got = run(spark, [(i, t, z, 7) for i, (t, z, _) in enumerate(CASES)])
    assert [got[i] for i in range(len(CASES))] == [w for *_, w in CASES]


def test_against_plain_python(spark):
    rnd, rows = random.Random(7), []
    zones = ["Europe/Berlin", "America/New_York", "Australia/Lord_Howe", "UTC", None, "Asia/Kolkata", "GMT+05:45"]
    for i in range(600):
        d = (rnd.choice([2023, 2024, 2025]), rnd.choice([3, 4, 10, 11, 7]), rnd.randint(1, 31), rnd.randint(0, 23), rnd.choice([0, 15, 30, 45]))
        form = rnd.choice(["{0}-{1:02}-{2:02} {3:02}:{4:02}", "{2:02}.{1:02}.{0} {3:02}:{4:02}", "{0}-{1:02}-{2:02}T{3:02}:{4:02}:00+02:00", "{0}{1:02}{2:02}T{3:02}{4:02}00", "{2:02}/{1:02}/{0} {3:02}:{4:02}"])
        rows.append((i, form.format(*d), rnd.choice(zones), 0))
    got = run(spark, rows)
    assert {i: kickoff(t, z) for i, t, z, _ in rows} == got


def test_empty(spark):
    assert run(spark, []) == {}


@pytest.mark.parametrize("text,day", [("2024-08-01 20:00", 19936), ("01.08.2024", 19936), ("1 Aug 2024 9:00 PM", 19936), ("20240801T000000", 19936), ("30.02.2024", None), ("1722525300", None), ("?", None)])
def test_calendar_day(spark, text, day):
    df = spark.createDataFrame([(text, 7)], "text string, y int")
    assert [tuple(r) for r in timestamps.with_calendar_day(df, "text", "d").collect()] == [(text, 7, day)]


def test_no_length_is_too_long(spark):
    rows = [(n, "2024-05-06" + " " * n + "07:08" + " " * n + "UTC") for n in (1, 59, 5000, 300_000)] + [(-1, "x" * 200_000), (-2, "2024-05-06 " + "0" * 100_000)]
    got = {r.n: r.instant_s for r in timestamps.to_instant(spark.createDataFrame(rows, "n int, text string"), "text").collect()}
    assert got == {n: 1714979280 if n > 0 else None for n, _ in rows}
