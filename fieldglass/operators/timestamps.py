"""Timestamps in mixed notations and zones, normalised to one UTC instant.

All notations are one regex alternation with named groups. A single regexp
replacement writes the groups of whichever notation matched into fixed slots,
so a text is scanned once; calendar checks and the assembly of the instant are
integer arithmetic on those slots. Everything stays in JVM code generation: no
shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Offsets in minutes of the zone abbreviations a text may carry.
ABBREVIATIONS = {"Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "CET": 60, "EET": 120, "WEST": 60, "CEST": 120, "EEST": 180}
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
SLOTS = ("y", "mo", "mon", "d", "h", "mi", "s", "ap", "os", "oh", "om", "z", "e", "ms")

_MONTH = "(?:" + "|".join(MONTHS) + ")[a-z]*"
_ZONE = r"(?:\s*(?:(?<z{i}>" + "|".join(sorted(ABBREVIATIONS, key=len, reverse=True)) + r")|(?:utc|gmt)?(?<os{i}>[+-])(?<oh{i}>\d{{2}}):?(?<om{i}>\d{{2}})?))?"
_CLOCK = r"(?<h{i}>\d{{1,2}}):(?<mi{i}>\d{{2}})(?::(?<s{i}>\d{{2}})(?:[.,]\d+)?)?(?:\s*(?<ap{i}>[ap])\.?m\.?)?"
#: One pattern per notation; {i} numbers its groups.
NOTATIONS = (
    r"(?<y{i}>\d{{4}})-(?<mo{i}>\d{{1,2}})-(?<d{i}>\d{{1,2}})(?:t|\s+)" + _CLOCK + _ZONE,
    r"(?<y{i}>\d{{4}})(?<mo{i}>\d{{2}})(?<d{i}>\d{{2}})t?(?<h{i}>\d{{2}})(?<mi{i}>\d{{2}})(?<s{i}>\d{{2}})?(?:[.,]\d+)?" + _ZONE,
    r"(?<d{i}>\d{{1,2}})[./](?<mo{i}>\d{{1,2}})[./](?<y{i}>\d{{4}}|\d{{2}}),?\s+" + _CLOCK + _ZONE,
    r"(?:[a-z]{{3,9}}\.?,?\s+)?(?<d{i}>\d{{1,2}})\.?\s+(?<mon{i}>" + _MONTH + r")\.?,?\s+(?<y{i}>\d{{4}}),?\s+" + _CLOCK + _ZONE,
    r"(?:[a-z]{{3,9}}\.?,?\s+)?(?<mon{i}>" + _MONTH + r")\.?\s+(?<d{i}>\d{{1,2}}),?\s+(?<y{i}>\d{{4}}),?\s+" + _CLOCK + _ZONE,
    r"(?<e{i}>\d{{10}})",
    r"(?<ms{i}>\d{{13}})",
)


def compiled() -> tuple[str, str]:
    """The alternation and the replacement that fills the slots; a leading '#' tells a match from a text left as it was."""
    pattern = r"(?i)^\s*(?:" + "|".join(p.format(i=i) for i, p in enumerate(NOTATIONS)) + r")\s*$"
    slots = ["".join(f"${{{slot}{i}}}" for i, p in enumerate(NOTATIONS) if f"(?<{slot}{{i}}>" in p) for slot in SLOTS]
    return pattern, "#|" + "|".join(slots)


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, by integer arithmetic (years 0 and later)."""
    yy = y - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(yy / 400).cast("bigint")
    yoe = yy - era * 400
    doy = F.floor((153 * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5).cast("bigint") + d - 1
    doe = yoe * 365 + F.floor(yoe / 4).cast("bigint") - F.floor(yoe / 100).cast("bigint") + doy
    return era * 146097 + doe - 719468


def month_length(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m.isin(4, 6, 9, 11), 30).when((m == 2) & leap, 29).when(m == 2, 28).otherwise(31)


def zone_names(spark: SparkSession) -> list[str]:
    """Region names and the plain UTC names the JVM knows; anything else in a zone column is no zone."""
    known = spark._jvm.java.time.ZoneId.getAvailableZoneIds()
    return sorted(z for z in map(str, known) if z in ("UTC", "GMT") or ("/" in z and not z.startswith("SystemV")))


def slots_of(text: Column) -> Column:
    """Array of '#' and the slots of a text ('' where absent); a text no notation matches is its only element.

    Runs of white space in longer texts count as one blank, so that no length is too long and none costs more than its share.
    """
    pattern, replacement = compiled()
    squeezed = F.when(F.length(text) > 40, F.regexp_replace(text, r"\s+", " ")).otherwise(text)
    return F.split(F.regexp_replace(squeezed, F.lit(pattern), F.lit(replacement)), r"\|")


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once: the optimizer neither copies their expressions into later uses nor pushes filters into them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def to_instant(df: DataFrame, text: str, zone: Column | None = None, out: str = "instant_s") -> DataFrame:
    """Adds `out`: the UTC instant of the text column in epoch seconds, null where it names none or more than one.

    An offset, abbreviation or epoch number in the text wins; otherwise `zone`
    (a region name, an abbreviation or an offset such as GMT+05:45) applies.
    Local times that a daylight-saving change skips or repeats, dates that do
    not exist, dates without time, vague texts, and texts with no zone at all
    give null, as do null and blank texts. Texts may have any length. Fractions are cut.
    Numeric dates are day first, two-digit years are 20xx. Other columns,
    repeated rows included, pass through; names starting with `_ts_` are used
    inside and must not occur.
    """
    zone = F.lit(None).cast("string") if zone is None else F.trim(zone)
    at = {s: i + 1 for i, s in enumerate(SLOTS)}
    slot = lambda s: F.when(F.col("_ts_hit"), F.get("_ts_p", F.lit(at[s])))
    num = lambda s: slot(s).try_cast("bigint")
    given_at = r"^(?i:UTC|GMT)?([+-])(\d{1,2}):?(\d{2})?$"
    df = bind(df, _ts_p=slots_of(F.col(text)), _ts_zone=zone, _ts_z=F.when(zone.rlike(r"[+-]\d"), F.split(F.regexp_replace(zone, given_at, "$1|$2|$3"), r"\|")))
    df = bind(df, _ts_hit=F.coalesce(F.get("_ts_p", F.lit(0)) == "#", F.lit(False)))
    mon = (F.instr(F.lit("".join(MONTHS)), F.lower(F.substring(slot("mon"), 1, 3))) + 2) / 3
    year = num("y") + F.when(F.length(slot("y")) == 2, 2000).otherwise(0)
    month = F.when(slot("mon") != "", mon.cast("bigint")).otherwise(num("mo"))
    ap = F.lower(slot("ap"))
    hour = F.when(ap == "", num("h")).when(num("h").between(1, 12), num("h") % 12 + F.when(ap == "p", 12).otherwise(0))
    df = bind(df, **{"_ts_y": year, "_ts_mo": month, "_ts_d": num("d"), "_ts_h": hour, "_ts_mi": num("mi"), "_ts_s": F.coalesce(num("s"), F.lit(0))})
    ok = F.col("_ts_mo").between(1, 12) & F.col("_ts_d").between(1, month_length(F.col("_ts_y"), F.col("_ts_mo"))) & F.col("_ts_h").between(0, 23) & F.col("_ts_mi").between(0, 59) & F.col("_ts_s").between(0, 59)
    wall = F.when(ok, days_from_civil(F.col("_ts_y"), F.col("_ts_mo"), F.col("_ts_d")) * 86400 + F.col("_ts_h") * 3600 + F.col("_ts_mi") * 60 + F.col("_ts_s"))

    offset = lambda sign, h, m: F.when((sign != "") & (h <= 18) & (F.coalesce(m, F.lit(0)) <= 59), F.when(sign == "-", -1).otherwise(1) * (h * 60 + F.coalesce(m, F.lit(0))))
    short = lambda c: F.coalesce(*[F.when(F.upper(c) == k, v) for k, v in ABBREVIATIONS.items()])
    z = [F.get("_ts_z", F.lit(i)) for i in range(3)]
    own = F.when(slot("z") != "", short(slot("z"))).when(slot("os") != "", offset(slot("os"), num("oh"), num("om")))
    has_own = (slot("z") != "") | (slot("os") != "")
    given = F.when(F.size("_ts_z") == 3, offset(z[0], z[1].try_cast("bigint"), z[2].try_cast("bigint"))).otherwise(short(F.col("_ts_zone")))
    df = bind(df, **{"_ts_w": wall, "_ts_own": has_own, "_ts_off": F.when(has_own, own).otherwise(given)})
    df = bind(df, **{"_ts_region": F.when(~F.col("_ts_own") & F.col("_ts_off").isNull() & F.col("_ts_w").isNotNull() & F.col("_ts_zone").isin(zone_names(df.sparkSession)), F.col("_ts_zone"))})
    # A wall time in a region: the offsets in force a day before and a day after are the only candidates; one that maps back to the wall time counts.
    # Only such rows are looked up: all others have no region.
    region = F.col("_ts_region")
    local = lambda utc: F.when(region.isNotNull(), F.floor(F.unix_micros(F.from_utc_timestamp(F.timestamp_seconds(utc), region)) / 1_000_000).cast("bigint"))
    df = bind(df, **{"_ts_a": F.col("_ts_w") - (local(F.col("_ts_w") - 86400) - F.col("_ts_w") + 86400), "_ts_b": F.col("_ts_w") - (local(F.col("_ts_w") + 86400) - F.col("_ts_w") - 86400)})
    a_ok, b_ok = local(F.col("_ts_a")) == F.col("_ts_w"), local(F.col("_ts_b")) == F.col("_ts_w")
    regional = F.when(F.col("_ts_a") == F.col("_ts_b"), F.when(a_ok, F.col("_ts_a"))).when(a_ok & ~b_ok, F.col("_ts_a")).when(b_ok & ~a_ok, F.col("_ts_b"))
    instant = (
        F.when(slot("e") != "", num("e"))
        .when(slot("ms") != "", F.floor(num("ms") / 1000).cast("bigint"))
        .when(F.col("_ts_off").isNotNull(), F.col("_ts_w") - F.col("_ts_off") * 60)
        .when(F.col("_ts_region").isNotNull(), regional)
    )
    return df.withColumn(out, instant.cast("bigint")).drop("_ts_p", "_ts_z", "_ts_hit", "_ts_y", "_ts_mo", "_ts_d", "_ts_h", "_ts_mi", "_ts_s", "_ts_w", "_ts_zone", "_ts_off", "_ts_own", "_ts_region", "_ts_a", "_ts_b")


#: Calendar dates, whatever follows them.
DATES = (
    r"(?<y{i}>\d{{4}})-(?<mo{i}>\d{{1,2}})-(?<d{i}>\d{{1,2}})",
    r"(?<y{i}>\d{{4}})(?<mo{i}>\d{{2}})(?<d{i}>\d{{2}})(?=t|$)",
    r"(?<d{i}>\d{{1,2}})[./](?<mo{i}>\d{{1,2}})[./](?<y{i}>\d{{4}}|\d{{2}})",
    r"(?:[a-z]{{3,9}}\.?,?\s+)?(?<d{i}>\d{{1,2}})\.?\s+(?<mon{i}>" + _MONTH + r")\.?,?\s+(?<y{i}>\d{{4}})",
    r"(?:[a-z]{{3,9}}\.?,?\s+)?(?<mon{i}>" + _MONTH + r")\.?\s+(?<d{i}>\d{{1,2}}),?\s+(?<y{i}>\d{{4}})",
)


def with_calendar_day(df: DataFrame, text: str, out: str = "day") -> DataFrame:
    """Adds `out`: days since 1970-01-01 of the date a text begins with, zone or not; null without a valid date."""
    slots = ("y", "mo", "mon", "d")
    pattern = r"(?is)^\s*(?:" + "|".join(p.format(i=i) for i, p in enumerate(DATES)) + r")(?!\d).*$"
    fill = "#|" + "|".join("".join(f"${{{slot}{i}}}" for i, p in enumerate(DATES) if f"(?<{slot}{{i}}>" in p) for slot in slots)
    df = bind(df, _ts_p=F.split(F.regexp_replace(F.ltrim(F.col(text)), F.lit(pattern), F.lit(fill)), r"\|"))
    part = lambda i: F.when(F.get("_ts_p", F.lit(0)) == "#", F.get("_ts_p", F.lit(i)))
    y = part(1).try_cast("bigint") + F.when(F.length(part(1)) == 2, 2000).otherwise(0)
    mo = F.when(part(3) != "", ((F.instr(F.lit("".join(MONTHS)), F.lower(F.substring(part(3), 1, 3))) + 2) / 3).cast("bigint")).otherwise(part(2).try_cast("bigint"))
    df = bind(df, _ts_y=y, _ts_mo=mo, _ts_d=part(4).try_cast("bigint"))
    y, mo, d = F.col("_ts_y"), F.col("_ts_mo"), F.col("_ts_d")
    return df.withColumn(out, F.when(mo.between(1, 12) & d.between(1, month_length(y, mo)), days_from_civil(y, mo, d))).drop("_ts_p", "_ts_y", "_ts_mo", "_ts_d")


def iso_text(seconds: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ssZ of epoch seconds, whatever the session's time zone."""
    day = F.floor(seconds / 86400).cast("int")
    rest = seconds - day.cast("bigint") * 86400
    two = lambda c: F.lpad(F.floor(c).cast("bigint").cast("string"), 2, "0")
    return F.concat(F.date_from_unix_date(day).cast("string"), F.lit("T"), two(rest / 3600), F.lit(":"), two(rest % 3600 / 60), F.lit(":"), two(rest % 60), F.lit("Z"))
