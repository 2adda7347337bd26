"""Identifiers: written-out nulls, UUID texts, digests and name-based UUIDs, all as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing id (fixed values).
NULL_TEXTS = ("", "null", "none", "n/a")
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def no_id(c: Column) -> Column:
    """True for null, blank and written-out nulls."""
    return c.isNull() | F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")).isin(*NULL_TEXTS)


def uuid_hex(c: Column) -> Column:
    """The 32 lower-case hex digits of a UUID text, whatever its case, hyphens, braces or surrounding blanks; null if it is none."""
    bare = F.lower(F.regexp_replace(c, r"^[\s {}]+|[\s {}]+$|-", ""))
    return F.when(bare.rlike(r"^[0-9a-f]{32}$"), bare)


def uuid_text(hex32: Column) -> Column:
    """32 hex digits with the usual hyphens."""
    return F.regexp_replace(hex32, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Name-based UUID (version 5) of a text; null for null."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
