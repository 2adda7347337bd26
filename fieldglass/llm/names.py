"""Names of clubs typed by people: words and side. What the words mean is learned from the names themselves (see vocabulary)."""

from __future__ import annotations

import re
import unicodedata

LETTERS = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ı": "i", "’": "'"})

# How a reserve, youth or women's side is marked; these are teams of their own.
_YOUTH = re.compile(r"\b(?:under|u)[\s.\-]*(\d\d)\b")
_WOMEN = re.compile(r"\(\s*w\s*\)|\b(?:women|ladies|femenino|feminin|frauen)\b|\bw\.?\s*$")
_RESERVE = re.compile(r"\(\s*(?:ii|b|2)\s*\)|\bb[\s\-]team\b|\b(?:ii|2nd|reserves?|res)\b|\b(?:b|2)\s*$")

_INITIALS = re.compile(r"\b([a-z])\.\s?([a-z])\.(?![a-z])")
_TOKEN = re.compile(r"([^\W_]+(?:'[^\W_]+)?)(\.?)")


def fold(name: str) -> str:
    """Case, width and accents removed."""
    s = unicodedata.normalize("NFKC", name).casefold().translate(LETTERS)
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def words(name: str | None) -> tuple[list[str], str]:
    """(words, side) of a name: sorted folded words, one that ends in a dot keeping it; side is empty for a senior men's team."""
    s = _INITIALS.sub(r"\1\2 ", fold(name or ""))
    side = ""
    if m := _YOUTH.search(s):
        side, s = f"u{m[1]}", f"{s[: m.start()]} {s[m.end() :]}"
    t = _WOMEN.sub(" ", s)
    side, s = (side + "w", t) if t != s else (side, s)
    t = _RESERVE.sub(" ", s)
    side, s = (side + "r", t) if t != s else (side, s)
    return sorted(t + dot for t, dot in _TOKEN.findall(s)), side
