"""Plain Python versions of operators, for tests."""

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

ABBR = {"UTC": 0, "GMT": 0, "Z": 0, "CET": 1, "EET": 2, "WET": 0, "CEST": 2, "EEST": 3, "WEST": 1}
PLAIN = ["%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M", "%Y%m%dT%H%M%S", "%d.%m.%Y %H:%M", "%d/%m/%Y %H:%M", "%d.%m.%y, %H:%M", "%b %d, %Y %H:%M", "%d %b %Y %I:%M %p", "%a, %d %b %Y %H:%M:%S"]


def kickoff(text, zone):
    """The instant as text, or 'unresolved'."""
    t = text.strip()
    stamp = lambda u: u.strftime("%Y-%m-%dT%H:%M:%SZ")
    if re.fullmatch(r"\d{10}", t):
        return stamp(datetime.fromtimestamp(int(t), timezone.utc))
    if re.fullmatch(r"\d{13}", t):
        return stamp(datetime.fromtimestamp(int(t) // 1000, timezone.utc))
    off = None
    if m := re.search(r"(?<=\d)\s*([A-Za-z]{1,4})$", t):
        if m[1].upper() in ABBR:
            off, t = ABBR[m[1].upper()] * 60, t[: m.start()]
    elif m := re.search(r"(?<=\d\d:\d\d)(?:\.\d+)?\s*([+-])(\d\d):?(\d\d)?$|(?<=:\d\d\.\d{6})([+-])(\d\d):(\d\d)$", t):
        sign, h, mi = (m[1] or m[4]), (m[2] or m[5]), (m[3] or m[6] or "0")
        off, t = (-1 if sign == "-" else 1) * (int(h) * 60 + int(mi)), t[: m.start(1) if m[1] else m.start(4)].strip()
    t = re.sub(r"(:\d\d)\.\d+$", r"\1", t)
    for f in PLAIN:
        try:
            wall = datetime.strptime(t, f)
            break
        except ValueError:
            continue
    else:
        return "unresolved"
    if off is None:
        if not zone or not zone.strip():
            return "unresolved"
        if m := re.fullmatch(r"(?:UTC|GMT)?([+-])(\d\d):(\d\d)", zone):
            off = (-1 if m[1] == "-" else 1) * (int(m[2]) * 60 + int(m[3]))
        else:
            try:
                z = ZoneInfo(zone)
            except Exception:
                return "unresolved"
            found = {u for fold in (0, 1) for u in [wall.replace(tzinfo=z, fold=fold).astimezone(timezone.utc)] if u.astimezone(z).replace(tzinfo=None) == wall}
            return stamp(found.pop()) if len(found) == 1 else "unresolved"
    return stamp(wall - timedelta(minutes=off))
