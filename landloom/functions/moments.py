"""All valid readings of one date or time value.

``readings`` gives those that the fixed rules below allow, ``interpretations`` also those that the value's form would
allow without them, marked as such: a year of two digits as Gregorian, the second of two equal local times, a skipped
time with the offset after the change.

Fixed rules of the data (stated, not inferred): years below 1911 are ROC years (+1911); 6 and 7 digits are ROC
year, month, day; 8 digits are a Gregorian day; 10 and 13 digits are seconds and milliseconds since 1970 UTC; a
time without zone is on the given clock; a local time that occurs twice is the first, a skipped one is read with
the offset in force before the change.
"""

from __future__ import annotations

import datetime as dt
import re
import unicodedata
from functools import lru_cache
from zoneinfo import ZoneInfo

UTC = dt.timezone.utc
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
#: The clock of the register, for values whose source has none.
REGISTER = "Asia/Taipei"
#: Zone abbreviations and their offsets in hours. CST is two clocks, so it has two readings.
ABBREVIATIONS = {
    "Z": [0], "UTC": [0], "GMT": [0], "WET": [0], "BST": [1], "WEST": [1], "CET": [1], "CEST": [2], "EET": [2], "EEST": [3],
    "JST": [9], "KST": [9], "HKT": [8], "EST": [-5], "EDT": [-4], "CST": [8, -6], "CDT": [-5], "MST": [-7], "MDT": [-6],
    "PST": [-8], "PDT": [-7],
}
HAN = {c: i for i, c in enumerate("〇一二三四五六七八九")} | {"零": 0, "元": 1}

_TIME = (
    r"(?:(?P<noon>上午|下午|AM|PM)\s*)?(?P<h>[0-9]{1,2}):(?P<mi>[0-9]{2})(?::(?P<s>[0-9]{2})(?:[.,][0-9]+)?)?\s*(?P<ap>AM|PM)?"
    r"\s*(?P<zone>Z|[+-][0-9]{2}:?[0-9]{2}|\[[A-Za-z_+\-/0-9]+\]|[A-Z]{3,4})?"
)
_NUM = re.compile(rf"(?:中華民國|民國)?\s*(?P<y>[0-9]{{1,4}})(?P<sep>[/.\-])(?P<mo>[0-9]{{1,2}})(?P=sep)(?P<d>[0-9]{{1,2}})(?:[T\s]\s*{_TIME})?", re.ASCII)
_HAN = re.compile(rf"(?:中華民國|民國)?\s*(?P<y>[0-9]{{1,4}}|元)\s*年\s*(?P<mo>[0-9]{{1,2}})\s*月\s*(?P<d>[0-9]{{1,2}})\s*日?(?:[T\s]*{_TIME})?", re.ASCII)
_COMPACT = re.compile(r"(?P<y>[0-9]{4})(?P<mo>[0-9]{2})(?P<d>[0-9]{2})T(?P<h>[0-9]{2})(?P<mi>[0-9]{2})(?P<s>[0-9]{2})?(?P<zone>Z|[+-][0-9]{2}:?[0-9]{2})?", re.ASCII)
_DAY_FIRST = re.compile(rf"(?P<d>[0-9]{{1,2}})[\s-](?P<mon>[A-Za-z]{{3}})[a-z]*[\s-](?P<y>[0-9]{{4}})(?:[,\s]\s*{_TIME})?", re.ASCII)
_MONTH_FIRST = re.compile(rf"(?P<mon>[A-Za-z]{{3}})[a-z]*\s+(?P<d>[0-9]{{1,2}}),?\s+(?P<y>[0-9]{{4}})(?:[,\s]\s*{_TIME})?", re.ASCII)
_YEAR_LAST = re.compile(rf"(?P<a>[0-9]{{1,2}})(?P<sep>[/.\-])(?P<b>[0-9]{{1,2}})(?P=sep)(?P<y>[0-9]{{4}})(?:[T\s]\s*{_TIME})?", re.ASCII)
_DIGITS = re.compile(r"[0-9]{6,8}|[0-9]{10}|[0-9]{13}", re.ASCII)
_HAN_NUMBER = re.compile(r"[〇零元一二三四五六七八九十百]+(?=[年月日])")


def _han_number(m: re.Match) -> str:
    text = m[0]
    if "十" not in text and "百" not in text:
        return "".join(str(HAN[c]) for c in text)
    total, digit = 0, None
    for c in text:
        if c in HAN:
            digit = HAN[c]
        else:
            total += (1 if digit is None else digit) * (100 if c == "百" else 10)
            digit = None
    return str(total + (digit or 0))


@lru_cache(maxsize=512)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:
        return None


def _day(y: int, mo: int, d: int) -> dt.date | None:
    try:
        return dt.date(y + 1911 if 0 < y < 1911 else y, mo, d)
    except ValueError:
        return None


def _moment(t: dt.datetime) -> tuple[str, int]:
    t = t.replace(microsecond=0)
    return f"{t.year:04d}-{t.month:02d}-{t.day:02d}T{t.hour:02d}:{t.minute:02d}:{t.second:02d}Z", int((t.replace(tzinfo=UTC) - dt.datetime(1970, 1, 1, tzinfo=UTC)).total_seconds())


def _with_time(form: str, day: dt.date | None, g: dict, clock: str | None) -> list[tuple[str, str, int]]:
    if day is None:
        return []
    if not g.get("h"):
        return [(form, day.isoformat(), (day - dt.date(1970, 1, 1)).days * 86400)]
    h, mi, s = int(g["h"]), int(g["mi"]), int(g.get("s") or 0)
    noon = g.get("noon") or g.get("ap")
    if noon:
        if not 1 <= h <= 12:
            return []
        h = h % 12 + (12 if noon in ("下午", "PM") else 0)
    if h > 23 or mi > 59 or s > 59:
        return []
    local = dt.datetime(day.year, day.month, day.day, h, mi, s)
    zone = g.get("zone")
    out = []
    try:
        if not zone or zone[0] == "[":
            z = _zone(zone[1:-1] if zone else clock or "")
            if z is not None:
                # fold=0: the first of two equal local times, and the old offset for a skipped one.
                out.append((form + ("z" if zone else "l"), *_moment((local.replace(tzinfo=z).astimezone(UTC)).replace(tzinfo=None))))
        elif zone[0] in "+-":
            hours, minutes = int(zone[1:3]), int(zone[-2:])
            if hours <= 18 and minutes <= 59:
                shift = dt.timedelta(hours=hours, minutes=minutes)
                out.append((form + "o", *_moment(local - shift if zone[0] == "+" else local + shift)))
        else:
            out += [(f"{form}{zone}{hours}", *_moment(local - dt.timedelta(hours=hours))) for hours in ABBREVIATIONS.get(zone, [])]
    except (OverflowError, ValueError):
        return []
    return out


def readings(value: str | None, clock: str | None) -> list[tuple[str, str, int]]:
    """(form, normal form, seconds since 1970) of every valid reading; empty for what names no whole, possible date."""
    if value is None:
        return []
    text = " ".join(unicodedata.normalize("NFKC", value).split())
    if not text:
        return []
    if m := _DIGITS.fullmatch(text):
        n = len(text)
        if n in (10, 13):
            try:
                at = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(text[:10]))
            except OverflowError:
                return []
            return [(f"e{n}", *_moment(at))]
        return _with_time(f"n{n}", _day(int(text[:-4]), int(text[-4:-2]), int(text[-2:])), {}, clock)
    if "年" in text:
        text = _HAN_NUMBER.sub(_han_number, text)
    if m := _NUM.fullmatch(text):
        return _with_time("y" + m["sep"], _day(int(m["y"]), int(m["mo"]), int(m["d"])), m.groupdict(), clock)
    if m := _HAN.fullmatch(text):
        return _with_time("han", _day(1 if m["y"] == "元" else int(m["y"]), int(m["mo"]), int(m["d"])), m.groupdict(), clock)
    if m := _COMPACT.fullmatch(text):
        return _with_time("compact", _day(int(m["y"]), int(m["mo"]), int(m["d"])), m.groupdict(), clock)
    for form, pattern in (("dmon", _DAY_FIRST), ("mond", _MONTH_FIRST)):
        if (m := pattern.fullmatch(text)) and m["mon"].lower() in MONTHS:
            return _with_time(form, _day(int(m["y"]), MONTHS[m["mon"].lower()], int(m["d"])), m.groupdict(), clock)
    if m := _YEAR_LAST.fullmatch(text):
        a, b, y, g = int(m["a"]), int(m["b"]), int(m["y"]), m.groupdict()
        out = _with_time("dmy" + m["sep"], _day(y, b, a), g, clock) + _with_time("mdy" + m["sep"], _day(y, a, b), g, clock)
        return out if len({x[1] for x in out}) > 1 else out[:1]
    return []


#: What may be a day with a Gregorian year of two digits: a two-digit year in front, or six digits.
_SHORT = re.compile(r"(?P<y>[0-9]{2})(?:(?P<sep>[/.\-])(?P<mo>[0-9]{1,2})(?P=sep)(?P<d>[0-9]{1,2})|(?P<mo2>[0-9]{2})(?P<d2>[0-9]{2}))", re.ASCII)


def _other_fold(form: str, text: str, clock: str | None, at: int) -> int | None:
    """The other moment that a local time names on its clock, if there is one; a value with an offset says which it means."""
    zone = _zone(re.search(r"\[([^\]]+)\]", text)[1] if form[-1] == "z" else clock or "") if form[-1] in "zl" else None
    if zone is None:
        return None
    # The time as written: a skipped one is shown an hour later, so it is sought on both sides.
    for shift in (0, -3600, 3600):
        wall = dt.datetime.fromtimestamp(at + shift, zone).replace(tzinfo=None) - dt.timedelta(seconds=shift)
        both = [int(wall.replace(tzinfo=zone, fold=f).timestamp()) for f in (0, 1)]
        if both[0] == at and both[1] != at:
            return both[1]
    return None


def interpretations(value: str | None, clock: str | None) -> list[tuple[str, str, int, bool]]:
    """(form, normal form, seconds since 1970, whether a fixed rule is broken) of every interpretation, those of ``readings`` first."""
    allowed = readings(value, clock)
    if not allowed:
        return []
    out = [(*r, False) for r in allowed]
    text = " ".join(unicodedata.normalize("NFKC", value).split())
    if m := _SHORT.fullmatch(text):
        y = int(m["y"])
        day = _day(y + (2000 if y < 50 else 1900), int(m["mo"] or m["mo2"]), int(m["d"] or m["d2"]))
        if day is not None:
            out += [(*r, True) for r in _with_time("short", day, {}, clock)]
    if len(allowed) == 1 and allowed[0][1].endswith("Z") and (other := _other_fold(allowed[0][0], text, clock, allowed[0][2])) is not None:
        out.append((allowed[0][0] + "2", *_moment(dt.datetime(1970, 1, 1) + dt.timedelta(seconds=other)), True))
    return out


def day_on(value: str | None, clock: str | None) -> str | None:
    """The day a value names, as ISO text; of a moment, its day on the clock. Null if there is none or the readings differ."""
    zone = _zone(clock or REGISTER) or _zone(REGISTER)
    found = {n if len(n) == 10 else dt.datetime.fromtimestamp(t, zone).date().isoformat() for _, n, t in readings(value, zone.key)}
    return found.pop() if len(found) == 1 else None
