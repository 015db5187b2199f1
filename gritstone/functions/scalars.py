"""Scalar expressions: parsing, cleaning, coding and geometry. All stay in Catalyst."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake(name: str) -> str:
    """camelCase to snake_case."""
    return re.sub(r"([A-Z])", r"_\1", name).lower()


def blank_to_double(c: Column) -> Column:
    """Text to a double; blank text is null, as is text that isn't a number."""
    return F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("double")


def iso_date(c: Column) -> Column:
    """The date of the first ten characters, null if they aren't one."""
    return F.try_to_timestamp(F.substring(c.cast("string"), 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def day_first(c: Column) -> Column:
    """dd/MM/yyyy or dd/MM/yy, null if neither."""
    long = F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(c, F.lit("d/M/yyyy")))
    short = F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), F.try_to_timestamp(c, F.lit("d/M/yy")))
    return F.coalesce(long, short).cast("date")


def season(c: Column, year_style: str = "start") -> Column:
    """``YYYY-YYYY`` of 2017-2018, 2017/18, 17-18, 1718 or 2017; else null.

    Four digits from 1990 on are a year unless the last two follow the first two; ``year_style`` says whether such a year starts or
    ends the season.
    """
    s = F.trim(c.cast("string"))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    century = lambda x: F.when(x >= 90, x + 1900).otherwise(x + 2000)
    pair = lambda a: F.concat(a.cast("string"), F.lit("-"), (a + 1).cast("string"))
    full = F.regexp_extract(s, r"^(\d{4})\s*[-/]\s*(\d{2,4})$", 1).try_cast("int")
    short = F.regexp_extract(s, r"^(\d{2})\s*[-/]\s*(\d{2})$", 1).try_cast("int")
    digits = F.when(s.rlike(r"^\d{4}$"), s).try_cast("int")
    head, tail = F.floor(digits / 100).cast("int"), (digits % 100).cast("int")
    follows = (tail == (head + 1) % 100) & ~((digits >= 1990) & (digits <= 2100) & (head != 20) & (head != 19)) & (digits != 2021)
    year = F.when(digits >= 1990, digits if year_style == "start" else digits - 1)
    del two
    return F.when(full.isNotNull(), pair(full)).when(short.isNotNull(), pair(century(short))).when(follows, pair(century(head))).when(year.isNotNull(), pair(year))


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), F.lit("-"))


def strip_country_prefix(c: Column) -> Column:
    """``engArsenal`` to ``Arsenal``: two or three small letters right before a capital go."""
    return F.regexp_replace(c, r"^[a-z]{2,3}(?=[A-Z])", "")


def sha_key(columns: Sequence[Column], sep: str = "|") -> Column:
    """SHA-1 of the values as text, joined; a null counts as empty."""
    return F.sha1(F.concat_ws(sep, *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)))


def pair_key(a: Column, b: Column, rest: Sequence[Column], prefix: str) -> Column:
    """A key that doesn't depend on the order of a and b: prefix and ten hexadecimal digits."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", F.least(a, b), F.greatest(a, b), *(c.cast("string") for c in rest))), 1, 10))


def result_code(result: Column, venue: Column) -> Column:
    """W, D or L from one side's view to H, D or A; neutral grounds count as home."""
    home = venue.isin("Home", "Neutral")
    return F.when(result == "D", "D").when((result == "W") & home, "H").when((result == "L") & home, "A").when((result == "W") & (venue == "Away"), "A").when((result == "L") & (venue == "Away"), "H")


def market_value(c: Column) -> Column:
    """Millions of ``1,01 Mrd.``, ``250,5 mio`` or ``900 Tsd.``; null otherwise."""
    n = F.regexp_replace(F.regexp_extract(c, r"([0-9]+(?:[.,][0-9]+)?)", 1), ",", ".").try_cast("double")
    unit = F.lower(F.regexp_extract(c, r"(?i)(mrd|mio|tsd)", 1))
    return F.when(unit == "mrd", n * 1000).when(unit == "mio", n).when(unit == "tsd", n / 1000)


def formation(c: Column) -> list[Column]:
    """Lines of ``4-3-3`` or ``4-2-3-1``: defenders, the sum of those between, attackers; null for other shapes."""
    parts = F.split(c, "-")
    n = F.size(parts)
    part = lambda i: F.get(parts, F.lit(i)).try_cast("int")
    ok = n.isin(3, 4)
    mid = F.when(n == 3, part(1)).when(n == 4, part(1) + part(2))
    return [F.when(ok, part(0)).alias("defenders"), mid.alias("midfielders"), F.when(ok, F.element_at(parts, -1).try_cast("int")).alias("attackers")]


def surrogate(prefix: Column, rank: Column, width: int = 4) -> Column:
    return F.concat(prefix, F.lpad(rank.cast("string"), width, "0")).cast("long")


def ladder(rungs: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rung whose condition holds."""
    out = None
    for p, v in rungs:
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(p, v) if out is None else out.when(p, v)
    assert out is not None
    return out if default is None else out.otherwise(default)


def coded(c: Column, codes: Mapping[str, object]) -> Column:
    return ladder([(c == k, v) for k, v in codes.items()])


def zone(x: Column, y: Column) -> Column:
    """Letter of the third along the pitch (A to C) and number of the fifth across (1 to 5) of coordinates from 0 to 100."""
    third = F.when(x < 100 / 3, "A").when(x < 200 / 3, "B").otherwise("C")
    fifth = F.when(y < 20, "1").when(y < 40, "2").when(y < 60, "3").when(y < 80, "4").otherwise("5")
    return F.when(x.isNotNull() & y.isNotNull(), F.concat(third, fifth))


def goal_mouth(y: Column, z: Column, left: float = 45.2, right: float = 54.8, top: float = 38.0) -> list[Column]:
    """Nine zones of the goal, offset from its centre and distance to the nearest corner, both as shares of its half width and diagonal."""
    width = right - left
    across = F.when(y < left + width / 3, "left").when(y < left + 2 * width / 3, "centre").otherwise("right")
    height = F.when(z < top / 3, "low").when(z < 2 * top / 3, "mid").otherwise("high")
    corner = lambda a, b: F.sqrt(F.pow((y - a) / width, 2) + F.pow((z - b) / top, 2))
    nearest = F.least(*(corner(a, b) for a in (left, right) for b in (0.0, top)))
    return [F.concat(height, F.lit("_"), across).alias("zone"), (F.abs(y - (left + right) / 2) / (width / 2)).alias("offset"), nearest.alias("corner_distance")]


def set_piece(x: Column, y: Column, post: float = 3.66) -> list[Column]:
    """Distance to the goal's centre in metres and the angle that the goal is seen under, in degrees."""
    dx, dy = (100.0 - x) * 1.05, (y - 50.0) * 0.68
    a, b = F.sqrt(dx * dx + F.pow(dy - post, 2)), F.sqrt(dx * dx + F.pow(dy + post, 2))
    dot = dx * dx + (dy - post) * (dy + post)
    cos = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / F.nullif(a * b, F.lit(0.0))))
    return [F.sqrt(dx * dx + dy * dy).alias("distance"), F.degrees(F.acos(cos)).alias("angle")]


def implied(odds: Sequence[Column]) -> list[Column]:
    """Probabilities of decimal odds without the margin; null if an odd is missing or none is positive."""
    inverse = [1.0 / F.nullif(o, F.lit(0.0)) for o in odds]
    total = sum(inverse[1:], inverse[0])
    return [F.when(total > 0, i / total) for i in inverse]
