"""Column expressions. All are built-in Spark functions; there is no Python UDF."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import constants as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- typing -----------------------------------------------------------------

def to_double(c) -> Column:
    """Number or NULL; text that is not a number becomes NULL."""
    return col(c).try_cast("double")


def to_int(c) -> Column:
    """Whole number or NULL; accepts ``180`` and ``180.0``. Exact, as a double holds every int."""
    return F.rint(to_double(c)).try_cast("int")


def to_long(c) -> Column:
    return F.coalesce(col(c).try_cast("bigint"), F.rint(to_double(c)).try_cast("bigint"))


def to_date(c) -> Column:
    """ISO date or NULL."""
    return col(c).try_cast("date")


def day_first_date(c) -> Column:
    """Day-first date with a four or two digit year, or an ISO date; else NULL.

    Two-digit years from 69 on belong to the last century. The parts are put in
    ISO order and cast once: a cast gives NULL where a failing parse by format
    would throw inside Spark, and cutting at slashes is cheaper than patterns.
    """
    day, year = F.substring_index(col(c), "/", 1), F.substring_index(col(c), "/", -1)
    month = F.substring_index(F.substring_index(col(c), "/", 2), "/", -1)
    century = F.when(F.length(year) != 2, "").when(year >= "69", "19").otherwise("20")
    iso = F.concat(century, year, F.lit("-"), month, F.lit("-"), day)
    slashed = F.contains(col(c), F.lit("/"))
    three = F.substring_index(col(c), "/", 3) == col(c)
    return to_date(F.when(~slashed, col(c)).when(three, iso))


def season_start_year(path) -> Column:
    """Start year of a ``season-YYZZ`` file name; codes up to 30 are after 2000."""
    yy = F.regexp_extract(col(path), r"season-(\d{2})\d{2}", 1).try_cast("int")
    return F.when(yy <= 30, yy + 2000).otherwise(yy + 1900)


# --- cleaning ---------------------------------------------------------------

def neg_to_null(c) -> Column:
    return F.when(col(c) >= 0, col(c))


def neg_to_zero(c) -> Column:
    """Negative or missing becomes 0."""
    return F.when(col(c) >= 0, col(c)).otherwise(F.lit(0))


def future_to_null(c, as_of) -> Column:
    return F.when(col(c) <= F.lit(as_of).cast("date"), col(c))


def alias_to(c, replacements: Mapping[str, str | None]) -> Column:
    """Replace single values, for example two spellings of one country."""
    out = col(c)
    for old, new in replacements.items():
        out = F.when(out == old, F.lit(new).cast("string")).otherwise(out)
    return out


def lookup(c, mapping: Mapping[str, str], default=None) -> Column:
    """Small fixed mapping; a missing key gives ``default`` (NULL if none)."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), col(c))
    return found if default is None else F.coalesce(found, col(default))


def competition_code(c, default=None) -> Column:
    return lookup(c, C.COMPETITION_CODES, default)


def competition_label(c, default=None) -> Column:
    return lookup(c, C.COMPETITION_LABELS, default)


# --- matches ----------------------------------------------------------------

def match_result(home, away) -> Column:
    """``home``, ``away`` or ``draw``; ``unknown`` when a score is missing."""
    h, a = col(home), col(away)
    return (
        F.when(h > a, "home").when(a > h, "away").when(h == a, "draw").otherwise("unknown")
    )


def total_goals(home, away) -> Column:
    return col(home) + col(away)


def points(result, side: str) -> Column:
    """3 for a win of ``side``, 1 for a draw, else 0."""
    return F.when(col(result) == side, 3).when(col(result) == "draw", 1).otherwise(0)


def match_id(date, home, away, competition) -> Column:
    """First 16 hex digits of the MD5 of date, competition, home and away."""
    parts = [F.coalesce(col(p).cast("string"), F.lit("")) for p in (date, competition, home, away)]
    return F.substring(F.md5(F.concat_ws("_", *parts)), 1, 16)


# --- players ----------------------------------------------------------------

def age_decimal(born, at, digits: int) -> Column:
    return F.round(F.datediff(col(at), col(born)) / F.lit(365.25), digits)


def age_calendar(born, at) -> Column:
    """Full years between two dates, counted on the calendar."""
    b, d = col(born), col(at)
    before = (F.month(d) < F.month(b)) | ((F.month(d) == F.month(b)) & (F.day(d) < F.day(b)))
    return F.year(d) - F.year(b) - before.cast("int")


def per90(amount, minutes, digits: int) -> Column:
    """Amount per 90 minutes; NULL without minutes."""
    return F.round(col(amount) * F.lit(90.0) / F.nullif(col(minutes), F.lit(0)), digits)


def per90_or_zero(amount, minutes, digits: int) -> Column:
    return F.when(col(minutes) > 0, per90(amount, minutes, digits)).otherwise(F.lit(0.0))


def delta(before, after) -> Column:
    return col(after) - col(before)


def delta_pct(before, after, digits: int = 2) -> Column:
    return F.round(
        (col(after) - col(before)) / F.nullif(col(before), F.lit(0.0)) * F.lit(100.0), digits
    )


def difference_pct(predicted, actual, digits: int = 1) -> Column:
    return F.round(
        (col(predicted) - col(actual)) / F.nullif(col(actual), F.lit(0.0)) * F.lit(100.0), digits
    )


def evaluation(pct) -> Column:
    """Under, fair or over valued, by the predicted gap in percent."""
    return (
        F.when(col(pct) > C.FAIR_BAND_PCT, C.UNDER)
        .when(col(pct) < -C.FAIR_BAND_PCT, C.OVER)
        .otherwise(C.FAIR)
    )


def log_value(c) -> Column:
    return F.log1p(col(c))


def unlog_value(c) -> Column:
    return F.expm1(col(c))


# --- scouting ---------------------------------------------------------------

def potential_tier(value) -> Column:
    out = None
    for floor, label in C.POTENTIAL_TIERS:
        test = col(value) >= floor
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(C.POTENTIAL_LOWEST)


def progression_pct(projected, current, unknown: float | None = 0.0) -> Column:
    """Gain over the current value in percent; ``unknown`` when that is 0 or missing."""
    return F.when(
        col(current) > 0,
        F.round((col(projected) - col(current)) / col(current) * F.lit(100.0), 1),
    ).otherwise(F.lit(unknown).cast("double"))


def opportunity(pct) -> Column:
    return (
        F.when(col(pct) > C.FAIR_BAND_PCT, "opportunity")
        .when(col(pct) < -C.FAIR_BAND_PCT, "overvalued")
    )


def peak_age_min(age) -> Column:
    """Youngest age of the peak band, rounded half to even."""
    return F.rint(F.lit(24.0) - (col(age) - 14) * F.lit(2.0) / F.lit(7.0)).cast("int")


def peak_age_max(age) -> Column:
    return peak_age_min(age) + 3


def reliability(age) -> Column:
    return F.when(col(age) <= 15, "indicative").when(col(age) <= 17, "moderate").otherwise("good")


def data_volume(minutes) -> Column:
    return (
        F.when(col(minutes) >= 1000, "sufficient").when(col(minutes) >= 500, "fair").otherwise("low")
    )


def club_level(mean_value) -> Column:
    """Highest club level whose value the club's mean player value reaches."""
    out = F.lit(None).cast("string")
    for label, value in C.CLUB_LEVELS.items():
        out = F.when(col(mean_value) >= value, label).otherwise(out)
    return F.when(col(mean_value).isNull(), F.lit(None)).otherwise(F.coalesce(out, F.lit("amateur")))


def club_level_value(level) -> Column:
    return lookup(level, {k: str(v) for k, v in C.CLUB_LEVELS.items()}).cast("double")


def money_text(c) -> Column:
    """``x.x M€`` from a million on, else ``x K€``."""
    def plain(number: Column, digits: int) -> Column:
        return F.translate(F.format_number(number, digits), ",", "")

    return F.when(
        col(c) >= 1_000_000, F.concat(plain(col(c) / F.lit(1e6), 1), F.lit(" M€"))
    ).otherwise(F.concat(plain(col(c) / F.lit(1e3), 0), F.lit(" K€")))
