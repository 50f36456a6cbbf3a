"""Scalar column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: Column, digits: int) -> Column:
    """Round halves away from zero on the binary value, so 1.005 stays 1.0.

    From 2**52 units on a double has no fraction of a unit, so such a value is already round.
    """
    scale = float(10 ** digits)
    whole = F.abs(c) * scale >= float(2 ** 52)
    return F.when(whole, c.cast("double")).otherwise(F.signum(c) * F.floor(F.abs(c) * scale + 0.5) / F.lit(scale))


def day_first_date(c: Column | str) -> Column:
    """Day-first text date in the three spellings the files use; bad text is NULL.

    Two-digit years from 69 on belong to the last century.
    """
    text = F.trim(as_column(c))
    # The shape picks the pattern: a failed parse attempt costs far more than a match.
    year = F.substring_index(text, "/", -1)
    short = F.try_to_date(text, "d/M/yy")
    return (F.when(F.length(year) == 4, F.try_to_date(text, "d/M/yyyy"))
            .when((F.length(year) == 2) & (year >= "69"), F.add_months(short, -1200))
            .when(F.length(year) == 2, short)
            .when(F.substring(text, 5, 1) == "-", F.try_to_date(text, "yyyy-MM-dd")))


def to_number(c: Column | str) -> Column:
    text = F.trim(as_column(c).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_whole(c: Column | str, kind: str = "int") -> Column:
    """Numeric text to a nullable whole number; ``2.0`` is 2, fractions are NULL."""
    text = F.trim(as_column(c).cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.substring_index(text, ".", 1).try_cast(kind))


def code(c: Column | str) -> Column:
    return F.upper(F.trim(as_column(c)))


def has_text(c: Column | str) -> Column:
    c = as_column(c)
    return c.isNotNull() & (F.trim(c) != "")


def season_label(c: Column | str, century: str = "20") -> Column:
    c = as_column(c)
    return F.concat(F.lit(century), F.substring(c, 1, 2), F.lit("/"), F.substring(c, 3, 2))


def season_year(c: Column | str, position: int, century: str = "20") -> Column:
    return F.concat(F.lit(century), F.substring(as_column(c), position, 2)).cast("int")


def label_for(c: Column | str, labels: dict, default) -> Column:
    """CASE over a small dict with a default."""
    c, out = as_column(c), None
    for key, label in labels.items():
        out = F.when(c == key, label) if out is None else out.when(c == key, label)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def points_for(result: Column | str, winner: str) -> Column:
    """Three for a win of side ``winner`` (H or A), one for a draw, none for a loss."""
    result = as_column(result)
    loser = "A" if winner == "H" else "H"
    return F.when(result == winner, 3).when(result == "D", 1).when(result == loser, 0)


def score_result(home: Column | str, away: Column | str) -> Column:
    home, away = as_column(home), as_column(away)
    return F.when(home > away, "H").when(home < away, "A").otherwise("D")


def from_tenths(c: Column | str) -> Column:
    return as_column(c) / F.lit(10.0)


def utc_timestamp(c: Column | str) -> Column:
    """ISO text to a timestamp; NULL when it does not parse (session zone is UTC)."""
    return F.try_to_timestamp(as_column(c))


def full_name(first: Column | str, second: Column | str) -> Column:
    return F.concat(as_column(first), F.lit(" "), as_column(second))


def date_key(day: Column | str) -> Column:
    """YYYYMMDD as a whole number, by arithmetic rather than by formatting."""
    day = as_column(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_columns(day: Column | str) -> list[Column]:
    day = as_column(day)
    return [
        date_key(day).alias("date_id"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekofyear(day).alias("iso_week"),
        F.dayofweek(day).isin(1, 7).cast("int").alias("is_weekend"),
    ]


def safe_ratio(x: Column, y: Column, digits: int | None = None) -> Column:
    """``x / y``, NULL where ``y`` is zero or NULL."""
    ratio = F.try_divide(x.cast("double"), F.nullif(y.cast("double"), F.lit(0.0)))
    return ratio if digits is None else round_half_away(ratio, digits)


def percent(x: Column, y: Column, digits: int | None = None) -> Column:
    ratio = F.try_divide(F.lit(100.0) * x, F.nullif(y.cast("double"), F.lit(0.0)))
    return ratio if digits is None else round_half_away(ratio, digits)


def shorten(c: Column | str, limit: int = 34) -> Column:
    """Cut text longer than ``limit`` and mark the cut with an ellipsis."""
    c = as_column(c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("…"))).otherwise(c)


def fixture_label(period: Column | str, opponent: Column | str, at_home: Column | str) -> Column:
    """``7 Leeds United (H)``; ``?`` for an unknown opponent, no venue when unknown."""
    venue = F.when(as_column(at_home), " (H)").when(~as_column(at_home), " (A)").otherwise("")
    return F.concat(as_column(period).cast("string"), F.lit(" "),
                    F.coalesce(as_column(opponent), F.lit("?")), venue)


def player_label(name: Column | str, team: Column | str) -> Column:
    return F.concat(as_column(name), F.lit(" · "), as_column(team))


def stamp(c: Column | str, pattern: str = "dd MMM yyyy HH:mm") -> Column:
    return F.date_format(as_column(c), pattern)


def fingerprint(*columns: Column | str) -> Column:
    """Text fingerprint of the columns that move when the row changes."""
    return F.concat_ws(":", *[F.coalesce(as_column(c).cast("string"), F.lit("∅")) for c in columns])
