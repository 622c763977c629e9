"""Column expressions over metadata text: dates, durations, coordinates, empties."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(c: Column) -> Column:
    """Missing, white space only, or the word nan."""
    text = F.trim(c.cast("string"))
    return text.isNull() | (text == "") | (F.lower(text) == "nan")


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), F.trim(c))


def assemble_timestamp(year: Column, month: Column, day: Column, time: Column | None = None) -> Column:
    """Time stamp from text parts; NULL where they are no valid instant.

    A one-digit hour and a missing seconds part are completed.
    """
    date = F.concat_ws("-", F.trim(year), F.lpad(F.trim(month), 2, "0"), F.lpad(F.trim(day), 2, "0"))
    whole = F.trim(year).rlike(r"^\d{4}$") & F.trim(month).rlike(r"^\d{1,2}$") & F.trim(day).rlike(r"^\d{1,2}$")
    if time is None:
        return F.when(whole, F.concat(date, F.lit(" 00:00:00"))).try_cast("timestamp_ntz")
    clean = F.trim(time)
    padded = F.when(clean.rlike(r"^\d:"), F.concat(F.lit("0"), clean)).otherwise(clean)
    full = F.when(F.regexp_count(padded, F.lit(":")) == 1, F.concat(padded, F.lit(":00"))).otherwise(padded)
    valid = whole & full.rlike(r"^\d{2}:\d{2}:\d{2}$")
    return F.when(valid, F.concat_ws(" ", date, full)).try_cast("timestamp_ntz")


def split_timestamp(c: Column, prefix: str) -> dict[str, Column]:
    """Inverse of :func:`assemble_timestamp`."""
    return {
        f"{prefix}_YEAR": F.year(c),
        f"{prefix}_MONTH": F.month(c),
        f"{prefix}_DAY": F.dayofmonth(c),
        f"{prefix}_TIME": F.date_format(c, "HH:mm:ss"),
    }


def format_duration(seconds: Column) -> Column:
    whole = F.floor(seconds)
    text = F.format_string(
        "%d days, %d hours, %d minutes",
        F.floor(whole / 86400),
        F.floor(F.pmod(whole, F.lit(86400)) / 3600),
        F.floor(F.pmod(whole, F.lit(3600)) / 60),
    )
    return F.when(seconds.isNull(), "NaN").otherwise(text)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def coordinate_error(lat: Column, long: Column) -> Column:
    """Message for a coordinate pair out of range or not numeric; NULL when both are fine."""
    y, x = lat.try_cast("double"), long.try_cast("double")
    bad_lat = ~F.coalesce(y.between(-90, 90) & ~F.isnan(y), F.lit(False))
    bad_long = ~F.coalesce(x.between(-180, 180) & ~F.isnan(x), F.lit(False))
    return (
        F.when(bad_lat & bad_long, "- Invalid latitude and longitude.")
        .when(bad_lat, "- Invalid latitude.")
        .when(bad_long, "- Invalid longitude.")
    )


def normalise_coordinate(c: Column) -> Column:
    """Pad a one-digit whole part on the left and a four-digit fraction on the right."""
    text = F.trim(c)
    left = F.regexp_extract(text, r"^([^.]*)\.([^.]*)$", 1)
    right = F.regexp_extract(text, r"^([^.]*)\.([^.]*)$", 2)
    left2 = F.when(left.rlike(r"^\d$"), F.concat(F.lit("0"), left)).otherwise(left)
    right2 = F.when(right.rlike(r"^\d{4}$"), F.concat(right, F.lit("0"))).otherwise(right)
    return F.when(text.rlike(r"^[^.]*\.[^.]*$"), F.concat_ws(".", left2, right2)).otherwise(text)


def coordinate_ok(c: Column) -> Column:
    """Blank, or two digits, a dot and five digits."""
    return (F.trim(c) == "") | normalise_coordinate(c).rlike(r"^\d{2}\.\d{5}$")


# Patterns tried in order before the slash-date rule (fixed values).
COMMON_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss", "dd-MMM-yyyy HH:mm:ss")
TIME_SUFFIXES = (" H:mm:ss", " H:mm", "")
# Messages of the date check (fixed values).
DATE_TOO_EARLY = "Date earlier than allowed minimum."
DATE_INVALID = "- Invalid datetime format. Please use format: yyyy-MM-ddTHH:mm:ssZ."


def parse_any_timestamp(c: Column, formats: tuple[str, ...] = COMMON_FORMATS, month_first: bool = True) -> Column:
    """Time stamp from text in one of several shapes, a slash date, or a spreadsheet day number."""
    text = F.trim(c)

    def parsed(fmt: str) -> Column:
        return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")

    listed = [F.when(F.year(parsed(f)) >= 1900, parsed(f)) for f in formats]
    slash = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
    first = F.regexp_extract(text, slash, 1).try_cast("int")
    second = F.regexp_extract(text, slash, 2).try_cast("int")
    us = F.coalesce(*[parsed("M/d/yyyy" + t) for t in TIME_SUFFIXES])
    eu = F.coalesce(*[parsed("d/M/yyyy" + t) for t in TIME_SUFFIXES])
    us_order = (first <= 12) if month_first else ((first <= 12) & (second > 12))
    slashed = F.when(text.rlike(slash), F.when(us_order, us).otherwise(eu))
    days = F.when(text.rlike(r"^\d+(\.\d+)?$"), text.try_cast("double"))
    # Whole day numbers beyond year 9999 are no dates.
    serial = F.when(
        days < 2958466,
        F.timestamp_add("SECOND", F.round(days * 86400).cast("long"), F.lit("1899-12-30 00:00:00").cast("timestamp_ntz")),
    )
    return F.when(text != "", F.coalesce(*listed, slashed, serial))


def timestamp_error(c: Column, parsed: Column, min_date: str) -> Column:
    early = parsed < F.lit(min_date).cast("timestamp_ntz")
    blank = F.coalesce(F.trim(c) == "", F.lit(True))
    return F.when(blank, "").when(parsed.isNull(), DATE_INVALID).when(early, DATE_TOO_EARLY).otherwise("")
