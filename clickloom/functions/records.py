"""Byte-level column expressions: class bytes, click time, header fields, marker attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickloom import layout as L


def _label(code: Column, labels: tuple[str, ...], otherwise: str | None = None) -> Column:
    value = F.try_element_at(F.array(*[F.lit(x) for x in labels]), code.cast("int") + 1)
    return value if otherwise is None else F.coalesce(value, F.lit(otherwise))


def quality_class(b: Column) -> Column:
    return b.bitwiseAND(F.lit(3))


def cpod_class(b: Column) -> dict[str, Column]:
    """Fields of byte 37 of a C-POD click."""
    species = F.shiftright(b.bitwiseAND(F.lit(240)), 4)
    return {
        "quality_class": quality_class(b),
        "quality": _label(quality_class(b), L.QUALITY_LABELS),
        "species_class": species,
        "species": _label(species, L.CPOD_SPECIES_LABELS, L.UNKNOWN_SPECIES),
        "rate_good": F.shiftright(b.bitwiseAND(F.lit(4)), 2),
        "species_good": F.shiftright(b.bitwiseAND(F.lit(8)), 3),
    }


def fpod_class(b: Column) -> dict[str, Column]:
    """Fields of byte 15 of an F-POD train record."""
    species = F.shiftright(b.bitwiseAND(F.lit(12)), 2)
    return {
        "quality_class": quality_class(b),
        "quality": _label(quality_class(b), L.QUALITY_LABELS),
        "species_class": species,
        "species": _label(species, L.FPOD_SPECIES_LABELS),
        "rate_good": (b.bitwiseAND(F.lit(128)) == 128).cast("int"),
        "species_good": (b.bitwiseAND(F.lit(64)) == 64).cast("int"),
    }


def click_time_us(high: Column, mid: Column, low: Column, tick_us: int = L.TICK_US) -> Column:
    """Microseconds after the start of the minute."""
    ticks = (high.cast("long") * 256 + mid) * 256 + low
    return ticks * tick_us


def tilt_angle(b: Column) -> Column:
    """Degrees from vertical."""
    return F.degrees(F.acos(1 - b / F.lit(128.0)))


def big_endian(header: Column, first: int, last: int) -> Column:
    """Unsigned big-endian number at 1-based bytes ``first`` to ``last`` of a binary column."""
    return F.conv(F.hex(F.substring(header, first, last - first + 1)), 16, 10).cast("long")


def clock(minutes: Column) -> Column:
    """Time stamp of a count of minutes since the recorder clock base."""
    base = F.lit(L.CLOCK_BASE).cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", minutes.cast("long"), base)


def header_facts(header: Column) -> dict[str, Column]:
    version = big_endian(header, *L.VERSION_BYTES)
    return {
        "start_time": clock(big_endian(header, *L.START_MINUTE_BYTES)),
        "tilt_min": big_endian(header, L.TILT_BYTES[0], L.TILT_BYTES[0]).cast("int"),
        "tilt_max": big_endian(header, L.TILT_BYTES[1], L.TILT_BYTES[1]).cast("int"),
        "version": version.cast("int"),
        "has_extended_amps": version > L.EXTENDED_AMPS_ABOVE_VERSION,
    }


def minute_on_cpod(tilt: Column, raw_clicks: Column, tilt_min: Column, tilt_max: Column) -> Column:
    """0 where the tilt byte lies outside the switch limits, unless clicks were logged."""
    outside = (tilt > tilt_max) | (tilt < tilt_min)
    return F.when(F.coalesce(raw_clicks, F.lit(0)) > 0, 1).when(outside, 0).otherwise(1)


def minute_on_fpod(nall: Column) -> Column:
    return (nall != 0).cast("int")
