"""Our detections against vendor exports of the same recordings.

``ours`` has DETECTION_DATE_TIME and NUMBER_CLICKS_TOTAL, three rows per minute; ``vendor`` has dt and
nall_m. ``keys`` name further columns of both sides, such as the recording, where several are compared.

Recordings and exports mostly agree, so days are compared first: each side adds up, for each day, its rows and counts
weighted by hashes of their minutes. The sums are combined before anything is shuffled. Only rows of days whose sums differ
are shuffled and compared minute by minute; a day whose sums agree has the same minutes and counts on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.session import write_and_read

QUALITIES = 3
# Days that differ may be sent to every task if they are this few.
MAX_BROADCAST = 100_000
NO_DAY = -(2**31)


def _day(time: str) -> Column:
    return F.coalesce(F.unix_date(F.to_date(F.col(time))), F.lit(NO_DAY)).alias("_day")


def _sums(side: DataFrame, keys: tuple[str, ...], time: str, value: Column, weight: int) -> DataFrame:
    """Rows, rows without a value, and hash-weighted sums of rows and values of each day."""
    minute = F.col(time).cast("timestamp_ntz")
    hashes = [F.pmod(F.xxhash64(minute, F.lit(seed)), F.lit(2**31 - 1)).cast("decimal(10,0)") for seed in (1, 2)]
    exact = (value * weight).cast("decimal(24,6)")
    return side.groupBy(*keys, _day(time)).agg(
        F.count("*").alias("_n"),
        F.count_if(value.isNull()).alias("_empty"),
        *(F.sum(h * weight).alias(f"_rows{i}") for i, h in enumerate(hashes)),
        *(F.sum(h * exact).alias(f"_sum{i}") for i, h in enumerate(hashes)),
    )


def day_digests(ours: DataFrame, vendor: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows of both sides of each day and whether the day has to be compared minute by minute.

    The two weights of a minute are 31-bit hashes. A single minute that differs always shows; differences in several
    minutes cancel out in both sums with a chance of about 2^-62.
    """
    mine = _sums(ours, keys, "DETECTION_DATE_TIME", F.col("NUMBER_CLICKS_TOTAL"), 1)
    theirs = _sums(vendor, keys, "dt", F.coalesce("nall_m", F.lit(0)), QUALITIES)
    on = [*keys, "_day"]
    both = mine.alias("o").join(theirs.alias("v"), on, "full_outer")
    equal = (F.col("o._n") == F.col("v._n") * QUALITIES) & (F.col("o._empty") == 0)
    for c in ("_rows0", "_rows1", "_sum0", "_sum1"):
        equal = equal & (F.col(f"o.{c}") == F.col(f"v.{c}"))
    # A day without a time has no minutes that could be the same.
    differs = ~F.coalesce(equal, F.lit(False)) | (F.col("_day") == NO_DAY)
    zero = F.lit(0).cast("long")
    return both.select(*on, F.coalesce("o._n", zero).alias("n_ours"), F.coalesce("v._n", zero).alias("n_vendor"), differs.alias("differs"))


@dataclass(frozen=True)
class Narrowed:
    """Both sides without the days that are the same, and the rows of each day."""

    ours: DataFrame
    vendor: DataFrame
    days: DataFrame


def narrowed(ours: DataFrame, vendor: DataFrame, keys: tuple[str, ...] = ()) -> Narrowed:
    days = write_and_read(day_digests(ours, vendor, keys), "day-digests")
    differ = days.filter("differs").select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_day").alias("__day")).distinct()
    if differ.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        differ = F.broadcast(differ)

    def kept(side: DataFrame, time: str) -> DataFrame:
        same = F.col("_day") == F.col("__day")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return side.withColumn("_day", _day(time)).join(differ, same, "left_semi").drop("_day")

    return Narrowed(kept(ours, "DETECTION_DATE_TIME"), kept(vendor, "dt"), days)


def click_totals(ours: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Click total of each minute: the sum over the three quality rows divided by three."""
    return ours.groupBy(*keys, F.col("DETECTION_DATE_TIME").alias("dt")).agg(
        (F.sum("NUMBER_CLICKS_TOTAL") / QUALITIES).alias("our_nall")
    )


def row_count_difference(ours: DataFrame, vendor: DataFrame) -> DataFrame:
    """Vendor rows minus our minutes."""
    sides = vendor.select(F.lit(1.0).alias("v")).unionAll(ours.select(F.lit(-1.0 / QUALITIES).alias("v")))
    counts = sides.agg(F.count_if(F.col("v") > 0).alias("n_vendor"), F.count_if(F.col("v") < 0).alias("n_ours"))
    return counts.select((F.col("n_vendor") - F.col("n_ours") / QUALITIES).alias("row_difference"))


def by_minute(ours: DataFrame, vendor: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Both sides on one row per minute. An empty vendor count is 0, a missing minute stays NULL."""
    theirs = vendor.select(*keys, "dt", F.coalesce("nall_m", F.lit(0)).alias("vendor_nall"))
    return theirs.join(click_totals(ours, keys), [*keys, "dt"], "full_outer").withColumn(
        "nall_diff", F.col("vendor_nall") - F.col("our_nall")
    )


def missing_minutes(ours: DataFrame, vendor: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Number of minutes that each side lacks."""
    left = narrowed(ours, vendor, keys)
    return by_minute(left.ours, left.vendor, keys).agg(
        F.count_if(F.col("our_nall").isNull()).alias("missing_in_ours"),
        F.count_if(F.col("vendor_nall").isNull()).alias("missing_in_vendor"),
    )


def mismatches(ours: DataFrame, vendor: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    left = narrowed(ours, vendor, keys)
    return by_minute(left.ours, left.vendor, keys).filter(F.col("nall_diff") != 0)


def first_mismatches(ours: DataFrame, vendor: DataFrame, keys: tuple[str, ...] = (), n: int = 10) -> DataFrame:
    """The report's list of the first ``n`` minutes that differ."""
    return mismatches(ours, vendor, keys).orderBy("dt", *keys).limit(n)


def reconcile(ours: DataFrame, vendor: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One report row: row difference, missing minutes, mismatches and verdict, from days and the minutes of those that differ."""
    left = narrowed(ours, vendor, keys)
    theirs = left.vendor.groupBy(*keys, "dt").agg(F.sum(F.coalesce("nall_m", F.lit(0))).alias("vendor_nall"), F.lit(True).alias("_v"))
    mine = left.ours.groupBy(*keys, F.col("DETECTION_DATE_TIME").alias("dt")).agg(
        (F.sum("NUMBER_CLICKS_TOTAL") / QUALITIES).alias("our_nall"), F.lit(True).alias("_o")
    )
    minutes = theirs.join(mine, [*keys, "dt"], "full_outer").agg(
        F.count_if(F.col("_o").isNull()).alias("missing_in_ours"),
        F.count_if(F.col("_v").isNull()).alias("missing_in_vendor"),
        F.count_if(F.col("vendor_nall") != F.col("our_nall")).alias("n_mismatch"),
    )
    rows = left.days.agg(
        (F.coalesce(F.sum("n_vendor"), F.lit(0)) - F.coalesce(F.sum("n_ours"), F.lit(0)) / QUALITIES).alias("row_difference")
    )
    # Two reports of one row each.
    report = rows.withColumn("_one", F.lit(1)).join(minutes.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return report.withColumn("verdict", F.when(F.col("n_mismatch") == 0, "PASS").otherwise("FAIL"))
