"""Products from a well's history: trends, recency, density, change, status, seasons, depletion."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.datetimes import iso_utc
from ..operators.silver import daily

JULIAN_YEAR_S = 31_557_600
Z_95 = 1.959963984540054
WELL = ["source", "id", "parameter_name"]


def _noon(day: str = "day") -> F.Column:
    return F.unix_date(F.col(day)).cast("long") * 86400


def pair_statistics(x: np.ndarray, y: np.ndarray, bins: int = 65_536, block: int = 512, direct: int = 1_500) -> tuple[int, float]:
    """Mann-Kendall S and the median of all pairwise slopes of a series with distinct, sorted x.

    Long series never hold their pairs at once: slopes are counted into bins, and only the bins around
    the middle ranks are looked into.
    """
    n = len(x)

    def slopes() -> Iterator[np.ndarray]:
        for a in range(0, n - 1, block):
            i = np.arange(a, min(a + block, n - 1))
            keep = np.arange(n)[None, :] > i[:, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                yield ((y[None, :] - y[i, None]) / (x[None, :] - x[i, None]))[keep]

    pairs = n * (n - 1) // 2
    wanted = sorted({(pairs - 1) // 2, pairs // 2})
    if n <= direct:
        s = np.concatenate(list(slopes()))
        part = np.partition(s, wanted)
        return int(np.sign(s).sum()), float(np.mean([part[k] for k in wanted]))
    sign, lo, hi = 0, np.inf, -np.inf
    for s in slopes():
        sign += int(np.sign(s).sum())
        lo, hi = min(lo, s.min()), max(hi, s.max())
    if lo == hi:
        return sign, float(lo)
    below = 0
    while True:
        # narrow the range around the middle ranks until few slopes are left in it
        count, under = np.zeros(bins, np.int64), 0
        width = (hi - lo) / bins
        for s in slopes():
            under += int((s < lo).sum())
            s = s[(s >= lo) & (s <= hi)]
            count += np.bincount(np.minimum(((s - lo) / width).astype(np.int64), bins - 1), minlength=bins)
        upto = under + np.cumsum(count)
        a, b = np.searchsorted(upto, wanted[0], side="right"), np.searchsorted(upto, wanted[-1], side="right")
        lo, hi = lo + a * width - abs(width) * 1e-6, lo + (b + 1) * width + abs(width) * 1e-6
        if count[a : b + 1].sum() <= 2_000_000 or width <= np.finfo(float).eps * max(abs(lo), abs(hi)):
            break
    below, kept = 0, []
    for s in slopes():
        below += int((s < lo).sum())
        kept.append(s[(s >= lo) & (s <= hi)])
    inside = np.sort(np.concatenate(kept))
    return sign, float(np.mean([inside[k - below] for k in wanted]))


TREND = "source string, id string, parameter_name string, record_count long, observation_count long, first long, last long, span_years double, n long, s long, var_s double, z double, p double, slope double"


def _seen(day_values: DataFrame, *more: F.Column) -> DataFrame:
    """Per series: days, readings, first and last day (UTC seconds), span in years."""
    return day_values.groupBy(*WELL).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum("n").alias("observation_count"), F.min(_noon()).alias("first"), F.max(_noon()).alias("last"),
        ((F.max(_noon()) - F.min(_noon())) / JULIAN_YEAR_S).alias("span"), *more,
    )


def _times(prefix: str = "") -> list[F.Column]:
    return [iso_utc(F.col(f"{prefix}first")).alias("first_observation_datetime"), iso_utc(F.col(f"{prefix}last")).alias("last_observation_datetime")]


def trend_statistics(day_values: DataFrame) -> DataFrame:
    """Days, span, S, its variance with ties, Z, its two-sided probability, and the Theil-Sen slope per year of each daily series.

    Series of fewer than 10 days, or of fewer than 4 or less than two years, get no statistics. A series of
    days is bounded by the calendar, so one task can hold it; its pairs are never held. The series is
    shuffled once and reaches numpy as Arrow arrays.
    """
    grouped = _seen(day_values, F.array_sort(F.collect_list(F.struct(_noon().alias("t"), F.col("value").alias("v")))).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("p")
            at = lists.offsets.to_numpy()
            t_all, v_all = lists.values.field("t").to_numpy() / JULIAN_YEAR_S, lists.values.field("v").to_numpy()
            spans = batch.column("span").to_numpy()
            n, sign, var, z, chance, slope = [], [], [], [], [], []
            for k in range(batch.num_rows):
                t, v = t_all[at[k] : at[k + 1]], v_all[at[k] : at[k + 1]]
                m = len(v)
                if not (m >= 10 or (m >= 4 and spans[k] >= 2)):
                    for c in (n, sign, var, z, chance, slope):
                        c.append(None)
                    continue
                ties = np.unique(v, return_counts=True)[1].astype(float)
                a, b = pair_statistics(t, v)
                n.append(m)
                sign.append(a)
                var.append((m * (m - 1) * (2 * m + 5) - (ties * (ties - 1) * (2 * ties + 5)).sum()) / 18)
                z.append(0.0 if var[-1] <= 0 or a == 0 else (a - np.sign(a)) / math.sqrt(var[-1]))
                chance.append(C.normal_tail(z[-1]))
                slope.append(b)
            keep = [batch.column(c) for c in (*WELL, "record_count", "observation_count", "first", "last", "span")]
            stats = [pa.array(n, pa.int64()), pa.array(sign, pa.int64()), *[pa.array(c, pa.float64()) for c in (var, z, chance, slope)]]
            yield pa.RecordBatch.from_arrays([*keep, *stats], [*WELL, "record_count", "observation_count", "first", "last", "span_years", "n", "s", "var_s", "z", "p", "slope"])

    return grouped.mapInArrow(run, TREND)


def trends(rows: DataFrame, reducer: str, units: str = "ft/year") -> DataFrame:
    """Category, slope per year, tau and probability per series; series too short are ``not enough data``."""
    t = trend_statistics(daily(rows, reducer))
    category = F.when(F.col("n").isNull(), "not enough data").when(F.abs("z") <= Z_95, "stable").when(F.col("z") > 0, "increasing").otherwise("decreasing")
    return t.select(
        *WELL, "record_count", "observation_count", *_times(), F.round("span_years", 3).alias("span_years"), C.half_up(F.col("slope"), 2).alias("slope_per_year"), F.lit(units).alias("slope_units"), category.alias("trend_category"),
        C.half_up(F.col("p"), 4).alias("mk_p_value"), F.round(F.col("s") / (F.col("n") * (F.col("n") - 1) / 2), 4).alias("mk_tau"),
    )


def recency(rows: DataFrame, as_of: str | None, stale_days: int = 365, wells: DataFrame | None = None) -> DataFrame:
    """Count, first and last reading, days since the last one; active, stale, or, without a usable ``as_of``, unknown.

    With ``wells`` (source, id), one row for each of them whatever its series; those without a reading are
    ``no data``.
    """
    end = F.unix_timestamp(F.lit(as_of).try_cast("timestamp"))
    days = F.floor((end - F.col("last")) / 86400)
    keys = WELL[:2] if wells is not None else WELL
    seen = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    if wells is not None:
        seen = wells.select(*keys).join(seen, keys, "left").withColumn("record_count", F.coalesce("record_count", F.lit(0).cast("long")))
    state = F.when(F.col("record_count") == 0, "no data").when(days.isNull(), "unknown").when(days <= stale_days, "active").otherwise("stale")
    return seen.select(*keys, "record_count", *_times(), days.alias("days_since_last"), state.alias("status"))


def density(rows: DataFrame) -> DataFrame:
    """Readings, distinct days, span, mean interval and readings per year."""
    seen = _seen(daily(rows, "min"))
    return seen.select(*WELL, "observation_count", "record_count", *_times(), F.round("span", 3).alias("span_years"),
                       F.when(F.col("record_count") > 1, F.round(F.col("span") * 365.25 / (F.col("record_count") - 1), 1)).alias("mean_interval_days"),
                       F.when(F.col("span") > 0, F.round(F.col("observation_count") / F.col("span"), 2)).alias("observations_per_year"))


def change(rows: DataFrame, years: float = 5.0) -> DataFrame:
    """Level at the end against the daily level nearest to ``years`` before it, within half of that time; of equally near ones the earlier."""
    days = daily(rows, "min").withColumn("t", _noon())
    ends = days.groupBy(*WELL).agg(F.max("t").alias("end"), F.max_by("value", "t").alias("end_value"), F.sum("n").alias("observation_count"), F.count(F.lit(1)).alias("days"))
    far = F.abs(F.col("t") - (F.col("end") - years * JULIAN_YEAR_S))
    near = days.drop("n").join(ends, WELL).withColumn("far", far)
    before = F.col("t") < F.col("end")
    best = near.groupBy(*WELL, "end", "end_value", "observation_count", "days").agg(F.min_by(F.when(before, F.struct("value", "t", "far")), F.when(before, F.struct("far", "t"))).alias("b"))
    ok = F.coalesce(F.col("b.far") <= years * JULIAN_YEAR_S / 2, F.lit(False))
    best = best.withColumn("start", F.when(ok, F.col("b.t"))).withColumn("start_value", F.when(ok, F.col("b.value"))).drop("b")
    counted = days.select(*WELL, "t").join(best, WELL).groupBy(*best.columns).agg(F.sum((F.col("t") >= F.col("start")).cast("long")).alias("n_in_window"))
    pair = F.col("days") >= 2
    end, start = F.when(pair, C.half_up(F.col("end_value"), 2)), C.half_up(F.col("start_value"), 2)
    diff = C.half_up(end - start, 2)
    return counted.select(
        *WELL, F.lit(float(years)).alias("window_years"), F.round((F.col("end") - F.col("start")) / JULIAN_YEAR_S, 3).alias("actual_window_years"), start.alias("dtw_start"), end.alias("dtw_end"),
        F.when(F.col("start").isNotNull(), iso_utc(F.col("start"))).alias("start_date"), F.when(pair, iso_utc(F.col("end"))).alias("end_date"), diff.alias("change_ft"), F.lit("ft").alias("change_units"),
        F.when(diff > 0, "declining").when(diff < 0, "rising").when(diff == 0, "stable").alias("direction"), F.coalesce("n_in_window", F.lit(0).cast("long")).alias("n_observations_in_window"), "observation_count",
        F.when(diff.isNull(), "insufficient").otherwise("ok").alias("status"),
    )


def status(rows: DataFrame, least: int = 10) -> DataFrame:
    """Midrank percentile of the latest daily level in the well's own record."""
    days = daily(rows, "min")
    latest = _seen(days, F.max_by("value", "day").alias("latest"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.percentile("value", F.lit(0.5)).alias("med"))
    ranked = days.drop("n").join(latest, WELL).groupBy(*latest.columns).agg(F.sum((F.col("value") < F.col("latest")).cast("int")).alias("less"), F.sum((F.col("value") == F.col("latest")).cast("int")).alias("same"))
    pct = F.when(F.col("record_count") >= least, C.half_up(100 * (F.col("less") + 0.5 * F.col("same")) / F.col("record_count"), 1))
    two = lambda c, name: C.half_up(F.col(c), 2).alias(name)
    return ranked.select(*WELL, "record_count", "observation_count", *_times(), F.round("span", 3).alias("span_years"), two("latest", "latest_dtw"), iso_utc(F.col("last")).alias("latest_dtw_date"), two("lo", "min_dtw"), two("med", "median_dtw"),
                         two("hi", "max_dtw"), F.lit("ft").alias("dtw_units"), pct.alias("dtw_percentile"), C.status_class(pct).alias("status"))


def seasonal(rows: DataFrame, least_days: int = 4) -> DataFrame:
    """Range within each year with enough days: mean, largest with its year, and smallest; wells without such a year are ``insufficient``."""
    years = daily(rows, "min").groupBy(*WELL, F.year("day").alias("year")).agg((F.max("value") - F.min("value")).alias("a"), F.count(F.lit(1)).alias("d"), F.sum("n").alias("o"))
    used = F.col("d") >= least_days
    a = F.when(used, F.col("a"))
    return years.groupBy(*WELL).agg(
        F.sum("d").alias("record_count"), F.sum("o").alias("observation_count"), F.count(F.lit(1)).alias("n_years_with_data"), F.sum(used.cast("long")).alias("n_years_used"), F.first(F.lit("ft")).alias("amplitude_units"),
        C.half_up(F.avg(a), 2).alias("mean_amplitude_ft"), C.half_up(F.max(a), 2).alias("max_amplitude_ft"), F.min_by("year", F.when(used, F.struct(-F.col("a"), "year"))).alias("max_amplitude_year"),
        C.half_up(F.min(a), 2).alias("min_amplitude_ft"), F.when(F.max(a).isNull(), "insufficient").otherwise("ok").alias("status"),
    )


def depletion(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """Years until a falling level reaches the bottom of the well, or why there are none."""
    from ..operators.silver import wells

    last = daily(rows, "min").groupBy(*WELL).agg(F.max_by("value", "day").alias("latest"), F.max("day").alias("last_day"))
    depth = wells(sites).select(F.col("source_key").alias("source"), "id", F.when(~F.isnan("well_depth"), C.length_in(F.col("well_depth"), F.col("well_depth_units"), "ft")).alias("depth_ft"))
    t = trends(rows, "min")
    joined = last.join(t, WELL).join(depth, ["source", "id"], "left")
    falling = (F.col("trend_category") == "increasing") & (F.col("slope_per_year") > 0)
    left = F.when(falling, C.half_up(F.col("depth_ft") - F.col("latest"), 2))
    years = F.when(left > 0, C.half_up(left / F.col("slope_per_year"), 1))
    state = F.when(F.col("trend_category") == "not enough data", "not enough data").when(~falling, "not declining").when(F.col("depth_ft").isNull(), "no well depth").when(left <= 0, "dtw exceeds well depth").otherwise("projected")
    category = F.when(F.col("trend_category") != "not enough data", F.col("trend_category"))
    return joined.select(*WELL, "record_count", "observation_count", "span_years", category.alias("trend_category"), F.col("slope_per_year").alias("slope_ft_per_year"), C.half_up(F.col("latest"), 2).alias("latest_dtw"),
                         iso_utc(F.unix_date("last_day").cast("long") * 86400).alias("latest_dtw_date"), left.alias("remaining_ft"), years.alias("years_to_depletion"), (F.year("last_day") + years).cast("int").alias("projected_depletion_year"),
                         state.alias("status"))
