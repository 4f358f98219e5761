"""Irregular readings onto a regular grid.

Readings are averaged per period, the periods of a stream are cut into time shards that exchange
halo periods, and each shard fills the periods missing between its own: short gaps by
shape-preserving (monotone) cubic interpolation, long gaps are left without a value and marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import epoch_seconds, iso_utc
from .halo import OWN, over_shards

OBSERVED, FILLED, GAP = "observed", "filled", "gap"
GRID = "stream_id long, step_s long, period long, value double, state int"


def monotone_slopes(x: np.ndarray, y: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Slopes at the nodes of piecewise cubics that overshoot nowhere; one curve per segment.

    Inside, the weighted harmonic mean of the two secants, 0 where they differ in sign; at the ends
    of a segment the secant itself, 0 for a single node.
    """
    n = len(x)
    if n < 2:
        return np.zeros(n)
    joined = seg[1:] == seg[:-1]
    h = np.where(joined, np.diff(x), 1.0)
    secant = np.where(joined, np.diff(y) / h, 0.0)
    left, right = np.r_[False, joined], np.r_[joined, False]
    hl, hr = np.r_[1.0, h], np.r_[h, 1.0]
    dl, dr = np.r_[0.0, secant], np.r_[secant, 0.0]
    w1, w2 = 2 * hr + hl, hr + 2 * hl
    with np.errstate(divide="ignore", invalid="ignore"):
        inner = (w1 + w2) / (w1 / dl + w2 / dr)
    inner = np.where(dl * dr > 0, inner, 0.0)
    return np.where(left & right, inner, np.where(left, dl, np.where(right, dr, 0.0)))


def fill_shard(key: np.ndarray, period: np.ndarray, value: np.ndarray, own: np.ndarray, max_gap: int, chunk: int = 200_000) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows (node index, period, value, state) of the own nodes and of the gaps that follow them."""
    n = len(key)
    linked = np.r_[key[1:] == key[:-1], False] if n else np.zeros(0, bool)
    # a long gap ends a curve: no slope is taken across it
    curve = np.cumsum(np.r_[0, ~linked[:-1] | (np.diff(period) - 1 > max_gap)]) if n else np.zeros(0, np.int64)
    slope = monotone_slopes(period.astype(float), value, curve)
    span = np.where(linked, np.r_[np.diff(period), 1], 1)
    nodes = np.flatnonzero(own)
    start, at = 0, np.cumsum(span[nodes])
    done, total = 0, int(at[-1]) if len(at) else 0
    while done < total:
        # rows done .. upto-1 of the shard's output; a long gap may need several chunks
        upto = min(total, done + chunk)
        row = np.arange(done, upto)
        which = np.searchsorted(at, row, side="right")
        node = nodes[which]
        k = row - (at[which] - span[node])
        g, nxt = span[node], np.minimum(node + 1, n - 1)
        u = k / g
        width = g.astype(float)
        y = (
            (1 + 2 * u) * (1 - u) ** 2 * value[node] + u * (1 - u) ** 2 * width * slope[node]
            + u * u * (3 - 2 * u) * value[nxt] + u * u * (u - 1) * width * slope[nxt]
        )
        state = np.where(k == 0, 0, np.where(g - 1 <= max_gap, 1, 2)).astype(np.int32)
        yield node, period[node] + k, np.where(k == 0, value[node], np.where(state == 1, y, np.nan)), state
        done, start = upto, upto


def regular_grid(observations: DataFrame, streams: DataFrame, max_gap: int = 12, rows_per_shard: int = 100_000, only_missing: bool = False) -> DataFrame:
    """One row per period of each stream between its first and last period with a reading.

    Columns: stream_id, period_start (ISO text, UTC), value, status. ``value`` is the mean of the
    period's readings (``observed``), interpolated at gaps of at most ``max_gap`` periods
    (``filled``), or null (``gap``). Periods of step_minutes are counted from the epoch.

    A reading is a row of the stream's (source, id, parameter_name) with a full date and a value that
    is neither null nor NaN; nulls in those key columns match nothing. Streams without readings, with
    a null id or with no positive step give no row. Ties and repeated readings share a period, so
    they change only its mean. Other columns of either table are ignored; empty tables give an empty
    result. ``only_missing`` leaves out observed periods.
    """
    total = observations.select("obs_id").count()
    wanted = streams.where("stream_id is not null and step_minutes > 0").select(
        F.col("stream_id").cast("long"), F.col("source").alias("s"), F.col("id").alias("i"), F.col("parameter_name").alias("p"), (F.col("step_minutes").cast("long") * 60).alias("step_s")
    )
    readings = (
        observations.where(F.col("parameter_value").isNotNull() & ~F.isnan("parameter_value"))
        .select(F.col("source").alias("s"), F.col("id").alias("i"), F.col("parameter_name").alias("p"), epoch_seconds(F.col("date_measured"), F.col("time_measured")).alias("ts"), F.col("parameter_value").alias("v"))
        .join(wanted, ["s", "i", "p"])
        .where("ts is not null")
    )
    periods = readings.groupBy("stream_id", "step_s", F.floor(F.col("ts") / F.col("step_s")).alias("period")).agg(F.avg("v").alias("v"))

    def shard(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {c: rows[c].to_numpy() for c in ("stream_id", "step_s", "period", "v", "_halo")}
        for node, period, value, state in fill_shard(col["stream_id"], col["period"], col["v"], col["_halo"] == OWN, max_gap):
            keep = state > 0 if only_missing else slice(None)
            node, period, value, state = node[keep], period[keep], value[keep], state[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(col["stream_id"][node]), pa.array(col["step_s"][node]), pa.array(period), pa.array(value, from_pandas=True), pa.array(state)],
                ["stream_id", "step_s", "period", "value", "state"],
            )

    grid = over_shards(periods, "stream_id", ["period"], shard, GRID, total, rows_per_shard, halo=8)
    status = F.element_at(F.array(*map(F.lit, (OBSERVED, FILLED, GAP))), F.col("state") + 1)
    return grid.select("stream_id", iso_utc(F.col("period") * F.col("step_s")).alias("period_start"), "value", status.alias("status"))


def missing_periods(observations: DataFrame, streams: DataFrame, max_gap: int = 12) -> DataFrame:
    """stream_id and period_start of the periods without reading between two that have one."""
    return regular_grid(observations, streams, max_gap, only_missing=True).select("stream_id", "period_start")
