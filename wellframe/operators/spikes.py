"""Implausible readings: spikes, stuck values and impossible values, judged per series.

Each series gets an isolation forest over level, difference, seasonal and run-length features; every
reading is scored. A probe, a made-up reading just far enough from the level to be a spike, is scored by
the same forest: readings that stand as alone as the probe are candidates, so the threshold is calibrated
per series. A local check then only rejects candidates that hardly leave the level of their neighbours or
leave it for more than a few readings. Runs of one value and physically impossible values are explicit
rules. Series of any length are cut into time shards with halo rows, so no series is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import epoch_seconds
from .halo import OWN, over_shards

#: What a parameter can be. Others are concentrations or conductivities: 0 and more.
PHYSICAL_LIMITS = {"waterlevels": (-500.0, 3000.0), "ph": (0.0, 14.0)}
OTHERS_LIMITS = (0.0, 9.0e6)
#: Numbers that stand for "no data".
NO_DATA = (-999999.0, -99999.0, -9999.0, -999.0, -999.9, -9999.9, -99999.9, 9999.0, 99999.0, 99999.9, 999999.0, 9999999.0, 1e10)


@dataclass(frozen=True)
class SpikeRules:
    """Parameters of the detector.

    ``trees``, ``sample`` and ``depth`` define each series' forest (``sample`` readings per tree, the
    bound of the method itself). The probe leaves the level, of the series and of its neighbours, by
    ``deviation`` (``level_deviation`` for water levels) noise scales, and the last reading and the season
    by ``probe_share`` of that; a reading is a candidate if its score falls at most ``margin`` below the
    probe's. ``veto`` noise scales is the least deviation from the neighbours that a candidate must show.
    Short series borrow noise from what their parameter usually shows: (absolute, share of the level),
    weighing as much as ``prior_weight`` readings. ``use_forest=False`` leaves the veto alone (for comparison).
    """

    trees: int = 24
    sample: int = 64
    depth: int = 6
    margin: float = 0.02
    probe_share: float = 0.3
    veto: float = 5.0
    use_forest: bool = True
    neighbours: int = 6
    deviation: float = 9.0
    level_deviation: float = 7.0
    prior_weight: float = 8.0
    prior_noise: tuple = (("waterlevels", 0.4, 0.0), ("ph", 0.12, 0.0))
    other_prior_noise: tuple = (0.0, 0.06)
    few: int = 5
    stuck: int = 8
    limits: dict = field(default_factory=lambda: dict(PHYSICAL_LIMITS))
    other_limits: tuple = OTHERS_LIMITS
    no_data: tuple = NO_DATA

    def kinds(self) -> list[str]:
        return list(dict.fromkeys([*self.limits, *(name for name, *_ in self.prior_noise)]))

    def by_kind(self) -> list[list[float]]:
        """Lower and upper limit, absolute and relative prior noise, deviation; of each kind, then of any other."""
        noise = {name: rest for name, *rest in self.prior_noise}
        rows = [(*self.limits.get(k, self.other_limits), *noise.get(k, self.other_prior_noise), self.level_deviation if k == "waterlevels" else self.deviation) for k in self.kinds()]
        return [list(x) for x in zip(*rows, (*self.other_limits, *self.other_prior_noise, self.deviation))]


def _segments(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment number of each row of a sorted key, and the segments' first rows."""
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _medians(group: np.ndarray, x: np.ndarray, groups: int) -> np.ndarray:
    """Median of x without NaN per group."""
    ok = ~np.isnan(x)
    g, v = group[ok], x[ok]
    order = np.lexsort((v, g))
    g, v = g[order], v[order]
    n = np.bincount(g, minlength=groups)
    start = np.cumsum(n) - n
    out = np.full(groups, np.nan)
    has = n > 0
    lo, hi = start[has] + (n[has] - 1) // 2, start[has] + n[has] // 2
    out[has] = (v[lo] + v[hi]) / 2
    return out


def _around(x: np.ndarray, seg: np.ndarray, reach: int) -> np.ndarray:
    """Values of the ``reach`` readings before and after each, without itself; NaN outside the series."""
    n = len(x)
    out = np.full((n, 2 * reach), np.nan)
    for j, shift in enumerate([*range(-reach, 0), *range(1, reach + 1)]):
        at = np.arange(n) + shift
        ok = (at >= 0) & (at < n)
        ok[ok] = seg[at[ok]] == seg[ok]
        out[ok, j] = x[at[ok]]
    return out


def _row_median(m: np.ndarray) -> np.ndarray:
    """Median of each row without NaN; NaN where there is none."""
    s = np.sort(m, axis=1)
    n = (~np.isnan(s)).sum(axis=1)
    r = np.arange(len(s))
    out = (s[r, np.maximum(n - 1, 0) // 2] + s[r, np.minimum(n // 2, s.shape[1] - 1)]) / 2
    return np.where(n > 0, out, np.nan)


def _mean_depth(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree of n points."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))


def forest_scores(seg: np.ndarray, features: np.ndarray, rules: SpikeRules, probe: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Isolation-forest scores of the rows and of each segment's probe, with a forest of its own per segment.

    All segments' trees are grown level by level at once, each on a sample of the segment and its probe.
    Rows of a segment must be neighbours; ``probe`` has one row per segment.
    """
    rows, width = features.shape
    if not rows:
        return np.zeros(0), np.zeros(0)
    groups = int(seg[-1]) + 1
    rng = np.random.default_rng(seed)
    size = np.bincount(seg, minlength=groups)
    start = np.cumsum(size) - size
    every = np.arange(groups)
    features, seg = np.vstack([features, probe]), np.r_[seg, every]
    n = rows + groups
    total = np.zeros(n)
    cells = 2**rules.depth
    for _ in range(rules.trees):
        take = np.minimum(size, rules.sample)
        of = np.repeat(np.arange(groups), take)
        rank = np.arange(len(of)) - np.repeat(np.cumsum(take) - take, take)
        # one reading from each of ``take`` equal stretches of the segment
        row = start[of] + np.minimum(size[of] - 1, ((rank + rng.random(len(of))) * size[of] / take[of]).astype(np.int64))
        of, row = np.r_[of, every], np.r_[row, rows + every]
        sub = features[row]
        s_node, r_node = np.zeros(len(row), np.int64), np.zeros(n, np.int64)
        s_end, r_end = np.zeros(len(row), bool), np.zeros(n, bool)
        length = np.zeros(n)
        for level in range(rules.depth):
            nodes = 2**level
            which = rng.integers(0, width, groups * nodes)
            spot = rng.random(groups * nodes)
            slot = of * nodes + s_node
            x = sub[np.arange(len(row)), which[slot]]
            lo, hi = np.full(groups * nodes, np.inf), np.full(groups * nodes, -np.inf)
            np.minimum.at(lo, slot, x)
            np.maximum.at(hi, slot, x)
            held = np.bincount(slot, minlength=groups * nodes)
            split = held > 1
            lo[~split], hi[~split] = np.inf, np.inf
            cut = np.where(split, lo, 0) * (1 - spot) + np.where(split, hi, 0) * spot
            cut[~split] = np.inf
            at = seg * nodes + r_node
            done = ~split[at] & ~r_end
            length[done] = level
            r_end |= done
            mine = features[np.arange(n), which[at]]
            r_node = r_node * 2 + (mine > cut[at])
            s_node = s_node * 2 + (x > cut[slot])
        held = np.bincount(of * cells + s_node, minlength=groups * cells)
        left = ~r_end
        length[left] = rules.depth + _mean_depth(held[seg[left] * cells + r_node[left]])
        total += length
    norm = _mean_depth(np.minimum(size, rules.sample) + 1)[seg]
    score = np.where(norm > 0, 2.0 ** (-(total / rules.trees) / np.maximum(norm, 1e-9)), 0.5)
    return score[:rows], score[rows:]


def judge(key: np.ndarray, ts: np.ndarray, value: np.ndarray, kind: np.ndarray, dated: np.ndarray, rules: SpikeRules) -> dict[str, np.ndarray]:
    """Scores and flags of readings sorted by series and time; no value is NaN.

    ``kind`` numbers the parameters of ``rules.kinds()``, -1 being any other. The time of readings that
    are not ``dated`` is a guess: they take no part in runs, and must leave the level of the whole
    series as well to be a spike.
    """
    low, high, prior_abs, prior_rel, need = (np.array(x, float)[kind] for x in rules.by_kind())
    n = len(value)
    seg, first = _segments(key)
    groups = len(first)
    impossible = (value < low) | (value > high) | np.isin(value, rules.no_data) & ((np.abs(value) > 5000) | (value == -999.0) | (value == -999.9))

    # runs of exactly one value
    at = np.flatnonzero(dated)
    new_run = np.r_[True, (seg[at][1:] != seg[at][:-1]) | (value[at][1:] != value[at][:-1])] if len(at) else np.zeros(0, bool)
    run = np.cumsum(new_run) - 1
    run_size = np.ones(n, np.int64)
    run_size[at] = np.bincount(run)[run] if len(at) else 0
    in_series = np.bincount(seg[at], minlength=groups)
    sane = ~impossible
    vmin, vmax = np.full(groups, np.inf), np.full(groups, -np.inf)
    np.minimum.at(vmin, seg[sane], value[sane])
    np.maximum.at(vmax, seg[sane], value[sane])
    stuck = dated & (run_size >= rules.stuck) & (run_size < in_series[seg]) & (vmax > vmin)[seg] & sane

    # neighbourhoods see each (time, value) once and no impossible value
    same = np.r_[False, (seg[1:] == seg[:-1]) & (ts[1:] == ts[:-1]) & (value[1:] == value[:-1])]
    pick = np.flatnonzero(sane & ~same)
    s, v, t = seg[pick], value[pick], ts[pick]
    near = _around(v, s, rules.neighbours)
    level = _row_median(near)
    local = 1.4826 * _row_median(np.abs(near - level[:, None]))
    off = v - level
    loose = run_size[pick] < 4
    noise = 1.4826 * _medians(s[loose], np.abs(off[loose]), groups)
    held = np.bincount(s[loose], minlength=groups)
    overall = _medians(s, v, groups)
    prior = np.hypot(prior_abs[first], prior_rel[first] * np.abs(overall))
    noise = np.sqrt((held * np.nan_to_num(noise) ** 2 + rules.prior_weight * prior**2) / (held + rules.prior_weight))
    scale = np.fmax(np.fmax(local, 0.8 * noise[s]), 1e-9)
    with np.errstate(invalid="ignore", divide="ignore"):
        z_local = np.nan_to_num(np.abs(off) / scale)
        z_level = np.nan_to_num(np.abs(v - overall[s]) / np.fmax(noise[s], scale))
        step = np.fmin(np.abs(v - near[:, rules.neighbours - 1]), np.abs(v - near[:, rules.neighbours]))
        z_step = np.nan_to_num(step / scale)
        month = (t.astype("datetime64[s]").astype("datetime64[M]").astype(np.int64)) % 12
        season = _medians(s * 12 + month, v, groups * 12)
        z_season = np.nan_to_num(np.abs(v - season[s * 12 + month]) / scale)
    features = np.column_stack([np.log1p(z_level), np.log1p(z_local), np.log1p(z_step), np.log1p(z_season), np.log1p(run_size[pick].astype(float))])
    # few neighbours say little about the level: short series must be left further
    many = np.bincount(s, minlength=groups)
    sure = np.maximum(1.0, 2 * rules.neighbours / np.maximum(1, many - 1))
    share = np.array([1.0, 1.0, rules.probe_share, rules.probe_share])
    probe = np.column_stack([np.log1p((need[first] * sure)[:, None] * share), np.full(groups, np.log1p(1.0))])
    scored, probed = forest_scores(s, features, rules, probe)
    alone = scored >= probed[s] - rules.margin if len(s) and rules.use_forest else np.ones(len(s), bool)
    spread = 1.4826 * _medians(s, np.abs(v - overall[s]), groups)
    off_whole = np.abs(v - overall[s]) >= need[pick] * np.fmax(spread, noise)[s]
    candidate = alone & (z_local >= rules.veto * sure[s]) & (dated[pick] | off_whole)
    # at most a few readings in direct succession may leave the level together
    c_new = np.r_[True, (s[1:] != s[:-1]) | (candidate[1:] != candidate[:-1])] if len(s) else np.zeros(0, bool)
    c_run = np.cumsum(c_new) - 1
    brief = candidate & ((np.bincount(c_run) if len(c_run) else np.zeros(0, int))[c_run] <= rules.few)
    enough = many[s] >= 4

    spike, score, z = np.zeros(n, bool), np.ones(n), np.zeros(n)
    spike[pick], score[pick], z[pick] = brief & enough, scored, z_local
    copies = np.flatnonzero(same & sane)
    if len(copies):
        origin = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        spike[copies], score[copies], z[copies] = spike[origin[copies]], score[origin[copies]], z[origin[copies]]
    return {"score": score, "deviation": z, "is_spike": spike, "is_stuck": stuck, "is_impossible": impossible}


RESULT = "obs_id long, score double, deviation double, is_spike boolean, is_stuck boolean, is_impossible boolean"


def flag_readings(observations: DataFrame, rules: SpikeRules = SpikeRules(), rows_per_shard: int = 150_000) -> DataFrame:
    """Score and flag every reading of ``observations`` that has a value.

    Needs obs_id, source, id, parameter_name, parameter_value, date_measured, time_measured, received_at;
    other columns are ignored. Rows whose value is null or NaN give no row. Rows without a full date stand
    at the middle of their month, or else at received_at; they are never stuck. A series is one (source,
    id, parameter_name), nulls being a name of their own; it is named by a 64-bit hash inside the job.
    Repeated rows and ties in time are ordered by obs_id; each keeps its own row in the result. An empty
    table gives an empty result.
    """
    total = observations.select("obs_id").count()
    kinds = rules.kinds()
    kind = F.lit(-1)
    for i, name in enumerate(kinds):
        kind = F.when(F.col("parameter_name") == name, F.lit(i)).otherwise(kind)
    text = lambda c: F.coalesce(F.col(c), F.lit("\u0000"))
    valued = observations.where(F.col("parameter_value").isNotNull() & ~F.isnan("parameter_value")).select(
        F.col("obs_id").cast("long"),
        F.xxhash64(text("source"), text("id"), text("parameter_name")).alias("series"),
        epoch_seconds(F.col("date_measured"), F.col("time_measured")).alias("ts"),
        F.when(F.length(F.trim("date_measured")) == 7, F.unix_date(F.concat(F.trim("date_measured"), F.lit("-15")).try_cast("date")).cast("long") * 86400).alias("month"),
        F.unix_timestamp("received_at").alias("received"),
        F.col("parameter_value").alias("value"),
        kind.cast("tinyint").alias("kind"),
    )
    valued = valued.select("obs_id", "series", F.coalesce("ts", "month", "received", F.lit(0).cast("long")).alias("ts"), "value", "kind", F.col("ts").isNotNull().alias("dated"))

    def shard(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {c: rows[c].to_numpy() for c in ("series", "ts", "value", "kind", "dated", "_halo", "obs_id")}
        out = judge(col["series"], col["ts"], col["value"], col["kind"].astype(int), col["dated"].astype(bool), rules)
        own = col["_halo"] == OWN
        yield pa.RecordBatch.from_pydict({"obs_id": col["obs_id"][own], **{k: v[own] for k, v in out.items()}})

    return over_shards(valued, "series", ["ts", "obs_id"], shard, RESULT, total, rows_per_shard)


def found(observations: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """obs_id of the readings that are a spike, stuck or impossible."""
    return flag_readings(observations, rules).where("is_spike or is_stuck or is_impossible").select("obs_id")
