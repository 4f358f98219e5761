"""Quantities recorded in different units, brought to one unit per parameter.

The unit a row states is read from any of its texts. Where texts contradict one another, are misspelt so
that several units are near, or state none, the series' history decides: an exact penalised changepoint
search on the logarithms of its values cuts it into segments, and a segment whose level differs from the
series' converted level by a known factor is in the unit of that factor. Where the history cannot tell
two factors apart, the row is marked undecided. Stated units are held against the history as well, by the
same search, also where every row of a series states its unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.datetimes import epoch_seconds
from ..functions.unit_text import BASES, SPELLINGS, near_units, read_name, read_note, read_unit, read_value
from .halo import OWN, over_shards

ORIGINS = STATED, CONTESTED, CHANGEPOINT, ASSUMED, UNDECIDED = "stated", "contested", "changepoint", "assumed", "undecided"
TEXTS = ["source_parameter_units", "value_text", "source_parameter_name", "qualifier"]
UNITS, BASIS = list(SPELLINGS), [None, *BASES]
MOST_CANDIDATES = 6


def changepoints(x: np.ndarray, penalty: float) -> np.ndarray:
    """First positions of the segments that minimise squared error plus ``penalty`` per segment (exact, pruned)."""
    n = len(x)
    s1, s2 = np.r_[0.0, np.cumsum(x)], np.r_[0.0, np.cumsum(x * x)]
    best, last = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
    best[0] = -penalty
    live = np.zeros(1, np.int64)
    for t in range(1, n + 1):
        cost = best[live] + s2[t] - s2[live] - (s1[t] - s1[live]) ** 2 / (t - live)
        i = int(np.argmin(cost))
        best[t], last[t] = cost[i] + penalty, live[i]
        live = np.r_[live[cost <= best[t]], t]
    starts = []
    while n > 0:
        n = int(last[n])
        starts.append(n)
    return np.array(starts[::-1], np.int64)


def segment_starts(x: np.ndarray, cuts: np.ndarray, penalty: float, longest: int = 500, cells: int = 250_000) -> np.ndarray:
    """True at the first value of each segment of every series of ``x`` (those between ``cuts``).

    The segments are those of ``changepoints``; series of like length are searched together, those of more
    than ``longest`` values one by one.
    """
    begin, n = cuts[:-1], np.diff(cuts)
    out = np.zeros(len(x), bool)
    for i in np.flatnonzero(n > longest):
        out[begin[i] + changepoints(x[begin[i] : begin[i] + n[i]], penalty)] = True
    order = np.argsort(-n, kind="stable")
    order = order[(n[order] > 0) & (n[order] <= longest)]
    while len(order):
        width = int(n[order[0]])
        batch, order = np.split(order, [max(1, cells // (width + 1))])
        own, size, every = begin[batch], n[batch], np.arange(len(batch))
        step = np.arange(width)[:, None]
        v = np.where(step < size, x[np.minimum(own + step, len(x) - 1)], 0.0)
        zero = np.zeros((1, len(batch)))
        s1, s2 = np.r_[zero, np.cumsum(v, axis=0)], np.r_[zero, np.cumsum(v * v, axis=0)]
        best, last = np.full(s1.shape, -penalty), np.zeros(s1.shape, np.int64)
        for t in range(1, width + 1):
            k = int(np.searchsorted(-size, -t, side="right"))
            cost = best[:t, :k] + s2[t, :k] - s2[:t, :k] - (s1[t, :k] - s1[:t, :k]) ** 2 / (t - np.arange(t))[:, None]
            at = np.argmin(cost, axis=0)
            best[t, :k], last[t, :k] = cost[at, every[:k]] + penalty, at
        while len(own):
            size = last[size, every]
            out[own + size] = True
            left = size > 0
            own, size, every = own[left], size[left], every[left]
    return out


def _medians(x: np.ndarray, group: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Median of ``x`` per group; ``counts`` are the groups' sizes, none of them 0."""
    ordered, first = x[np.lexsort((x, group))], np.cumsum(counts) - counts
    return (ordered[first + (counts - 1) // 2] + ordered[first + counts // 2]) / 2


def units_of_series(value: np.ndarray, param: np.ndarray, choices: np.ndarray, cuts: np.ndarray, tables: _Tables, penalty: float, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit, origin (place in ``ORIGINS``) and agreement of each reading of many series, each in time order between ``cuts``.

    ``choices`` holds, per reading, the places in its parameter's units of those its texts may mean, -1
    after the last. A reading with one choice has stated it. Every series that knows at least two converted
    values, the level that others are held against, is cut into segments, whether or not all its readings
    state a unit. Agreement is 1 if no other factor brings the readings of the segment that state this unit
    nearer to the series' level, 0 if one does, -1 where nothing can be said.
    """
    stated = np.where(choices[:, 1] < 0, choices[:, 0], -1)
    commons = np.array([*tables.own, 0])
    unit = np.where((choices[:, 0] < 0) & (param >= 0), commons[param], choices[:, 0])
    origin, agrees = np.where(stated >= 0, 0, np.where(choices[:, 0] >= 0, 1, 3)), np.full(len(value), -1)
    series = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    usable = np.flatnonzero(np.isfinite(value) & (value > 0) & (param >= 0))
    own = np.full(len(usable), np.nan)
    named = stated[usable] >= 0
    own[named] = np.log(tables.flat[tables.first[param[usable[named]]] + stated[usable[named]]])
    told = np.bincount(series[usable[~np.isnan(own)]], minlength=len(cuts) - 1)
    telling = told[series[usable]] >= 2
    usable, own = usable[telling], own[telling]
    if not len(usable):
        return unit, origin, agrees
    logs, kind = np.log(value[usable]), param[usable]
    _, first, of, size = np.unique(series[usable], return_index=True, return_inverse=True, return_counts=True)
    known = np.flatnonzero(~np.isnan(own))
    n_known = np.bincount(of[known])
    converted = logs[known] + own[known]
    level = _medians(converted, of[known], n_known)
    spread = np.maximum(0.05, 1.4826 * _medians(np.abs(converted - level[of[known]]), of[known], n_known))
    segment = np.cumsum(segment_starts(logs, np.r_[first, len(logs)], penalty)) - 1

    # stated units: the readings of a segment that state one unit, against all factors of the parameter
    key = segment[known] * (stated.max() + 1) + stated[usable[known]]
    _, one, group, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    mean = np.bincount(group, logs[known]) / count
    at = of[known[one]]
    error = spread[at] * np.sqrt(1 / count + 1 / n_known[at])
    best = np.abs(mean[:, None] + tables.shifts[kind[known[one]]] - level[at, None]).min(axis=1)
    agrees[usable[known]] = (np.abs(mean + own[known[one]] - level[at]) <= best + 2 * error + 1e-9)[group]

    # readings whose texts leave the unit open: the level of their segment
    open_rows = np.flatnonzero(stated[usable] < 0)
    for part in np.split(open_rows, np.flatnonzero(np.diff(segment[open_rows])) + 1) if len(open_rows) else []:
        a, b = np.searchsorted(segment, [segment[part[0]], segment[part[0]] + 1])
        s, p = of[a], kind[a]
        shifts, factors, common = tables.shifts[p][np.isfinite(tables.shifts[p])], tables.factors[p], tables.own[p]
        error = spread[s] * np.sqrt(1 / (b - a) + 1 / n_known[s])
        mean = logs[a:b].mean()
        away = np.abs(mean + shifts - level[s])
        best = float(away.min())
        # levels of natural series wander; a factor is told from the next one by more than the segment's error
        rivals = away[away > best + 1e-9]
        clear = best <= tolerance + 3 * error and (not len(rivals) or rivals.min() - best > 2 * error)
        right = shifts[int(np.argmin(away))]
        for i in usable[part]:
            picks = choices[i][choices[i] >= 0]
            if len(picks):
                shift = np.abs(mean + np.log(factors[picks]) - level[s])
                shift = np.where(np.isnan(shift), np.inf, shift)
                order = np.argsort(shift, kind="stable")
                apart = shift[order[1]] - shift[order[0]]
                if apart > 2 * error and not np.isclose(factors[picks[order[0]]], factors[picks[0]]):
                    unit[i] = picks[order[0]]
            elif not clear:
                origin[i] = 4
            elif abs(right - np.log(factors[common])) > 1e-6:
                unit[i] = np.flatnonzero(np.abs(np.log(np.where(np.isnan(factors), 1e300, factors)) - right) <= 1e-6)[0]
                origin[i] = 2
    return unit, origin, agrees


class _Tables:
    """Per parameter its units, factors and common unit, and for every (unit, basis) the unit's place."""

    def __init__(self, listed: list):
        self.units: list[list[str]] = []
        self.factors: list[np.ndarray] = []
        self.common: list[str] = []
        self.params: dict[str, int] = {}
        for r in sorted(listed, key=lambda r: (r["parameter_name"] or "", r["unit"] or "")):
            p = self.params.setdefault(r["parameter_name"], len(self.params))
            if p == len(self.units):
                self.units.append([])
                self.factors.append(np.zeros(0))
                self.common.append(r["common_unit"])
            self.units[p].append(r["unit"])
            self.factors[p] = np.r_[self.factors[p], np.nan if r["factor"] is None else r["factor"]]
        self.place = np.full((len(self.units) + 1, len(UNITS) + 1, len(BASIS)), -1, np.int64)
        for p, units in enumerate(self.units):
            at = {u: i for i, u in enumerate(units)}
            for u, unit in enumerate(UNITS):
                for k, basis in enumerate(BASIS):
                    self.place[p, u, k] = at.get(f"{unit} as {basis}", at.get(unit, -1)) if basis else at.get(unit, -1)
        self.own = [units.index(c) if c in units else 0 for units, c in zip(self.units, self.common)]
        # one flat list of all parameters' factors, and each parameter's distinct ones as logarithms
        self.first = np.cumsum([0, *map(len, self.units)])
        self.flat = np.r_[np.concatenate(self.factors) if self.factors else np.zeros(0), np.nan]
        logs = [np.unique(np.round(np.log(f[~np.isnan(f)]), 9)) for f in self.factors]
        self.shifts = np.full((len(logs), max([1, *map(len, logs)])), np.inf)
        for p, x in enumerate(logs):
            self.shifts[p, : len(x)] = x


def _codes(column: pa.ChunkedArray, read) -> list[np.ndarray]:
    """``read`` (a tuple of numbers) of every text of a column, once per distinct text."""
    codes = column.combine_chunks().dictionary_encode()
    got = [read(t) for t in codes.dictionary.to_pylist()]
    got.append(read(None))
    index = codes.indices.fill_null(len(got) - 1).to_numpy()
    return [np.array(c)[index] for c in zip(*got)]


def read_rows(rows: pa.Table, tables: _Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value, parameter and choices of units of each row; each distinct text is read once."""
    unit_code = {u: i for i, u in enumerate(UNITS)}
    code = lambda got: (unit_code.get(got[0], -1), BASIS.index(got[1]))
    value = rows["value"].to_numpy().astype(float)
    # plain numbers state no unit and are read already
    text = rows["value_text"].combine_chunks()
    plain = pc.fill_null(pc.match_substring_regex(text, r"^[0-9]+\.?[0-9]*$|^$"), True)
    text = pc.if_else(plain, pa.scalar(None, text.type), text)
    number, v_unit, v_basis = _codes(pa.chunked_array([text]), lambda t: ((lambda n, u, b: (np.nan if n is None else n, *code((u, b))))(*read_value(t))))
    fields = [_codes(rows["source_parameter_units"], lambda t: code(read_unit(t))), [v_unit, v_basis], _codes(rows["source_parameter_name"], lambda t: code(read_name(t))), _codes(rows["qualifier"], lambda t: code(read_note(t)))]
    value = np.where(np.isnan(value), number, value)
    names = rows["parameter_name"].combine_chunks().dictionary_encode()
    of = np.array([*(tables.params.get(t, -1) for t in names.dictionary.to_pylist()), -1])
    param = of[names.indices.fill_null(len(of) - 1).to_numpy()]
    units, bases = np.column_stack([u for u, _ in fields]), np.column_stack([b for _, b in fields])
    every = np.arange(len(value))
    basis = bases[every, np.argmax(bases > 0, axis=1)]
    choices = np.full((len(value), MOST_CANDIDATES), -1, np.int64)
    stated = np.where(units >= 0, tables.place[param[:, None], units, basis[:, None]], -1)
    # a misspelt unit may mean any that is near, if no text of the row says more
    blank = (units < 0).all(axis=1)
    near = _codes(rows["source_parameter_units"], lambda t: tuple([unit_code[u] for u in near_units(t)][:MOST_CANDIDATES] + [-1] * MOST_CANDIDATES)[:MOST_CANDIDATES])
    guess = np.column_stack(near)
    guess = np.where((guess >= 0) & blank[:, None], tables.place[param[:, None], guess, basis[:, None]], -1)
    filled = np.zeros(len(value), np.int64)
    for column in [*stated.T, *guess.T]:
        new = (column >= 0) & ~(choices == column[:, None]).any(axis=1) & (filled < MOST_CANDIDATES)
        choices[every[new], filled[new]] = column[new]
        filled += new
    return value, param, choices


def common_units(results: DataFrame, unit_names: DataFrame, penalty: float = 0.5, tolerance: float = 0.7, most_units: int = 10_000, rows_per_shard: int = 20_000) -> DataFrame:
    """Each result with the unit it is in and its value in its parameter's common unit.

    Columns: result_id, parameter_name, stated_unit (as written in ``unit_names.unit``, or null),
    unit, unit_origin (stated; contested: several units may be stated, the
    series decides, the first one stands where it cannot; changepoint: none
    stated, the series decided; assumed: none stated, the level is that of the common unit; undecided: the
    series cannot tell), agrees (whether the series bears the unit out, null where it cannot say),
    common_unit, value (null without a usable number), common_value (null if it cannot be converted),
    convertible.

    Needs the columns of lab_results; others are ignored. ``unit_names`` is checked to hold at most
    ``most_units`` rows before it goes to every task. Parameters it does not list keep their value and
    are marked not convertible. A unit not listed for the parameter counts as none stated; with a basis
    (as N) that is not listed, the unit without it does. Rows without a date are ordered by
    received_at; repeated rows each keep a row; rows with a null result_id too. Empty tables give an
    empty result. Series of any length are cut into time shards, each segmented by itself; texts are
    read once per shard and distinct text.
    """
    total = results.select("result_id").count()
    listed = unit_names.select("parameter_name", "unit", "common_unit", "factor").limit(most_units + 1).collect()
    if len(listed) > most_units:
        raise ValueError(f"unit_names has more than {most_units} rows")
    shared = results.sparkSession.sparkContext.broadcast(_Tables(listed))

    def shard(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        value, param, choices = read_rows(rows, tables)
        series = rows["series"].to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(series)) + 1, len(series)]
        first, factors = tables.first, tables.flat
        unit, origin, agrees = units_of_series(value, param, choices, cuts, tables, penalty, tolerance)
        own = np.flatnonzero(rows["_halo"].to_numpy() == OWN)
        p, u, v, o = param[own], unit[own], value[own], origin[own]
        names = pa.array([x for units in tables.units for x in units] or [None], pa.string())
        at = np.where((p >= 0) & (u >= 0), first[p] + u, len(factors) - 1)
        factor = factors[at]
        word = lambda index, ok: names.take(pa.array(np.where(ok, index, 0), mask=~ok))
        listed = (p >= 0) & (u >= 0)
        converted = v * factor
        common = pa.array([*tables.common, None], pa.string()).take(pa.array(np.where(p >= 0, p, len(tables.common))))
        take = pa.array(own)
        yield pa.RecordBatch.from_arrays(
            [rows["result_id"].take(take).combine_chunks(), rows["parameter_name"].take(take).combine_chunks(), word(at, listed & (o <= 1)), word(at, listed), pa.array(ORIGINS).take(pa.array(o)), pa.array(agrees[own] == 1, mask=agrees[own] < 0), common,
             pa.array(v, mask=~np.isfinite(v)), pa.array(converted, mask=~np.isfinite(converted)), pa.array(~np.isnan(factor))],
            ["result_id", "parameter_name", "stated_unit", "unit", "unit_origin", "agrees", "common_unit", "value", "common_value", "convertible"],
        )

    text = lambda c: F.coalesce(F.col(c), F.lit("\u0000"))
    ts = F.coalesce(epoch_seconds(F.col("date_measured"), F.col("time_measured")), F.unix_timestamp("received_at"), F.lit(0))
    landed = results.select(
        F.col("result_id").cast("long"), F.xxhash64(text("source"), text("id"), text("parameter_name")).alias("series"), ts.cast("long").alias("ts"), F.col("parameter_value").cast("double").alias("value"), "parameter_name",
        *[F.col(c) for c in TEXTS],
    )
    kinds = "result_id long, parameter_name string, stated_unit string, unit string, unit_origin string, agrees boolean, common_unit string, value double, common_value double, convertible boolean"
    return over_shards(landed, "series", ["ts", "result_id"], shard, kinds, total, rows_per_shard, halo=500)


def found(results: DataFrame, unit_names: DataFrame) -> DataFrame:
    """(result_id, unit) of the rows that state a unit other than their parameter's common unit.

    Where a row's texts leave several units open, it is the one the series' segments bear out, the first
    stated where they cannot say.
    """
    rows = common_units(results, unit_names).where("stated_unit <> common_unit")
    return rows.select("result_id", F.col("stated_unit").alias("unit"))
