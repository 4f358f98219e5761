import numpy as np

from test_nearby_grid_units import by_id, lab
from wellframe.operators import unit_repair
from wellframe.operators.unit_repair import changepoints


def dated(rows):
    return [(*r[:9], str(np.datetime64("1990-01-01") + int(r[0]) * 7), *r[10:]) for r in rows]


def test_segments_are_searched_where_every_row_states_its_unit(spark):
    """A stretch whose level is 1000 times the series' is not borne out, though all its rows state the series' unit."""
    rng = np.random.default_rng(4)
    wrong = range(20, 30)
    data = [lab(i, (2000.0 if i in wrong else 2.0) * float(np.exp(rng.normal(0, 0.1)))) for i in range(40)]
    got = by_id(spark, dated(data))
    assert {r.unit_origin for r in got.values()} == {"stated"} and {r.unit for r in got.values()} == {"mg/L"}
    assert {i for i, r in got.items() if r.agrees is False} == set(wrong) and all(got[i].agrees for i in got if i not in wrong)
    blunt = by_id(spark, dated(data), penalty=1e9)
    assert {r.agrees for r in blunt.values()} == {True}


def test_units_stated_in_turns_within_a_segment_agree(spark):
    """Two units whose factors are near share a segment; each is held against the level by its own readings."""
    rng = np.random.default_rng(6)
    close = [("bicarbonate", "mg/L", "mg/L", 1.0), ("bicarbonate", "mg/L as CaCO3", "mg/L", 1.22)]
    other = set(range(5, 200, 10))
    data = [lab(i, 200.0 * float(np.exp(rng.normal(0, 0.02))) / (1.22 if i in other else 1.0), "mg/L as CaCO3" if i in other else "mg/L", parameter="bicarbonate", name="Bicarbonate") for i in range(200)]
    got = by_id(spark, dated(data), close)
    assert {got[i].unit for i in other} == {"mg/L as CaCO3"} and all(r.agrees for r in got.values())


def test_series_searched_together_and_alone_are_cut_alike():
    rng = np.random.default_rng(9)
    sizes = [1, 2, 3, 0, 7, 40, 40, 120, 1, 61]
    x = np.concatenate([np.repeat(rng.normal(0, 2, n), rng.integers(1, 9, n))[:n] + rng.normal(0, 0.2, n) for n in sizes])
    cuts = np.r_[0, np.cumsum(sizes)]
    want = np.concatenate([a + changepoints(x[a:b], 0.5) for a, b in zip(cuts[:-1], cuts[1:])])
    for kw in ({}, {"longest": 50}, {"cells": 100}):
        assert np.array_equal(np.flatnonzero(unit_repair.segment_starts(x, cuts, 0.5, **kw)), want)
