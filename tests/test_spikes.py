from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellframe.operators.spikes import SpikeRules, flag_readings, forest_scores, found, judge

SCHEMA = "obs_id long, source string, id string, parameter_name string, parameter_value double, date_measured string, time_measured string, received_at timestamp, ts string, value int"


def rows(values, start=1, source="S", well="W", parameter="waterlevels"):
    return [(start + i, source, well, parameter, v, str(date(2001, 1, 1) + timedelta(days=i)), None, None, "y", 1) for i, v in enumerate(values)]


def flagged(spark, data, **kw):
    return {r.obs_id for r in found(spark.createDataFrame(data, SCHEMA), **kw).collect()}


def noise(n, seed=1, level=100.0, scale=0.3):
    return [round(float(x), 2) for x in level + np.random.default_rng(seed).normal(0, scale, n)]


def test_spike_stuck_impossible(spark):
    v = noise(120)
    v[40], v[70], v[71] = 160.0, 61.0, 60.0
    assert flagged(spark, rows(v)) == {41, 71, 72}
    w = noise(120, 2)
    w[50:60] = [101.37] * 10
    assert flagged(spark, rows(w)) == set(range(51, 61))
    x = noise(60, 3)
    x[5], x[9] = -999999.0, 1e10
    assert flagged(spark, rows(x)) == {6, 10}


def test_changes_that_last_are_no_spikes(spark):
    step = noise(60, 4) + noise(60, 5, 110.0)
    assert flagged(spark, rows(step)) == set()
    rise = [100 + 6 * float(np.sin(i / 40 * np.pi)) + e - 100 for i, e in enumerate(noise(120, 6))]
    assert flagged(spark, rows(rise)) == set()
    assert flagged(spark, rows([-12.0 + x - 100 for x in noise(50, 7)])) == set()


def test_nulls_ties_undated_and_empty(spark):
    v = noise(40, 8)
    data = rows(v) + [(900, "S", "W", "waterlevels", None, "2001-01-01", None, None, "y", 1), (901, "S", "W", "waterlevels", float("nan"), "2001-01-01", None, None, "y", 1),
                      (902, "S", "W", "waterlevels", -999999.0, "2001-01", None, None, "y", 1), (903, None, None, None, 1.0, None, None, None, None, None)]
    data += [(1000 + r[0], *r[1:]) for r in rows(v)]
    assert flagged(spark, data) == {902}
    assert found(spark.createDataFrame([], SCHEMA)).count() == 0


def test_undated_readings(spark):
    v = noise(60, 11)
    data = rows(v) + [(900, "S", "W", "waterlevels", 1003.0, "2001-02", None, None, "y", 1), (901, "S", "W", "waterlevels", 100.2, None, None, None, "y", 1)]
    data += [(910 + i, "S", "W", "waterlevels", 100.1, "2001-02", None, None, "y", 1) for i in range(9)]
    assert flagged(spark, data) == {900}


def test_constant_series_is_not_stuck(spark):
    assert flagged(spark, rows([50.0] * 30)) == set()
    assert flagged(spark, rows([-1.0, 2.0, 2.1, 2.0], parameter="nitrate")) == {1}
    assert flagged(spark, rows([7.0, 7.1, 14.6, 7.0], parameter="ph")) == {3}


def test_shards_do_not_change_flags(spark):
    v = noise(1200, 9)
    v[300], v[599], v[600], v[900] = 150.0, 40.0, 41.0, 170.0
    v[795:806] = [100.11] * 11
    data = spark.createDataFrame(rows(v), SCHEMA)
    whole = {r.obs_id for r in flag_readings(data).where("is_spike or is_stuck").collect()}
    cut = {r.obs_id for r in flag_readings(data, rows_per_shard=300).where("is_spike or is_stuck").collect()}
    assert whole == cut == {301, 600, 601, 901, *range(796, 807)}


def test_the_forest_decides():
    """Without the forest, ordinary readings of heavy-tailed series pass the veto; with it, the planted spikes stay and most others go."""
    rng = np.random.default_rng(5)
    series, per = 40, 300
    key, ts = np.repeat(np.arange(series), per), np.tile(np.arange(per) * 86400, series)
    value = 100 + np.clip(rng.standard_t(3, series * per), -7, 7)
    planted = rng.choice(series * per, 120, replace=False)
    value[planted] += rng.choice([-1, 1], 120) * rng.uniform(30, 80, 120)
    truth = np.zeros(series * per, bool)
    truth[planted] = True
    flags = {use: judge(key, ts, value, np.zeros(len(key), int), np.ones(len(key), bool), SpikeRules(use_forest=use))["is_spike"] for use in (True, False)}
    precision = {use: (f & truth).sum() / f.sum() for use, f in flags.items()}
    recall = {use: (f & truth).sum() / truth.sum() for use, f in flags.items()}
    assert precision[True] > precision[False] + 0.02 and recall[True] >= recall[False] - 0.03, (precision, recall)


def test_forest_ranks_outliers():
    x = np.random.default_rng(1).normal(0, 1, (500, 3))
    x[7] = 9
    s, probe = forest_scores(np.zeros(500, int), x, SpikeRules(), np.full((1, 3), 4.0))
    assert s[7] == s.max() and s[7] > 0.6 and np.median(s) < 0.5
    assert s[7] > probe[0] > np.median(s)


def test_every_reading_is_scored(spark, sf):
    t = spark.read.parquet(f"{sf}/observations.parquet")
    valued = t.where(F.col("parameter_value").isNotNull() & ~F.isnan("parameter_value")).count()
    assert flag_readings(t).count() == pytest.approx(valued)
