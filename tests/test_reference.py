import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellframe.functions import columns as C
from wellframe.operators.components import smallest_labels
from wellframe.plans import catalog
from wellframe.products import chemistry, correlation, series
from wellframe.sources import paged, providers, sinks
from wellframe.streaming import daily


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr.alias("x")).first().x


@pytest.mark.parametrize("text, day, time", [("2024-01-15T08:30:00", "2024-01-15", "08:30:00"), ("2024-01-15T08:30:00.123Z", "2024-01-15", "08:30:00"), ("2024-01-15T00:00:00Z", "2024-01-15", ""), ("2024/01/15", "2024-01-15", ""), ("01/15/2024", "2024-01-15", ""),
                                             ("2024-01", "2024-01", ""), ("45000", "2023-03-17", ""), ("2024-02-30", None, ""), ("not-a-date", None, ""), ("2024-01-15 08:30", "2024-01-15", "08:30:00"), ("2024", "1905-07-18", "")])
def test_dates(spark, text, day, time):
    assert one(spark, C.standard_date(F.col("d")), d=text) == day
    assert one(spark, C.standard_time(F.col("d")), d=text) == time


@pytest.mark.parametrize("p, u, o, s, factor", [("ph", "anything", "", "x", 1.0), ("bicarbonate", "mg/L CaCO3", "mg/L", "x", 1.22), ("calcium", "mg/l caco3**", "mg/L", "x", 0.4), ("sodium", "mg/l caco3", "mg/L", "x", None), ("nitrate", "mg/l as N", "mg/L", "x", 4.427),
                                                ("nitrate", "mg/L", "mg/L", "Nitrate as N", 4.427), ("uranium", "pCi/L", "mg/L", "x", 0.00149), ("tds", "tons/ac ft", "mg/L", "x", 735.47), ("arsenic", "ug/L", "mg/L", "x", 0.001), ("conductivity", "uS/cm @25C", "uS/cm", "x", 1.0),
                                                ("waterlevels", "m", "ft", "x", 3.28084), ("waterlevels", "feet", "m", "x", 0.3048), ("tds", "furlong", "mg/L", "x", None)])
def test_factors(spark, p, u, o, s, factor):
    assert one(spark, C.conversion_factor(*map(F.col, "puos")), p=p, u=u, o=o, s=s) == factor


def test_values_and_status(spark):
    assert one(spark, C.coerce_value(F.col("v")), v="ND") == 0.0 and one(spark, C.coerce_value(F.col("v")), v="lost") is None and one(spark, C.coerce_value(F.col("v")), v=" 2.5 ") == 2.5 and one(spark, C.coerce_value(F.col("v")), v="1d") is None
    for raw, want in [("Approved", "approved"), ("Provisional; estimated", "provisional"), ("true", "approved"), ("false", "provisional"), ("", "unknown"), ("provisional, approved later", "provisional"), ("odd", "unknown")]:
        assert one(spark, C.approval_status(F.col("v")), v=raw) == want
    for v, want in [(999.0, "fresh"), (1000.0, "brackish"), (9999.0, "brackish"), (10000.0, "saline"), (34999.0, "saline"), (35000.0, "brine")]:
        assert one(spark, C.tds_class(F.col("v")), v=v) == want


def test_keys_and_places(spark):
    assert sorted(one(spark, C.match_keys(F.col("v")), v="USGS-08313000")) == ["08313000", "USGS-08313000"] and one(spark, C.match_keys(F.col("v")), v="  abc123 ") == ["ABC123"] and one(spark, C.match_keys(F.col("v")), v="") == []
    assert one(spark, C.references(F.col("v")), v="a, b; c|d/e") == ["a", "b", "c", "d", "e"]
    assert one(spark, C.station_keys(F.col("v")), v="at 330519 104134001") == ["330519104134001"] and one(spark, C.station_keys(F.col("v")), v="08313000") == []
    assert abs(one(spark, C.haversine(*map(F.col, "abcd")), a=34.0, b=-106.0, c=35.0, d=-106.0) - 111195) < 500
    lon, lat = C.to_wgs84(F.col("x"), F.col("y"), F.col("d"))
    assert one(spark, lon, x=-106.5, y=34.0, d="NAD27") == pytest.approx(-106.5006, abs=1e-3) and one(spark, lat, x=-106.5, y=34.0, d="NAD27") == pytest.approx(34.0001, abs=1e-3) and one(spark, lat, x=-106.5, y=34.0, d="NAD83") == 34.0


OBS = "source string, id string, parameter_name string, value double, ts long, day date, obs_id long"


def yearly(spark, values, parameter="waterlevels", start=2010):
    import datetime as dt

    rows = [("S", "W", parameter, float(v), int(dt.datetime(start + i, 6, 1, tzinfo=dt.timezone.utc).timestamp()), dt.date(start + i, 6, 1), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, OBS)


@pytest.mark.parametrize("values, category, slope", [([50 + 0.5 * i for i in range(12)], "increasing", 0.5), ([50] * 12, "stable", 0.0), ([50, 51, 52], "not enough data", None), ([50 - i for i in range(5)], "decreasing", -1.0)])
def test_trends(spark, values, category, slope):
    r = series.trends(yearly(spark, values), "min").first()
    assert r.trend_category == category and r.slope_per_year == (slope if slope is None else pytest.approx(slope))


def test_long_series_statistics():
    rng = np.random.default_rng(1)
    x, y = np.sort(rng.choice(100_000, 1600, replace=False)).astype(float), rng.normal(0, 1, 1600).round(2)
    i, j = np.triu_indices(1600, 1)
    s, m = series.pair_statistics(x, y)
    assert s == int(np.sign(y[j] - y[i]).sum()) and m == pytest.approx(float(np.median((y[j] - y[i]) / (x[j] - x[i]))), rel=1e-12)
    assert series.pair_statistics(x[:80], y[:80], direct=10)[1] == pytest.approx(series.pair_statistics(x[:80], y[:80])[1], rel=1e-12)


def test_change_and_normal_tail(spark):
    r = series.change(yearly(spark, [50 + i for i in range(11)])).first()
    assert (r.dtw_end, r.dtw_start, r.change_ft, r.direction, r.n_observations_in_window, r.status) == (60.0, 55.0, 5.0, "declining", 6, "ok")
    assert C.normal_tail(1.959963984540054) == pytest.approx(0.05)


def test_quality_index(spark):
    parts = [yearly(spark, [v], p) for p, v in (("arsenic", 0.011), ("nitrate", 2.0), ("fluoride", 1.0))]
    r = chemistry.quality_index(parts[0].unionAll(parts[1]).unionAll(parts[2])).first()
    assert 70 < r.wqi < 75 and r.wqi_class == "fair" and r.n_exceeding == 1
    assert chemistry.quality_index(parts[1]).first().wqi_class == "excellent"


def test_crosswalk_ignores_row_order(spark):
    schema = "site_uid long, source string, id string, name string, latitude double, longitude double, elevation double, elevation_units string, well_depth double, well_depth_units string, usgs_site_id string, alternate_site_id string"
    rows = [(1, "NMBGMR", "W1", "A well", 34.0, -106.0, None, None, 100.0, "ft", "08313000", None), (2, "USGS-NWIS", "USGS-08313000", "B", 34.5, -106.0, None, None, None, None, None, None), (3, "ST2/X", "9", "A well", 34.0003, -106.0, None, None, 110.0, "ft", None, None),
            (4, "ST2/Y", "8", "A well", 34.0003, -106.0001, None, None, 300.0, "ft", None, None)]
    a = {tuple(r) for r in correlation.crosswalk(spark.createDataFrame(rows, schema)).collect()}
    b = {tuple(r) for r in correlation.crosswalk(spark.createDataFrame(rows[::-1], schema).repartition(3)).collect()}
    assert a == b and {(r[1], r[13], r[14]) for r in a} == {("NMBGMR", "mixed", 0.95), ("USGS-NWIS", "mixed", 0.95), ("ST2/X", "mixed", 0.95), ("ST2/Y", "unmatched", 0.0)}


def test_crosswalk_members_and_points_of_diversion(spark):
    import hashlib

    schema = "site_uid long, source string, id string, name string, latitude double, longitude double, elevation double, elevation_units string, well_depth double, well_depth_units string, usgs_site_id string, alternate_site_id string"
    blank = (None, None, None, None)
    rows = [
        (1, "A", "a1", None, 34.0, -106.0, *blank, None, "b1 LV-1"), (2, "B", "b1", None, 36.0, -106.0, *blank, None, None), (3, "NMOSEPOD", "LV-1", None, 33.0, -105.0, *blank, None, None), (4, "C", "c1", None, 35.0, -106.0, *blank, None, None),
        (5, "NMOSEPOD", "LV-3", None, 35.0009, -106.0, *blank, None, None), (6, "NMOSEPOD", "LV-2", None, 35.0009, -106.0, *blank, None, None), (7, "D", "d1", "Well 364643 108143801", None, None, *blank, None, None), (8, "E", "USGS-364643108143801", None, None, None, *blank, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.site_key: r for r in correlation.crosswalk(df).collect()}
    a = got["A:a1"]
    assert (a.linked_site_ids, a.linked_by_agency, a.ose_pod_ids, a.ose_pod_link_method, a.n_linked) == ("B:b1,NMOSEPOD:LV-1", '{"B": ["b1"], "NMOSEPOD": ["LV-1"]}', "LV-1", "explicit", 2)
    assert a.cluster_id == "wc_" + hashlib.sha1(b"A:a1|B:b1|NMOSEPOD:LV-1").hexdigest()[:12]
    assert got["NMOSEPOD:LV-1"].ose_pod_link_method == "none" and got["NMOSEPOD:LV-1"].is_ose_pod
    assert got["D:d1"].cluster_id == got["E:USGS-364643108143801"].cluster_id and got["D:d1"].match_method == "explicit"
    c = got["C:c1"]
    assert {c.match_method, got["NMOSEPOD:LV-2"].match_method} == {"spatial"} and c.ose_pod_link_method == "explicit" and c.ose_pod_ids == "LV-2"
    big = {r.site_key: r for r in correlation.crosswalk(df, most_listed=2).collect()}
    assert big["A:a1"].linked_site_ids is None and big["A:a1"].cluster_id == big["B:b1"].cluster_id != a.cluster_id and big["A:a1"].n_linked == 2
    deep = df.withColumn("well_depth", F.when(F.col("source") == "C", 500.0).when(F.col("source") == "NMOSEPOD", 10.0)).withColumn("well_depth_units", F.lit("ft"))
    lone = {r.site_key: r for r in correlation.crosswalk(deep).collect()}["C:c1"]
    assert (lone.match_method, lone.ose_pod_ids, lone.ose_pod_link_method) == ("unmatched", "LV-2", "spatial")


def test_crosswalk_lists_groups_of_any_size(spark):
    """A group of 1,101 wells: every other member in every row, and the digest of all sorted keys, as in SQL."""
    import hashlib

    schema = "site_uid long, source string, id string, name string, latitude double, longitude double, elevation double, elevation_units string, well_depth double, well_depth_units string, usgs_site_id string, alternate_site_id string"
    rows = [(i, "A", f"a{i}", None, None, None, None, None, None, None, None, "HUB1") for i in range(1, 1101)] + [(2000, "NMOSEPOD", "HUB1", *[None] * 9)]
    got = {r.site_key: r for r in correlation.crosswalk(spark.createDataFrame(rows, schema)).collect()}
    keys = sorted([f"A:a{i}" for i in range(1, 1101)] + ["NMOSEPOD:HUB1"])
    assert sorted(got) == keys and {r.cluster_id for r in got.values()} == {"wc_" + hashlib.sha1("|".join(keys).encode()).hexdigest()[:12]}
    assert all(r.linked_site_ids == ",".join(k for k in keys if k != r.site_key) for r in got.values())
    assert got["A:a7"].ose_pod_ids == "HUB1" and got["A:a7"].ose_pod_link_method == "explicit" and got["A:a7"].linked_by_agency.endswith('], "NMOSEPOD": ["HUB1"]}')


def test_chain_labels(spark):
    e = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(70)] + [("x", "y"), (None, "z")], "a string, b string")
    got = {r.node: r.root for r in smallest_labels(e).collect()}
    assert got == {**{f"n{i:03d}": "n000" for i in range(71)}, "x": "x", "y": "x"}


def test_catalog_and_requests(spark, sf):
    products = catalog.load()
    tables = catalog.Tables(spark, sf)
    for p in products[:1] + [p for p in products if p.output_type in ("hardness", "monitoring_recency", "well_density")]:
        assert catalog.build(tables, p).count() > 0
    for bad in (catalog.Request(parameter="gold"), catalog.Request(bbox="1 2,3 4", county="A"), catalog.Request(start="soon"), catalog.Request(bbox="1 2 3"), catalog.Request(county="B")):
        with pytest.raises(ValueError):
            bad.validate(["A"])
    assert catalog.parse_box("-105 34, -106 33") == (-106.0, 33.0, -105.0, 34.0)


def test_provider_files(spark, tmp_path):
    (tmp_path / "n.json").write_text(json.dumps({"features": [{"properties": {"monitoring_location_id": "USGS-1", "monitoring_location_name": "a", "altitude": "x"}, "geometry": {"coordinates": [-106.0, 34.0]}}] * 3}))
    raw = providers.read_json(spark, str(tmp_path / "n.json"), providers.PROVIDERS["nwis"].site_schema, "features")
    assert [(r.id, r.latitude, r.elevation) for r in providers.sites("nwis", raw).collect()] == [("USGS-1", 34.0, None)]
    head = "MonitoringLocationIdentifier\tCharacteristicName\tResultMeasureValue\tResultMeasure/MeasureUnitCode\tActivityStartDate\tActivityStartTime/Time\tActivityIdentifier\tUSGSPCode\tResultTemperatureBasisText\tResultStatusIdentifier\tMeasureQualifierCode"
    (tmp_path / "w.tsv").write_text(head + '\nW-1\tNitrate\t2.5\tmg/l\t2020-01-01\t\t1\t\t\tAccepted\t"\nW-1\tNitrate\t\tmg/l\t2020-01-02\t\t1\t\t\t\t\n\n')
    rows = providers.readings("wqp", providers.read_tsv(spark, str(tmp_path / "w.tsv"), providers.PROVIDERS["wqp"].reading_schema), "nitrate").collect()
    assert [(r.source, r.id, r.parameter_value, r.parameter_name) for r in rows] == [("WQP", "W-1", 2.5, "nitrate")]
    for name, p in providers.PROVIDERS.items():
        for kind, schema in (("sites", p.site_schema), ("readings", p.reading_schema)):
            if schema:
                assert getattr(providers, kind)(name, spark.createDataFrame([], schema)).count() == 0


def test_paged_source(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"value": [{"a": i}, {"a": 10 + i}]}))
    spark.dataSource.register(paged.PagedJson)
    got = spark.read.format("paged_json").options(url=f"file://{tmp_path}/p{{page}}.json", pages=5, pagesPerTask=2, selector="value").load()
    assert sorted(json.loads(r.row)["a"] for r in got.collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("S", "1", 34.0, -106.0, None), ("", "2", None, None, 3.0)], "source string, id string, latitude double, longitude double, v double")
    assert sinks.write_collection(df, str(tmp_path / "c"), "c", "t", "d", "2025-01-01T00:00:00Z")["numberReturned"] == 2
    found = {f["id"]: f for f in (json.loads(r.value) for r in spark.read.text(str(tmp_path / "c/features")).collect())}
    assert found["S:1"]["geometry"]["coordinates"] == [-106.0, 34.0] and found["2"]["geometry"] is None and found["S:1"]["properties"]["v"] is None
    root = str(tmp_path / "pub")
    assert sinks.publish(df, root, "p", "2025-01-01") and not sinks.publish(df.repartition(3), root, "p", "2025-01-02") and sinks.publish(df.limit(1), root, "p", "2025-01-03")
    assert sinks.latest(spark, root, "p").count() == 1


def test_stream_equals_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    (tmp_path / "in").mkdir()
    batch.repartition(3).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = daily.daily_windows(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")), "user_id", "ts", "value")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("d").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: sorted((r.user_id, str(r.day), r.min, r.max, round(r["mean"], 9), r.n) for r in df.collect())
    assert key(spark.table("d")) == key(daily.daily_windows(batch, "user_id", "ts", "value"))
    s = daily.keep_summaries(spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "event_type", "value", str(tmp_path / "s"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    s.awaitTermination()
    last = max(int(p.name) for p in (tmp_path / "s").iterdir())
    got = {r.event_type: (r.n, r.min, r.max) for r in spark.read.parquet(str(tmp_path / "s" / str(last))).collect()}
    want = {r.event_type: (r.n, r.min, r.max) for r in daily.merge_summaries(None, batch, "event_type", "value").collect()}
    assert got == want


NAMES = ["summary_stats", "daily_mean", "unit_convert", "standardize_datetime", "approval_status", "water_type", "waterlevel_trend", "level_status", "explicit_links", "well_density", "pod_nearest", "p2_found", "p5_found"]


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, sf, name):
    import os

    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{sf}/{f}')")
    text = lambda v: "" if v is None else "nan" if isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in con.description]
    want = sorted(tuple(text(dict(zip(names, r))[c]) for c in cols) for r in con.fetchall())
    assert sorted(names) == cols
    assert sorted(tuple(text(r[c]) for c in cols) for r in df.collect()) == want
