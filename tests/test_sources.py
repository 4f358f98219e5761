import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from wellframe.operators import filters
from wellframe.plans import unify
from wellframe.plans.catalog import Request
from wellframe.sources import analytes, paged, providers


@pytest.fixture()
def service():
    """A service with next links, posted batches, offsets, and one that is too busy at first."""
    seen = {"busy": 0}

    class Handler(BaseHTTPRequestHandler):
        def answer(self, body, code=200, **headers):
            raw = json.dumps(body).encode()
            self.send_response(code)
            for k, v in headers.items():
                self.send_header(k.replace("_", "-"), v)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def do_GET(self):
            base = f"http://127.0.0.1:{self.server.server_port}"
            if self.path.startswith("/things"):
                n = int(self.path.rpartition("=")[2]) if "skip" in self.path else 0
                self.answer({"value": [{"n": n}, {"n": n + 1}]} | ({"@iot.nextLink": f"{base}/things?skip={n + 2}"} if n < 4 else {}))
            elif self.path.startswith("/features"):
                n = int(self.path.rpartition("=")[2])
                self.answer({"features": [{"n": n}], "links": [{"rel": "self", "href": "x"}] + ([{"rel": "next", "href": f"{base}/features?at={n + 1}"}] if n < 2 else [])})
            elif self.path.startswith("/offset"):
                self.answer({"rows": [{"at": self.path.rpartition("=")[2]}]})
            elif self.path.startswith("/busy"):
                seen["busy"] += 1
                self.answer([1], 429 if seen["busy"] < 3 else 200, Retry_After="0")
            elif self.path.startswith("/always"):
                self.answer([], 429, Retry_After="0")
            else:
                self.answer({}, 404)

        def do_POST(self):
            ids = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["in"]
            self.answer({"rows": [{"id": x.strip("'"), "key": self.headers.get("X-Key")} for x in ids.split(",")]})

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def load(spark, **options):
    spark.dataSource.register(paged.PagedJson)
    return [json.loads(r.row) for r in spark.read.format("paged_json").options(**options).load().collect()]


def test_paging(spark, service):
    assert [r["n"] for r in load(spark, url=f"{service}/things", paging="next", selector="value")] == [0, 1, 2, 3, 4, 5]
    assert [r["n"] for r in load(spark, url=f"{service}/things", paging="next", selector="value", top="true")] == [0, 1]
    assert sorted(r["n"] for r in load(spark, url=f"{service}/features?at=0 {service}/features?at=2", paging="next", selector="features")) == [0, 1, 2, 2]
    assert sorted(r["at"] for r in load(spark, url=f"{service}/offset?n={{limit}}&o={{offset}}", paging="offset", total="5000", limit="2000", selector="rows", pagesPerTask="1")) == ["0", "2000", "4000"]
    got = load(spark, url=f"{service}/batch", paging="ids", ids="a,b,c", batch="2", body='{"in": "{ids}"}', selector="rows", **{"header.X-Key": "k"})
    assert sorted(r["id"] for r in got) == ["a", "b", "c"] and {r["key"] for r in got} == {"k"}


def test_failures(service):
    how = paged.Request(tries=3, wait=0.01)
    assert paged.fetch_json(f"{service}/busy", how=how) == [1]
    with pytest.raises(paged.RateLimited):
        paged.fetch_text(f"{service}/always", how=how)
    with pytest.raises(paged.SourceUnavailable):
        paged.fetch_text(f"{service}/missing", {"a": "b"}, how=how)
    assert paged.healthy(f"{service}/things") and not paged.healthy(f"{service}/missing")
    assert paged.sensorthings_url("http://h/v1/", "Things", expand="Locations", top=1) == "http://h/v1/Things?$expand=Locations&$top=1"
    assert paged.during("phenomenonTime", "2020-01-01", None) == "phenomenonTime ge 2020-01-01" and paged.during("x", None, None) is None


PORTAL = "MonitoringLocationIdentifier string, CharacteristicName string, ResultMeasureValue string, ActivityIdentifier string, USGSPCode string, ResultTemperatureBasisText string, n int"


def test_portal_rules(spark):
    raw = spark.createDataFrame([
        ("w", "Total dissolved solids", "1", "a", "70303", None, 1), ("w", "Total dissolved solids", "2", "a", "70300", None, 2), ("w", "Total dissolved solids", " ", "a", "70300", None, 3), ("w", "Total dissolved solids", "4", "b", None, None, 4),
        ("w", "Total dissolved solids", "5", None, "70300", None, 5), ("w", "Total dissolved solids", "6", None, "70300", None, 6), ("w", "Specific conductance", "7", "a", None, "25 deg C ", 7), ("w", "Specific conductance", "8", "a", None, None, 8), ("w", "Sulfate as S", "9", "a", None, None, 9),
    ], PORTAL)
    got = lambda a: sorted(r.n for r in providers.portal_results(raw, a).collect())
    assert got("tds") == [2, 4, 5, 6] and got("specific_conductance") == [7] and got("conductivity") == [8] and got("sulfate") == [9] and got("uranium") == []


def test_names_of_analytes(spark):
    rows = spark.createDataFrame([("Nitrate-N", 1), (" Sulfate ", 2), ("Specific conductance", 3), ("Lead", 4), (None, 5)], "source_parameter_name string, n int")
    got = sorted((r.n, r.parameter_name) for r in analytes.named(rows, "wqp").collect())
    assert got == [(1, "nitrate"), (2, "sulfate"), (3, "conductivity"), (3, "specific_conductance")]
    assert analytes.listed("bor", "bicarbonate") == [] and analytes.listed("dwb", "uranium") == ["385"]


def test_walks_and_lookups(spark):
    walk = providers.catalog_items(
        spark.createDataFrame([(1, [10, 11]), (2, [12]), (3, [])], "location_id int, record_ids array<int>"), spark.createDataFrame([(10, [100, 101]), (11, [102]), (12, [103])], "record_id int, item_ids array<int>"),
        spark.createDataFrame([(100, "x"), (101, "Ca"), (102, "Ca"), (103, "y")], "item_id int, parameter_code string"), "Ca",
    )
    assert walk.collect() == [(1, 101)]
    keyed = spark.createDataFrame([({"p": [{"v": 1.0}, {"v": 2.0}]},)], "m map<string, array<struct<v: double>>>")
    assert sorted(tuple(r) for r in providers.exploded(keyed, "m").collect()) == [("p", 1.0), ("p", 2.0)]
    found = providers.joined_wells(spark.createDataFrame([("a",), ("b",)], "point_id string"), spark.createDataFrame([("a", None, 9.0, "ft"), ("a", "F", None, "ft")], "point_id string, formation string, well_depth double, well_depth_units string"))
    assert {(r.point_id, r.formation, r.well_depth) for r in found.collect()} == {("a", "F", 9.0), ("b", None, None)}


def things(ids, agency=None):
    return [(i, "n", {"coordinates": [-104.5, 33.2, 1000.0]}, {"agency": agency, "stickup": 2.0}) for i in ids]


def test_agencies_and_results(spark):
    schema = providers.PROVIDERS["pvacd"].site_schema
    at = lambda p, rows: sorted(r.id for r in providers.sites(p, spark.createDataFrame(rows, schema)).collect())
    assert at("pvacd", things(["9639", "9640", "9650", "9651"])) == ["9640", "9650"] and at("bernco", things(["9652", "1"])) == ["1"] and at("ebid", things(["1"], "EBID") + things(["2"], "PVACD")) == ["1"]
    cabq = providers.sites("cabq", spark.createDataFrame(things(["1"], "CABQ"), schema)).first()
    assert cabq.elevation == pytest.approx(1000 - 0.6096)
    obs = spark.createDataFrame([("1", {"result": r, "phenomenonTime": "2020-01-01T00:00:00Z"}, {"name": "x", "unitOfMeasurement": {"symbol": "ug/L"}, "ObservedProperty": {"name": "Arsenic"}}) for r in ("< MRL 0.5", "3.2 ug", "ND")], providers.PROVIDERS["dwb"].reading_schema)
    assert sorted((r.value_text, r.parameter_value) for r in providers.readings("dwb", obs, "arsenic").collect()) == [("3.2 ug", 3.2), ("< MRL 0.5", 0.0), ("ND", None)]
    pods = spark.createDataFrame([({"pod_file": f, "elevation": 1.0, "aquifer": None, "depth_well": 10.0, "start_date": 0, "finish_dat": 86_400_000, "pod_status": s, "pod_basin": b}, {"x": -106.0, "y": 34.0}) for f, s, b in (("A", "ACT", "RG"), ("B", "ACT", "SP"), ("C", "PEN", "RG"))], providers.PROVIDERS["pods"].site_schema)
    assert [(r.id, r.well_completion_date) for r in providers.sites("pods", pods).collect()] == [("A", "1970-01-02")]


SITES = "site_uid long, source string, id string, name string, latitude double, longitude double, horizontal_datum string, well_depth double, well_depth_units string"
ROWS = "source string, id string, parameter_name string, value_text string, source_parameter_name string, source_parameter_units string, date_measured string, time_measured string, n int"
SITE_ROWS = [(1, "WQP/X", "w", "n", 34.0, -106.0, "NAD83", None, None), (2, "WQP", "zero", "n", 0.0, -106.0, None, None, None), (3, "WQP", "far", "n", 36.0, -106.0, None, None, None)]


def row(n, value="1.5", units="mg/L", date="2020-01-05", id="w", parameter="calcium", time=None):
    return ("WQP", id, parameter, value, None, units, date, time, n)


def test_unify_gives_reasons(spark):
    rows = [row(1), row(2, None), row(3, " "), row(4, "-999999"), row(5, "abc"), row(6, "2", "furlongs"), row(7, "2", date=None), row(8, "2", date="soon"), row(9, "2", id="zero"), row(10, "2", id="none"), row(11, "ND", date="2020-01-04"), row(12, "5000", "ug/L", "2020-01-06", time="14:30"), row(13, "7", id="far")]
    sites = spark.createDataFrame(SITE_ROWS, SITES)
    raw = spark.createDataFrame(rows, ROWS)
    got = unify.unify(raw, sites, Request(bbox="-107 33, -105 35"))
    assert {r.n: r.reason for r in got.rejected.collect()} == {2: "no value", 3: "no value", 4: "no value", 5: "unreadable value", 6: "unknown unit", 7: "no date", 8: "unreadable date", 9: "unusable coordinates", 10: "unknown well", 13: "out of bounds"}
    s = unify.summaries(got.kept).collect()
    assert len(s) == 1 and (s[0].nrecords, s[0].min, s[0].max, s[0].earliest_value, s[0].earliest_date, s[0].latest_value, s[0].latest_time) == (2, 1.5, 5.0, 0.0, "2020-01-04", 5.0, "14:30:00")
    area = spark.createDataFrame([("POLYGON ((-107 35, -105 35, -105 37, -107 37, -107 35))",)], "geometry string")
    assert [r.n for r in unify.unify(raw, sites, area=area).kept.collect()] == [13]
    early = unify.unify(raw, sites, Request(start="2020-01-05", end="2020-01"))
    assert sorted(r.n for r in early.kept.collect()) == [1, 12, 13] and [r.n for r in early.rejected.where("reason = 'before the range'").collect()] == [11]
    with pytest.raises(ValueError, match="value_text"):
        unify.unify(raw.drop("value_text"), sites)
    assert unify.summaries(unify.unify(raw.limit(0), sites.limit(0)).kept).count() == 0
    assert [r.n for r in unify.flat(got.kept).collect()] == [11, 1, 12]


def test_a_failing_source_leaves_the_others(spark):
    sites, rows = spark.createDataFrame(SITE_ROWS, SITES), spark.createDataFrame([row(1)], ROWS)

    def broken():
        raise paged.SourceUnavailable("down")

    got = unify.gather({"a": lambda: (sites, rows), "b": broken, "c": lambda: (sites.limit(0), None)})
    assert set(got.failed) == {"b", "c"} and "down" in got.failed["b"] and got.sites.count() == 3 and got.rows.count() == 1
    assert unify.gather({"a": lambda: (sites, rows)}, sites_only=True).rows is None


def test_areas_with_a_buffer(spark):
    points = spark.createDataFrame([(1, 34.0, -106.0), (2, 34.0, -104.9), (3, 34.0, -104.5), (4, None, -106.0), (5, 35.0, -105.5)], "site_uid long, latitude double, longitude double")
    square = spark.createDataFrame([("POLYGON ((-107 33, -105 33, -105 35, -107 35, -107 33))",)], "geometry string")
    at = lambda df: sorted(r.site_uid for r in df.collect())
    assert at(filters.in_area(points, "site_uid", square)) == [1] and at(filters.in_area(points, "site_uid", square, boundary=True)) == [1, 5]
    assert at(filters.near_area(points, "site_uid", square, 25_000)) == [1, 2, 5]
    assert filters.near_area(points.limit(0), "site_uid", square, 25_000).count() == 0


def test_a_cluster_needs_a_shared_folder():
    from wellframe.session import shared_dir

    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(Fake())


def test_layers(spark, tmp_path):
    from wellframe.sources import layers

    square = [[[-106, 34], [-105, 34, 9], [-105, 35], [-106, 35], [-106, 34]]]
    body = {"type": "FeatureCollection", "features": [{"id": "1", "properties": {"NAME": "A", "FIPS": "35"}, "geometry": {"type": "Polygon", "coordinates": square}}, {"id": "2", "properties": {"NAME": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [square, [[[0, 0], [1.5e0, 0], [0, 1], [0, 0]]]]}}, {"id": "3", "properties": {}, "geometry": None}]}
    (tmp_path / "r.json").write_text(json.dumps(body))
    rows = {r.id: r for r in layers.with_area(layers.read_regions(spark, str(tmp_path / "r.json"), "NAME", "FIPS")).collect()}
    assert rows["1"].geometry == "POLYGON ((-106 34, -105 34, -105 35, -106 35, -106 34))" and (rows["1"].name, rows["1"].key) == ("A", "35") and rows["2"].geometry.startswith("MULTIPOLYGON (((-106 34,") and rows["3"].geometry is None
    # a degree square at 34.5 degrees north
    assert rows["1"].area_sq_km == pytest.approx(10_180, rel=0.003) and rows["3"].area_sq_km is None
    assert json.loads(layers.outline_json(rows["1"].geometry))["rings"][0][1] == [-105.0, 34.0]
    east, north = layers.utm_metres(layers.np.array([-105.0, -106.5]), layers.np.array([34.0, 34.0]))
    assert east[0] == pytest.approx(500_000) and north[0] == pytest.approx(3_762_155, abs=1) and east[1] == pytest.approx(361_451, abs=30)


def test_tables_and_binary_points(spark, tmp_path):
    from wellframe.sources import layers

    df = spark.createDataFrame([(1, -106.1234567, 34.0), (2, None, 34.0)], "n int, longitude double, latitude double")
    layers.write_tables(str(tmp_path), points=layers.with_wkb(df))
    back = layers.from_wkb(layers.read_table(spark, str(tmp_path), "points", "n int, longitude double, latitude double, geometry binary").drop("longitude", "latitude"))
    assert sorted(map(tuple, back.collect())) == [(1, -106.1234567, 34.0), (2, None, None)]
    assert layers.read_table(spark, str(tmp_path), "missing", "n int").count() == 0
    assert layers.displayed(df).first().longitude == -106.123457


def test_requests():
    with pytest.raises(ValueError, match="one spatial"):
        Request(bbox="1 2, 3 4", wkt="POLYGON ((0 0, 1 0, 0 1, 0 0))").validate()
    with pytest.raises(ValueError, match="outline"):
        Request(wkt="POINT (1 2)").validate()
    Request(wkt="POLYGON ((0 0, 1 0, 0 1, 0 0))", start="2020", end="2020-02-03T04:05:06.7Z").validate()
    with pytest.raises(ValueError, match="date"):
        Request(start="2020-13").validate()
