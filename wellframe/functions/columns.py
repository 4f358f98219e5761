"""Column builders for harmonising provider values. None of them uses a Python function per row."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the domain.
FT_PER_M, M_PER_FT = 3.28084, 0.3048
EARTH_RADIUS_M = 6_371_008.8
APPROVED = ["approved", "accepted", "final", "finalized", "validated", "verified", "historical", "published", "reviewed", "public release", "released"]
PROVISIONAL = ["provisional", "preliminary", "working", "estimated", "unverified", "unvalidated", "raw", "draft", "in review", "tentative", "not released"]
NON_DETECT = ["nd", "not detected", "< mrl", "< mdl", "<mrl", "<mdl"]
CONDUCTIVITY_UNITS = ["μmhos/cm", "umho/cm", "cm-1", "micromhos per centimeter", "mg/l", "su", "us/cm", "us/cm @25c", "µs/cm", "μs/cm"]
MEQ_WEIGHTS = {"calcium": 20.04, "magnesium": 12.15, "sodium": 22.99, "potassium": 39.10, "bicarbonate": 61.02, "carbonate": 30.00, "chloride": 35.45, "sulfate": 48.03}
NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def number(x: Column) -> Column:
    """The text's finite number, or null."""
    return F.when(x.rlike(NUMBER), F.trim(x).try_cast("double"))


def coerce_value(x: Column) -> Column:
    """A number; 0 for a non-detect marker; null otherwise."""
    low = F.lower(F.trim(x))
    marked = reduce(lambda a, b: a | b, (low.contains(m) for m in NON_DETECT))
    return F.coalesce(number(x), F.when(marked, 0.0))


def conversion_factor(parameter: Column, units: Column, output: Column, source_name: Column) -> Column:
    """Factor to the output unit, or null where the decision list knows none."""
    p, u, o, s = (F.lower(F.trim(c)) for c in (parameter, units, output, source_name))
    caco3 = F.when(p == "bicarbonate", 1.22).when(p == "calcium", 0.4).when(p == "carbonate", 0.6)
    mgl = (
        F.when(u.isin("mg/l caco3", "mg/l caco3**"), caco3)
        .when(u == "mg/l as n", 4.427)
        .when(u.isin("mg/l asno3", "mg/l as no3"), 1.0)
        .when(u == "ug/l as n", 0.004427)
        .when(u == "pci/l", 0.00149)
        .when(u.isin("ug/l", "ppb"), 0.001)
        .when(u == "tons/ac ft", 735.47)
        .when(u == "ppm", 1.0)
        .when(u == "mg/l", F.when(s.isin("nitrate as n", "nitrate (as n)"), 4.427).otherwise(1.0))
    )
    return (
        F.when(p == "ph", 1.0)
        .when(p.isin("conductivity", "specific_conductance"), F.when(u.isin(*CONDUCTIVITY_UNITS), 1.0))
        .when(o == "mg/l", mgl)
        .when(o == "ft", F.when(u.isin("m", "meters"), FT_PER_M).when(u.isin("ft", "feet"), 1.0))
        .when(o == "m", F.when(u.isin("ft", "feet"), M_PER_FT).when(u.isin("m", "meters"), 1.0))
    )


def length_in(value: Column, unit: Column, out: str) -> Column:
    """Feet or metres as ``out``; unknown units keep their number."""
    u = F.lower(F.trim(unit))
    if out == "ft":
        return F.when(u.isin("m", "meters"), value * FT_PER_M).otherwise(value)
    return F.when(u.isin("ft", "feet"), value * M_PER_FT).otherwise(value)


def standard_date(text: Column) -> Column:
    """Day (or month) of a landed date text: ``yyyy-MM-dd`` or ``yyyy-MM``; null where no form fits."""
    t = F.split_part(F.trim(text), F.lit("."), F.lit(1))
    serial = F.when(t.rlike(r"^[-+]?\d{1,6}$"), F.date_add(F.lit("1900-01-01").cast("date"), t.try_cast("int")).cast("string"))
    day = lambda fmt, head: F.date_format(F.try_to_timestamp(head, F.lit(fmt)), "yyyy-MM-dd")
    iso = F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(Z|\+00:00)?)?)?$"), day("yyyy-M-d", F.regexp_extract(t, r"^(\d{4}-\d{1,2}-\d{1,2})", 1)))
    slashed = F.when(t.rlike(r"^\d{4}/\d{1,2}/\d{1,2}( \d{1,2}:\d{1,2}(:\d{1,2})?)?$"), day("yyyy/M/d", F.regexp_extract(t, r"^(\d{4}/\d{1,2}/\d{1,2})", 1)))
    american = F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), day("M/d/yyyy", t))
    month = F.when(t.rlike(r"^\d{4}-\d{2}$") & F.substring(t, 6, 2).try_cast("int").between(1, 12), t)
    return F.coalesce(serial, iso, slashed, american, month)


def standard_time(text: Column) -> Column:
    """``HH:mm:ss`` of a landed date text that holds a time; empty at midnight and without one."""
    t = F.split_part(F.trim(text), F.lit("."), F.lit(1))
    part = lambda i: F.lpad(F.coalesce(F.nullif(F.regexp_extract(t, r"[T ](\d{1,2}):(\d{1,2})(?::(\d{1,2}))?", i), F.lit("")), F.lit("0")), 2, "0")
    full = F.concat_ws(":", part(1), part(2), part(3))
    return F.when(t.rlike(r"[T ]\d{1,2}:\d{1,2}") & (full != "00:00:00"), full).otherwise("")


def approval_status(raw: Column) -> Column:
    """approved, provisional or unknown; of compound texts, provisional wins."""
    s = F.lower(F.trim(raw))
    has = lambda terms: reduce(lambda a, b: a | b, (s.contains(t) for t in terms))
    return (
        F.when(raw.isNull() | (raw == ""), "unknown")
        .when(s == "true", "approved").when(s == "false", "provisional")
        .when(s.isin(*APPROVED), "approved").when(s.isin(*PROVISIONAL), "provisional")
        .when(has(PROVISIONAL), "provisional").when(has(APPROVED), "approved")
        .otherwise("unknown")
    )


def feature_id(source: Column, id: Column) -> Column:
    return F.when(F.coalesce(source, F.lit("")) == "", id).otherwise(F.concat(source, F.lit(":"), id))


def source_key(source: Column) -> Column:
    """``WQP/<provider>`` sites share the key of WQP observations."""
    return F.when(source.startswith("WQP/"), "WQP").otherwise(source)


def observation_datetime(date: Column, time: Column) -> Column:
    """ISO text of a standardized reading."""
    return F.when(F.coalesce(date, F.lit("")) == "", None).when(F.coalesce(time, F.lit("")) == "", F.concat(date, F.lit("T00:00:00Z"))).otherwise(F.concat(date, F.lit("T"), time, F.lit("Z")))


def normalize_id(x: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(F.coalesce(x, F.lit("")))), r"\s+", " ")


def match_keys(x: Column) -> Column:
    """The identifier, and the same without an agency prefix."""
    n = normalize_id(x)
    return F.filter(F.array_distinct(F.array(n, F.regexp_replace(n, "^(USGS-|USGS:|NWIS-|NWIS:)", ""))), lambda k: k != "")


def station_keys(x: Column) -> Column:
    """15 or 14 digit station numbers written anywhere, also with a blank after the sixth digit."""
    found = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"((?<!\d)\d{6}[ \t]?\d{8,9}(?!\d))"), 1)
    return F.array_distinct(F.transform(found, lambda k: F.regexp_replace(k, r"[ \t]", "")))


def references(x: Column) -> Column:
    return F.filter(F.split(F.coalesce(x, F.lit("")), r"[,;|/\n\t ]+"), lambda t: t != "")


def name_tokens(x: Column) -> Column:
    """Distinct words of at least three letters or digits, in capitals."""
    return F.array_distinct(F.filter(F.split(F.upper(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) >= 3))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def to_wgs84(lon: Column, lat: Column, datum: Column) -> tuple[Column, Column]:
    """Longitude and latitude on WGS84; NAD83 is taken as equal, NAD27 shifted by the abridged three-parameter formula."""
    a, f = 6_378_206.4, 1 / 294.978698214
    da, df = 6_378_137.0 - a, 1 / 298.257223563 - f
    dx, dy, dz = -8.0, 159.0, 175.0
    e2 = 2 * f - f * f
    phi, lam = F.radians(lat), F.radians(lon)
    w = F.sqrt(1 - e2 * F.pow(F.sin(phi), 2))
    m, n = a * (1 - e2) / F.pow(w, 3), a / w
    d_phi = (-dx * F.sin(phi) * F.cos(lam) - dy * F.sin(phi) * F.sin(lam) + dz * F.cos(phi) + (a * df + f * da) * F.sin(2 * phi)) / m
    d_lam = (-dx * F.sin(lam) + dy * F.cos(lam)) / (n * F.cos(phi))
    old = F.upper(F.trim(datum)) == "NAD27"
    return F.when(old, lon + F.degrees(d_lam)).otherwise(lon), F.when(old, lat + F.degrees(d_phi)).otherwise(lat)


def ladder(x: Column, steps: list[tuple[float, str]], last: str, closed: bool = False) -> Column:
    """The first class whose upper bound x lies below (or at, if ``closed``); null gives ``insufficient``."""
    out = F.when(x.isNull(), "insufficient")
    for bound, name in steps:
        out = out.when(x <= bound if closed else x < bound, name)
    return out.otherwise(last)


def tds_class(x: Column) -> Column:
    return ladder(x, [(1000, "fresh"), (10000, "brackish"), (35000, "saline")], "brine")


def hardness_class(x: Column) -> Column:
    return ladder(x, [(60, "soft"), (120, "moderate"), (180, "hard")], "very hard")


def sar_class(x: Column) -> Column:
    return ladder(x, [(10, "low"), (18, "medium"), (26, "high")], "very high")


def balance_class(x: Column) -> Column:
    return ladder(F.abs(x), [(5, "balanced"), (10, "acceptable")], "suspect", closed=True)


def wqi_class(x: Column) -> Column:
    return F.when(x.isNull(), "insufficient").when(x >= 95, "excellent").when(x >= 80, "good").when(x >= 65, "fair").when(x >= 45, "marginal").otherwise("poor")


def status_class(x: Column) -> Column:
    """Of a percentile of depth to water: a deep level is below normal."""
    return (
        F.when(x.isNull(), "insufficient").when(x >= 90, "much below normal").when(x >= 75, "below normal")
        .when(x <= 10, "much above normal").when(x <= 25, "above normal").otherwise("normal")
    )


def meq(x: Column, ion: str) -> Column:
    return F.coalesce(x, F.lit(0.0)) / MEQ_WEIGHTS[ion]


def half_up(x: Column, digits: int) -> Column:
    """Rounded half up; noise far below the wanted digits does not decide, and 0 has no sign."""
    scale = 10.0**digits
    return F.floor(F.round(x * scale, 6) + 0.5) / scale


def normal_tail(z: float) -> float:
    """Two-sided probability of a standard normal value."""
    return math.erfc(abs(z) / math.sqrt(2))
