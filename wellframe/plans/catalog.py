"""The declared products, checked and bound to the functions that compute them."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import parse_wkt
from ..operators import filters, silver
from ..products import chemistry, correlation, series, spatial
from ..session import table

#: The parameters and date forms a request may name.
PARAMETERS = ["waterlevels", "arsenic", "bicarbonate", "calcium", "carbonate", "chloride", "conductivity", "fluoride", "magnesium", "nitrate", "ph", "potassium", "silica", "sodium", "specific_conductance", "sulfate", "tds", "uranium"]
DATE_FORMS = ["%Y", "%Y-%m", "%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S.%fZ"]


@dataclass(frozen=True)
class Request:
    """What to compute: parameter, place, time, sources. At most one spatial filter (outline, box or county)."""

    parameter: str | None = None
    bbox: str | None = None
    county: str | None = None
    wkt: str | None = None
    start: str | None = None
    end: str | None = None
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    site_limit: int | None = None

    def validate(self, counties: list[str] | None = None) -> None:
        """Raises ValueError with what is wrong."""
        if self.parameter and self.parameter not in PARAMETERS:
            raise ValueError(f"unknown parameter {self.parameter!r}; known: {', '.join(PARAMETERS)}")
        if sum(x is not None for x in (self.bbox, self.county, self.wkt)) > 1:
            raise ValueError("give one spatial filter, an outline, a box or a county")
        if self.wkt is not None and not len(parse_wkt(None, self.wkt).x1):
            raise ValueError("unreadable outline")
        for d in (self.start, self.end):
            if d and not parse_date(d):
                raise ValueError(f"unreadable date {d!r}")
        if self.bbox:
            parse_box(self.bbox)
        if self.county and counties is not None and self.county not in counties:
            raise ValueError(f"unknown county {self.county!r}")


def parse_date(text: str) -> dt.datetime | None:
    """A date of one of the known forms; parts left out are the first ones."""
    m = re.fullmatch(r"(\d{4})(?:-(\d\d?)(?:-(\d\d?)(?: (\d\d?):(\d\d?):(\d\d?)|T(\d\d?):(\d\d?):(\d\d?)\.(\d{1,6})Z)?)?)?", text)
    if not m:
        return None
    year, month, day, *clock, fraction = m.groups()
    hour, minute, second = clock[:3] if clock[0] else clock[3:]
    try:
        return dt.datetime(int(year), int(month or 1), int(day or 1), int(hour or 0), int(minute or 0), int(second or 0), int((fraction or "0").ljust(6, "0")))
    except ValueError:
        return None


def parse_box(text: str) -> tuple[float, float, float, float]:
    """``"x1 y1, x2 y2"`` as west, south, east, north, rounded to seven digits."""
    try:
        (x1, y1), (x2, y2) = (map(float, p.split()) for p in text.split(","))
    except ValueError:
        raise ValueError(f"unreadable box {text!r}") from None
    west, east, south, north = *sorted((x1, x2)), *sorted((y1, y2))
    return tuple(round(v, 7) for v in (west, south, east, north))


@dataclass(frozen=True)
class Product:
    id: str
    output_type: str
    title: str = ""
    parameter: str | None = None
    params: dict = field(default_factory=dict)
    exclude: tuple[str, ...] = ()


def load(path: str | None = None) -> list[Product]:
    """Products of a YAML file, by default the built-in ones; ids must be unique and types known."""
    import yaml

    rows = yaml.safe_load(Path(path or Path(__file__).with_name("products.yaml")).read_text(encoding="utf-8"))["products"]
    products = [Product(**{**r, "exclude": tuple(r.get("exclude", ()))}) for r in rows]
    for p in products:
        if p.output_type not in BUILDERS:
            raise ValueError(f"{p.id}: unknown output type {p.output_type!r}")
        Request(parameter=p.parameter).validate()
    if len({p.id for p in products}) < len(products):
        raise ValueError("product ids repeat")
    return products


class Tables:
    """The shared tables of one run; products built from it share their scans."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = "2025-06-01 00:00:00", regions: dict[str, DataFrame] | None = None):
        self.sites, self.pods, self.counties = (table(spark, sf_dir, t) for t in ("sites", "pod_sites", "counties"))
        self.rows = silver.readings(table(spark, sf_dir, "observations"))
        self.as_of = as_of
        self.regions = {"counties": self.counties, **(regions or {})}

    def of(self, p: Product) -> DataFrame:
        rows = filters.sources(self.rows, exclude=list(p.exclude)) if p.exclude else self.rows
        return rows.where(F.col("parameter_name") == p.parameter) if p.parameter else rows


BUILDERS = {
    "summary": lambda t, p: silver.summaries(t.of(p), t.sites),
    "timeseries": lambda t, p: t.of(p),
    "major_chemistry": lambda t, p: chemistry.major_chemistry(t.of(p)),
    "mcl_exceedance": lambda t, p: chemistry.exceedance(t.of(p)),
    "hardness": lambda t, p: chemistry.hardness(t.of(p)),
    "water_type": lambda t, p: chemistry.water_type(t.of(p)),
    "sar": lambda t, p: chemistry.sodium_adsorption(t.of(p)),
    "ion_balance": lambda t, p: chemistry.ion_balance(t.of(p)),
    "wqi": lambda t, p: chemistry.quality_index(t.of(p)),
    "waterlevel_trend": lambda t, p: series.trends(t.of(p), "min"),
    "analyte_trend": lambda t, p: series.trends(t.of(p), "mean"),
    "monitoring_recency": lambda t, p: series.recency(t.of(p), t.as_of, **p.params),
    "data_density": lambda t, p: series.density(t.of(p)),
    "waterlevel_change": lambda t, p: series.change(t.of(p), **p.params),
    "waterlevel_status": lambda t, p: series.status(t.of(p), **p.params),
    "seasonal_amplitude": lambda t, p: series.seasonal(t.of(p), **p.params),
    "depletion_projection": lambda t, p: series.depletion(t.of(p), t.sites),
    "well_correlation": lambda t, p: correlation.crosswalk(t.sites, t.pods),
    "well_density": lambda t, p: spatial.density(t.sites, t.counties),
    "basin_well_density": lambda t, p: spatial.density(t.sites, t.regions[p.params["layer"]], p.params.get("key", "name")),
    "pod_age_by_county": lambda t, p: spatial.completions_by_region(t.pods, t.counties, int(t.as_of[:4]), **p.params),
    "pod_age_points": lambda t, p: spatial.completion_points(t.pods, t.counties, int(t.as_of[:4]), **p.params),
}


def build(tables: Tables, product: Product) -> DataFrame:
    """The product as a lazy table."""
    return BUILDERS[product.output_type](tables, product)
