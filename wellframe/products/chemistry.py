"""Per-well chemistry products from each analyte's latest value."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.silver import latest_by_well

MAJOR_IONS = ["calcium", "magnesium", "sodium", "potassium", "bicarbonate", "carbonate", "chloride", "sulfate"]
#: Drinking-water limits in mg/L and their kind.
LIMITS = {
    "arsenic": (0.01, "primary"), "nitrate": (10.0, "primary"), "fluoride": (4.0, "primary"), "uranium": (0.03, "primary"),
    "chloride": (250.0, "secondary"), "sulfate": (250.0, "secondary"), "tds": (500.0, "secondary"),
}
CATIONS, ANIONS = ["calcium", "magnesium", "sodium", "potassium"], ["bicarbonate", "carbonate", "chloride", "sulfate"]


def _sum(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def major_chemistry(rows: DataFrame) -> DataFrame:
    return latest_by_well(rows, MAJOR_IONS, units=True)


def limits(path: str | None = None) -> dict[str, tuple[float, str]]:
    """Limits and their kind by analyte: of a JSON file (analyte to mcl and type; names with a leading underscore are remarks), or the built-in ones."""
    if path is None:
        return dict(LIMITS)
    with open(path, encoding="utf-8") as file:
        return {a: (float(v["mcl"]), v.get("type", "primary")) for a, v in json.load(file).items() if not a.startswith("_")}


def exceedance(rows: DataFrame, known: dict[str, tuple[float, str]] = LIMITS) -> DataFrame:
    """Latest value per limited analyte with its limit and whether it exceeds, how many do and which."""
    names = sorted(known)
    wide = latest_by_well(rows, names)
    over = {a: F.col(a) > known[a][0] for a in names}
    flagged = F.array_compact(F.array(*[F.when(over[a], F.lit(a)) for a in names]))
    tested = lambda a, x: F.when(F.col(a).isNotNull(), F.lit(x))
    return wide.select(
        "source", "id", *[x for a in names for x in (F.col(a), F.col(f"{a}_date"), tested(a, known[a][0]).alias(f"{a}_mcl"), tested(a, known[a][1]).alias(f"{a}_mcl_type"), over[a].alias(f"{a}_exceeds"))],
        F.size(flagged).alias("exceedance_count"), (F.size(flagged) > 0).alias("any_exceedance"), F.array_join(flagged, ",").alias("exceeded_analytes"),
    )


def hardness(rows: DataFrame) -> DataFrame:
    wide = latest_by_well(rows, ["calcium", "magnesium"])
    h = F.round(2.497 * F.col("calcium") + 4.118 * F.col("magnesium"), 1)
    return wide.withColumn("hardness_caco3", h).withColumn("hardness_units", F.lit("mg/L as CaCO3")).withColumn("hardness_class", C.hardness_class(h))


def _totals(wide: DataFrame) -> tuple[Column, Column]:
    return _sum([C.meq(F.col(a), a) for a in CATIONS]), _sum([C.meq(F.col(a), a) for a in ANIONS])


def water_type(rows: DataFrame) -> DataFrame:
    """Dominant ions (over half of their side's milliequivalents) and charge balance."""
    wide = latest_by_well(rows, MAJOR_IONS)
    cat, an = _totals(wide)
    ok = (cat > 0) & (an > 0)
    share = lambda side, *ions: 100 * _sum([C.meq(F.col(i), i) for i in ions]) / side
    ca, mg, na = share(cat, "calcium"), share(cat, "magnesium"), share(cat, "sodium", "potassium")
    hco3, cl, so4 = share(an, "bicarbonate", "carbonate"), share(an, "chloride"), share(an, "sulfate")
    lead = lambda named: reduce(lambda w, kv: w.when(kv[0] > 50, kv[1]), named[1:], F.when(named[0][0] > 50, named[0][1])).otherwise("mixed")
    c, a = lead([(ca, "Ca"), (mg, "Mg"), (na, "Na+K")]), lead([(hco3, "HCO3"), (cl, "Cl"), (so4, "SO4")])
    pct = lambda x: F.when(ok, F.round(x, 1))
    return wide.select(
        "source", "id", F.round(cat, 3).alias("cation_meq_total"), F.round(an, 3).alias("anion_meq_total"),
        F.when(ok, F.concat(c, F.lit("-"), a)).otherwise("insufficient").alias("water_type"), F.when(ok, c).alias("dominant_cation"), F.when(ok, a).alias("dominant_anion"),
        pct(ca).alias("ca_pct"), pct(mg).alias("mg_pct"), pct(na).alias("na_k_pct"), pct(hco3).alias("hco3_pct"), pct(cl).alias("cl_pct"), pct(so4).alias("so4_pct"),
        pct(100 * (cat - an) / (cat + an)).alias("charge_balance_pct"),
    )


def sodium_adsorption(rows: DataFrame) -> DataFrame:
    wide = latest_by_well(rows, ["sodium", "calcium", "magnesium"])
    base = (C.meq(F.col("calcium"), "calcium") + C.meq(F.col("magnesium"), "magnesium")) / 2
    known = F.col("sodium").isNotNull() & (F.col("calcium").isNotNull() | F.col("magnesium").isNotNull()) & (base > 0)
    sar = F.when(known, F.round(C.meq(F.col("sodium"), "sodium") / F.sqrt(base), 2))
    return wide.withColumn("sar", sar).withColumn("sar_class", C.sar_class(F.col("sar")))


def ion_balance(rows: DataFrame) -> DataFrame:
    wide = latest_by_well(rows, MAJOR_IONS)
    cat, an = _totals(wide)
    known = lambda ions: _sum([F.col(i).isNotNull().cast("int") for i in ions])
    balance = F.when((cat > 0) & (an > 0), F.round(100 * (cat - an) / (cat + an), 1))
    return wide.select(
        "source", "id", F.round(cat, 3).alias("cation_meq_total"), F.round(an, 3).alias("anion_meq_total"), known(CATIONS).alias("n_cations_reported"),
        known(ANIONS).alias("n_anions_reported"), balance.alias("charge_balance_pct"), C.balance_class(balance).alias("balance_class"),
    )


def quality_index(rows: DataFrame, known: dict[str, tuple[float, str]] = LIMITS) -> DataFrame:
    """Water quality index of scope, frequency and amplitude of exceedances of the limits above 0."""
    names = sorted(a for a in known if known[a][0] > 0)
    wide = latest_by_well(rows, names)
    tested = _sum([F.col(a).isNotNull().cast("int") for a in names])
    over = [F.coalesce(F.col(a) > known[a][0], F.lit(False)) for a in names]
    failed = _sum([o.cast("int") for o in over])
    nse = _sum([F.when(o, F.col(a) / known[a][0] - 1).otherwise(0.0) for a, o in zip(names, over)]) / tested
    f1, f3 = 100.0 * failed / tested, nse / (0.01 * nse + 0.01)
    index = F.when(tested > 0, F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 - F.sqrt(2 * f1 * f1 + f3 * f3) / 1.732)), 1))
    flagged = F.array_compact(F.array(*[F.when(o, F.lit(a)) for a, o in zip(names, over)]))
    return wide.select(
        "source", "id", *[x for a in names for x in (F.col(a), F.col(f"{a}_date"))], tested.alias("n_analytes_tested"), failed.alias("n_exceeding"), F.array_join(flagged, ",").alias("exceeded_analytes"), index.alias("wqi")
    ).withColumn("wqi_class", C.wqi_class(F.col("wqi")))
