"""How the providers name the analytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names or numbers under which a provider lists an analyte; none where it does not.
ANALYTES = {
    "arsenic": {"dwb": [3], "isc": [], "nmbgmr": ["Arsenic"], "wqp": ["Arsenic"], "bor": ["As"]},
    "bicarbonate": {"dwb": [22], "isc": ["Bicarbonate (HCO3)"], "nmbgmr": ["Bicarbonate"], "wqp": ["Bicarbonate"], "bor": []},
    "calcium": {"dwb": [11], "isc": ["Calcium"], "nmbgmr": ["Calcium"], "wqp": ["Calcium"], "bor": ["Ca"]},
    "carbonate": {"dwb": [], "isc": ["Carbonate (CO3)"], "nmbgmr": ["Carbonate"], "wqp": ["Carbonate"], "bor": []},
    "chloride": {"dwb": [15], "isc": ["Chloride"], "nmbgmr": ["Chloride"], "wqp": ["Chloride"], "bor": ["Cl"]},
    "conductivity": {"dwb": [], "isc": ["Specific Conductance"], "nmbgmr": [], "wqp": ["Specific conductance"], "bor": ["Cond"]},
    "fluoride": {"dwb": [19], "isc": ["Fluoride"], "nmbgmr": ["Fluoride"], "wqp": ["Fluoride"], "bor": ["F"]},
    "magnesium": {"dwb": [23], "isc": ["Magnesium"], "nmbgmr": ["Magnesium"], "wqp": ["Magnesium"], "bor": ["Mg"]},
    "nitrate": {"dwb": [35], "isc": ["Nitrate"], "nmbgmr": ["Nitrate (as N)"], "wqp": ["Nitrate", "Nitrate-N", "Nitrate as N"], "bor": ["NO3"]},
    "ph": {"dwb": [81], "isc": ["pH"], "nmbgmr": ["pH, laboratory"], "wqp": ["pH"], "bor": ["pH"]},
    "potassium": {"dwb": [33], "isc": ["Potassium"], "nmbgmr": ["Potassium"], "wqp": ["Potassium"], "bor": ["K"]},
    "silica": {"dwb": [37], "isc": ["SiO2"], "nmbgmr": ["Silica"], "wqp": ["Silica"], "bor": ["SiO2"]},
    "sodium": {"dwb": [38], "isc": ["Sodium"], "nmbgmr": ["Sodium"], "wqp": ["Sodium"], "bor": ["Na"]},
    "specific_conductance": {"dwb": [49], "isc": ["Electrical Conductance"], "nmbgmr": ["Conductivity, laboratory"], "wqp": ["Specific conductance"], "bor": []},
    "sulfate": {"dwb": [41], "isc": ["Sulfate"], "nmbgmr": ["Sulfate"], "wqp": ["Sulfate", "Sulfate as SO4", "Sulfur Sulfate", "Sulfate as S", "Total Sulfate"], "bor": ["SO4"]},
    "tds": {"dwb": [90], "isc": ["TDS calc"], "nmbgmr": ["Total Dissolved Solids"], "wqp": ["Total dissolved solids"], "bor": ["TDS"]},
    "uranium": {"dwb": [385], "isc": [], "nmbgmr": ["Uranium (total, by ICP-MS)"], "wqp": ["Uranium"], "bor": ["U"]},
}


def listed(provider: str, analyte: str) -> list[str]:
    """The provider's names of an analyte, none if it does not report it."""
    return [str(x) for x in ANALYTES.get(analyte, {}).get(provider, [])]


def named(readings: DataFrame, provider: str, wanted: list[str] | None = None, column: str = "source_parameter_name") -> DataFrame:
    """Readings of the wanted analytes (all by default) with their canonical ``parameter_name``.

    A name that stands for two analytes gives a row for each; both stay until their rules (temperature basis)
    tell them apart. Other rows drop out. The table of names is fixed and goes to every task.
    """
    pairs = [(name, analyte) for analyte in (wanted or ANALYTES) for name in listed(provider, analyte)]
    table = readings.sparkSession.createDataFrame(pairs, "_name string, _analyte string")
    met = readings.join(F.broadcast(table), F.trim(column) == F.col("_name"))
    return met.withColumn("parameter_name", F.col("_analyte")).drop("_name", "_analyte")
