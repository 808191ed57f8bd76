"""Weir discharge and the flows derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.columns import col

# Coefficients of the full-width weir formula.
WEIR_BASE, WEIR_HEAD, WEIR_RATIO, WEIR_END, WEIR_POWER = 1.785, 0.00295, 0.237, 0.55, 1.5

# Fixed values: (sill offset m, crest length m, crest height m) of the weirs that
# make up the overflow and the fishway of station A.
OVERFLOW_WEIRS = ((0.5, 29.35, 2.1), (0.0, 10.85, 2.6))
FISHWAY_WEIRS = ((1.6, 0.6, 0.8), (1.6, 1.4, 0.9))

# Column names of the derived flows and of what they sum.
LEVEL_A = "A頭首工 河川水位"
OVERFLOW_A = "A頭首工 越流流量"
FISHWAY_A = "A頭首工 魚道流量"
INTAKE_SUMS = {
    "E頭首工 取水量": ("E頭首工 右岸１取水量", "E頭首工 右岸２取水量"),
    "A頭首工 取水量": ("A頭首工 右岸取水量", "A頭首工 越流流量", "A頭首工 魚道流量"),
    "C頭首工 取水量": ("C頭首工 右岸取水量", "C頭首工 左岸取水量"),
    "H頭首工 取水量": ("H頭首工 右岸取水量", "H頭首工 左岸取水量"),
}


def weir_discharge(h: Column, crest_length: float, crest_height: float) -> Column:
    """Discharge (m³/s) over a full-width weir at water level ``h``."""
    head = h - F.lit(crest_height)
    end = 0.0 if crest_height <= 1 else WEIR_END * (crest_height - 1)
    coefficient = F.lit(WEIR_BASE) + (F.lit(WEIR_HEAD) / head + F.lit(WEIR_RATIO) * head / F.lit(crest_height)) * F.lit(1 + end)
    return F.when(h <= crest_height, F.lit(0.0)).when(
        h > crest_height, coefficient * F.lit(crest_length) * F.pow(head, F.lit(WEIR_POWER))
    )


def weirs_discharge(h: Column, weirs: tuple[tuple[float, float, float], ...]) -> Column:
    parts = [weir_discharge(h - F.lit(offset), length, height) for offset, length, height in weirs]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def derived_flows(df: DataFrame) -> DataFrame:
    """Add each derived flow whose inputs exist; a null input gives null."""
    added: dict[str, Column] = {}
    if LEVEL_A in df.columns:
        added[OVERFLOW_A] = weirs_discharge(col(LEVEL_A), OVERFLOW_WEIRS)
        added[FISHWAY_A] = weirs_discharge(col(LEVEL_A), FISHWAY_WEIRS)
    for name, inputs in INTAKE_SUMS.items():
        if all(i in df.columns or i in added for i in inputs):
            parts = [added.get(i, col(i)) for i in inputs]
            total = parts[0]
            for p in parts[1:]:
                total = total + p
            added[name] = total
    return df.withColumns(added) if added else df
