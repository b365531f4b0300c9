"""Quantities of the ventilation estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airq.functions.aggregates import col

MEASURES = ("pm01", "pm02", "rco2", "pm10", "rhum", "atmp", "tvoc")

# Outdoor CO2 in ppm, school-type codes of the two age groups,
# CO2 generation per person, occupancy factor times metabolic rate.
OUTDOOR_CO2 = 412
PRIMARY_TYPES = (1, 2, 3)
SECONDARY_TYPES = (4, 8, 12, 16, 20, 24, 28)
PRIMARY_RATE = 3.1
OTHER_RATE = 4.32
OCCUPANCY = 5 * 1.048


def co2_excess(c: str | Column = "rco2") -> Column:
    """Volume fraction of CO2 above outdoor air."""
    return (col(c) - OUTDOOR_CO2) / F.lit(1e6)


def age_group(school_type: str | Column) -> Column:
    t = col(school_type)
    return F.when(t.isin(*PRIMARY_TYPES), "Primary").when(t.isin(*SECONDARY_TYPES), "11-plus").otherwise("Mixed")


def generation_rate(group: str | Column) -> Column:
    return F.when(col(group) == "Primary", F.lit(PRIMARY_RATE)).otherwise(F.lit(OTHER_RATE))
