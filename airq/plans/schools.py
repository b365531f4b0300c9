"""School characteristics from reference tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.functions.text import clean_postcode, format_postcode, postcode_area, to_int
from airq.operators.align import union_aligned
from airq.operators.lookup import branch_lookup, geocode, lookup, monitor_dimension, unambiguous_values

CERTIFICATE_VALUES = ("EPCBand", "MainHeatingFuel", "FloorArea", "BuildingEnvironment")


def school_monitors(requests: DataFrame, schools: DataFrame, monitors: DataFrame) -> DataFrame:
    """Monitor dimension with parsed ids and uniform postcodes."""
    dimension = monitor_dimension(requests.withColumn("EstablishmentId", to_int("EstablishmentId")), schools, monitors)
    return dimension.withColumn("SchoolAddressPostCode", format_postcode("SchoolAddressPostCode"))


def rural_urban_tables(england_wales: DataFrame, scotland: DataFrame, northern_ireland: DataFrame) -> dict[str, DataFrame]:
    """The three classifications with text codes and one set of labels."""
    # Codes and labels of the three classifications.
    code = F.col("RUC_code")
    scottish = F.when(code == 1, "Urban Scotland").when(code == 2, "Rural Scotland")
    irish = F.when(code == "Rural", "Rural NI").when(code.isin("Urban", "Mixed urban/rural"), "Urban NI")
    return {
        "England and Wales": england_wales.withColumn("RUC_code", code.cast("string")),
        "Scotland": scotland.withColumn("RUC", scottish).withColumn("RUC_code", code.cast("string")),
        "Northern Ireland": northern_ireland.withColumn("RUC", irish),
    }


def country_branch(country: str = "Country"):
    """Branch of a country; NULL for countries without a branch."""
    # Names of countries.
    c = F.col(country)
    return F.when(c.isin("England", "Wales"), "England and Wales").when(
        c.isin("Scotland", "Northern Ireland", "Channel Islands"), c)


def with_country(df: DataFrame, areas: DataFrame) -> DataFrame:
    coded = df.withColumn("pcode_region", postcode_area("SchoolAddressPostCode"))
    return lookup(coded, areas.select("area", "Country"), {"pcode_region": "area"})


def with_rural_urban(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Classification by output area within the country; fixed for the islands."""
    out = branch_lookup(df, country_branch(), tables, ["OutputArea"])
    island = F.col("Country") == "Channel Islands"
    return out.withColumns({
        "RUC_code": F.when(island, "channel island").otherwise(F.col("RUC_code")),
        "RUC": F.when(island, "Rural").otherwise(F.col("RUC")),
    })


def school_characteristics(monitors: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Area, deprivation, register, energy and position of every monitor's school.

    ``tables``: areas, postcodes, deprivation, rural_england_wales,
    rural_scotland, rural_northern_ireland, register_england_wales,
    register_scotland, register_northern_ireland, certificates,
    certificates_scotland, live_postcodes, retired_postcodes. Schools outside
    the known countries are dropped.
    """
    df = with_country(monitors, tables["areas"])
    df = lookup(df, tables["postcodes"], {"SchoolAddressPostCode": "Postcode"})
    df = lookup(df, tables["deprivation"], ["LSOA"])
    df = with_rural_urban(df, rural_urban_tables(
        tables["rural_england_wales"], tables["rural_scotland"], tables["rural_northern_ireland"]))
    registers = {
        "England and Wales": tables["register_england_wales"],
        "Scotland": tables["register_scotland"],
        "Northern Ireland": tables["register_northern_ireland"],
    }
    df = branch_lookup(df, country_branch(), registers, ["EstablishmentId"])
    certificates = union_aligned(tables["certificates"], tables["certificates_scotland"])
    agreed = unambiguous_values(certificates, "POSTCODE", CERTIFICATE_VALUES)
    df = lookup(df, agreed, {"SchoolAddressPostCode": "POSTCODE"})
    df = df.withColumns({
        "FractionalOccupancy": F.try_divide("NumberOfPupils", "SchoolCapacity"),
        "pc_clean": clean_postcode("SchoolAddressPostCode"),
    })
    return geocode(df, "pc_clean", tables["live_postcodes"], tables["retired_postcodes"])
