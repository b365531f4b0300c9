"""Columns of the inputs: new name -> (name in the file, type)."""

from __future__ import annotations

from pyspark.sql import types as T

from airq.functions.air import MEASURES

LONG_SERIES = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

WIDE_SERIES = T.StructType([
    T.StructField("DateTime", T.TimestampType()),
    T.StructField("device_id", T.StringType()),
    *[T.StructField(m, T.DoubleType()) for m in MEASURES],
])

# Fixed values, here and below: headers of the files.
TERMS = {
    "academic_year": ("academic_year", "string"),
    "term_name": ("term_name", "string"),
    "start_date": ("start_date", "date"),
    "end_date": ("end_date", "date"),
}
HOLIDAYS = {"date": ("date", "date")}

POSTCODE_AREAS = {"area": ("Postcode.area", "string"), "Country": ("Country", "string")}
POSTCODE_CODES = {
    "Postcode": ("pcds", "string"),
    "LSOA": ("lsoa11cd", "string"),
    "OutputArea": ("oa11cd", "string"),
}
DEPRIVATION = {
    "LSOA": ("LSOA", "string"),
    "LocalAuthority": ("LANAME", "string"),
    "IMD_decile": ("SOA_decile", "int"),
}
RURAL_ENGLAND_WALES = {
    "OutputArea": ("OA11CD", "string"),
    "RUC_code": ("RUC11CD", "string"),
    "RUC": ("RUC11", "string"),
}
RURAL_SCOTLAND = {"OutputArea": ("OUTPUTAREA", "string"), "RUC_code": ("UR2FOLD", "int")}
RURAL_NORTHERN_IRELAND = {"OutputArea": ("SA2011_Code", "string"), "RUC_code": ("Rural_Urban", "string")}
REGISTER_ENGLAND_WALES = {
    "EstablishmentId": ("URN", "int"),
    "EducationPhase": ("PhaseOfEducation..name.", "string"),
    "PercentageFSM": ("PercentageFSM", "double"),
    "SchoolCapacity": ("SchoolCapacity", "int"),
    "NumberOfPupils": ("NumberOfPupils", "int"),
}
REGISTER_SCOTLAND = {
    "EstablishmentId": ("SeedCode", "int"),
    "EducationPhase": ("SchoolType", "string"),
    "PercentageFSM": ("PercentageFSM", "double"),
}
REGISTER_NORTHERN_IRELAND = {
    "EstablishmentId": ("DE.ref", "int"),
    "EducationPhase": ("school.type", "string"),
    "PercentageFSM": ("PercentageFSM", "double"),
}
ENERGY_CERTIFICATES = {
    "POSTCODE": ("POSTCODE", "string"),
    "EPCBand": ("ASSET_RATING_BAND", "string"),
    "EPCAssetRating": ("ASSET_RATING", "int"),
    "MainHeatingFuel": ("MAIN_HEATING_FUEL", "string"),
    "FloorArea": ("FLOOR_AREA", "double"),
    "BuildingEnvironment": ("BUILDING_ENVIRONMENT", "string"),
}
POSTCODE_COORDINATES = {
    "pc_clean": ("pc_clean", "string"),
    "latitude": ("latitude", "double"),
    "longitude": ("longitude", "double"),
}

# Views of the relational database.
VIEWS = (
    "vw_Research_Schools", "vw_Research_Monitors", "vw_Research_Activities", "vw_Research_ActivitySteps",
    "vw_Research_UserScores", "vw_Research_SchoolEstablishments", "vw_Research_SchoolUsers",
    "vw_Research_UserAchievementProgresses", "vw_Research_Rooms", "vw_Research_MonitorLocationHistories",
    "vw_Research_RequestMonitorSubmissions",
)
PROGRESS_VIEW = "vw_Research_ActivityUserProgresses"
PROGRESS_COLUMNS = (
    "Id", "ActivityId", "SchoolUserId", "ActivityStatus", "ActiveStepId", "DateCreated", "DateModified",
    "StepsState", "PreviousSteps", "AttemptNo",
)
PROGRESS_TEXT = ("StepsState", "PreviousSteps")
