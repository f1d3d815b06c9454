"""Schemas and fixed domain values of the incident tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the values the original analysis used, so
# that the same records survive the same filters and map to the same labels.
# ---------------------------------------------------------------------------
ARREST_AGE_GROUPS = ["<18", "18-24", "25-44", "45-64", "65+"]
COMPLAINT_AGE_GROUPS = ["<18", "18-24", "25-44", "45-64", "65+", "UNKNOWN"]
SUSPECT_SEXES = ["M", "F", "U"]
VICTIM_SEXES = ["M", "F", "U", "D", "E"]
BOROUGH_CODES = {
    "B": "BRONX",
    "S": "STATEN ISLAND",
    "K": "BROOKLYN",
    "M": "MANHATTAN",
    "Q": "QUEENS",
}
ARREST_DROP = ["PD_CD", "KY_CD", "LAW_CODE", "LAW_CAT_CD", "JURISDICTION_CODE",
               "X_COORD_CD", "Y_COORD_CD"]
COMPLAINT_DROP = ["CMPLNT_TO_DT", "CMPLNT_TO_TM", "RPT_DT", "KY_CD", "PD_CD",
                  "LOC_OF_OCCUR_DESC", "JURIS_DESC", "JURISDICTION_CODE", "PARKS_NM",
                  "HADEVELOPT", "HOUSING_PSA", "X_COORD_CD", "Y_COORD_CD",
                  "TRANSIT_DISTRICT", "PATROL_BORO", "STATION_NAME"]
ARREST_RENAMES = {
    "ARREST_BORO": "BORO_NM",
    "ARREST_PRECINCT": "ADDR_PCT_CD",
    "AGE_GROUP": "SUSP_AGE_GROUP",
    "PERP_RACE": "SUSP_RACE",
    "PERP_SEX": "SUSP_SEX",
    "ARREST_KEY": "CMPLNT_NUM",
}
DEMOGRAPHIC_YEARS = ["2006", "2007", "2008", "2009", "2010", "2011", "2012",
                     "2013", "2014", "2015", "2016", "2017", "2018"]
DEMOGRAPHIC_MEASURES = ["proverty_rate", "income_diversity", "racial_diversity",
                        "unemployment_rate", "population"]
DEMOGRAPHIC_DROP = ["short_name", "long_name"]
RACE_FRACTIONS = {
    "WHITE": 0.01,
    "BLACK": 0.01,
    "BLACK HISPANIC": 0.01,
    "WHITE HISPANIC": 0.01,
    "UNKNOWN": 0,
    "OTHER": 0,
    "AMERICAN INDIAN/ALASKAN NATIVE": 0.01,
    "ASIAN / PACIFIC ISLANDER": 0.01,
}
TOP_K = 30
# Offences left out of the hour-of-day profile.
HOURLY_EXCLUDED_OFFENCES = [
    "OTHER OFFENSES RELATED TO THEFT",
    "OTHER TRAFFIC INFRACTION",
    "OFFENSES AGAINST PUBLIC ADMINISTRATION",
    "POSSESSION OF STOLEN PROPERTY 5",
    "CRIMINAL MISCHIEF & RELATED OFFENSES",
    "OFF. AGNST PUB ORD SENSBLTY & RGHTS TO PRIV",
    "F.C.A. P.I.N.O.S.",
]
SIGNIFICANCE_LEVEL = 0.05
ELASTIC_NET = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}
CLUSTERS = 4
SAMPLE_SEED = 0
# Text layouts of the raw feeds.
CIVIL_DATE_FORMAT = "M/d/yyyy"      # accepts both 01/02/2019 and 1/2/2019
CLOCK_TIME_FORMAT = "H:m:s"
# ---------------------------------------------------------------------------

_S = T.StringType()

ARREST_FIELDS = ["ARREST_KEY", "ARREST_DATE", "PD_CD", "PD_DESC", "KY_CD", "OFNS_DESC",
                 "LAW_CODE", "LAW_CAT_CD", "ARREST_BORO", "ARREST_PRECINCT",
                 "JURISDICTION_CODE", "AGE_GROUP", "PERP_SEX", "PERP_RACE",
                 "X_COORD_CD", "Y_COORD_CD", "Latitude", "Longitude"]
COMPLAINT_FIELDS = ["CMPLNT_NUM", "CMPLNT_FR_DT", "CMPLNT_FR_TM", "CMPLNT_TO_DT",
                    "CMPLNT_TO_TM", "ADDR_PCT_CD", "RPT_DT", "KY_CD", "OFNS_DESC", "PD_CD",
                    "PD_DESC", "CRM_ATPT_CPTD_CD", "LAW_CAT_CD", "BORO_NM",
                    "LOC_OF_OCCUR_DESC", "PREM_TYP_DESC", "JURIS_DESC",
                    "JURISDICTION_CODE", "PARKS_NM", "HADEVELOPT", "HOUSING_PSA",
                    "X_COORD_CD", "Y_COORD_CD", "SUSP_AGE_GROUP", "SUSP_RACE", "SUSP_SEX",
                    "TRANSIT_DISTRICT", "Latitude", "Longitude", "Lat_Lon", "PATROL_BORO",
                    "STATION_NAME", "VIC_AGE_GROUP", "VIC_RACE", "VIC_SEX"]

# Raw feeds are read with an explicit all-string schema: no inference pass
# over terabytes of JSON, and a stable column set even when a file lacks a key.
ARREST_SCHEMA = T.StructType([T.StructField(f, _S) for f in ARREST_FIELDS])
COMPLAINT_SCHEMA = T.StructType([T.StructField(f, _S) for f in COMPLAINT_FIELDS])

# Unified incident table: leading columns in this order, any other surviving
# raw column follows in name order.
INCIDENT_COLUMNS = ["CMPLNT_NUM", "RECORD_TYPE", "BORO_NM", "ADDR_PCT_CD", "ARREST_DATE",
                    "CMPLNT_FR_DT", "CMPLNT_FR_TM", "OFNS_DESC", "PREM_TYP_DESC",
                    "CRM_ATPT_CPTD_CD", "LAW_CAT_CD", "SUSP_AGE_GROUP", "SUSP_RACE",
                    "SUSP_SEX", "VIC_AGE_GROUP", "VIC_RACE", "VIC_SEX", "Lat_Lon",
                    "Latitude", "Longitude", "Year", "Month", "Date"]
