"""Declared columns of every layer.

Types are declared rather than inferred: inference costs a full pass over the
file and turns an identifier such as ``015009`` into a number.
"""

from pyspark.sql import types as T

# --- fixed values: names of the four extracts -------------------------------
PBJ = "PBJ_Daily_Nurse_Staffing_Q2_2024"
PROVIDER = "NH_ProviderInfo_Oct2024"
STATE_AVERAGES = "NH_StateUSAverages_Oct2024"
SURVEY_DATES = "NH_SurveyDates_Oct2024"
DATASETS = (PROVIDER, STATE_AVERAGES, SURVEY_DATES, PBJ)

# --- fixed values: daily staffing columns -----------------------------------
FACILITY_KEYS = ("PROVNUM", "PROVNAME", "STATE")
STAFF_TYPES = ("RN", "LPN", "CNA")
HOURS = tuple(f"Hrs_{s}" for s in STAFF_TYPES)
EMPLOYEE_HOURS = tuple(f"Hrs_{s}_emp" for s in STAFF_TYPES)
CONTRACT_HOURS = tuple(f"Hrs_{s}_ctr" for s in STAFF_TYPES)
CENSUS = "MDScensus"
WORK_DATE = "WorkDate"
PBJ_NUMBERS = HOURS + EMPLOYEE_HOURS + CONTRACT_HOURS + (CENSUS,)

# --- fixed values: provider headers -> model names --------------------------
PROVIDER_TEXT = {
    "CMS Certification Number (CCN)": "PROVNUM",
    "Provider Name": "PROVNAME",
    "State": "STATE",
}
PROVIDER_NUMBERS = {
    "Number of Certified Beds": "CERTIFIED_BEDS",
    "Average Number of Residents per Day": "AVG_RESIDENTS",
    "Overall Rating": "OVERALL_RATING",
    "Health Inspection Rating": "HEALTH_RATING",
    "Staffing Rating": "STAFFING_RATING",
}
RATINGS = ("OVERALL_RATING", "HEALTH_RATING", "STAFFING_RATING")

# --- fixed values: columns the silver layer leaves out ----------------------
SILVER_DROPPED = (
    "Average Number of Residents per Day Footnote",
    "Overall Rating Footnote",
    "Health Inspection Rating Footnote",
    "QM Rating Footnote",
    "Reported Staffing Footnote",
    "Physical Therapist Staffing Footnote",
    "Special Focus Status",
    "Long-Stay QM Rating Footnote",
    "Geocoding Footnote",
    "Staffing Rating Footnote",
    "Total nursing staff turnover footnote",
    "Administrator turnover footnote",
    "Registered Nurse turnover footnote",
    "Short-Stay QM Rating Footnote",
)

# --- lineage columns added on landing ---------------------------------------
SOURCE_FILE = "_source_file"
MODIFIED_AT = "_modified_at"
INGESTED_AT = "_ingested_at"
# The text of a row that does not fit the header; null for all others.
UNFIT_ROW = "_unfit_row"
LANDING_COLUMNS = (UNFIT_ROW, SOURCE_FILE, MODIFIED_AT, INGESTED_AT)


def _table(text=(), numbers=(), ints=(), partitions=()):
    fields = [T.StructField(c, T.StringType()) for c in text]
    fields += [T.StructField(c, T.DoubleType()) for c in numbers]
    kinds = {c: T.IntegerType() for c in ints}
    fields += [T.StructField(c, kinds.get(c, T.StringType())) for c in partitions]
    return T.StructType(fields)


# Gold tables as read back: partition columns come last.
GOLD_PARTITIONS = {
    "staffing_metrics": ("STATE", "YEAR", "MONTH"),
    "facility_metrics": ("STATE",),
    "quality_metrics": ("STATE",),
    "top_patient_volume": (),
}
# Names and order of the gold columns.
GOLD_NUMBERS = {
    "staffing_metrics": (
        "TOTAL_NURSE_HOURS", "AVG_PATIENT_CENSUS", "RN_HOURS", "LPN_HOURS", "CNA_HOURS",
        "EMPLOYEE_HOURS", "CONTRACT_HOURS", "NURSE_TO_PATIENT_RATIO",
        "EMPLOYEE_STAFF_PERCENT", "CONTRACT_STAFF_PERCENT",
    ),
    "facility_metrics": (
        "CERTIFIED_BEDS", "AVG_RESIDENTS", *RATINGS, "OCCUPANCY_RATE",
        "AVG_STAFFING_RATIO", "STAFFING_PRESSURE_INDEX",
    ),
    "quality_metrics": (*RATINGS, "FACILITY_QUALITY_SCORE"),
    "top_patient_volume": ("TOTAL_PATIENT_DAYS",),
}
GOLD_TABLES = tuple(GOLD_NUMBERS)
GOLD_SCHEMAS = {
    name: _table(
        text=[c for c in FACILITY_KEYS if c not in GOLD_PARTITIONS[name]],
        numbers=GOLD_NUMBERS[name],
        ints=("YEAR", "MONTH"),
        partitions=GOLD_PARTITIONS[name],
    )
    for name in GOLD_TABLES
}
