"""Table schemas and column groups.

Fixed values: the names and types below are the layout of the source files and
of the published feature table, so they are written out as plain text.
"""

from __future__ import annotations

SUBJECT = "SUBJECT_ID"
ADMISSION = "HADM_ID"
STAY = "ICUSTAY_ID"
TARGET = "LOS"
ID_COLUMNS = [SUBJECT, ADMISSION, STAY]
# Prepared outputs: one vector, or one array.
FEATURES, PREPARED = "features", "prepared"

RAW_TABLES: dict[str, str] = {
    "chartevents": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, ITEMID bigint, "
        "CHARTTIME timestamp, STORETIME timestamp, CGID bigint, VALUE string, VALUENUM double, "
        "VALUEUOM string, WARNING bigint, ERROR bigint, RESULTSTATUS string, STOPPED string"
    ),
    "icustays": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, DBSOURCE string, "
        "FIRST_CAREUNIT string, LAST_CAREUNIT string, FIRST_WARDID bigint, LAST_WARDID bigint, "
        "INTIME timestamp, OUTTIME timestamp, LOS double"
    ),
    "d_items": (
        "ROW_ID bigint, ITEMID bigint, LABEL string, ABBREVIATION string, DBSOURCE string, "
        "LINKSTO string, CATEGORY string, UNITNAME string, PARAM_TYPE string, CONCEPTID string"
    ),
    "patients": (
        "ROW_ID bigint, SUBJECT_ID bigint, GENDER string, DOB timestamp, DOD timestamp, "
        "DOD_HOSP timestamp, DOD_SSN timestamp, EXPIRE_FLAG bigint"
    ),
    "admissions": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ADMITTIME timestamp, DISCHTIME timestamp, "
        "DEATHTIME timestamp, ADMISSION_TYPE string, ADMISSION_LOCATION string, "
        "DISCHARGE_LOCATION string, INSURANCE string, LANGUAGE string, RELIGION string, "
        "MARITAL_STATUS string, ETHNICITY string, EDREGTIME timestamp, EDOUTTIME timestamp, "
        "DIAGNOSIS string, HOSPITAL_EXPIRE_FLAG bigint, HAS_CHARTEVENTS_DATA bigint"
    ),
    "labevents": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ITEMID bigint, CHARTTIME timestamp, "
        "VALUE string, VALUENUM double, VALUEUOM string, FLAG string"
    ),
    "d_labitems": (
        "ROW_ID bigint, ITEMID bigint, LABEL string, FLUID string, CATEGORY string, LOINC_CODE string"
    ),
    "outputevents": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, CHARTTIME timestamp, "
        "ITEMID bigint, VALUE double, VALUEUOM string, STORETIME timestamp, CGID bigint, "
        "STOPPED string, NEWBOTTLE bigint, ISERROR bigint"
    ),
    "inputevents_cv": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, CHARTTIME timestamp, "
        "ITEMID bigint, AMOUNT double, AMOUNTUOM string, RATE double, RATEUOM string, "
        "STORETIME timestamp, CGID bigint, ORDERID bigint, LINKORDERID bigint, STOPPED string, "
        "NEWBOTTLE bigint, ORIGINALAMOUNT double, ORIGINALAMOUNTUOM string, ORIGINALROUTE string, "
        "ORIGINALRATE double, ORIGINALRATEUOM string, ORIGINALSITE string"
    ),
    "inputevents_mv": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, STARTTIME timestamp, "
        "ENDTIME timestamp, ITEMID bigint, AMOUNT double, AMOUNTUOM string, RATE double, "
        "RATEUOM string, STORETIME timestamp, CGID bigint, ORDERID bigint, LINKORDERID bigint, "
        "ORDERCATEGORYNAME string, SECONDARYORDERCATEGORYNAME string, "
        "ORDERCOMPONENTTYPEDESCRIPTION string, ORDERCATEGORYDESCRIPTION string, "
        "PATIENTWEIGHT double, TOTALAMOUNT double, TOTALAMOUNTUOM string, ISOPENBAG bigint, "
        "CONTINUEINNEXTDEPT bigint, CANCELREASON bigint, STATUSDESCRIPTION string, "
        "COMMENTS_EDITEDBY string, COMMENTS_CANCELEDBY string, COMMENTS_DATE timestamp, "
        "ORIGINALAMOUNT double, ORIGINALRATE double"
    ),
    "prescriptions": (
        "ROW_ID bigint, SUBJECT_ID bigint, HADM_ID bigint, ICUSTAY_ID bigint, STARTDATE timestamp, "
        "ENDDATE timestamp, DRUG_TYPE string, DRUG string, DRUG_NAME_POE string, "
        "DRUG_NAME_GENERIC string, FORMULARY_DRUG_CD string, GSN string, NDC string, "
        "PROD_STRENGTH string, DOSE_VAL_RX string, DOSE_UNIT_RX string, FORM_VAL_DISP string, "
        "FORM_UNIT_DISP string, ROUTE string"
    ),
}

STAY_CATEGORIES = ["DBSOURCE", "FIRST_CAREUNIT", "LAST_CAREUNIT"]
ADMISSION_CATEGORIES = [
    "ADMISSION_TYPE",
    "ADMISSION_LOCATION",
    "INSURANCE",
    "LANGUAGE",
    "RELIGION",
    "MARITAL_STATUS",
    "ETHNICITY",
]

# Known only after the stay, therefore never a feature.
LEAKING_COLUMNS = [
    "OUTTIME",
    "DISCHTIME",
    "DEATHTIME",
    "DISCHARGE_LOCATION",
    "HOSPITAL_EXPIRE_FLAG",
    "DOD",
    "DOD_HOSP",
    "DOD_SSN",
]
