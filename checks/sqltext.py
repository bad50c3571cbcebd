"""Building blocks of the comparison SQL (DuckDB dialect)."""

from __future__ import annotations

from checks.standins import STANDINS
from staylens.schemas import ADMISSION_CATEGORIES, STAY_CATEGORIES

NUMERIC_VALUE = "TRY_CAST({c} AS DOUBLE)"


def cte(*parts: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts) + "\n"


def standin(*names: str) -> list[tuple[str, str]]:
    return [(n, STANDINS[n]) for n in names]


def unit_table(mode: str = "plain") -> tuple[str, str]:
    cats = ", ".join(f"{category(c, mode)} AS {c}" for c in STAY_CATEGORIES)
    return (
        "stays",
        f"""SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, {cats}, INTIME,
  COALESCE(LOS, datesub('second', INTIME, OUTTIME) / 86400.0) AS LOS
FROM icustays WHERE ICUSTAY_ID IS NOT NULL AND INTIME IS NOT NULL""",
    )


def category(c: str, mode: str = "plain") -> str:
    return f"upper(coalesce({c}, 'UNKNOWN'))" if mode == "plain" else f"upper(coalesce(nullif(trim({c}), ''), 'UNKNOWN'))"


EVENT_SQL = {
    "chart": "SELECT ICUSTAY_ID, ITEMID, CHARTTIME AS EVENT_TIME, TRY_CAST(VALUENUM AS DOUBLE) AS VALUE FROM chartevents",
    "lab": "SELECT HADM_ID, ITEMID, CHARTTIME AS EVENT_TIME, VALUENUM AS VALUE FROM labevents",
    "output": "SELECT ICUSTAY_ID, ITEMID, CHARTTIME AS EVENT_TIME, VALUE FROM outputevents",
    "input": """SELECT ICUSTAY_ID, ITEMID, CHARTTIME AS EVENT_TIME, AMOUNT AS VALUE FROM inputevents_cv
UNION ALL SELECT ICUSTAY_ID, ITEMID, STARTTIME AS EVENT_TIME, AMOUNT AS VALUE FROM inputevents_mv""",
    "drug": """SELECT HADM_ID, STARTDATE AS EVENT_TIME, coalesce(DRUG, DRUG_NAME_GENERIC) IS NOT NULL AS NAMED,
  upper(trim(coalesce(DRUG, DRUG_NAME_GENERIC, 'UNKNOWN'))) AS DRUG_NAME FROM prescriptions""",
}
FAMILY_TABLES = {
    "chart": ("chartevents",),
    "lab": ("labevents",),
    "output": ("outputevents",),
    "input": ("inputevents_cv", "inputevents_mv"),
    "drug": ("prescriptions",),
}
DIMENSIONS = {
    "chart": ("d_items", "LABEL, CATEGORY, UNITNAME"),
    "lab": ("d_labitems", "LABEL, FLUID, CATEGORY"),
    "output": ("d_items", "LABEL, CATEGORY, UNITNAME"),
    "input": ("d_items", "LABEL, CATEGORY, UNITNAME"),
}
KEYS = {"chart": "ICUSTAY_ID", "lab": "HADM_ID", "output": "ICUSTAY_ID", "input": "ICUSTAY_ID", "drug": "HADM_ID"}
TOP_N = {"chart": 50, "lab": 30, "output": 20, "input": 30, "drug": 30}
DRUG_KEY = "substr(concat('drug_', regexp_replace(lower(DRUG_NAME), '[^a-z0-9]+', '_', 'g')), 1, 100)"


def linked(family: str, hours: int = 24) -> list[tuple[str, str]]:
    """Stand-ins, stays and the events of a family inside the window."""
    key = KEYS[family]
    what = "e.NAMED, e.DRUG_NAME" if family == "drug" else "e.ITEMID, e.VALUE"
    valid = "" if family == "drug" else "AND e.ITEMID IS NOT NULL AND e.VALUE IS NOT NULL AND NOT isnan(e.VALUE)"
    return [
        (
            f"{family}_linked",
            f"""SELECT s.ICUSTAY_ID, {what}, e.EVENT_TIME, s.INTIME FROM ({EVENT_SQL[family]}) e JOIN stays s ON e.{key} = s.{key}
WHERE e.EVENT_TIME >= s.INTIME AND e.EVENT_TIME <= s.INTIME + INTERVAL '{hours}' HOUR {valid}""",
        )
    ]


LAST = "arg_max(VALUE, row(EVENT_TIME, VALUE))"
STAT_SQL = {
    "mean": "avg(VALUE)",
    "min": "min(VALUE)",
    "max": "max(VALUE)",
    "std": "stddev_samp(VALUE)",
    "sum": "sum(VALUE)",
    "count": "count(*)",
    "last": LAST,
}
STATS = {
    "chart": ("mean", "min", "max", "std", "count", "last"),
    "lab": ("mean", "min", "max", "std", "count", "last"),
    "output": ("sum", "count", "last"),
    "input": ("sum", "mean", "count", "last"),
    "drug": ("count",),
}
ROUNDED = {"mean", "std", "sum"}


def rounded(stat: str, expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits})" if stat in ROUNDED else expression


def family_stats(family: str) -> list[tuple[str, str]]:
    if family == "drug":
        return [
            (
                "drug_stats",
                f"""SELECT ICUSTAY_ID, {DRUG_KEY} AS stem, count(*) AS count, CAST(count_if(NAMED) AS BIGINT) AS named
FROM drug_linked GROUP BY ALL""",
            )
        ]
    columns = ", ".join(f"{STAT_SQL[s]} AS {s}" for s in STATS[family])
    return [(f"{family}_stats", f"SELECT ICUSTAY_ID, ITEMID, {columns} FROM {family}_linked GROUP BY ALL")]


def top(family: str) -> list[tuple[str, str]]:
    if family == "drug":
        return [
            (
                "drug_top",
                f"""SELECT DRUG_KEY, list_slice(list_sort(list_distinct(list(DRUG_NAME))), 1, 5) AS DRUG_NAMES,
  count(*) AS prescription_count
FROM (SELECT DRUG_NAME, {DRUG_KEY} AS DRUG_KEY FROM drug_linked WHERE NAMED) GROUP BY DRUG_KEY
ORDER BY prescription_count DESC, DRUG_KEY LIMIT {TOP_N['drug']}""",
            )
        ]
    return [
        (
            f"{family}_top",
            f"""SELECT ITEMID, count(*) AS event_count FROM {family}_linked GROUP BY ITEMID
ORDER BY event_count DESC, ITEMID LIMIT {TOP_N[family]}""",
        )
    ]


def context(mode: str = "plain", age: str = "boundary") -> list[tuple[str, str]]:
    years = "(year(s.INTIME) - year(p.DOB))"
    if age == "exact":
        years = f"""({years} - CASE WHEN month(s.INTIME) < month(p.DOB)
  OR (month(s.INTIME) = month(p.DOB) AND day(s.INTIME) < day(p.DOB)) THEN 1 ELSE 0 END)"""
    cats = ", ".join(f"{category(c, mode)} AS {c}" for c in ADMISSION_CATEGORIES)
    names = ", ".join(f"a.{c}" for c in ADMISSION_CATEGORIES)
    return [
        (
            "patient_context",
            f"SELECT SUBJECT_ID, {category('GENDER', mode)} AS GENDER, CAST(DOB AS DATE) AS DOB FROM patients",
        ),
        (
            "admission_context",
            f"""SELECT SUBJECT_ID, HADM_ID, {cats}, TRY_CAST(HAS_CHARTEVENTS_DATA AS BIGINT) AS HAS_CHARTEVENTS_DATA,
  datesub('second', EDREGTIME, EDOUTTIME) / 3600.0 AS ED_LOS_HOURS FROM admissions""",
        ),
        (
            "context",
            f"""SELECT s.SUBJECT_ID, s.HADM_ID, s.ICUSTAY_ID, s.DBSOURCE, s.FIRST_CAREUNIT, s.LAST_CAREUNIT, s.LOS, p.GENDER,
  CAST(CASE WHEN {years} > 120 THEN 90 WHEN {years} < 0 THEN NULL ELSE {years} END AS BIGINT) AS AGE,
  {names}, a.HAS_CHARTEVENTS_DATA, a.ED_LOS_HOURS
FROM stays s LEFT JOIN patient_context p USING (SUBJECT_ID)
LEFT JOIN admission_context a ON a.SUBJECT_ID = s.SUBJECT_ID AND a.HADM_ID = s.HADM_ID
WHERE s.LOS IS NOT NULL""",
        ),
    ]


GROUP_FAMILIES = {
    "5": ("chart",),
    "7": ("chart", "lab"),
    "9": ("chart", "lab", "output", "drug"),
    "more": ("chart", "lab", "output", "input", "drug"),
}


def feature_cells(group: str) -> tuple[list[tuple[str, str]], str]:
    """CTEs and SELECT of every cell (ICUSTAY_ID, feature, number, text) of a feature table.

    Each kept stay meets each selected code, so cells without events are NULL rows.
    """
    families = GROUP_FAMILIES[group]
    tables = [t for f in families for t in FAMILY_TABLES[f]]
    parts = standin("icustays", *dict.fromkeys(tables), "patients", "admissions") + [unit_table()] + context()
    for f in families:
        parts += linked(f) + family_stats(f) + top(f)
    anchor = "" if group == "more" else "SEMI JOIN (SELECT ICUSTAY_ID FROM chart_stats JOIN chart_top USING (ITEMID)) c USING (ICUSTAY_ID)"
    parts.append(("kept", f"SELECT * FROM context {anchor}"))
    cells = [
        f"SELECT ICUSTAY_ID, '{c}' AS feature, CAST(NULL AS DOUBLE) AS number, {c} AS text FROM kept"
        for c in ("DBSOURCE", *STAY_CATEGORIES[1:], "GENDER", *ADMISSION_CATEGORIES)
    ]
    cells += [
        f"SELECT ICUSTAY_ID, '{c}', round(CAST({c} AS DOUBLE), 6), NULL FROM kept"
        for c in ("SUBJECT_ID", "HADM_ID", "LOS", "AGE", "HAS_CHARTEVENTS_DATA", "ED_LOS_HOURS")
    ]
    for f in families:
        prefix = "item" if group == "5" and f == "chart" else f
        cells.append(f"SELECT ICUSTAY_ID, 'no_{f}_features', NULL, NULL FROM kept WHERE NOT EXISTS (SELECT 1 FROM {f}_top)")
        cells += _family_cells(f, prefix, "kept")
    return parts, " UNION ALL ".join(cells)


def _family_cells(family: str, prefix: str, stays: str) -> list[str]:
    code = "DRUG_KEY" if family == "drug" else "ITEMID"
    own = "stem" if family == "drug" else "ITEMID"
    stem = "t.DRUG_KEY" if family == "drug" else f"concat('{prefix}_', t.ITEMID)"
    return [
        f"""SELECT k.ICUSTAY_ID, concat({stem}, '_{s}') AS feature, round(CAST(x.{s} AS DOUBLE), 6) AS number, NULL AS text
FROM {stays} k CROSS JOIN {family}_top t LEFT JOIN {family}_stats x ON x.ICUSTAY_ID = k.ICUSTAY_ID AND x.{own} = t.{code}"""
        for s in STATS[family]
    ]


def features(group: str, mode: str = "plain") -> list[tuple[str, str]]:
    """CTEs of a feature table up to the statistics and selected codes."""
    families = GROUP_FAMILIES[group]
    tables = [t for f in families for t in FAMILY_TABLES[f]]
    parts = standin("icustays", *dict.fromkeys(tables), "patients", "admissions") + [unit_table(mode)] + context(mode)
    for f in families:
        parts += linked(f) + family_stats(f) + top(f)
    return parts
