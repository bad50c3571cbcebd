"""Queries for scanning, linking, statistics, selection, features and reports."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sqltext as q
from checks.standins import MANY_CODES, STANDINS, standin_tables
from staylens import functions as fn
from staylens.operators import events as ev
from staylens.operators import quality as ql
from staylens.operators.pivot import pivot_features
from staylens.operators.stays import context_features, stay_windows, unit_table
from staylens.plans import features as ft
from staylens.schemas import ADMISSION_CATEGORIES, ID_COLUMNS, RAW_TABLES, STAY, STAY_CATEGORIES, TARGET
from staylens.session import new_path
from staylens.settings import CHART, DRUG, GROUPS, INPUT, LAB, OUTPUT, Settings
from staylens.sources import export_csv, load_projected, load_raw_tables, read_export
from staylens.sources.sinks import replace_table, write_report

HOURS = 24


def _stays(t):
    return unit_table(t["icustays"])


def _linked(t, family, hours=HOURS):
    return ev.link_in_window(ev.family_scan(t, family), stay_windows(_stays(t), hours), family.key)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Averages, deviations and sums depend on summation order in the last bits."""
    cells = []
    for c in df.columns:
        loose = c in q.ROUNDED or any(c.endswith(f"_{s}") for s in q.ROUNDED)
        cells.append(f"round(`{c}`, {digits}) AS `{c}`" if loose else f"`{c}`")
    return df.selectExpr(*cells)


def event_scan(spark, sf):
    t = standin_tables(spark, sf)
    return ev.event_scan(t["chartevents"], STAY, CHART.sources[0]).select(
        STAY, ev.ITEM, F.unix_micros(ev.TIME).alias("event_micros"), ev.VALUE
    )


def unit(spark, sf):
    t = standin_tables(spark, sf)
    return _stays(t).select(*ID_COLUMNS, *STAY_CATEGORIES, F.unix_micros("INTIME").alias("intime_micros"), F.round(TARGET, 9).alias(TARGET))


def window_link(spark, sf):
    t = standin_tables(spark, sf)
    return _linked(t, CHART).select(STAY, ev.ITEM, F.unix_micros(ev.TIME).alias("event_micros"), ev.VALUE)


def window_link_admission(spark, sf):
    t = standin_tables(spark, sf)
    return _linked(t, LAB).select(STAY, ev.ITEM, F.unix_micros(ev.TIME).alias("event_micros"), ev.VALUE)


def _stats_query(family):
    def run(spark, sf):
        t = standin_tables(spark, sf)
        return _rounded(ev.event_stats(_linked(t, family), family.stats))

    return run


def drug_features(spark, sf):
    t = standin_tables(spark, sf)
    return ev.drug_counts(_linked(t, DRUG))


def _top_query(family, variant=None):
    def run(spark, sf):
        return ft.selected_codes(standin_tables(spark, sf, variant), family)

    return run


def merge_stats(spark, sf):
    t = standin_tables(spark, sf)
    daily = ev.summarise(_linked(t, CHART).withColumn("day", F.to_date(ev.TIME)), [STAY, ev.ITEM, "day"])
    return _rounded(ev.merge_stats(daily, [STAY, ev.ITEM]))


def _cells(df: DataFrame) -> DataFrame:
    """Every cell of a wide table as (ICUSTAY_ID, feature, number, text), NULLs too."""
    kinds = {c: kind for c, kind in df.dtypes if c != STAY}
    numbers = [c for c, kind in kinds.items() if kind != "string"]
    texts = [c for c, kind in kinds.items() if kind == "string"]
    every = [F.col(f"`{c}`").cast("double") for c in numbers] + [F.lit(None).cast("double")] * len(texts)
    names = F.array(*[F.lit(c) for c in numbers + texts])
    text = F.get(F.col("texts"), F.col("at") - len(numbers)) if texts else F.lit(None)
    cells = df.select(STAY, F.array(*[F.col(c) for c in texts]).alias("texts"), F.posexplode(F.array(*every)).alias("at", "number"))
    return cells.select(
        STAY, F.get(names, F.col("at")).alias("feature"), F.round("number", 6).alias("number"), text.cast("string").alias("text")
    )


def _cells_query(group, name=None, settings=Settings()):
    def run(spark, sf):
        return _cells(ft.build_features(standin_tables(spark, sf, name), group, settings).features)

    return run


def pivot_query(spark, sf):
    t = standin_tables(spark, sf)
    group = ft.GROUPS["7"]
    windows = stay_windows(_stays(t), HOURS)
    long = ft.long_statistics(t, group, windows, Settings())
    selected, _ = ft.select_features(long, group, Settings())
    return _cells(pivot_features(long, selected))


def context_query(spark, sf):
    t = standin_tables(spark, sf)
    out = context_features(_stays(t), t["patients"], t["admissions"])
    return out.withColumn(TARGET, F.round(TARGET, 9))


def age_exact(spark, sf):
    t = standin_tables(spark, sf)
    out = context_features(
        unit_table(t["icustays"], "strip"), t["patients"], t["admissions"], age_mode="exact", category_mode="strip"
    )
    return out.withColumn(TARGET, F.round(TARGET, 9))


def _features_query(group):
    def run(spark, sf):
        run_ = ft.build_features(standin_tables(spark, sf), group)
        return _rounded(run_.features.withColumn(TARGET, F.round(TARGET, 9)))

    return run


def quality_5(spark, sf):
    t = standin_tables(spark, sf)
    return ql.quality_base(t, ft.build_features(t, "5"))


def replace_table_query(spark, sf):
    """The stays, written over an older table and read again."""
    rows, path = unit(spark, sf), new_path(spark, "replaced")
    replace_table(rows.limit(1), path)
    return replace_table(rows, path)


def write_report_query(spark, sf):
    """A small report as CSV, read again."""
    path = new_path(spark, "report")
    write_report(stays_per_patient(spark, sf), path)
    return spark.read.option("header", True).schema("metric string, value double").csv(path)


def quality_more(spark, sf):
    t = standin_tables(spark, sf)
    out = None
    for group in ("7", "9", "more"):
        part = ql.quality_group(ft.build_features(t, group)).select(F.lit(group).alias("table_group"), "metric", "value")
        out = part if out is None else out.unionByName(part)
    return out


def quality_local(spark, sf):
    t = standin_tables(spark, sf)
    return ql.quality_local(t, ft.build_features(t, "5"))


def missing_rates(spark, sf):
    run = ft.build_features(standin_tables(spark, sf), "5")
    return ql.missing_rates(run.features).withColumn("missing_rate", F.round("missing_rate", 6))


def stays_per_patient(spark, sf):
    return ql.stays_per_patient(_stays(standin_tables(spark, sf)))


def target_summary(spark, sf):
    return ql.target_summary(_stays(standin_tables(spark, sf))).withColumn("value", F.round("value", 6))


def target_histogram(spark, sf):
    out = ql.target_histogram(_stays(standin_tables(spark, sf)))
    return out.select("bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"), "count")


SWEEP_HOURS = [6, 12, 24, 48]
EXPERIMENT_GROUPS = ["stays", "context", "labs", "5", "7", "inputs", "outputs", "9", "more"]


def window_sweep(spark, sf):
    runs = ft.sweep_features(standin_tables(spark, sf), ["5", "7"], SWEEP_HOURS, [2, 25], Settings())
    return ft.compare_sweep(spark, runs)


def experiment_sweep(spark, sf):
    """All table groups, windows and published limits, over more codes than these limits."""
    runs = ft.sweep_features(standin_tables(spark, sf, "many"), EXPERIMENT_GROUPS, SWEEP_HOURS, [25, 50, 100], Settings())
    return ft.compare_sweep(spark, runs)


def load_typed(spark, sf):
    """CSV written from the stand-ins, loaded with the fixed schemas, counted."""
    t = standin_tables(spark, sf)
    paths = {}
    for name in ("chartevents", "icustays", "prescriptions"):
        have = {c: F.col(c) for c in t[name].columns}
        if name == "chartevents":
            have["VALUENUM"] = fn.number(F.col("VALUENUM"))
        ddl = [f.split() for f in RAW_TABLES[name].split(", ")]
        full = t[name].select(*[have.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in ddl])
        paths[name] = new_path(spark, f"csv-{name}")
        export_csv(full, paths[name])
    loaded = load_raw_tables(spark, paths, new_path(spark, "raw"), only=list(paths))
    rows = None
    checks = {"chartevents": ("CHARTTIME", "VALUENUM"), "icustays": ("INTIME", "LOS"), "prescriptions": ("STARTDATE", "HADM_ID")}
    for name, (time, value) in checks.items():
        line = loaded[name].agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.unix_seconds(time)).alias("time_sum"),
            F.round(F.sum(F.col(value).cast("double")), 3).alias("value_sum"),
        ).select(F.lit(name).alias("table_name"), "rows", "time_sum", "value_sum")
        rows = line if rows is None else rows.unionByName(line)
    return rows


def load_projected_query(spark, sf):
    t = standin_tables(spark, sf)
    path = new_path(spark, "csv-projected")
    export_csv(t["admissions"].toDF(*[f" {c.lower()} " for c in t["admissions"].columns]), path)
    wanted = ["SUBJECT_ID", "HADM_ID", "ADMISSION_TYPE", "INSURANCE", "NOT_THERE"]
    raw = load_projected(spark, path, wanted, required=["SUBJECT_ID", "HADM_ID"], name="ADMISSIONS")
    return raw.select(
        F.col("SUBJECT_ID").cast("bigint").alias("SUBJECT_ID"),
        F.col("HADM_ID").cast("bigint").alias("HADM_ID"),
        "ADMISSION_TYPE",
        fn.category(F.col("INSURANCE"), "strip").alias("INSURANCE"),
    )


def export_features(spark, sf):
    run = ft.build_features(standin_tables(spark, sf), "5")
    path = new_path(spark, "csv-features")
    export_csv(run.features, path)
    back = read_export(spark, path, run.features.schema)
    return _rounded(back.withColumn(TARGET, F.round(TARGET, 9)))


QUERIES = {
    "event_scan": event_scan,
    "unit_table": unit,
    "window_link": window_link,
    "window_link_admission": window_link_admission,
    "event_stats": _stats_query(CHART),
    "lab_stats": _stats_query(LAB),
    "output_stats": _stats_query(OUTPUT),
    "input_stats": _stats_query(INPUT),
    "drug_features": drug_features,
    "top_codes": _top_query(CHART),
    "top_labs": _top_query(LAB),
    "top_outputs": _top_query(OUTPUT),
    "top_inputs": _top_query(INPUT),
    "top_drugs": _top_query(DRUG),
    "merge_stats": merge_stats,
    "pivot_features": pivot_query,
    "context_features": context_query,
    "age_exact": age_exact,
    "features_5": _features_query("5"),
    "features_7": _cells_query("7"),
    "features_9": _cells_query("9"),
    "features_more": _cells_query("more"),
    "features_9_empty": _cells_query("9", settings=Settings(top_n_output=0)),
    "replace_table": replace_table_query,
    "write_report": write_report_query,
    "features_5_cut": _cells_query("5", "many"),
    "features_more_cut": _cells_query("more", "many"),
    "top_codes_cut": _top_query(CHART, "many"),
    "top_outputs_cut": _top_query(OUTPUT, "many"),
    "top_inputs_cut": _top_query(INPUT, "many"),
    "quality_5": quality_5,
    "quality_more": quality_more,
    "quality_local": quality_local,
    "missing_rates": missing_rates,
    "stays_per_patient": stays_per_patient,
    "target_summary": target_summary,
    "target_histogram": target_histogram,
    "window_sweep": window_sweep,
    "experiment_sweep": experiment_sweep,
    "load_typed": load_typed,
    "load_projected": load_projected_query,
    "export_features": export_features,
}


# ---------------------------------------------------------------- comparison


def _stay_parts(*tables):
    return q.standin("icustays", *tables) + [q.unit_table()]


def _linked_parts(family, hours=HOURS):
    return _stay_parts(*q.FAMILY_TABLES[family]) + q.linked(family, hours)


def _family_stats_sql(family):
    final = "SELECT ICUSTAY_ID, ITEMID, " + ", ".join(f"{q.rounded(s, s)} AS {s}" for s in q.STATS[family]) + f" FROM {family}_stats"
    if family == "drug":
        final = "SELECT ICUSTAY_ID, stem AS DRUG_KEY, count, named FROM drug_stats"
    return q.cte(*_linked_parts(family), *q.family_stats(family)) + final


def _top_sql(family):
    parts = _linked_parts(family)
    if family == "drug":
        return q.cte(*parts, *q.top("drug")) + "SELECT * FROM drug_top"
    table, columns = q.DIMENSIONS[family]
    parts = parts + q.standin(table) + q.top(family)
    return q.cte(*parts) + f"SELECT t.*, {columns} FROM {family}_top t LEFT JOIN {table} USING (ITEMID)"


def _cells_sql(group):
    parts, final = q.feature_cells(group)
    return q.cte(*parts) + final


def _many(text):
    """The same SQL over the stand-ins with many codes."""
    for name, many in MANY_CODES.items():
        assert STANDINS[name] in text or name not in text
        text = text.replace(STANDINS[name], many)
    return text


def _metrics(rows):
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({v} AS DOUBLE) AS value{' FROM ' + s if s else ''}" for m, v, s in rows)


def _valid_chart():
    return (
        "valid",
        """SELECT ICUSTAY_ID, CHARTTIME, TRY_CAST(VALUENUM AS DOUBLE) AS VALUE FROM chartevents
WHERE ICUSTAY_ID IS NOT NULL AND CHARTTIME IS NOT NULL AND TRY_CAST(VALUENUM AS DOUBLE) IS NOT NULL""",
    )


def _quality_base_rows():
    any_link = "valid v JOIN stays s USING (ICUSTAY_ID)"
    return [
        ("window_hours", "24", ""),
        ("top_n_items", "50", ""),
        ("selected_items", "count(*)", "chart_top"),
        ("icustays_after_target_filter", "count(*)", "stays WHERE LOS IS NOT NULL"),
        ("patients_after_target_filter", "count(DISTINCT SUBJECT_ID)", "stays WHERE LOS IS NOT NULL"),
        ("preprocessed_rows", "count(*)", "final_features"),
        ("valid_numeric_chartevents", "count(*)", "valid"),
        ("chartevents_linked_to_icustay", "count(*)", any_link),
        ("chartevents_before_intime", "count_if(CHARTTIME < INTIME)", any_link),
        (
            "chartevents_in_prediction_window",
            "count_if(CHARTTIME >= INTIME AND CHARTTIME <= INTIME + INTERVAL '24' HOUR)",
            any_link,
        ),
        ("chartevents_after_prediction_window", "count_if(CHARTTIME > INTIME + INTERVAL '24' HOUR)", any_link),
    ]


CHART_CODES = (1, 2, 3, 4, 5)  # the stand-in maps event types to these items


def static_features_5() -> list[tuple[str, str]]:
    """The 5-table features with the five known items spelled out (no PIVOT)."""
    parts = q.features("5")
    columns = ", ".join(
        f"max(CASE WHEN ITEMID = {k} THEN {s} END) AS item_{k}_{s}" for k in CHART_CODES for s in q.STATS["chart"]
    )
    return parts + [
        ("chart_wide", f"SELECT ICUSTAY_ID, {columns} FROM chart_stats JOIN chart_top USING (ITEMID) GROUP BY ICUSTAY_ID"),
        ("final_features", "SELECT context.*, chart_wide.* EXCLUDE (ICUSTAY_ID) FROM context JOIN chart_wide USING (ICUSTAY_ID)"),
    ]


CONTEXT_COLUMNS = [*ID_COLUMNS, *STAY_CATEGORIES, TARGET, "GENDER", "AGE", *ADMISSION_CATEGORIES, "HAS_CHARTEVENTS_DATA", "ED_LOS_HOURS"]
ITEM_ROUNDED = ", ".join(f"round(item_{k}_{s}, 6) AS item_{k}_{s}" for k in CHART_CODES for s in ("mean", "std"))
ITEM_COLUMNS = [f"item_{k}_{s}" for k in CHART_CODES for s in q.STATS["chart"]]
FEATURE_COLUMNS = [c for c in CONTEXT_COLUMNS if c not in (*ID_COLUMNS, TARGET)] + ITEM_COLUMNS


def _missing_sql(columns, source="final_features"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", 1.0 - count({c}) / CAST(count(*) AS DOUBLE) AS missing_rate FROM {source}" for c in columns
    )


def _quality_group_rows(group):
    names = {"chart": "chart_items", "lab": "lab_items", "output": "output_items", "input": "input_items", "drug": "drugs"}
    families = q.GROUP_FAMILIES[group]
    rows = [] if group == "more" else [("version_tables", group, "")]
    rows.append(("window_hours", "24", ""))
    if group == "more":
        rows += [(f"top_n_{names[f]}", str(q.TOP_N[f]), "") for f in families]
    rows += [(f"selected_{names[f]}", "count(*)", f"{f}_top") for f in families]
    anchored = "context" if group == "more" else "context SEMI JOIN (SELECT ICUSTAY_ID FROM chart_stats JOIN chart_top USING (ITEMID)) c USING (ICUSTAY_ID)"
    return rows + [("preprocessed_rows", "count(*)", anchored)]


def _quality_more_sql():
    parts = q.features("more")
    body = " UNION ALL ".join(
        f"SELECT '{g}' AS table_group, metric, value FROM ({_metrics(_quality_group_rows(g))})" for g in ("7", "9", "more")
    )
    return q.cte(*parts) + body


def _sweep_sql(groups, hours, tops):
    """Every setting as a row of ``points``; cells, stays and checksums by joins with it."""
    families = list(dict.fromkeys(f.name for g in groups for f in GROUPS[g].families))
    parts = _stay_parts(*[t for f in families for t in q.FAMILY_TABLES[f]], "patients", "admissions") + q.context()
    parts.append(("hours", f"SELECT unnest({hours}) AS h"))
    cells, ranks = [], []
    for f in families:
        parts += q.linked(f, max(hours))
        parts.append((f"{f}_at", f"SELECT w.h, l.* FROM {f}_linked l JOIN hours w ON l.EVENT_TIME <= l.INTIME + w.h * INTERVAL '1' HOUR"))
        code, ranked = ("DRUG_NAME", "count_if(NAMED)") if f == "drug" else ("ITEMID", "count(*)")
        code = q.DRUG_KEY if f == "drug" else code
        columns = ", ".join(f"{q.STAT_SQL[s]} AS {s}" for s in q.STATS[f])
        parts.append((f"{f}_stats", f"SELECT h, ICUSTAY_ID, {code} AS code, {columns}, {ranked} AS ranked FROM {f}_at GROUP BY ALL"))
        cells += [f"SELECT '{f}' AS family, h, ICUSTAY_ID, CAST(code AS VARCHAR) AS code, '{s}' AS stat, CAST({s} AS DOUBLE) AS v FROM {f}_stats" for s in q.STATS[f]]
        ranks.append(
            f"""SELECT '{f}' AS family, h, CAST(code AS VARCHAR) AS code, CAST(sum(ranked) AS BIGINT) AS c,
  row_number() OVER (PARTITION BY h ORDER BY sum(ranked) DESC, code) AS place FROM {f}_stats GROUP BY h, code HAVING sum(ranked) > 0"""
        )
    texts = {g: [*STAY_CATEGORIES] + (["GENDER", *ADMISSION_CATEGORIES] if GROUPS[g].context else []) for g in groups}
    numbers = {g: ["LOS"] + (["AGE", "HAS_CHARTEVENTS_DATA", "ED_LOS_HOURS"] if GROUPS[g].context else []) for g in groups}
    shape = ", ".join(f"('{g}', {n}, {GROUPS[g].needs_chart}, {3 + len(texts[g]) + len(numbers[g])})" for g in groups for n in tops)
    points = ", ".join(
        f"('{g}', {n}, '{f.name}', '{'' if f.name == 'drug' else GROUPS[g].prefix(f.name) + '_'}', {n if f.name == 'chart' else q.TOP_N[f.name]})"
        for g in groups for n in tops for f in GROUPS[g].families
    )
    stats = ", ".join(f"('{f}', '{s}')" for f in families for s in q.STATS[f])
    hashed = "CAST(('0x' || substr(md5({c}), 1, 4)) AS BIGINT)"
    context = [
        f"SELECT '{g}' AS g, ICUSTAY_ID, {_weight(c)} AS w, {value} AS v FROM context"
        for g in groups
        for c, value in [(c, f"CAST({hashed.format(c=c)} AS DOUBLE)") for c in texts[g]] + [(c, f"CAST({c} AS DOUBLE)") for c in numbers[g]]
    ]
    prime, offset = ft.CHECK_PRIME, ft.CHECK_OFFSET
    cell = f"((CAST(floor(v * 1000 + {offset}) AS BIGINT) % {prime}) + {prime}) % {prime}"
    parts += [
        ("cells", " UNION ALL ".join(cells)),
        ("ranked", " UNION ALL ".join(ranks)),
        ("shape", f"SELECT * FROM (VALUES {shape}) t(g, n, anchored, context_columns)"),
        ("points", f"SELECT * FROM (VALUES {points}) t(g, n, family, prefix, most)"),
        ("chosen", "SELECT p.g, p.n, r.h, p.family, p.prefix, r.code, r.c FROM points p JOIN ranked r ON r.family = p.family AND r.place <= p.most"),
        ("chosen_stats", f"SELECT c.*, s.stat, {hashed.format(c='concat(c.prefix, c.code, chr(95), s.stat)')} AS w FROM chosen c JOIN (VALUES {stats}) s(family, stat) USING (family)"),
        ("anchors", "SELECT DISTINCT c.g, c.n, c.h, x.ICUSTAY_ID FROM chosen c JOIN cells x USING (family, h, code) WHERE c.family = 'chart'"),
        (
            "kept",
            """SELECT s.g, s.n, w.h, c.ICUSTAY_ID FROM shape s CROSS JOIN hours w CROSS JOIN context c WHERE NOT s.anchored
UNION ALL SELECT a.g, a.n, a.h, a.ICUSTAY_ID FROM anchors a JOIN shape s ON s.g = a.g AND s.n = a.n AND s.anchored SEMI JOIN context c ON c.ICUSTAY_ID = a.ICUSTAY_ID""",
        ),
        ("context_cells", " UNION ALL ".join(context)),
        (
            "weighed",
            f"""SELECT k.g, k.n, k.h, k.ICUSTAY_ID, ({cell}) * w AS x FROM kept k JOIN context_cells c ON c.g = k.g AND c.ICUSTAY_ID = k.ICUSTAY_ID WHERE v IS NOT NULL
UNION ALL SELECT k.g, k.n, k.h, k.ICUSTAY_ID, ({cell}) * w FROM chosen_stats c JOIN cells x USING (family, h, code, stat)
JOIN kept k ON k.g = c.g AND k.n = c.n AND k.h = c.h AND k.ICUSTAY_ID = x.ICUSTAY_ID WHERE v IS NOT NULL""",
        ),
        ("stay_sums", f"SELECT g, n, h, ICUSTAY_ID, count(*) AS cells, (sum(x) * (ICUSTAY_ID % 1009 + 1)) % {prime} AS x FROM weighed GROUP BY g, n, h, ICUSTAY_ID"),
        ("sums", "SELECT g, n, h, sum(cells) AS cells, sum(x) AS checksum FROM stay_sums GROUP BY g, n, h"),
        ("sizes", "SELECT g, n, h, count(*) AS rows FROM kept GROUP BY g, n, h"),
        ("codes", "SELECT g, n, h, count(*) AS codes, sum(c) AS events FROM chosen GROUP BY g, n, h"),
        ("widths", "SELECT g, n, h, count(*) AS columns FROM chosen_stats GROUP BY g, n, h"),
        ("blanks", "SELECT p.g, p.n, w.h, count(*) AS columns FROM points p CROSS JOIN hours w ANTI JOIN chosen c ON c.g = p.g AND c.n = p.n AND c.h = w.h AND c.family = p.family GROUP BY p.g, p.n, w.h"),
    ]
    whole = lambda e, name: f"CAST(coalesce({e}, 0) AS BIGINT) AS {name}"
    return q.cte(*parts) + f"""SELECT s.g AS table_group, w.h AS window_hours, s.n AS top_n, {whole('z.rows', 'rows')},
  {whole('s.context_columns + coalesce(d.columns, 0) + coalesce(b.columns, 0)', 'columns')}, {whole('o.codes', 'codes')}, {whole('o.events', 'events')},
  {whole('m.cells', 'cells')}, {whole('m.checksum', 'checksum')}
FROM shape s CROSS JOIN hours w LEFT JOIN sizes z ON (z.g, z.n, z.h) = (s.g, s.n, w.h) LEFT JOIN codes o ON (o.g, o.n, o.h) = (s.g, s.n, w.h)
LEFT JOIN widths d ON (d.g, d.n, d.h) = (s.g, s.n, w.h) LEFT JOIN blanks b ON (b.g, b.n, b.h) = (s.g, s.n, w.h) LEFT JOIN sums m ON (m.g, m.n, m.h) = (s.g, s.n, w.h)"""


def _weight(column):
    return int(hashlib.md5(column.encode()).hexdigest()[:4], 16)


def _pivot_sql():
    parts, cells = _stay_parts("chartevents", "labevents"), []
    for f in ("chart", "lab"):
        parts += q.linked(f) + q.family_stats(f) + q.top(f)
        cells += q._family_cells(f, f, "kept")
    kept = " UNION ".join(f"SELECT ICUSTAY_ID FROM {f}_stats JOIN {f}_top USING (ITEMID)" for f in ("chart", "lab"))
    parts.append(("kept", kept))
    columns = "SELECT ICUSTAY_ID, feature, number, CAST(text AS VARCHAR) AS text"
    return q.cte(*parts) + f"{columns} FROM ({' UNION ALL '.join(cells)})"


def _load_typed_sql():
    lines = []
    for name, time, value in (
        ("chartevents", "CHARTTIME", "TRY_CAST(VALUENUM AS DOUBLE)"),
        ("icustays", "INTIME", "LOS"),
        ("prescriptions", "STARTDATE", "CAST(HADM_ID AS DOUBLE)"),
    ):
        seconds = f"CAST(floor(epoch_us({time}) / 1000000.0) AS BIGINT)"
        lines.append(
            f"SELECT '{name}' AS table_name, count(*) AS rows, CAST(sum({seconds}) AS BIGINT) AS time_sum, round(sum({value}), 3) AS value_sum FROM {name}"
        )
    return q.cte(*q.standin("chartevents", "icustays", "prescriptions")) + " UNION ALL ".join(lines)


def oracles() -> dict[str, str]:
    base5 = static_features_5()
    out = {
        "event_scan": q.cte(*q.standin("chartevents"), _valid_chart())
        + "SELECT ICUSTAY_ID, CAST(ITEMID AS BIGINT) AS ITEMID, epoch_us(EVENT_TIME) AS event_micros, VALUE FROM ("
        + q.EVENT_SQL["chart"]
        + ") WHERE VALUE IS NOT NULL AND NOT isnan(VALUE)",
        "unit_table": q.cte(*_stay_parts()) + "SELECT * EXCLUDE (INTIME) REPLACE (round(LOS, 9) AS LOS), epoch_us(INTIME) AS intime_micros FROM stays",
        "merge_stats": q.cte(*_linked_parts("chart"))
        + "SELECT ICUSTAY_ID, CAST(ITEMID AS BIGINT) AS ITEMID, "
        + ", ".join(f"{q.rounded(s, e)} AS {s}" for s, e in q.STAT_SQL.items())
        + " FROM chart_linked GROUP BY ALL",
        "pivot_features": _pivot_sql(),
        "context_features": q.cte(*_stay_parts("patients", "admissions"), *q.context())
        + "SELECT * REPLACE (round(LOS, 9) AS LOS) FROM context",
        "age_exact": q.cte(*q.standin("icustays", "patients", "admissions"), q.unit_table("strip"), *q.context("strip", "exact"))
        + "SELECT * REPLACE (round(LOS, 9) AS LOS) FROM context",
        "quality_5": q.cte(*base5, _valid_chart()) + _metrics(_quality_base_rows()),
        "quality_more": _quality_more_sql(),
        "quality_local": q.cte(*base5, _valid_chart())
        + _metrics(
            _quality_base_rows()
            + [
                ("preprocessed_columns", str(len(CONTEXT_COLUMNS) + len(ITEM_COLUMNS)), ""),
                ("model_feature_columns", str(len(FEATURE_COLUMNS)), ""),
                ("icustays_with_chart_features", "count(DISTINCT ICUSTAY_ID)", "final_features"),
                (
                    "icustays_without_chart_features",
                    "(SELECT count(*) FROM stays WHERE LOS IS NOT NULL) - count(DISTINCT ICUSTAY_ID)",
                    "final_features",
                ),
            ]
        )
        + f""" UNION ALL SELECT concat('missing_rate_top25.', "column"), round(missing_rate, 6) FROM
(SELECT * FROM ({_missing_sql(FEATURE_COLUMNS)}) ORDER BY missing_rate DESC, "column" LIMIT 25)""",
        "missing_rates": q.cte(*base5)
        + f'SELECT "column", round(missing_rate, 6) AS missing_rate FROM ({_missing_sql(CONTEXT_COLUMNS + ITEM_COLUMNS)})',
        "stays_per_patient": q.cte(*_stay_parts(), ("per", "SELECT SUBJECT_ID, count(DISTINCT ICUSTAY_ID) AS n FROM stays GROUP BY SUBJECT_ID"))
        + _metrics(
            [
                ("patients", "count(*)", "per"),
                ("patients_with_several_stays", "count_if(n > 1)", "per"),
                ("max_stays_of_one_patient", "max(n)", "per"),
            ]
        ),
        "target_summary": q.cte(*_stay_parts())
        + "SELECT metric, round(value, 6) AS value FROM ("
        + _metrics(
            [
                ("count", "count(LOS)", "stays"),
                ("mean", "avg(LOS)", "stays"),
                ("std", "stddev_samp(LOS)", "stays"),
                ("min", "min(LOS)", "stays"),
                ("max", "max(LOS)", "stays"),
                ("25%", "quantile_cont(LOS, 0.25)", "stays"),
                ("50%", "quantile_cont(LOS, 0.5)", "stays"),
                ("75%", "quantile_cont(LOS, 0.75)", "stays"),
            ]
        )
        + ")",
        "target_histogram": q.cte(
            *_stay_parts(),
            ("edge", "SELECT min(LOS) AS lo, (max(LOS) - min(LOS)) / 40 AS w FROM stays"),
            ("hit", "SELECT CAST(least(floor((LOS - lo) / w), 39) AS INT) AS bin, count(*) AS n FROM stays, edge WHERE LOS IS NOT NULL GROUP BY ALL"),
        )
        + """SELECT CAST(i AS INT) AS bin, round(lo + i * w, 6) AS bin_start, round(lo + (i + 1) * w, 6) AS bin_end, coalesce(n, 0) AS count
FROM range(40) r(i) CROSS JOIN edge LEFT JOIN hit ON hit.bin = r.i""",
        "window_sweep": _sweep_sql(["5", "7"], SWEEP_HOURS, [2, 25]),
        "load_typed": _load_typed_sql(),
        "load_projected": q.cte(*q.standin("admissions"))
        + f"SELECT SUBJECT_ID, HADM_ID, ADMISSION_TYPE, {q.category('INSURANCE', 'strip')} AS INSURANCE FROM admissions",
        # NULL and the empty text stay apart in the export.
        "export_features": q.cte(*base5)
        + f"SELECT * REPLACE (round(LOS, 9) AS LOS, {ITEM_ROUNDED}) FROM final_features",
        "features_5": q.cte(*base5) + f"SELECT * REPLACE (round(LOS, 9) AS LOS, {ITEM_ROUNDED}) FROM final_features",
    }
    for key, family in (("window_link", "chart"), ("window_link_admission", "lab")):
        out[key] = q.cte(*_linked_parts(family)) + (
            f"SELECT ICUSTAY_ID, CAST(ITEMID AS BIGINT) AS ITEMID, epoch_us(EVENT_TIME) AS event_micros, VALUE FROM {family}_linked"
        )
    for key, family in (("event_stats", "chart"), ("lab_stats", "lab"), ("output_stats", "output"), ("input_stats", "input"), ("drug_features", "drug")):
        out[key] = _family_stats_sql(family)
    for key, family in (("top_codes", "chart"), ("top_labs", "lab"), ("top_outputs", "output"), ("top_inputs", "input"), ("top_drugs", "drug")):
        out[key] = _top_sql(family)
    for group in ("7", "9", "more"):
        out[f"features_{group}"] = _cells_sql(group)
    out["replace_table"], out["write_report"] = out["unit_table"], out["stays_per_patient"]
    limit = f"LIMIT {q.TOP_N['output']}"
    parts, final = q.feature_cells("9")
    parts = [(n, t.replace(limit, "LIMIT 0") if n == "output_top" else t) for n, t in parts]
    out["features_9_empty"] = q.cte(*parts) + final
    for group in ("5", "more"):
        out[f"features_{group}_cut"] = _many(_cells_sql(group))
    for key, family in (("top_codes_cut", "chart"), ("top_outputs_cut", "output"), ("top_inputs_cut", "input")):
        out[key] = _many(_top_sql(family))
    out["experiment_sweep"] = _many(_sweep_sql(EXPERIMENT_GROUPS, SWEEP_HOURS, [25, 50, 100]))
    return out
