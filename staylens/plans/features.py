"""Feature tables: from raw tables to one row per stay."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import functions as fn
from staylens.operators import events as ev
from staylens.operators import selection as sel
from staylens.operators.pivot import Feature, empty_family, pivot_features
from staylens.operators.quality import quality_base, quality_group
from staylens.operators.stays import StayWindows, assert_unique, context_features, stay_windows, unit_table
from staylens.schemas import ADMISSION, ID_COLUMNS, STAY, SUBJECT
from staylens.session import fine_shuffles, keep
from staylens.settings import FAMILIES, GROUPS, Family, Settings, TableGroup
from staylens.sources.sinks import export_csv, replace_table, write_report

ALL_STATS = ("mean", "min", "max", "std", "sum", "count", "last")
MICROS_PER_HOUR = 3_600_000_000
CHART_RANK = "_chart_rank"
CHECK_PRIME = 1_000_003
CHECK_OFFSET = 0.2371
SWEEP_LINE = "table_group string, window_hours int, top_n int, rows bigint, columns bigint, codes bigint, events bigint, cells bigint, checksum bigint"
UNIQUE_KEYS = {"icustays": [STAY], "patients": [SUBJECT], "admissions": [SUBJECT, ADMISSION]}


@dataclass(frozen=True)
class FeatureRun:
    """A feature table together with the tables it was made from."""

    group: TableGroup
    settings: Settings
    features: DataFrame
    long: DataFrame
    selected: list[Feature]
    counts: dict[tuple[str, str], int]
    windows: StayWindows
    stays: DataFrame

    def selected_in(self, family: str) -> list[Feature]:
        return [f for f in self.selected if f.family == family]


def _long_form(stats: DataFrame, family: Family, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per-stay statistics of one family in the shape all families share."""
    if family.name == "drug":
        code, ranked = F.col("DRUG_KEY"), F.col("named")
    else:
        code, ranked = F.col(ev.ITEM).cast("string"), F.col("count")
    have = set(stats.columns)
    kinds = {"count": "bigint"}
    return stats.select(
        F.lit(family.name).alias("family"),
        STAY,
        code.alias("code"),
        *[
            (F.col(s) if s in have else F.lit(None).cast(kinds.get(s, "double"))).alias(s)
            for s in ALL_STATS
        ],
        ranked.alias("ranked"),
        *extra,
    )


def _no_statistics(spark: SparkSession) -> DataFrame:
    stats = ", ".join(f"{s} {'bigint' if s == 'count' else 'double'}" for s in ALL_STATS)
    return spark.createDataFrame([], f"family string, {STAY} bigint, code string, {stats}, ranked bigint")


def family_statistics(
    tables: Mapping[str, DataFrame], family: Family, windows: StayWindows, settings: Settings
) -> DataFrame:
    """Scan, link and aggregate one family; nothing runs yet."""
    linked = ev.link_in_window(ev.family_scan(tables, family), windows, family.key, settings.limits)
    if family.name == "drug":
        return _long_form(ev.drug_counts(linked), family)
    return _long_form(ev.event_stats(linked, family.stats), family)


def long_statistics(
    tables: Mapping[str, DataFrame], group: TableGroup, windows: StayWindows, settings: Settings
) -> DataFrame:
    """Statistics of every (family, stay, code), written once.

    One job reads each event table a single time. Code selection, the pivot and
    the reports all continue from this table, which is orders of magnitude
    smaller than the events.
    """
    if not group.families:
        return _no_statistics(windows.df.sparkSession)
    parts = [family_statistics(tables, f, windows, settings) for f in group.families]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    with fine_shuffles(union.sparkSession, windows.rows):
        return keep(union, f"stats-{group.name}", partition_by="family")


def select_features(
    long: DataFrame, group: TableGroup, settings: Settings
) -> tuple[list[Feature], dict[tuple[str, str], int]]:
    """The chosen codes, at most the sum of all top-N limits, and their counts."""
    if not group.families:
        return [], {}
    ranked = sel.rank_codes(long, {f.name: settings.top_n(f.name) for f in group.families}).collect()
    families = {f.name: f for f in group.families}
    ranked.sort(key=lambda r: ([f.name for f in group.families].index(r["family"]), r["rank"]))
    chosen = [
        make_feature(group, families[r["family"]], r["code"]) for r in ranked
    ]
    return chosen, {(r["family"], r["code"]): r["event_count"] for r in ranked}


def make_feature(group: TableGroup, family: Family, code: str) -> Feature:
    stem = code if family.name == "drug" else f"{group.prefix(family.name)}_{code}"
    return Feature(family.name, code, stem, family.stats)


def assemble(
    context: DataFrame, long: DataFrame, group: TableGroup, selected: list[Feature], exclude: Iterable[str] = ()
) -> DataFrame:
    """Context plus pivoted statistics, keeping the stays the group asks for."""
    context = context.drop(*exclude)
    chart = [f for f in selected if f.family == "chart"]
    if selected:
        wide = pivot_features(long, selected).withColumnRenamed(STAY, "_stay")
        if group.needs_chart:
            # A test over the pivoted columns would make the optimizer try all
            # combinations of their aliases; the long rows say the same.
            anchors = long.filter((F.col("family") == "chart") & F.col("code").isin([f.code for f in chart]))
            order = context.columns
            context = context.join(anchors.select(STAY).distinct(), STAY, "left_semi").select(*order)
        kind = "inner" if group.needs_chart else "left"
        out = context.join(wide, context[STAY] == wide["_stay"], kind).drop("_stay")
    else:
        out = context.filter(F.lit(not group.needs_chart))
    chosen = {f.family for f in selected}
    empty = [f.name for f in group.families if f.name not in chosen]
    return out.select("*", *[empty_family(name) for name in empty])


def group_context(
    tables: Mapping[str, DataFrame], stays: DataFrame, group: TableGroup, settings: Settings
) -> DataFrame:
    """Stays with a target and the context the group asks for."""
    patients, admissions = (tables.get(t) if t in group.context else None for t in ("patients", "admissions"))
    return context_features(stays, patients, admissions, settings.age_mode, settings.category_mode)


def build_features(
    tables: Mapping[str, DataFrame],
    group: str | TableGroup = "5",
    settings: Settings = Settings(),
    codes: Mapping[str, list] | None = None,
    validate: bool = True,
) -> FeatureRun:
    """The feature table of a table group.

    ``codes`` (family to code list) applies an earlier selection instead of a
    new one, for example the codes chosen on training stays only. ``validate``
    first makes sure that no stay, patient or admission has several rows, which
    would double features; switch it off only for tables known to be clean.
    """
    group = GROUPS[group] if isinstance(group, str) else group
    if validate:
        for table, keys in UNIQUE_KEYS.items():
            if table in tables:
                assert_unique(tables[table].dropna(subset=keys), keys, table.upper())
    stays = unit_table(tables["icustays"], settings.category_mode)
    windows = stay_windows(stays, settings.window_hours)
    long = long_statistics(tables, group, windows, settings)
    if codes is None:
        selected, counts = select_features(long, group, settings)
    else:
        selected = [
            make_feature(group, f, str(code)) for f in group.families for code in codes.get(f.name, [])
        ]
        counts = {}
    features = assemble(group_context(tables, stays, group, settings), long, group, selected, settings.exclude)
    return FeatureRun(group, settings, features, long, selected, counts, windows, stays)


def selected_codes(
    tables: Mapping[str, DataFrame], family: Family, settings: Settings = Settings()
) -> DataFrame:
    """The table of selected codes (or drugs) of one family."""
    stays = unit_table(tables["icustays"])
    windows = stay_windows(stays, settings.window_hours)
    linked = ev.link_in_window(ev.family_scan(tables, family), windows, family.key, settings.limits)
    if family.name == "drug":
        return sel.top_drugs(linked, settings.top_n("drug"))
    top = sel.top_codes(linked, settings.top_n(family.name))
    if family.dimension is None or family.dimension not in tables:
        return top
    return sel.describe_codes(top, tables[family.dimension], family.dimension_columns)


def selected_table(run: FeatureRun, tables: Mapping[str, DataFrame], family: Family) -> DataFrame:
    """The selected-codes table of a finished run, without reading events again."""
    spark = run.features.sparkSession
    rows = [(int(code), int(n)) for (name, code), n in run.counts.items() if name == family.name]
    top = spark.createDataFrame(rows, f"{ev.ITEM} bigint, event_count bigint")
    if family.dimension is None or family.dimension not in tables:
        return top
    return sel.describe_codes(top, tables[family.dimension], family.dimension_columns)


def write_run(run: FeatureRun, tables: Mapping[str, DataFrame], path: str) -> None:
    """Publish a run: features as parquet and CSV, selected codes, quality report."""
    features = replace_table(run.features, f"{path}/features")
    export_csv(features, f"{path}/features_csv")
    for family in run.group.families:
        if family.name == "drug":
            table = selected_codes(tables, family, run.settings)
            replace_table(table, f"{path}/selected_drug")
        else:
            replace_table(selected_table(run, tables, family), f"{path}/selected_{family.name}")
    written = replace(run, features=features)
    report = quality_base(tables, written) if run.group.name == "5" else quality_group(written)
    write_report(report, f"{path}/quality")


@dataclass(frozen=True)
class SweepSetting:
    group: str
    window_hours: int
    top_n: int


def sweep_statistics(
    tables: Mapping[str, DataFrame], family: Family, hours: list[int], settings: Settings
) -> DataFrame:
    """Long statistics of one family for several windows, events read once.

    Windows nest, so events are linked at the widest one and reduced to
    mergeable rows per (stay, code, smallest window holding the event). Each of
    these few rows then counts for its own and every wider window.
    """
    windows = stay_windows(unit_table(tables["icustays"]), max(hours))
    linked = ev.link_in_window(ev.family_scan(tables, family), windows, family.key, settings.limits)
    offset = F.unix_micros(ev.TIME) - F.unix_micros("INTIME")
    smallest = F.coalesce(*[F.when(offset <= h * MICROS_PER_HOUR, F.lit(h)) for h in sorted(hours)])
    steps = F.array(*[F.lit(h) for h in sorted(hours)])
    own_and_wider = F.explode(F.filter(steps, lambda h: h >= F.col("window_hours")))
    if family.name == "drug":
        keys = ["window_hours", STAY, "DRUG_KEY"]
        counted = (
            ev.named_drugs(linked)
            .withColumn("window_hours", smallest)
            .withColumn("DRUG_KEY", fn.drug_key(F.col("DRUG_NAME")))
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("count"), F.count_if("NAMED").alias("named"))
        )
        stats = (
            counted.withColumn("window_hours", own_and_wider)
            .groupBy(*keys)
            .agg(F.sum("count").alias("count"), F.sum("named").alias("named"))
        )
    else:
        keys = ["window_hours", STAY, ev.ITEM]
        summary = ev.summarise(linked.withColumn("window_hours", smallest), keys)
        stats = ev.merge_stats(summary.withColumn("window_hours", own_and_wider), keys).select(*keys, *family.stats)
    return _long_form(stats, family, ("window_hours",))


def _widest(long: DataFrame, ranked: list[Feature], label: str) -> DataFrame:
    """All selected statistics of one window, a row per stay, written once.

    ``_chart_rank`` is the best rank among the chart codes a stay has, so that a
    smaller top-N keeps its stays by a comparison.
    """
    chart = [f.code for f in ranked if f.family == "chart"]
    wide = pivot_features(long, ranked)
    if chart:
        place = F.create_map(*[F.lit(x) for pair in zip(chart, range(1, len(chart) + 1)) for x in pair])
        of_chart = long.filter((F.col("family") == "chart") & F.col("code").isin(chart))
        best = of_chart.groupBy(STAY).agg(F.min(place[F.col("code")]).alias(CHART_RANK))
        wide = wide.join(best, STAY, "left")
    else:
        wide = wide.withColumn(CHART_RANK, F.lit(None).cast("int"))
    return keep(wide.withColumnRenamed(STAY, "_stay"), label)


def _from_widest(
    context: DataFrame, wide: DataFrame, group: TableGroup, chosen: list[tuple[Feature, Feature]], top_n: int, exclude: Iterable[str]
) -> DataFrame:
    """What ``assemble`` gives, read from the columns of the widest table.

    ``chosen`` pairs each feature of the group with its name in ``wide``.
    """
    context = context.drop(*exclude)
    if chosen:
        part = wide.filter(F.col(CHART_RANK) <= top_n) if group.needs_chart else wide
        columns = [
            f"{fn.sql_name(f'{stored.stem}_{s}')} AS {fn.sql_name(f'{own.stem}_{s}')}"
            for own, stored in chosen
            for s in ALL_STATS
            if s in own.stats
        ]
        kind = "inner" if group.needs_chart else "left"
        # Text, since hundreds of column objects take seconds to build.
        out = context.join(part.selectExpr("_stay", *columns), context[STAY] == F.col("_stay"), kind).drop("_stay")
    else:
        out = context.filter(F.lit(not group.needs_chart))
    filled = {own.family for own, _ in chosen}
    empty = [f.name for f in group.families if f.name not in filled]
    return out.select("*", *[empty_family(name) for name in empty]) if empty else out


def sweep_features(
    tables: Mapping[str, DataFrame],
    groups: Iterable[str | TableGroup],
    hours: list[int],
    top_ns: list[int],
    settings: Settings = Settings(),
) -> dict[SweepSetting, FeatureRun]:
    """One feature run per (table group, window, top-N), events read once each.

    ``groups`` are names or own table groups, also such without families.
    ``top_ns`` limits the chart codes; the other families keep their own limit.
    Each window is pivoted once, with the codes of all groups and the largest
    top-N; a setting reads its columns of that table. Settings that come to the
    same table share it.
    """
    groups = [GROUPS[g] if isinstance(g, str) else g for g in groups]
    used = {f.name: f for g in groups for f in g.families}
    everything = TableGroup("sweep", 0, tuple(f for f in FAMILIES.values() if f.name in used), False)
    stays = unit_table(tables["icustays"], settings.category_mode)
    contexts: dict[tuple[str, ...], DataFrame] = {}
    for group in groups:
        if group.context not in contexts:
            contexts[group.context] = keep(group_context(tables, stays, group, settings), "sweep-context")
    with fine_shuffles(stays.sparkSession, stay_windows(stays, max(hours)).rows if everything.families else 0):
        merged = [
            keep(sweep_statistics(tables, family, hours, settings), f"sweep-{family.name}", partition_by="window_hours")
            for family in everything.families
        ]
    runs: dict[SweepSetting, FeatureRun] = {}
    for h in hours:
        windows = stay_windows(stays, h)
        widest = replace(settings, window_hours=h, top_n_chart=max(top_ns))
        long = _no_statistics(stays.sparkSession)
        for df in merged:
            long = long.unionByName(df.filter(F.col("window_hours") == h).drop("window_hours"))
        ranked, all_counts = select_features(long, everything, widest)
        wide = _widest(long, ranked, f"sweep-wide-{h}") if ranked else None
        for group in groups:
            own_long = long.filter(F.col("family").isin([f.name for f in group.families]))
            made: dict[int, DataFrame] = {}
            for n in top_ns:
                # A smaller top-N is a prefix of the ranking made for the largest.
                point = replace(widest, top_n_chart=n)
                chosen = []
                for family in group.families:
                    stored = [f for f in ranked if f.family == family.name][: point.top_n(family.name)]
                    chosen += [(make_feature(group, family, f.code), f) for f in stored]
                selected = [own for own, _ in chosen]
                if len(chosen) not in made:
                    made[len(chosen)] = _from_widest(contexts[group.context], wide, group, chosen, n, point.exclude)
                counts = {(f.family, f.code): all_counts[f.family, f.code] for f in selected}
                runs[SweepSetting(group.name, h, n)] = FeatureRun(
                    group, point, made[len(chosen)], own_long, selected, counts, windows, stays
                )
    return runs


def _column_weight(column: str) -> int:
    return int(hashlib.md5(column.encode()).hexdigest()[:4], 16)


def feature_checksum(features: DataFrame) -> DataFrame:
    """Rows, filled cells and a checksum that depends on every cell but not on row order.

    A number counts with its thousandths (the offset keeps sums of decimals off
    the edge, so the order of additions does not matter), a text with its hash;
    cells are weighted by column name and stay.
    """
    texts = [c for c, kind in features.dtypes if kind == "string"]
    numbers = [c for c in features.columns if c not in (*ID_COLUMNS, *texts)]
    cells = [f"CAST(conv(substr(md5({fn.sql_name(c)}), 1, 4), 16, 10) AS DOUBLE)" for c in texts]
    cells += [f"CAST({fn.sql_name(c)} AS DOUBLE)" for c in numbers]
    weights = ", ".join(f"{_column_weight(c)}L" for c in texts + numbers)
    per_row = features.select(F.col(STAY).alias("stay"), F.expr(f"array({', '.join(cells)})").alias("cells"))
    weighted = f"""aggregate(zip_with(cells, array({weights}),
        (v, w) -> coalesce(pmod(floor(v * 1000 + {CHECK_OFFSET}D), {CHECK_PRIME}L) * w, 0L)), 0L, (a, x) -> a + x)"""
    return per_row.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.size(F.filter("cells", F.isnotnull))), F.lit(0)).cast("bigint").alias("cells"),
        F.coalesce(F.sum(F.expr(f"pmod({weighted} * (pmod(stay, 1009L) + 1), {CHECK_PRIME}L)")), F.lit(0)).cast("bigint").alias("checksum"),
    )


def compare_sweep(spark: SparkSession, runs: Mapping[SweepSetting, FeatureRun]) -> DataFrame:
    """One line per setting: rows, columns, selected codes, events used, cells and checksum.

    Settings that share a table are computed together, one table after the other:
    a plan over all these wide tables would fill the driver. Three numbers of each
    table come back.
    """
    shared: dict[int, list[SweepSetting]] = {}
    for setting, run in runs.items():
        shared.setdefault(id(run.features), []).append(setting)
    lines = []
    for settings in shared.values():
        run = runs[settings[0]]
        found = feature_checksum(run.features).first()
        shape = (len(run.features.columns), len(run.selected), sum(run.counts.values()))
        lines += [(s.group, s.window_hours, s.top_n, found["rows"], *shape, found["cells"], found["checksum"]) for s in settings]
    return spark.createDataFrame(lines, SWEEP_LINE)
