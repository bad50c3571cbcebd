from staylens.sources.raw import load_projected, load_raw_table, load_raw_tables, require_columns  # noqa: F401
from staylens.sources.sinks import export_csv, read_export, replace_table, write_report  # noqa: F401
