"""Sources and sinks: Parquet tables, fixture views, scoring requests, runs."""

from riskfold.sources.tables import TABLES, read_table

__all__ = ["TABLES", "read_table"]
