"""Typed sources: raw domain tables from Parquet, JDBC or CSV, and the driver adapter."""

from plantmetrics.sources.readers import CsvSource, JdbcSource, ParquetSource, Source  # noqa: F401
from plantmetrics.sources.driver import DriverTables  # noqa: F401
