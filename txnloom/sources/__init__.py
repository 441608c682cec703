from .files import csv_rows, parquet_rows, text_lines
from .jdbc import JdbcTarget, check_connection, jdbc_query
from .kafka import kafka_read_options, kafka_stream
from .lines import numbered_lines, quoted_records
from .rates import RATES_DDL, RateBook, rates_from_csv, rates_from_mapping, rates_from_parquet

__all__ = [
    "RATES_DDL",
    "JdbcTarget",
    "RateBook",
    "check_connection",
    "csv_rows",
    "jdbc_query",
    "kafka_read_options",
    "kafka_stream",
    "numbered_lines",
    "parquet_rows",
    "quoted_records",
    "rates_from_csv",
    "rates_from_mapping",
    "rates_from_parquet",
    "text_lines",
]
