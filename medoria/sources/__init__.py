"""Raw files, silver tables and relational tables as DataFrames."""

from medoria.sources.csv_files import read_csv, sniff_separator
from medoria.sources.discovery import discover
from medoria.sources.jdbc import read_jdbc
from medoria.sources.json_files import read_json
from medoria.sources.raw import UnsupportedFormat, read_raw
from medoria.sources.silver import SILVER_COLUMNS, SILVER_TABLES, MissingTables, load_silver

__all__ = [
    "MissingTables",
    "SILVER_COLUMNS",
    "SILVER_TABLES",
    "UnsupportedFormat",
    "discover",
    "load_silver",
    "read_csv",
    "read_jdbc",
    "read_json",
    "read_raw",
    "sniff_separator",
]
