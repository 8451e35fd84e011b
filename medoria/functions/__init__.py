"""Column functions: every one is built from Spark's own expressions."""

from medoria.functions.dates import age_at, calendar, date_key, in_period, to_date_key
from medoria.functions.text import clean_name, table_name_of, to_number
from medoria.functions.sizing import output_files, size_mb

__all__ = [
    "age_at",
    "calendar",
    "clean_name",
    "date_key",
    "in_period",
    "output_files",
    "size_mb",
    "table_name_of",
    "to_date_key",
    "to_number",
]
