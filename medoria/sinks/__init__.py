"""Writing, registering, moving and checking tables."""

from medoria.sinks.buckets import register_bucketed, write_bucketed
from medoria.sinks.catalog import (
    create_if_absent,
    databases,
    ensure_database,
    location_of,
    register,
    register_all,
    tables_in,
)
from medoria.sinks.checks import differences, fingerprint, relocate, same_rows, verify_tables
from medoria.sinks.generations import generations, newest
from medoria.sinks.gold import read_table, replace_table
from medoria.sinks.report import Outcome, as_report, failed, summary
from medoria.sinks.silver import write_silver

__all__ = [
    "Outcome",
    "as_report",
    "create_if_absent",
    "databases",
    "differences",
    "ensure_database",
    "failed",
    "fingerprint",
    "generations",
    "location_of",
    "newest",
    "read_table",
    "register",
    "register_all",
    "register_bucketed",
    "relocate",
    "replace_table",
    "same_rows",
    "summary",
    "tables_in",
    "verify_tables",
    "write_bucketed",
    "write_silver",
]
