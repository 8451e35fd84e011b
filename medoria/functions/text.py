"""Text expressions: table names and numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name given to a file whose own name leaves nothing usable.
UNKNOWN_TABLE = "unknown_table"


def clean_name(raw: Column) -> Column:
    """Lower-case ASCII identifier starting with a letter.

    Every run of other characters (``_`` included) becomes one ``_``; leading
    characters up to the first letter and a trailing ``_`` go.
    """
    joined = F.regexp_replace(F.lower(raw), "[^a-z0-9]+", "_")
    bare = F.rtrim(F.regexp_replace(joined, "^[^a-z]+", ""), F.lit("_"))
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(UNKNOWN_TABLE))


def table_name_of(relative_path: Column) -> Column:
    """Folder parts and file stem joined by ``_``, then cleaned."""
    return clean_name(F.regexp_replace(relative_path, r"\.[^./]+$", ""))


def to_number(raw: Column) -> Column:
    """Number from text with decimal point or comma; anything else is NULL."""
    return F.replace(F.trim(raw.cast("string")), F.lit(","), F.lit(".")).try_cast("double")
