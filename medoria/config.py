"""Settings of a run. Paths are plain parameters; any Hadoop file system works."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """``keep_generations`` contents of a gold table stay; ``output_files`` sizes silver by its rows.

    With ``changed_only`` sources that did not change since the last run are not converted again.
    """

    source_root: str
    output_root: str
    file_format: str = "csv"
    database: str = "healthcare"
    table_format: str = "parquet"
    as_of: dt.date = field(default_factory=dt.date.today)
    survey_year: int = 2020
    relocate_to: str | None = None
    keep_generations: int = 2
    output_files: bool = False
    changed_only: bool = False

    def __post_init__(self) -> None:
        if not self.source_root or not self.output_root:
            raise ValueError("source_root and output_root are both needed")

    @property
    def silver_root(self) -> str:
        return f"{self.output_root.rstrip('/')}/silver"

    @property
    def gold_root(self) -> str:
        return f"{self.output_root.rstrip('/')}/gold"

    @property
    def database_root(self) -> str:
        return f"{self.output_root.rstrip('/')}/{self.database}.db"

    @classmethod
    def from_env(cls, **given) -> "Settings":
        """SOURCE_FOLDER, FILE_EXTENSION and TARGET_BUCKET unless given as arguments."""
        bucket = os.environ.get("TARGET_BUCKET", "")
        values = {
            "source_root": os.environ.get("SOURCE_FOLDER", ""),
            "file_format": os.environ.get("FILE_EXTENSION", "csv"),
            "output_root": f"s3a://{bucket}" if bucket else "",
        }
        return cls(**{**values, **given})
