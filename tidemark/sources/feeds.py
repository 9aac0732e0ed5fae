"""Which tables to ingest, from where and to where."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

# Configured tables may be named after their bronze copy; sources use the other prefix.
BRONZE_PREFIX = "brz_"
SOURCE_PREFIX = "h_"


@dataclass(frozen=True)
class Feed:
    table: str
    source_system: str
    source_path: str
    target_path: str


def feeds_of_system(
    source_system: str, source_root: str, target_root: str, tables: Iterable[str]
) -> list[Feed]:
    """One feed per table of a source system."""
    return [
        Feed(
            table,
            source_system,
            f"{source_root}/{table.replace(BRONZE_PREFIX, SOURCE_PREFIX)}",
            f"{target_root}/{table}",
        )
        for table in tables
    ]


def feeds_from_config(config: dict) -> list[Feed]:
    """Feeds of one parsed configuration file."""
    return feeds_of_system(
        config["source_system"],
        config["source_system_path"],
        config["target_system_path"],
        [table["table_name"] for table in config["tables"]],
    )
