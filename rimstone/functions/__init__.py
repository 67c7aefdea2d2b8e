"""Column functions shared by the operators."""

from rimstone.functions.seasons import (
    latest_completed_season,
    season_of_year,
    season_table,
)
from rimstone.functions.text import (
    file_stem,
    hash_key,
    kebab,
    last_part,
    path_tail,
    snake,
    snake_names,
    trimmed,
)

__all__ = [
    "file_stem",
    "hash_key",
    "kebab",
    "last_part",
    "latest_completed_season",
    "path_tail",
    "season_of_year",
    "season_table",
    "snake",
    "snake_names",
    "trimmed",
]
