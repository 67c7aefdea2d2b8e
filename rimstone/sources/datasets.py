"""Datasets of the lake: their names, keys and typed readers of what has landed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.errors import EmptyDataset
from rimstone.operators.cleaning import require_columns
from rimstone.operators.keyed import NO_KEYS, covered_by, keys_by_source, require_keys
from rimstone.sinks.naming import Declared, targets
from rimstone.sinks.parquet import read_published
from rimstone.sources.drift import expand, load_datasets
from rimstone.sources.files import with_source_name

# Codes used in source names.
LEAGUES = {"NBA": "00", "ABA": "01", "WNBA": "10", "G_LEAGUE": "20"}
ROW_KINDS = {"TEAM": "T", "PLAYER": "P"}
SEASON_TYPES = ("Regular Season", "Pre Season", "Playoffs", "All Star")
ALL_PERIODS = "0"
ALL_SEASONS, CURRENT_SEASON_ONLY = 0, 1

# Source-name prefixes and folders.
GAME_LOGS = "league-game-logs"
PLAY_BY_PLAY = "play-by-play-logs"
BOX_SCORES = "box-score-logs"
PLAYERS, PLAYER_FOLDER = "players-info", "player-bios"
TEAMS, ROSTER_FOLDER = "team", "rosters"
INJURIES = "injuries"

# Datasets in the order in which one response returns them.
BOX_SCORE_DATASETS = {
    "traditional": ("player_stats", "team_starter_bench_stats", "team_stats"),
    "advanced": ("player_stats", "team_stats"),
    "summary": (
        "game_summary",
        "game_info",
        "arena_info",
        "officials",
        "line_score",
        "inactive_players",
        "last_five_meetings",
        "other_stats",
        "available_video",
    ),
}
ROSTER_DATASETS = ("roster", "coaches")

GAME_LOG_COLUMNS = ("SEASON_ID", "TEAM_ID", "GAME_ID")
PLAY_BY_PLAY_COLUMNS = ("gameId", "actionNumber", "actionId")
INJURY_COLUMNS = (
    "game_date",
    "game_time",
    "matchup",
    "team",
    "player_name",
    "current_status",
    "reason",
    "reported_at",
)

# Types of the columns that fetchers have landed in different ones over the seasons, by dataset.
_COUNTS = "MIN FGM FGA FG3M FG3A FTM FTA OREB DREB REB AST STL BLK TOV PF PTS PLUS_MINUS VIDEO_AVAILABLE".split()
GAME_LOG_TYPES = {
    **dict.fromkeys(("SEASON_ID", "GAME_ID", "GAME_DATE"), "string"),
    "TEAM_ID": "bigint",
    **dict.fromkeys(_COUNTS, "bigint"),
    **dict.fromkeys(("FG_PCT", "FG3_PCT", "FT_PCT"), "double"),
}
GAME_TYPES = {"gameId": "string"}
PERSON_TYPES = {"PERSON_ID": "bigint", "TEAM_ID": "bigint"}
ROSTER_TYPES = {"TEAM_ID": "bigint", "PLAYER_ID": "bigint", "COACH_ID": "bigint"}


def name_parts(names: Sequence[str], parts: Sequence[object]) -> dict:
    """Parts of one response by dataset name; their number must match."""
    return dict(zip(names, parts, strict=True))


@dataclass(frozen=True)
class LandedDataset:
    """Where a dataset lies, which columns it must have, and the types of those whose type has drifted."""

    source_name: str
    path: str
    s3_key: str
    required: tuple[str, ...] = field(default=())
    types: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        """Its rows in the declared types; a path with a star names the same dataset of several seasons."""
        several = expand(spark, self.path) if "*" in self.path else []
        rows = load_datasets(spark, several, self.types, lambda r: r) if several else read_published(spark, self.path)
        casts = {c: F.col(f"`{c}`").cast(t) for c, t in self.types.items() if c in rows.columns}
        return require_columns(rows.withColumns(casts), self.required)


class Landed:
    """Typed readers over a lake root: what fetchers have landed, or what has been published from it."""

    def __init__(self, spark: SparkSession, root: str, *, league: str = LEAGUES["NBA"], run_date: str = "") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.league = league
        self.run_date = run_date

    def _named(
        self, declared: Sequence[tuple[Declared, Sequence[str]]], types: Mapping[str, str]
    ) -> list[LandedDataset]:
        made = targets(self.spark, self.root, [d for d, _ in declared])
        return [LandedDataset(t.source_name, t.path, t.s3_key, tuple(r), types) for t, (_, r) in zip(made, declared)]

    def game_log_dataset(self, season: str, kind: str = "T", season_type: str = SEASON_TYPES[0]) -> LandedDataset:
        declared = Declared(GAME_LOGS, (self.league, kind, season_type), (season,))
        return self._named([(declared, GAME_LOG_COLUMNS)], GAME_LOG_TYPES)[0]

    def play_by_play_dataset(self, season: str) -> LandedDataset:
        declared = Declared(PLAY_BY_PLAY, (ALL_PERIODS, ALL_PERIODS), (season,))
        return self._named([(declared, PLAY_BY_PLAY_COLUMNS)], GAME_TYPES)[0]

    def box_score_datasets(self, season: str, variant: str) -> dict[str, LandedDataset]:
        names = BOX_SCORE_DATASETS[variant]
        declared = [
            Declared(BOX_SCORES, (ALL_PERIODS, ALL_PERIODS, variant, n.replace("_", "-")), (season,)) for n in names
        ]
        return name_parts(names, self._named([(d, ("gameId", "source_name")) for d in declared], GAME_TYPES))

    def player_list_dataset(self, season: str, flag: int = CURRENT_SEASON_ONLY) -> LandedDataset:
        return self._named([(Declared(PLAYERS, (flag, self.league), (season,)), ("PERSON_ID",))], PERSON_TYPES)[0]

    def player_detail_dataset(self, flag: int = CURRENT_SEASON_ONLY) -> LandedDataset:
        folders = (PLAYER_FOLDER, self.run_date)
        return self._named([(Declared(PLAYERS, (flag, self.league), folders), ("PERSON_ID",))], PERSON_TYPES)[0]

    def roster_datasets(self) -> dict[str, LandedDataset]:
        keys = {"roster": ("TEAM_ID", "PLAYER_ID"), "coaches": ("TEAM_ID", "COACH_ID")}
        folders = (ROSTER_FOLDER, self.run_date)
        declared = [(Declared(TEAMS, (self.league, n), folders), keys[n]) for n in ROSTER_DATASETS]
        return name_parts(ROSTER_DATASETS, self._named(declared, ROSTER_TYPES))

    def injury_dataset(self, year: int) -> LandedDataset:
        key = f"{INJURIES}/{year}/parsed/{INJURIES}.parquet"
        return LandedDataset(INJURIES, f"{self.root}/{key}", key, INJURY_COLUMNS)

    def get_game_logs(self, season: str) -> DataFrame:
        return self.game_log_dataset(season).read(self.spark)

    def get_play_by_play_logs(self, season: str) -> DataFrame:
        return self.play_by_play_dataset(season).read(self.spark)

    def get_box_score_game_logs(self, keys: DataFrame, variant: str, season: str = "*") -> dict[str, DataFrame]:
        """Box-score datasets of the games in the key list, which may span seasons."""
        frames = [
            covered_by(d.read(self.spark), keys, "gameId") for d in self.box_score_datasets(season, variant).values()
        ]
        return name_parts(BOX_SCORE_DATASETS[variant], frames)

    def get_all_players_info(self, season: str) -> DataFrame:
        return self.player_list_dataset(season).read(self.spark)

    def get_player_info(self, keys: DataFrame) -> DataFrame:
        return covered_by(self.player_detail_dataset().read(self.spark), keys, "PERSON_ID")

    def get_team_roster_info(self, keys: DataFrame, season: str | None = None) -> dict[str, DataFrame]:
        frames = [covered_by(d.read(self.spark), keys, "TEAM_ID") for d in self.roster_datasets().values()]
        return name_parts(ROSTER_DATASETS, frames)

    def game_ids_by_source(self, season: str, prefix: str = GAME_LOGS, key: str = "GAME_ID") -> DataFrame:
        """Distinct game ids of every landed source of a season: `(source_name, id)`; an error if there is none.

        `season` may be a pattern such as `*` for several seasons, whose ids may have landed in different types.
        """
        paths = expand(self.spark, f"{self.root}/{season}/{prefix}*.parquet")
        if not paths:
            raise EmptyDataset(NO_KEYS)

        def named(rows: DataFrame) -> DataFrame:
            return with_source_name(require_columns(rows, [key]).drop("source_name")).select("source_name", key)

        return require_keys(keys_by_source(load_datasets(self.spark, paths, {key: "string"}, named), key))
