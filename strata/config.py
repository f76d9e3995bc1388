"""Lake layout: dataset registry, layer roots and the naming rules between layers."""

from __future__ import annotations

import os
from dataclasses import dataclass

# --- Fixed values: names the published warehouse must keep -------------------
# Bronze datasets (one CSV each) and the columns the silver layer reads from
# them. Files may carry more columns; silver selects by name.
DATASETS: dict[str, tuple[str, ...]] = {
    "Olympics_Country": ("noc", "country"),
    "Olympics_Games": (
        "edition", "edition_id", "edition_url", "year", "city", "country_flag_url",
        "country_noc", "start_date", "end_date", "competition_date", "isHeld",
    ),
    "Olympic_Athlete_Bio": (
        "athlete_id", "name", "sex", "born", "height", "weight", "country",
        "country_noc", "description", "special_notes",
    ),
    "Olympic_Athlete_Event_Results": (
        "edition_id", "country_noc", "result_id", "athlete_id", "pos", "medal",
        "isTeamSport", "event",
    ),
    "Olympic_Games_Medal_Tally": ("edition_id", "country_noc", "gold", "silver", "bronze", "total"),
    "Olympic_Results": (
        "result_id", "event_title", "edition", "edition_id", "sport", "sport_url",
        "result_date", "result_location", "result_participants",
    ),
}

# Silver Parquet folder names, keyed by our builder name.
SILVER: dict[str, str] = {
    "athlete": "Athlete_parquet",
    "games": "OlympicsGames_parquet",
    "results": "OlympicResults_parquet",
    "country": "OlympicsCountry_parquet",
    "date": "Date_parquet",
    "fact": "Fact_Table_parquet",
}

# Gold publication: (catalog table, Parquet folder), keyed by builder name.
GOLD_DATABASE = "gold"
GOLD: dict[str, tuple[str, str]] = {
    "athlete": ("Athlete_Dim", "Athlete_parquet"),
    "games": ("Games_Dim", "OlympicsGames_parquet"),
    "results": ("Results_Dim", "OlympicResults_parquet"),
    "country": ("Country_Dim", "Country_parquet"),
    "date": ("Date_Dim", "Date_parquet"),
    "fact": ("Olympics_Fact", "Olympics_Fact_parquet"),
    "mart": ("BusinessLogic", "BusinessLogic_Parquet"),
}
# -----------------------------------------------------------------------------


def _join(root: str, name: str) -> str:
    return root.rstrip("/") + "/" + name


@dataclass(frozen=True)
class LakePaths:
    """Roots of the four layers. Any Hadoop URI works (hdfs://, s3a://, file:/)."""

    csv_root: str
    bronze_root: str
    silver_root: str
    gold_root: str

    @classmethod
    def under(cls, lake_root: str, csv_root: str | None = None) -> "LakePaths":
        return cls(
            csv_root=csv_root or _join(lake_root, "csv"),
            bronze_root=_join(lake_root, "bronze"),
            silver_root=_join(lake_root, "silver"),
            gold_root=_join(lake_root, "gold"),
        )

    @classmethod
    def from_env(cls, environ: dict[str, str] | None = None) -> "LakePaths":
        """``STRATA_CSV_ROOT`` / ``STRATA_LAKE_ROOT`` with local defaults."""
        env = os.environ if environ is None else environ
        lake = env.get("STRATA_LAKE_ROOT", "file:/data/lake")
        return cls.under(lake, env.get("STRATA_CSV_ROOT", "file:/data/incoming"))

    def csv(self, dataset: str) -> str:
        return _join(self.csv_root, f"{dataset}.csv")

    def bronze(self, dataset: str) -> str:
        """Layer naming rule: ``X.csv`` lands as ``X_parquet``."""
        return _join(self.bronze_root, bronze_name(dataset))

    def silver(self, builder: str) -> str:
        return _join(self.silver_root, SILVER[builder])

    def gold(self, builder: str) -> str:
        return _join(self.gold_root, GOLD[builder][1])

    @property
    def runs_root(self) -> str:
        """Where named runs note what they have finished."""
        return f"{self.gold_root.rstrip('/')}_runs"


def bronze_name(file_name: str) -> str:
    """``Olympics_Games.csv`` (or ``Olympics_Games``) → ``Olympics_Games_parquet``."""
    base = file_name.rsplit("/", 1)[-1]
    if base.endswith(".csv"):
        base = base[: -len(".csv")]
    return f"{base}_parquet"
