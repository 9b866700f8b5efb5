"""Settings shared by the batch, streaming and model code."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# The station ids that get their own model, with their display names.
STATION_NAMES = {
    "JC115": "Newport Parkway",
    "HB102": "Hoboken Terminal",
    "HB103": "14th Street Hoboken",
}

# Model key, short label, long label, strategy label of the dashboards.
MODEL_LABELS = (
    ("lag28", "Lag-28", "Lag-28 Model", "All Lags"),
    ("topk", "Top-K", "Top-K Model", "Top 10 Features"),
    ("pca", "PCA", "PCA Model", "PCA Reduction"),
)

# Fixed value: strategy shown for a model that has no entry above.
UNKNOWN_STRATEGY = "Unknown"

# Columns a trip file must have; a row without one of them is dropped.
REQUIRED_TRIP_COLUMNS = ("started_at", "ended_at", "start_station_id", "end_station_id")


@dataclass(frozen=True)
class Settings:
    n_lags: int = 28
    # The first int(n * 4 / 5) rows of a series train, the rest test.
    train_parts: int = 4
    split_parts: int = 5
    top_k: int = 10
    n_components: int = 10
    horizon_hours: int = 168
    seed: int = 42
    recent_months: int = 2
    recent_files: int = 2
    monitor_days: int = 60
    bin_hours: int = 6
    history_start: date = date(2023, 1, 1)
    # Monthly archives are called <prefix><yyyyMM><suffix>.
    archive_prefix: str = "JC-"
    archive_suffix: str = "-tripdata.csv.zip"
    stations: tuple[str, ...] = tuple(STATION_NAMES)


DEFAULTS = Settings()


def lag_names(n_lags: int = DEFAULTS.n_lags) -> list[str]:
    return [f"lag_{i}" for i in range(1, n_lags + 1)]
