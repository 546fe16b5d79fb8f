"""Settings of the feature builder and the detector."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, replace

# Stop ids of the interchange that gets its own flag.
CENTRAL_STOPS = (
    "2000466",
    "2000467",
    "200060",
    "2065163",
    "2060115",
    "2000460",
    "2000463",
    "2000464",
    "2017078",
)

# Stop ids the detector watches unless told otherwise.
WATCHED_STOPS = (
    "2155269",
    "2155267",
    "2155265",
    "2153402",
    "2153404",
    "2154264",
    "2154262",
    "2126159",
    "2121225",
    "2113351",
    "2113341",
    "2113361",
    "2067142",
    "2065163",
    "2060115",
    "2000460",
    "2000463",
    "2000464",
    "2000467",
    "2017078",
    "204471",
)


@dataclass(frozen=True)
class FeatureConfig:
    """Rules of the station features.

    ``scope`` names extra columns (for example ``("network_id",)``) that prefix
    every key, so that many networks run through one plan side by side.
    """

    scope: tuple[str, ...] = ()
    delay_cap: int = 300
    tu_lag_secs: int = 180
    vp_lag_secs: int = 60
    lag_buffer_secs: int = 10
    lag_history: int = 60
    # Columns that tell a row's place in its minute's document, for the lags that are remembered.
    # Without any, the oldest rows of a minute count as the first.
    feed_order: tuple[str, ...] = ()
    max_future_secs: int = 7200
    future_ceiling_secs: int = 14400
    max_headway_secs: int = 3600
    reset_hour: int = 3
    fresh_cap_secs: int = 86400
    local_zone: str = "Australia/Sydney"
    # "arrival_date": a new calendar date at or after reset_hour starts a segment.
    # "shifted": a new date of (local time - reset_hour) starts a segment.
    service_day_rule: str = "arrival_date"
    central_stops: tuple[str, ...] = CENTRAL_STOPS
    # Number of salts that spread the minute x key grid when keys are too many to broadcast.
    grid_salts: int = 32
    # Write the two shared intermediate tables through the checkpoint folder.
    cut_lineage: bool = True

    @property
    def minute_key(self) -> list[str]:
        return [*self.scope, "snapshot_minute"]

    @property
    def stop_key(self) -> list[str]:
        return [*self.scope, "stop_id", "direction_id"]

    @property
    def row_key(self) -> list[str]:
        return [*self.scope, "snapshot_minute", "stop_id", "direction_id"]


# Columns of the feature table that describe the train traffic itself; the
# remaining ones (clock and network shape) are never all zero.
DYNAMIC_FEATURES = (
    "arrival_delay_t",
    "departure_delay_t",
    "headway_t",
    "rel_headway_t",
    "dwell_delta_t",
    "delay_arrival_grad_t",
    "delay_departure_grad_t",
    "upstream_delay_mean_2",
    "downstream_delay_max_2",
    "delay_mean_5",
    "delay_std_5",
    "delay_mean_15",
    "headway_p90_60",
    "congestion_level",
    "occupancy_status",
    "is_train_present",
    "data_fresh_secs",
)
STATIC_FEATURES = ("sin_hour", "cos_hour", "day_type", "node_degree", "hub_flag", "central_flag")

DROPPED_BY_DEFAULT = ("data_fresh_secs", "dwell_delta_t")

# Accepted in a settings mapping for compatibility; they change nothing.
_INERT_SETTINGS = {"subsample_size", "warmup_days"}


@dataclass(frozen=True)
class DetectorConfig:
    """Hyper-parameters of the half-space-tree detector."""

    n_trees: int = 100
    height: int = 10
    window_size: int = 10_000
    threshold_quantile: float = 0.99
    seed: int = 42
    daily_reset: bool = True
    # Value range the random splits are drawn from, per feature.
    lower: float = 0.0
    upper: float = 1.0

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> DetectorConfig:
        known = {k: v for k, v in values.items() if k not in _INERT_SETTINGS}
        return replace(cls(), **known)

    @classmethod
    def from_yaml(cls, path: str) -> DetectorConfig:
        import yaml

        with open(path, encoding="utf-8") as handle:
            return cls.from_mapping(yaml.safe_load(handle) or {})

    @property
    def structure(self) -> tuple:
        """Everything that changes scores; the quantile only changes flags."""
        return (
            self.n_trees,
            self.height,
            self.window_size,
            self.seed,
            self.daily_reset,
            self.lower,
            self.upper,
        )

    @property
    def structure_id(self) -> str:
        return hashlib.md5(json.dumps(self.structure).encode()).hexdigest()[:12]

    def config_id(self, **context: object) -> str:
        """Stable id over all settings and ``context`` (time range, data version)."""
        text = json.dumps({**asdict(self), **context}, sort_keys=True, default=str)
        return hashlib.md5(text.encode()).hexdigest()[:12]
