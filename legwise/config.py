"""Run configuration: frozen dataclasses, paths in, no
credentials. ``from_env`` reads the same setting names as an env file."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


class ConfigError(ValueError):
    pass


def _req(env: dict, key: str) -> str:
    v = (env.get(key) or "").strip()
    if not v:
        raise ConfigError(f"missing required setting {key}")
    return v


def _opt(env: dict, key: str, default: str | None = None) -> str | None:
    v = (env.get(key) or "").strip()
    return v or default


_SWITCH = {**dict.fromkeys(("1", "true", "yes", "y", "on"), True),
           **dict.fromkeys(("0", "false", "no", "n", "off"), False)}


def _switch(env: dict, key: str, default: bool) -> bool:
    """A yes/no setting; words that are neither are refused, not read as no."""
    word = _opt(env, key)
    if word is None:
        return default
    try:
        return _SWITCH[word.lower()]
    except KeyError:
        raise ConfigError(f"{key}: expected one of {', '.join(_SWITCH)}, not {word!r}") from None


@dataclass(frozen=True)
class IngestConfig:
    landing_path: str                       # folder (or glob) the daily leg files arrive in
    raw_path: str                           # raw table (Parquet, partitioned by file_date)
    polygons_path: str | None = None        # block-group polygons (Parquet or GeoJSON)
    polygon_id_field: str = "GEOID"         # property that holds a GeoJSON feature's id
    filename_substring: str = "tapped_trip_view_legs"
    file_suffix: str = ".csv"
    only_years: tuple[int, ...] | None = None
    dist_epsg: int = 32140
    cell_size_deg: float = 0.01
    whole_files: bool = True                # a file with a bad record does not load at all
    max_files: int = 20_000                 # files of one run; their names reach the driver

    @staticmethod
    def from_env(env: dict | None = None) -> "IngestConfig":
        env = dict(os.environ if env is None else env)
        years = _opt(env, "ONLY_YEARS")
        return IngestConfig(
            landing_path=_req(env, "LANDING_PATH"),
            raw_path=_req(env, "RAW_PATH"),
            polygons_path=_opt(env, "BG_POLYGONS_PATH"),
            polygon_id_field=_opt(env, "BG_ID_FIELD", "GEOID"),
            filename_substring=_opt(env, "FILENAME_SUBSTRING", "tapped_trip_view_legs"),
            file_suffix=_opt(env, "FILE_SUFFIX", ".csv"),
            only_years=tuple(int(y) for y in years.split(",") if y.strip()) if years else None,
            dist_epsg=int(_opt(env, "DIST_CRS_EPSG", "32140")),
            cell_size_deg=float(_opt(env, "CELL_SIZE_DEG", "0.01")),
            whole_files=_switch(env, "WHOLE_FILES", True),
            max_files=int(_opt(env, "MAX_FILES", "20000")))


@dataclass(frozen=True)
class TransformConfig:
    raw_path: str
    clean_path: str
    state_path: str
    output_path: str                        # folder of the aggregate and publish tables
    reject_path: str | None = None          # default: beside the clean table
    rolling_days: int = 34
    overlap_days: int = 5
    days_back: int = 31
    region_prefix: str | None = None
    as_of: str | None = None                # default: today
    materialize: str = "parquet"
    tune_shuffle: bool = False              # size shuffle partitions from the window's input

    @staticmethod
    def from_env(env: dict | None = None) -> "TransformConfig":
        env = dict(os.environ if env is None else env)
        return TransformConfig(
            raw_path=_req(env, "RAW_PATH"), clean_path=_req(env, "CLEAN_PATH"),
            state_path=_req(env, "STATE_PATH"), output_path=_req(env, "OUTPUT_PATH"),
            reject_path=_opt(env, "REJECT_PATH"),
            rolling_days=int(_opt(env, "ROLLING_DAYS", "34")),
            overlap_days=int(_opt(env, "OVERLAP_DAYS", "5")),
            days_back=int(_opt(env, "PROC_DAYS_BACK", "31")),
            region_prefix=_opt(env, "PROC_REGION_PREFIX"),
            as_of=_opt(env, "AS_OF"), tune_shuffle=_switch(env, "TUNE_SHUFFLE", False))


@dataclass(frozen=True)
class PublishConfig:
    output_path: str                        # where the publish tables are
    features_path: str                      # where the feature datasets go
    fmt: str = "parquet"                    # or "geojson" (one Feature per line)
    densify: int = 0
    dry_run: bool = False

    @staticmethod
    def from_env(env: dict | None = None) -> "PublishConfig":
        env = dict(os.environ if env is None else env)
        return PublishConfig(output_path=_req(env, "OUTPUT_PATH"), features_path=_req(env, "FEATURES_PATH"),
                             fmt=_opt(env, "FEATURES_FORMAT", "parquet"),
                             densify=int(_opt(env, "DENSIFY", "0")), dry_run=_switch(env, "DRY_RUN", False))


@dataclass(frozen=True)
class PipelineConfig:
    ingest: IngestConfig
    transform: TransformConfig
    publish: PublishConfig
    publish_enabled: bool = True
    run_transform_if_no_new: bool = True
    run_publish_if_no_new: bool = False
    extra: dict = field(default_factory=dict)

    @staticmethod
    def from_env(env: dict | None = None) -> "PipelineConfig":
        env = dict(os.environ if env is None else env)
        return PipelineConfig(IngestConfig.from_env(env), TransformConfig.from_env(env),
                              PublishConfig.from_env(env),
                              publish_enabled=_switch(env, "PUBLISH_ENABLED", True),
                              run_transform_if_no_new=_switch(env, "RUN_MODULE2_IF_NO_NEW", True),
                              run_publish_if_no_new=_switch(env, "RUN_MODULE3_IF_NO_NEW", False))
