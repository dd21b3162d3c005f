"""The guarded chain ingest -> transform/refresh -> publish.

Exit codes: 0 ok, 1 ingest failed, 2 transform failed, 3 publish failed.

| rows inserted | run transform if no new | transform | publish enabled | run publish if no new | publish |
|---|---|---|---|---|---|
| > 0 | any | run | yes | any | run |
| 0 | yes (default) | run | yes | no (default) | skip |
| 0 | no | skip | yes | yes | run |
| any | any | as above | no | any | skip |
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from legwise.config import PipelineConfig
from legwise.plans.ingest import ingest
from legwise.plans.publish import publish
from legwise.plans.transform import transform

log = logging.getLogger(__name__)


@dataclass
class RunResult:
    exit_code: int
    inserted: int = 0
    transformed: bool = False
    published: bool = False
    error: str | None = None
    details: dict = field(default_factory=dict)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, today=None) -> RunResult:
    try:
        inserted = ingest(spark, cfg.ingest)
    except Exception as e:  # noqa: BLE001 - reported as exit code 1
        log.exception("ingest failed")
        return RunResult(1, error=f"{type(e).__name__}: {e}")
    res = RunResult(0, inserted=inserted)

    if inserted == 0 and not cfg.run_transform_if_no_new:
        log.info("no new rows and transform-if-no-new is off: skipping transform")
    else:
        try:
            t = transform(spark, cfg.transform, today=today)
            res.transformed = True
            res.details["transform"] = t
        except Exception as e:  # noqa: BLE001 - exit code 2
            log.exception("transform failed")
            res.exit_code, res.error = 2, f"{type(e).__name__}: {e}"
            return res

    if not cfg.publish_enabled:
        return res
    if inserted == 0 and not cfg.run_publish_if_no_new:
        return res
    try:
        publish(spark, cfg.publish)
        res.published = True
    except Exception as e:  # noqa: BLE001 - exit code 3
        log.exception("publish failed")
        res.exit_code, res.error = 3, f"{type(e).__name__}: {e}"
    return res
