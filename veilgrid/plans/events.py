"""Events of a run: what the driver reports as it happens, and what the stage tables tell about each image."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The events, their level and what they say.
EVENTS = {
    "pipeline_started": ("info", "run started in mode {mode}"),
    "stage_started": ("info", "{stage}: started"),
    "stage_completed": ("info", "{stage}: {count} images done"),
    "loading_model": ("info", "loading {model}"),
    "model_loaded": ("info", "{model} is ready"),
    "processing_image": ("info", "{stage}: {name}"),
    "alarm_triggered": ("warning", "alarm on {name}: {motivation}"),
    "fallback_prompt_attempted": ("info", "nothing found on {name}, tried again with '{prompt}'"),
    "image_completed": ("info", "{name}: segmentation {sam3} s, post-processing {post} s, redaction {deid} s"),
    "report_written": ("info", "{records} records written to {path}"),
}


class EventLog:
    """Reports events to a logger of the driver."""

    def __init__(self, logger: logging.Logger | None = None) -> None:
        self.logger = logger or logging.getLogger("veilgrid")

    def __call__(self, event: str, **facts) -> None:
        level, text = EVENTS[event]
        self.logger.log(getattr(logging, level.upper()), text.format(**facts))


def _event(rows: DataFrame, event: str, **facts: Column) -> DataFrame:
    level, text = EVENTS[event]
    message: Column = F.lit(text)
    for name, value in facts.items():
        message = F.replace(message, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return rows.select("name", F.lit(event).alias("event"), F.lit(level).alias("level"), message.alias("message"))


def image_events(segmented: DataFrame, report: DataFrame, fallback: str = "") -> DataFrame:
    """name, event, level, message of every image, from the stage tables: no image passes through the driver."""
    name, alarm, times = F.col("name"), F.col("alarm"), F.col("metrics.times")
    return (
        _event(segmented, "processing_image", stage=F.lit("segmentation"), name=name)
        .unionAll(_event(segmented.filter("fallback"), "fallback_prompt_attempted", name=name, prompt=F.lit(fallback)))
        .unionAll(_event(report.filter("alarm.triggered"), "alarm_triggered", name=name, motivation=alarm["motivation"]))
        .unionAll(_event(report, "image_completed", name=name, **{k: F.round(times[c], 3) for k, c in (("sam3", "sam3_inference"), ("post", "erosion_diffusion"), ("deid", "deidentification"))}))
    )
