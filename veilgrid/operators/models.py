"""Pluggable models. Each is built once per Python worker and called image by image inside an Arrow batch.

The real models are not part of this package; the stubs here are deterministic stand-ins for tests and dry runs.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import paths as P
from ..sources import schemas


class Segmenter(Protocol):
    def infer(self, image: np.ndarray, prompt: str) -> tuple[np.ndarray, list[tuple[float, float, float, float]]]:
        """Masks [N,H,W] and boxes (x1, y1, x2, y2)."""


class TextReader(Protocol):
    def readtext(self, image: np.ndarray, **options) -> Iterable[tuple[list, str, float]]:
        """(four points, text, probability)."""


class VisionLanguageModel(Protocol):
    def ask(self, image_url: str) -> str:
        """The reply, which should hold JSON."""


class ReportWriter(Protocol):
    def write(self, path: str, report: DataFrame) -> None: ...


@dataclass(frozen=True)
class StubSegmenter:
    """Everything brighter than a threshold is the subject."""

    least: int = 40

    def infer(self, image: np.ndarray, prompt: str):
        gray = image if image.ndim == 2 else image.max(axis=2)
        on = gray >= self.least
        if not on.any() or prompt == "nothing":
            return np.zeros((0, *gray.shape), np.uint8), []
        y, x = np.nonzero(on)
        return (on * np.uint8(255))[None], [(float(x.min()), float(y.min()), float(x.max() + 1), float(y.max() + 1))]


@dataclass(frozen=True)
class StubReader:
    """Reports each block of pure white as one piece of text."""

    def readtext(self, image: np.ndarray, **options):
        from .pixels import box_of, outer_components

        gray = image if image.ndim == 2 else image.min(axis=2)
        out = []
        for k, part in enumerate(outer_components(np.where(gray == 255, 255, 0).astype(np.uint8))):
            x, y, w, h = box_of(part)
            out.append(([[x, y], [x + w, y], [x + w, y + h], [x, y + h]], f"text {k}", 0.9))
        return out


@dataclass(frozen=True)
class StubVlm:
    def ask(self, image_url: str) -> str:
        return json.dumps({"detections": [{"text": str(len(image_url)), "bbox": [1, 2, len(image_url) % 7 + 1, 3]}]})


#: Options of the two passes of text recognition; the second one sees small print.
PASSES = ({"text_threshold": 0.5, "canvas_size": 4000, "mag_ratio": 1.0}, {"text_threshold": 0.5, "mag_ratio": 0.1})


def union_passes(*passes: DataFrame) -> DataFrame:
    """Readings of several passes; the index of a later pass follows those of the earlier ones in its image."""
    out, width = passes[0], 1_000_000
    for k, more in enumerate(passes[1:], 1):
        out = out.unionByName(more.withColumn("ix", F.col("ix") + F.lit(k * width)))
    return out


_BUILT: dict[Callable, object] = {}


def built(factory: Callable):
    """One model per worker and factory."""
    if factory not in _BUILT:
        _BUILT[factory] = factory()
    return _BUILT[factory]


READINGS = "readings array<struct<ix:bigint,quad:array<array<int>>,text:string,prob:double>>"


def read_each(images: DataFrame, factory: Callable[[], TextReader], passes: int = 1) -> DataFrame:
    """name, seconds, error, readings: a row for each image of name, height, width, channels, data. A failed image carries its
    error and fails no other."""
    from .pixels import from_spark_image

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = built(factory)
        for f in frames:
            rows = []
            for r in f.itertuples():
                begun, readings, error = time.perf_counter(), [], None
                try:
                    image = from_spark_image(r.height, r.width, r.channels, r.data)
                    found = [d for options in PASSES[:passes] for d in reader.readtext(image, **options)]
                    readings = [{"ix": ix, "quad": [[int(round(v)) for v in p] for p in quad], "text": str(text), "prob": float(prob)} for ix, (quad, text, prob) in enumerate(found) if len(quad) >= 4]
                except Exception as e:  # isolated: the row carries its error
                    error = f"{type(e).__name__}: {e}"
                rows.append((r.name, time.perf_counter() - begun, error, readings))
            yield pd.DataFrame(rows, columns=["name", "seconds", "error", "readings"])

    return images.select("name", "height", "width", "channels", "data").mapInPandas(run, f"name string, seconds double, error string, {READINGS}")


def read_text(images: DataFrame, factory: Callable[[], TextReader], passes: int = 1) -> DataFrame:
    """name, ix, quad, text, prob: one row per reading."""
    return read_each(images, factory, passes).select("name", F.inline("readings"))


class PaddleReader:
    """A reader of another make as a :class:`TextReader`: ``engine`` has a method ``ocr`` and is built on first use."""

    def __init__(self, make: Callable[[], object]) -> None:
        self.make, self.engine = make, None

    def readtext(self, image: np.ndarray, **options):
        if self.engine is None:
            self.engine = self.make()
        try:
            result = self.engine.ocr(image, cls=False)
        except TypeError:  # newer engines have no such option
            result = self.engine.ocr(image)
        lines = result[0] if result and len(result) == 1 and isinstance(result[0], list) else result
        out = []
        for line in lines or []:
            try:
                quad = [(float(p[0]), float(p[1])) for p in line[0]]
            except (TypeError, IndexError, ValueError):
                continue
            said = line[1] if len(line) > 1 and isinstance(line[1], (list, tuple)) else ("", 0.0)
            out.append((quad, said[0], said[1]))
        return out


def ask_vlm(images: DataFrame, factory: Callable[[], VisionLanguageModel]) -> DataFrame:
    """name, reply, error, seconds: a failed call becomes an error, not a failed job. images: name, content (file bytes)."""
    urls = images.select("name", P.data_url(F.col("content"), F.col("name")).alias("url"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = built(factory)
        for f in frames:
            rows = []
            for r in f.itertuples():
                begun, reply, error = time.perf_counter(), None, None
                try:
                    reply = model.ask(r.url)
                except Exception as e:  # the caller decides what a failure means
                    error = f"{type(e).__name__}: {e}"
                rows.append((r.name, reply, error, time.perf_counter() - begun))
            yield pd.DataFrame(rows, columns=["name", "reply", "error", "seconds"])

    return urls.mapInPandas(run, "name string, reply string, error string, seconds double")


def vlm_records(replies: DataFrame) -> DataFrame:
    """name, boxes (x, y, w, h, text), error, and seconds where the replies have them; a reply without JSON holds nothing."""
    parsed = F.from_json(P.extract_json(F.coalesce("reply", F.lit(""))), schemas.REPLY)
    return replies.select("name", F.coalesce(G.spelled_boxes(parsed["detections"]), F.array()).alias("boxes"), "error", *(c for c in replies.columns if c == "seconds"))
