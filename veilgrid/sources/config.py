"""Configuration: a section of a TOML file, checked field by field."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass
from pathlib import Path

#: What to do about images that cannot be read: fail the run, or list them among the failures and go on.
UNREADABLE = ("fail", "list")
RUN_MODES = ("full", "sam3", "postprocess", "deidentification", "report")


@dataclass(frozen=True)
class PipelineConfig:
    input_path: Path
    output_dir: Path
    output_json: Path
    run_mode: str = "full"
    prompt: str = "panoramic radiograph"
    fallback_prompt: str | None = None
    save_artifacts: bool = True
    kernel_size: int = 9
    iterations: int = 5
    large_box_ratio: float = 0.1
    merge_distance: float = 10.0
    max_area: float | None = 120000.0
    axis_x: float = 0.45
    axis_y: float = 0.35
    proximity: float = 0.0
    padding: int = 10
    languages: tuple[str, ...] = ("en",)
    gpu: bool = False
    checkpoint: Path | None = None
    unreadable: str = "fail"


def _typed(section: dict, key: str, kinds: tuple[type, ...], default=None, required: bool = False):
    value = section.get(key, default)
    if value is None:
        if required:
            raise ValueError(f"missing setting: {key}")
        return None
    if isinstance(value, bool) and bool not in kinds or not isinstance(value, kinds):
        raise ValueError(f"{key} must be {' or '.join(k.__name__ for k in kinds)}")
    return value


def parse_config(text: str, base: Path, section: str = "pipeline") -> PipelineConfig:
    """Paths are relative to ``base``; an area limit of 0 or less means none; booleans are not numbers."""
    raw = tomllib.loads(text).get(section)
    if not isinstance(raw, dict):
        raise ValueError(f"missing section: {section}")
    path = lambda key, required=True: None if (v := _typed(raw, key, (str,), required=required)) is None else (base / v).resolve()
    d = PipelineConfig.__dataclass_fields__
    number = lambda key, cast: cast(_typed(raw, key, (int, float) if cast is float else (int,), d[key].default))
    mode = _typed(raw, "run_mode", (str,), "full").strip().lower()
    if mode not in RUN_MODES:
        raise ValueError(f"run_mode must be one of {', '.join(RUN_MODES)}")
    if (unreadable := _typed(raw, "unreadable", (str,), "fail")) not in UNREADABLE:
        raise ValueError(f"unreadable must be one of {', '.join(UNREADABLE)}")
    languages = tuple(_typed(raw, "languages", (list,), ["en"]))
    if not languages or not all(isinstance(x, str) and x for x in languages):
        raise ValueError("languages must name at least one language")
    limit = _typed(raw, "max_area", (int, float), 120000.0)
    config = PipelineConfig(
        path("input_path"), path("output_dir"), path("output_json"), mode, _typed(raw, "prompt", (str,), d["prompt"].default), _typed(raw, "fallback_prompt", (str,)) or None,
        _typed(raw, "save_artifacts", (bool,), True), number("kernel_size", int), number("iterations", int), number("large_box_ratio", float), number("merge_distance", float),
        float(limit) if limit > 0 else None, number("axis_x", float), number("axis_y", float), number("proximity", float), number("padding", int), languages, _typed(raw, "gpu", (bool,), False), path("checkpoint", False), unreadable,
    )
    if config.kernel_size < 1 or config.kernel_size % 2 == 0 or config.iterations < 1 or not 0 < config.large_box_ratio <= 1:
        raise ValueError("kernel_size must be odd and positive, iterations positive, large_box_ratio in (0, 1]")
    return config


def load_config(path: str | Path, section: str = "pipeline") -> PipelineConfig:
    path = Path(path)
    return parse_config(path.read_text(encoding="utf-8"), path.parent, section)
