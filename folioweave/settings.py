"""Settings from the environment, a .env file and the session, read once."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Each field is set by the environment variable of its name in capitals, else by its default."""

    # Names and defaults that configurations rely on.
    log_level: str = "INFO"
    log_dir: str = "logs"
    log_to_file: bool = True
    log_max_bytes: int = 5_242_880
    log_backup_count: int = 5
    outputs_dir: str = "outputs"
    preprocessing_enable_deskew: bool = True
    preprocessing_enable_denoise: bool = True
    preprocessing_enable_contrast: bool = True
    preprocessing_enable_threshold: bool = True
    preprocessing_enable_border_cleanup: bool = True
    preprocessing_clahe_clip_limit: float = 2.0
    preprocessing_clahe_tile_grid_size: int = 8
    preprocessing_threshold_block_size: int = 31
    preprocessing_threshold_c: int = 15
    preprocessing_denoise_kernel_size: int = 3
    preprocessing_border_margin: int = 12
    crop_min_width: int = 40
    crop_min_height: int = 40
    entry_timeout_seconds: float = 20.0
    extraction_backend: str = "auto"
    model_base_url: str = ""
    model_api_key: str = ""
    model_id: str = ""
    model_fallback_id: str = ""
    model_timeout_seconds: float = 120
    model_max_retries: int = 3
    model_quality_retries: int = 3
    model_temperature: float = 0.0
    model_max_tokens: int = 256
    validation_ocr_confidence_threshold: float = 0.8
    ocr_language: str = "hi"

    def preprocessing(self):
        """The same as options of the preprocessing operator."""
        from .operators.preprocess import STEPS, Options

        steps = tuple(s for s in STEPS if getattr(self, f"preprocessing_enable_{s}"))
        own = {"kernel": "denoise_kernel_size", "clip": "clahe_clip_limit", "tiles": "clahe_tile_grid_size", "block": "threshold_block_size", "c": "threshold_c", "margin": "border_margin"}
        return Options(steps, **{k: getattr(self, f"preprocessing_{v}") for k, v in own.items()})


def _typed(text: str, default):
    if isinstance(default, bool):
        low = text.strip().lower()
        if low not in ("1", "true", "yes", "on", "0", "false", "no", "off"):
            raise ValueError(f"not a truth value: {text}")
        return low in ("1", "true", "yes", "on")
    return type(default)(text)


def env_file(path: str | Path) -> dict[str, str]:
    """NAME=value lines of a file, without comments and outer quotes; empty if there is no file."""
    out = {}
    for line in Path(path).read_text("utf-8").splitlines() if Path(path).is_file() else ():
        name, equals, value = line.strip().removeprefix("export ").partition("=")
        if equals and not name.startswith("#"):
            value = value.strip()
            out[name.strip().upper()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return out


def load(env: dict[str, str] | None = None, file: str | Path = ".env", spark: SparkSession | None = None) -> Settings:
    """Of equal names the session's spark.folioweave.<field> counts, then the environment's, then the file's."""
    given = env_file(file) | {k.upper(): v for k, v in (os.environ if env is None else env).items()}
    found = {}
    for f in fields(Settings):
        text = spark.conf.get(f"spark.folioweave.{f.name}", None) if spark else None
        text = given.get(f.name.upper()) if text is None else text
        if text is not None:
            found[f.name] = _typed(text, f.default)
    return Settings(**found)


@lru_cache(maxsize=1)
def settings() -> Settings:
    return load()
