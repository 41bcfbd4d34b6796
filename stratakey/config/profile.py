"""Engine settings: presets, merged profiles, and where a value comes from."""

from __future__ import annotations

import json
import os
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import SparkSession

from .versions import memory_bytes


@dataclass(frozen=True)
class Preset:
    cores: int
    memory: str
    driver: str


# Resources by name.
PRESETS = {
    "MICRO": Preset(2, "4G", "2324M"),
    "SMALL": Preset(2, "8G", "4648M"),
    "LARGE": Preset(4, "16G", "9296M"),
    "XLARGE": Preset(8, "32G", "24G"),
}


@dataclass
class Profile:
    name: str = "default"
    preset: str = "SMALL"
    master: str | None = None
    shuffle_partitions: int | None = None
    checkpoint_dir: str | None = None
    warehouse: str | None = None
    packages: list[str] = field(default_factory=list)
    settings: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.preset not in PRESETS:
            raise ValueError(f"unknown preset {self.preset!r}; known: {', '.join(PRESETS)}")
        names = [p.rsplit(":", 1)[0] for p in self.packages]
        if len(set(names)) < len(names):
            raise ValueError("a package is named twice")

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> Profile:
        known = {f.name for f in fields(cls)}
        for k in sorted(set(raw) - known):
            warnings.warn(f"unknown setting {k!r} is ignored", stacklevel=2)
        return cls(**{k: v for k, v in raw.items() if k in known})

    @classmethod
    def load(cls, path: str) -> Profile:
        with open(path) as f:
            return cls.of(json.load(f))

    def session(self) -> SparkSession:
        p = PRESETS[self.preset]
        memory_bytes(p.driver)
        b = SparkSession.builder.appName(self.name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
        b = b.config("spark.sql.sources.partitionColumnTypeInference.enabled", "false").config("spark.driver.memory", p.driver.lower()).config("spark.executor.memory", p.memory.lower()).config("spark.executor.cores", p.cores)
        b = b.master(self.master) if self.master else b
        named = {"spark.sql.shuffle.partitions": self.shuffle_partitions, "spark.checkpoint.dir": self.checkpoint_dir, "spark.sql.warehouse.dir": self.warehouse}
        for k, v in ({k: v for k, v in named.items() if v is not None} | self.settings).items():
            b = b.config(k, v)
        return b.getOrCreate()


def merge(*profiles: Mapping[str, Any]) -> dict[str, Any]:
    """Later values win unless they are empty; maps are merged key by key."""
    out: dict[str, Any] = {}
    for p in profiles:
        for k, v in p.items():
            if isinstance(v, Mapping) and isinstance(out.get(k), Mapping):
                out[k] = merge(out[k], v)
            elif v not in (None, "", [], {}):
                out[k] = v
    return out


def setting(name: str, given: Any = None, profile: Mapping[str, Any] | None = None, default: Any = None) -> Any:
    """What the caller gives, else the environment (STRATAKEY_<NAME>), else the profile, else the default."""
    for v in (given, os.environ.get(f"STRATAKEY_{name.upper().replace('-', '_')}"), (profile or {}).get(name)):
        if v not in (None, ""):
            return v
    return default
