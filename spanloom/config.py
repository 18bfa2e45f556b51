"""Settings from YAML, grouped by what they steer. Keys that nothing here reads are passed over."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from spanloom.functions.expansion import ExpansionConfig

# The names of sections and keys, and their defaults, are the file format's.


@dataclass(frozen=True)
class SourceConfig:
    """Where documents come from. ``type`` is a format of Spark's readers, with ``table`` as its path (``jdbc``: as its table); ``keyset``, a
    table that any Python database driver reaches (``module``); or ``mysql``, the same over pymysql."""

    type: str = "parquet"
    host: str = "localhost"
    port: int = 9306
    table: str = "documents"
    batch_size: int = 1000
    connection_timeout: int = 30
    module: str = "pymysql"
    connect: dict = field(default_factory=dict)  #: further arguments of the driver's connect(), or options of the reader
    partitions: int = 8


@dataclass(frozen=True)
class ModelConfig:
    """``name`` is the tagger: ``rule`` or a token-classification model. ``tokenizer`` is a tokenizer file that chunks are cut by."""

    name: str = "rule"
    tokenizer: str = ""
    max_tokens: int = 512
    overlap_ratio: float = 0.0
    min_confidence: float = 0.5


@dataclass(frozen=True)
class DeviceConfig:
    device_id: int = 0
    batch_size: int = 32
    precision: str = "float16"


@dataclass(frozen=True)
class OutputConfig:
    format: str = "csv"
    path: str = "./results/output"
    delimiter: str = "|"
    include_confidence: bool = True
    include_positions: bool = False
    enable_expansion: bool = False
    expansion: ExpansionConfig = field(default_factory=ExpansionConfig)


@dataclass(frozen=True)
class Config:
    source: SourceConfig = field(default_factory=SourceConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    devices: tuple[DeviceConfig, ...] = ()
    output: OutputConfig = field(default_factory=OutputConfig)
    workers: int = 4  #: partitions of documents, at least
    checkpoint: str = "./checkpoint"  #: the folder of the run's state
    verbose: bool = False

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> Config:
        def section(kind: type, name: str, **more: Any):
            given = (values.get(name) or {}) | more
            return kind(**{f.name: given[f.name] for f in fields(kind) if f.name in given})

        params = dict((values.get("output") or {}).get("expansion_params") or {})
        if "expand_entity_types" in params:
            params["expand_entity_types"] = tuple(params["expand_entity_types"])
        expansion = ExpansionConfig(**{f.name: params[f.name] for f in fields(ExpansionConfig) if f.name in params})
        one = lambda name, key, default: (values.get(name) or {}).get(key, default)
        return cls(
            section(SourceConfig, "source"),
            section(ModelConfig, "model"),
            tuple(DeviceConfig(**{f.name: d[f.name] for f in fields(DeviceConfig) if f.name in d}) for d in values.get("gpu_devices") or ()),
            section(OutputConfig, "output", expansion=expansion),
            one("tokenizer", "num_workers", cls.workers),
            one("checkpoint", "file", cls.checkpoint),
            one("logging", "verbose", cls.verbose),
        )


def load_config(path: str) -> Config:
    """Settings from a YAML file; a missing file is a FileNotFoundError."""
    import yaml

    return Config.from_dict(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
