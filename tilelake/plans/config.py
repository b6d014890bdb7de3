"""Configuration: frozen dataclasses, dotted overrides, validation. Numbers may be written as a quotient, 256/224."""

from __future__ import annotations

import dataclasses
import typing
from dataclasses import dataclass, field
from fractions import Fraction

from tilelake.functions.metadata import TARGET_MPP


@dataclass(frozen=True)
class InputConfig:
    path: str = ""
    glob: str = "*.svs"
    backend: str = "auto"
    num_slides: int | None = None
    level: int | None = None


@dataclass(frozen=True)
class StainConfig:
    enabled: bool = True
    method: str = "macenko"
    template: str | None = None
    exact: bool = True


@dataclass(frozen=True)
class FeatureConfig:
    enabled: bool = True
    model: str = "histogram"
    batch_size: int = 256
    width: int = 768


@dataclass(frozen=True)
class OutputConfig:
    path: str = ""
    format: str = "parquet"
    features: bool = True
    coords: bool = True
    patch_index_grid: bool = True
    patches: bool = True
    normalized_patches: bool = True
    status_markers: str | None = None


@dataclass(frozen=True)
class Config:
    input: InputConfig = field(default_factory=InputConfig)
    output: OutputConfig = field(default_factory=OutputConfig)
    stain: StainConfig = field(default_factory=StainConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    patch_size: int = 224
    target_mpp: float = TARGET_MPP
    foreground_mode: str = "rgb"
    retry_failed: bool = False
    slides_per_batch: int | None = None

    def validate(self) -> Config:
        if self.output.format not in ("parquet", "zarr"):
            raise ValueError(f"unknown output format {self.output.format!r}")
        if self.stain.method != "macenko":
            raise ValueError(f"unknown stain method {self.stain.method!r}")
        if self.output.normalized_patches and not self.stain.enabled:
            raise ValueError("normalized patches can't be saved without stain normalisation")
        if self.patch_size < 1 or self.target_mpp <= 0 or self.features.batch_size < 1:
            raise ValueError("patch_size, target_mpp and batch_size must be positive")
        if self.foreground_mode not in ("rgb", "gray"):
            raise ValueError("foreground_mode is rgb or gray")
        return self


def _parse(text: str, kind: object) -> object:
    options = typing.get_args(kind) or (kind,)
    if text.lower() in ("", "null", "none") and type(None) in options:
        return None
    if bool in options:
        if text.lower() not in ("true", "false"):
            raise ValueError(f"{text!r} is not true or false")
        return text.lower() == "true"
    if int in options:
        return int(text)
    if float in options:
        a, _, b = text.partition("/")
        return float(a) / float(b) if b else float(Fraction(text)) if "." not in text and "e" not in text.lower() else float(text)
    return text


def override(config: Config, *items: str) -> Config:
    """Applies 'a.b=value' items."""
    for item in items:
        key, eq, text = item.partition("=")
        if not eq:
            raise ValueError(f"{item!r} is not key=value")
        names = key.strip().split(".")
        chain: list[object] = [config]
        for n in names:
            if not dataclasses.is_dataclass(chain[-1]) or n not in {f.name for f in dataclasses.fields(chain[-1])}:
                raise ValueError(f"there is no option {key!r}")
            chain.append(getattr(chain[-1], n))
        kind = typing.get_type_hints(type(chain[-2]))[names[-1]]
        if dataclasses.is_dataclass(kind):
            raise ValueError(f"{key!r} is a group of options")
        value: object = _parse(text.strip(), kind)
        for owner, n in zip(reversed(chain[:-1]), reversed(names), strict=True):
            value = dataclasses.replace(owner, **{n: value})  # type: ignore[type-var]
        config = value  # type: ignore[assignment]
    return config.validate()


def show(config: Config) -> str:
    out = []
    for f in dataclasses.fields(config):
        v = getattr(config, f.name)
        if dataclasses.is_dataclass(v):
            out += [f"{f.name}:"] + [f"  {g.name}: {getattr(v, g.name)}" for g in dataclasses.fields(v)]
        else:
            out.append(f"{f.name}: {v}")
    return "\n".join(out)
