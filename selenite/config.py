"""Parameters of the pipeline's stages, with their types checked."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    scales: tuple[int, ...] = (4,)
    z: float = 3.0
    min_size: int = 12
    border: float = 0.0
    method: str = "box"
    contrast_bar: float = 1.5
    lead_area: tuple[int, int] = (200, 50000)
    group_reach: int = 8
    fdr_level: float = 0.05
    max_shift_share: float = 0.15

    def with_values(self, values: dict[str, object]) -> Config:
        """Known keys of the right kind win; others, and nulls, only warn."""
        own = {f.name: getattr(self, f.name) for f in fields(self)}
        good = {}
        for key, value in values.items():
            value = tuple(value) if isinstance(value, list) else value
            if value is None:
                continue
            if key not in own or not isinstance(value, (int, float) if isinstance(own[key], float) else type(own[key])):
                warnings.warn(f"config: {key}={value!r} left out", stacklevel=2)
            else:
                good[key] = value
        return replace(self, **good)

    @classmethod
    def load(cls, text: str = "{}", **overrides: object) -> Config:
        """From a JSON text, then from what is given by name."""
        return cls().with_values(json.loads(text)).with_values(overrides)
