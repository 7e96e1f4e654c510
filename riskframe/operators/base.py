"""Fitted stages: fit is one aggregate, the fitted numbers become literals."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame


@dataclass
class Fitted:
    """A fitted, JSON-serialisable stage; ``transform`` is a projection."""

    kind: str
    params: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - overridden
        raise NotImplementedError

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "Fitted":
        from . import clean, encode, scale
        d = json.loads(text)
        registry = {**clean.STAGES, **encode.STAGES, **scale.STAGES}
        return registry[d["kind"]](kind=d["kind"], params=d["params"])
