"""Rules kept as data: hour limits and the board registry."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULT_SETTINGS = Path(__file__).parent / "config" / "settings.toml"


@dataclass(frozen=True)
class HourLimits:
    """Accepted range of stated hours, overall and per period."""

    minimum: Decimal
    maximum: Decimal
    by_period: dict[str, Decimal]


@dataclass(frozen=True)
class Board:
    """One source board; postings are keyed by ``source_key``."""

    adapter_id: str
    source_key: str
    company: str
    enabled: bool = True


def load_hour_limits(path: Path | str = DEFAULT_SETTINGS) -> HourLimits:
    hours = _toml(path).get("hours")
    if not isinstance(hours, dict) or not isinstance(hours.get("maximum_by_period"), dict):
        raise ValueError(f"{path}: [hours] and [hours.maximum_by_period] are required")
    if hours.get("minimum") is None or hours.get("maximum") is None:
        raise ValueError(f"{path}: hours.minimum and hours.maximum are required")
    return HourLimits(
        minimum=Decimal(str(hours["minimum"])),
        maximum=Decimal(str(hours["maximum"])),
        by_period={p: Decimal(str(v)) for p, v in hours["maximum_by_period"].items()},
    )


def load_boards(path: Path | str = DEFAULT_SETTINGS) -> list[Board]:
    return [
        Board(b["adapter_id"], b.get("source_key", b["adapter_id"]), b["company"], b.get("enabled", True))
        for b in _toml(path).get("boards", [])
    ]


def boards_frame(spark: SparkSession, boards: list[Board]) -> DataFrame:
    """The registry as a table; ``board_ord`` keeps the configured order."""
    return spark.createDataFrame(
        [(b.adapter_id, b.source_key, b.company, i) for i, b in enumerate(boards)],
        "adapter_id string, source_key string, company string, board_ord int",
    )


def _toml(path: Path | str) -> dict:
    with open(path, "rb") as handle:
        return tomllib.load(handle)
