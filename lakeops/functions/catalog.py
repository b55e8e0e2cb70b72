"""Named column functions that a column spec can ask for; all are plain expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "*" * 16
CATALOG: dict[str, Callable[[Column], Column]] = {"mask-asterisk": lambda c: F.lit(MASK)}


def register(name: str, function: Callable[[Column], Column]) -> None:
    CATALOG[name] = function


def function(name: str) -> Callable[[Column], Column]:
    if name not in CATALOG:
        raise KeyError(f"no column function named {name}")
    return CATALOG[name]
