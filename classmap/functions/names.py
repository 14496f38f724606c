"""Column references by exact name; headers such as "No." contain dots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(c: str | Column) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]
