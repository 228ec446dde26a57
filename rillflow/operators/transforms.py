"""Running several transforms of one frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

Transform = Callable[[DataFrame], DataFrame]


def apply_all(df: DataFrame, transforms: dict[str, Transform]) -> dict[str, DataFrame]:
    """Each transform applied to the same frame; all results stay lazy."""
    return {name: fn(df) for name, fn in transforms.items()}


class shared_input:
    """`with shared_input(df) as d:` keeps a frame that several actions read, and releases it."""

    def __init__(self, df: DataFrame):
        self.df = df

    def __enter__(self) -> DataFrame:
        return self.df.persist(StorageLevel.MEMORY_AND_DISK)

    def __exit__(self, *exc) -> None:
        self.df.unpersist()
