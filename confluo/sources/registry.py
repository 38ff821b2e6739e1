"""Named sources: anything that can be read into the common catalogue layout."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.schemas import CATALOGUE


@dataclass(frozen=True)
class SourceSpec:
    """A source plug-in: a name and a reader returning catalogue columns (``source`` is filled in)."""

    name: str
    read: Callable[[SparkSession, str], DataFrame]


def conform(df: DataFrame, source: str) -> DataFrame:
    """Exactly the catalogue columns, with their types; columns a source does not have are null."""
    present = set(df.columns)
    columns = [
        f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in CATALOGUE.fields
        if f.name != "source"
    ]
    return df.selectExpr(*columns).withColumn("source", F.lit(source)).select(*CATALOGUE.names)


class Registry:
    """Sources in registration order; the order decides resolution and the order of fused hits."""

    def __init__(self, specs: Iterable[SourceSpec] = ()):
        self._specs: dict[str, SourceSpec] = {}
        for spec in specs:
            self.add(spec)

    def add(self, spec: SourceSpec) -> Registry:
        if spec.name in self._specs:
            raise ValueError(f"source {spec.name!r} is already registered")
        self._specs[spec.name] = spec
        return self

    @property
    def names(self) -> list[str]:
        return list(self._specs)

    def load(self, spark: SparkSession, path: str, only: str | None = None) -> DataFrame:
        """Union of all sources, or the one named by ``only``."""
        if only is not None and only not in self._specs:
            raise KeyError(f"unknown source {only!r}, have {self.names}")
        chosen = [only] if only is not None else self.names
        frames = [conform(self._specs[n].read(spark, path), n) for n in chosen]
        result = frames[0]
        for frame in frames[1:]:
            result = result.unionByName(frame)
        return result
