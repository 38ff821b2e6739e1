"""Small catalogues for tests."""

from __future__ import annotations

from datetime import datetime

from confluo.schemas import CATALOGUE


def doc(source, id, name, entity=None, summary=None, storyline=None, genres=(), platforms=(), devs=(), date=None):
    return (
        source, str(id), entity or f"{source}-{id}", name, storyline, summary, list(genres), list(platforms), list(devs),
        datetime.fromisoformat(date) if isinstance(date, str) else date, 0,
    )


def catalogue(spark, docs):
    return spark.createDataFrame(docs, CATALOGUE)
