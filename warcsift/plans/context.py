"""Shared, per-session building blocks for the registered queries."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.article import Staged, stage
from ..operators.language import train_profile
from ..operators.records import classify
from ..sources.responses import load_table, responses

_CACHE: dict[tuple, DataFrame] = {}
_STAGED: list[Staged] = []


def _key(spark: SparkSession, *parts) -> tuple:
    return (spark.sparkContext.applicationId, *parts)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language profile trained on the ``documents`` table, materialised once."""
    k = _key(spark, "profile", sf_dir)
    if k not in _CACHE:
        p = train_profile(load_table(spark, sf_dir, "documents"))
        p = p.persist(StorageLevel.MEMORY_AND_DISK)
        p.count()
        _CACHE[k] = p
    return _CACHE[k]


def classified(spark: SparkSession, sf_dir: str, patterns: list[str] | None = None
               ) -> DataFrame:
    return classify(responses(spark, sf_dir), ["*"] if patterns is None else patterns)


def disp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of ``responses`` with article fields and disposition (glob ``*``)."""
    k = _key(spark, "disp", sf_dir)
    if k not in _CACHE:
        staged = stage(classified(spark, sf_dir), profile(spark, sf_dir))
        _STAGED.append(staged)
        _CACHE[k] = staged.disp
    return _CACHE[k]


def reset() -> None:
    """Forget the shared inputs and delete what was stored for them."""
    for staged in _STAGED:
        staged.release()
    for df in _CACHE.values():
        df.unpersist()
    _STAGED.clear()
    _CACHE.clear()
