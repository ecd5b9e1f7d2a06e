"""Fitted models on any Hadoop file system: load what is there, else fit and save."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from tagweave.operators.staging import remove


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(hadoop_path)


def _about(path: str) -> str:
    return f"{path.rstrip('/')}.about"


def remember(spark: SparkSession, path: str, about: dict) -> None:
    """Write beside a model what it was fitted with."""
    text = json.dumps(about, sort_keys=True, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
        _about(path))


def keep(spark: SparkSession, path: str, save: Callable[[], None], about: dict) -> None:
    """Store a model and then its note. A model without one is refused later, so
    one that was half written, or replaced in part, is never taken."""
    remove(spark, _about(path))
    save()
    remember(spark, path, about)


def refuse_other(spark: SparkSession, path: str, about: dict) -> None:
    """Raise if the model at ``path`` was fitted with anything else, or has no note."""
    if not exists(spark, _about(path)):
        raise ValueError(f"the model at {path} has no note of what it was fitted with; retrain "
                         "it or name another folder")
    kept = json.loads(spark.read.text(_about(path)).first()["value"])
    wanted = json.loads(json.dumps(about, sort_keys=True, default=str))
    differing = sorted(k for k in {*kept, *wanted} if kept.get(k) != wanted.get(k))
    if differing:
        raise ValueError(f"the model at {path} was fitted with other {', '.join(differing)}; "
                         "retrain it or name another folder")


def load_or_fit(spark: SparkSession, path: str | None, kind: type,
                fit: Callable[[], object], retrain: bool = False, about: dict | None = None):
    """The model of class ``kind`` at ``path``. It is fitted, and saved when a
    path is given, if nothing is there yet or ``retrain`` asks for it. A stored model
    that was fitted with something else than ``about`` says is refused."""
    if path and not retrain and exists(spark, path):
        refuse_other(spark, path, about or {})
        return kind.load(path)
    model = fit()
    if path:
        keep(spark, path, lambda: model.write().overwrite().save(path), about or {})
    return model
