"""Where tables are read from and written to.

Four interchangeable places share two methods, ``read(name)`` and
``write(df, name, mode)``: files below a folder, a relational database over
JDBC, the session catalog (Hive included when the session has it), and frames
already at hand. Every one returns a lazy DataFrame, so column pruning and
predicate pushdown reach the source.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def _ordered(df: DataFrame, sort_by: str | None) -> DataFrame:
    # A global sort costs a range shuffle and a relational sink forgets it.
    return df.orderBy(sort_by) if sort_by else df


@dataclass(frozen=True)
class FileTables:
    """Files below ``root``, one folder or ``<name>.<ext>`` file per table."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    suffix: str = ""
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}{self.suffix}"

    def read(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read.format(self.format).options(**self.options)
        return (reader.schema(schema) if schema else reader).load(self.path(name))

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              sort_by: str | None = None) -> None:
        """An overwrite is written beside the table and takes its place when it is whole,
        so it may read the table it replaces and no reader meets half of it."""
        path, writer = self.path(name), _ordered(df, sort_by).write.format(
            self.format).options(**self.options)
        if mode != "overwrite":
            writer.mode(mode).save(path)
            return
        jvm = self.spark._jvm
        place = lambda text: jvm.org.apache.hadoop.fs.Path(text)
        files = place(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(place(path)):
            writer.mode("error").save(path)
            return
        version = uuid.uuid4().hex[:12]
        fresh, old = f"{path}.new-{version}", f"{path}.old-{version}"
        try:
            writer.mode("error").save(fresh)
        except Exception:
            files.delete(place(fresh), True)
            raise
        if not files.rename(place(path), place(old)):
            raise OSError(f"cannot replace {path}; the new table is {fresh}")
        if not files.rename(place(fresh), place(path)):
            if not files.rename(place(old), place(path)):
                raise OSError(f"cannot replace {path}; the old table is {old}")
            raise OSError(f"cannot replace {path}; it is as it was, the new table is {fresh}")
        files.delete(place(old), True)


@dataclass(frozen=True)
class Split:
    """How one JDBC table is cut into parallel range reads."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def check_unsplit(name: str, rows: int, most: int) -> None:
    """Raise if a table is too large to be read in one task."""
    if rows > most:
        raise ValueError(f"table {name} has {rows} rows, no split and no key to cut it by; "
                         "one task would read them")


def quantile_query(table: str, column: str, parts: int) -> str:
    """SQL for the last key of each of ``parts`` equal runs of a table's rows."""
    return (f"(SELECT MAX({column}) AS bound FROM (SELECT {column}, NTILE({parts}) OVER "
            f"(ORDER BY {column}) AS run FROM {table} WHERE {column} IS NOT NULL) runs "
            "GROUP BY run) bounds")


def range_predicates(column: str, bounds: Iterable) -> list[str]:
    """Conditions of which each row meets just one, cut after the given keys.

    Rows without a key meet the first. Equal bounds, which a frequent key gives, are one.
    """
    def literal(value) -> str:
        if isinstance(value, (int, float, Decimal)):
            return str(value)
        return "'" + str(value).replace("'", "''") + "'"

    cuts = [literal(b) for b in sorted(set(bounds))][:-1]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} <= {cuts[0]} OR {column} IS NULL", *between, f"{column} > {cuts[-1]}"]


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a relational database.

    Without a ``Split`` Spark reads a table in one task. One of more than ``unsplit_rows``
    rows is cut by its column in ``keys`` at the quantiles that the database finds, so
    that tasks read equal shares whatever the keys are; without such a column it is
    refused. Overwrite keeps the table's own DDL (TRUNCATE, INSERT).
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str]
    splits: Mapping[str, Split] = field(default_factory=dict)
    fetch_size: int = 10_000
    batch_size: int = 10_000
    write_partitions: int = 32
    unsplit_rows: int = 1_000_000
    keys: Mapping[str, str] = field(default_factory=dict)

    def read_options(self, name: str) -> dict[str, str]:
        options = {**self.properties, "url": self.url, "dbtable": name,
                   "fetchsize": str(self.fetch_size)}
        split = self.splits.get(name)
        if split:
            options |= {"partitionColumn": split.column,
                        "lowerBound": str(split.lower),
                        "upperBound": str(split.upper),
                        "numPartitions": str(split.partitions)}
        return options

    def write_options(self, name: str) -> dict[str, str]:
        return {**self.properties, "url": self.url, "dbtable": name,
                "truncate": "true", "batchsize": str(self.batch_size),
                "numPartitions": str(self.write_partitions)}

    def read(self, name: str) -> DataFrame:
        if name in self.splits:
            return self._load(self.read_options(name))
        predicates = self.cut(name, self._one(f"(SELECT COUNT(*) AS n FROM {name}) counted"))
        if not predicates:
            return self._load(self.read_options(name))
        properties = {**self.properties, "fetchsize": str(self.fetch_size)}
        return self.spark.read.jdbc(self.url, name, predicates=predicates, properties=properties)

    def cut(self, name: str, rows: int) -> list[str]:
        """Conditions for reads of at most about ``unsplit_rows`` rows; none for one read."""
        if rows <= self.unsplit_rows:
            return []
        if name not in self.keys:
            check_unsplit(name, rows, self.unsplit_rows)
        column, parts = self.keys[name], -(-rows // self.unsplit_rows)
        found = self._load({**self.read_options(name),
                            "dbtable": quantile_query(name, column, parts)}).collect()
        return range_predicates(column, [r[0] for r in found if r[0] is not None])

    def _one(self, query: str) -> int:
        return int(self._load({**self.read_options("one"), "dbtable": query}).first()[0])

    def _load(self, options: Mapping[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**options).load()

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              sort_by: str | None = None) -> None:
        (_ordered(df, sort_by).write.format("jdbc")
         .options(**self.write_options(name)).mode(mode).save())


@dataclass(frozen=True)
class Buckets:
    """How tables are dealt to files: rows of one key are in one of ``count`` buckets.

    Tables with the same buckets are joined and grouped by the key where they lie.
    ``count`` should give files of some 100 MB of the largest table.
    """

    column: str
    count: int


@dataclass(frozen=True)
class CatalogTables:
    """Tables of the session catalog, optionally inside one database.

    With ``buckets`` tables that have the bucket column are written by it, one file
    for each bucket, sorted within; ``sort_by`` may name no other column then.
    With ``versioned`` an overwrite writes a new table and then points a view
    of the plain name at it, so a reader never meets a half-written tag. An existing
    plain table becomes the first version, the version before the last is dropped.
    """

    spark: SparkSession
    database: str | None = None
    format: str = "parquet"
    versioned: bool = False
    buckets: Buckets | None = None

    def qualified(self, name: str) -> str:
        return f"`{self.database}`.`{name}`" if self.database else f"`{name}`"

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.qualified(name))

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              sort_by: str | None = None) -> None:
        writer = self._writer(df, sort_by).format(self.format)
        if not self.versioned:
            writer.mode(mode).saveAsTable(self.qualified(name))
            return
        kept = self._version(name)
        if mode != "overwrite":
            writer.mode(mode).saveAsTable(kept or self.qualified(name))
            if kept is None:
                self._point(name, self._renamed(name))
            return
        version = self.qualified(f"{name}_{uuid.uuid4().hex[:12]}")
        try:
            writer.mode("error").saveAsTable(version)
            if kept is None and self.spark.catalog.tableExists(self.qualified(name)):
                kept = self._renamed(name)
            self._point(name, version)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
            raise
        self._drop_others(name, {version, kept})

    def _writer(self, df: DataFrame, sort_by: str | None):
        held = self.buckets
        if held is None or held.column not in df.columns:
            return _ordered(df, sort_by).write
        if sort_by not in (None, held.column):
            raise ValueError(f"tables are bucketed and sorted by {held.column}, not {sort_by}")
        # Spark places rows by the hash that it cuts buckets with: a task writes one file.
        return (df.repartition(held.count, held.column).write
                .bucketBy(held.count, held.column).sortBy(held.column))

    def _point(self, name: str, version: str) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.qualified(name)} AS SELECT * FROM {version}")

    def _renamed(self, name: str) -> str:
        """A plain table under the name of a version."""
        version = self.qualified(f"{name}_{uuid.uuid4().hex[:12]}")
        self.spark.sql(f"ALTER TABLE {self.qualified(name)} RENAME TO {version}")
        return version

    def _version(self, name: str) -> str | None:
        """The table that the view of this name shows; None if it is no view."""
        if not self.spark.catalog.tableExists(self.qualified(name)):
            return None
        about = {r["col_name"]: r["data_type"] for r in self.spark.sql(
            f"DESCRIBE TABLE EXTENDED {self.qualified(name)}").collect()}
        text = about.get("View Text") or ""
        return text.rpartition(" FROM ")[2].strip() or None

    def _drop_others(self, name: str, keep: set[str | None]) -> None:
        """Drop older versions; the last one stays for those who still read it."""
        shape = re.compile(re.escape(name.lower()) + "_[0-9a-f]{12}")
        for row in self.spark.sql("SHOW TABLES" + (
                f" IN `{self.database}`" if self.database else "")).collect():
            table = self.qualified(row["tableName"])
            if shape.fullmatch(row["tableName"].lower()) and table not in keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")


class FrameTables:
    """Named DataFrames already built in this session; writes are kept by name, as plans."""

    lazy = True

    def __init__(self, frames: Mapping[str, DataFrame] | None = None):
        self.frames = dict(frames or {})

    def read(self, name: str) -> DataFrame:
        if name not in self.frames:
            raise KeyError(f"no table {name!r}; known: {sorted(self.frames)}")
        return self.frames[name]

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              sort_by: str | None = None) -> None:
        df = _ordered(df, sort_by)
        if mode == "append" and name in self.frames:
            df = self.frames[name].unionByName(df)
        self.frames[name] = df
