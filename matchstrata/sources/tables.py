"""Parquet tables: full loads, partition loads, appends and upserts.

The rows of a table lie in one folder, partitioned as its declaration says, and
are read and written with Spark's own Parquet source; ``_about.json`` beside it
holds the declaration (columns, partition columns, keys, constraints) and names
the folder.

* A full load writes a new folder, holds it to the constraints, and then the
  declaration names that one; the former folder stays until the load after next.
* A partition load is Spark's dynamic partition overwrite: the partitions found
  in the frame are replaced when the job commits, the others are not touched.
* A table with keys is bucketed and sorted by them, so an upsert joins it without
  shuffling it; Bloom filters on the keys let the search for few keys skip row
  groups. The partitions that hold a match or take rows in are read, merged and
  replaced by a dynamic overwrite.

One writer at a time. Where a lakehouse format is on the classpath, its own
MERGE does the same work for many.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import (
    CalendarIntervalType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
)

from ..operators.contracts import Contract, ContractViolation
from ..session import Staged, shuffles_removed, stage

ABOUT = "_about.json"
# Fixed value: what Spark names the partition of NULL. A partition value '' would
# be read back as NULL, and so would that name as a value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Put before such values, and before values that begin with it, on disk.
ESCAPE = "__TEXT__"
#: Buckets of a table with keys at least, unless it is created with another number.
BUCKETS = 4
#: Rows for one bucket, and for one task that writes into it: a full load takes as many buckets as its rows need.
BUCKET_ROWS = 1_000_000
#: Up to so many keys of an upsert are looked for by value; beyond them by a join.
LISTED_KEYS = 1_000

Gate = Callable[[DataFrame], None]


def storable(df: DataFrame) -> DataFrame:
    """Columns of types Parquet cannot hold, as text."""
    odd = [f.name for f in df.schema if isinstance(f.dataType, (NullType, CalendarIntervalType))]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in odd}) if odd else df


def merged_schema(old: StructType, new: StructType) -> StructType:
    """Old columns in their order, then the new ones; types must agree."""
    known = {f.name: f.dataType for f in old}
    for f in new:
        if f.name in known and known[f.name] != f.dataType:
            raise ValueError(
                f"column '{f.name}' is {known[f.name].simpleString()} in the table "
                f"and {f.dataType.simpleString()} in the frame"
            )
    return StructType(list(old) + [f for f in new if f.name not in known])


def _escaped(c: Column) -> Column:
    odd = (c == "") | (c == NULL_PARTITION) | c.startswith(ESCAPE)
    return F.when(odd, F.concat(F.lit(ESCAPE), c)).otherwise(c)


def _unescaped(c: Column) -> Column:
    return F.when(c.startswith(ESCAPE), F.substring(c, len(ESCAPE) + 1, 1 << 30)).otherwise(c)


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, absent ones as NULL."""
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


class LakeTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- declaration ------------------------------------------------------
    def _hadoop(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _about(self) -> dict | None:
        new_path, fs = self._hadoop()
        file = new_path(f"{self.path}/{ABOUT}")
        if not fs.exists(file):
            return None
        stream = fs.open(file)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _declare(self, about: dict) -> int:
        new_path, fs = self._hadoop()
        stream = fs.create(new_path(f"{self.path}/{ABOUT}"), True)
        try:
            stream.write(bytearray(json.dumps(about), "utf-8"))
        finally:
            stream.close()
        return about["version"]

    def _existing(self) -> dict:
        about = self._about()
        if about is None:
            raise FileNotFoundError(f"no table at '{self.path}'")
        return about

    def exists(self) -> bool:
        return self._about() is not None

    def version(self) -> int | None:
        """Writes since the table was created, None for no table."""
        about = self._about()
        return None if about is None else about["version"]

    def schema(self) -> StructType:
        return StructType.fromJson(self._existing()["schema"])

    def create(
        self,
        schema: StructType,
        partition_by: Sequence[str] = (),
        checks: Mapping[str, str] | None = None,
        description: str = "",
        keys: Sequence[str] = (),
        buckets: int = BUCKETS,
    ) -> "LakeTable":
        """An empty table with fixed columns and constraints; no-op if it exists.

        With ``keys`` its files are bucketed and sorted by them, in ``buckets`` of
        them or, from a full load on, as many more as its rows need.
        """
        if not self.exists():
            self._declare(
                {
                    **self._first(partition_by, keys, buckets),
                    "description": description,
                    "schema": _nullable(schema).jsonValue(),
                    "checks": dict(checks or {}),
                }
            )
        return self

    @staticmethod
    def _first(partition_by: Sequence[str] = (), keys: Sequence[str] = (), buckets: int = BUCKETS) -> dict:
        return {
            "version": 0, "data": None, "former": None, "description": "", "checks": {},
            "partition_by": list(partition_by), "keys": list(keys), "buckets": buckets,
        }

    def _next(self, about: dict | None) -> dict:
        return self._first() if about is None else {**about, "version": about["version"] + 1}

    # -- reading ----------------------------------------------------------
    def read(self) -> DataFrame:
        """The whole table; partition filters prune folders."""
        about = self._existing()
        return self._shown(self._scan(about), about)

    def read_or_empty(self, schema: StructType) -> DataFrame:
        return self.read() if self.exists() else self.spark.createDataFrame([], schema)

    def _scan(self, about: dict) -> DataFrame:
        """The table as stored, partition values as on disk."""
        schema = StructType.fromJson(about["schema"])
        new_path, fs = self._hadoop()
        folder = f"{self.path}/{about['data']}"
        if about["data"] is None or not fs.exists(new_path(folder)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    @staticmethod
    def _texts(about: dict) -> list[str]:
        """Partition columns of texts."""
        return [
            f["name"] for f in about["schema"]["fields"]
            if f["name"] in about["partition_by"] and f["type"] == "string"
        ]

    def _shown(self, df: DataFrame, about: dict) -> DataFrame:
        """Partition values as they were given, columns in the table's order."""
        texts = self._texts(about)
        columns = [
            (_unescaped(F.col(f"`{n}`")).alias(n) if n in texts else F.col(f"`{n}`"))
            for n in (f["name"] for f in about["schema"]["fields"])
        ]
        return df.select(*columns)

    def _hidden(self, df: DataFrame, about: dict) -> DataFrame:
        """Partition values as on disk."""
        marked = {c: _escaped(F.col(f"`{c}`")) for c in self._texts(about) if c in df.columns}
        return df.withColumns(marked) if marked else df

    # -- writing ----------------------------------------------------------
    @staticmethod
    def _buckets(about: dict) -> list[str]:
        """The keys that files are bucketed by: those that are no partition columns."""
        return [k for k in about["keys"] if k not in about["partition_by"]]

    @contextmanager
    def _bucketed(self, about: dict) -> Iterator[str]:
        """The name under which the session knows the table as bucketed, for one statement or two.

        Spark keeps buckets of tables only, not of folders; the entry is external,
        so dropping it leaves the files.
        """
        name = f"matchstrata_{uuid.uuid4().hex}"
        schema = StructType.fromJson(about["schema"])
        last = [f for f in schema if f.name in about["partition_by"]]
        columns = [f for f in schema if f.name not in about["partition_by"]] + last
        keys = ", ".join(f"`{k}`" for k in self._buckets(about))
        options = {"path": f"{self.path}/{about['data']}", "partitionOverwriteMode": "dynamic"}
        options |= {f"parquet.bloom.filter.enabled#{k}": "true" for k in self._buckets(about)}
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
        quoted = ", ".join("'{}'='{}'".format(k, v.replace("'", "\\'")) for k, v in options.items())
        parts = ", ".join(f"`{c}`" for c in about["partition_by"])
        self.spark.sql(
            f"CREATE TABLE {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in columns)}) USING parquet "
            f"OPTIONS ({quoted}) {f'PARTITIONED BY ({parts})' if parts else ''} "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {about['buckets']} BUCKETS"
        )
        try:
            new_path, fs = self._hadoop()
            if parts and fs.exists(new_path(options["path"])):
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    @contextmanager
    def read_by_keys(self, about_rows: int) -> Iterator[DataFrame]:
        """The whole table, a bucket a task: what groups by its keys needs no exchange.

        The frame is to be used within the block. A table without buckets, or with too
        few for so many rows (it grew by partition loads), is read as any other.
        """
        about = self._existing()
        new_path, fs = self._hadoop()
        few = about_rows > 2 * BUCKET_ROWS * about["buckets"]
        if few or not self._buckets(about) or about["data"] is None or not fs.exists(new_path(f"{self.path}/{about['data']}")):
            yield self.read()
            return
        with self._bucketed(about) as name:
            yield self._shown(self.spark.table(name), about)

    @staticmethod
    def _needed(about: dict, about_rows: int | None) -> int:
        """Buckets of the table if a load of so many rows writes it anew."""
        return max(about["buckets"], -(-(about_rows or 0) // BUCKET_ROWS))

    @staticmethod
    def _tasks(buckets: int, about_rows: int) -> int:
        """More than ``BUCKET_ROWS`` rows a bucket are written by several tasks each: the
        hash of a multiple of the buckets tells the bucket too."""
        return buckets * max(1, -(-about_rows // (BUCKET_ROWS * buckets)))

    def placed(self, df: DataFrame, about_rows: int) -> DataFrame:
        """``df`` as a save of so many rows places it: by its keys, so that a step by key before the save shares the shuffle.

        The table must exist; one without buckets places nothing.
        """
        about = self._existing()
        keys = self._buckets(about)
        if not keys or not set(keys) <= set(df.columns):
            return df
        buckets = self._needed(about, about_rows) if about["data"] is None else about["buckets"]
        return df.repartition(self._tasks(buckets, about_rows), *[F.col(f"`{k}`") for k in keys])

    def _write(
        self, df: DataFrame, about: dict, overwrite: bool, name: str | None = None, about_rows: int = 0,
        placed: bool = False,
    ) -> None:
        """Add the rows of ``df`` (as on disk), or replace the partitions found in it.

        ``name``: what the session knows the bucketed table as, if it does already.
        ``placed``: the rows already lie as :meth:`placed` puts them.
        """
        by = about["partition_by"]
        if self._buckets(about):
            tasks = self._tasks(about["buckets"], about_rows)
            placed = df if placed else df.repartition(tasks, *[F.col(f"`{k}`") for k in self._buckets(about)])
            with nullcontext(name) if name else self._bucketed(about) as known, shuffles_removed(self.spark):
                placed.select(*self.spark.table(known).columns).write.insertInto(known, overwrite=overwrite)
            return
        if by:  # one file set per partition value; AQE splits a value with a large share of the rows
            df = df.hint("rebalance", *[F.col(f"`{c}`") for c in by])
        writer = df.write.mode("overwrite" if overwrite else "append")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        with shuffles_removed(self.spark):
            writer.partitionBy(*by).parquet(f"{self.path}/{about['data']}")

    def _enforce(self, df: DataFrame, about: dict, gate: Gate | None, more: Mapping[str, str] | None = None) -> None:
        rules = {**about["checks"], **(more or {})}
        if rules:
            Contract(f"checks of {self.path}", rows=rules).enforce(df)
        if gate is not None:
            gate(df)

    def _delete(self, folder: str) -> None:
        new_path, fs = self._hadoop()
        fs.delete(new_path(folder), True)

    def _load(
        self, df: DataFrame, about: dict, gate: Gate | None = None, more: Mapping[str, str] | None = None,
        checked: bool = False, about_rows: int | None = None, placed: bool = False,
    ) -> int:
        """The frame becomes the table: written aside, held to its checks unless that is done, then named.

        Its rows, where the caller does not know about how many there are, are stored
        and counted first, if the table has buckets.
        """
        former, gone = about["data"], about["former"]
        about = {**about, "data": f"data-{uuid.uuid4().hex}", "former": former}
        counted = stage(df, "load") if self._buckets(about) and about_rows is None else None
        if counted is not None:
            df = counted.df
            about_rows = df.count()
        about["buckets"] = self._needed(about, about_rows)
        self._write(self._hidden(df, about), about, overwrite=False, placed=placed)
        if counted is not None:
            counted.discard()
        try:
            if not checked:
                self._enforce(self._shown(self._scan(about), about), about, gate, more)
        except ContractViolation:
            self._delete(f"{self.path}/{about['data']}")
            raise
        version = self._declare(about)
        if gone:
            self._delete(f"{self.path}/{gone}")
        return version

    def save(
        self,
        df: DataFrame,
        mode: str = "overwrite",
        partition_by: Sequence[str] | None = None,
        replace_partitions: bool = False,
        schema_mode: str = "overwrite",
        replace_where: str | None = None,
        gate: Gate | None = None,
        about_rows: int | None = None,
        placed: bool = False,
    ) -> int:
        """Write a frame; returns the table's version.

        ``mode``: overwrite, append, error (if the table exists) or ignore.
        ``replace_partitions`` overwrites the partitions found in the frame and
        keeps the others: done twice, it gives the same table. ``replace_where``
        overwrites the rows that meet the condition, which every row of the frame
        must meet too; the whole table is written anew. ``schema_mode``: merge adds
        the frame's new columns to the table's, overwrite takes the frame's columns.
        Rows that break a constraint, or that ``gate`` rejects by raising
        :class:`ContractViolation`, leave the table as it was. ``about_rows``, an
        estimate, spares a table with keys the count of the frame; ``placed``, that the
        frame comes from :meth:`placed` with it, spares a shuffle.
        """
        if mode not in ("overwrite", "append", "error", "ignore"):
            raise ValueError(f"unknown mode '{mode}'")
        current = self._about()
        if current is not None:
            if mode == "error":
                raise FileExistsError(f"table '{self.path}' exists")
            if mode == "ignore":
                return current["version"]
        df = storable(df)
        about = self._next(current)
        keeps_rows = replace_partitions or replace_where is not None or mode == "append"
        if partition_by is not None and not (keeps_rows and about["data"]):
            about["partition_by"] = list(partition_by)
        schema = _nullable(df.schema)
        if current is not None and (schema_mode == "merge" or keeps_rows):
            schema = self._widened(current, schema, schema_mode)
        about["schema"] = schema.jsonValue()
        rows = conform(df, schema)

        if about["data"] is None or not keeps_rows:
            met = {"replace_where": f"coalesce({replace_where}, false)"} if replace_where else None
            return self._load(rows, about, gate, met, about_rows=about_rows, placed=placed)
        if replace_where is not None:
            return self._replace_where(rows, about, replace_where, gate)
        unknown = about_rows is None and bool(self._buckets(about))
        staged = stage(rows, "load") if about["checks"] or gate or unknown else None
        if staged is not None:
            rows, placed = staged.df, False
            self._enforce(rows, about, gate)
        if unknown:
            about_rows = rows.count()
        self._write(self._hidden(rows, about), about, overwrite=mode != "append", about_rows=about_rows or 0, placed=placed)
        if staged is not None:
            staged.discard()
        return self._declare(about)

    def _widened(self, current: dict, schema: StructType, schema_mode: str) -> StructType:
        known = StructType.fromJson(current["schema"])
        extra = set(schema.names) - set(known.names)
        if extra and schema_mode != "merge":
            raise ValueError(f"columns {sorted(extra)} are not in '{self.path}'")
        return merged_schema(known, schema)

    def _replace_where(self, rows: DataFrame, about: dict, condition: str, gate: Gate | None) -> int:
        met = f"coalesce({condition}, false)"
        staged = stage(rows, "load")
        self._enforce(staged.df, about, gate, {"replace_where": met})
        kept = self._shown(self._scan(about), about).where(f"NOT {met}")
        version = self._load(kept.unionByName(staged.df), about, checked=True)
        staged.discard()
        return version

    def append(self, df: DataFrame) -> int:
        return self.save(df, mode="append")

    # -- upsert -----------------------------------------------------------
    def upsert(
        self,
        source: DataFrame | Staged,
        keys: Sequence[str],
        partition_by: Sequence[str] = (),
        schema_mode: str = "merge",
        keys_are_unique: bool = False,
        gate: Gate | None = None,
        about_rows: int | None = None,
    ) -> int:
        """Update rows whose keys match, insert the rest, delete nothing.

        Every matching table row takes all source values, so a row may move to
        another partition and a key held k times stays k times. A NULL key
        matches nothing and is inserted. Two source rows with one key are an
        error, unless the caller has already checked (``keys_are_unique``).
        Doing it again with the same source changes nothing, as long as no source
        row has a NULL key.

        A table that the first upsert makes is partitioned by ``partition_by`` and
        bucketed by ``keys``. Later ones look for the keys (see :meth:`_touched`)
        and write the partitions anew that hold a match or take rows in; the
        others are not read. An unpartitioned table is written anew as a whole.
        ``about_rows``, an estimate, spares the first upsert the count of its rows.
        """
        keys = list(keys)
        current = self._about()
        if current is None:
            current = self._first(partition_by, keys)
            first = storable(source.df if isinstance(source, Staged) else source)
            staged = source if isinstance(source, Staged) else None
            if not keys_are_unique:
                staged = staged or stage(first, "upsert")
                first = staged.df
                self._require_unique(first, keys)
            if staged is not None:
                about_rows = staged.df.count()
            about = {**current, "schema": _nullable(first.schema).jsonValue()}
            version = self._load(first, about, gate, about_rows=about_rows)
        else:
            staged = source if isinstance(source, Staged) else stage(storable(source), "upsert")
            if not keys_are_unique:
                self._require_unique(staged.df, keys)
            version = self._merge(current, staged.df, keys, schema_mode, gate)
        if staged is not None and staged is not source:
            staged.discard()
        return version

    def _require_unique(self, df: DataFrame, keys: list[str]) -> None:
        present = df.na.drop(subset=keys)
        Contract(f"upsert into {self.path}", unique=(tuple(keys),)).enforce(present)

    def _merge(self, current: dict, source: DataFrame, keys: list[str], schema_mode: str, gate: Gate | None) -> int:
        about = self._next(current)
        schema = self._widened(current, _nullable(source.schema), schema_mode)
        about["schema"] = schema.jsonValue()
        self._enforce(source, about, gate)
        src = self._hidden(source, about)
        if about["data"] is None:
            return self._load(conform(source, schema), about, checked=True, about_rows=source.count())
        if not self._buckets(about):
            return self._replaced(self._scan(about), src, keys, about, None)
        with self._bucketed(about) as name:
            return self._replaced(self.spark.table(name), src, keys, about, name)

    def _replaced(self, table: DataFrame, src: DataFrame, keys: list[str], about: dict, name: str | None) -> int:
        schema, by = StructType.fromJson(about["schema"]), about["partition_by"]
        if not by:
            n = table.count() + src.count() if name else None
            return self._load(self._merged(table, src, keys, schema), about, checked=True, about_rows=n)
        left = self._touched(table, src, keys, by)
        entered = self._distinct(src, by) if set(by) <= set(src.columns) else []
        touched = left + [p for p in entered if p not in left]
        old = table.where(_one_of(touched, by)) if touched else table.limit(0)
        merged = self._merged(old, src, keys, schema)
        # Rows may move, so a partition may be left empty; a dynamic overwrite would not see it.
        emptied: list[tuple] = []
        if [p for p in left if p not in entered] and set(by) & set(src.columns):
            kept = self._distinct(self._merged(old.select(*keys, *[c for c in by if c not in keys]), src.select(
                *keys, *[c for c in by if c in src.columns and c not in keys]), keys,
                StructType([f for f in schema if f.name in {*keys, *by}])), by)
            emptied = [p for p in left if p not in kept]
        folders = self._folders(about, emptied)
        n = old.count() + src.count() if name else 0
        self._write(merged, about, overwrite=True, name=name, about_rows=n)
        for folder in folders:
            self._delete(folder)
        return self._declare(about)

    @staticmethod
    def _touched(table: DataFrame, src: DataFrame, keys: list[str], by: list[str]) -> list[tuple]:
        """Partitions that hold a key of the source: their number is what reaches the driver.

        Few keys are pushed to the scan as values, so that buckets, row groups and
        pages are skipped by the hash, the least and greatest value and the Bloom
        filter; many are joined, bucket by bucket.
        """
        if len(keys) == 1:
            few = src.select(keys[0]).where(F.col(f"`{keys[0]}`").isNotNull()).limit(LISTED_KEYS + 1).collect()
            if len(few) <= LISTED_KEYS:
                return LakeTable._distinct(table.where(F.col(f"`{keys[0]}`").isin([r[0] for r in few])), by)
        return LakeTable._distinct(table.join(src.select(*keys), keys, "left_semi"), by)

    @staticmethod
    def _distinct(df: DataFrame, by: list[str]) -> list[tuple]:
        return [tuple(r) for r in df.select(*[F.col(f"`{c}`") for c in by]).distinct().collect()]

    def _folders(self, about: dict, partitions: list[tuple]) -> list[str]:
        if not partitions:
            return []
        rows = self._scan(about).where(_one_of(partitions, about["partition_by"]))
        folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1)
        return [unquote(r[0]) for r in rows.select(folder).distinct().collect()]

    @staticmethod
    def _merged(old: DataFrame, src: DataFrame, keys: list[str], schema: StructType) -> DataFrame:
        """Rows of ``old`` with the values of ``src`` where the keys match, and its further rows."""
        old = conform(old, schema)
        new = src.select(*[F.col(f"`{c}`").alias(f"_new_{c}") for c in src.columns], F.lit(True).alias("_hit"))
        same = reduce(and_, [old[f"`{k}`"] == new[f"`_new_{k}`"] for k in keys])
        columns = []
        for f in schema:
            c = F.col(f"`{f.name}`")
            if f.name in src.columns:
                c = F.when(F.col("_hit"), F.col(f"`_new_{f.name}`")).otherwise(c)
            columns.append(c.alias(f.name))
        updated = old.join(new, same, "left").select(*columns)
        added = conform(src.join(old.select(*keys), keys, "left_anti"), schema)
        return updated.unionByName(added)

    # -- describing -------------------------------------------------------
    def summary(self, name: str) -> DataFrame:
        """One row: name, path, version, rows, columns; a message if absent."""
        schema = StructType(
            [
                StructField("name", StringType()),
                StructField("path", StringType()),
                StructField("version", LongType()),
                StructField("n_rows", LongType()),
                StructField("n_columns", LongType()),
                StructField("message", StringType()),
            ]
        )
        if not self.exists():
            row = (name, self.path, None, None, None, f"no table at '{self.path}'")
        else:
            df = self.read()
            row = (name, self.path, self.version(), df.count(), len(df.columns), None)
        return self.spark.createDataFrame([row], schema)

    def preview(self, order: Sequence[str], n: int = 10) -> DataFrame:
        """The first rows in a stated order, numbered from 1."""
        first = self.read().orderBy(*order).limit(n)
        place = F.row_number().over(Window.orderBy(*order))  # over those n rows
        return first.withColumn("place", place)


def _one_of(values: list[tuple], columns: list[str]) -> Column:
    """Whether a row lies in one of the partitions, in a form that prunes folders."""
    if len(columns) == 1:
        c, given = F.col(f"`{columns[0]}`"), [v[0] for v in values if v[0] is not None]
        found = c.isin(given) if given else F.lit(False)
        return found | c.isNull() if any(v[0] is None for v in values) else found
    return reduce(or_, [reduce(and_, [F.col(f"`{c}`").eqNullSafe(x) for c, x in zip(columns, v, strict=True)]) for v in values])
