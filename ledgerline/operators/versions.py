"""Tables as versions: immutable folders of Parquet, and one small file that says which make up a version.

    table/data/<random>/...            written once, never changed
    table/_versions/000000000007.json  schema, folders of each bucket, batches applied

A version exists once its file has its number for a name, which one writer alone can
give it (a hard link on a local disk, a rename that refuses to replace elsewhere).
A reader takes the greatest number once and then reads folders that no
writer touches.  A writer that is lost at any step leaves the last version as it was,
and folders that `expire` clears later.  A writer that finds its number taken
starts again from the new version.

Keyed tables lie in hash buckets of the key, so that a batch rewrites only the
buckets that it touches.  A batch's number goes into the version with its rows,
so that a batch that comes again is seen and skipped.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge import latest_by_key, upsert

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has taken the version number."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: str
    #: Folders, under the table, of each bucket; tables without a key have the one bucket "".
    folders: dict[str, list[str]]
    key: list[str] = field(default_factory=list)
    buckets: int = 1
    #: The last batch that each source has put in.
    batches: dict[str, int] = field(default_factory=dict)


class Store:
    """The file system of a table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.jvm = spark, path.rstrip("/"), spark._jvm
        self.make = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.make(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.local = self.fs.getScheme() == "file"

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what is in a folder under the table."""
        at = self.make(f"{self.path}/{folder}")
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.make(f"{self.path}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.make(f"{self.path}/{name}"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def name_once(self, draft: str, name: str) -> None:
        """Gives a draft its name, unless there is a file of that name."""
        old, new = self.make(f"{self.path}/{draft}"), self.make(f"{self.path}/{name}")
        try:
            if self.local:
                plain = lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
                self.jvm.java.nio.file.Files.createLink(plain(new), plain(old))
                self.fs.delete(old, False)
            else:
                kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
                options = self.spark.sparkContext._gateway.new_array(kind, 1)
                options[0] = kind.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), self.spark._jsc.hadoopConfiguration()).rename(old, new, options)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                self.delete(draft)
                raise Conflict(name) from e
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.make(f"{self.path}/{name}"), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name[:-5]) for name, _ in Store(spark, path).names("_versions") if name.endswith(".json") and name[:-5].isdigit())


def current(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The last version, or the one of a number; None where there is no table."""
    found = versions(spark, path)
    if number is None and not found:
        return None
    number = found[-1] if number is None else number
    if number not in found:
        raise ValueError(f"{path} has no version {number}")
    return Version(**json.loads(Store(spark, path).read(f"_versions/{number:012d}.json")))


def read(spark: SparkSession, path: str, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a version, the last by default, or of some of its buckets."""
    version = version or current(spark, path)
    if version is None:
        raise ValueError(f"no table at {path}")
    schema = T.StructType.fromJson(json.loads(version.schema))
    wanted = version.folders if buckets is None else {str(b): version.folders.get(str(b), []) for b in buckets}
    folders = [f"{path.rstrip('/')}/{f}" for some in wanted.values() for f in some]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _written(df: DataFrame, path: str, key: list[str], buckets: int) -> dict[str, list[str]]:
    """Writes rows into a new folder; the folders of each bucket."""
    folder = f"data/{uuid.uuid4().hex}"
    if not key:
        df.write.option("compression", "zstd").parquet(f"{path}/{folder}")
        return {"": [folder]}
    # adaptive execution splits a bucket that is much larger than the others
    dealt = df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
    dealt.write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{path}/{folder}")
    names = [name for name, _ in Store(df.sparkSession, path).names(folder)]
    return {name.split("=")[1]: [f"{folder}/{name}"] for name in names if name.startswith(f"{BUCKET}=")}


def publish(spark: SparkSession, path: str, version: Version) -> Version:
    """Makes a version the last one, if its number is free."""
    store = Store(spark, path)
    draft = f"_versions/.{uuid.uuid4().hex}"
    store.write(draft, json.dumps(asdict(version)))
    store.name_once(draft, f"_versions/{version.number:012d}.json")
    return version


def _applied(base: Version | None, source: str | None, batch: int | None) -> bool:
    return base is not None and source is not None and base.batches.get(source, -1) >= batch


def _noted(base: Version | None, source: str | None, batch: int | None) -> dict[str, int]:
    return (base.batches if base else {}) | ({source: batch} if source is not None else {})


def overwrite(
    df: DataFrame, path: str, key: list[str] | None = None, buckets: int = 1, source: str | None = None, batch: int | None = None, check: Callable[[], None] | None = None
) -> Version:
    """Makes the rows the table's next version; `check` runs when they are written, and may refuse them."""
    spark, key = df.sparkSession, key or []
    base = current(spark, path)
    if _applied(base, source, batch):
        return base
    folders = _written(df, path, key, buckets)
    if check:
        check()
    while True:  # whatever another writer has made meanwhile is replaced
        try:
            return publish(spark, path, Version(base.number + 1 if base else 0, df.schema.json(), folders, key, buckets if key else 1, _noted(base, source, batch)))
        except Conflict:
            base = current(spark, path)
            if _applied(base, source, batch):
                return base


def replace_load(batches: DataFrame, path: str, key: list[str], by: list[str], buckets: int = 1) -> Version:
    """Replaces a table by its batches; duplicates inside and across batches fall to the last by `by`."""
    return overwrite(latest_by_key(batches, key, by), path, key, buckets)


def append(df: DataFrame, path: str, source: str | None = None, batch: int | None = None, tries: int = 20) -> Version:
    """Adds rows to a table without a key; a batch that is in is skipped."""
    spark = df.sparkSession
    base = current(spark, path)
    if _applied(base, source, batch):
        return base
    made = _written(df, path, [], 1)[""]
    for _ in range(tries):
        try:
            return publish(spark, path, Version(base.number + 1 if base else 0, df.schema.json(), {"": (base.folders[""] if base else []) + made}, batches=_noted(base, source, batch)))
        except Conflict:
            base = current(spark, path)
            if _applied(base, source, batch):
                return base
    raise Conflict(f"{path}: {tries} tries")


def _aligned(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, T.StructType]:
    """Rows with the types of a table, so that keys hash alike, and the table's schema with columns that are new."""
    kinds = {f.name: f.dataType for f in schema}
    df = df.select(*[F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in df.columns])
    return df, T.StructType([*schema, *[f for f in df.schema if f.name not in kinds]])


def merge(
    incoming: DataFrame, path: str, key: list[str], by: list[str], source: str | None = None, batch: int | None = None, now: Column | None = None, buckets: int = 64, tries: int = 20
) -> Version:
    """Puts rows over a table, the last by `by` of each key, and rewrites the buckets that they touch.

    Null keys are keys like others.  A new table gets `buckets` buckets; later
    merges keep its number.
    """
    spark = incoming.sparkSession
    for _ in range(tries):
        base = current(spark, path)
        if _applied(base, source, batch):
            return base
        if base is None:
            fresh, whole = latest_by_key(incoming, key, by), buckets
            if now is not None:
                fresh = fresh.withColumns({"data_criacao": now, "data_atualizacao": now})
            made, schema, kept = _written(fresh, path, key, whole), fresh.schema, {}
        else:
            if base.key != key:
                raise ValueError(f"{path} lies by {base.key}, not by {key}")
            whole = base.buckets
            rows, schema = _aligned(incoming, T.StructType.fromJson(json.loads(base.schema)))
            touched = sorted(r[0] for r in rows.select(bucket_of(key, whole)).distinct().collect())  # at most `whole` numbers
            merged = upsert(read(spark, path, base, touched), rows, key, by, now)
            made = _written(merged.select(*schema.names), path, key, whole)
            if stray := set(made) - {str(b) for b in touched}:
                raise RuntimeError(f"rows changed while they were merged: buckets {sorted(stray)}")
            kept = {b: f for b, f in base.folders.items() if int(b) not in touched}
        try:
            return publish(spark, path, Version(base.number + 1 if base else 0, schema.json(), kept | made, key, whole, _noted(base, source, batch)))
        except Conflict:
            continue
    raise Conflict(f"{path}: {tries} tries")


def expire(spark: SparkSession, path: str, keep: int = 2, grace: float = 86_400.0) -> list[str]:
    """Deletes old versions, and folders and drafts that no other version names; the names of what went.

    The last `keep` versions stay, and so do those that were the last within `grace`
    seconds, as their readers may still be at work.  Folders without a version stay for the
    same time, as they may be being written.  So the grace must be longer than any read or
    write takes.
    """
    store, old = Store(spark, path), time.time() * 1000 - grace * 1000
    numbers = versions(spark, path)
    made = dict(store.names("_versions"))
    # a version's readers came before the next one was made
    stale = [n for n, after in zip(numbers, numbers[1:], strict=False) if made[f"{after:012d}.json"] <= old][: max(len(numbers) - keep, 0)]
    named = {f.split("/")[1] for n in numbers if n not in stale for folders in current(spark, path, n).folders.values() for f in folders}
    gone = [f"_versions/{n:012d}.json" for n in stale]
    gone += [f"_versions/{name}" for name, at in made.items() if name.startswith(".") and at <= old]
    gone += [f"data/{name}" for name, at in store.names("data") if name not in named and at <= old]
    for name in gone:
        store.delete(name)
    return gone


def restore(spark: SparkSession, path: str, number: int) -> Version:
    """Makes an earlier version's rows the next version; batches stay noted, so none is applied again."""
    base, old = current(spark, path), current(spark, path, number)
    return publish(spark, path, replace(old, number=base.number + 1, batches=base.batches))
