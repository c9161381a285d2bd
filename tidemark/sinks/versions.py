"""Tables that change by parts: copy on write, and one small file that switches to a new version.

A table is a set of named parts, each a folder of Parquet files. A write puts the parts it changes into
new folders and then creates ``_versions/<number>``, which names the folder of every part. Creating
that file is the switch: readers see the version before it or the one after it, a write that fails
leaves folders that no version names, and parts that a write does not touch keep their files. A writer
that finds its number taken by another fails instead of overwriting it.

The driver handles names of parts only; their number is a parameter of the table (buckets, days), not
of its rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.clean import latest_per_key

BUCKET = "_bucket"
_NEWEST = object()


class WriteConflict(RuntimeError):
    """Another writer made the version that this one was about to make."""


@dataclass(frozen=True)
class Version:
    number: int
    parts: dict[str, str]  # name of a part: its folder below the table
    schema: T.StructType
    info: dict = field(default_factory=dict)
    side: dict[str, str] = field(default_factory=dict)  # parts of another schema that switch along


class VersionedTable:
    """A table of named parts. Old versions stay readable until :meth:`vacuum`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- files ---------------------------------------------------------------------------------
    def at(self, folder: str):
        """File system and path of a folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self, folder: str) -> bool:
        fs, path = self.at(folder)
        return bool(fs.exists(path))

    def _hadoop(self, name: str):
        return self.at(f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        fs, path = self._hadoop(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in self._names("_versions") if n.isdigit())

    def _load(self, number: int) -> Version:
        fs, path = self._hadoop(f"_versions/{number:012d}")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        entry = json.loads(text)
        schema = T.StructType.fromJson(entry["schema"])
        return Version(number, entry["parts"], schema, entry["info"], entry["side"])

    def _create(self, name: str, text: str) -> None:
        """Create a file with all of its content at once, or fail if there is one of that name: a file
        written elsewhere gets the name by a rename that does not replace (a link on a local disk).
        Stores without such a rename allow one writer at a time."""
        jvm = self.spark._jvm
        fs, target = self._hadoop(name)
        _, draft = self._hadoop(f"data/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs.mkdirs(target.getParent())
        try:
            if fs.getScheme() == "file":
                local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
                jvm.java.nio.file.Files.createLink(*local)
            else:
                kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                none = self.spark.sparkContext._gateway.new_array(kind, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, target, none)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception):
                raise WriteConflict(f"{self.path} has changed since it was read") from e
            raise
        finally:
            fs.delete(draft, False)

    # ---- reading -------------------------------------------------------------------------------
    def latest(self) -> Version | None:
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else None

    def read(self, parts: list[str] | None = None, version: Version | int | None = None) -> DataFrame:
        """The rows of a version (the newest, if none is named), or of some of its parts."""
        if isinstance(version, int):
            version = self._load(version)
        version = version or self.latest()
        if version is None:
            raise FileNotFoundError(f"no version of {self.path}")
        names = version.parts if parts is None else [p for p in parts if p in version.parts]
        folders = [f"{self.path}/{version.parts[p]}" for p in names]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    def read_side(self, prefix: str, schema: str, version: Version | None = None) -> DataFrame:
        """The rows of the side parts whose names begin with ``prefix``."""
        version = version or self.latest()
        folders = [f"{self.path}/{f}" for n, f in (version.side if version else {}).items()
                   if n.startswith(prefix)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # ---- writing -------------------------------------------------------------------------------
    def commit(self, base: Version | None, parts: dict[str, str | None], schema: T.StructType,
               info: dict | None = None, side: dict[str, str | None] | None = None) -> Version:
        """The version after ``base``: its parts with ``parts`` put in their place (null drops one),
        and likewise its side parts."""
        merged = (base.parts if base else {}) | parts
        merged = {k: v for k, v in merged.items() if v is not None}
        beside = (base.side if base else {}) | (side or {})
        beside = {k: v for k, v in beside.items() if v is not None}
        number = (base.number if base else 0) + 1
        entry = {"parts": merged, "schema": schema.jsonValue(), "info": info or {},
                 "side": beside}
        self._create(f"_versions/{number:012d}", json.dumps(entry))
        return Version(number, merged, schema, info or {}, beside)

    def put(self, df: DataFrame, name: str) -> str:
        """Write a frame into a new part folder that no version names yet; returns its name."""
        folder = f"data/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.path}/{folder}")
        return folder

    def put_split(self, df: DataFrame, split: dict[str, Column]) -> dict[str, str]:
        """Write a frame with one part folder per combination of the ``split`` values; returns the
        folders by ``<name>=<value>/...``. The values are not added to the rows."""
        folder = f"data/{uuid.uuid4().hex[:12]}"
        df.withColumns(split).hint("rebalance", *split).write.partitionBy(*split).parquet(
            f"{self.path}/{folder}")
        paths = [""]
        for _ in split:
            paths = [f"{p}/{n}" for p in paths for n in self._names(folder + p) if "=" in n]
        return {p[1:]: folder + p for p in paths}

    def vacuum(self, keep_versions: int = 2) -> int:
        """Delete versions before the newest ``keep_versions`` and part folders that none of these
        names; returns how many folders went. Call it when no other writer is at work: the folders of
        a write that has not switched yet are not named by a version."""
        kept = self._numbers()[-keep_versions:]
        named = {f for v in map(self._load, kept) for f in (*v.parts.values(), *v.side.values())}

        def sweep(folder: str) -> int:
            if folder in named:
                return 0
            if not any(f.startswith(f"{folder}/") for f in named):
                fs, path = self._hadoop(folder)
                return int(fs.delete(path, True))
            return sum(sweep(f"{folder}/{n}") for n in self._names(folder) if not n.startswith("."))

        gone = sum(sweep(f"data/{name}") for name in self._names("data")) if kept else 0
        for number in self._numbers():
            if kept and number < kept[0]:
                fs, path = self._hadoop(f"_versions/{number:012d}")
                fs.delete(path, False)
        return gone


class KeyedTable(VersionedTable):
    """A versioned table cut into ``buckets`` parts by a hash of its key.

    A change rewrites only the buckets of the keys it brings. Rows without a key match nothing: they
    form parts of their own that are only ever added to. ``split`` cuts the buckets further by named
    expressions, so that a reader can ask for the parts with one value: give the same ones each time.
    A table keeps its number of buckets until it is replaced.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | list[str], buckets: int = 64,
                 split: dict[str, Column] | None = None):
        super().__init__(spark, path)
        self.keys = [key] if isinstance(key, str) else list(key)
        self.buckets, self.split = buckets, split or {}

    def _no_key(self) -> Column:
        return F.greatest(*[F.col(k).isNull() for k in self.keys], F.lit(False))

    def _bucket(self) -> Column:
        hashed = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return F.when(self._no_key(), F.lit(-1)).otherwise(hashed)

    def touched(self, df: DataFrame, version: Version) -> list[str]:
        """The parts of a version that may hold keys of a frame; at most ``buckets`` numbers reach the
        driver."""
        found = {r[0] for r in df.select(self._bucket().alias(BUCKET)).distinct().collect()} - {-1}
        return [p for p in version.parts if p.startswith(BUCKET)
                and int(p.split("/")[0].split("=")[1]) in found]

    def with_value(self, name: str, value: str, version: Version | None = None) -> DataFrame:
        """The rows of the parts that have one value of the split."""
        version = version or self.latest()
        return self.read([p for p in version.parts if f"/{name}={value}" in p], version)

    def _written(self, df: DataFrame, schema: T.StructType) -> dict[str, str]:
        parts = self.put_split(df.select(*schema.names), {BUCKET: self._bucket()} | self.split)
        mark = uuid.uuid4().hex[:12]
        return {p.replace(f"{BUCKET}=-1", f"unkeyed={mark}"): f for p, f in parts.items()}

    def replace(self, df: DataFrame, **extra) -> Version:
        """All rows anew. ``df`` may read this table: it is written before the switch."""
        base = self.latest()
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        parts = self._written(df, schema)
        gone = {p: None for p in (base.parts if base else {}) if p not in parts}
        extra["info"] = {**extra.get("info", {}), "buckets": self.buckets}
        return self.commit(base, gone | parts, schema, **extra)

    def change(self, landing: DataFrame, merge, base: Version | None = _NEWEST, **extra) -> Version:
        """``merge(stored, landing)`` gives the new rows of the touched parts from their stored rows
        and the landing rows with a key; landing rows without a key are added. ``base`` is
        the version that the change builds on; ``extra`` goes to :meth:`commit`.

        ``landing`` is used three times: give a stored frame, not a chain of work.
        """
        base = self.latest() if base is _NEWEST else base
        if base and base.info.get("buckets") != self.buckets:
            raise ValueError(f"{self.path} has {base.info.get('buckets')} buckets, not {self.buckets}")
        if base is None:
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in landing.schema])
            stored, touched = self.spark.createDataFrame([], schema), []
        else:
            schema, touched = base.schema, self.touched(landing, base)
            stored = self.read(touched, base)
        keyed = landing.select(*schema.names).filter(~self._no_key())
        loose = landing.select(*schema.names).filter(self._no_key())
        parts = self._written(merge(stored, keyed).select(*schema.names).unionByName(loose), schema)
        gone = {p: None for p in touched if p not in parts}
        extra["info"] = {**extra.get("info", {}), "buckets": self.buckets}
        return self.commit(base, gone | parts, schema, **extra)

    def _landing(self, df: DataFrame) -> DataFrame:
        """A frame stored beside the table, so that its work is done once."""
        folder = self.put(df, "landing")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}")

    def upsert(self, landing: DataFrame, newest: list[str], insert_null_keys: bool = True,
               **extra) -> Version:
        """The newest landing row of each key takes the place of the stored one; new keys are added.
        A null key never matches, so such rows are inserts."""
        source = self._landing(latest_per_key(
            landing, self.keys, newest, keep_null_keys=insert_null_keys))

        def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
            return stored.join(new.select(*self.keys), self.keys, "left_anti").select(
                *stored.columns).unionByName(new.select(*stored.columns))

        return self.change(source, merge, **extra)

    def keep_newest(self, landing: DataFrame, newest: list[str], **extra) -> Version:
        """The newest row of each key among the stored and the landing ones stays: both are reduced
        together, by one shuffle; the landing rows are stored as they come."""
        source = self._landing(landing)
        return self.change(source, lambda stored, new: latest_per_key(
            stored.unionByName(new.select(*stored.columns)), self.keys, newest), **extra)
