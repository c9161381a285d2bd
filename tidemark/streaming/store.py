"""The event table of a streaming job: one tagged write per batch, every event once, closed days packed.

* ``events``: what the batches wrote, partitioned by load day, route and batch. A route is ``rejected``
  or one of the three datasets; the job's tables are read from here, pruned by route.
* ``event_ids``: per event month a Bloom filter over the ids of all stored events, as bitmaps.
* ``events_packed``: the rows of packed batches, one part per load day and route.

An event is stored once, however the records are cut into batches and whatever checkpoint they come
with; a repeat has the id and the event time of the first. Ids that the filter has not seen are new; the rest, if any, are compared with the stored rows of
their event times, which the files' own statistics find. The filter is written before the rows, so it holds every stored id at all times; an
id that is in the filter only (its batch failed) is found missing by the comparison.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sinks.tables import write_table
from tidemark.sinks.versions import VersionedTable
from tidemark.sources.files import list_files
from tidemark.streaming import events as ev

REJECTED = "rejected"
PARTITIONS = ["processing_date", "route", "batch_key"]
# Per event month: ten bits and four hashes for each id give about one false alarm in a hundred. These
# 16 Mi bits (2 MiB) suit some 1,600,000 ids; more ids cost comparisons, not correctness.
BITS = 1 << 24
HASHES = 4
SENT_MONTHS = 16  # filters of so many months, 32 MiB, go to every task
TARGET_BYTES = 256 << 20
PACKED_AT_ONCE = 4  # routes
_WORD = 1 << 15  # bits of one bitmap


def route() -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in ev.EVENT_KINDS.items() for x in pair])
    return F.when(F.col("rejection_reason").isNotNull(), F.lit(REJECTED)).otherwise(
        F.element_at(kinds, F.col("event_type")))


def keyed(tagged: DataFrame, batch_key: str) -> DataFrame:
    """Tagged events with what the table needs to place them and to know them again."""
    sequence = F.concat(F.lit("sequence:"), F.col("sequence_number"))
    return tagged.select(
        *ev.STORED_COLUMNS,
        F.coalesce("event_id", sequence).alias("identity"),
        F.coalesce(F.date_format("event_timestamp", "yyyy-MM"), F.lit("none")).alias("event_month"),
        route().alias("route"), F.lit(batch_key).alias("batch_key"))


def months_of(batch: DataFrame) -> dict[str, tuple[int | None, int | None]]:
    """The months of a batch's events, each with its first and last event time in microseconds."""
    at = F.unix_micros("event_timestamp")
    return {r[0]: (r[1], r[2])
            for r in batch.groupBy("event_month").agg(F.min(at), F.max(at)).collect()}


class EventStore:
    def __init__(self, spark: SparkSession, root: str, bits: int = BITS, hashes: int = HASHES):
        self.spark, self.bits, self.hashes = spark, bits, hashes
        self.live = f"{root.rstrip('/')}/events"
        self.ids = VersionedTable(spark, f"{root.rstrip('/')}/event_ids")
        self.packed = VersionedTable(spark, f"{root.rstrip('/')}/events_packed")
        self.compared: list[DataFrame] = []

    # ---- reading -------------------------------------------------------------------------------
    def rows(self, route: str | None = None, batches: list[str] | None = None) -> DataFrame:
        """Stored events, of one route and of some batches. A version of the packed table says which
        batches are packed; their own files stay until :meth:`drop_packed_files`, so a reader that
        began before finds them."""
        schema, version = ev.stored_schema(), self.packed.latest()
        hidden = version.info["batches"] if version else []
        parts = []
        if self.packed.exists(self.live):
            parts.append(self.spark.read.schema(schema).parquet(self.live).filter(
                ~F.col("batch_key").isin(hidden) if hidden else F.lit(True)))
        if version:
            parts.append(self.packed.read(
                [p for p in version.parts if route is None or f"/{route}-" in p], version))
        out = parts[0] if parts else self.spark.createDataFrame([], schema)
        for p in parts[1:]:
            out = out.unionByName(p)
        if route is not None:
            out = out.filter(F.col("route") == route)
        return out if batches is None else out.filter(F.col("batch_key").isin(batches))

    def batches(self) -> DataFrame:
        """Keys of all batches with rows: of the live ones from the folders' names, without reading a
        file, of the packed ones from the list that came with them."""
        out = self.packed.read_side("batches-", "batch_key string")
        if self.packed.exists(self.live):
            key = F.regexp_extract("path", r"/batch_key=([^/]+)/", 1).alias("batch_key")
            out = out.unionByName(list_files(self.spark, self.live).select(key))
        return out.distinct()

    # ---- every event once ----------------------------------------------------------------------
    def _spots(self, ids: DataFrame) -> DataFrame:
        """Places of each id in the filter of its month."""
        places = F.array(*[F.pmod(F.xxhash64("identity", F.lit(i)), F.lit(self.bits))
                           for i in range(self.hashes)])
        spots = ids.filter("identity is not null").select(
            "event_month", "identity", F.explode(places).alias("spot"))
        return spots.select("event_month", "identity", F.floor(F.col("spot") / _WORD).alias("word"),
                            (F.col("spot") % _WORD).alias("bit"))

    def _filters(self, months: list) -> DataFrame | None:
        version = self.ids.latest()
        parts = [p for p in (version.parts if version else {}) if p.split("=")[1] in months]
        return self.ids.read(parts, version) if parts else None

    def maybe_stored(self, ids: DataFrame, months: list) -> DataFrame | None:
        """Ids that the filters of their months may hold; null if none of these months has a filter.
        The filters of a few months go to every task; else the ids' places are shuffled to them."""
        filters = self._filters(months)
        if filters is None:
            return None
        if len(months) <= SENT_MONTHS:
            filters = F.broadcast(filters)
        byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
        is_set = F.getbit(byte.cast("int"), (F.col("bit") % 8).cast("int")) == 1
        return self._spots(ids).join(filters, ["event_month", "word"]).groupBy("identity").agg(
            F.count_if(is_set).alias("hits")).filter(F.col("hits") == self.hashes).select("identity")

    def fresh(self, batch: DataFrame, batch_key: str, months: dict[str, tuple],
              remember: bool = False) -> DataFrame:
        """The events of a batch that no other batch has stored; ``months`` are those of :func:`months_of`.
        What was compared is kept until :meth:`release`, so that the passes over the result do not
        compare again. With ``remember`` the batch's ids go into the filters beside the comparison, which
        has the filters of before; those of known events are in them already."""
        maybe = self.maybe_stored(batch.select("event_month", "identity"), list(months))
        if not remember:
            return self._unknown(batch, batch_key, months, maybe)
        with ThreadPoolExecutor(1) as pool:
            added = pool.submit(
                inheritable_thread_target(self.spark)(self.remember), batch, list(months))
            new = self._unknown(batch, batch_key, months, maybe)
            added.result()
        return new

    def _unknown(self, batch: DataFrame, batch_key: str, months: dict[str, tuple],
                 maybe: DataFrame | None) -> DataFrame:
        if maybe is None or self._kept(maybe).isEmpty():
            return batch
        times = [t for span in months.values() for t in span if t is not None]
        same_time = F.col("event_timestamp").isNull()
        if times:
            same_time |= F.col("event_timestamp").between(
                F.timestamp_micros(F.lit(min(times))), F.timestamp_micros(F.lit(max(times))))
        known = self._kept(self.rows().filter(same_time & (F.col("batch_key") != batch_key)).select(
            "identity").join(maybe, "identity", "left_semi"))
        if known.isEmpty():
            return batch
        return batch.join(known, "identity", "left_anti").select(*batch.columns)

    def _kept(self, ids: DataFrame) -> DataFrame:
        self.compared.append(ids.persist(StorageLevel.MEMORY_AND_DISK))
        return ids

    def release(self) -> None:
        """Drop what :meth:`fresh` keeps."""
        while self.compared:
            self.compared.pop().unpersist()

    def remember(self, batch: DataFrame, months: list) -> None:
        """Add the ids of a batch to the filters of their months."""
        new = self._spots(batch).groupBy("event_month", "word").agg(
            F.bitmap_construct_agg(F.col("bit")).alias("bits"))
        base, old = self.ids.latest(), self._filters(months)
        if old is not None:
            new = new.unionByName(old).groupBy("event_month", "word").agg(
                F.bitmap_or_agg(F.col("bits")).alias("bits"))
        parts = self.ids.put_split(new, {"month": F.col("event_month")})
        self.ids.commit(base, parts, new.schema)
        self.ids.vacuum(keep_versions=2)

    # ---- writing -------------------------------------------------------------------------------
    def forget_attempt(self, batch_key: str) -> None:
        """Delete what a failed attempt at a batch left, on whatever load day it was made."""
        fs, folder = self.packed.at(self.live)
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"*/*/batch_key={batch_key}")
        for status in fs.globStatus(pattern) or []:
            fs.delete(status.getPath(), True)

    def write(self, batch: DataFrame) -> None:
        """One write for all routes. It replaces only the partitions of its own batch."""
        write_table(batch, self.live, PARTITIONS, replace_partitions_only=True)

    # ---- packing -------------------------------------------------------------------------------
    def pack(self, before, target_bytes: int = TARGET_BYTES) -> int:
        """Pack the batches of load days before ``before`` into files of about ``target_bytes``;
        returns the number of batches packed. Rows stay the same for every reader throughout.

        No shuffle: a scan packs small files into splits of the target size, and each split becomes
        one file. Each day's route is a write of its own, some of them at the same time, as one of few
        rows has one task.
        """
        version = self.packed.latest()
        hidden = version.info["batches"] if version else []
        place = r"/processing_date=([^/]+)/route=([^/]+)/batch_key=([^/]+)/"
        day, way, key = (F.regexp_extract("path", place, i) for i in (1, 2, 3))
        found = list_files(self.spark, self.live).select(
            day.alias("day"), way.alias("route"), key.alias("batch_key")).filter(
            (F.col("day") != "") & (F.col("day") < F.lit(str(before)))
            & ~F.col("batch_key").isin(hidden)).distinct().collect()
        if not found:
            return 0
        packer = self.spark.newSession()  # the settings hold for this scan only
        for name, value in (("maxPartitionBytes", target_bytes), ("openCostInBytes", 0),
                            ("minPartitionNum", 1)):
            packer.conf.set(f"spark.sql.files.{name}", str(value))
        schema, places = ev.stored_schema(), {}
        for x in found:
            places.setdefault((x["day"], x["route"]), []).append(x["batch_key"])

        def put(place: tuple[str, str]) -> tuple[str, str]:
            d, r = place
            small = packer.read.schema(schema).option("basePath", self.live).parquet(
                f"{self.live}/processing_date={d}/route={r}").filter(
                F.col("batch_key").isin(places[place]))
            return f"{d}/{r}-{uuid.uuid4().hex[:12]}", self.packed.put(small, "packed")

        with ThreadPoolExecutor(PACKED_AT_ONCE) as pool:
            parts = dict(pool.map(inheritable_thread_target(self.spark)(put), sorted(places)))
        keys = sorted({x["batch_key"] for x in found})
        side = self.packed.put(self.spark.range(0, 1, 1, 1).select(
            F.explode(F.array(*[F.lit(k) for k in keys])).alias("batch_key")), "batches")
        self.packed.commit(version, parts, schema, {"batches": sorted({*hidden, *keys})},
                           {f"batches-{uuid.uuid4().hex[:12]}": side})
        return len(keys)

    def drop_packed_files(self) -> None:
        """Delete the files of packed batches. Call it when readers that began before are done."""
        version = self.packed.latest()
        for key in (version.info["batches"] if version else []):
            self.forget_attempt(key)
        if version and version.info["batches"]:
            self.packed.commit(version, {}, version.schema, {"batches": []})

    def files(self) -> DataFrame:
        """Files that a reader of all events opens: those of batches that are not packed, and packed
        ones."""
        version = self.packed.latest()
        hidden = version.info["batches"] if version else []
        key = F.regexp_extract("path", r"/batch_key=([^/]+)/", 1)
        listing = list_files(self.spark, self.live).filter(~key.isin(hidden) if hidden else F.lit(True))
        for folder in (version.parts.values() if version else []):
            listing = listing.unionByName(list_files(self.spark, f"{self.packed.path}/{folder}"))
        return listing
