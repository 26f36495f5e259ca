"""A keyed table in buckets of bounded size, where a change reads and writes the buckets that it touches alone.

A version of the table is one small file, the manifest: which folder holds each bucket. It is put in place by one
rename, so readers see a change whole or not at all, and what the caller saves with it (its state) holds for the same
version. Buckets follow linear hashing: their number grows with the rows, one bucket splits at a time, and the bucket
of a key is arithmetic on its hash.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rankwell.operators.upsert import upsert
from rankwell.sources.schemas import TableSpec

#: Rows of a bucket, on average, beyond which buckets split; manifests that are kept.
BUCKET_ROWS, KEPT = 1_000_000, 2


@dataclass(frozen=True)
class Manifest:
    """A version: the batch that made it, folder and rows of each bucket (buckets without rows are absent), and what
    was saved with it."""

    batch: int = -1
    buckets: int = 1
    held: dict[int, tuple[str, int]] = field(default_factory=dict)
    saved: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.held.values())


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key among so many: its hash modulo the power of two above them, or below where that is too large."""
    h, low = F.xxhash64(*keys).bitwiseAND(F.lit((1 << 62) - 1)), 1 << (buckets.bit_length() - 1)
    high = F.pmod(h, F.lit(2 * low))
    return F.when(high < buckets, high).otherwise(F.pmod(h, F.lit(low))).cast("int")


def split_by(old: int, new: int) -> set[int]:
    """The buckets whose rows are dealt anew when their number grows."""
    return {b for made in range(old, new) if (b := made - (1 << (made.bit_length() - 1))) < old} if new > old else set()


class BucketedTable:
    """The table of a specification below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, spec: TableSpec, location: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.spec, self.location, self.bucket_rows = spark, spec, location.rstrip("/"), bucket_rows

    # the file system of the folder, whatever it is
    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _manifests(self) -> list[int]:
        folder = self._path("manifest")
        names = [s.getPath().getName() for s in self._files().listStatus(folder)] if self._files().exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _read(self, batch: int) -> Manifest:
        stream = self._files().open(self._path(f"manifest/{batch}.json"))
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        found = json.loads(text)
        return Manifest(found["batch"], found["buckets"], {int(b): (folder, n) for b, (folder, n) in found["held"].items()}, found["saved"])

    def _commit(self, manifest: Manifest) -> None:
        jvm = self.spark.sparkContext._jvm
        draft, final = self._path(f"manifest/{manifest.batch}-{uuid.uuid4().hex}.draft"), self._path(f"manifest/{manifest.batch}.json")
        stream = self._files().create(draft)
        stream.write(bytearray(json.dumps({"batch": manifest.batch, "buckets": manifest.buckets, "held": manifest.held, "saved": manifest.saved}).encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(draft, final, options)

    def manifest(self, before: int | None = None) -> Manifest:
        """The newest version (made by an earlier batch than `before`, if given), empty at the start."""
        found = [n for n in self._manifests() if before is None or n < before]
        return self._read(found[-1]) if found else Manifest()

    def rows(self, manifest: Manifest | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a version (the newest), or of some of its buckets."""
        manifest = self.manifest() if manifest is None else manifest
        paths = [f"{self.location}/{folder}/__bucket={b}" for b, (folder, _) in manifest.held.items() if buckets is None or b in buckets]
        return self.spark.read.schema(self.spec.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.spec.schema)

    def merge(self, batch: DataFrame, number: int, order: str, saved: dict) -> dict[str, int]:
        """Upsert a batch as version `number`, and save a value with it: received, written, inserted and updated keys.

        A batch that is run again starts from the version before it, and takes the place of what it wrote. The buckets
        that the batch's keys fall in, and those that split, are read, merged and written; all others stay as they are.
        """
        before = self.manifest(number)
        # written once: what is computed from the batch below must see the same rows each time
        staged = f"staged/{number}-{uuid.uuid4().hex}"
        batch.write.parquet(f"{self.location}/{staged}")
        batch = self.spark.read.schema(batch.schema).parquet(f"{self.location}/{staged}")
        try:
            return self._merge(batch, number, order, saved, before)
        finally:
            self._files().delete(self._path(staged), True)

    def _merge(self, batch: DataFrame, number: int, order: str, saved: dict, before: Manifest) -> dict[str, int]:
        received = batch.count()
        buckets = max(before.buckets, -(-(before.rows + received) // self.bucket_rows))
        at = bucket_of(self.spec.keys, before.buckets)
        touched = {r[0] for r in batch.select(at.alias("b")).distinct().collect()} | split_by(before.buckets, buckets)
        if not received:
            self._commit(Manifest(number, before.buckets, before.held, saved))
            return {"received": 0, "written": 0, "inserted": 0, "updated": 0}
        merged = upsert(self.rows(before, touched), batch, self.spec, order).merged
        seen, change = Observation(), F.col("__change")
        merged = merged.observe(seen, F.count_if(change == "insert").alias("inserted"), F.count_if(change.isin("update", "known")).alias("updated"))
        folder = f"data/{number}-{uuid.uuid4().hex}"
        placed = merged.drop("__change").withColumn("__bucket", bucket_of(self.spec.keys, buckets))
        placed.repartition("__bucket").write.partitionBy("__bucket").parquet(f"{self.location}/{folder}")
        counts = self.spark.read.parquet(f"{self.location}/{folder}").groupBy("__bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        held = {b: kept for b, kept in before.held.items() if b not in touched} | {r["__bucket"]: (folder, r["n"]) for r in counts}
        self._commit(Manifest(number, buckets, held, saved))
        self._retire(number)
        told = seen.get
        return {"received": received, "written": told["inserted"] + told["updated"], "inserted": told["inserted"], "updated": told["updated"]}

    def _retire(self, number: int) -> None:
        """Only what the last versions hold stays: the newest ones, from which a batch that is run again starts."""
        numbers = [n for n in self._manifests() if n <= number]
        kept = numbers[-KEPT:]
        used: dict[str, set[int]] = {}
        for n in kept:
            for bucket, (folder, _) in self._read(n).held.items():
                used.setdefault(folder.removeprefix("data/"), set()).add(bucket)
        files = self._files()
        for n in numbers[:-KEPT]:
            files.delete(self._path(f"manifest/{n}.json"), False)
        for status in files.listStatus(self._path("data")) if files.exists(self._path("data")) else ():
            name = status.getPath().getName()
            if name not in used:
                files.delete(status.getPath(), True)
                continue
            for part in files.listStatus(status.getPath()):
                bucket = part.getPath().getName()
                if bucket.startswith("__bucket=") and int(bucket.removeprefix("__bucket=")) not in used[name]:
                    files.delete(part.getPath(), True)
