"""State tables that a micro-batch changes in place (rows 94, 95, 97).

A state is dealt by its key into a fixed number of buckets. An epoch writes new files for the buckets that its
rows touch and then a pointer that names the version of every bucket; the others keep their files. A replayed
epoch starts from the pointer before it, so it writes the same again. ``vacuum`` removes versions that no kept
pointer names.

The pointer has a row per bucket, whatever the state holds; only that and bucket numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from interlog.operators.containers import is_q
from interlog.operators.joins import state_lookup
from interlog.streaming import serving
from interlog.streaming.families import with_attributes


class BucketedState:
    """One state table under ``path``, with ``schema`` (DDL) and ``keys``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = 32):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, list(keys), buckets
        self.columns = [c.split()[0] for c in schema.split(", ")]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _entries(self, *parts: str) -> list[str]:
        at = self._path(*parts)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def epochs(self) -> list[int]:
        """Epochs with a finished pointer, in order."""
        found = [e for e in self._entries("pointer") if e.startswith("epoch=") and "_SUCCESS" in self._entries("pointer", e)]
        return sorted(int(e.removeprefix("epoch=")) for e in found)

    def pointer(self, before: int | None = None) -> dict[int, int]:
        """bucket -> epoch that wrote it, as of the last epoch (before ``before``)."""
        known = [e for e in self.epochs() if before is None or e < before]
        if not known:
            return {}
        rows = self.spark.read.schema("bucket int, version long").parquet(f"{self.path}/pointer/epoch={known[-1]}")
        return {r.bucket: r.version for r in rows.collect()}

    def _buckets_of(self, df: DataFrame) -> list[int]:
        return [r[0] for r in df.select(self.bucket().alias("b")).distinct().collect()]

    def _write(self, epoch: int, df: DataFrame, touched: list[int], old: dict[int, int]) -> None:
        if touched:
            (df.select(*self.columns).withColumn("bucket", self.bucket()).repartition(min(len(touched), self.buckets), "bucket")
               .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/epoch={epoch}"))
        rows = sorted((old | dict.fromkeys(touched, epoch)).items())
        (self.spark.createDataFrame(rows, "bucket int, version long").coalesce(1)
             .write.mode("overwrite").parquet(f"{self.path}/pointer/epoch={epoch}"))

    def create(self, df: DataFrame, epoch: int = -1) -> None:
        self._write(epoch, df, self._buckets_of(df), {})

    def read(self, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """The current rows, of all buckets or of the given ones."""
        versions = self.pointer(before)
        paths = [f"{self.path}/data/epoch={v}/bucket={b}" for b, v in sorted(versions.items()) if buckets is None or b in set(buckets)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read_for(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """The current rows of the buckets that ``rows`` name by their keys."""
        return self.read(self._buckets_of(rows), before)

    def merge(self, epoch: int, rows: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the touched buckets by ``merged(their rows before the epoch)``. ``rows`` name the keys."""
        touched = self._buckets_of(rows)
        self._write(epoch, merged(self.read(touched, epoch)), touched, self.pointer(epoch))

    def vacuum(self, keep: int = 2) -> int:
        """Remove what only pointers older than the last ``keep`` name. Returns the number of folders removed."""
        known = self.epochs()
        old, kept = known[:-keep], known[-keep:]
        named = {(v, b) for e in kept for b, v in self.pointer(e + 1).items()}
        fs = self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = 0
        for epoch in [e for e in self._entries("data") if e.startswith("epoch=")]:
            version = int(epoch.removeprefix("epoch="))
            if version > known[-1]:
                continue                                 # being written
            buckets = [b for b in self._entries("data", epoch) if b.startswith("bucket=")]
            for b in buckets:
                if (version, int(b.removeprefix("bucket="))) not in named:
                    fs.delete(self._path("data", epoch, b), True)
                    gone += 1
        for e in old:
            fs.delete(self._path("pointer", f"epoch={e}"), True)
        return gone


def totals_schema(keys: Sequence[str], suffix: str) -> str:
    return ", ".join([f"{k} long" for k in keys] + [f"{c}{suffix} long" for c in ("ac_cumsum", "aic_cumsum", "r_cumcnt", "l_cumcnt")])


#: name -> (keys, suffix of the totals)
KEYED = {"users_content": (("user_id", "content_id"), "_content_id"), "users_part": (("user_id", "part"), "_part"),
         "users_tag": (("user_id", "tag"), "_tag"), "questions": (("content_id",), "_question")}


class ServingTables:
    """The five state tables of a scoring loop: users and the totals by (user, content), (user, part), (user, tag) and
    question. ``rows`` of a micro-batch: row_id, user_id, timestamp, content_id, content_type_id, answered_correctly."""

    def __init__(self, spark: SparkSession, path: str, content: DataFrame, buckets: int = 32, hours: float = serving.SESSION_HOURS):
        self.content, self.hours = content, hours
        self.users = BucketedState(spark, f"{path}/users", ", ".join(f"{c} long" for c in serving.USER_STATE), ["user_id"], buckets)
        # all of a user's rows share a bucket
        self.keyed = {name: BucketedState(spark, f"{path}/{name}", totals_schema(keys, suffix), keys[:1], buckets)
                      for name, (keys, suffix) in KEYED.items()}

    def _deltas(self, rows: DataFrame) -> dict[str, DataFrame]:
        full = with_attributes(rows, self.content)
        asked = full.where(is_q())
        return {"users_content": asked, "users_part": full, "questions": asked,
                "users_tag": full.withColumn("tag", F.explode("tags"))}

    def merge(self, epoch: int, rows: DataFrame, only: Sequence[str] | None = None) -> None:
        """Add one micro-batch (its containers in time order, questions before lectures) to the tables."""
        if only is None or "users" in only:
            self.users.merge(epoch, rows, lambda old: serving.upsert_user_state(old, rows, self.hours))
        for name, delta in self._deltas(rows).items():
            if only is None or name in only:
                keys, suffix = KEYED[name]
                self.keyed[name].merge(epoch, delta, lambda old, d=delta, k=keys, s=suffix: serving.upsert_keyed_totals(old, d, list(k), s))

    def lookup(self, questions: DataFrame, catalogue: DataFrame) -> DataFrame:
        """Features of question rows from the current tables: only the buckets of the rows' users are read, and of
        these only the rows' own keys are moved (``state_lookup``)."""
        t = {name: self.keyed[name].read_for(questions) for name in ("users_content", "users_tag", "users_part")}
        return state_lookup(questions, self.users.read_for(questions), t["users_content"], t["users_tag"], t["users_part"],
                            catalogue, self.hours)

    def vacuum(self, keep: int = 2) -> None:
        for state in (self.users, *self.keyed.values()):
            state.vacuum(keep)
