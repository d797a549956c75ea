"""Stand-in interaction tables built from the driver's ``events`` and ``embeddings`` tables.

The mapping is fixed by FIXTURES.md section 4: one interaction per event, containers are a user's
6-hour buckets, ``signup`` events play lectures, and the content catalog is the set of ``k`` values.
Everything is derived with aggregates and equi-joins, so it scales with the events table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in mapping (FIXTURES.md section 4).
BUCKET_MS = 21_600_000          # container width: 6 hours
CONTAINER_MOD = 997             # raw container id = min(event_id) of the bucket mod 997
LECTURE_EVENT = "signup"        # event type that plays a lecture
CORRECT_ABOVE = 20              # answered correctly when value > 20
NULL_TAGS_K = 50                # question whose tags are missing
LECTURE_TYPE_OF = "concept"
HELD_OUT = 3                    # ids with this remainder modulo 10 have no vector of their own
CONTENT_VECTOR_BASE = 499       # content vector of k is vec_id 499 - k

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("long")


def _epoch_ms(ts: str = "ts") -> Column:
    # time-zone free: events.ts is timestamp_ntz
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts}) div 1000")


def interactions(events: DataFrame) -> DataFrame:
    """Raw interaction rows (the reference's ``train`` before any transform)."""
    ev = events.select(
        F.col("event_id").alias("row_id"), "user_id", "event_type", "value",
        _k().alias("k"), (_epoch_ms() / BUCKET_MS).cast("long").alias("b"))
    # per-user start and per-container stats as aggregates + equi-joins (no user-wide window)
    start = ev.groupBy("user_id").agg(F.min("b").alias("b0"))
    bucket = ev.groupBy("user_id", "b").agg(F.max("value").alias("vmax"), F.min("row_id").alias("rmin"))
    j = ev.join(bucket.join(start, "user_id"), ["user_id", "b"])      # the rows themselves move once
    lecture = F.col("event_type") == LECTURE_EVENT
    first = F.col("b") == F.col("b0")
    return j.select(
        "row_id",
        ((F.col("b") - F.col("b0")) * BUCKET_MS).alias("timestamp"),
        "user_id",
        F.col("k").alias("content_id"),
        F.when(lecture, 1).otherwise(0).cast("long").alias("content_type_id"),
        (F.col("rmin") % CONTAINER_MOD).alias("task_container_id"),
        F.when(lecture, -1).otherwise(F.col("k") % 4).cast("long").alias("user_answer"),
        F.when(lecture, -1).when(F.col("value") > CORRECT_ABOVE, 1).otherwise(0).cast("long")
        .alias("answered_correctly"),
        F.when(first, None).otherwise(F.round(F.col("vmax") * 1000)).cast("double")
        .alias("prior_question_elapsed_time"),
        F.when(first, None).otherwise(F.col("k") % 2 == 0).alias("prior_question_had_explanation"),
        F.col("b").alias("batch_id"),
    )


def _catalog(events: DataFrame) -> DataFrame:
    return events.select(_k().alias("k")).distinct()


def questions(events: DataFrame) -> DataFrame:
    k = F.col("k")
    tag_list = F.slice(F.array(k % 9, k % 11 + 9, k % 13 + 20), 1, (k % 3 + 1).cast("int"))
    tags = F.array_join(F.transform(tag_list, lambda t: t.cast("string")), " ")
    return _catalog(events).select(
        k.alias("question_id"), (k / 3).cast("long").alias("bundle_id"), (k % 4).alias("correct_answer"),
        (k % 7 + 1).alias("part"), F.when(k == NULL_TAGS_K, None).otherwise(tags).alias("tags"))


def lectures(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return _catalog(events).select(
        k.alias("lecture_id"), (k % 9).alias("tag"), (k % 7 + 1).alias("part"),
        F.lit(LECTURE_TYPE_OF).alias("type_of"))


def _vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select("vec_id", F.col("embedding").alias("vector"),
                             F.col("embedding")[0].cast("double").alias("bias"))


def user_vectors(embeddings: DataFrame) -> DataFrame:
    """id -> (vector, bias) of every vector but the held-out ids, which take the unseen path."""
    v = _vectors(embeddings).where(F.col("vec_id") % 10 != HELD_OUT)
    return v.select(F.col("vec_id").alias("id"), "vector", "bias")


def content_vectors(embeddings: DataFrame) -> DataFrame:
    k = F.lit(CONTENT_VECTOR_BASE) - F.col("vec_id")
    v = _vectors(embeddings).where((k >= 0) & (k % 10 != HELD_OUT))
    return v.select((F.lit(CONTENT_VECTOR_BASE) - F.col("vec_id")).alias("id"), "vector", "bias")
