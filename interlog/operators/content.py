"""Content dimension: questions and lectures in one id space, tag arrays and encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Tag string used for questions without tags, and the tag pad value / width.
MISSING_TAGS = "188"
PAD_TAG = 188
PAD_WIDTH = 6


def content_dimension(questions: DataFrame, lectures: DataFrame, fill_tags: str = MISSING_TAGS) -> DataFrame:
    """Union of questions and lectures keyed by ``ql_id``: questions 0..n-1 by id, lectures follow by id.

    The catalog is small and does not grow with interactions, so the global numbering window is fine.
    """
    tags = F.coalesce(F.col("tags"), F.lit(fill_tags))
    q = questions.select(
        F.lit(0).alias("_t"), F.col("question_id").alias("_id"),
        F.col("question_id").cast("long").alias("question_id"), F.lit(None).cast("long").alias("lecture_id"),
        F.col("bundle_id").cast("long").alias("bundle_id"), F.col("correct_answer").cast("long").alias("correct_answer"),
        F.col("part").cast("long").alias("part"), tags.alias("tags"),
        F.transform(F.split(tags, " "), lambda t: t.cast("long")).alias("tags_array"))
    lec = lectures.select(
        F.lit(1).alias("_t"), F.col("lecture_id").alias("_id"),
        F.lit(None).cast("long").alias("question_id"), F.col("lecture_id").cast("long").alias("lecture_id"),
        F.lit(None).cast("long").alias("bundle_id"), F.lit(None).cast("long").alias("correct_answer"),
        F.col("part").cast("long").alias("part"), F.col("tag").cast("string").alias("tags"),
        F.array(F.col("tag").cast("long")).alias("tags_array"))
    both = q.unionByName(lec)
    ql = (F.row_number().over(Window.orderBy("_t", "_id")) - 1).cast("long")
    return tags_code(both.select(ql.alias("ql_id"), *[c for c in both.columns if not c.startswith("_")]))


def tags_code(content: DataFrame) -> DataFrame:
    """Dense 0-based code of each distinct question tag string (lectures: null)."""
    codes = (content.where(F.col("question_id").isNotNull()).select("tags").distinct()
             .select("tags", (F.dense_rank().over(Window.orderBy("tags")) - 1).cast("long").alias("_code")))
    out = content.join(codes, "tags", "left").withColumn(
        "tags_code", F.when(F.col("question_id").isNotNull(), F.col("_code"))).drop("_code")
    return out.select("ql_id", "question_id", "lecture_id", "bundle_id", "correct_answer", "part",
                      "tags", "tags_array", "tags_code")


def assign_ql_id(train: DataFrame, content: DataFrame) -> DataFrame:
    """Surrogate content id looked up by (content id, type) with one equi-join."""
    keys = content.select(
        F.coalesce("question_id", "lecture_id").alias("content_id"),
        F.when(F.col("question_id").isNotNull(), 0).otherwise(1).cast("long").alias("content_type_id"),
        "ql_id")
    base = train.drop("ql_id") if "ql_id" in train.columns else train
    return base.join(keys, ["content_id", "content_type_id"], "left")


MAX_HOT = 2000                  # columns of a multi-hot table


def hot_values(content: DataFrame) -> tuple[list[int], list[int]]:
    """The tags and parts that the catalogue holds, sorted: a small dimension of its own, whose size is checked."""
    tags = content.select(F.explode("tags_array").alias("v")).distinct()
    parts = content.select(F.col("part").alias("v")).where("v is not null").distinct()
    found = [[r.v for r in df.orderBy("v").limit(MAX_HOT + 1).collect()] for df in (tags, parts)]
    if sum(map(len, found)) > MAX_HOT:
        raise ValueError(f"more than {MAX_HOT} tags and parts; use content_tag_pairs")
    return found[0], found[1]


def one_hots(content: DataFrame, tags: list[int] | None = None, parts: list[int] | None = None) -> DataFrame:
    """Multi-hot ``tag_NNN`` and one-hot ``part_N`` columns per content row, by default one for each tag and part
    of the catalogue."""
    if tags is None or parts is None:
        found = hot_values(content)
        tags, parts = found[0] if tags is None else tags, found[1] if parts is None else parts
    cols = [F.array_contains("tags_array", t).cast("int").alias(f"tag_{t:03d}") for t in tags]
    cols += [(F.col("part") == p).cast("int").alias(f"part_{p}") for p in parts]
    return content.select("ql_id", *cols)


def long_hots(hots: DataFrame) -> DataFrame:
    """(ql_id, name, hot): a row for each column of ``one_hots``."""
    return hots.unpivot("ql_id", [c for c in hots.columns if c != "ql_id"], "name", "hot")


def content_tag_pairs(content: DataFrame) -> DataFrame:
    """(question_id, tag) bridge table, plus the question's part and first tag."""
    return content.where(F.col("question_id").isNotNull()).select(
        "question_id", "part", F.element_at("tags_array", 1).alias("tag_0"), F.explode("tags_array").alias("tag"))


def padded_tags(content: DataFrame, width: int = PAD_WIDTH, pad: int = PAD_TAG) -> DataFrame:
    """Fixed-width ``tag_0..tag_{width-1}`` columns, right-padded with ``pad``."""
    arr = F.slice(F.concat("tags_array", F.array_repeat(F.lit(pad).cast("long"), width)), 1, width)
    return content.where(F.col("question_id").isNotNull()).select(
        "question_id", *[arr[i].alias(f"tag_{i}") for i in range(width)])


def distinct_tags(content: DataFrame) -> DataFrame:
    return content.where(F.col("question_id").isNotNull()).select("tags").distinct()
