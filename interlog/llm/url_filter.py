"""URL filters: host and path rules first, gradient-boosted trees on lexical features for the rest.

DataFrame operations and Spark's own tree learner only. A rule fits its host and all subdomains when the
path starts with the rule's path; the longest rule wins. URLs that a rule judges are the labelled URLs: the
trees are fitted on those of them whose hash falls under ``max_train`` expected rows, and judge every URL
that no rule fits.

Features: length, path depth, digit ratio, character entropy, parameter count, host labels, hyphens, and for
the host's suffix (last two labels) its number of URLs and mean parameter count over the whole table.

Defined results: a null URL, or one without ``://``, has an empty host and path and is judged by the trees;
repeated rows are judged alike; without labelled URLs of both kinds the only kind present (or allow) is the
method's verdict; an empty table gives no rows. Only the id and URL columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from interlog.llm.shared import lower_ascii
from interlog.session import cut_lineage

#: (verdict, host, path)
Rule = tuple[str, str, str]
FEATURES = ["f_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_labels", "f_hyphens", "f_host_length",
            "f_suffix_urls", "f_suffix_params"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, after, k), F.lit(""))
    return lower_ascii(part(1)), part(2)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of its text and verdict."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character: the characters are sorted, so a run holds one character's number."""
    bits = lambda n: n * F.log2(n)
    runs = F.aggregate(
        F.array_sort(F.split(text, "")), F.struct(F.lit("").alias("c"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s")),
        lambda a, c: F.when(a["c"] == c, F.struct(a["c"].alias("c"), (a["n"] + 1).alias("n"), a["s"].alias("s")))
        .otherwise(F.struct(c.alias("c"), F.lit(1.0).alias("n"),
                            (a["s"] + F.when(a["n"] > 0, bits(a["n"])).otherwise(0.0)).alias("s"))),
        lambda a: a["s"] + F.when(a["n"] > 0, bits(a["n"])).otherwise(0.0))
    n = F.length(text)
    return F.when(n > 0, F.log2(n) - runs / n).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    n = F.length(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return urls.withColumns({
        "suffix": F.substring_index(host, ".", -2),
        "f_length": n.cast("double"), "f_host_length": F.length(host).cast("double"),
        "f_depth": count(path, "/+[^/]"), "f_digits": F.when(n > 0, count(url, "[0-9]") / n).otherwise(0.0),
        "f_entropy": entropy(url), "f_params": count(query, "[^&]+"), "f_labels": count(host, "[^.]+"),
        "f_hyphens": count(url, "-")})


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               max_train: int = 20_000, trees: int = 10, depth: int = 4, seed: int = 17) -> DataFrame:
    """(id, url, host, path, rule, score, verdict) of every row; ``score`` is the trees' chance of a block."""
    slim = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    parts = slim.withColumns({"host": host, "path": path})
    parts = lexical(parts.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules)))
    parts = cut_lineage(parts, "url_parts")
    suffixes = parts.groupBy("suffix").agg(F.log1p(F.count("*")).alias("f_suffix_urls"),
                                           F.avg("f_params").alias("f_suffix_params"))
    parts = parts.join(suffixes, "suffix")
    kinds = {r["v"]: r["n"] for r in parts.where("found is not null").groupBy(F.col("found.verdict").alias("v"))
             .agg(F.count("*").alias("n")).collect()}          # at most two rows: block and allow
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features")
    if len(kinds) < 2:
        only = next(iter(kinds), "allow")
        scored = parts.withColumn("score", F.lit(float(only == "block")))
    else:
        part = max_train / sum(kinds.values())
        train = (parts.where("found is not null").withColumn("label", (F.col("found.verdict") == "block").cast("double"))
                 .where(F.pmod(F.xxhash64("url", id_col), F.lit(1_000_000)) < part * 1_000_000))
        train = cut_lineage(assembled.transform(train.select("label", *FEATURES)).select("label", "features"), "url_train")
        if train.select("label").distinct().count() < 2:
            scored = parts.withColumn("score", F.lit(float(max(kinds, key=kinds.get) == "block")))
        else:
            learner = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxBins=32)
            scored = (learner.fit(train).transform(assembled.transform(parts))
                      .withColumn("score", vector_to_array("probability")[1]))
    return scored.select(id_col, "url", "host", "path", F.col("found.rule").alias("rule"), "score",
                         F.coalesce("found.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"))
