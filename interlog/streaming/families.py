"""As-of features of all families on a stream (row 96): user, content, part, tag and (part, tag).

The state of a user is a value for the totals and a map per family, held in RocksDB. A family's keys lie in pages of
about ``PAGE`` keys: a micro-batch reads and writes the pages of the keys that its rows name, one for most users, and a
user with 100,000 contents still touches small pages only. Each family can have a time to live of its own; its keys are
then held one by one, as each expires alone. Results on question rows equal the batch families (rows 50 and 51).
"""

from __future__ import annotations

import contextlib
import itertools
import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from interlog.functions.expr import clip_count, safe_avg, safe_pct
from interlog.operators.content import assign_ql_id

#: suffix of the columns -> whether lectures count
FAMILIES = {"_content_id": False, "_part": True, "_tags": True, "_part_tags": True}
TOTALS = ("ac_cumsum", "r_cumcnt", "l_cumcnt", "pqet_cumsum")
OUT = ["row_id long", "user_id long", "content_type_id long", *(f"{t} long" for t in TOTALS),
       *(f"{t}{s} long" for s, lectures in FAMILIES.items() for t in TOTALS if lectures or t != "l_cumcnt")]
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time a streaming query is started; a started query keeps its own copy."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_KEY = -(1 << 62)              # rows without a part or content share a key, as nulls do in a grouping


def _key(value) -> int:
    return NO_KEY if pd.isna(value) else int(value)


PAGE = 256                       # keys of a page, on average at most


class _Pages:
    """One user's totals of one family: 2 ** depth pages by the key's hash, doubled as keys are added."""

    def __init__(self, state, depth: int, count: int):
        self.state, self.depth, self.count = state, depth, count
        self.pages: dict[int, dict[tuple[int, int], list]] = {}

    def _page(self, a: int, b: int) -> int:
        mixed = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
        return (mixed ^ mixed >> 29) & ((1 << self.depth) - 1)

    def _load(self, page: int) -> dict:
        if page not in self.pages:
            known = self.state.getValue((page,))
            self.pages[page] = {(a, b): four for a, b, *four in json.loads(known[0])} if known is not None else {}
        return self.pages[page]

    def totals(self, a: int, b: int) -> list:
        page = self._load(self._page(a, b))
        if (a, b) not in page:
            page[a, b] = found = [0, 0, 0, 0]
            self.count += 1
            if self.count > PAGE << self.depth:
                self._double()
            return found
        return page[a, b]

    def _double(self) -> None:
        held = [item for p in range(1 << self.depth) for item in self._load(p).items()]
        self.depth += 1
        self.pages = {p: {} for p in range(1 << self.depth)}
        for (a, b), four in held:
            self.pages[self._page(a, b)][a, b] = four

    def write(self) -> None:
        for page, held in self.pages.items():
            self.state.updateValue((page,), (json.dumps([[a, b, *four] for (a, b), four in held.items()]),))


class _Keys:
    """The same with an entry for each key, which expires alone."""

    def __init__(self, state):
        self.state, self.held, self.depth, self.count = state, {}, 0, 0

    def totals(self, a: int, b: int) -> list:
        if (a, b) not in self.held:
            known = self.state.getValue((a, b))
            self.held[a, b] = list(known) if known is not None else [0, 0, 0, 0]
        return self.held[a, b]

    def write(self) -> None:
        for key, values in self.held.items():
            self.state.updateValue(key, tuple(values))


class AsofFamilies(StatefulProcessor):
    """Rows of one user, container by container (rows that share a timestamp) in time order: each container's rows
    get the totals of all earlier containers, then it is added. The elapsed time of a question container comes with
    the next one, so its row counts per key wait as pending."""

    def __init__(self, ttl_ms: dict[str, int] | None = None):
        self.ttl_ms = ttl_ms or {}

    def init(self, handle: StatefulProcessorHandle) -> None:
        four = "ac long, r long, l long, e long"
        # pending and sizes: lists of (family, key, rows) and (family, depth, keys) as JSON
        self.user = handle.getValueState("user", f"{four}, pending string, sizes string")
        self.maps = {s: handle.getMapState(f"totals{s}", "a long, b long", four, self.ttl_ms[s]) if s in self.ttl_ms
                     else handle.getMapState(f"pages{s}", "page long", "totals string") for s in FAMILIES}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [p for p in rows if len(p)]
        if not frames:
            return
        pdf = pd.concat(frames).sort_values(["timestamp", "row_id"], kind="stable")
        known = self.user.get() if self.user.exists() else None
        user = list(known[:4]) if known is not None else [0, 0, 0, 0]
        pending = {(f, a, b): n for f, a, b, n in json.loads(known[4])} if known is not None else {}
        sizes = {f: (depth, n) for f, depth, n in json.loads(known[5])} if known is not None else {}
        held = {s: _Keys(m) if s in self.ttl_ms else _Pages(m, *sizes.get(s, (0, 0))) for s, m in self.maps.items()}

        out = []
        columns = ("timestamp", "row_id", "user_id", "content_type_id", "content_id", "answered_correctly",
                   "prior_question_elapsed_time", "part", "tags")
        for _, group in itertools.groupby(zip(*(pdf[c].tolist() for c in columns), strict=True), key=lambda r: r[0]):
            cont = list(group)
            asked = [r for r in cont if r[3] == 0]
            prior = [float(r[6]) for r in asked if not pd.isna(r[6])]
            if asked and pending:
                if prior:
                    most = max(prior)
                    elapsed = int(math.copysign(math.floor(abs(most) + 0.5), most))
                    for (family, a, b), n in pending.items():
                        into = user if family == "user" else held[family].totals(a, b)
                        into[3] += n * elapsed
                pending = {}
            added: list[tuple] = []
            for _, row_id, user_id, kind, content_id, answer, _, part, tags in cont:
                question = kind == 0
                part, tags = _key(part), [int(t) for t in tags] if question and tags is not None else []
                keys = {"_content_id": [(_key(content_id), 0)], "_part": [(part, 0)],
                        "_tags": [(t, 0) for t in tags], "_part_tags": [(part, t) for t in tags]}
                row = [int(row_id), int(user_id), int(kind), *user]
                for s, lectures in FAMILIES.items():
                    sums = [sum(x) for x in zip(*(held[s].totals(a, b) for a, b in keys[s]), strict=True)] or [None] * 4
                    row += sums if lectures else [sums[0], sums[1], sums[3]]
                out.append(row)
                added.append((question, max(int(answer), 0) if question else 0, keys))
            for question, correct, keys in added:
                named = [("user", 0, 0), *((s, a, b) for s, ks in keys.items() for a, b in ks)]
                for family, a, b in named:
                    into = user if family == "user" else held[family].totals(a, b)
                    into[0] += correct
                    into[1] += question
                    into[2] += not question
                    if question:
                        pending[family, a, b] = pending.get((family, a, b), 0) + 1
        for m in held.values():
            m.write()
        self.user.update((*user, json.dumps([[*k, n] for k, n in pending.items()]),
                          json.dumps([[s, m.depth, m.count] for s, m in held.items()])))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT]).astype("Int64")

    def close(self) -> None:
        pass


def with_attributes(stream: DataFrame, content: DataFrame) -> DataFrame:
    """Part and tags of each row's content: a join with the static dimension."""
    rows = assign_ql_id(stream, content)
    return rows.join(content.select("ql_id", "part", F.col("tags_array").alias("tags")), "ql_id", "left")


def streaming_asof_families(stream: DataFrame, content: DataFrame, ttl_ms: dict[str, int] | None = None) -> DataFrame:
    """As-of totals, rates and averages of every family for a stream of raw interactions. Start it under
    ``settings(spark, ROCKSDB)``. ``ttl_ms``: family suffix -> milliseconds after which an untouched key is dropped.
    That goes by processing time, so such a query needs a processing-time trigger: an available-now run of it does
    not come to an end."""
    rows = with_attributes(stream, content).select(
        "row_id", "user_id", "timestamp", "content_id", "content_type_id", "answered_correctly",
        "prior_question_elapsed_time", "part", "tags")
    out = rows.groupBy("user_id").transformWithStateInPandas(
        AsofFamilies(ttl_ms), ", ".join(OUT), "Append", "ProcessingTime" if ttl_ms else "None")
    for s in ("", *FAMILIES):
        known = F.col(f"r_cumcnt{s}").isNotNull()
        out = (out.withColumn(f"ac_cumsum_pct{s}", F.when(known, safe_pct(f"ac_cumsum{s}", f"r_cumcnt{s}")))
                  .withColumn(f"pqet_cumavg{s}", F.when(known, safe_avg(f"pqet_cumsum{s}", f"r_cumcnt{s}"))))
    return out.withColumn("r_cumcnt_clip", clip_count("r_cumcnt", 300))
