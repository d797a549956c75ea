"""Spelling variants: words one edit apart, found through a variable-length gram index.

The words of all texts are counted first. Their grams are counted next, and a gram dictionary is pruned by
frequency: every gram of two letters is in it, a gram of three only if the two letters it begins with occur
more than ``often`` times, so that long lists are split and short ones are not. A word is decomposed into the
longest dictionary gram at each of its positions. One edit can only change the grams that cover its place, or
that end right before it and have a longer form in the dictionary; the largest such number over all places is
the word's affected-gram bound. Two words one edit apart therefore share all their grams but that many, at
positions that agree up to the shift that an inserted letter makes.

List merging: the lists are those of pairs of grams with their positions and the word's length. A pair of
words that shares at least two grams shares two among the rarest ones, so a word posts the pairs out of its
``bound + 2`` rarest grams only. Words whose bound leaves fewer than two grams (shorter than six letters) also
post their halves, of which one edit leaves one untouched, so no pair is lost. Candidates meet by an equi-join
on the list's key and are verified by edit distance.

Scale: texts are read once and their words are summed before the shuffle; lists are joined as rows, whose hot
keys adaptive execution splits; the only broadcast is the gram dictionary, which the alphabet bounds (90
letters: 8,100 grams of two and 729,000 of three), whatever the number of words.

Defined results: null and empty texts hold no words; repeated rows count each time; a null id counts as an
empty one in the deletion rule; words of equal count tie to the smaller in code-point order; an empty table
gives no rows; only the id and text columns are read, so extra columns cannot clash. Very long texts are split
into runs inside the scan; a very long run is a word like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from interlog.llm.shared import lower_ascii
from interlog.session import cut_lineage

SHORT, LONG = 2, 3               # letters of a gram
RUN = r"[a-zÀ-ÿ]"


def counted_words(docs: DataFrame, min_length: int = 6, min_count: int = 5, every: int = 199, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """word, n: letter runs, A-Z in lower case, after the deletion rule. A run whose hash with its document's id is
    divisible by ``every`` lost a letter. Shorter runs cannot give a word, so the scan leaves them out."""
    runs = docs.select(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("id"),
                       F.explode(F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(f"({RUN}{{{min_length},}})"), F.lit(1))).alias("run"))
    h = F.crc32(F.concat("id", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(h % every == 0, cut).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def gram_dictionary(words: DataFrame, often: int = 200) -> dict[str, tuple[int, bool]]:
    """gram -> (rank by frequency, rarest first; whether the dictionary holds longer forms of it)."""
    def grams(length: int) -> DataFrame:
        places = F.when(F.length("word") >= length, F.sequence(F.lit(1), F.length("word") - length + 1)).otherwise(F.array().cast("array<int>"))
        return (words.select("word", F.explode(places).alias("at"))
                .groupBy(F.substring(F.col("word"), F.col("at"), F.lit(length)).alias("gram")).agg(F.count("*").alias("n")))

    short = grams(SHORT)
    common = short.where(F.col("n") > often).select(F.col("gram").alias("head"))
    long = grams(LONG).join(common, F.substring("gram", 1, SHORT) == F.col("head"), "left_semi")
    found = sorted((n, gram) for gram, n in short.union(long).collect())     # bounded by the alphabet
    heads = {gram[:SHORT] for _, gram in found if len(gram) == LONG}
    return {gram: (rank, gram in heads) for rank, (_, gram) in enumerate(found)}


def decompose(word: str, grams: dict[str, tuple[int, bool]]) -> list[str]:
    """The longest dictionary gram at each position."""
    return [word[i:i + LONG] if i + LONG <= len(word) and word[i:i + LONG] in grams else word[i:i + SHORT]
            for i in range(len(word) - SHORT + 1)]


def affected(word: str, parts: list[str], grams: dict[str, tuple[int, bool]]) -> int:
    """The most grams that one edit can change: replaced or deleted at a letter, or inserted before one."""
    ends = [i + len(g) for i, g in enumerate(parts)]
    grows = [grams[g][1] if g in grams else False for g in parts]
    most = 0
    for place in range(len(word) + 1):
        replaced = inserted = 0
        for i in range(max(0, place - LONG), min(place + 1, len(parts))):
            if ends[i] == place:
                replaced += grows[i]
                inserted += grows[i]
            elif ends[i] > place:
                replaced += 1
                inserted += i < place
        most = max(most, replaced if place < len(word) else 0, inserted)
    return most


def _posts(batches: Iterator[pa.RecordBatch], grams: dict[str, tuple[int, bool]]) -> Iterator[pa.RecordBatch]:
    """Rows of the lists. Side 0 looks for words of its own length and one letter longer; side 1 is looked for, as a
    word of its own length and as one that a letter made longer before, between or behind the two grams."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            keys, sides, words, counts = [], [], [], []
            for word, n in zip(*(c.to_pylist() for c in batch.slice(start, 2000).columns), strict=True):
                parts, length = decompose(word, grams), len(word)
                left = len(parts) - affected(word, parts, grams)
                order = sorted(range(len(parts)), key=lambda i: (grams[parts[i]][0], i))[:len(parts) - max(left, 2) + 2]
                own, sought = set(), set()
                for i, j in combinations(sorted(order), 2):
                    a, b = grams[parts[i]][0], grams[parts[j]][0]
                    own.add((a, i, b, j, length))
                    sought.update(((a, i, b, j, length), (a, i, b, j, length - 1), (a, i, b, j - 1, length - 1),
                                   (a, i - 1, b, j - 1, length - 1)))
                if left < 2:
                    own.update(_halves(word, length))
                    sought.update(_halves(word, length) + _halves(word, length - 1))
                for side, found in ((0, own), (1, sought)):
                    keys += map(hash, found)
                    sides += [side] * len(found)
                    words += [word] * len(found)
                    counts += [n] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sides, pa.int8()), pa.array(words, pa.string()),
                                              pa.array(counts, pa.int64())], names=["key", "side", "word", "n"])


def _halves(word: str, length: int) -> list[tuple]:
    """Both halves of a word of ``length``, as the word begins and ends."""
    half = length // 2
    number = lambda s: int.from_bytes(s.encode(), "big")  # noqa: E731  text hashes differ between workers
    return [(-1, number(word[:half]), length), (-2, number(word[len(word) - (length - half):]), length)]


def near_words(words: DataFrame, often: int = 200) -> DataFrame:
    """word, n, other, other_n: every pair of words one edit apart, in both directions."""
    grams = gram_dictionary(words, often)
    posts = cut_lineage(words.select("word", "n").mapInArrow(lambda it: _posts(it, grams), "key long, side byte, word string, n long"), "gram_lists")
    a = posts.where("side = 0").select("key", "word", "n")
    b = posts.where("side = 1").select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    size, other = F.length("word"), F.length("other")
    apart = ((size < other) | (F.col("word") < F.col("other"))) & (F.levenshtein("word", "other", 1) == 1)
    pairs = a.join(b, "key").where(apart).select("word", "n", "other", "other_n").distinct()
    pairs = cut_lineage(pairs, "near_words")
    return pairs.union(pairs.select(F.col("other"), F.col("other_n"), "word", "n"))


def follow(forms: DataFrame) -> DataFrame:
    """word, root: from each word with a form along the forms to the last. A form's count is a multiple of its
    word's, so chains are short; each round doubles the stretch that a word has gone."""
    at = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if at.join(on, "root", "left_semi").isEmpty():
            return at
        at = cut_lineage(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, times: int = 5, often: int = 200, **columns) -> DataFrame:
    """word, form, root, n, n_near, form_n. A word's form is its most frequent near word, if that occurs at least
    ``times`` as often; its root is where the forms end."""
    words = cut_lineage(counted_words(docs, min_length, min_count, **columns), "words")
    near = near_words(words, often)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("down"), F.col("other"))).alias("best"), F.max("n").alias("of"))
    best = best.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.down")).alias("other_n"), "of")
    fits = F.col("other_n") >= times * F.col("of")
    best = cut_lineage(best.select("word", "n_near", F.when(fits, F.col("other")).alias("form"), F.when(fits, F.col("other_n")).alias("form_n")), "forms")
    roots = follow(best.where("form IS NOT NULL"))
    return (words.join(best, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
