r"""Benchmark decontamination by winnowing, as column expressions alone.

A text's fingerprints are the least hashes of its word ``K``-grams in every window of ``w`` neighbouring ``K``-grams.  With
``w = L - K + 1`` each span of ``L`` equal words puts an equal fingerprint into both texts, so a join of fingerprints finds
every text that shares such a span with a benchmark item; L is the shortest window of the benchmark, at most ``WINDOW``.
Texts found are then extended: their windows are compared with the benchmark's windows, and the words covered are counted.

Equal texts are looked at once (by digest).  All arrays belong to one text; a frequent window or passage is one row on
the benchmark's side, and the texts that hold it stay spread over the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.session import written

from .tables import ascii_lower, let

WINDOW = 13
K = 5
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; NULL has none."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), NOT_A_WORD, -1), "")


def _places(n: Column, span: int | Column) -> Column:
    """First places (from 1) of all spans in ``n`` words; none if there are fewer."""
    return F.when(n >= span, F.sequence(F.lit(1), (n - span + 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def fingerprints(word: Column, k: int, w: int) -> Column:
    """Winnowed k-gram hashes of a column with an array of words."""
    grams = F.transform(_places(F.size(word), k), lambda i: F.xxhash64(*(F.element_at(word, i + j) for j in range(k))))
    if w == 1:
        return F.array_distinct(grams)
    least = let(grams, lambda g: F.transform(_places(F.size(g), w), lambda i: F.array_min(F.slice(g, i, F.lit(w)))))
    return F.array_distinct(least)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``hash, span, words, items``: every distinct window with the items that hold it; shorter items are one window."""
    rows = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    span = F.least(F.size("w"), F.lit(WINDOW))
    rows = rows.select("item_id", "w", span.alias("span")).withColumn("at", F.explode(_places(F.size("w"), F.col("span"))))
    own = F.slice(F.col("w"), F.col("at"), F.col("span"))
    return (
        rows.select("item_id", "span", own.alias("words"))
        .groupBy(F.xxhash64("words").alias("hash"), "span", "words")
        .agg(F.collect_set("item_id").alias("items"))
    )


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key`` (digest of the text), ``n_words, n_hit, n_items, items_sha256`` of every distinct text with a hit.

    A word is hit if it lies inside any occurrence of a window.  Items are listed by their ids as strings; one without id
    counts for hits only.  NULL and empty texts, and an empty benchmark, have no hits.  The benchmark's windows are a
    written table, so Spark broadcasts them only if their files are small.
    """
    windows = written(benchmark_windows(benchmark))
    # At most WINDOW lengths.
    spans = sorted(r["span"] for r in windows.select("span").distinct().collect())
    shortest = min(spans, default=WINDOW)
    k = min(K, shortest)
    w = shortest - k + 1
    marks = written(windows.select(F.explode(fingerprints(F.col("words"), k, w)).alias("mark")).distinct())
    texts = docs.select(F.md5("text").alias("key"), words(F.col("text")).alias("w")).filter(F.size("w") >= shortest)
    seen = texts.select("key", F.explode(fingerprints(F.col("w"), k, w)).alias("mark")).join(marks, "mark", "left_semi")
    keys = seen.select("key").distinct()
    found = docs.select(F.md5("text").alias("key"), "text").join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    return _extended(found.select("key", words(F.col("text")).alias("w")), windows, spans)


def _extended(found: DataFrame, windows: DataFrame, spans: list[int]) -> DataFrame:
    """Hits of texts (``key``, ``w``) that share a fingerprint with the benchmark."""

    def windows_of(span: int) -> Column:
        return F.transform(
            _places(F.size("w"), span),
            lambda i: F.struct(
                i.alias("at"), F.lit(span).alias("span"), F.xxhash64(F.slice(F.col("w"), i, F.lit(span))).alias("hash")
            ),
        )

    none = F.array().cast("array<struct<at:int,span:int,hash:bigint>>")
    occurrences = F.concat(none, *map(windows_of, spans))
    rows = found.select("key", F.size("w").alias("n_words"), F.explode(occurrences).alias("o"))
    rows = rows.select("key", "n_words", "o.at", "o.span", "o.hash")
    hits = rows.join(windows.select("hash", "span", "items"), ["hash", "span"])
    covered = F.aggregate(
        F.array_sort(F.transform("hits", lambda h: F.struct(h["at"], (h["at"] + h["span"]).alias("end")))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda done, h: F.struct(
            F.greatest(done["end"], h["end"]).alias("end"),
            (done["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(done["end"], h["at"]))).cast("long").alias("n"),
        ),
    )
    items = F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))
    names = F.array_sort(F.transform(items, lambda i: i.cast("string")))
    return (
        hits.groupBy("key")
        .agg(F.first("n_words").cast("long").alias("n_words"), F.collect_list(F.struct("at", "span", "items")).alias("hits"))
        .select(
            "key",
            "n_words",
            covered["n"].alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        )
    )


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hits and verdict of every document; repeated rows get equal ones, NULL text has no words."""
    hits = contaminated_texts(docs, benchmark).drop("n_words")
    own = docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), F.md5("text").alias("key"))
    none = F.lit(0).cast("long")
    n_hit = F.coalesce("n_hit", none)
    return own.join(hits, "key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        is_contaminated(F.col("n_words"), n_hit).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that are not contaminated, as they were."""
    bad = contaminated_texts(docs, benchmark).filter(is_contaminated(F.col("n_words"), F.col("n_hit"))).select("key")
    return docs.withColumn("__text_digest", F.md5("text")).join(bad.withColumnRenamed("key", "__text_digest"), "__text_digest", "left_anti").drop("__text_digest")
