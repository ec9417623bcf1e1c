"""Spelling variants: words at edit distance one, found by pivotal grams, with the frequent form of each word.

All bigrams of the words are ranked from rare to frequent; there are as many as pairs of letters, so the ranks are a
bounded table.  A word's gram prefix is its ``2 t + 1`` rarest bigrams (ties included) for distance t = 1.  Of these, dynamic
programming picks the ``t + 1`` pivots that do not overlap and are rarest together.  An edit touches at most one of two
disjoint bigrams; so, of two near words, the one whose prefix ends earlier in the ranking has a pivot that stands, at the
same place or moved by the difference in length, in the other's prefix.  Since the one edit lies to the right or to the left
of that surviving bigram, everything up to it, or everything from it on, is equal too: this, with the lengths, is the key
under which pivots look up prefixes.  Candidates are verified by their edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.session import written

from .tables import ascii_lower, let

DISTANCE = 1
GRAM = 2
PREFIX = GRAM * DISTANCE + 1
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10  # a form is so many times as frequent as its variant
TYPO = 31  # one run in so many loses a letter


def runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """``owner, run``: lower-cased letter runs of at least ``least`` letters of whole texts; shorter ones never become words."""
    letters = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(rf"([a-zÀ-ÿ]{{{least},}})"), F.lit(1))
    owner = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(owner.alias("owner"), F.explode(letters).alias("run"))


def with_typos(owner: Column, run: Column) -> Column:
    """The run, or for one in ``TYPO``, by the checksum of owner and run, the run without one letter."""
    sum_of = F.crc32(F.encode(F.concat(owner, F.lit(":"), run), "UTF-8"))
    at = lambda h: F.pmod(h, F.length(run)).cast("int")
    cut = lambda h: F.concat(F.substring(run, F.lit(1), at(h)), F.substring(run, at(h) + 2, F.length(run)))
    return let(sum_of, lambda h: F.when(F.pmod(h, F.lit(TYPO)) == 0, cut(h)).otherwise(run))


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: every word of at least ``least`` letters that occurs ``count`` times or more in all texts.

    Counts are added up before the shuffle, so a frequent word is one row per task.
    """
    words = runs(docs, least).select(with_typos(F.col("owner"), F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= count)


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """Every bigram's place in the order from rare to frequent.  At most (26 + 64)^2 bigrams exist in lower-cased runs."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring("word", i, F.lit(GRAM)))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect()
    ordered = sorted(counts, key=lambda r: (r["count"], r.gram))
    return {r.gram: i for i, r in enumerate(ordered)}


def pivots(grams: list[tuple[int, int]], most: int = DISTANCE + 1) -> list[int]:
    """Places of the ``most`` grams that do not overlap and have the least sum of ranks; ``grams``: (place, rank) by place."""
    # best[k]: for the grams seen so far, the least sum and the places of k disjoint ones
    seen: list[list[tuple[int, list[int]] | None]] = []
    for i, (place, rank) in enumerate(grams):
        before = i
        while before and grams[before - 1][0] > place - GRAM:
            before -= 1
        best: list[tuple[int, list[int]] | None] = [(0, [])]
        for k in range(1, most + 1):
            skip = seen[i - 1][k] if i else None
            base = (seen[before - 1] if before else [(0, [])] + [None] * most)[k - 1]
            take = (base[0] + rank, [*base[1], place]) if base else None
            best.append(min((x for x in (skip, take) if x), key=lambda x: x[0], default=None))
        seen.append(best)
    last = seen[-1][most]
    return last[1] if last else []


def grams_of(word: str, ranks: dict[str, int]) -> tuple[int, list[int], list[int]]:
    """Rank at which the word's prefix ends, the places of its prefix grams and of its pivots among them."""
    every = [(i, ranks[word[i : i + GRAM]]) for i in range(len(word) - GRAM + 1)]
    end = sorted(r for _, r in every)[min(PREFIX, len(every)) - 1]
    prefix = [g for g in every if g[1] <= end]
    return end, [p for p, _ in prefix], pivots(prefix)


def keys_of(word: str, length: int, place: int) -> tuple[int, int]:
    """The two keys of a gram in a word (or its near word) of ``length``: the edit lies behind it, or before it."""
    left = xxhash.xxh64_intdigest(word[: place + GRAM].encode(), seed=2 * length)
    right = xxhash.xxh64_intdigest(word[place:].encode(), seed=2 * length + 1)
    return left - (left >> 63 << 64), right - (right >> 63 << 64)


def indexed(words: DataFrame, ranks: dict[str, int], asking: bool) -> DataFrame:
    """``key, word, n, last, letters``: a word's pivots as they would stand in near words (``asking``), or its prefix grams.

    ``letters`` has a bit per letter of the word (letters may share one); one edit changes two bits at most.
    """
    spans = range(-DISTANCE, DISTANCE + 1) if asking else (0,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, key, last, letters = [], [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                end, prefix, chosen = grams_of(word, ranks)
                keys = {k for p in (chosen if asking else prefix) for n in spans for k in keys_of(word, len(word) + n, p)}
                mask = 0
                for c in set(word):
                    mask |= 1 << ord(c) % 63
                key += keys
                owner += [i] * len(keys)
                last += [end] * len(keys)
                letters += [mask] * len(keys)
            own = batch.select(["word", "n"]).take(pa.array(owner, pa.int64()))
            more = [pa.array(key, pa.int64()), pa.array(last, pa.int32()), pa.array(letters, pa.int64())]
            yield pa.RecordBatch.from_arrays([*own.columns, *more], names=["word", "n", "key", "last", "letters"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, key long, last int, letters long")


def near_words(words: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """``word, n, near, near_n``: every pair of words at edit distance one, in both directions, once.

    A word of l letters has at most (2 l + 1) x 90 near words, so no group below grows with the data.
    """
    asks = indexed(words, ranks, asking=True).select("key", *(F.col(c).alias(f"a_{c}") for c in ("word", "n", "last", "letters")))
    holds = indexed(words, ranks, asking=False).select("key", *(F.col(c).alias(f"b_{c}") for c in ("word", "n", "last", "letters")))
    found = asks.join(holds, "key").filter(
        # The prefix of the asking word ends earlier; of two that end at the same rank, one asks.
        ((F.col("a_last") < F.col("b_last")) | ((F.col("a_last") == F.col("b_last")) & (F.col("a_word") < F.col("b_word"))))
        & (F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2 * DISTANCE)
        & (F.levenshtein("a_word", "b_word", DISTANCE) == DISTANCE)
    )
    pairs = written(found.select("a_word", "a_n", "b_word", "b_n").distinct())
    names = ("word", "n", "near", "near_n")
    return pairs.toDF(*names).union(pairs.select("b_word", "b_n", "a_word", "a_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``word, form`` ends.  Pointers double each round.

    Each form is ``RATIO`` times as frequent as the word before it, so at most 19 follow each other and five rounds do.
    """
    up = written(forms.select("word", F.col("form").alias("root")))
    while True:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(up.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        up = moved.select("word", "root")
        if moved.filter("next IS NOT NULL").isEmpty():
            return up


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for words (``word, n``, each once, of four letters or more; ``words`` is read often).

    A word's form is its near word of largest n (of equal ones the smallest in code-point order) if that is ``ratio`` times its
    own n or more, its root the form where forms end.  No words give no rows.
    """
    near = near_words(words, gram_ranks(words))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    isform = -F.col("best.less") >= ratio * F.col("n")
    judged = written(
        words.select("word", "n")
        .join(best, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(isform, F.col("best.near")).alias("form"),
            F.when(isform, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(judged.filter("form IS NOT NULL"))
    joined = judged.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants among the words of whole texts.  NULL texts have no words; a NULL ``doc_id`` counts as empty text."""
    return variants(written(vocabulary(docs)))
