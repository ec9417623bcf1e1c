"""Near-duplicates: MinHash bands, sequential Bayesian pruning, exact verification, connected components.

Equal texts are one node (digest of the text).  A node has ``HASHES`` minima, of which the last byte is kept as its
signature, and ``BANDS`` band hashes over the first of them; two nodes with an equal band are candidates.  Most nodes have no
candidate, so all texts get the minima of the bands alone, and only members of a bucket the other ones.  A band's bucket may
hold a very large group, so its pairs are never listed: every member is first compared with its most central neighbour
(the one with the most bucket mates), components are formed, and only members of a bucket that are still in
different components are compared with each other, block against block, inside a task, in the first band they share.

A candidate's signatures are compared ``BATCH`` hashes at a time.  With a uniform prior, m of n equal hashes give
P(J >= t | m, n) = P(Bin(n + 1, t) <= m); a pair whose probability falls under its share of ``MISS`` is dropped, every other
pair is verified on the full shingle sets.  Losses of the looks add up, so each of the ``HASHES / BATCH`` looks has an equal
share: over all looks a pair of similarity 0.85 is dropped with a probability of 7.3e-6.  A pair of similarity 0.85 shares no band with a probability of 4e-7.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriscope.session import dropped, written

from .caches import sliced
from .components import components

SHINGLE = 5
WORD = r"[^\x09-\x0D\x20]"  # a character of a word
PERCENT = 85
HASHES = 512
ROWS, BANDS = 5, 25
BATCH = 32
MISS = 1e-5  # over all looks at a pair
BLOCK = 256  # members of a bucket that are compared with as many others in one group
FILTER_BITS = 16  # per key of a filter that keeps most other texts from being shuffled

_rng = np.random.default_rng(20210)
_FACTORS = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; one for a text of fewer words, none without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    # A word's hash takes less time than its place in a dictionary; a digest has its bytes in big-endian order.
    h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), dtype=">u8").astype(np.uint64)
    n = len(words) - SHINGLE + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(SHINGLE):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def minima(sets: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """The first ``hashes`` minima, of 32 bits each."""
    least = np.full(hashes, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(sets), 256):
        part = sets[at : at + 256, None] * _FACTORS[:hashes]
        part += _ADDENDS[:hashes]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def bands_of(least: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of ``ROWS`` minima, for each row of a matrix of minima."""
    mixed = np.arange(BANDS, dtype=np.uint64)
    for at in range(ROWS):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + least[:, at : BANDS * ROWS : ROWS])
    return mixed.view(np.int64)


@functools.cache
def least_matches() -> np.ndarray:
    """For n compared hashes the fewest equal ones with P(J >= t | m, n) of at least a look's share of MISS."""
    t = PERCENT / 100
    t += (1 - t) / 256  # bytes of different minima may be equal
    fewest = np.zeros(HASHES + 1, dtype=np.int64)
    for n in range(1, HASHES + 1):
        below, m = 0.0, -1
        while below < MISS * BATCH / HASHES:
            m += 1
            below += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(t) + (n + 1 - m) * log(1 - t))
        fewest[n] = m
    return fewest


def survivors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the row pairs of two signature matrices that no batch of hashes ruled out."""
    fewest = least_matches()
    left = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for n in range(BATCH, HASHES + 1, BATCH):
        matches += (a[left, n - BATCH : n] == b[left, n - BATCH : n]).sum(axis=1)
        stay = matches >= fewest[n]
        left, matches = left[stay], matches[stay]
    return left


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, HASHES)


def nodes(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n_shingles, bands`` per document; a text without words has no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, least = [], []
            for text in batch.column(2).to_pylist():
                own = shingles(text)
                sizes.append(len(own))
                least.append(minima(own, ROWS * BANDS))
            bands = [row if size else None for size, row in zip(sizes, bands_of(np.array(least)).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "key", "n_shingles", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", _key(), "text").mapInArrow(
        run, f"doc_id {kind}, key binary, n_shingles long, bands array<bigint>"
    )


def _key() -> Column:
    return F.unhex(F.md5("text")).alias("key")


def _pruned(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that the signatures leave possible."""
    one = signed.select(F.col("key").alias("a"), F.col("signature").alias("sa"))
    two = signed.select(F.col("key").alias("b"), F.col("signature").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sa, sb = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "sa", "sb"))
            if batch.num_rows:
                left = pa.array(survivors(_signatures(sa), _signatures(sb)))
                yield pa.RecordBatch.from_arrays([a.take(left), b.take(left)], names=["a", "b"])

    return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(run, "a binary, b binary")


def _possible(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of all ``keys`` and, of other rows, about one in ``FILTER_BITS``; no text is moved.

    What is broadcast is a bit map of ``FILTER_BITS`` bits for each key, in words of 64.
    """
    words = -(-keys.count() * FILTER_BITS // 64)
    if not words:
        return texts.limit(0)
    word, bit = F.pmod(F.xxhash64("key"), F.lit(words)), F.pmod(F.xxhash64("key", F.lit(1)), F.lit(64)).cast("int")
    marks = keys.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("mark"))
    marks = marks.groupBy("word").agg(F.bit_or("mark").alias("marks"))
    marked = texts.withColumn("word", word).withColumn("bit", bit).join(F.broadcast(marks), "word")
    return marked.filter(F.getbit("marks", "bit") == 1).select(*texts.columns)


def _texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, text`` of the distinct ``keys``; an inner join, since Spark would move a semi-join below the filter."""
    texts = _possible(docs.select(_key(), "text"), keys)
    return texts.join(keys, "key").groupBy("key").agg(F.first("text").alias("text"))


def _shingle_sets(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, shingles, signature, bands`` of every text of ``keys``, written; the one place where texts are shuffled."""
    texts = _texts_of(docs, keys)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            own, least = [], []
            for text in batch.column(1).to_pylist():
                full = shingles(text)
                own.append(full.tobytes())
                least.append(minima(full))
            least = np.array(least)
            signatures = (least & np.uint32(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(own, pa.binary()),
                    pa.array([row.tobytes() for row in signatures], pa.binary()),
                    pa.array(bands_of(least).tolist(), pa.list_(pa.int64())),
                ],
                names=["key", "shingles", "signature", "bands"],
            )

    return written(texts.mapInArrow(sets, "key binary, shingles binary, signature binary, bands array<bigint>"))


def _verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose full shingle sets are similar enough."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, one, two = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "one", "two"))
            left = []
            for i, (x, y) in enumerate(zip(one, two, strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    left.append(i)
            left = pa.array(left, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(left), b.take(left)], names=["a", "b"])

    one = full.select(F.col("key").alias("a"), F.col("shingles").alias("one"))
    two = full.select(F.col("key").alias("b"), F.col("shingles").alias("two"))
    return written(pairs.join(one, "a").join(two, "b").mapInArrow(similar, "a binary, b binary"))


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components: ``band, bucket, key, label``."""
    now = members.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    open_ = now.groupBy("band", "bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    return now.join(open_.select("band", "bucket"), ["band", "bucket"], "left_semi")


def _across(apart: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs of different components within a bucket that the signatures leave possible, found block against block.

    A bucket's members, ordered by component, are cut into blocks of about ``BLOCK``; two blocks meet in one group unless
    all their members are of one component.
    """
    sizes = apart.groupBy("band", "bucket").agg(F.count("*").alias("size"))
    # Blocks by a hash of the component, then of the member: no window over a whole bucket.
    spot = F.pmod(F.xxhash64("label"), F.ceil(F.col("size") / BLOCK))
    blocked = written(apart.join(sizes, ["band", "bucket"]).withColumn("spot", spot).drop("size"))
    parts = blocked.groupBy("band", "bucket", "spot").agg(
        F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")
    )
    pieces = parts.withColumn("pieces", F.ceil(F.col("n") / BLOCK))
    blocked = blocked.join(pieces.select("band", "bucket", "spot", "pieces"), ["band", "bucket", "spot"]).withColumn(
        "piece", F.pmod(F.xxhash64("key"), F.col("pieces"))
    )
    blocks = pieces.select("band", "bucket", "spot", "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    block = F.struct("spot", "piece")
    one = blocks.select("band", "bucket", block.alias("one"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"))
    two = blocks.select("band", "bucket", block.alias("two"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    # A block with one component need not meet itself, nor another of the same component.
    meet = one.join(two, ["band", "bucket"]).filter("one <= two AND NOT (lo1 = hi1 AND lo2 = hi2 AND lo1 = lo2)")
    meet = meet.select("band", "bucket", "one", "two")
    own = blocked.select("band", "bucket", block.alias("own"), "key", "label")
    own = own.join(signed.select("key", "signature", "bands"), "key")
    sides = meet.select("*", F.explode(F.array_distinct(F.array("one", "two"))).alias("own"))
    rows = sides.join(own, ["band", "bucket", "own"]).select(
        "band", "bucket", (F.col("own") == F.col("two")).alias("second"), F.to_json("one").alias("one"), F.to_json("two").alias("two"), "key", "label", "signature", "bands"
    )

    def compare(table: pa.Table) -> pa.Table:
        found_a, found_b = [], []
        keys, labels = table.column("key").to_pylist(), np.array(table.column("label").to_pylist(), dtype=object)
        signed = _signatures(table.column("signature"))
        bands = np.array(table.column("bands").to_pylist(), dtype=np.int64).reshape(-1, BANDS)
        band = table.column("band")[0].as_py()
        # Of two blocks only pairs across them are this group's; within a block they are the group's of that block alone.
        two_blocks = table.column("one")[0] != table.column("two")[0]
        side = np.array(table.column("second").to_pylist())
        for i in range(len(keys) - 1):
            others = i + 1 + np.flatnonzero(labels[i + 1 :] != labels[i])
            if two_blocks:
                others = others[side[others] != side[i]]
            # A pair is looked at in the first band it shares.
            others = others[(bands[others] == bands[i]).argmax(axis=1) == band]
            near = survivors(np.broadcast_to(signed[i], (len(others), HASHES)), signed[others])
            for j in others[near]:
                found_a.append(min(keys[i], keys[j]))
                found_b.append(max(keys[i], keys[j]))
        return pa.table({"a": pa.array(found_a, pa.binary()), "b": pa.array(found_b, pa.binary())})

    return rows.groupBy("band", "bucket", "one", "two").applyInArrow(compare, "a binary, b binary")


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written :func:`nodes`, and ``key, label, component_id`` of every distinct text with words.

    ``label`` is one text of the component, ``component_id`` its smallest ``doc_id``.
    """
    own = written(nodes(docs))
    named = own.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    named = written(named)
    members = named.select("key", F.posexplode("bands").alias("band", "bucket"))
    mates = members.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(members.join(mates, ["band", "bucket"]))
    # The most central member of a bucket is the one with the most mates over all its bands.
    weighed = members.groupBy("key").agg(F.sum("n").alias("weight"))
    weighed = written(members.select("band", "bucket", "key").join(weighed, "key"))
    heads = weighed.groupBy("band", "bucket").agg(F.max(F.struct("weight", "key")).alias("head"))
    stars = weighed.join(heads, ["band", "bucket"]).groupBy("key").agg(F.max("head").alias("head"))
    full = _shingle_sets(docs, written(weighed.select("key").distinct()))
    first = written(_pruned(stars.select(F.col("head.key").alias("a"), F.col("key").alias("b")).filter("a <> b"), full))
    links = _verified(first, full)
    labels = components(links)
    across = _across(_apart(weighed.select("band", "bucket", "key"), labels), full)
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = written(across.join(tested, ["a", "b"], "left_anti"))
    if not second.isEmpty():
        labels = components(links.union(_verified(second, full)))
    named = named.select("key", "first_id").join(labels.withColumnRenamed("node", "key"), "key", "left")
    named = written(named.withColumn("label", F.coalesce("label", "key")))
    dropped(members, weighed, full)
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return own, named.join(smallest, "label").select("key", "label", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    A document without words (NULL, empty, white space) is linked with nothing: it is its own component.  Rows with equal
    ``doc_id`` count as one document.  A document without ``doc_id`` is kept only if no document of its component has one.
    """
    own, classes = _classes(docs)
    return (
        own.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("key")).alias("key"))
        .join(classes.select("key", "component_id"), "key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of one document of each component, as they were: of the one with the smallest ``doc_id``.

    A row is judged by its id and its text, so a copy goes also if another row of its id stays; rows of one id in one component
    stay together.  Of a component in which no row has an id, one row stays.  Rows without words stay.
    """
    _, classes = _classes(docs)
    has_words = F.coalesce(docs["text"].rlike(WORD), F.lit(False))
    key = F.unhex(F.md5(docs["text"]))
    named = docs.filter(has_words & docs["doc_id"].isNotNull())
    named = named.join(classes, (key == classes["key"]) & (docs["doc_id"] == classes["component_id"]), "left_semi")
    # Equal texts without an id are made one row before the join, so a frequent one is a row per task there.
    copy = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns)))
    nameless = docs.filter(has_words & docs["doc_id"].isNull()).withColumn("__copy", copy).filter("__copy = 1")
    alone = classes.filter("component_id IS NULL AND key = label")
    nameless = nameless.join(alone, key == alone["key"], "left_semi").drop("__copy")
    return docs.filter(~has_words).unionByName(named).unionByName(nameless)
