"""Exact removal of long repeated byte strings with a partitioned, sampled suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.  Sorting every suffix is not
needed for that.  Each string of ``LENGTH`` bytes is filed under one *anchor* inside it: the place whose following ``GRAM``
bytes have the least hash.  Equal strings have their anchors at equal places, so they meet at suffixes that start at
equal anchors.  Neighbouring strings mostly share an anchor; such a *run* of strings is one row.

1. Every document is cut into runs (about one per 100 bytes), with hashes of the anchor and of the run's bytes.
2. An anchor that occurs once settles its run: nothing in it repeats.  Equal runs settle each other: everything in
   them repeats.  Both are counted before and after the shuffle, without any text.
3. The other runs bring their bytes.  Spark samples splitters and range-partitions them by the leading bytes of the
   suffix at the anchor; splitters are whole leading strings, so suffixes that share one never sit on two sides of a
   boundary.  A bucket is sorted by multikey quicksort, one 8-byte token at a time, and so are the reversed bytes
   before the anchors.  A string that starts o bytes before its anchor repeats if another suffix of its group agrees on
   LENGTH - o bytes to the right and on o bytes to the left, which neighbours' common prefixes tell.
4. An anchor with more than ``HOT_RUNS`` different runs (a licence line, each time in other surroundings) would be one
   group in one task.  Its runs are cut into their strings instead, and 128-bit digests of those are counted before and
   after a shuffle, so that no task holds the anchor.
5. Spans go back to their documents.

Rows with the same runs (copies) are only counted, never compared; what is compared at one anchor are different runs.

Passages of ``PASSAGE`` words that other documents hold too may be shorter than ``LENGTH`` bytes.  They are counted, not removed,
by the same runs and anchors over words instead of bytes; strings at an anchor with different runs are told apart by hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriscope.session import dropped, written

from .caches import WordCache, sliced

LENGTH = 400
GRAM = 200  # bytes hashed at an anchor
BLOCK = 1 << 18  # bytes of a text that are cut into runs at a time
LEADING = 64  # bytes by which suffixes are dealt out
BATCH_RUNS = 4000  # runs compared at a time; a whole group at least
HOT_RUNS = 4000  # different runs at one anchor that are compared in one group
CUT_RUNS = 500  # runs cut into strings at a time
PASSAGE = 51  # words
PASSAGE_GRAM = 8  # words hashed at an anchor

_PLACE_BITS = np.uint64(20)
_PLACES = np.uint64((1 << 20) - 1)
_rng = np.random.default_rng(400)
_VALUES = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            table = np.ones(BLOCK + LENGTH + 1, dtype=np.uint64)
            table[1:] = np.uint64(base)
            _powers.append(np.multiply.accumulate(table))
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _least(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours."""
    size = 1
    while 2 * size <= span:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x if size == span else np.minimum(x[: len(x) - (span - size)], x[span - size :])


def block_runs(values: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """First start, number of strings, place of the anchor, hash of the anchor, hash of the run, of one block; a hash per string.

    ``values`` are odd random numbers that stand for the bytes (or words).
    """
    power, inverse = _power_tables()
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * power[:n], out=sums[1:])
    grams = _mixed((sums[gram:] - sums[:-gram]) * inverse[: n + 1 - gram])
    places = np.arange(len(grams), dtype=np.uint64)
    least = _least((grams & ~_PLACES) | places, length - gram + 1)
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change - 1, [len(least) - 1]])
    anchor = (least[first] & _PLACES).astype(np.int64)
    own = (sums[last + length] - sums[first]) * inverse[first]
    shape = ((anchor - first) << 32 | (last - first)).astype(np.uint64)
    run = (_mixed(own) ^ _mixed(shape + np.uint64(1))).view(np.int64)
    strings = _mixed((sums[length:] - sums[:-length]) * inverse[: n + 1 - length])
    return first, last - first + 1, anchor - first, grams[anchor].view(np.int64), run, strings


RUN_FIELDS = "row binary, start long, strings int, left int, anchor long, run long"


def row_key() -> Column:
    """Identity of a row: its id and its text.  Rows equal in both are interchangeable."""
    return F.unhex(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))))


def runs(rows: DataFrame) -> DataFrame:
    """The runs of ``row, text``; a text shorter than ``LENGTH`` bytes has none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
                for at in range(0, len(raw) - LENGTH + 1, BLOCK):
                    first, strings, left, anchor, run, _ = block_runs(_VALUES[raw[at : at + BLOCK + LENGTH - 1]], LENGTH, GRAM)
                    found.append([np.full(len(first), i), first + at, strings, left, anchor, run])
            if found:
                owner, start, strings, left, anchor, run = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner)),
                        pa.array(start),
                        pa.array(strings.astype(np.int32)),
                        pa.array(left.astype(np.int32)),
                        pa.array(anchor),
                        pa.array(run),
                    ],
                    names=["row", "start", "strings", "left", "anchor", "run"],
                )

    return rows.select("row", "text").mapInArrow(cut, RUN_FIELDS)


_hashes = WordCache(lambda word: xxhash.xxh64_intdigest(word) | 1)


def word_runs(rows: DataFrame) -> DataFrame:
    """The runs of passages of ``PASSAGE`` words: ``row, anchor, run, left, strings`` with a hash per passage."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _hashes.begin()
        for batch in sliced(batches):
            found: list[list[np.ndarray]] = []
            hashes: list[np.ndarray] = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = (text or "").encode().split()
                if len(words) < PASSAGE:
                    continue
                values = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
                for at in range(0, len(words) - PASSAGE + 1, BLOCK):
                    first, n, left, anchor, run, strings = block_runs(values[at : at + BLOCK + PASSAGE - 1], PASSAGE, PASSAGE_GRAM)
                    found.append([np.full(len(first), i), n, left, anchor, run])
                    hashes.append((strings >> np.uint64(32)).astype(np.uint32).view(np.int32))
            if found:
                owner, n, left, anchor, run = (np.concatenate(c) for c in zip(*found, strict=True))
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner)),
                        pa.array(anchor),
                        pa.array(run),
                        pa.array(left.astype(np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(hashes))),
                    ],
                    names=["row", "anchor", "run", "left", "strings"],
                )

    return rows.select("row", "text").mapInArrow(cut, "row binary, anchor long, run long, left int, strings array<int>")


def shared_passages(rows: DataFrame) -> DataFrame:
    """``row, n_shared``: how many of a row's passages of ``PASSAGE`` words another row holds too; rows without one are left out."""
    own = written(word_runs(rows))
    kinds = own.groupBy("anchor").agg(F.min("row").alias("a"), F.max("row").alias("b"), F.min("run").alias("lo"), F.max("run").alias("hi"))
    kinds = written(kinds.filter("a <> b").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")))
    again = written(own.join(kinds, "anchor"))
    dropped(own)
    # A passage lies as far before its anchor wherever it stands.
    each = again.filter("mixed").select("row", "anchor", "left", F.posexplode("strings").alias("at", "hash"))
    each = each.select("row", "anchor", (F.col("left") - F.col("at")).alias("before"), "hash")
    key = ["anchor", "before", "hash"]
    twice = written(each.groupBy(*key).agg(F.min("row").alias("a"), F.max("row").alias("b")).filter("a <> b").select(*key))
    settled = again.filter("NOT mixed").select("row", F.size("strings").alias("n"))
    met = each.join(twice, key, "left_semi").select("row", F.lit(1).alias("n"))
    # Rows equal in id and text have one key, so their passages were counted once for each of them.
    copies = written(rows.groupBy("row").agg(F.count("*").alias("_copies")).filter("_copies > 1"))
    total = settled.union(met).groupBy("row").agg(F.sum("n").alias("n")).join(copies, "row", "left")
    found = written(total.select("row", F.expr("n div coalesce(_copies, 1)").alias("n_shared")))
    dropped(kinds, again, twice, copies)
    return found


def multikey_sort(group: np.ndarray, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings (``rows``, zero behind ``size``) within groups, and common prefixes of neighbours (-1 across groups).

    Multikey quicksort: strings that agree so far are parted by their next token of 8 bytes, all such sets at once.
    """
    tokens = rows.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    cls = np.searchsorted(group[order], group[order])
    for depth in range(tokens.shape[1]):
        size_of = np.bincount(cls, minlength=len(cls))
        place = np.flatnonzero(size_of[cls] > 1)
        if not len(place):
            break
        token = tokens[order[place], depth]
        by = np.lexsort((token, cls[place]))
        order[place] = order[place][by]
        known, token = cls[place], token[by]
        new = np.concatenate([[True], (known[1:] != known[:-1]) | (token[1:] != token[:-1])])
        cls[place] = np.maximum.accumulate(np.where(new, place, 0))
    one, two = order[:-1], order[1:]
    differs = rows[one] != rows[two]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    common = np.minimum(common, np.minimum(size[one], size[two]))
    return order, np.where(group[one] == group[two], common, -1)


def _matrix(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in parts])
    rows = np.zeros((len(parts), max(8, -(-int(size.max()) // 8) * 8)), dtype=np.uint8)
    for i, part in enumerate(parts):
        rows[i, : len(part)] = np.frombuffer(part, dtype=np.uint8)
        rows[i, : len(part)] += 1  # text has no byte 255; so the end of a string differs from a zero in it
    return rows, size


def repeated(anchor: np.ndarray, data: list[bytes], left: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """For each run and each o whether its string that starts o bytes before the anchor also is in another run."""
    group = np.unique(anchor, return_inverse=True)[1]
    order_r, common_r = multikey_sort(group, *_matrix([d[n:] for d, n in zip(data, left, strict=True)]))
    order_l, common_l = multikey_sort(group, *_matrix([d[:n][::-1] for d, n in zip(data, left, strict=True)]))
    found = np.zeros((len(data), int(left.max()) + 1), dtype=bool)
    cls_r, cls_l = np.empty(len(data), dtype=np.int64), np.empty(len(data), dtype=np.int64)
    for o in range(found.shape[1]):
        own = np.flatnonzero((left >= o) & (left - strings < o))
        if len(own) < 2:
            continue
        cls_r[order_r] = np.concatenate([[0], np.cumsum(common_r < LENGTH - o)])
        cls_l[order_l] = np.concatenate([[0], np.cumsum(common_l < o)])
        _, place, times = np.unique(cls_r[own] * len(data) + cls_l[own], return_inverse=True, return_counts=True)
        found[own, o] = times[place] > 1
    return found


def compared(suffixes: DataFrame) -> DataFrame:
    """Repeated spans ``row, start, end`` of runs that occur once, from runs dealt out and sorted by suffix.

    The task keeps whole anchors together and holds fewer than ``BATCH_RUNS`` runs and one anchor's different runs at a time.
    """
    names = ["row", "start", "strings", "left", "anchor", "copies", "data"]

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        key, start, strings, left, anchor, copies, data = zip(*rows, strict=True)
        left, strings = np.array(left), np.array(strings)
        found = repeated(np.array(anchor), data, left, strings)
        out: list[tuple] = []
        for i in np.flatnonzero(found.any(axis=1) & (np.array(copies) == 1)):
            hit = found[i, left[i] - np.arange(strings[i])]  # by start
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                out.append((key[i], start[i] + int(a), start[i] + int(b) - 1 + LENGTH))
        columns = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()), strict=True)],
            names=["row", "start", "end"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for r in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True):
                if len(held) >= BATCH_RUNS and held[-1][4] != r[4]:
                    yield spans(held)
                    held = []
                held.append(r)
        if held:
            yield spans(held)

    return suffixes.select(*names).mapInArrow(run, "row binary, start long, end long")


def counted(suffixes: DataFrame) -> DataFrame:
    """What :func:`compared` finds, by counts of the runs' strings: no task holds an anchor, however many runs it has."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CUT_RUNS):
                batch = whole.slice(at, CUT_RUNS)
                starts, counts, copies, data = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("start", "strings", "copies", "data"))
                digests = [hashlib.blake2b(d[o : o + LENGTH], digest_size=16).digest() for d, n in zip(data, counts, strict=True) for o in range(n)]
                owner = np.repeat(np.arange(len(counts)), counts)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(batch.schema.get_field_index("row")).take(pa.array(owner)),
                        pa.array(np.array(starts)[owner]),
                        pa.array(place.astype(np.int32)),
                        pa.array(np.array(copies)[owner] > 1),
                        pa.array(digests, pa.binary()),
                    ],
                    names=["row", "run_start", "place", "settled", "digest"],
                )

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends = [], [], []
            for key, start, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hit = np.unique(places)
                breaks = np.flatnonzero(np.diff(hit) > 1)
                for a, b in zip(hit[np.append(0, breaks + 1)], hit[np.append(breaks, len(hit) - 1)], strict=True):
                    rows.append(key)
                    starts.append(start + int(a))
                    ends.append(start + int(b) + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["row", "start", "end"]
            )

    own = ["row", "start", "strings", "copies", "data"]
    strings = suffixes.select(*own).mapInArrow(cut, "row binary, run_start long, place int, settled boolean, digest binary")
    strings = written(strings)
    # A table of its own, so that Spark may split the places of a very frequent string in the join.
    again = written(strings.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"))
    found = strings.filter("NOT settled").join(again, "digest", "left_semi")
    found = found.groupBy("row", "run_start").agg(F.collect_list("place").alias("places"))
    return found.mapInArrow(spans, "row binary, start long, end long")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """Spans ``row, start, end`` (bytes, end exclusive; they overlap) of ``row, doc_id, text`` that repeat somewhere."""
    own = written(runs(rows))
    # Per anchor: does it occur again, and with different runs?
    kinds = own.groupBy("anchor").agg(F.count("*").alias("n"), F.min("run").alias("lo"), F.max("run").alias("hi"))
    # A table of its own, so that Spark may split the runs of a very frequent anchor in the join.
    kinds = written(kinds.filter("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")))
    again = written(own.join(kinds, "anchor"))
    whole = [F.col("start"), (F.col("start") + F.col("strings") - 1 + LENGTH).alias("end")]
    mixed = again.filter("mixed")
    different = written(
        mixed.groupBy("anchor", "run").agg(F.count("*").alias("copies"), F.min(F.struct("row", "start", "strings", "left")).alias("r"))
    )
    # By their places, which are unique, not by run: one run may hold a third of all rows.
    single = different.filter("copies = 1").select("r.row", "r.start")
    equal = mixed.join(single, ["row", "start"], "left_anti")
    wanted = different.select("anchor", "copies", "r.*")
    size = (F.col("strings") - 1 + LENGTH).cast("int")
    data = F.substring(F.encode("text", "UTF-8"), (F.col("start") + 1).cast("int"), size)
    # Repeated rows have equal keys, and bring a run more than once: those runs count as copies already.
    bring = ["row", "start", "strings", "left", "anchor", "copies"]

    def suffixes(runs: DataFrame) -> DataFrame:
        return rows.join(runs.select(*bring), "row").select(*bring, data.alias("data"))

    hot = written(wanted.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_RUNS).select("anchor"))
    found = again.filter("NOT mixed").select("row", *whole).union(equal.select("row", *whole))
    if not hot.isEmpty():
        found = found.union(counted(suffixes(wanted.join(hot, "anchor", "left_semi"))))
        wanted = wanted.join(hot, "anchor", "left_anti")
    leading = F.substring(F.col("data"), F.col("left") + 1, F.lit(LEADING))
    # The anchor too, so that many anchors with the same leading bytes are not one task's.
    dealt = suffixes(wanted).withColumn("leading", leading).repartitionByRange("leading", "anchor")
    return found.union(compared(dealt.sortWithinPartitions("leading", "anchor")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept, n_shared`` of every document: removed spans (maximal, in bytes) and the bytes that stay.

    ``n_shared`` counts the passages of ``PASSAGE`` words, at every start, that another document holds too, removed or not.

    NULL counts as an empty text; a text shorter than ``LENGTH`` bytes loses nothing.  Rows that repeat are copies of each
    other.  Bytes are judged on the input, so a string goes everywhere.
    """
    rows = docs.select(row_key().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shared = shared_passages(rows)
    found = repeated_spans(rows).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    found = found.join(shared, "row", "full")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode()
                merged: list[list[int]] = []
                for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                sizes.append(len(raw))
                removed.append([{"start": a, "end": b} for a, b in merged])
                edges = [0, *(x for span in merged for x in span), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.list_(span)), pa.array(kept, pa.binary()), batch.column(3)],
                names=["doc_id", "n_bytes", "spans", "kept", "n_shared"],
            )

    joined = rows.join(found, "row", "left").select("doc_id", "text", "spans", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"))
    schema = f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, n_shared long"
    return joined.mapInArrow(remove, schema)


def digests(deduped: DataFrame) -> DataFrame:
    """Counts and the digest of what stays."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return deduped.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"),
        F.col("n_shared").alias("n_shared_passages"),
    )
