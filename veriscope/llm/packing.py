"""Best-fit packing by length patterns.

Documents are tokenised once, cut only where they are longer than a sequence, and written as pieces, with their ids if asked for.
The histogram of piece lengths (at most one number per length) then decides everything: patterns of a few lengths that
fill a sequence are enumerated on a coarse grid, their repeat counts are fitted to the histogram by non-negative least
squares and rounded down, and what is left is packed best-fit into the gaps and into new sequences.  All this works on
counts of lengths, so its cost does not depend on the number of documents.  The outcome is a table of runs: "the pieces
of length l with ranks from a to b go to the sequences from s on, at offset o".  Ranks come from a salted count, so no
task gets all pieces of one length.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veriscope.session import written

from .caches import WordCache, sliced

CAPACITY = 4096
END_ID = 1  # closes every document
GRID = 128  # cells of the coarse grid
PATTERN_PIECES = 4  # lengths in a pattern, at most
HALF = (1 << 15) - 1  # the largest number of 16 bits
SALTS = 64  # parts in which the pieces of one length are ranked
PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # without the apostrophe, which may start an ending


class WordIds(WordCache):
    """White-space separated word (bytes) to its ids as little-endian 32-bit bytes, for a tokenizer that drops white space.

    A Latin word, with or without punctuation behind it, skips the tokenizer's normalisation, which would change only its
    case, and its splitting, which puts the punctuation apart; every other word goes through the tokenizer as it is.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__(self.made)
        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        alphabet = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in alphabet]
        # The byte-level alphabet: printable bytes stand for themselves, others for characters from 256 on.
        self.shown = {b: chr(b) for b in alphabet} | {b: chr(256 + i) for i, b in enumerate(others)}

    def made(self, word: bytes) -> bytes:
        low = word.lower()
        core = low.rstrip(PUNCTUATION)
        if core.isalpha():  # of ASCII letters alone
            if len(core) == len(word):
                return self.merged(core.decode()) if low == word else self[low]
            tail = word[len(core) :]
            return self[core] + (self[tail] if len(tail) < 4 else self.full(tail.decode()))
        text = word.decode(errors="replace")
        core = word.rstrip(PUNCTUATION)
        letters = core.decode(errors="replace")
        if letters.isalpha() and max(letters) < "\u0250" and (small := letters.lower()).isalpha():
            if len(core) < len(word):
                tail = word[len(core) :]
                return self[small.encode()] + (self[tail] if len(tail) < 4 else self.full(tail.decode()))
            if small != letters:
                return self[small.encode()]
            return self.merged("".join(map(self.shown.__getitem__, word)))
        return self.full(text)

    def merged(self, shown: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def full(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_ids: dict[str, WordIds] = {}


def words_of(file: str) -> WordIds:
    """The worker's words for a vocabulary file; its tokenizer outlives a task."""
    if file not in _ids:
        _ids[file] = WordIds(file)
    return _ids[file]


def ids_of(text: str | None, file: str) -> bytes:
    """A document's ids with the closing one, as little-endian 32-bit bytes."""
    words = words_of(file)
    spaced = (text or "").encode().split()
    return b"".join(map(words.__getitem__, spaced)) + END_ID.to_bytes(4, "little")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document, in pieces of at most ``capacity`` ids.

    A narrow map over whole texts.  A NULL or empty text is one piece that holds only the closing id.
    """
    file = file or vocabulary()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of(file).begin()
        for batch in sliced(batches):
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                raw = ids_of(text, file)
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    owner.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def patterns(cells: int = GRID, most: int = PATTERN_PIECES) -> np.ndarray:
    """One row per way to fill ``cells`` with at most ``most`` positive parts: how often each part 1..cells occurs."""
    found: list[list[int]] = []

    def extend(parts: list[int], left: int, smallest: int) -> None:
        if len(parts) + 1 <= most and left >= smallest:
            found.append([*parts, left])
        if len(parts) + 2 <= most:
            for part in range(smallest, left // 2 + 1):
                extend([*parts, part], left - part, part)

    extend([], cells, 1)
    rows = np.zeros((len(found), cells + 1), dtype=np.float32)
    for i, parts in enumerate(found):
        for part in parts:
            rows[i, part] += 1
    return rows[:, 1:]


def nonnegative_fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b| (active set method); its size depends on the grid alone."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    scale = max(1.0, float(b.max(initial=0)))
    for _ in range(3 * a.shape[0]):
        gain = a.T @ (b - a @ x).astype(a.dtype)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-5 * scale:
            break
        active[best] = True
        while True:
            own = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, own].astype(float), b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[own] = s
                break
            low = s <= 0
            step = (x[own][low] / np.maximum(x[own][low] - s[low], 1e-12)).min()
            x[own] += step * (s - x[own])
            dropped = own[(x[own] <= 1e-9 * scale) & low]
            if not len(dropped):
                dropped = own[low][:1]
            x[dropped] = 0
            active[dropped] = False
    return x


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Where the pieces go, from how many there are of each length (``counts[l]``, l up to ``capacity``).

    Returns runs (length, first rank, end rank, first sequence, offset), sorted by length and rank, and the number of
    sequences.  Ranks count the pieces of one length from 0.
    """
    counts = counts.astype(np.int64).copy()
    runs: list[tuple[int, int, int, int, int]] = []
    given = np.zeros(capacity + 1, dtype=np.int64)  # ranks already placed, by length
    gaps: dict[int, list[tuple[int, int, int]]] = {}  # free ids -> (first sequence, sequences, offset)
    total = int(counts[capacity])
    if total:
        runs.append((capacity, 0, total, 0, 0))
        given[capacity], counts[capacity] = total, 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, int(given[length]), int(given[length]) + n, first, offset))
        given[length] += n
        counts[length] -= n

    # Lengths on the grid are rounded up, so a pattern never overfills a sequence.
    cell = -(-np.arange(capacity + 1) * GRID // capacity)
    held = np.bincount(cell[1:], weights=counts[1:], minlength=GRID + 1)[1:]
    if held.sum():
        ways = patterns()
        fit = np.floor(nonnegative_fit(ways.T, held)).astype(np.int64)
        left = held.astype(np.int64)
        lengths_of = [np.flatnonzero(cell == c)[::-1] for c in range(GRID + 1)]
        for way in np.argsort(-fit, kind="stable"):
            parts = [(c + 1, int(m)) for c, m in enumerate(ways[way]) if m]
            n = min([int(fit[way]), *(int(left[c - 1]) // m for c, m in parts)])
            if n <= 0:
                continue
            slots: list[list[tuple[int, int]]] = []  # per slot: lengths and how many of each, n in all
            for k, (c, m) in enumerate(parts):
                left[c - 1] -= n * m
                # The smallest part is left to the best fit below, which knows the true gap.
                for _ in range(m - (k == 0 and sum(m for _, m in parts) > 1)):
                    need, slot = n, []
                    for length in lengths_of[c]:
                        took = min(need, int(counts[length] - sum(k for s in slots for x, k in s if x == length)))
                        if took > 0:
                            slot.append((int(length), took))
                            need -= took
                        if not need:
                            break
                    slots.append(slot)
            cuts = sorted({0, n, *(int(e) for s in slots for e in np.cumsum([k for _, k in s]))})
            heads = [[s, 0, 0] for s in slots]  # slot, position in it, used of that position
            for a, b in pairwise(cuts):
                offset = 0
                for head in heads:
                    slot, at, used = head
                    length = slot[at][0]
                    put(length, b - a, total + a, offset)
                    offset += length
                    head[2] = used + b - a
                    if head[2] == slot[at][1]:
                        head[1], head[2] = at + 1, 0
                if offset < capacity:
                    gaps.setdefault(capacity - offset, []).append((total + a, b - a, offset))
            total += n
    # Best fit, longest first: equal pieces at a time, into the smallest gap that takes one.
    room = np.zeros(capacity + 1, dtype=bool)
    for free in gaps:
        room[free] = True
    for length in range(capacity, 0, -1):
        while counts[length] > 0:
            fits = length + int(room[length:].argmax())
            if room[fits]:
                first, n, offset = gaps[fits].pop()
                room[fits] = bool(gaps[fits])
                took = min(n, int(counts[length]))
                put(length, took, first, offset)
                if took < n:
                    gaps[fits].append((first + took, n - took, offset))
                    room[fits] = True
                opened = [(fits - length, first, took, offset + length)]
            else:
                each = capacity // length
                n = int(counts[length])
                opened = []
                for sequences, per in ((n // each, each), (1 if n % each else 0, n % each)):
                    if sequences:
                        for k in range(per):
                            put(length, sequences, total, k * length)
                        opened.append((capacity - per * length, total, sequences, per * length))
                        total += sequences
            for free, first, n, offset in opened:
                if free:
                    gaps.setdefault(free, []).append((first, n, offset))
                    room[free] = True
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    return table, total


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (see :func:`pieces`) with ``sequence_id`` and ``offset``.

    ``parts`` is read three times and should be a written table.  Pieces of equal length are told apart by doc_id, piece
    and digest; equal rows may swap places, which changes nothing.  No rows give no sequences.
    """
    with_ids = "ids" in parts.columns
    largest = F.max(F.array_max("ids")) if with_ids else F.lit(None)
    # At most one row per possible length reaches the driver.
    counts = np.zeros(capacity + 1, dtype=np.int64)
    narrow = with_ids
    for length, n, most in parts.groupBy("length").agg(F.count("*"), largest).collect():
        counts[length] = n
        narrow = narrow and most <= 2 * HALF
    runs, _ = plan(counts, capacity)
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS))
    sizes = parts.groupBy("length", salt.alias("_salt")).agg(F.count("*").alias("_n"))  # at most lengths x SALTS rows
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        F.col("length").alias("_length"), F.col("_salt").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    # Ids of 16 bits are moved as such.
    moved = parts.withColumn("ids", F.transform("ids", lambda x: (x - HALF - 1).cast("smallint"))) if narrow else parts
    ranked = (
        moved.withColumn("_salt", salt)
        .withColumn("_row", F.row_number().over(within) - 1)
        .join(firsts, (F.col("length") == F.col("_length")) & (F.col("_salt") == F.col("_part")))
        .withColumn("_rank", (F.col("_first") + F.col("_row")).cast("long"))
        .drop("_salt", "_row", "_length", "_part", "_first")
    )
    key = runs[:, 0] << np.int64(40) | runs[:, 1]  # lengths and ranks in one sorted number

    # Only lengths and ranks go to Python, so pieces with their ids stay where they are.
    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rank = rank.to_numpy(dtype=np.int64)
        run = runs[np.searchsorted(key, length.to_numpy(dtype=np.int64) << np.int64(40) | rank, side="right") - 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + rank - run[:, 1], "offset": run[:, 4]})

    placed = ranked.withColumn("_place", place("length", "_rank")).select(*parts.columns, "_place.sequence_id", "_place.offset")
    return placed.withColumn("ids", F.transform("ids", lambda x: x.cast("int") + HALF + 1)) if narrow else placed


def packed(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Whole documents to packed pieces, with their ids if asked for; the pieces are written once to the shared folder."""
    return pack(written(pieces(docs, file, capacity, with_ids)), capacity)
