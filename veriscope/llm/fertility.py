"""Quality rules from what public vocabularies make of a text.

Each white-space separated word is tokenised on its own, so a worker keeps the tokens of words it has seen (a bounded
number of them).  Measured per text: characters per token under a piece vocabulary with byte fallback and under a
byte-level vocabulary, the share of tokens that are byte fallbacks, and the entropy of the tokens relative to the
largest value for so many tokens (of at most 512).

There are two bands.  The fixed outer ``BANDS``, per script, reject what no running text looks like.  Inside them, lower limits
per script and language follow the bulk of the documents: what is no text breaks into more and odder tokens than that.
The bulk is the shortest interval of a measure's histogram that holds ``CORE`` of the documents; where two such intervals
lie apart, with few documents between them, the upper one counts, so the bulk is found while junk is less than half of all.
Its width, as that of a normal distribution, gives the spread; the limit lies ``SPREADS`` spreads below its middle.  The fewer
the documents, the wider: there is no number from which on limits begin.  Documents with equal numbers of words and
characters count once, so that copies and near copies, however many, do not pass for the bulk.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, chain, filterfalse, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriscope.session import written

from .caches import WordCache, sliced

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"  # counted by the base rules
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CORE = 0.25  # share of the documents in the interval that is taken for the bulk
CORE_SPREADS = 0.6373  # width of that interval of a normal distribution, in standard deviations
SPREADS = 7.0  # below the middle of the bulk
LEAST_SPREAD = 0.01  # of the middle
UNSURE = 0.05  # of the middle, more spread for one document; less with the root of their number
GAP = 0.25  # of the bulk's density: fewer documents than that between two intervals part them
BINS = 1024  # of a histogram for each unit of a measure
ENTROPY_TOKENS = 512  # a longer text is not asked for more entropy
AT_ONCE = 2048  # new words in one call of the piece model
SEEN = 1 << 16  # distinct words of texts that are looked through for new ones at a time, and those of one more text


@dataclass(frozen=True)
class Band:
    """What is accepted; characters do not count white space."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_fallback_share: float
    min_entropy: float


#: By script, the outer limits.  Wide on purpose: they reject what no running text of the script looks like.
BANDS = {
    "latin": Band(1.15, 12.0, 0.25, 0.35),
    "greek": Band(0.6, 8.0, 0.6, 0.35),
    "cyrillic": Band(0.8, 10.0, 0.4, 0.35),
    "semitic": Band(0.5, 8.0, 0.8, 0.35),
    "indic": Band(0.3, 8.0, 0.95, 0.3),
    "east_asian": Band(0.25, 6.0, 0.95, 0.3),
    "other": Band(0.2, 20.0, 1.0, 0.3),
}
#: Measures with a limit from the data.
FOLLOWED = ("chars_per_token", "chars_per_byte_token", "token_entropy")
#: Lead bytes of UTF-8 by script.
LEAD_BYTES = {
    "latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)],
    "greek": [0xCE, 0xCF],
    "cyrillic": [*range(0xD0, 0xD4)],
    "semitic": [*range(0xD7, 0xDC)],
    "indic": [0xE0],
    "east_asian": [*range(0xE3, 0xEE)],
}
COLUMNS = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "kept": pa.bool_(),
    "script": pa.string(),
    "chars_per_token": pa.float64(),
    "chars_per_byte_token": pa.float64(),
    "fallback_share": pa.float64(),
    "token_entropy": pa.float64(),
}
SQL_TYPES = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string", pa.float64(): "double"}


class Words(WordCache):
    """Word (bytes) to 16-bit numbers as bytes: its piece ids, then its number of byte-level tokens, low half first.

    One short value for each word, so that many fit into what a worker may remember (:meth:`measures` takes them apart).
    A call of the piece model costs several times what a word in it costs, so the new words of several texts go in
    together (:meth:`learn`).
    """

    def __init__(self, piece_model: str, byte_ranks: str, pattern: str):
        import sentencepiece
        import tiktoken

        super().__init__(lambda word: self.tokens([word])[0])
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        with open(byte_ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])

    def tokens(self, words: list[bytes]) -> list[bytes]:
        texts = [word.decode(errors="replace") for word in words]
        pieces = self.pieces.encode(texts, num_threads=1)
        ids = np.fromiter(chain.from_iterable(pieces), dtype="<u2").tobytes()
        ends = list(accumulate((2 * len(x) for x in pieces), initial=0))
        tails = np.array([len(self.bytes.encode_ordinary(" " + text)) for text in texts], dtype="<u4").tobytes()
        return [ids[a:b] + tails[4 * i : 4 * i + 4] for i, (a, b) in enumerate(pairwise(ends))]

    def measures(self, words: list[bytes]) -> tuple[np.ndarray, int]:
        """The piece ids of all of these words (one at least), and their number of byte-level tokens."""
        found = list(map(self.__getitem__, words))
        numbers = np.frombuffer(b"".join(found), dtype="<u2")
        ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found))) // 2
        piece = np.ones(len(numbers), dtype=bool)
        piece[ends - 2] = piece[ends - 1] = False
        return numbers[piece], int(numbers[ends - 2].sum(dtype=np.int64)) + (int(numbers[ends - 1].sum(dtype=np.int64)) << 16)

    def learn(self, texts: Iterable[list[bytes]]) -> None:
        """Makes the new words of these texts, ``AT_ONCE`` in a call."""
        seen: set[bytes] = set()
        for words in texts:
            seen.update(words)
            if len(seen) >= SEEN:
                self.make_all(seen)
                seen = set()
        self.make_all(seen)

    def make_all(self, words: set[bytes]) -> None:
        for word in self.older.keys() & words:
            self[word]  # back to the newer half, so that the words made here do not push it out
        new = list(filterfalse(self.__contains__, words))
        for at in range(0, len(new), AT_ONCE):
            part = new[at : at + AT_ONCE]
            for word, value in zip(part, self.tokens(part), strict=True):
                self.keep(word, value)


_words: dict[tuple, Words] = {}


def words_of(*files: str) -> Words:
    """The worker's words for these vocabulary files; they outlive a task."""
    if files not in _words:
        _words[files] = Words(*files)
    return _words[files]


def vocabularies() -> tuple[str, str, str]:
    """Piece model, byte-level ranks and their splitting pattern, as installed."""
    import public_tokenizers

    names = ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")
    return (*map(public_tokenizers.path, names), public_tokenizers.PATTERN)


def script_of(raw: bytes) -> str:
    """The script of most letters; ``other`` without any."""
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    letters = {name: int(seen[lead].sum()) for name, lead in LEAD_BYTES.items()}
    best = max(letters, key=letters.get)
    return best if letters[best] else "other"


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text holds twice or more, its first place included."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    windows = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, windows), len(twice) - 1)] == windows)
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[starts + shift] = True
    return int(covered.sum())


def measure(text: str | None, vocabulary: Words, bands: dict[str, Band] = BANDS) -> tuple:
    """One row of ``COLUMNS``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space alone, which is SPACE
    n_dup_lines, lines = 0, set()
    for line in text.split("\n"):
        if line.strip(SPACE):
            if line in lines:
                n_dup_lines += 1
            else:
                lines.add(line)
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SPACE))
    n_repeat = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    per_token = per_byte_token = fallback = entropy = None
    script = script_of(raw)
    kept = not base_failed
    if words:
        ids, n_bytes = vocabulary.measures(words)
        _, counts = np.unique(ids, return_counts=True)
        n = max(1, len(ids))
        per_token = word_chars / n
        per_byte_token = word_chars / max(1, n_bytes)
        fallback = float(vocabulary.fallback[ids].mean()) if len(ids) else 1.0
        share = counts / n
        entropy = float(-(share * np.log2(share)).sum() / np.log2(min(n, ENTROPY_TOKENS))) if n > 1 else 0.0
        band = bands.get(script, bands["other"])
        kept = kept and bool(
            band.min_chars_per_token <= per_token <= band.max_chars_per_token
            and per_byte_token <= band.max_chars_per_token
            and fallback <= band.max_fallback_share
            and entropy >= band.min_entropy
        )
    return (
        n_words, word_chars, sum(map(text.count, SYMBOLS)), n_dup_lines, n_repeat, base_failed, kept,
        script, per_token, per_byte_token, fallback, entropy,
    )


def measured(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), files: tuple[str, str, str] | None = None) -> DataFrame:
    """The columns ``carry`` of every document with its measures, ``kept`` by the base rules and the outer bands alone.

    A narrow map over whole texts: no shuffle, one text at a time.
    """
    files = files or vocabularies()
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    schema = f"{kinds}, " + ", ".join(f"{name} {SQL_TYPES[kind]}" for name, kind in COLUMNS.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = words_of(*files).begin()
        for batch in sliced(batches):
            texts = batch.column(0).to_pylist()
            vocabulary.learn(text.encode().split() for text in texts if text)
            rows = [measure(text, vocabulary) for text in texts]
            values = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(COLUMNS.values())]
            carried = [batch.column(i + 1) for i in range(len(carry))]
            yield pa.RecordBatch.from_arrays([*carried, *values], names=[*carry, *COLUMNS])

    return docs.select(docs["text"].alias("_text"), *(docs[c] for c in carry)).mapInArrow(run, schema)


def shortest(bins: np.ndarray, counts: np.ndarray, need: float) -> tuple[int, int] | None:
    """Places of the first and last bin of the shortest interval that holds ``need`` documents; the upper of equal ones."""
    ends = np.cumsum(counts)
    if not len(ends) or ends[-1] < need:
        return None
    first = np.arange(len(bins))
    last = np.searchsorted(ends, ends - counts + need - 1e-9)
    fits = last < len(bins)
    width = np.where(fits, bins[np.minimum(last, len(bins) - 1)] - bins[first], np.iinfo(np.int64).max)
    best = len(width) - 1 - int(width[::-1].argmin())
    return best, int(last[best])


def bulk(bins: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Middle and spread of the bulk, in bins; ``bins`` are sorted and not empty.

    From the shortest interval on, upwards to one that is parted from it by a gap, if there is one.
    """
    total = float(counts.sum())
    need = CORE * total
    first, last = shortest(bins, counts, need)
    while (above := shortest(bins[last + 1 :], counts[last + 1 :], need)) is not None:
        lo, hi = above[0] + last + 1, above[1] + last + 1
        room = float(bins[lo] - bins[last] - 1)
        dense = min(need / float(bins[j] - bins[i] + 1) for i, j in ((first, last), (lo, hi)))
        if room <= 0 or counts[last + 1 : lo].sum() >= GAP * dense * room:
            break
        first, last = lo, hi
    middle = (bins[first] + bins[last] + 1) / 2
    spread = (bins[last] - bins[first] + 1) / CORE_SPREADS
    return float(middle), float(max(spread, LEAST_SPREAD * middle) + UNSURE * middle / np.sqrt(total))


def lower_limit(bins: np.ndarray, counts: np.ndarray) -> float:
    """The least accepted value of a measure."""
    middle, spread = bulk(bins, counts)
    return (middle - SPREADS * spread) / BINS


def limits(rows: DataFrame) -> DataFrame:
    """``script, _lang, low``: the least accepted value of each of ``FOLLOWED`` per script and language, from all of ``rows``.

    A script also has a row without a language, with the least of its languages' limits: for documents whose language is not
    known.  A histogram has a row per bin that occurs, and is looked at as a whole.
    """
    key = ["script", "_lang"]
    values = F.struct(*FOLLOWED)
    one_each = rows.filter("kept").groupBy(*key, "n_words", "word_chars").agg(F.max_by(values, F.xxhash64(*FOLLOWED)).alias("v"))
    each = F.array(*(F.struct(F.lit(i).alias("measure"), F.floor(F.col("v")[m] * BINS).alias("bin")) for i, m in enumerate(FOLLOWED)))
    counts = one_each.select(*key, F.inline(each)).groupBy(*key, "measure", "bin").count()

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin")
        low = lower_limit(rows["bin"].to_numpy(np.int64), rows["count"].to_numpy(np.int64))
        return rows.iloc[:1][[*key, "measure"]].assign(low=low)

    fitted = counts.groupBy(*key, "measure").applyInPandas(fit, "script string, _lang string, measure int, low double")
    own = fitted.groupBy(*key).agg(*(F.max(F.when(F.col("measure") == i, F.col("low"))).alias(f"_low{i}") for i in range(len(FOLLOWED))))
    own = written(own)
    least = own.groupBy("script").agg(*(F.min(f"_low{i}").alias(f"_low{i}") for i in range(len(FOLLOWED))))
    least = least.withColumn("_lang", F.lit(None).cast("string"))
    return written(own.filter("_lang IS NOT NULL").unionByName(least))


def fertility(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), files: tuple[str, str, str] | None = None) -> DataFrame:
    """The columns ``carry`` of every document with its measures and verdict.

    Measures are written once, then judged by limits from all of them, per script and ``lang`` (per script if ``docs`` has no
    such column).  NULL and empty texts have no words: measures are NULL, the script is ``other``, and they fail the base
    rules.  Equal texts of one language get equal verdicts.  Columns outside ``carry`` are not read.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = written(measured(docs.withColumn("_lang", lang), (*carry, "_lang"), files))
    low = limits(rows).withColumnsRenamed({"script": "_script", "_lang": "_of"})
    joined = rows.join(low, (F.col("script") == F.col("_script")) & F.col("_lang").eqNullSafe(F.col("_of")), "left")
    inside = F.lit(True)
    for i, name in enumerate(FOLLOWED):
        inside = inside & F.coalesce(F.col(name) >= F.col(f"_low{i}"), F.lit(True))
    return joined.withColumn("kept", F.col("kept") & inside).select(*(F.col(c) for c in carry), *COLUMNS)


def rejections(found: DataFrame) -> DataFrame:
    """Per script of what :func:`fertility` gives: documents, and how many the bands alone reject."""
    alone = F.count_if(~F.col("base_failed") & ~F.col("kept"))
    return found.groupBy("script").agg(F.count("*").alias("documents"), alone.alias("rejected_by_bands"))
