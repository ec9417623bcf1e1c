r"""Secret scans with a battery of randomness tests, as column expressions alone.

Base kinds are patterns (``assign``, ``access``, ``hex``).  The method adds the kind ``random``: tokens of 20 or more
characters of an encoding's alphabet, with both letters and digits, that look drawn at random.  For each token the
encoding is inferred (hex, base32 or base64), and three tests ask whether its symbols are uniform and independent:

* chi-squared of the symbol counts against the uniform distribution (Wilson-Hilferty),
* the runs of symbols below and above the middle of the alphabet (Wald-Wolfowitz),
* the serial correlation of neighbouring symbols.

Fisher's method joins their p-values.  Tokens are compared within classes of encoding and length (powers of the square
root of two), because a short token gives a test little to go by: in each class the Benjamini-Hochberg rule at
``FALSE_DISCOVERY`` says which tokens are *not* random, from a histogram of the whole corpus; the others are secrets.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veriscope.session import written

from .tables import let

# The base patterns and their least lengths.
ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 12
ACCESS = "AKIA[A-Z0-9]{14,}"  # longest runs, so dropping short ones first changes nothing
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

TOKEN = "[A-Za-z0-9+/_=-]{20,}"
FALSE_DISCOVERY = 0.05
BLOCK = 256
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
MASK = "[secret]"


def running(lengths: Column) -> Column:
    """For each element the sum of those before it; in blocks, so that long arrays do not cost their square."""
    last = functools.partial(F.element_at, extraction=-1)
    zero = F.array(F.lit(0).cast("long"))

    def grow(total: Column, x: Column) -> Column:
        return F.array_append(total, last(total) + x)

    def in_blocks(lengths: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)), zero, grow),
        )

    def shifted(block: Column, first: Column) -> Column:
        return F.transform(F.slice(block, F.lit(1), F.size(block) - 1), lambda x: x + first)

    def joined(blocks: Column) -> Column:
        firsts = F.aggregate(blocks, zero, lambda total, block: grow(total, last(block)))
        return F.flatten(let(firsts, lambda f: F.transform(blocks, lambda block, i: shifted(block, F.element_at(f, i + 1)))))

    own = let(lengths, lambda x: let(in_blocks(x), joined))
    return F.when(F.size(lengths) > 0, own).otherwise(F.array().cast("array<bigint>"))


def _matches(docs: DataFrame, kind: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds the array ``kind`` of (start, end, token): all matches of a pattern, leftmost first, without overlaps."""
    text = F.col("_text")
    hits, gaps, before, tokens = (f"_{kind}_{x}" for x in ("hits", "gaps", "before", "tokens"))
    found = docs.withColumn(hits, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    any_hit = F.size(hits) > 0
    empty = F.array().cast("array<string>")
    found = found.withColumns(
        {
            gaps: F.when(any_hit, F.split(text, pattern, -1)).otherwise(empty),
            tokens: F.when(any_hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(empty) if group else F.col(hits),
        }
    )
    pairs = F.transform(hits, lambda h, i: (F.length(h) + F.length(F.element_at(F.col(gaps), i + 1))).cast("long"))
    found = found.withColumn(before, running(pairs))

    def span(hit: Column, i: Column) -> Column:
        start = F.element_at(F.col(before), i + 1) + F.length(F.element_at(F.col(gaps), i + 1))
        return F.struct(
            start.cast("long").alias("start"),
            (start + F.length(hit)).cast("long").alias("end"),
            F.element_at(F.col(tokens), i + 1).alias("token"),
        )

    return found.withColumn(kind, F.transform(hits, span)).drop(hits, gaps, before, tokens)


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic approximation), at least 1e-12."""
    return F.greatest(F.lit(1e-12), 1 / (1 + F.exp(F.least(F.lit(40.0), 1.5976 * z + 0.07056 * z * z * z))))


def battery(token: Column) -> Column:
    """Encoding, size of its alphabet, and the token's symbols as numbers from 1."""
    plain = F.translate(token, "-_=", "+/")  # the URL alphabet counts as the usual one, padding does not count

    def numbered(own: Column, name: str) -> Column:
        alphabet = F.lit(ALPHABETS[name])
        numbers = F.transform(
            F.sequence(F.lit(1), F.length(own)), lambda i: F.position(F.substring(own, i, F.lit(1)), alphabet).cast("double")
        )
        # A token of padding alone has no symbols.
        numbers = F.when(F.length(own) > 0, numbers).otherwise(F.array().cast("array<double>"))
        return F.struct(F.lit(name).alias("encoding"), F.lit(float(len(ALPHABETS[name]))).alias("k"), numbers.alias("x"))

    return let(
        plain,
        lambda t: F.when(t.rlike("^([0-9a-f]+|[0-9A-F]+)$"), let(F.lower(t), lambda x: numbered(x, "hex")))
        .when(t.rlike("^[A-Z2-7]+$"), numbered(t, "base32"))
        .otherwise(numbered(t, "base64")),
    )


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def _score(prepared: Column) -> Column:
    """Ten times the negative decimal logarithm of the joint p-value, rounded down, from (k, symbol numbers)."""
    x, k = prepared["x"], prepared["k"]
    n = F.size(x).cast("double")
    squares = total(F.transform(F.array_distinct(x), lambda s: F.pow(F.size(F.filter(x, lambda y: y == s)).cast("double"), F.lit(2.0))))
    chi, df = k / n * squares - n, k - 1
    spread = 2 / (9 * df)
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
    high = F.size(F.filter(x, lambda s: s > k / 2)).cast("double")
    after = F.sequence(F.lit(2), F.size(x))
    changes = total(
        F.transform(after, lambda i: ((F.element_at(x, i - 1) > k / 2) != (F.element_at(x, i) > k / 2)).cast("double"))
    )

    def z_of_runs(high: Column) -> Column:
        expected = 2 * high * (n - high) / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        return F.when(variance > 0, F.abs(1 + changes - expected) / F.sqrt(variance)).otherwise(F.lit(9.0))

    def z_of_serial(mean: Column) -> Column:
        power = total(F.transform(x, lambda s: (s - mean) * (s - mean)))
        product = total(F.transform(after, lambda i: (F.element_at(x, i - 1) - mean) * (F.element_at(x, i) - mean)))
        return let(power, lambda p: F.when(p > 0, F.abs(product / p) * F.sqrt(n)).otherwise(F.lit(9.0)))

    def joint(half: Column) -> Column:
        p = F.exp(-half) * (1 + half + half * half / 2)  # chi-squared of six degrees of freedom
        return F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-20)))).cast("int")

    def two_sided(z: Column) -> Column:
        return F.least(F.lit(1.0), 2 * tail(z))

    logs = [
        F.log(let(z_chi, tail)),
        F.log(let(let(high, z_of_runs), two_sided)),
        F.log(let(let(total(x) / n, z_of_serial), two_sided)),
    ]
    return let(-(logs[0] + logs[1] + logs[2]), joint)


def scan(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry``, and per document its base ``spans`` and its candidate ``tokens`` with class and bin; a narrow map."""
    rows = docs.select(*(docs[c] for c in carry), F.coalesce(docs["text"], F.lit("")).alias("_text"))
    rows = _matches(rows, "assign", ASSIGN, group=2)
    rows = rows.withColumn("assign", F.filter("assign", lambda s: F.length(s["token"]) >= ASSIGN_VALUE))
    rows = _matches(rows, "access", ACCESS)
    rows = _matches(rows, "hex", HEX)
    rows = _matches(rows, "random", TOKEN)

    def of_kind(k: int) -> Column:
        return F.transform(KINDS[k], lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))

    base = F.concat(*map(of_kind, range(3)))
    rows = rows.withColumn("spans", F.array_sort(base))
    mixed = F.filter(
        "random",
        lambda s: s["token"].rlike("[0-9]")
        & s["token"].rlike("[A-Za-z]")
        & ~F.exists("spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    rows = rows.withColumn("random", mixed)
    rows = rows.withColumn(
        "random", F.transform("random", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), battery(s["token"]).alias("t")))
    )
    rows = rows.withColumn("random", F.filter("random", lambda s: F.size(s["t"]["x"]) >= 8))
    scored = F.transform(
        "random",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.concat_ws(
                ":", s["t"]["encoding"], F.floor(2 * F.log2(F.size(s["t"]["x"]).cast("double"))).cast("int").cast("string")
            ).alias("class"),
            _score(s["t"]).alias("bin"),
        ),
    )
    return rows.select(*carry, "spans", scored.alias("tokens"))


def cutoffs(scanned: DataFrame) -> DataFrame:
    """Per class of tokens the smallest ``bin`` that counts as not random (NULL: none does).

    Benjamini-Hochberg on the histogram of the whole corpus: at most 201 bins per class reach the window.
    """
    counts = scanned.select(F.explode("tokens").alias("t")).groupBy("t.class", "t.bin").agg(F.count("*").alias("n"))
    down = Window.partitionBy("class").orderBy(F.desc("bin"))
    everything = Window.partitionBy("class")
    ranked = counts.withColumn("seen", F.sum("n").over(down)).withColumn("total", F.sum("n").over(everything))
    rejected = F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("total") <= FALSE_DISCOVERY * F.col("seen")
    return ranked.groupBy("class").agg(F.min(F.when(rejected, F.col("bin"))).alias("cutoff"))


def find(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and ``spans`` of every document: sorted (start, kind, end), kinds numbered as in ``KINDS``.

    Offsets are code points, ends exclusive.  NULL counts as an empty text, which has no spans.  Spans of different kinds may
    overlap; a random token never overlaps a base span.  The scan is written once, since the cutoffs and the result both
    read it.  There are at most 3 encodings times 64 length classes, so the cutoffs travel to the tasks as one literal map.
    """
    scanned = written(scan(docs, carry))
    limits = {r["class"]: r["cutoff"] for r in cutoffs(scanned).collect()}
    entries = [x for name, cutoff in sorted(limits.items()) for x in (F.lit(name), F.lit(cutoff).cast("int"))]
    limit = F.create_map(*entries) if entries else F.lit(None).cast("map<string,int>")
    random = F.filter("tokens", lambda t: F.coalesce(t["bin"] < limit[t["class"]], F.lit(True)))
    added = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return scanned.select(*carry, F.array_sort(F.concat("spans", added)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def digests(found: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)

    def count(k: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")

    counts = {f"n_{name}": count(k) for k, name in enumerate(KINDS)}
    return found.select(
        *carry, *(c.alias(n) for n, c in counts.items()), F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``MASK``; overlapping or touching spans by one."""
    first = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def join(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        overlaps = F.coalesce(last["end"] >= s["start"], F.lit(False))
        return F.when(overlaps, F.array_append(F.slice(done, F.lit(1), F.size(done) - 1), wider)).otherwise(F.array_append(done, own))

    merged = F.aggregate(spans, first, join)
    starts = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(merged, lambda s: s["end"]))
    parts = F.zip_with(ends, starts, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int")))
    return F.when(F.size(spans) > 0, F.array_join(parts, MASK)).otherwise(text)
