"""WARC revisit resolution: an as-of join of not-modified records to earlier full responses.

Records have ``record_id, url, at`` (capture time, any orderable number), ``kind`` (``response`` or ``revisit``), ``etag``,
``last_modified``, ``headers`` (a map of lower-case names) and ``payload`` (a digest or place of the body).  A revisit
says that the server answered "not modified"; it is resolved to the latest earlier response of the same canonical URL if the
validators of the two agree.

A host, or one URL, may hold a third of all records.  The latest response is therefore looked up within (URL, bucket of
time) first, and only one row per URL and bucket goes on to the next bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 4096  # time units that one group of a URL spans
# Header fields which a not-modified answer may update (RFC 9110, 15.4.5, and RFC 9111, 3.2).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"(?<=[?&])(?:utm_[^=&]*|ref|fbclid|gclid)(?:=[^&]*)?(?:&|$)"


def canonical(url: Column) -> Column:
    """URL without scheme, ``www.``, default port, fragment, tracking parameters and closing slash; host in lower case.

    NULL stays NULL: such a record has no earlier response.
    """
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    plain = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    plain = F.regexp_replace(F.regexp_replace(plain, TRACKING, ""), r"[?&]+$", "")
    host = F.lower(F.regexp_extract(plain, r"^[^/?]*", 0))
    rest = F.substring(plain, F.length(host) + 1, F.length(plain))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    return F.concat(host, F.regexp_replace(rest, r"/+$", ""))


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, canonical_url, status, response_id, payload, headers``.

    ``status`` is ``resolved``, ``mismatch`` (the latest earlier response has other validators, or neither side has one) or
    ``missing`` (no earlier response); only a resolved revisit has a payload.  Strong comparison: ``etag`` decides if both have
    one, else ``last_modified``.  The headers are the response's, updated with the revisit's permitted ones; NULL maps count
    as empty.  Records at the same time are ordered responses first, then by id, so a response counts as earlier than
    a revisit of its moment.  A record without time or URL is never a response to others, and a revisit without one is missing.
    """
    own = records.select("record_id", canonical(F.col("url")).alias("canonical_url"), "at", "kind", "etag", "last_modified", "headers", "payload")
    full = F.struct("record_id", "etag", "last_modified", "headers", "payload")
    usable = F.col("at").isNotNull() & F.col("canonical_url").isNotNull()
    own = own.withColumns(
        {
            "bucket": F.floor(F.col("at") / BUCKET),
            "response": F.when((F.col("kind") == "response") & usable, full),
        }
    )
    by_moment = [F.col("at"), F.when(F.col("kind") == "response", 0).otherwise(1), F.col("record_id")]
    within = Window.partitionBy("canonical_url", "bucket").orderBy(*by_moment).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = own.withColumn("here", F.last("response", ignorenulls=True).over(within)).filter("kind = 'revisit'")
    # One row per URL and bucket with a record: its last response, carried to the next bucket.
    order = F.struct(F.col("at"), F.col("record_id"))
    closing = own.filter(usable).groupBy("canonical_url", "bucket").agg(F.max_by("response", F.when(F.col("response").isNotNull(), order)).alias("closing"))
    before = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = closing.select("canonical_url", "bucket", F.last("closing", ignorenulls=True).over(before).alias("carried"))
    found = seen.join(carried, ["canonical_url", "bucket"], "left")
    found = found.withColumn("source", F.when(usable, F.coalesce("here", "carried")))
    etags = F.col("etag").isNotNull() & F.col("source.etag").isNotNull()
    agrees = F.when(etags, F.col("etag") == F.col("source.etag")).otherwise(F.col("last_modified") == F.col("source.last_modified"))
    status = F.when(F.col("source").isNull(), "missing").when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("mismatch")
    found = found.withColumn("status", status)
    empty = F.create_map().cast("map<string,string>")
    old, new = F.coalesce("source.headers", empty), F.coalesce("headers", empty)
    update = F.map_filter(new, lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    resolved = F.col("status") == "resolved"
    return found.select(
        "record_id",
        "canonical_url",
        "status",
        F.when(resolved, F.col("source.record_id")).alias("response_id"),
        F.when(resolved, F.col("source.payload")).alias("payload"),
        F.when(resolved, merged).alias("headers"),
    )


def listed(headers: Column) -> Column:
    """Headers as ``name: value`` lines in the order of their names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """A crawl's records from pages, with several responses and revisits per URL; a page is first fetched at its number.

    Every third page changes 500 fetches later and is fetched in full again.  Each page is revisited by another spelling of its
    URL: 200 and 700 fetches after the first with the first one's etag, 800 after it with the second one's, 1000 after it with
    the then known etag, none (one page in seven), or that of a change that was not fetched (one in five).  One page in four
    was also revisited before any response.  With every page the crawler asks for one robots.txt, which is answered in
    full at every tenth page and changes every fifty; so that URL holds a seventh of all records.
    """
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    second = F.sha2(F.concat(F.coalesce("html", F.lit("")), F.lit(" again")), 256)
    length = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    number, page = F.col("page_id"), F.col("page_id").cast("string")
    modified = F.concat(F.lit("day "), F.floor(number / 100).cast("string"))
    spelling = F.concat(F.regexp_replace("url", "^https?://", "HTTP://www."), F.lit("#again"))
    robots = F.lit("http://crawled.example/robots.txt")
    version = F.sha2(F.concat(F.lit("robots "), F.floor(number / 50).cast("string")), 256)
    twice = number % 3 == 0

    def record(place: int, at: Column, kind: str, url: Column, etag: Column, payload: Column | None, when: Column | None = None) -> Column:
        date = F.concat(F.lit("fetch "), at.cast("string"))
        if payload is None:
            fields = [F.lit("date"), date, F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=60")]
        else:
            fields = [F.lit("content-length"), length, F.lit("content-type"), F.lit("text/html"), F.lit("date"), date, F.lit("etag"), etag]
        row = F.struct(
            (10 * number + place).alias("record_id"),
            url.alias("url"),
            at.alias("at"),
            F.lit(kind).alias("kind"),
            etag.alias("etag"),
            modified.alias("last_modified"),
            F.create_map(*fields).alias("headers"),
            (F.lit(None).cast("string") if payload is None else payload).alias("payload"),
        )
        return row if when is None else F.when(when, row)

    newest = F.when(twice, second).otherwise(digest)
    newest = F.when(number % 5 == 0, F.concat(newest, F.lit("-new"))).otherwise(newest)
    records = [
        record(0, number, "response", F.col("url"), digest, digest),
        record(1, number + 1000, "revisit", spelling, F.when(number % 7 != 0, newest), None),
        record(2, number - 300, "revisit", spelling, digest, None, number % 4 == 0),
        record(3, number + 200, "revisit", F.col("url"), digest, None),
        record(4, number + 500, "response", F.concat("url", F.lit("#")), second, second, twice),
        record(5, number + 700, "revisit", spelling, digest, None),
        record(6, number + 800, "revisit", F.col("url"), second, None),
        record(7, number, "response", robots, version, version, number % 10 == 0),
        record(8, number, "revisit", robots, version, None, number % 10 != 0),
    ]
    return pages.select(F.inline(F.filter(F.array(*records), lambda r: r.isNotNull())))
