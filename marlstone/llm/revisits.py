"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit record has no payload. It is joined, by canonical url, to the latest full
response captured strictly before it; the validators of both are compared, and the
headers of the revisit that a 304 may update replace those of the response.

The as-of join is one ordering of the slim records (no payloads): runs of the whole
order are worked on by themselves, and what earlier runs hold of a url comes from a
table of one row per url and run. A url with a third of all captures so spreads over
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import in_runs, join_safe

# Header fields that a 304 does not update (they describe one message or the stored payload).
NOT_UPDATED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
               "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
TRACKING = r"(?:utm_[^=&]*|ref|fbclid|gclid)"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters, order of parameters and a closing slash do not count.

    Null for a null url.
    """
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(bare, r"(?s)\?(.*)$", 1), "&")
    query = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(=|$)")))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(F.lit("")))


def _named(headers: Column) -> Column:
    """Header names in lower case; of names alike in that the last one by spelling counts."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: F.coalesce(~F.array_contains(F.slice(names, i + 2, F.size(names)), F.get(names, i)), F.lit(True)))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers with those fields of the revisit that it may update."""
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*NOT_UPDATED))
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: ``record_id, url_key, refers_to, refers_to_date, verdict, headers, digest``.

    ``records``: ``record_id, url, captured, is_revisit, etag, last_modified, digest,
    headers`` (map); other columns are ignored. ``verdict``: ``etag``, ``last_modified`` or
    ``digest`` name the first validator that both have, if it agrees; ``mismatch`` if it
    does not; ``unverified`` if they share none; ``none`` without an earlier response, as for
    a null url or time. Only a verified revisit gets merged headers and the digest of
    the response. Of responses at one time the one with the largest id is the latest;
    repeated revisits are repeated; an empty table gives no rows.
    """
    info = F.struct("record_id", "captured", "etag", "last_modified", "digest", _named(F.col("headers")).alias("headers"))
    full = ~F.coalesce(F.col("is_revisit"), F.lit(False))
    slim = records.select(canonical_url(F.col("url")).alias("url_key"), "captured", full.alias("is_full"), "record_id",
                          info.alias("info"))
    order = ["captured", "is_full", "record_id"]  # at one time revisits come first: a response there is not earlier
    runs = in_runs(slim, ["url_key"], order)
    usable = F.col("is_full") & F.col("url_key").isNotNull() & F.col("captured").isNotNull()
    place = F.when(usable, F.struct("captured", "record_id"))
    of_run = runs.groupBy("url_key", "_run").agg(F.max(place).alias("place"), F.max_by("info", place).alias("found"))
    past = Window.partitionBy("url_key").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    of_run = of_run.select("url_key", "_run", F.max_by("found", "place").over(past).alias("earlier"))
    inside = Window.partitionBy("_run", "url_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = runs.withColumn("near", F.max_by("info", place).over(inside)).where(~F.col("is_full"))
    met = join_safe(near, of_run, ["url_key", "_run"], "left").withColumn(
        "hit", F.when(F.col("captured").isNotNull(), F.coalesce("near", "earlier")))
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    verdict = F.when(F.col("hit").isNull(), "none")
    for name in ("etag", "last_modified", "digest"):
        a, b = F.col(f"info.{name}"), F.col(f"hit.{name}")
        same = (weak(a) == weak(b)) if name == "etag" else (a == b)
        verdict = verdict.when(a.isNotNull() & b.isNotNull(), F.when(same, name).otherwise("mismatch"))
    met = met.withColumn("verdict", verdict.otherwise("unverified"))
    sure = F.col("verdict").isin("etag", "last_modified", "digest")
    return met.select("record_id", "url_key", F.col("hit.record_id").alias("refers_to"),
                      F.col("hit.captured").alias("refers_to_date"), "verdict",
                      F.when(sure, merged_headers(F.col("hit.headers"), F.col("info.headers"))).alias("headers"),
                      F.when(sure, F.col("hit.digest")).alias("digest"))


def capture_log(pages: DataFrame) -> DataFrame:
    """Records of a crawl that made a capture per page, a minute apart, a third of them revisits.

    Everything derives from the page: the server's validator changes with every 997th
    page, so some revisits meet a response of another state.
    """
    key = canonical_url(F.regexp_replace("url", r"(?:\.html)?/?(?:[?#].*)?$", ""))
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.concat_ws(" ", key, F.expr("page_id div 997").cast("string"))), 1, 16), F.lit('"'))
    revisit = F.pmod(F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(3)) == 0
    date = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60)
    named = lambda **values: F.create_map(*[v for k, c in values.items() for v in (F.lit(k.replace("_", "-")), c)])
    fresh = named(Date=date.cast("string"), ETag=etag, Content_Length=F.lit("0"), Connection=F.lit("close"))
    stored = named(Date=date.cast("string"), ETag=etag, Content_Type=F.lit("text/html"),
                   Content_Length=F.octet_length("html").cast("string"), Server=F.concat(F.lit("s"), F.col("page_id") % 7))
    return pages.select(F.col("page_id").alias("record_id"), key.alias("url"), date.alias("captured"),
                        revisit.alias("is_revisit"), etag.alias("etag"), F.lit(None).cast("string").alias("last_modified"),
                        F.when(~revisit, F.md5("html")).alias("digest"), F.when(revisit, fresh).otherwise(stored).alias("headers"))
