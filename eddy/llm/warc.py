"""Operator 5: resolving WARC "not modified" revisits.

A revisit record (a 304 answer) has no payload.  It is resolved by an as-of
join: the latest earlier full response of the same canonical URL is looked
up, its validators are checked against the revisit's, and its payload and
headers are taken over, with the headers that a 304 may update replaced.

The as-of join is split for hot URLs: time is cut at quantiles, each (URL,
piece of time) looks within itself, and gets the last response of the URL's
earlier pieces from a table with one row for each (URL, piece).  Only ids,
times and validators take part; payloads are joined afterwards by record id.

Records: ``rid`` (unique), ``kind`` ('response' or 'revisit'), ``url``,
``time``, ``headers`` (map, lower-case names), ``payload``.

Results: ``resolved``, or ``no_earlier`` (no earlier full response),
``mismatch`` (validators differ), ``no_validator`` (the revisit names none,
or none that the response has).

Defined cases: a null URL or time is never resolved (``no_earlier``) and
resolves nothing; responses of the same time are not earlier; of several
responses at one time the one with the largest ``rid`` counts; header maps
may be null; repeated rows get equal answers, and records of one ``rid`` count
as one; a revisit without ``rid`` is listed without headers; other columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_CUTS = 1_000
ROWS_A_PIECE = 200_000

# Headers of a stored response that a 304 may update
# (RFC 9110, section 15.4.5), and query parameters that only track visits.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment,
    trailing slash and tracking parameters; parameters sorted."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^[^/?]*", 0)), r":(80|443)$", ""),
                            r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"),
                                  lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _strong(tag: Column) -> Column:
    """An entity tag without its weakness mark."""
    return F.regexp_replace(tag, r"^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """``(rid, url_key, time, ref, status)`` for every revisit; ``ref`` is the
    response's ``rid`` (null unless resolved)."""
    events = records.select("rid", "kind", canonical_url(F.col("url")).alias("url_key"), "time",
                            F.col("headers")["etag"].alias("etag"), F.col("headers")["last-modified"].alias("modified"))
    n = events.count()
    pieces = max(1, min(MAX_CUTS, -(-n // ROWS_A_PIECE)))
    shares = [i / pieces for i in range(1, pieces)]
    cuts = sorted(set(events.agg(F.percentile_approx("time", shares, 20 * pieces).alias("c")).first().c or [])) \
        if shares else []
    piece = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("time"))) if cuts else F.lit(0)
    stored = F.when((F.col("kind") == "response") & F.col("time").isNotNull(),
                    F.struct("time", "rid", "etag", "modified"))
    usable = events.where("url_key IS NOT NULL AND time IS NOT NULL").withColumn("piece", piece).withColumn("last", stored)

    # The last response of earlier pieces: at most MAX_CUTS rows for a URL.
    ends = usable.groupBy("url_key", "piece").agg(F.max("last").alias("last"))
    before = Window.partitionBy("url_key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("url_key", "piece", F.max("last").over(before).alias("carried"))

    within = Window.partitionBy("url_key", "piece").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    found = (usable.withColumn("near", F.max("last").over(within)).where("kind = 'revisit'")
             .join(carry, ["url_key", "piece"]).withColumn("hit", F.coalesce("near", "carried")))
    hit, etag, modified = F.col("hit"), F.col("etag"), F.col("modified")
    by_tag = _strong(etag) == _strong(hit["etag"])
    status = (F.when(hit.isNull(), "no_earlier")
              .when(by_tag.isNotNull(), F.when(by_tag, "resolved").otherwise("mismatch"))
              .when((modified == hit["modified"]).isNotNull(),
                    F.when(modified == hit["modified"], "resolved").otherwise("mismatch"))
              .otherwise("no_validator"))
    out = found.select("rid", "url_key", "time", status.alias("status"), hit["rid"].alias("ref"))
    lost = (events.where("kind = 'revisit' AND (url_key IS NULL OR time IS NULL)")
            .select("rid", "url_key", "time", F.lit("no_earlier").alias("status"), F.lit(None).cast("long").alias("ref")))
    return out.unionByName(lost).select(
        "rid", "url_key", "time", F.when(F.col("status") == "resolved", F.col("ref")).alias("ref"), "status")


def merged_headers(stored: Column, update: Column) -> Column:
    """``stored`` with the permitted headers of ``update`` in place."""
    update = F.map_filter(F.coalesce(update, F.create_map().cast("map<string,string>")),
                          lambda k, _: k.isin(PERMITTED))
    stored = F.coalesce(stored, F.create_map().cast("map<string,string>"))
    kept = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(update), k))
    return F.map_concat(kept, update)


def restore(records: DataFrame, resolution: DataFrame, payload: Column | None = None) -> DataFrame:
    """``resolution`` with ``headers`` and ``payload`` of the resolved record
    (null unless resolved); ``payload`` may be an expression on the records,
    such as a digest, so that less is moved."""
    payload = F.col("payload") if payload is None else payload
    full = records.where("kind = 'response'").select(
        F.col("rid").alias("ref"), F.col("headers").alias("stored"), payload.alias("payload")).dropDuplicates(["ref"])
    own = records.where("kind = 'revisit'").select("rid", F.col("headers").alias("update")).dropDuplicates(["rid"])
    # Rows without a reference are spread by a key of their own; what it may
    # meet by chance is not taken.
    at = F.coalesce("ref", -F.abs(F.xxhash64("rid", "time"))).alias("at")
    found = F.col("ref").isNotNull()
    return (resolution.join(own, "rid", "left").select("*", at)
            .join(full.withColumnRenamed("ref", "at"), "at", "left")
            .select("rid", "url_key", "time", "ref", "status",
                    F.when(found, merged_headers(F.col("stored"), F.col("update"))).alias("headers"),
                    F.when(found, F.col("payload")).alias("payload")))


def records_of(pages: DataFrame) -> DataFrame:
    """Capture records derived from ``pages``: a full response of each page,
    a revisit some time later by another form of its URL, one with the
    validator of its text's first half only (out of date), and one from
    before the page was first fetched."""
    tag = lambda c: F.concat(F.lit('"'), F.substring(F.sha2(c, 256), 1, 20), F.lit('"'))
    html = F.coalesce("html", F.lit(""))
    day = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    head = lambda etag, when: F.create_map(
        F.lit("etag"), etag, F.lit("date"), when, F.lit("content-length"), F.octet_length(html).cast("string"),
        F.lit("content-type"), F.lit("text/html"), F.lit("last-modified"), day)
    light = lambda etag, when: F.create_map(
        F.lit("etag"), etag, F.lit("date"), when, F.lit("cache-control"), F.lit("max-age=600"),
        F.lit("content-length"), F.lit("0"))
    row = lambda i, kind, url, time, headers, body: F.struct(
        (F.col("page_id") * 4 + i).alias("rid"), F.lit(kind).alias("kind"), url.alias("url"), time.alias("time"),
        headers.alias("headers"), body.alias("payload"))
    at, none = F.col("page_id") * 10, F.lit(None).cast("string")
    when = lambda x: (at + x).cast("string")
    half = F.substring(html, F.lit(1), F.floor(F.length(html) / 2).cast("int"))
    made = F.array(
        row(0, "response", F.col("url"), at, head(tag(html), when(0)), html),
        row(1, "revisit", F.concat(F.regexp_replace("url", "#.*", ""), F.lit("#again")), at + 4005,
            light(F.concat(F.lit("W/"), tag(html)), when(4005)), none),
        row(2, "revisit", F.col("url"), at + 7, light(tag(half), when(7)), none),
        row(3, "revisit", F.col("url"), at - 3, light(tag(html), when(-3)), none))
    return pages.select(F.explode(made).alias("r")).select("r.*")
