"""Resolving "not modified" revisits of a web archive.

A revisit record says that a page was as before and carries no body. It is resolved by an as-of join:
the latest earlier full response of the same canonical URL. The validators of both are compared, and
the headers that a 304 response may update are merged into those of the full response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_ranges, query, read

# Header fields that RFC 9110, section 15.4.5, has a 304 response send, and Last-Modified. Fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that only track visitors.
TRACKING = r"^(utm_[^=]*|gclid|fbclid|msclkid)(=|$)"
_ORDER = ("ts", "record_id", "__is_full", "__tie")
RECORD = ("record_id", "url", "ts", "status", "headers")


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path without a slash at its end, sorted query without tracking.

    The scheme is left out, so http and https meet, as is the fragment. A null url stays null; a text
    that is no URL is kept, in lower case.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    parts = r"^(?i:https?)://([^/?]*)([^?]*)\??(.*)$"
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, parts, 1)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, parts, 2), "/+$", "")
    pairs = F.filter(
        F.split(F.regexp_extract(bare, parts, 3), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)
    )
    search = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(F.sort_array(pairs), "&"))).otherwise("")
    return F.when(bare.rlike(r"^(?i:https?)://"), F.concat(host, path, search)).otherwise(F.lower(bare))


def _etag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def latest_before(rows: DataFrame, key: str, order: tuple[str, ...], value: str) -> DataFrame:
    """Add ``latest``: the last non-null ``value`` of an earlier row of the same key.

    Rows are cut into ranges of (key, order), so a key of any size spans many ranges. Each range is
    scanned by itself, and what a key brings along from earlier ranges is a scan over one row per key
    and range.
    """
    parts = in_ranges(rows, key, *order)
    inside = Window.partitionBy(key, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ends = parts.groupBy(key, "part").agg(
        F.max_by(value, F.struct(*[F.when(F.col(value).isNotNull(), F.col(c)).alias(c) for c in order])).alias("__end")
    )
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__carried", F.last("__end", ignorenulls=True).over(earlier)).drop("__end")
    return (
        parts.withColumn("__own", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [key, "part"])
        .withColumn("latest", F.coalesce("__own", "__carried"))
        .drop("__own", "__carried", "part")
    )


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url, ts, target_id, target_ts, outcome, headers.

    ``records`` has record_id, url, ts, status (200 for a full response, 304 for a revisit) and headers (a
    map with names in any case); other columns and other statuses are ignored. Of header names that differ
    in case alone, the one that sorts first counts. ``outcome`` is

    * ``resolved``: the ETag (compared weakly) agrees or, where the revisit has none, Last-Modified does;
    * ``unchecked``: the revisit has no validator, so the latest earlier response is taken as it is;
    * ``mismatch``: a validator differs or the response has none; no headers are merged;
    * ``missing``: no earlier full response, or a null url or time.

    Responses of equal time are ordered by record id, and a response is earlier than a revisit only if
    its (time, id) is smaller; of responses with equal time and id, one is taken by a hash of its headers.
    A null id is the smallest. Repeated rows give repeated results; an empty table gives none.
    """
    entries = F.array_sort(F.map_entries(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>"))))
    named = F.transform(entries, lambda e: F.struct(F.lower(e.key).alias("key"), e.value.alias("value")))
    names = F.transform(F.col("__named"), lambda e: e.key)
    firsts = F.filter(F.col("__named"), lambda e, i: F.array_position(F.col("__names"), e.key) == i + 1)
    rows = (
        records.filter(F.col("status").isin(200, 304))
        .select(*RECORD[:4], named.alias("__named"), canonical_url(F.col("url")).alias("__key"))
        .withColumn("__names", names)
        .withColumn("__firsts", firsts)
        .select(
            *RECORD[:4],
            F.map_from_entries("__firsts").alias("headers"),
            "__key",
            (F.col("status") == 200).cast("int").alias("__is_full"),
            F.xxhash64("__firsts").alias("__tie"),
        )
    )
    whole = F.col("__key").isNotNull() & F.col("ts").isNotNull()
    full = F.when(
        F.col("status") == 200, F.struct(F.col("record_id").alias("id"), F.col("ts").alias("ts"), F.col("headers"))
    )
    joined = latest_before(rows.filter(whole).withColumn("__full", full), "__key", _ORDER, "__full")
    lost = rows.filter(~whole).select("*", F.lit(None).cast(joined.schema["latest"].dataType).alias("latest"))
    found = joined.drop("__full").unionByName(lost).filter("status = 304")
    sent, kept = F.col("headers"), F.col("latest.headers")
    same_tag = F.coalesce(_etag(sent) == _etag(kept), F.lit(False))
    same_time = F.coalesce(sent["last-modified"] == kept["last-modified"], F.lit(False))
    outcome = (
        F.when(F.col("latest").isNull(), "missing")
        .when(sent["etag"].isNotNull(), F.when(same_tag, "resolved").otherwise("mismatch"))
        .when(sent["last-modified"].isNotNull(), F.when(same_time, "resolved").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    updates = F.map_filter(sent, lambda name, value: name.isin(*PERMITTED) & value.isNotNull())
    merged = F.map_concat(F.map_filter(kept, lambda name, _: ~F.array_contains(F.map_keys(updates), name)), updates)
    good = F.col("outcome").isin("resolved", "unchecked")
    return found.withColumn("outcome", outcome).select(
        "record_id",
        "url",
        "ts",
        F.col("latest.id").alias("target_id"),
        F.col("latest.ts").alias("target_ts"),
        "outcome",
        F.when(good, merged).alias("headers"),
    )


def crawl_log(pages: DataFrame) -> DataFrame:
    """Records of two visits of each page: a full response, and a revisit of another spelling of its URL.

    The page table has one visit per page, so the second is derived: every fifth page has changed since
    (its ETag differs), and every seventh was asked for before the response was there.
    """
    n = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    response = pages.select(
        (2 * n).alias("record_id"),
        "url",
        (10 * n).alias("ts"),
        F.lit(200).alias("status"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), size, F.lit("ETag"), tag,
            F.lit("Date"), (10 * n).cast("string"),
        ).alias("headers"),
    )
    late = F.when(n % 7 == 6, 10 * n - 5).otherwise(10 * n + 100_003)
    revisit = pages.select(
        (2 * n + 1).alias("record_id"),
        F.concat(F.upper(F.regexp_extract("url", "^https?", 0)), F.regexp_replace("url", "^https?|#.*$", ""), F.lit("#again")).alias("url"),
        late.alias("ts"),
        F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), F.when(n % 5 == 4, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag)),
            F.lit("date"), late.cast("string"), F.lit("content-length"), F.lit("0"), F.lit("vary"), F.lit("accept"),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


_SQL = r"""
WITH base AS (
  SELECT page_id, md5(coalesce(html, '')) AS tag, strlen(coalesce(html, '')) AS size,
    regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
keyed AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '^https?://([^/?]*)', 1)), ':(80|443)$', '')
    || regexp_replace(regexp_extract(u, '^https?://[^/?]*([^?]*)', 1), '/+$', '')
    || (CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END) AS k
  FROM (SELECT *, list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|gclid|fbclid|msclkid)(=|$)')) AS q FROM base)),
visits AS (
  SELECT page_id, k, tag, 2 * page_id + 1 AS record_id, page_id % 5 = 4 AS changed,
    CASE WHEN page_id % 7 = 6 THEN 10 * page_id - 5 ELSE 10 * page_id + 100003 END AS ts FROM keyed),
found AS (
  SELECT v.page_id, v.tag, v.ts, v.changed, r.page_id AS target, r.tag AS target_tag, r.size,
    row_number() OVER (PARTITION BY v.page_id ORDER BY 10 * r.page_id DESC NULLS LAST, 2 * r.page_id DESC) AS n
  FROM visits v LEFT JOIN keyed r
    ON r.k = v.k AND (10 * r.page_id < v.ts OR 10 * r.page_id = v.ts AND 2 * r.page_id < v.record_id))
SELECT page_id, target AS target_page_id,
  CASE WHEN target IS NULL THEN 'missing' WHEN changed OR tag <> target_tag THEN 'mismatch' ELSE 'resolved' END AS outcome,
  CASE WHEN target IS NOT NULL AND NOT changed AND tag = target_tag THEN
    'content-length=' || size || '&content-type=text/html&date=' || ts || '&etag=W/"' || tag || '"&vary=accept' END AS headers
FROM found WHERE n = 1"""


@query("op5_warc_revisits", _SQL)
def op5_warc_revisits(spark, sf):
    resolved = resolve(crawl_log(read(spark, sf, "pages")))
    named = F.transform(F.map_entries("headers"), lambda e: F.concat(e.key, F.lit("="), e.value))
    half = lambda c: F.floor(F.col(c) / 2).cast("long")  # noqa: E731  record ids are twice the page's, plus one for a revisit
    return resolved.select(
        half("record_id").alias("page_id"),
        half("target_id").alias("target_page_id"),
        "outcome",
        F.array_join(F.sort_array(named), "&").alias("headers"),
    )
