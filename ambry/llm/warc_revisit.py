"""Resolving "not modified" revisit records of a web archive.

Each revisit (a 304 answer) is joined as of its time with the latest strictly
earlier full response for the same canonical URL.  Its validators are checked
against that response's (entity tags compare weakly; without them on both sides,
Last-Modified), and where they hold, the response's headers are updated with
those that a 304 answer may bring.

Records: record_id string, uri string, ts long (seconds), type string, status
int, headers map<string, string> (lower-case names), digest string, length long.
A full response has type ``response`` and status 200.

The as-of join works in time buckets of a URL: inside a bucket the last response
is carried along, and only each bucket's last response is carried on to the
URL's later buckets, so one URL's records need not meet in one task.

Defined cases: a revisit without URL is ``no_url``, without earlier response
``no_response``, without comparable validators ``unvalidated`` (its headers are
not merged); of responses at the same second the largest record_id is the
latest; a null ts is before every other; repeated rows are resolved each; an
empty table gives an empty result; other columns of the records are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a 304 answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that don't name another page.
TRACKING = ("ref", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")
#: Seconds of a time bucket.
BUCKET_SECONDS = 86_400


def canonical_url(uri: Column) -> Column:
    """Without scheme, fragment, "www.", default port, tracking parameters and last "/"; host in
    lower case; parameters in order.  Null and empty stay null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(uri), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.split(p, "=")[0].isin(*TRACKING)))
    url = F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))
    return F.when(url != "", url)


def latest_response(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Each revisit of ``records`` (with url) and ``found``: the latest earlier full response."""
    full = (F.col("type") == "response") & (F.col("status") == 200)
    r = (records.where(F.col("url").isNotNull() & (full | (F.col("type") == "revisit")))
         .withColumn("_ts", F.coalesce("ts", F.lit(-(1 << 62))))
         .withColumn("_bucket", F.floor(F.col("_ts") / bucket_seconds))
         .withColumn("_response", F.when(full, F.struct(F.col("_ts").alias("ts"), "record_id", "headers", "digest", "length")))
         .withColumn("_after", F.when(full, 1).otherwise(0)))  # a response is no earlier than a revisit at its second
    inside = Window.partitionBy("url", "_bucket").orderBy("_ts", "_after", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    own = r.withColumn("_own", F.last("_response", ignorenulls=True).over(inside)).where("_after = 0")
    ends = r.groupBy(F.col("url").alias("_u"), F.col("_bucket").alias("_b")).agg(
        F.max_by("_response", F.when(full, F.struct("_ts", "record_id"))).alias("_end"))
    before = Window.partitionBy("_u").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).select("_u", "_b", "_carried")
    return (own.join(ends, (F.col("url") == F.col("_u")) & (F.col("_bucket") == F.col("_b")), "left")
            .withColumn("found", F.coalesce("_own", "_carried"))
            .drop("_ts", "_bucket", "_response", "_after", "_own", "_u", "_b", "_carried"))


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit: record_id, url, ts, outcome, response_id, response_ts, digest, length
    (of the response's payload) and headers (merged, where the outcome is ``resolved``)."""
    cols = ["record_id", "ts", "type", "status", "headers", "digest", "length"]
    r = records.select(*cols, canonical_url(F.col("uri")).alias("url"))
    joined = latest_response(r, bucket_seconds)
    missing = r.where(F.col("url").isNull() & (F.col("type") == "revisit"))
    joined = joined.unionByName(missing, allowMissingColumns=True)
    tag = lambda h: F.regexp_replace(F.trim(h["etag"]), "^W/", "")
    sent, stored = F.coalesce("headers", F.create_map().cast("map<string,string>")), F.col("found.headers")
    modified = lambda h: h["last-modified"]
    outcome = (F.when(F.col("url").isNull(), "no_url").when(F.col("found").isNull(), "no_response")
               .when(tag(sent).isNotNull() & tag(stored).isNotNull(), F.when(tag(sent) == tag(stored), "resolved").otherwise("etag_mismatch"))
               .when(modified(sent).isNotNull() & modified(stored).isNotNull(), F.when(modified(sent) == modified(stored), "resolved").otherwise("modified"))
               .otherwise("unvalidated"))
    new = F.map_filter(sent, lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(new), k)), new)
    return joined.select("record_id", "url", "ts", outcome.alias("outcome"), F.col("found.record_id").alias("response_id"),
                         F.col("found.ts").alias("response_ts"), F.col("found.digest").alias("digest"), F.col("found.length").alias("length"),
                         F.when(outcome == "resolved", merged).alias("headers"))


def records_of(pages: DataFrame) -> DataFrame:
    """Crawl records derived from ``pages``, four rounds for each page: a full response (missing for
    some), a revisit, a changed response or another revisit, and a last revisit; with entity tags,
    weak ones, none, or ones that don't match, by page_id."""
    p = F.coalesce("page_id", F.lit(0))
    md5 = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    base = pages.select(p.alias("p"), F.col("url").alias("uri"), md5.alias("md5"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("size"))
    r = base.withColumn("k", F.explode(F.array(*map(F.lit, range(4)))))
    k, p = F.col("k"), F.col("p")
    again = (k == 2) & (p % 2 == 0)
    response = (k == 0) | again
    # the version a record speaks of: round 2 brings a new one on even pages, of which the last revisit of every fourth page doesn't know
    version = F.when(again | ((k == 3) & (p % 2 == 0) & (p % 4 != 0)), 2).otherwise(0)
    ts = p * 60 + k * 50_000
    tag = F.concat(F.when((p % 3 == 1) & (k > 0), "W/").otherwise(""), F.lit('"'), F.substring("md5", 1, 12), version.cast("string"),
                   F.when((p % 7 == 3) & (k == 1), "x").otherwise(""), F.lit('"'))
    named = {"etag": F.when(p % 5 != 0, tag),
             "last-modified": F.when(p % 10 != 0, F.concat(F.lit("t"), (p * 60 - 1000 + version).cast("string"))),
             "cache-control": F.concat(F.lit("max-age="), (k * 100 + 60).cast("string")),
             "date": F.concat(F.lit("t"), ts.cast("string")),
             "content-type": F.when(response, "text/html").otherwise("text/plain"),
             "content-length": F.when(response, F.col("size")).otherwise(0).cast("string")}
    headers = F.map_filter(F.create_map(*[x for name, value in named.items() for x in (F.lit(name), value)]), lambda _, v: v.isNotNull())
    return (r.where((k > 0) | (p % 11 != 0))
            .select(F.concat(p.cast("string"), F.lit("-"), k.cast("string")).alias("record_id"), "uri", ts.cast("long").alias("ts"),
                    F.when(response, "response").otherwise("revisit").alias("type"), F.when(response, 200).otherwise(304).alias("status"),
                    headers.alias("headers"), F.when(response, F.concat(F.lit("md5:"), F.col("md5"))).alias("digest"),
                    F.when(response, F.col("size")).otherwise(0).alias("length")))


def revisit_report(pages: DataFrame) -> DataFrame:
    """Every revisit that the pages' records hold, resolved; headers as one text."""
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolve_revisits(records_of(pages)).withColumn("headers", F.array_join(lines, "\n"))


#: The same rows in DuckDB's SQL, by its as-of join.
SQL = r"""
WITH b AS (
  SELECT coalesce(page_id, 0) AS p, url AS uri, md5(coalesce(html, '')) AS md5, strlen(coalesce(html, '')) AS size,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
u AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
            || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
         list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT string_split(x, '=')[1] IN
             ('ref', 'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content'))) AS params FROM b),
r AS (
  SELECT *, nullif(place || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END, '') AS url,
         p * 60 + k * 50000 AS ts, k = 0 OR (k = 2 AND p % 2 = 0) AS response,
         CASE WHEN p % 2 = 0 AND (k = 2 OR (k = 3 AND p % 4 <> 0)) THEN 2 ELSE 0 END AS version
  FROM u, (SELECT unnest([0, 1, 2, 3]) AS k) WHERE k > 0 OR p % 11 <> 0),
h AS (
  SELECT *, p || '-' || k AS id,
         CASE WHEN p % 5 <> 0 THEN CASE WHEN p % 3 = 1 AND k > 0 THEN 'W/' ELSE '' END || '"' || md5[1:12] || version
              || CASE WHEN p % 7 = 3 AND k = 1 THEN 'x' ELSE '' END || '"' END AS etag,
         CASE WHEN p % 10 <> 0 THEN 't' || (p * 60 - 1000 + version) END AS modified,
         'max-age=' || (k * 100 + 60) AS cc, 't' || ts AS date_ FROM r),
latest AS (SELECT url, ts, max_by(h, id) AS o FROM h WHERE response GROUP BY url, ts),
j AS (SELECT h.*, l.o FROM (SELECT * FROM h WHERE NOT response) h ASOF LEFT JOIN latest l ON h.url = l.url AND h.ts > l.ts),
c AS (SELECT *, CASE WHEN url IS NULL THEN 'no_url' WHEN o IS NULL THEN 'no_response'
         WHEN etag IS NOT NULL AND o.etag IS NOT NULL THEN
           CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(o.etag, '^W/', '') THEN 'resolved' ELSE 'etag_mismatch' END
         WHEN modified IS NOT NULL AND o.modified IS NOT NULL THEN CASE WHEN modified = o.modified THEN 'resolved' ELSE 'modified' END
         ELSE 'unvalidated' END AS outcome FROM j)
SELECT id AS record_id, url, ts, outcome, o.id AS response_id, o.ts AS response_ts,
       CASE WHEN o IS NOT NULL THEN 'md5:' || o.md5 END AS digest, o.size AS length,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: ' || cc || chr(10) || 'content-length: ' || o.size || chr(10)
         || 'content-type: text/html' || chr(10) || 'date: ' || date_ || chr(10)
         || CASE WHEN coalesce(etag, o.etag) IS NULL THEN 'last-modified: ' || o.modified
                 ELSE 'etag: ' || coalesce(etag, o.etag) || coalesce(chr(10) || 'last-modified: ' || o.modified, '') END END AS headers
FROM c
"""
