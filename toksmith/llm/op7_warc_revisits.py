"""Resolution of "not modified" WARC revisits.

A revisit record has headers only; its body is that of the latest earlier full
response for the same canonical URL.  The as-of join runs over rows range-dealt
by (URL, time): each range carries its last response in a window, and a URL that
spans ranges passes the last one on through a table of one row per (URL, range),
so a hot URL or host is never one task's work.  Bodies do not move: a match is
the id and digest of the response.

A match counts only if its validators agree: the entity tags by weak comparison
where the revisit has one, else the Last-Modified dates; a payload digest in the
revisit must agree as well.  Headers merge as a cache updates a stored response:
the revisit's replace the stored ones, except hop-by-hop fields and those that
describe the stored body.

Defined cases: a revisit without URL or time is ``unresolvable``; none earlier:
``no_response``; neither validator: ``no_validator``; a difference:
``mismatch``; a response at the very time of the revisit is not earlier; of
several at one time the largest record id is the latest; repeated records give
repeated rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toksmith.session import cut_lineage

#: fixed values: fields of a 304 response that must not replace those of the stored one
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "keep-alive", "proxy-authenticate",
              "proxy-authentication-info", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
#: fixed values: query parameters that do not select content
TRACKING = r"utm_[a-z]+|ref|fbclid|gclid|sessionid|sid"

COLUMNS = "record_id", "kind", "url", "ts", "etag", "last_modified", "digest", "headers"


def canonical_url(url: Column) -> Column:
    """Scheme and a leading ``www.`` left out, host in lower case, default port, fragment, tracking
    parameters and trailing slashes removed, other parameters sorted.  Null for no host."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^:]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike(f"^({TRACKING})(=|$)"))), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def merge_headers(stored: Column, fresh: Column) -> Column:
    """Maps with lower-case names; a null map has no field."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    stored, fresh = F.coalesce(stored, none), F.coalesce(fresh, none)
    allowed = F.map_filter(fresh, lambda k, _: ~k.isin(*NOT_MERGED))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.map_contains_key(allowed, k)), allowed)


def resolve(records: DataFrame) -> DataFrame:
    """Rows ``COLUMNS`` (kind ``response`` or ``revisit``; headers: map with lower-case names) ->
    per revisit ``record_id, canonical, ts, status, refers_to, body_digest, headers``."""
    rows = records.select(*COLUMNS).withColumn("canonical", canonical_url(F.col("url")))
    late = (F.col("kind") == "response").cast("int")  # a response at the revisit's time sorts after it
    known = rows.where(F.col("canonical").isNotNull() & F.col("ts").isNotNull()).withColumn("late", late)
    order = ["ts", "late", "record_id"]
    full = F.when(F.col("late") == 1, F.struct("record_id", "etag", "last_modified", "digest", "headers"))
    # written once, so that the range of a row is the same for all readers
    dealt = cut_lineage(known.repartitionByRange("canonical", *order).withColumn("part", F.spark_partition_id()))
    own = Window.partitionBy("canonical", "part").orderBy(*order)
    carried = dealt.where("late = 1").groupBy("canonical", "part").agg(F.max_by(full, F.struct(*order)).alias("full"))
    parts = dealt.groupBy("canonical", "part").agg(F.count(F.lit(1)).alias("n")).join(carried, ["canonical", "part"], "left")
    before = F.last("full", ignorenulls=True).over(Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("canonical", "part", before.alias("before")).where(F.col("before").isNotNull())
    seen = dealt.withColumn("full", F.last(full, ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("late = 0")
    found = seen.join(parts, ["canonical", "part"], "left").withColumn("full", F.coalesce("full", "before"))
    lost = rows.where((F.col("canonical").isNull() | F.col("ts").isNull()) & (F.col("kind") == "revisit"))
    both = found.where("kind = 'revisit'").select(*rows.columns, "full").unionByName(lost, allowMissingColumns=True)
    at = F.col("full")
    same = F.when(F.col("etag").isNotNull(), F.coalesce(_weak(F.col("etag")) == _weak(at["etag"]), F.lit(False))).when(
        F.col("last_modified").isNotNull(), F.coalesce(F.col("last_modified") == at["last_modified"], F.lit(False)))
    same = same & (F.col("digest").isNull() | F.coalesce(F.col("digest") == at["digest"], F.lit(False)))
    status = F.when(F.col("canonical").isNull() | F.col("ts").isNull(), "unresolvable").when(at.isNull(), "no_response").when(
        F.col("etag").isNull() & F.col("last_modified").isNull(), "no_validator").when(same, "resolved").otherwise("mismatch")
    out = both.withColumn("status", status)
    hit = F.col("status") == "resolved"
    return out.select("record_id", "canonical", "ts", "status", F.when(hit, at["record_id"]).alias("refers_to"), F.when(hit, at["digest"]).alias("body_digest"),
                      F.when(hit, merge_headers(at["headers"], F.col("headers"))).alias("headers"))


def attach_body(resolved: DataFrame, responses: DataFrame, body: str) -> DataFrame:
    """Resolved revisits with the body of their response, by its id."""
    return resolved.join(responses.select(F.col("record_id").alias("refers_to"), body), "refers_to", "left")


# The tables hold no WARC records; these are derived from ``pages``, as pure functions of each row:
# a full response per page at minute ``page_id``, and for each a revisit ``GAP`` minutes later whose
# validator is the page's tag (id divisible by 3), its date (remainder 1) or a changed tag (2).
GAP = 1440


def page_records(pages: DataFrame) -> DataFrame:
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))
    date = F.concat(F.lit("day "), F.expr("page_id div 100").cast("string"))
    turn = F.col("page_id") % 3
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", (F.col("page_id") * 60).alias("ts"), tag.alias("etag"),
        date.alias("last_modified"), digest.alias("digest"),
        F.create_map(F.lit("content-length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("etag"), tag, F.lit("server"), F.lit("a")).alias("headers"))
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url",
        ((F.col("page_id") + GAP) * 60).alias("ts"), F.when(turn == 0, F.concat(F.lit("W/"), tag)).when(turn == 2, F.lit('"changed"')).alias("etag"),
        F.when(turn == 1, date).alias("last_modified"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("content-length"), F.lit("0"), F.lit("age"), F.col("page_id").cast("string"), F.lit("server"), F.lit("b")).alias("headers"))
    return full.unionByName(again)


def op7_warc_revisits(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    fields = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return resolve(page_records(pages)).select("record_id", "canonical", "ts", "status", "refers_to", "body_digest", F.array_join(fields, ";").alias("headers"))


ORACLE = f"""
WITH p AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS len,
    regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?]*@)?([^/?]*)', 1)), ':(80|443)$', ''), '^www\\.', '') AS host,
    regexp_replace(regexp_extract(u, '^[^:]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(lower(x), '^({TRACKING})(=|$)'))), '&') AS q FROM p),
k AS (
  SELECT page_id, digest, len, page_id // 100 AS day, '"' || substr(digest, 1, 12) || '"' AS tag,
    CASE WHEN host <> '' THEN host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical FROM c),
j AS (
  SELECT v.page_id AS id, v.canonical, v.day, v.tag, r.page_id AS rid, r.tag AS rtag, r.day AS rday, r.digest AS rdigest, r.len AS rlen
  FROM k v ASOF LEFT JOIN k r ON v.canonical = r.canonical AND v.page_id + {GAP} > r.page_id),
s AS (
  SELECT *, CASE WHEN canonical IS NULL OR id IS NULL THEN 'unresolvable' WHEN rid IS NULL THEN 'no_response'
    WHEN id % 3 = 0 AND tag = rtag OR id % 3 = 1 AND day = rday THEN 'resolved' ELSE 'mismatch' END AS status FROM j)
SELECT id * 2 + 1 AS record_id, canonical, (id + {GAP}) * 60 AS ts, status,
  CASE WHEN status = 'resolved' THEN rid * 2 END AS refers_to, CASE WHEN status = 'resolved' THEN rdigest END AS body_digest,
  CASE WHEN status = 'resolved' THEN 'age=' || id || ';content-length=' || rlen || ';etag=' || rtag || ';server=b' END AS headers
FROM s
"""
