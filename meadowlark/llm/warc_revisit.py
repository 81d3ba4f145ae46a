"""WARC: not-modified revisit resolution.

A revisit record says that a fetch brought "304 Not Modified". It is resolved by an as-of join on the
canonical URL: to the latest full response strictly before it. The validators (entity tag, else last
modification) must agree; the response's headers are then updated by those of the revisit's that a 304
may carry.

The join is made of two windows, so that a URL with any share of the rows doesn't land in one task:
within (URL, slice of time) rows are matched in order of time, and for what is left the slices' latest
responses are matched in order of slices, a row a slice. Slices are cut at quantiles of the rows' times,
so that outliers don't matter and even a URL with all rows has about ``ROWS`` of them in a slice. Only ids,
times and validators pass through the windows; headers are joined once the match is known.

Nulls: without a URL, a time or an earlier response a revisit has the outcome ``unresolved``; a response
without an id or a time can't be a target. A validator that the revisit lacks isn't checked; with
neither it is ``unvalidated``. Of responses with equal times the largest id counts; of records
that share an id the headers that sort first; repeated rows give repeated results; an empty table gives an
empty one. Only the named columns are read. Very long URLs and headers pass through like any others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meadowlark.llm.common import staged

#: Slices of time: as many as have so many rows each, but at least and at most so many.
ROWS, SLICES, MOST = 500_000, 512, 1 << 14
#: The fields that a 304 carries for the cache (RFC 9110, 15.4.5, and Last-Modified).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
_TRACKING = r"^(utm_[a-z]+|gclid|fbclid)(=|$)"


def canonical(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment and final slash; query fields
    sorted, without those for tracking; the host in lower case."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r"^www[0-9]*\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    fields = F.filter(F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda x: (x != "") & ~x.rlike(_TRACKING))
    query = F.array_join(F.array_sort(fields), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def permitted(headers: Column) -> Column:
    lower = F.transform_keys(headers, lambda k, _: F.lower(k))
    return F.map_filter(lower, lambda k, _: k.isin(*PERMITTED))


def quantiles(rows: DataFrame) -> list[int]:
    """Times that cut the rows into slices of about equal size: a number a slice."""
    n = min(max(SLICES, rows.count() // ROWS), MOST)
    found = rows.agg(F.percentile_approx("at", [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else []
    return sorted(set(found or []))


def slice_of(at: Column, bounds: list[int]) -> Column:
    """How many of the bounds are at most ``at``, by halving."""
    if not bounds:
        return F.lit(0)
    size = 1 << len(bounds).bit_length()
    steps = F.array(*[F.lit(size >> i) for i in range(1, size.bit_length())])
    padded = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    return F.aggregate(steps, F.lit(0), lambda i, step: F.when(at >= F.get(padded, i + step - 1), i + step).otherwise(i))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, ``canonical_url``, ``target_id`` (the response), ``outcome``
    (resolved, mismatch, unvalidated, unresolved) and ``headers`` (merged if resolved, else the revisit's
    own). ``records`` has record_id, type (response or revisit), url, ts, etag, last_modified, headers."""
    rows = records.select("record_id", "type", canonical(F.col("url")).alias("canonical_url"), F.unix_micros("ts").alias("at"), "etag", "last_modified")
    known = F.col("canonical_url").isNotNull() & F.col("at").isNotNull()
    full = F.when((F.col("type") == "response") & F.col("record_id").isNotNull(), F.struct("at", "record_id", "etag", "last_modified"))
    cut = rows.where(known).withColumn("slice", slice_of(F.col("at"), quantiles(rows.where(known)))).withColumn("full", full)
    cut = staged(cut, "captures")

    before = Window.partitionBy("canonical_url", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    within = cut.withColumn("near", F.max("full").over(before)).where("type = 'revisit'").drop("full")
    latest = cut.groupBy("canonical_url", "slice").agg(F.max("full").alias("full"))
    earlier = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("canonical_url", "slice", F.max("full").over(earlier).alias("carried"))
    matched = within.join(carried, ["canonical_url", "slice"], "left").withColumn("target", F.coalesce("near", "carried")).drop("near", "carried", "slice")
    missed = rows.where(~known & (F.col("type") == "revisit")).withColumn("target", F.lit(None).cast(matched.schema["target"].dataType))
    matched = matched.unionByName(missed)

    weak = lambda tag: F.regexp_replace(tag, "^W/", "")
    outcome = (
        F.when(F.col("target").isNull(), "unresolved")
        .when(F.col("etag").isNotNull(), F.when(weak(F.col("etag")).eqNullSafe(weak(F.col("target.etag"))), "resolved").otherwise("mismatch"))
        .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified").eqNullSafe(F.col("target.last_modified")), "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    found = matched.select("record_id", "canonical_url", F.col("target.record_id").alias("target_id"), outcome.alias("outcome"))
    order = F.to_json(F.array_sort(F.map_entries("headers")))
    kept = lambda kind, name: records.where(F.col("type") == kind).groupBy(F.col("record_id").alias(f"{name}_id")).agg(F.min_by("headers", order).alias(name))
    joined = found.join(kept("revisit", "own"), F.col("record_id").eqNullSafe(F.col("own_id")), "left")
    # only resolved rows look up their response: the others' missing ids would all meet in one task
    old = kept("response", "old").where("old_id is not null")
    resolved = joined.where("outcome = 'resolved'").join(old, F.col("target_id") == F.col("old_id"), "left").drop("old_id")
    joined = resolved.unionByName(joined.where("outcome <> 'resolved'"), allowMissingColumns=True)
    news = permitted(F.coalesce("own", F.create_map().cast("map<string,string>")))
    base = F.transform_keys(F.coalesce("old", F.create_map().cast("map<string,string>")), lambda k, _: F.lower(k))
    merged = F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(news), k)), news)
    return joined.select("record_id", "canonical_url", "target_id", "outcome", F.when(F.col("outcome") == "resolved", merged).otherwise(F.col("own")).alias("headers"))


# ---- captures derived from the table of pages --------------------------------------------------


def captures(pages: DataFrame) -> DataFrame:
    """Two records for each page: a full response, and a revisit some hours later or (every eleventh)
    earlier, by another spelling of the URL; every seventh revisit has an entity tag of its own."""
    base = F.lit(1_700_000_000)
    stamp = lambda s: F.timestamp_seconds(s)
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    n = F.col("page_id")
    first = base + n * 60
    full = pages.select(
        (n * 2).alias("record_id"),
        F.lit("response").alias("type"),
        "url",
        stamp(first).alias("ts"),
        tag.alias("etag"),
        (first - 86400).cast("string").alias("last_modified"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag, F.lit("Date"), first.cast("string"), F.lit("Server"), F.lit("a")).alias("headers"),
    )
    again = first + F.when(n % 11 == 0, -7200).otherwise(3600 * (1 + n % 5))
    other = F.when(n % 7 == 0, F.lit('"other"')).when(n % 3 == 0, F.concat(F.lit("W/"), tag)).when(n % 5 != 0, tag)
    modified = F.when(n % 10 != 0, (first - 86400).cast("string"))
    spelled = F.concat(F.regexp_replace("url", r"#.*$", ""), F.lit("#again"))
    revisit = pages.select(
        (n * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("type"),
        spelled.alias("url"),
        stamp(again).alias("ts"),
        other.alias("etag"),
        modified.alias("last_modified"),
        F.create_map(F.lit("Date"), again.cast("string"), F.lit("Server"), F.lit("b"), F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
    )
    return full.unionByName(revisit)


def revisit_digest(pages: DataFrame) -> DataFrame:
    """The query's rows: every revisit, its target and its headers as sorted lines."""
    found = resolve_revisits(staged(captures(pages.select("page_id", "url", "html")), "records"))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda x: F.concat(F.lower(x["key"]), F.lit("="), F.coalesce(x["value"], F.lit(""))))), ";")
    return found.select("record_id", "canonical_url", "target_id", "outcome", lines.alias("headers"))


ORACLE = r"""
WITH c AS (
  SELECT page_id, html, url, '"' || md5(coalesce(html, '')) || '"' AS tag, 1700000000 + page_id * 60 AS first,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages),
k AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www[0-9]*\.', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid)(=|$)'))), '&') AS query
  FROM c),
u AS (SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS canon FROM k),
full_r AS (SELECT page_id * 2 AS id, canon, first AS sec, tag, cast(first - 86400 AS VARCHAR) AS modified FROM u),
rev AS (
  SELECT page_id * 2 + 1 AS id, canon,
         first + CASE WHEN page_id % 11 = 0 THEN -7200 ELSE 3600 * (1 + page_id % 5) END AS sec,
         CASE WHEN page_id % 7 = 0 THEN '"other"' WHEN page_id % 3 = 0 THEN 'W/' || tag WHEN page_id % 5 <> 0 THEN tag END AS tag,
         CASE WHEN page_id % 10 <> 0 THEN cast(first - 86400 AS VARCHAR) END AS modified
  FROM u),
best AS (
  SELECT r.id, r.canon, r.sec, r.tag, r.modified, max(struct_pack(sec := f.sec, id := f.id)) AS hit
  FROM rev r LEFT JOIN full_r f ON f.canon = r.canon AND f.sec < r.sec GROUP BY ALL),
res AS (
  SELECT b.id, b.canon, b.sec, f.id AS target, f.tag AS ftag, f.sec AS fsec,
         CASE WHEN f.id IS NULL THEN 'unresolved'
              WHEN b.tag IS NOT NULL THEN CASE WHEN regexp_replace(b.tag, '^W/', '') = regexp_replace(f.tag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
              WHEN b.modified IS NOT NULL THEN CASE WHEN b.modified = f.modified THEN 'resolved' ELSE 'mismatch' END
              ELSE 'unvalidated' END AS outcome
  FROM best b LEFT JOIN full_r f ON f.id = b.hit.id)
SELECT id AS record_id, canon AS canonical_url, target AS target_id, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=60;content-type=text/html;date=' || sec || ';etag=' || ftag || ';server=a'
            ELSE 'cache-control=max-age=60;date=' || sec || ';server=b' END AS headers
FROM res
"""
