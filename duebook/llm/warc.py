"""Not-modified records of a web archive resolved to the responses they stand for.

A revisit record says that a page had not changed and holds headers only. It is resolved to the latest earlier full
response of the same canonical URL. The search is an as-of join in two steps, so that a URL with very many captures is no
single task: within (URL, span of time) by a window, and for what lies before a span by one row per span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a URL's captures that one window looks at.
SPAN = 3600
#: What a cache must not take from a not-modified answer, by the HTTP standard.
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Query parameters that only track.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"
RECORD = ("record_id", "url", "captured", "is_revisit", "headers")


def canonical_url(url: Column) -> Column:
    """Host and path in one spelling: no scheme, user, leading www, default port, fragment, tracking or order of parameters.

    Null for what has no host.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    part = lambda n: F.regexp_extract(bare, r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://(?:[^/?@]*@)?([^/?:]*)(?::(\d*))?([^?]*)(?:\?(.*))?$", n)
    scheme, port = F.lower(part(1)), part(3)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(2)), r"\.$", ""), r"^www\d*\.", "")
    usual = (port == "") | (scheme == "http") & (port == "80") | (scheme == "https") & (port == "443")
    path = F.regexp_replace(F.regexp_replace(part(4), "/{2,}", "/"), "/$", "")
    asked = F.array_sort(F.filter(F.split(part(5), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    address = F.concat(host, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), F.when(path == "", "/").otherwise(path))
    full = F.when(F.size(asked) > 0, F.concat(address, F.lit("?"), F.array_join(asked, "&"))).otherwise(address)
    return F.when(part(2) != "", full)


def lower_names(headers: Column) -> Column:
    """Headers as sorted (key, value) entries with names in lower case; of a name given twice the largest value counts."""
    entries = F.array_sort(F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    last = F.filter(entries, lambda e, i: (i == F.size(entries) - 1) | (F.get(entries, i + 1)["key"] != e["key"]))
    return F.when(headers.isNull(), F.array().cast("array<struct<key:string,value:string>>")).otherwise(last)


def value_of(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["key"] == name), F.lit(0))["value"]


def weak_tag(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve(records: DataFrame, span: int = SPAN) -> DataFrame:
    """Per revisit: record_id, url, canonical_url, captured, resolved_id, outcome, headers (of the response as updated).

    records has the columns RECORD: captured in seconds (long), headers a map. Others are ignored. The response is the
    latest strictly earlier one of the same canonical URL; of several at one time, the one with the largest id.
    outcome: `no url`, `no time`, `no response`, `validators differ`, `matched` (entity tags, or else dates of change, are
    equal) or `unchecked` (one side has no validator to compare). A revisit whose validators differ stands for another
    content: it has no resolved_id and no headers. Otherwise headers are the response's, with those of the revisit that
    HTTP lets a not-modified answer change. Repeated records stay separate rows. is_revisit null counts as a response.
    """
    entries = lower_names(F.col("headers"))
    events = records.select("record_id", "url", F.col("captured").cast("long").alias("captured"), F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"), entries.alias("entries"))
    events = events.withColumn("canonical_url", canonical_url(F.col("url")))
    placed = F.col("canonical_url").isNotNull() & F.col("captured").isNotNull()
    event = events.filter(placed).withColumn("span", F.floor(F.col("captured") / span).cast("long"))
    response = F.when(~F.col("is_revisit"), F.struct("captured", "record_id", F.col("entries").alias("headers")))
    earlier = Window.partitionBy("canonical_url", "span").orderBy("captured").rangeBetween(Window.unboundedPreceding, -1)
    within = event.withColumn("near", F.max(response).over(earlier)).filter("is_revisit")
    spans = event.groupBy("canonical_url", "span").agg(F.max(response).alias("last"))
    before = Window.partitionBy("canonical_url").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    far = spans.withColumn("far", F.max("last").over(before)).drop("last").filter("far is not null")
    found = within.join(far, ["canonical_url", "span"], "left").withColumn("of", F.coalesce("near", "far")).drop("near", "far", "span")
    unplaced = events.filter("is_revisit").filter(~placed).withColumn("of", F.lit(None).cast(found.schema["of"].dataType))
    both = found.unionByName(unplaced)

    mine, theirs = F.col("entries"), F.col("of.headers")
    tags = [weak_tag(value_of(x, "etag")) for x in (mine, theirs)]
    dates = [F.trim(value_of(x, "last-modified")) for x in (mine, theirs)]
    equal = F.when(tags[0].isNotNull() & tags[1].isNotNull(), tags[0] == tags[1]).otherwise(dates[0] == dates[1])
    outcome = (
        F.when(F.col("canonical_url").isNull(), "no url")
        .when(F.col("captured").isNull(), "no time")
        .when(F.col("of").isNull(), "no response")
        .when(equal.isNull(), "unchecked")
        .when(equal, "matched")
        .otherwise("validators differ")
    )
    updates = F.filter(mine, lambda e: ~e["key"].isin(*NOT_UPDATED))
    names = F.transform(updates, lambda e: e["key"])
    merged = F.array_sort(F.concat(F.filter(theirs, lambda e: ~F.array_contains(names, e["key"])), updates))
    settled = F.col("outcome").isin("matched", "unchecked")
    judged = both.withColumn("outcome", outcome)
    return judged.select(
        "record_id",
        "url",
        "canonical_url",
        "captured",
        F.when(settled, F.col("of.record_id")).alias("resolved_id"),
        "outcome",
        F.when(settled, F.map_from_entries(merged)).alias("headers"),
    )
