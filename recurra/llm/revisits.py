"""Not-modified revisit resolution for web archives.

A revisit record (HTTP 304) carries no payload: it refers to the latest earlier full response
of the same canonical URL. The as-of join sorts all records by (canonical URL, date) over
range partitions and carries the latest full response forward; a hot URL spreads over as many
partitions as it needs, and what crosses a partition border comes from a table with one row
per partition. Validators are then compared and the permitted headers merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import freeze, small_batches

#: Headers that a 304 response must not change (fixed values): they describe the payload or the connection.
NOT_MERGED = ("content-length", "content-encoding", "content-type", "content-range", "transfer-encoding",
              "connection", "keep-alive", "proxy-connection", "te", "trailer", "upgrade")
#: Query parameters that do not name a different page (a regular expression).
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Host (lower case, without ``www.`` and default port) + path without a closing slash +
    the remaining query parameters in order. Scheme and fragment do not count. NULL: ''."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, "#.*$", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*(/[^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                    .otherwise(F.lit("")))


#: Headers in the sorted pass: entries in order of their names, a type that can be compared.
_ENTRIES = "array<struct<key:string,value:string>>"
_CARRIED = (f"kind string, pid int, url_key string, record_id string, headers {_ENTRIES}, copies long, "
            f"original_id string, stored {_ENTRIES}, open boolean")


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In one sorted partition: each revisit with the latest full response before it, and
    the partition's last full response."""
    pid = TaskContext.get().partitionId()
    last, first_key = None, None

    def out(kind, *columns):
        n = len(columns[0])
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n), pa.array(np.full(n, pid, np.int32)), *columns],
            names=["kind", "pid", "url_key", "record_id", "headers", "copies", "original_id", "stored", "open"])

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        columns = [batch.column(c) for c in ("url_key", "record_id", "headers")]
        full = batch.column("full").to_numpy(zero_copy_only=False)
        if last is None:
            last, first_key = [pa.nulls(1, c.type) for c in columns], columns[0][0].as_py()
        # place 0 stands for what earlier batches carried
        placed = [pa.concat_arrays([one, c]) for one, c in zip(last, columns)]
        latest = np.maximum.accumulate(np.where(full, np.arange(1, n + 1), 0))
        before = np.r_[0, latest[:-1]]
        same = np.asarray(pc.fill_null(pc.equal(placed[0].take(pa.array(before)), columns[0]), False))
        revisit = np.flatnonzero(~full)
        pick = pa.array(revisit)
        original = pa.array(before[revisit], mask=~same[revisit])
        start = np.asarray(pc.equal(columns[0].take(pick), pa.scalar(first_key)))
        yield out("revisit", *(c.take(pick) for c in columns), batch.column("copies").take(pick),
                  placed[1].take(original), placed[2].take(original), pa.array(~same[revisit] & start))
        last = [c.take(pa.array(latest[-1:])) for c in placed]
    if last is not None:
        key, original_id, stored = last
        yield out("tail", key, pa.nulls(1, pa.string()), pa.nulls(1, stored.type), pa.array([0], pa.int64()),
                  original_id, stored, pa.array([False]))


def latest_earlier(records: DataFrame) -> DataFrame:
    """(url_key, record_id, headers, copies, original_id, stored) of every revisit.

    ``records`` is (url_key, date, record_id, full, headers, copies), headers as entries. "Earlier" is
    by (date, full responses first, record_id, headers); NULL dates and ids sort first. The
    original travels with its headers, so no id is looked up; ``stored`` is NULL without one.
    """
    small_batches(records.sparkSession, 10_000)
    key = [F.col("url_key"), F.col("date"), F.col("full").desc(), F.col("record_id"), F.col("headers")]
    ranged = records.repartitionByRange(*key).sortWithinPartitions(*key)
    carried = freeze(ranged.select("url_key", "record_id", "full", "headers", "copies")
                     .mapInArrow(_carry, _CARRIED))
    tails = carried.filter("kind = 'tail'").select(
        "pid", F.when(F.col("url_key").isNotNull(), F.struct("url_key", "original_id", "stored")).alias("last"))
    earlier = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    over = tails.select("pid", F.last("last", ignorenulls=True).over(earlier).alias("last"))
    revisits = carried.filter("kind = 'revisit'")
    own = ["url_key", "record_id", "headers", "copies"]
    found = revisits.filter("not open").select(*own, "original_id", "stored")
    hit = F.col("last.url_key") == F.col("url_key")
    late = (revisits.filter("open").select("pid", *own).join(over, "pid", "left")
            .select(*own, F.when(hit, F.col("last.original_id")).alias("original_id"),
                    F.when(hit, F.col("last.stored")).alias("stored")))
    return found.unionByName(late)


def _etag(headers: Column) -> Column:
    return F.regexp_replace(F.element_at(headers, "etag"), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url_key, original_id, outcome, headers.

    ``records``: record_id (string), url, date, status (int), headers (map, names in
    lower case). A full response has status 200, a revisit 304; other records are neither.
    ``outcome``: 'resolved' (validators agree), 'unchecked' (no validator on either side),
    'validator_mismatch', or 'no_original'. An ETag decides if both sides have one (weak
    comparison), else Last-Modified. For a resolved or unchecked revisit ``headers`` are the
    original's, overwritten by the revisit's except for ``NOT_MERGED``; otherwise the
    revisit's own. NULL urls share the empty canonical URL; NULL headers are no headers. An
    empty table gives no rows.

    Ids need not be unique: records that share an id but differ in canonical URL, date or
    headers are records of their own, each with its own original. Records equal in all of
    these are one record stored more than once and give one row; without an id (NULL) they
    are counted as different records and each gives a row. ``original_id`` is NULL where the
    original has no id, too: ``outcome`` tells.
    """
    listed = F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))))
    kinds = records.filter("status in (200, 304)").select(
        F.col("record_id").cast("string").alias("record_id"), "date", (F.col("status") == 200).alias("full"),
        canonical_url(F.col("url")).alias("url_key"), listed.cast(_ENTRIES).alias("headers"))
    # records without an id are counted by task, so that a hot one comes out in many places
    part = F.when(F.col("record_id").isNull(), F.spark_partition_id())
    counted = (kinds.withColumn("part", part).groupBy(*kinds.columns, "part")
               .agg(F.count("*").alias("copies")).drop("part"))
    joined = latest_earlier(counted).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.when(F.col("record_id").isNull(), F.col("copies"))
                                     .otherwise(F.lit(1).cast("long"))))).select(
        "record_id", "url_key", "original_id", F.map_from_entries("headers").alias("headers"),
        F.map_from_entries("stored").alias("stored"))
    h, s = F.col("headers"), F.col("stored")
    agree = F.when(_etag(h).isNotNull() & _etag(s).isNotNull(), _etag(h) == _etag(s)).when(
        F.element_at(h, "last-modified").isNotNull() & F.element_at(s, "last-modified").isNotNull(),
        F.element_at(h, "last-modified") == F.element_at(s, "last-modified"))
    outcome = (F.when(s.isNull(), "no_original").when(agree.isNull(), "unchecked")
               .when(agree, "resolved").otherwise("validator_mismatch"))
    news = F.map_filter(h, lambda k, v: ~k.isin(*NOT_MERGED))
    olds = F.map_filter(s, lambda k, v: ~F.map_contains_key(news, k))
    merged = F.when(outcome.isin("resolved", "unchecked"), F.map_concat(olds, news)).otherwise(h)
    return joined.select("record_id", "url_key", "original_id", outcome.alias("outcome"), merged.alias("headers"))


def crawl_records(pages: DataFrame, recrawl_after: int = 1000) -> DataFrame:
    """WARC-like records of ``pages``: a full response at second ``page_id``, whose ETag is the
    MD5 of the page, and a 304 revisit of it ``recrawl_after`` seconds later. A page without
    an id (NULL) has records without id and date."""
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    first = F.create_map(F.lit("etag"), tag, F.lit("content-type"), F.lit("text/html"),
                         F.lit("content-length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
                         F.lit("date"), F.col("page_id").cast("string"))
    again = F.create_map(F.lit("etag"), tag, F.lit("content-length"), F.lit("0"),
                         F.lit("date"), (F.col("page_id") + recrawl_after).cast("string"))
    def made(kind: str, date: Column, status: int, headers: Column) -> DataFrame:
        return pages.select(F.concat(F.lit(f"{kind}-"), F.col("page_id").cast("string")).alias("record_id"), "url",
                            date.alias("date"), F.lit(status).alias("status"), headers.alias("headers"))

    return made("response", F.col("page_id"), 200, first).unionByName(
        made("revisit", F.col("page_id") + recrawl_after, 304, again))
