"""URL filters with dated lists.

List entries carry a date; each one holds until the next entry for the same key, so a list
becomes validity intervals. A capture is evaluated against the entries active when it was
fetched: its host suffixes and its host with the first path segment are looked up, and the
most specific active entry decides.

Scale. Only the id, URL and time of a capture travel, never its page. Both sides are cut
into periods, so that a host with a third of all captures and a key with a long history meet
period by period in an equi-join, which Spark may split further where it is skewed. Nothing
is broadcast by hand.

Defined results, one row per distinct (id, url, time). NULL or unusable URLs, NULL fetch
times and captures without an active entry: not blocked, matched key NULL. Entries without
key, time or action are no entries. Entries of one key and time: the largest (action, id)
holds. Hosts are compared in lower case without port, user or final dot. Extra columns of
captures and entries do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm.text import table, unit_hash

PERIOD_DAYS = 30
DAY = 86400


def host_of(url: Column) -> Column:
    """The host in lower case, NULL where the URL has none."""
    host = F.regexp_extract(
        F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@\s]+)", 1
    )
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def segment_of(url: Column) -> Column:
    """The first path segment, empty where there is none."""
    return F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^/?#]*)", 1)


def lookup_keys(url: Column) -> Column:
    """Array of (rank, key): host suffixes of two labels and more, then host/segment.

    A larger rank is more specific.
    """
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.when(
        n >= 2,
        F.transform(
            F.sequence(F.lit(2), F.greatest(n, F.lit(2))),
            lambda k: F.struct(
                k.cast("int").alias("rank"),
                F.array_join(F.slice(labels, -k, k), ".").alias("key"),
            ),
        ),
    ).otherwise(F.array(F.struct(F.lit(1).alias("rank"), host.alias("key"))))
    segment = segment_of(url)
    path = F.struct((n + 1).cast("int").alias("rank"), F.concat(host, F.lit("/"), segment).alias("key"))
    return F.when(segment != "", F.concat(suffixes, F.array(path))).otherwise(suffixes)


def validity(entries: DataFrame) -> DataFrame:
    """Dated entries (entry_id, key, action, dated_at) to intervals [since, until).

    ``until`` is NULL for the last entry of a key. The window holds the history of one key.
    """
    named = entries.select("entry_id", F.lower("key").alias("key"), "action", "dated_at").dropna(
        subset=["key", "action", "dated_at"]
    )
    held = named.groupBy("key", F.col("dated_at").alias("since")).agg(
        F.max(F.struct("action", "entry_id")).alias("entry")
    )
    until = F.lead("since").over(Window.partitionBy("key").orderBy("since"))
    return held.select("key", "since", until.alias("until"), "entry.action", "entry.entry_id")


def url_filter(captures: DataFrame, entries: DataFrame, period_days: int = PERIOD_DAYS) -> DataFrame:
    """Judge captures (page_id, url, fetched_at) by entries (entry_id, key, action, dated_at).

    Actions: ``block``, ``allow``, and ``retire``, which ends the entry before it. Returns
    page_id, url, fetched_at, host, matched_key, entry_id, action, blocked.
    """
    period = lambda at: F.floor(at.cast("timestamp").cast("long") / (period_days * DAY))
    seen = captures.select("page_id", "url", "fetched_at").distinct()
    spans = validity(entries).where(F.col("action") != "retire")
    # An interval stands in each period that it touches, the last one up to the last capture.
    edge = captures.agg(F.max("fetched_at").cast("timestamp")).first()[0]
    edge = F.lit(edge).cast("timestamp")
    last = F.least(F.coalesce(period(F.col("until")), period(edge)), period(edge))
    spans = spans.where(F.col("since") <= edge).select(
        "key",
        "since",
        "until",
        "action",
        "entry_id",
        F.explode(F.sequence(period(F.col("since")), F.greatest(last, period(F.col("since"))))).alias("period"),
    )
    looked = seen.select(
        "page_id", "url", "fetched_at", period(F.col("fetched_at")).alias("period"), F.explode(lookup_keys(F.col("url"))).alias("k")
    ).select("page_id", "url", "fetched_at", "period", "k.rank", F.lower("k.key").alias("key"))
    hits = looked.join(spans, ["key", "period"]).where(
        (F.col("fetched_at") >= F.col("since"))
        & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until")))
    )
    found = hits.select(
        "page_id", "url", "fetched_at", F.struct("rank", "key", "entry_id", "action").alias("hit")
    )
    none = F.lit(None).cast(found.schema["hit"].dataType)
    judged = (
        found.unionByName(seen.withColumn("hit", none))
        .groupBy("page_id", "url", "fetched_at")
        .agg(F.max("hit").alias("hit"))
    )
    return judged.select(
        "page_id",
        "url",
        "fetched_at",
        host_of(F.col("url")).alias("host"),
        F.col("hit.key").alias("matched_key"),
        F.col("hit.entry_id").alias("entry_id"),
        F.col("hit.action").alias("action"),
        F.coalesce(F.col("hit.action") == "block", F.lit(False)).alias("blocked"),
    )


def at_day(share: Column) -> Column:
    """A time in 2024 for a number in [0, 1)."""
    seconds = F.floor(share * 366 * DAY).cast("long") + F.lit(1704067200)
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures; the tables give no fetch time, so the id fixes one in 2024."""
    return pages.select("page_id", "url", at_day(unit_hash(F.col("page_id"), 1)).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated list entries drawn from the hosts and first segments of all pages by hash.

    About a quarter of the registered domains, hosts and host/segment keys get up to three
    dated entries each.
    """
    keys = pages.select(F.explode(lookup_keys(F.col("url"))).alias("k")).select(F.col("k.key").alias("key"))
    keys = keys.where(F.col("key").isNotNull()).distinct().where(unit_hash(F.col("key"), 2) < 0.25)
    dated = keys.select("key", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("turn"))
    mark = F.concat_ws("#", "key", F.col("turn").cast("string"))
    pick = unit_hash(mark, 3)
    action = F.when(pick < 0.5, "block").when(pick < 0.75, "allow").otherwise("retire")
    return dated.select(
        mark.alias("entry_id"), "key", action.alias("action"), at_day(unit_hash(mark, 4)).alias("dated_at")
    )


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every page against the dated lists active at its fetch time."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(captures_of(pages), entries_of(pages))


OP1_SQL = r"""
WITH seen AS (
  SELECT DISTINCT page_id, url,
    make_timestamp((1704067200 + floor(('0x' || substr(md5(coalesce(page_id::VARCHAR, '') || ':1'), 1, 8))::BIGINT::DOUBLE
      / 4294967296.0 * 366 * 86400)::BIGINT) * 1000000) AS fetched_at
  FROM pages
), hosted AS (
  SELECT *, nullif(regexp_replace(regexp_extract(lower(trim(url)),
      '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@\s]+)', 1), '\.+$', ''), '') AS host,
    regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^/?#]*)', 1) AS segment
  FROM seen
), labelled AS (
  SELECT *, string_split(host, '.') AS labels, len(string_split(host, '.')) AS n FROM hosted WHERE host IS NOT NULL
), keyed AS (
  SELECT page_id, url, fetched_at, k AS rank, array_to_string(labels[-k:], '.') AS key
  FROM (SELECT *, unnest(range(2, n + 1)) AS k FROM labelled WHERE n >= 2)
  UNION ALL SELECT page_id, url, fetched_at, 1, host FROM labelled WHERE n < 2
  UNION ALL SELECT page_id, url, fetched_at, n + 1, host || '/' || segment FROM labelled WHERE segment <> ''
), marks AS (
  SELECT DISTINCT key, turn, key || '#' || turn AS mark
  FROM (SELECT DISTINCT key FROM keyed) CROSS JOIN range(1, 4) AS t(turn)
  WHERE ('0x' || substr(md5(key || ':2'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 < 0.25
), entries AS (
  SELECT mark AS entry_id, lower(key) AS key,
    ('0x' || substr(md5(mark || ':3'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS pick,
    make_timestamp((1704067200 + floor(('0x' || substr(md5(mark || ':4'), 1, 8))::BIGINT::DOUBLE
      / 4294967296.0 * 366 * 86400)::BIGINT) * 1000000) AS since
  FROM marks
), acted AS (
  SELECT *, CASE WHEN pick < 0.5 THEN 'block' WHEN pick < 0.75 THEN 'allow' ELSE 'retire' END AS action FROM entries
), held AS (
  SELECT key, since, max({'action': action, 'entry_id': entry_id}) AS e FROM acted GROUP BY key, since
), spans AS (
  SELECT key, since, lead(since) OVER (PARTITION BY key ORDER BY since) AS until,
    e.action AS action, e.entry_id AS entry_id FROM held
), hits AS (
  SELECT page_id, url, fetched_at, max({'rank': rank, 'key': keyed.key, 'entry_id': entry_id, 'action': action}) AS hit
  FROM (SELECT page_id, url, fetched_at, rank, lower(key) AS key FROM keyed) keyed
  JOIN spans ON keyed.key = spans.key AND fetched_at >= since AND (until IS NULL OR fetched_at < until)
  WHERE action <> 'retire' GROUP BY ALL
)
SELECT h.page_id, h.url, h.fetched_at, h.host, hit.key AS matched_key, hit.entry_id AS entry_id,
       hit.action AS action, coalesce(hit.action = 'block', false) AS blocked
FROM hosted h LEFT JOIN hits ON h.page_id IS NOT DISTINCT FROM hits.page_id
  AND h.url IS NOT DISTINCT FROM hits.url AND h.fetched_at = hits.fetched_at
"""
