"""URL filters by dated lists: a temporal join of captures with the entries active when fetched.

Dated list entries become validity intervals. Captures first collapse to their distinct hosts and
periods; those meet the intervals of the host and of its parent domains, and what a host has in a
period becomes one array. Each capture then joins its host's array and keeps what was active at its
fetch time, so a host with a third of all captures costs one small row on the list side. The arrays are
written before that join: between two tables as they are Spark splits such a host, beside an aggregate
it doesn't. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.llm.common import materialize, row_of, unused

#: seconds of a period; intervals are cut at its borders, so arrays stay short on busy lists
PERIOD = 30 * 86400
FOREVER = (1 << 62) - 1


def host_of(url: Column) -> Column:
    """Host of a URL: lower case, without user, port and final dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and every parent domain of two or more labels, longest first."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(n < 2, F.array(host)).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, pattern, valid_from, valid_to`` from dated ``add`` and ``remove`` entries.

    ``entries`` has ``list, kind (host or domain), pattern, action, at``. A state holds from its date
    until the next entry of the same list and pattern; of entries at one time a removal wins. Entries
    without a pattern or date, or with another action or kind, say nothing; patterns are compared in
    lower case. Adding what is listed and removing what isn't changes nothing.
    """
    known = (entries.where("pattern is not null and at is not null and action in ('add', 'remove') "
                           "and kind in ('host', 'domain')")
             .groupBy(F.coalesce("list", F.lit("")).alias("list"), "kind",
                      F.lower("pattern").alias("pattern"), F.col("at").cast("long").alias("at"))
             .agg(F.min(F.when(F.col("action") == "add", 1).otherwise(0)).alias("listed")))
    history = W.partitionBy("list", "kind", "pattern").orderBy("at")
    return (known.withColumn("until", F.lead("at", 1, FOREVER).over(history)).where("listed = 1")
            .select("list", "kind", "pattern", F.col("at").alias("valid_from"), F.col("until").alias("valid_to")))


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", at_col: str = "fetched_at",
                out: str = "matches") -> DataFrame:
    """All columns of every capture and an array of the entries that were active at its fetch time.

    An element is ``struct<list, kind, pattern, valid_from, valid_to>``, in this order; an interval
    holds from its start up to, not including, its end (both in seconds). A ``host`` entry matches that
    host, a ``domain`` entry the domain and all below it. Captures without a host or time, and all
    captures under an empty list, have an empty array. One row per capture, repeated rows included.
    Captures may have any other columns; where one is called ``out``, the array's name gets an underscore.
    """
    host, at, out = "_host", "_at", unused(captures, out)
    dated = (captures.select(row_of(captures.columns).alias("_row"), host_of(F.col(f"`{url_col}`")).alias(host),
                             F.col(f"`{at_col}`").cast("long").alias(at))
             .withColumn("_period", F.floor(F.col(at) / PERIOD)))
    seen = dated.where("_host is not null and _period is not null").select("_host", "_period").distinct()
    # a domain entry may be a top-level domain, so the last label is looked up as well
    names = F.array_union(domains_of(F.col(host)), F.array(F.substring_index(F.col(host), ".", -1)))
    keyed = seen.select("_host", "_period", F.explode(names).alias("pattern"))
    # the last period in which an interval can matter is the last one with a capture
    last = seen.agg(F.max("_period")).scalar()
    first = seen.agg(F.min("_period")).scalar()
    spans = (intervals(entries)
             .withColumn("_from", F.greatest(F.floor(F.col("valid_from") / PERIOD), first))
             .withColumn("_to", F.least(F.floor((F.col("valid_to") - 1) / PERIOD), last))
             .where("_from <= _to")
             .withColumn("_period", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to"))
    # entries of one pattern become an array before they meet hosts, so hosts below a domain share it
    entry = F.struct("list", "kind", "pattern", "valid_from", "valid_to")
    by_pattern = spans.groupBy("pattern", "_period").agg(F.collect_list(entry).alias("_entries"))
    by_host = materialize(keyed.join(by_pattern, ["pattern", "_period"]).groupBy("_host", "_period")
                          .agg(F.flatten(F.collect_list("_entries")).alias("_entries"))
                          .select(F.col("_host").alias("_h"), F.col("_period").alias("_p"), "_entries"), "by-host")
    active = F.filter("_entries", lambda e: (e["valid_from"] <= F.col(at)) & (F.col(at) < e["valid_to"])
                      & ((e["kind"] == "domain") | (e["pattern"] == F.col(host))))
    return (dated.join(by_host, (F.col(host) == F.col("_h")) & (F.col("_period") == F.col("_p")), "left")
            .select("_row", F.array_sort(F.coalesce(
                active, F.array().cast("array<struct<list:string,kind:string,pattern:string,"
                                       "valid_from:bigint,valid_to:bigint>>"))).alias("_active"))
            .select("_row.*", F.col("_active").alias(out)))
