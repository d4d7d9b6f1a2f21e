"""WARC fixity by Merkle trees: find damaged records of a replica without reading all digests.

Each archive file is an ordered run of records, and an index says at which offset each lies. A leaf is
the digest of a record with its offset range: its length, and how far its offset is from the end of what
comes before. Runs of leaves that follow each other are hashed into nodes, those again, up to one root per
archive; a node covers the range from its first record's start to its last one's end. Every level is
written once. Two replicas compare their roots, and only below nodes that differ are the next level's
nodes compared, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.llm.common import forget, materialize

FAN = 16


def warc_record(url: Column, payload: Column) -> Column:
    """Bytes of a response record; a null URL or payload counts as empty."""
    payload, url = F.coalesce(payload, F.lit("")), F.coalesce(url, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"),
                    F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n")).cast("binary")


def _height(places: DataFrame, fan: int) -> int:
    """Levels above the leaves, so that the last one has one node per archive. Places count from 0."""
    top = places.agg(F.max("seq")).first()[0] or 0
    height = 1
    while fan ** height <= top:
        height += 1
    return height


def placed(records: DataFrame, fan: int = FAN) -> DataFrame:
    """Records ``archive, seq`` and a ``length`` with ``expected``: where each starts if none is out of place.

    Lengths are added up node by node and handed down again, so no window holds more than ``fan`` rows,
    however long an archive is.
    """
    levels = [records.select("archive", F.col("seq").alias("node"), "length")]
    for _ in range(_height(records, fan)):
        levels.append(materialize(levels[-1].groupBy("archive", F.floor(F.col("node") / fan).alias("node"))
                                  .agg(F.sum("length").alias("length")), "sums"))
    starts = levels[-1].select("archive", "node", F.lit(0).cast("long").alias("start"))
    siblings = W.partitionBy("archive", "up").orderBy("node").rowsBetween(W.unboundedPreceding, -1)
    for level in reversed(levels[:-1]):
        above = starts.select("archive", F.col("node").alias("up"), F.col("start").alias("above"))
        starts = (level.withColumn("up", F.floor(F.col("node") / fan)).join(above, ["archive", "up"])
                  .select("archive", "node", (F.col("above") + F.coalesce(F.sum("length").over(siblings), F.lit(0)))
                          .cast("long").alias("start")))
    return records.join(starts.select("archive", F.col("node").alias("seq"), F.col("start").alias("expected")),
                        ["archive", "seq"])


def leaves(records: DataFrame, fan: int = FAN, index: DataFrame | None = None) -> DataFrame:
    """``archive, seq, record_offset, length, shift, digest`` of records ``archive, seq, record``.

    ``seq`` orders the records of an archive. ``index`` says where each lies (``archive, seq,
    record_offset``); ``shift`` is how far that is from where the record should start. Without an index, or
    where it says nothing, records lie one after the other; of several entries the smallest counts. Records
    without an archive, place or bytes are left out; of several at one place the one with the smallest
    digest counts.
    """
    hashed = (records.where("archive is not null and seq is not null and record is not null")
              .select("archive", F.col("seq").cast("long").alias("seq"), F.sha2("record", 256).alias("digest"),
                      F.octet_length("record").cast("long").alias("length"))
              .groupBy("archive", "seq").agg(F.min(F.struct("digest", "length")).alias("r"))
              .select("archive", "seq", "r.*"))
    hashed = materialize(hashed, "records")
    whole = placed(hashed, fan).withColumn("at", F.lit(None).cast("long"))
    if index is not None:
        entries = index.groupBy("archive", F.col("seq").cast("long").alias("seq")).agg(
            F.min(F.col("record_offset").cast("long")).alias("at"))
        whole = whole.drop("at").join(entries, ["archive", "seq"], "left")
    found = materialize(whole.select(
        "archive", "seq", F.coalesce("at", "expected").alias("record_offset"), "length",
        (F.coalesce("at", "expected") - F.col("expected")).alias("shift"), "digest"), "leaves")
    forget(hashed)
    return found


def merkle_levels(leaf: DataFrame, height: int, fan: int = FAN) -> list[DataFrame]:
    """Nodes ``archive, node, start, stop, digest`` of each level, written once, the records' own first.

    A leaf's digest covers its bytes and its offset range. A node's children are those whose place divided
    by ``fan`` is its place, so a missing record changes the nodes above it and no others. No group has
    more than ``fan`` members.
    """
    levels = [leaf.select("archive", F.col("seq").alias("node"), F.col("record_offset").alias("start"),
                          (F.col("record_offset") + F.col("length")).alias("stop"),
                          F.sha2(F.concat_ws(":", "digest", "length", "shift"), 256).alias("digest"))]
    for _ in range(height):
        child = F.struct("node", "digest")
        levels.append(materialize(levels[-1].groupBy("archive", F.floor(F.col("node") / fan).alias("up")).agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"),
            F.sha2(F.concat_ws("|", F.transform(F.array_sort(F.collect_list(child)),
                                                lambda c: F.concat_ws(":", c["node"], c["digest"]))), 256).alias("digest"))
            .withColumnRenamed("up", "node"), "nodes"))
    return levels


def audit(reference: DataFrame, replica: DataFrame, fan: int = FAN, reference_index: DataFrame | None = None,
          replica_index: DataFrame | None = None) -> DataFrame:
    """``archive, seq, record_offset, length, problem`` of the records that differ in the replica.

    Both sides are records ``archive, seq, record`` and may have an index, as ``leaves`` reads it. The problem
    is ``changed`` (other bytes of the same length), ``resized``, ``misplaced`` (the same bytes, but the index
    is off by another distance), ``missing`` or ``extra``; offset and length are those of the reference, of
    an extra record those of the replica. What a lost or resized record moves is not misplaced. A side
    without records makes all of the other missing or extra; equal sides give no rows. Places count from 0.
    """
    ours, theirs = leaves(reference, fan, reference_index), leaves(replica, fan, replica_index)
    height = max(_height(ours, fan), _height(theirs, fan))
    a, b = merkle_levels(ours, height, fan), merkle_levels(theirs, height, fan)
    suspect = None
    for level in range(height, -1, -1):
        x, y = (side[level].select("archive", "node", "digest") for side in (a, b))
        if suspect is not None:  # only children of nodes that differ
            x, y = (side.withColumn("up", F.floor(F.col("node") / fan))
                    .join(suspect.withColumnRenamed("node", "up"), ["archive", "up"], "left_semi").drop("up")
                    for side in (x, y))
        both = x.withColumnRenamed("digest", "x").join(y.withColumnRenamed("digest", "y"), ["archive", "node"], "full")
        suspect = materialize(both.where(~F.col("x").eqNullSafe(F.col("y"))).select("archive", "node"), "suspect")
    for level in (*a[1:], *b[1:]):
        forget(level)
    found = suspect.withColumnRenamed("node", "seq")
    x = found.join(ours, ["archive", "seq"], "left")
    y = theirs.select("archive", "seq", F.col("record_offset").alias("o"), F.col("length").alias("l"),
                      F.col("digest").alias("d"))
    problem = (F.when(F.col("d").isNull(), "missing").when(F.col("digest").isNull(), "extra")
               .when(F.col("l") != F.col("length"), "resized").when(F.col("d") != F.col("digest"), "changed")
               .otherwise("misplaced"))
    return x.join(y, ["archive", "seq"], "left").select(
        "archive", "seq", F.coalesce("record_offset", "o").alias("record_offset"),
        F.coalesce("length", "l").alias("length"), problem.alias("problem"))
