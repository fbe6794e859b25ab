"""Merkle fixity audit of WARC replicas.

The records of an archive, in order of their offsets, are the leaves of a tree: a leaf
is the SHA-256 of a record's bytes, a node that of its children's digests one after the
other, and covers the offset range of its children. An audit compares the roots of two
replicas; where digests differ it goes down to the children of the differing nodes only,
and so finds the damaged records without comparing all of them.

All of it is joins and aggregates on tables; nodes have at most FANOUT children.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import buckets_for, staged, total_before

FANOUT = 32


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a WARC resource record; a null url or body is empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def digests(records: DataFrame) -> DataFrame:
    """record_id, length and SHA-256 of each of ``records`` (record_id, record)."""
    return records.select(
        F.col("record_id").cast("long").alias("record_id"),
        F.octet_length("record").cast("long").alias("length"),
        F.sha2(F.col("record").cast("binary"), 256).alias("digest"),
    )


def manifest(records: DataFrame) -> DataFrame:
    """The order of an archive: record_id, leaf number, offset, length, digest.

    ``records`` (record_id, record) stand in the archive by record_id, then digest. Rows
    without a record_id or a record have no place in an archive and are left out. Records
    that repeat an id are leaves of their own, told apart by ``copy``, their number among equal ids.
    """
    found = staged(digests(records.where("record_id is not null and record is not null")), "record-digests")
    count, least, most = found.agg(F.count(F.lit(1)), F.min("record_id"), F.max("record_id")).first()
    if not count:
        return found.selectExpr("record_id", "1L copy", "0L leaf", "0L offset", "length", "digest")
    width = max(1, -(-(int(most) - int(least) + 1) // buckets_for(int(count), 500)))
    found = found.withColumn("_bucket", F.floor((F.col("record_id") - F.lit(least)) / F.lit(width)))
    found = found.withColumn("_one", F.lit(1).cast("long"))
    found = total_before(found, "_one", "_bucket", ["record_id", "digest"], "leaf")
    found = total_before(found, "length", "_bucket", ["record_id", "digest", "leaf"], "offset")
    return numbered(found).select("record_id", "copy", "leaf", "offset", "length", "digest")


def numbered(found: DataFrame) -> DataFrame:
    """Adds ``copy``: 1, 2, ... among the records of one id, ordered by digest."""
    return found.withColumn("copy", F.row_number().over(Window.partitionBy("record_id").orderBy("digest")).cast("long"))


@dataclass(frozen=True)
class Tree:
    """All nodes of a tree (level, node, digest, start, stop) and the number of its levels."""

    nodes: DataFrame
    levels: int


def build(leaves: DataFrame, fanout: int = FANOUT) -> Tree:
    """The tree over ``leaves`` (leaf, offset, length, digest); leaves are level 0, the root stands alone on top.

    A missing leaf digest stands as zeros. No leaves give a tree of no nodes.
    """
    level = leaves.select(
        F.lit(0).alias("level"),
        F.col("leaf").alias("node"),
        F.coalesce("digest", F.lit("0" * 64)).alias("digest"),
        F.col("offset").alias("start"),
        (F.col("offset") + F.col("length")).alias("stop"),
    )
    level = staged(level, "merkle")
    nodes, number, size = level, 0, level.count()
    while size > 1:
        number += 1
        parts = F.transform(F.sort_array(F.collect_list(F.struct("node", "digest"))), lambda c: c["digest"])
        level = level.groupBy(F.floor(F.col("node") / fanout).cast("long").alias("node")).agg(
            F.sha2(F.unhex(F.concat_ws("", parts)), 256).alias("digest"), F.min("start").alias("start"), F.max("stop").alias("stop")
        )
        level = staged(level.select(F.lit(number).alias("level"), "node", "digest", "start", "stop"), "merkle")
        nodes, size = nodes.union(level), -(-size // fanout)
    return Tree(nodes, number + 1)


def differing(mine: Tree, other: Tree, fanout: int = FANOUT) -> DataFrame:
    """Nodes whose digests differ, level by level from the root: level, node, start, stop.

    Both trees have the same shape. Below a node that agrees nothing is looked at.
    """
    if mine.levels != other.levels:
        raise ValueError("the trees differ in height")
    found = below = None
    for level in range(mine.levels - 1, -1, -1):
        here = mine.nodes.where(F.col("level") == level)
        there = other.nodes.where(F.col("level") == level).select("node", F.col("digest").alias("_other"))
        if below is not None:
            open_ = below.select(F.explode(F.sequence(F.col("node") * fanout, F.col("node") * fanout + fanout - 1)).alias("node"))
            here = here.join(open_, "node")
        below = staged(here.join(there, "node").where("digest != _other").select("level", "node", "start", "stop"), "merkle-diff")
        found = below if found is None else found.union(below)
        if below.isEmpty():
            break
    return found


def audit(records: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Compares a replica with the archive: one row per record of the archive, in the archive's offsets.

    Both have record_id and record (text or bytes). Returns record_id, copy, leaf,
    offset, length, digest, replica_digest and status: ``ok``, ``corrupt`` or
    ``missing``; the last two come from the descent alone. Records of the replica that the archive
    lacks come with a null offset and the status ``extra``. Null ids and null records
    have no place; repeated ids are matched in order of their digests. Other columns are
    left aside. Empty tables give no rows but the other side's.
    """
    listed = staged(manifest(records), "manifest")
    found = digests(replica.where("record_id is not null and record is not null"))
    theirs = staged(numbered(found).select("record_id", "copy", F.col("digest").alias("replica_digest")), "replica")
    both = staged(listed.join(theirs, ["record_id", "copy"], "left"), "replica-leaves")
    other = both.select("leaf", "offset", "length", F.col("replica_digest").alias("digest"))
    bad = differing(build(listed, fanout), build(other, fanout), fanout).where("level = 0").select(F.col("node").alias("leaf"))
    marked = both.join(bad.withColumn("_bad", F.lit(True)), "leaf", "left")
    status = F.when(F.col("_bad").isNull(), "ok").when(F.col("replica_digest").isNull(), "missing").otherwise("corrupt")
    names = ["record_id", "copy", "leaf", "offset", "length", "digest", "replica_digest"]
    rows = marked.select(*names, status.alias("status"))
    extra = theirs.join(listed.select("record_id", "copy"), ["record_id", "copy"], "left_anti")
    nothing = [F.lit(None).cast("long").alias(n) for n in ("leaf", "offset", "length")]
    return rows.union(extra.select("record_id", "copy", *nothing, F.lit(None).cast("string").alias("digest"), "replica_digest", F.lit("extra")))
