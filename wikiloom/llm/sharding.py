"""Consistent-hash sharding with virtual nodes and bounded loads (DataFrame functions only)."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fan_out, literal_table, stage

#: Equal rows that one task lays out one by one; more are cut into ranges, dealt to all tasks.
RANGE = 1 << 16


def ring(n_shards: int, vnodes: int, segments: int) -> list[tuple[int, int]]:
    """Sorted (segment, shard) of all virtual nodes.

    A shard's points on the circle depend on its number only; segments, a power of two, cut the circle by leading bits, for
    points and keys alike, so a finer cut leaves every point where it was.
    """
    point = lambda s, v: int.from_bytes(hashlib.md5(f"shard-{s}/point-{v}".encode()).digest()[:4], "big")
    return sorted((point(s, v) * segments >> 32, s) for s in range(n_shards) for v in range(vnodes))


def fill(counts: dict[int, int], n_shards: int, vnodes: int, segments: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (segment, lo, hi, shard, slot of lo): which ranks of each ring segment go to which shard.

    Every shard may hold floor or ceil of the mean. A segment's keys go to the first virtual node clockwise; the keys that
    a full shard cannot take go on to the next virtual node whose shard has room.
    """
    points = ring(n_shards, vnodes, segments)
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    used = [0] * n_shards
    out, waiting = [], []

    def put(seg: int, lo: int, n: int, shard: int) -> int:
        took = min(n, room[shard] - used[shard])
        if took:
            out.append((seg, lo, lo + took, shard, used[shard]))
            used[shard] += took
        return took

    for seg in sorted(counts):
        at = bisect_left(points, (seg, -1)) % len(points)
        took = put(seg, 0, counts[seg], points[at][1])
        if took < counts[seg]:
            waiting.append((seg, took, at))
    for seg, lo, at in waiting:
        while lo < counts[seg]:
            at = (at + 1) % len(points)
            lo += put(seg, lo, counts[seg] - lo, points[at][1])
    return out


def shard_documents(docs: DataFrame, n_shards: int = 8, vnodes: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The ring position is the hash of the text, so equal texts share a position and stay together unless their shard is
    full. Shard sizes in rows differ by one at most (law ``rows``); slots count from 0 in every shard. grown_shard is
    null under this law. Null text counts as empty (size 1, checksum 0); null and repeated ids are ordinary rows; rows
    equal in id, size and checksum are interchangeable. An empty table gives no rows. Other columns are ignored.

    The driver sees one count per ring segment (a number fixed by ``n_shards`` and ``vnodes``, never by the data), and
    the broadcast plan has at most that many rows plus one for each overflow.
    """
    spark = docs.sparkSession
    segments = 1 << max(12, (4 * n_shards * vnodes - 1).bit_length())
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_h"))
    rows = rows.withColumn("_seg", F.shiftrightunsigned("_h", 64 - (segments.bit_length() - 1)).cast("int"))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(fan_out(docs.count()))).cast("int"))
    cols = ["_seg", "_salt", "doc_id", "size", "text_crc32"]
    # Equal rows meet in one counted row, so that no repeated row is hot.
    rows = stage(rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")), "shard")
    pieces = rows.groupBy("_seg", "_salt").agg(F.sum("_n").alias("_piece"))
    counts = {r[0]: r[1] for r in pieces.groupBy("_seg").agg(F.sum("_piece")).collect()}
    plan = fill(counts, n_shards, vnodes, segments) if counts else []
    plan_df = literal_table(spark, plan, "_seg int, _lo bigint, _hi bigint, shard int, _slot bigint")
    before = Window.partitionBy("_seg").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_seg", "_salt", F.coalesce(F.sum("_piece").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_seg", "_salt").orderBy(F.xxhash64("doc_id"), "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(pieces, ["_seg", "_salt"])
    first = F.col("_before") + F.col("_in")
    at = at.select("_seg", "doc_id", "size", "text_crc32", "_n", first.alias("_first"))
    many = at.where(F.col("_n") > RANGE).withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(RANGE).cast("long"))))
    many = many.select("_seg", "doc_id", "size", "text_crc32", F.least(F.lit(RANGE), F.col("_n") - F.col("_at")).alias("_n"), (F.col("_first") + F.col("_at")).alias("_first")).repartition("_first")
    at = at.where(F.col("_n") <= RANGE).unionByName(many)
    at = at.select("_seg", "doc_id", "size", "text_crc32", F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)).alias("_rank"))
    out = at.join(F.broadcast(plan_df.withColumnRenamed("_seg", "_pseg")), (F.col("_seg") == F.col("_pseg")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi")))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_slot") + F.col("_rank") - F.col("_lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
