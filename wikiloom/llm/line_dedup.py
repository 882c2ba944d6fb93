"""Line dedup: repeated runs of lines, by a suffix array over line ids built with distributed prefix doubling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, numbered, stage

_WORD = r"[^\x20\x09-\x0D]+"
#: Which of two copies is the first: columns of a line's place.
_PLACE = ["doc_id", "_hash", "_row", "pos"]


def ranks(members: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Members whose ``keys`` occur more than once, with ``r``, the rank of their keys, and the place of the first copy.

    Equal keys form an interval of the suffix array. The distinct keys are sorted over all partitions and numbered in that
    order, so ranks are dense and compare like the prefixes they stand for.
    """
    groups = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.min(F.struct(*_PLACE)).alias("_f")).where("_c > 1")
    order = numbered(groups.select(*keys, "_c", F.col("_f._row").alias("_first"), F.col("_f.pos").alias("_from")), keys, "r", "ranks")
    met = join_counted(members, order, keys, "_c", total)
    return stage(met.select(*_PLACE, "long", "r", ((F.col("_row") != F.col("_first")) | (F.col("pos") != F.col("_from"))).alias("later")), "suffixes")


def repeated(lines: DataFrame, min_lines: int, total: int) -> DataFrame:
    """(_row, pos, depth) of every run of ``min_lines`` lines, and of every long line, that also stands at an earlier place.

    ``lines`` has the place, the id (p, q) and the mark ``long`` of every line. Prefix doubling: suffixes sorted by h lines
    are sorted by 2h through the rank of the suffix h lines on; the last step overlaps if ``min_lines`` is no power of two. What
    is alone at a step stays alone and drops out. At depth h a suffix lies in an interval whose common prefix is at least
    h: the interval's first copy stays, the others are returned.
    """
    members, h = ranks(lines, ["p", "q"], total), 1
    later = lambda d, test: members.where(F.col("later") & test).select("_row", "pos", F.lit(d).alias("depth"))
    out = later(1, F.col("long") if min_lines > 1 else F.lit(True))
    while h < min_lines:
        step = min(h, min_lines - h)
        ahead = members.select(F.col("_row").alias("_row2"), (F.col("pos") - step).alias("_at"), F.col("r").alias("r2"))
        pairs = members.join(ahead, (F.col("_row") == F.col("_row2")) & (F.col("pos") == F.col("_at")))
        pairs = stage(pairs.select(*_PLACE, "long", F.col("r").alias("r1"), "r2"), "pairs")
        members, h = ranks(pairs, ["r1", "r2"], total), h + step
    return out if min_lines == 1 else out.unionByName(later(min_lines, F.lit(True)))


def line_dedup(docs: DataFrame, min_lines: int = 2, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, n_runs, kept_text.

    Lines are what line feeds separate. A run of ``min_lines`` or more lines, or one line of ``min_words`` or more words, that
    also stands earlier (a smaller doc_id, or further up in the same document; overlaps count) is removed: of each
    repeated run the first copy stays. The array is sorted to ``min_lines`` lines, as deep as that needs: a longer repeated
    run is the union of the runs of that depth in it, each of which has its own earlier copy, so what is removed and merged
    to n_runs maximal runs is what deeper sorting would give. Line ids are 128-bit hashes of the lines, ranks come from sorting.

    Null text: no lines, null kept_text; empty text: one empty line. Every row is a document of its own, whatever its id:
    doc_id only orders the copies, null ids first, rows of one id by a hash of their text. An empty table gives no rows;
    other columns are ignored.
    """
    # Row numbers hold only for what is written.
    base = stage(docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("_text"), F.monotonically_increasing_id().alias("_row")), "texts")
    base = base.select("doc_id", "_row", F.xxhash64("_text").alias("_hash"), F.split("_text", "\n", -1).alias("_lines"))
    each = lambda x: F.struct(F.xxhash64(x).alias("p"), F.xxhash64(F.lit(1), x).alias("q"), (F.regexp_count(x, F.lit(_WORD)) >= min_words).alias("long"))
    at = base.select("doc_id", "_hash", "_row", F.posexplode(F.transform("_lines", each)).alias("pos", "w"))
    at = stage(at.select(*_PLACE, "w.*"), "lines")
    gone = repeated(at, min_lines, at.count())
    covered = gone.select("_row", F.explode(F.sequence("pos", F.col("pos") + F.col("depth") - 1)).alias("pos"))
    marks = covered.groupBy("_row").agg(F.sort_array(F.collect_set("pos")).alias("_at"))
    out = base.select("doc_id", "_row", "_lines").join(marks, "_row", "left").withColumn("_at", F.coalesce("_at", F.array().cast("array<int>")))
    n, k = F.coalesce(F.size("_lines"), F.lit(0)), F.size("_at")
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("_at", i - 1) + 1)
    end = lambda i: F.when(i == k, F.size("_lines")).otherwise(F.get("_at", i))
    piece = lambda i: F.slice("_lines", start(i) + 1, end(i) - start(i))
    out = out.withColumn("_kept", F.when(k == 0, F.col("_lines")).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), k), piece))))
    runs = F.size(F.filter(F.col("_at"), lambda x, i: (i == 0) | (x > F.get("_at", i - 1) + 1)))
    lines = F.when(F.col("_lines").isNull(), 0).otherwise(n)
    return out.select("doc_id", lines.cast("long").alias("n_lines"), k.cast("long").alias("n_removed"), runs.cast("long").alias("n_runs"), F.array_join("_kept", "\n").alias("kept_text"))
