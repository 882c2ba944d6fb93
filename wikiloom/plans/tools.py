"""Dataset tools: sample, split, merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw(id_: Column, seed: int, n: int) -> Column:
    """0 to n - 1 by a multiplicative hash of the id: plain arithmetic, the same in any engine."""
    h = F.pmod(F.pmod(id_, F.lit(1 << 31)) * F.lit(2654435761) + F.lit(seed * 40503 + 12345), F.lit(1 << 32))
    return F.pmod(F.shiftright(h, 16), F.lit(n))


def sample_pages(raw: DataFrame, one_in: int = 500, cap: int | None = 5000, template_prefix: str = "Template:") -> DataFrame:
    """About one page in ``one_in``, by hash of the id, ``cap`` at most; templates always stay."""
    keep = raw.title.startswith(template_prefix)
    drawn = raw.where(~keep & (draw(F.col("id"), 0, one_in) == 1 % one_in))
    return raw.where(keep).unionByName(drawn if cap is None else drawn.orderBy("pos").limit(cap))


def split_pages(raw: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Adds split, 0 to n - 1, by seeded hash of the id; write with partitionBy("split")."""
    return raw.withColumn("split", draw(F.col("id"), seed, n).cast("int"))


def merge_pages(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with pages of ``new`` in place of those with the same id, and the others of ``new`` added; status says which."""
    o, n = old.alias("o"), new.alias("n")
    here, there = F.col("n.id").isNotNull(), F.col("o.id").isNotNull()
    status = F.when(here & there, "updated").when(here, "new").otherwise("unmodified")
    return o.join(n, F.col("o.id") == F.col("n.id"), "full").select(*[F.when(here, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in old.columns], status.alias("status"))


def merge_counts(merged: DataFrame) -> DataFrame:
    """(status, n): pages updated, new and unmodified."""
    return merged.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
