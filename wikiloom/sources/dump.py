"""Reading page dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import dump_date, dump_name

PAGE = "title STRING, id BIGINT, revision STRUCT<timestamp: STRING, text: STRING>"


def part_paths(path: str) -> str:
    """The glob of a split dump: X.0000[.ext] stands for all its parts; other paths stand for themselves."""
    head, dot, tail = path.partition(".0000")
    return f"{head}.[0-9][0-9][0-9][0-9]{tail}" if dot and (not tail or tail[1:].isalpha()) else path


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """raw pages (part, pos, id, title, timestamp, text, dump, date); .gz and .bz2 decode by suffix; null text is empty."""
    rows = spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(PAGE).load(part_paths(path))
    file = F.col("_metadata.file_path")
    return rows.select(file.alias("part"), F.monotonically_increasing_id().alias("pos"), "id", "title", F.coalesce("revision.timestamp", F.lit("")).alias("timestamp"), F.coalesce("revision.text", F.lit("")).alias("text"), dump_name(file).alias("dump"), dump_date(file).alias("date"))


def read_namespaces(spark: SparkSession, path: str) -> DataFrame:
    """(key, name) of the dump's header."""
    rows = spark.read.format("xml").option("rowTag", "namespace").schema("_key INT, _VALUE STRING").load(part_paths(path))
    return rows.select(F.col("_key").alias("key"), F.coalesce("_VALUE", F.lit("")).alias("name")).distinct()


def from_columns(df: DataFrame) -> DataFrame:
    """Raw pages from a DataFrame with id, title, text: position by id, in one part."""
    return df.select(F.lit("").alias("part"), F.col("id").cast("long").alias("pos"), F.col("id").cast("long").alias("id"), "title", F.lit("").alias("timestamp"), F.coalesce("text", F.lit("")).alias("text"))


def first_of_id(raw: DataFrame) -> DataFrame:
    """The first page of each id within a part."""
    return raw.withColumn("_n", F.row_number().over(Window.partitionBy("part", "id").orderBy("pos"))).where("_n = 1").drop("_n")


def read_header(spark: SparkSession, path: str, most: int = 2000) -> str:
    """The dump's lines up to the end of its site information (``most`` lines at most), the root without attributes."""
    out = []
    for (line,) in spark.read.text(path).limit(most).toLocalIterator():
        out.append("<mediawiki>" if line.startswith("<mediawiki ") else line)
        if "</siteinfo>" in line:
            return "\n".join(out) + "\n"
    return "<mediawiki>\n"
