"""Reading nested page documents and tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINE = T.StructType([
    T.StructField("uid", T.StringType()), T.StructField("line_index", T.IntegerType()), T.StructField("markdown", T.StringType()), T.StructField("cle", T.StringType()),
    T.StructField("word_confidence", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("line_bbox_estimate", T.ArrayType(T.IntegerType())),
    T.StructField("prediction", T.StringType()), T.StructField("provenance", T.StringType()), T.StructField("probability", T.DoubleType()), T.StructField("timestamp", T.StringType())])
_BLOCK = T.StructType([T.StructField("index", T.IntegerType()), T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("label", T.StringType()), T.StructField("chunk_index", T.IntegerType()), T.StructField("lines", T.ArrayType(_LINE))])
#: A page: as OCR gives it (raw, chunks) and as extraction completes it (data_blocks).
PAGE = T.StructType([
    T.StructField("page_index", T.IntegerType()), T.StructField("page_box", T.ArrayType(T.DoubleType())), T.StructField("chunks", T.ArrayType(T.StructType([T.StructField("bbox", T.ArrayType(T.DoubleType()))]))),
    T.StructField("raw", T.StringType()), T.StructField("data_blocks", T.ArrayType(_BLOCK)), T.StructField("_corrupt_record", T.StringType())])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """document (file name up to the last two suffixes), page_pos and the columns of PAGE; one JSON array of pages per file.

    A file that is no array of page objects fails the job.
    """
    rows = spark.read.schema(PAGE).option("columnNameOfCorruptRecord", "_corrupt_record").json(path, multiLine=True)
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.[A-Za-z_]+\.json$|\.json$", "")
    bad = F.raise_error(F.concat(F.lit("not a list of pages: "), name))
    return rows.select(name.alias("document"), *[F.when(F.col("_corrupt_record").isNotNull(), bad).otherwise(F.col("page_index")).cast("int").alias("page_index") if f.name == "page_index" else F.col(f.name) for f in PAGE.fields if f.name != "_corrupt_record"])


def nested(pages: DataFrame) -> DataFrame:
    """document, pages: the pages of each document as one array in page order, as operators.lines.walk takes them."""
    return pages.groupBy("document").agg(F.array_sort(F.collect_list(F.struct("page_index", "page_box", "data_blocks"))).alias("pages"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, every cell a string, empty cells empty strings."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    return df.na.fill("")


def read_patch(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A hand-edited CSV: cells stripped, missing columns empty, line numbers from 2; empty if there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], ", ".join(["line long", *[f"`{c}` string" for c in columns]]))
    df = read_table(spark, path).coalesce(1)  # a patch is edited by hand; its line numbers are those of one file
    cells = [F.regexp_replace(F.col(f"`{c}`"), r"(?U)^\s+|\s+$", "").alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    return df.select((F.monotonically_increasing_id() + 2).alias("line"), *cells)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_edited(spark: SparkSession, path: str) -> DataFrame | None:
    """A single CSV table as people left it, with pos from 0 in the order of the file; None if there is no file."""
    return read_table(spark, path).coalesce(1).withColumn("pos", F.monotonically_increasing_id()) if exists(spark, path) else None


def hashes(spark: SparkSession, *paths: str) -> DataFrame:
    """path, sha256 of files, folders of files and patterns."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path", F.sha2("content", 256).alias("sha256"))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """left_uuid, right_uuid, score (null where empty), source (learned where empty)."""
    df = read_table(spark, path)
    return df.select("left_uuid", "right_uuid", F.expr("nullif(score, '')").cast("double").alias("score"), F.coalesce(F.expr("nullif(source, '')"), F.lit("dedupe")).alias("source"))


def page_range(name: str) -> tuple[int, int]:
    """First and last page of a range name a-b; ValueError unless 1 <= a <= b."""
    m = re.fullmatch(r"(\d+)-(\d+)", name)
    if not m or not 1 <= int(m[1]) <= int(m[2]):
        raise ValueError(f"no range of pages: {name!r}")
    return int(m[1]), int(m[2])


def pair_name(left: str, right: str) -> str:
    """The name of a pair of volumes, as its files bear it."""
    if "__" in left or "__" in right:
        raise ValueError("a volume's name can't hold two underscores")
    return f"{left}__{right}"


def parse_pair(path: str) -> tuple[str, str, str]:
    """Left volume, right volume and suffix of the file of a pair: <left>__<right>.<suffix>; ValueError for any other."""
    m = re.fullmatch(r"(?:.*/)?([^/]+?)__([^/_](?:[^/]*?))((?:\.[A-Za-z-]+)+)", path)
    if not m or "__" in m[2]:
        raise ValueError(f"no file of a pair of volumes: {path!r}")
    return m[1], m[2], m[3]


def discover(spark: SparkSession, root: str, suffix: str, ranges: list[str] | None = None) -> DataFrame:
    """volume, range_name, first, last, path of the step files <root>/<volume>/<a>-<b>/...<suffix>, a <= b, a >= 1, in order.

    Folders that are no ranges are left out; ranges that are named must be ranges, and have files.
    """
    for name in ranges or ():
        page_range(name)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(root).select("path", "modificationTime")
    parts = files.select("path", "modificationTime", F.regexp_extract("path", r"/([^/]+)/(\d+)-(\d+)/[^/]+$", 1).alias("volume"), F.regexp_extract("path", r"/(\d+-\d+)/[^/]+$", 1).alias("range_name"))
    bounds = parts.withColumn("first", F.split("range_name", "-")[0].cast("int")).withColumn("last", F.split("range_name", "-")[1].cast("int"))
    found = bounds.where((F.col("volume") != "") & (F.col("first") >= 1) & (F.col("first") <= F.col("last")))
    if ranges is not None:
        found = found.where(F.col("range_name").isin(*ranges))
        if missing := set(ranges) - {r["range_name"] for r in found.select("range_name").distinct().collect()}:
            raise ValueError(f"no files of the ranges {sorted(missing)}")
    return found.orderBy("volume", "first", "last")


def number_records(records: DataFrame) -> DataFrame:
    """records(volume, range_first, pos) with order from 0 over the whole volume: numbers of a range, after those of the ranges before."""
    counts = records.groupBy("volume", "range_first").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("volume").orderBy("range_first").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("volume", "range_first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("volume", "range_first").orderBy("pos")) - 1
    return records.withColumn("__own", own).join(counts, ["volume", "range_first"]).withColumn("order", F.col("__own") + F.col("__before")).drop("__own", "__before")


def read_records(entities: DataFrame, title_key, anchor) -> DataFrame:
    """The ENTRY records of a volume, as alignment takes them, of entities (volume, range_first, pos, uuid, parent_uuid, entity, markdown, tagged_text, page).

    section and its title are those of the nearest heading, text and subject those without tags; order runs over all
    ranges. title_key, anchor: column functions that make a section's key and a text's plain form.
    """
    titles = entities.where(F.col("entity") == "TITLE").select("volume", F.col("uuid").alias("parent_uuid"), F.col("markdown").alias("section_title"))
    rows = number_records(entities.where(F.col("entity") == "ENTRY")).join(titles, ["volume", "parent_uuid"], "left")
    title = F.coalesce("section_title", F.lit(""))
    return rows.select("volume", "order", "uuid", F.col("parent_uuid").alias("section_uuid"), title.alias("section_title"), title_key(title).alias("section"), anchor(F.col("tagged_text")).alias("text"), "markdown", "tagged_text", "page")


def repeated_uuids(records: DataFrame) -> DataFrame:
    """volume, uuid, times of those that stand in several records: links can't tell these apart."""
    return records.groupBy("volume", "uuid").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > 1)
