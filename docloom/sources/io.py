"""Sources and sinks: PDF listing, Markdown, JSON lines (with the two forms of ``question``), checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.session import written

CHUNK = "id long, source string, title string, content string"
STAGE12 = "question string, docs array<string>, answer string, data_type string, pos_index array<int>, metadata struct<type:string,source_chunk_id:long>"


def pdfs(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """All PDFs under a folder: path, length, stem and, if asked for, content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(path)
    stem = F.regexp_extract("path", r"([^/]+)\.pdf\z", 1)
    return files.select("path", "length", stem.alias("stem"), *(["content"] if content else []))


def without_existing(files: DataFrame, made: DataFrame) -> DataFrame:
    """Files whose stem has no Markdown yet (made: stem); files of the same name in different folders count as one."""
    return files.join(made.select("stem").distinct(), "stem", "left_anti")


def page_ranges(files: DataFrame, block: int = 6, max_pages: int | None = None) -> DataFrame:
    """(path, stem, first, last) blocks of the pages of files with a column ``pages``."""
    n = F.col("pages") if max_pages is None else F.least("pages", F.lit(max_pages))
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(block)))
    return files.withColumn("first", F.explode(starts)).withColumn("last", F.least(F.col("first") + block - 1, n)).drop("pages")


def markdown(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """(source, md) of the ``*.md`` files of a folder, not of its subfolders; the first ``max_files`` by name."""
    files = spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True).select(F.col("_metadata.file_name").alias("source"), F.col("value").alias("md"))
    return files if max_files is None else files.orderBy("source").limit(max_files)


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines; blank ones are skipped, or fail if ``strict``."""
    lines, blank = spark.read.text(path), F.trim("value") == ""
    if strict:
        lines = lines.select(F.when(blank, F.raise_error(F.lit("blank line"))).otherwise(F.col("value")).alias("value"))
    else:
        lines = lines.filter(~blank)
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def stage1_lines(spark: SparkSession, path: str) -> DataFrame:
    """Stage-1 records; a ``question`` that is a plain string becomes a list of it."""
    v = F.try_parse_json("value")
    get = lambda field, kind: F.try_variant_get("v", f"$.{field}", kind).alias(field)
    question = F.coalesce(F.try_variant_get("v", "$.question", "array<string>"), F.array(F.try_variant_get("v", "$.question", "string")))
    rows = spark.read.text(path).filter(F.trim("value") != "").select(v.alias("v"))
    return rows.select(get("data_type", "string"), question.alias("question"), get("answers", "array<string>"), get("docs", "array<string>"), get("pos_index", "array<int>"))


def write_stage1(records: DataFrame, path: str, mode: str = "append") -> None:
    """As JSON lines; a paraphrase's question is written as an empty string."""
    plain = records.select("data_type", "question", "answers", "docs", "pos_index")
    listed = F.to_json(F.struct("data_type", "question", "answers", "docs", "pos_index"))
    single = F.to_json(F.struct("data_type", F.lit("").alias("question"), "answers", "docs", "pos_index"))
    plain.select(F.when(F.col("data_type") == "paraphrase", single).otherwise(listed).alias("value")).write.mode(mode).text(path)


def write_generated(stage1: DataFrame, stage12: DataFrame, windows: DataFrame, path1: str, path12: str, done: str, mode: str = "append") -> None:
    """Both record files are appended to, then the checkpoint: a run that breaks in between repeats its windows, and loses none."""
    write_stage1(stage1, path1, mode)
    write_json_lines(stage12, path12, mode)
    record_done(windows, done)


def write_layout(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A JSON list of {page, blocks} for each source, below ``path``/source=…; pages that are missing or have no layout are left out."""
    one = F.concat(F.lit('{"page": '), F.col("page").cast("string"), F.lit(', "blocks": '), F.col("blocks"), F.lit("}"))
    listed = pages.filter("not missing and blocks is not null").groupBy("source").agg(F.array_sort(F.collect_list(F.struct("page", one.alias("json")))).alias("p"))
    whole = F.concat(F.lit("["), F.array_join(F.transform("p", lambda x: x["json"]), ", "), F.lit("]"))
    listed.select("source", whole.alias("value")).write.mode(mode).partitionBy("source").text(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): every physical line with its 0-based number in its file. Lines are counted within the blocks that Spark reads, blocks are summed up; no task sees a whole file."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    rows = written(rows, "lines")
    sizes = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("file", "block", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1
    return rows.withColumn("own", own).join(before, ["file", "block"]).select("file", (F.col("own") + F.col("before")).alias("line"), "value")


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def record_done(windows: DataFrame, path: str, mode: str = "append") -> None:
    """Append (win_idx, status) to the checkpoint table."""
    windows.select("win_idx", "status", F.current_timestamp().alias("ts")).write.mode(mode).parquet(path)


def read_done(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("win_idx long, status string, ts timestamp").parquet(path)
