"""PDF folders to Markdown files: list, count, cut into blocks, render, read, assemble, write; each file's run is independent of the others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.models import OcrModel, page_counts, read_pages
from docloom.operators.chunking import pages_markdown
from docloom.session import written
from docloom.sources import io


def existing(spark: SparkSession, path: str) -> DataFrame:
    """(stem) of the Markdown files in a folder; none if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "stem string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.md\z", 1).alias("stem"))


def convert(
    pdfs: DataFrame, made: DataFrame, count: Callable[[bytes], int], render, make_model: Callable[[], OcrModel], block: int = 6, max_pages: int | None = None, layout=None, debug: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Markdown (source, md), pages (source, page, text, missing, image, blocks) and a report (source, pages, missing) of the files (stem, content) that have no Markdown in ``made`` (stem).
    Pages are read once and written. Blocks of pages are dealt anew, so that one long file is read by many tasks. Images are kept for ``debug``."""
    files = page_counts(io.without_existing(pdfs, made), count)
    blocks = io.page_ranges(files, block, max_pages).repartition("stem", "first")
    pages = written(read_pages(blocks, render, make_model, layout, debug), "pages")
    report = pages.groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.count_if("missing").alias("missing"))
    return pages_markdown(pages.select("source", "page", "text")), pages, report


def write_markdown(texts: DataFrame, path: str, mode: str = "append") -> None:
    """One folder ``source=…`` with a Markdown text for each source."""
    texts.select("source", F.col("md").alias("value")).write.mode(mode).option("lineSep", "\n").partitionBy("source").text(path)
