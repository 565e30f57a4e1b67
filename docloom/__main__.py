"""Command lines: ``python -m docloom chunk | convert | generate | judge``. Models are named as ``module:function``."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docloom.session import ship_package, written


def named(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docloom", description=__doc__)
    kinds = top.add_subparsers(dest="command", required=True)

    chunk = kinds.add_parser("chunk", help="Markdown files to chunks as JSON lines")
    chunk.add_argument("--max-files", type=int)
    chunk.add_argument("--max-tokens", type=int, default=1024)
    chunk.add_argument("--tokenizer", help="a tokenizers file that every executor can read; words are counted without it")

    convert = kinds.add_parser("convert", help="PDF files to Markdown")
    convert.add_argument("--count", type=named, required=True, help="bytes of a file to its number of pages")
    convert.add_argument("--render", type=named, required=True, help="bytes, first and last page to (page, PNG) pairs")
    convert.add_argument("--model", type=named, required=True, help="makes a function from an image to its text")
    convert.add_argument("--layout", type=named, help="image to a list of blocks")
    convert.add_argument("--max-pages", type=int)
    convert.add_argument("--chunk-size", type=int, default=6, help="pages in a block")
    convert.add_argument("--debug", action="store_true", help="keep the images of the pages")

    generate = kinds.add_parser("generate", help="chunks to records of stages 1 and 1.2")
    generate.add_argument("--client", type=named, required=True, help="makes a function from a prompt to a response")
    generate.add_argument("--template", required=True, help="file with the prompt; {windows_text} is the window")
    generate.add_argument("--workers", type=int, default=4, help="calls at a time")
    generate.add_argument("--start", type=int, help="first window; resuming is off then")
    generate.add_argument("--limit", type=int)
    generate.add_argument("--clear", action="store_true", help="drop what was made before")
    generate.add_argument("--no-resume", action="store_true")

    judge = kinds.add_parser("judge", help="stage-1 records that a judge lets pass")
    judge.add_argument("--client", type=named, required=True)
    judge.add_argument("--template", help="file with {doc}, {question} and {answer}")
    judge.add_argument("--least", type=int, default=4)
    for kind in (chunk, convert, generate, judge):
        kind.add_argument("input")
        kind.add_argument("output")
    return top


def run_chunk(spark: SparkSession, a) -> None:
    from docloom.operators.chunking import chunks, with_ids
    from docloom.operators.splitting import Subwords
    from docloom.sources import io

    path = a.tokenizer
    made = chunks(io.markdown(spark, a.input, a.max_files), a.max_tokens, make_tokenizer=(lambda: Subwords(path)) if path else None)
    io.write_json_lines(with_ids(written(made, "chunks")), a.output, "overwrite")


def run_convert(spark: SparkSession, a) -> None:
    from docloom.operators import conversion
    from docloom.sources import io

    md, pages, report = conversion.convert(io.pdfs(spark, a.input), conversion.existing(spark, f"{a.output}/md"), a.count, a.render, a.model, a.chunk_size, a.max_pages, a.layout, a.debug)
    conversion.write_markdown(md, f"{a.output}/md")
    if a.layout:
        io.write_layout(pages, f"{a.output}/layout", "append")
    if a.debug:
        pages.filter("not missing").select("source", "page", "image").write.mode("append").parquet(f"{a.output}/debug")
    report.write.mode("append").json(f"{a.output}/report")


def run_generate(spark: SparkSession, a) -> None:
    from docloom.operators import generation, prompts, records, windows
    from docloom.sources import io

    done = f"{a.output}/done"
    mode = "overwrite" if a.clear else "append"
    # The table is there from the first run on, so that it can be read
    io.record_done(spark.createDataFrame([], "win_idx long, status string"), done, "overwrite" if a.clear or a.no_resume else "append")
    chunks = io.json_lines(spark, a.input, io.CHUNK)
    found = windows.window_contents(windows.adaptive_windows(chunks)).withColumnRenamed("rn", "win_idx")
    asked = generation.to_do(found, io.read_done(spark, done), a.start, a.limit)
    with open(a.template, encoding="utf-8") as f:
        template = f.read()
    prompt = prompts.filled(template, windows_text=windows.window_text(F.col("chunks"), F.col("center_idx")))
    asked = written(asked.withColumn("prompt", prompt), "asked")
    made = written(generation.generate(asked.repartition(a.workers), a.client), "responses")
    center = F.get("chunks", "center_idx")
    parsed = records.parsed(made.withColumnRenamed("ok", "called").drop("error").join(asked, "win_idx").withColumn("docs", F.transform("chunks", lambda c: c["content"])).withColumn("center_id", center["id"]))
    parsed = parsed.withColumn("ok", F.col("ok") & F.col("called"))
    state = parsed.select("win_idx", F.when(F.col("ok"), "processed").otherwise("failed").alias("status"))
    io.write_generated(records.stage1(parsed), records.stage12(parsed), state, f"{a.output}/stage1", f"{a.output}/stage12", done, mode)


def run_judge(spark: SparkSession, a) -> None:
    from docloom.operators import generation, prompts
    from docloom.sources import io

    template = prompts.JUDGE
    if a.template:
        with open(a.template, encoding="utf-8") as f:
            template = f.read()
    io.write_stage1(generation.judge(io.stage1_lines(spark, a.input), a.client, template, a.least), a.output, "overwrite")


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"docloom {a.command}").getOrCreate()
    ship_package(spark)
    globals()[f"run_{a.command}"](spark, a)


if __name__ == "__main__":
    main()
