"""Markdown to chunks: sections, tables of contents, page numbers, budgets.

Sections and the table-of-contents state are window scans within a source; the greedy packing runs inside one row's arrays. Everything is built-in expressions
unless a tokenizer is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators.splitting import split_sections
from docloom.session import running_sum, written

#: Defaults of the chunker: tokens in a chunk, words and characters below which one is dropped.
MAX_TOKENS, MIN_WORDS, MIN_CHARS = 1024, 10, 500
_MARK = "\u0001"
_TABLE = "\u0002"


def sections(docs: DataFrame) -> DataFrame:
    """(source, pos, header, body) at each level-2 heading outside tables of ``docs`` (source, md); pos 0 is what stands before the first, with header ''."""
    fixed = T.repair_tables(F.coalesce("md", F.lit("")))
    # Headings inside tables do not split
    parts = F.split(fixed, r"(?is)(?=<table[^>]*>)|(?<=</table>)")
    shielded = F.array_join(F.transform(parts, lambda x: F.when(x.rlike("(?i)^<table"), F.regexp_replace(x, r"(?m)^## ", _MARK + "## ")).otherwise(x)), "")
    split = docs.select("source", F.posexplode(F.split(shielded, r"(?md)(?=^## )")).alias("k", "part"))
    headed = F.col("part").startswith("## ")
    header = F.when(headed, F.regexp_extract("part", r"(?d)\A(.*)", 1)).otherwise(F.lit(""))
    body = F.when(headed, F.regexp_replace("part", r"(?d)\A.*\n?", "")).otherwise(F.col("part"))
    rows = split.select("source", "k", header.alias("header"), F.replace(body, F.lit(_MARK + "## "), F.lit("## ")).alias("body"))
    # A text that starts with a heading has an empty element before it
    first = F.min(F.when(F.col("header") != "", F.col("k"))).over(Window.partitionBy("source"))
    return rows.withColumn("first", first).withColumn("pos", F.when(F.col("header") == "", F.lit(0)).otherwise(F.col("k") - F.col("first") + 1).cast("int")).select("source", "pos", "header", "body")


def toc_states(parts: DataFrame) -> DataFrame:
    """``parts`` (of ``sections``) with page, is_page and in_toc: the state after the row of the two-state machine that skips tables of contents."""
    w = Window.partitionBy("source").orderBy("pos")
    head = T.stripped(F.col("header"))
    page_no = F.regexp_extract(head, r"^## Page (\d+)\z", 1)
    has_index = F.upper("body").contains("# INDICE")
    entry = T.is_toc_entry(head) | T.has_toc_lines(F.col("body")) | head.rlike(r"(?U)^##\s*\*.*\*\z")
    index_header = head.rlike(r"(?iU)^##\s*Indice")
    # Columns of their own are made once a row, however often they are named
    rows = parts.withColumns({"page_no": page_no, "prelude": F.col("pos") == 0, "has_index": has_index, "entry": entry, "index_header": index_header}).withColumn("is_page", F.col("page_no") != "")
    has_index, entry, index_header = F.col("has_index"), F.col("entry"), F.col("index_header")
    const = (
        F.when(F.col("prelude"), has_index.cast("int"))
        .when(F.col("is_page") & has_index, F.lit(1)).when(F.col("is_page"), F.lit(None))
        .when(index_header, F.lit(1)).when(has_index & entry, F.lit(1)).when(~has_index & ~entry, F.lit(0))
    )
    toggle = ~F.col("prelude") & ~F.col("is_page") & ~index_header & has_index & ~entry
    rows = rows.withColumn("const", const).withColumn("toggle", toggle.cast("int")).withColumn("seg", F.count("const").over(w))
    flips = F.sum("toggle").over(Window.partitionBy("source", "seg").orderBy("pos"))
    rows = rows.withColumn("in_toc", ((F.coalesce(F.last("const", ignorenulls=True).over(w), F.lit(0)) + flips) % 2) == 1)
    rows = rows.withColumn("page", F.coalesce(F.last(F.when(F.col("is_page"), F.col("page_no")), ignorenulls=True).over(w), F.lit("N/A")))
    return rows.select("source", "pos", "header", "body", "is_page", "in_toc", "page")


def assembled(states: DataFrame) -> DataFrame:
    """(source, sec, title, body, page): each section with the page bodies that follow it; its page is the one it ends on. Rows inside a table of contents go."""
    w = Window.partitionBy("source").orderBy("pos")
    opens = (~F.col("is_page") & ~F.col("in_toc")) | (F.col("pos") == 0)
    # A table-of-contents entry ends a section too: what follows it belongs to nothing until the next start
    cut = opens | (~F.col("is_page") & F.col("in_toc"))
    rows = states.withColumn("grp", F.sum(cut.cast("int")).over(w)).filter(~F.col("in_toc"))
    started = F.max(opens.cast("int")).over(Window.partitionBy("source", "grp")) == 1
    rows = rows.withColumn("started", started).filter("started")
    listed = rows.groupBy("source", "grp").agg(F.array_sort(F.collect_list(F.struct("pos", "header", "body", "page"))).alias("r"))
    body = F.aggregate(
        F.slice("r", 2, F.greatest(F.size("r"), F.lit(1))), T.stripped(F.col("r")[0]["body"]),
        lambda acc, x: F.when(T.stripped(x["body"]) == "", acc).when(T.joins_previous(acc), F.concat_ws(" ", acc, T.stripped(x["body"]))).when(acc == "", T.stripped(x["body"])).otherwise(F.concat(acc, F.lit("\n\n"), T.stripped(x["body"]))),
    )
    title = F.when(F.col("r")[0]["pos"] == 0, F.lit("Introduzione")).otherwise(F.col("r")[0]["header"])
    return listed.select("source", F.col("r")[0]["pos"].alias("sec"), title.alias("title"), body.alias("body"), F.element_at("r", -1)["page"].alias("page"))


def useful(sections_: DataFrame) -> DataFrame:
    """Without empty sections, leftovers of broken tables, boilerplate titles and bodies that are mostly a table of contents."""
    keep = (T.stripped(F.col("body")) != "") & ~F.col("title").startswith("TOC -") & ~F.col("body").startswith("</table>") & ~T.is_boilerplate(F.col("title")) & ~(T.toc_ratio(F.col("body")) > 0.3)
    return sections_.filter(keep)


def split_long(body, budget, count=T.word_count):
    """Legal items first; then paragraphs, packed with each table counted as one mark. Where the tables themselves do not fit, they are cut by rows between the texts around them."""

    def with_tables(x):
        return T.let(T.tables(x), lambda found: around(x, found))

    def around(x, found):
        between = F.split(x, r"(?is)<table[^>]*>.*?</table>")
        marked = F.array_join(F.transform(between, lambda y, i: F.when(i < F.size(found), F.concat(y, F.lit(_TABLE), i.cast("string"), F.lit(_TABLE))).otherwise(y)), "")

        def restored(part):
            # Every second piece is the number of a table
            pieces = F.transform(F.split(part, _TABLE), lambda y, i: F.when(i % 2 == 1, F.get(found, F.try_to_number(y, F.lit("999999999")).cast("int"))).otherwise(y))
            return T.let(pieces, whole_or_apart)

        def whole_or_apart(pieces):
            whole = F.array_join(pieces, "")
            apart = F.flatten(F.transform(pieces, lambda y, i: F.when(i % 2 == 1, T.split_table(y, budget, count)).when(T.stripped(y) != "", F.array(T.stripped(y))).otherwise(F.array().cast("array<string>"))))
            return F.when((F.size(pieces) == 1) | (count(whole) <= budget), F.array(whole)).otherwise(apart)

        packed = F.flatten(F.transform(T.paragraph_pack(marked, budget, count, T.simple_sentences), restored))
        return F.when(F.size(found) > 0, packed).otherwise(T.paragraph_pack(x, budget, count))

    return F.flatten(F.transform(T.legal_split(body, budget, count), with_tables))


def chunks(docs: DataFrame, max_tokens: int = MAX_TOKENS, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, make_tokenizer=None) -> DataFrame:
    """(source, seq, title, content) of Markdown documents (source, md): the whole chunker. seq orders a source's chunks. The content begins
    with a line on the source and the heading as it stands; a part that stays above the budget is cut, so no chunk holds more than ``max_tokens``: words, counted by built-in
    expressions, or the tokens of what ``make_tokenizer`` returns (``splitting.Subwords``), counted in Arrow batches."""
    rows = useful(assembled(toc_states(sections(docs))))
    meta = T.file_metadata(F.coalesce("source", F.lit("")))
    rows = rows.withColumn("m", meta).withColumn("clean", T.clean_title(F.col("title")))
    line = F.concat(F.lit("> "), F.col("m.source_cleaned"), F.lit(" "), F.col("m.year"), F.lit(" | "), F.col("m.topic"), F.lit(" | p."), F.col("page"), F.lit(" <\n\n"))
    rows = rows.withColumn("lead", F.concat(line, T.stripped(F.col("title")), F.lit("\n\n")))
    if make_tokenizer is not None:
        made = split_sections(rows, make_tokenizer, max_tokens, min_words).withColumn("content", T.balance_tables(F.col("content")))
    else:
        rows = rows.withColumn("budget", F.lit(max_tokens) - T.word_count(F.col("lead")))
        # Within the generator, so that the filter on the content does not make it a second time
        content = lambda x: T.let(F.concat("lead", T.stripped(x)), lambda c: T.balance_tables(T.truncated(c, max_tokens)))
        contents = F.transform(split_long(F.col("body"), F.col("budget")), lambda x: F.when(T.word_count(x) >= min_words, content(x)))
        made = rows.select("source", "sec", "clean", F.posexplode(contents).alias("k", "content"))
    kept = made.filter(T.content_length(F.col("content")) >= min_chars)
    order = Window.partitionBy("source").orderBy("sec", "k")
    return kept.select("source", (F.row_number().over(order) - 1).alias("seq"), F.col("clean").alias("title"), "content")


def with_ids(chunks_: DataFrame) -> DataFrame:
    """Dense 0-based ids by (source, seq): a position within the source plus the sizes of the sources before."""
    chunks_ = written(chunks_, "chunks")
    sizes = running_sum(chunks_.groupBy("source").agg(F.count(F.lit(1)).alias("size")), "source", "size", "upto")
    before = sizes.select(F.col("source").alias("same"), (F.col("upto") - F.col("size")).alias("before"))
    own = F.row_number().over(Window.partitionBy("source").orderBy("seq")) - 1
    return chunks_.withColumn("own", own).join(before, F.col("source").eqNullSafe(F.col("same"))).select((F.col("own") + F.col("before")).cast("long").alias("id"), "source", "title", "content")


def pages_markdown(pages: DataFrame) -> DataFrame:
    """(source, md) from OCR pages (source, page, text): a title, then each page under its heading; pages without text are left out."""
    one = lambda x: F.concat(F.lit("## Page "), x["page"].cast("string"), F.lit("\n\n"), x["text"], F.lit("\n\n---\n\n"))
    listed = pages.filter(F.col("text").isNotNull()).groupBy("source").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("p"))
    return listed.select("source", F.concat(F.lit("# "), F.col("source").cast("string"), F.lit("\n\n"), F.array_join(F.transform("p", one), "")).alias("md"))
