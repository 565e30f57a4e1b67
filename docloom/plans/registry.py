"""The library's queries over the shared test tables, each with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.numbers import missing_numbers, numbers
from docloom.operators import chunking as C
from docloom.operators import generation as G
from docloom.operators import records as R
from docloom.operators import retrieval as B
from docloom.operators import review as V
from docloom.operators import windows as W
from docloom.plans import fixtures as X
from docloom.plans.oracle import ORACLE_SQL  # noqa: F401
from docloom.session import ship_package, written

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def literal(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def joined(c):
    return F.array_join(c, "\x1f")


@query
def bm25_tokens(spark, sf):
    tokens = T.bm25_tokens(F.col("text"))
    return t(spark, sf, "documents").select("doc_id", F.size(tokens).alias("n_tokens"), F.md5(F.array_join(tokens, " ")).alias("tokens_md5"))


@query
def bm25_df_tf(spark, sf):
    return B.term_statistics(B.bags(t(spark, sf, "documents"))).filter("term IS NOT NULL").select("term", "df", F.col("total").alias("total_tf"))


def ranked(spark, sf):
    return B.bm25(t(spark, sf, "documents"), t(spark, sf, "benchmark"))


@query
def bm25_topk(spark, sf):
    return ranked(spark, sf).select(F.col("question").alias("item_id"), F.col("doc").alias("doc_id"), "rank", "score")


def negatives(spark, sf):
    best = written(ranked(spark, sf), "ranked")
    docs = t(spark, sf, "documents")
    gold = best.filter("rank = 1").select("question", "doc")
    return docs, gold, written(B.hard_negatives(best, docs, gold), "hard")


@query
def hard_negatives(spark, sf):
    return negatives(spark, sf)[2].select(F.col("question").alias("item_id"), F.col("doc").alias("doc_id"), "place")


def randoms(spark, sf):
    docs, gold, hard = negatives(spark, sf)
    return docs, gold, hard, B.random_negatives(gold, docs, gold.union(hard.select("question", "doc")), 12)


@query
def random_negatives(spark, sf):
    return randoms(spark, sf)[3].select(F.col("question").alias("item_id"), F.col("doc").alias("doc_id"), "place")


@query
def stage3_pool(spark, sf):
    docs, gold, hard, rest = randoms(spark, sf)
    made = B.pool(gold, hard, rest, docs)
    return made.select(F.col("question").alias("item_id"), F.size("docs").alias("n_docs"), F.array_join("doc_ids", ",").alias("doc_ids"), F.array_join("pos_index", ",").alias("pos_index"))


def sentence(order):
    """A sentence with amounts, dates and references, from an order's key."""
    k = F.col(order)
    s = lambda c: c.cast("string")
    return F.concat(
        F.lit("Art. "), s(k % 200), F.lit(" comma "), s(k % 9 + 1), F.lit(": entro il "), s(k % 28 + 1), F.lit("/03/"), s(2000 + k % 30),
        F.lit(" versare € "), s(k % 900 + 1), F.lit(".500,"), s(k % 90 + 10), F.lit(" pari al "), s(k % 40), F.lit(",5 % in "), s(k % 120 + 1),
        F.lit(" rate, L. "), s(k % 400 + 1), F.lit("/2012"),
    )


@query
def number_extract(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", F.array_join(F.array_sort(numbers(sentence("o_orderkey"))), "|").alias("numbers"))


@query
def number_gate(spark, sf):
    answer = F.concat(F.lit("Art. "), (F.col("o_orderkey") % 100).cast("string"), F.lit(" comma "), (F.col("o_orderkey") % 9 + 1).cast("string"))
    question = F.concat(F.lit("Art. "), (F.col("o_orderkey") % 200).cast("string"), F.lit(" comma "), (F.col("o_orderkey") % 9 + 1).cast("string"))
    missing = missing_numbers(question, answer)
    return t(spark, sf, "orders").select("o_orderkey", (F.size(missing) == 0).alias("valid"), F.array_join(missing, "|").alias("missing"))


@query
def number_cases(spark, sf):
    return literal(spark, X.NUMBERS, "id int, text string, want string").select("id", F.array_join(F.array_sort(numbers(F.col("text"))), "|").alias("numbers"))


@query
def filename_metadata(spark, sf):
    return literal(spark, X.FILES, "name string").select("name", T.file_metadata(F.col("name")).alias("m")).select("name", "m.year", "m.topic", "m.source_cleaned")


def talk(spark, sf):
    return t(spark, sf, "conversations").select(F.col("conv_id").alias("source"), F.col("turn").alias("id"), F.col("role").alias("title"), F.col("text").alias("content"))


@query
def adaptive_windows(spark, sf):
    return W.adaptive_windows(talk(spark, sf)).select("source", "id", "rn", "win_start", "win_end", "center_idx")


@query
def adaptive_windows_per_source(spark, sf):
    return W.adaptive_windows(talk(spark, sf), cross_source=False).select("source", "id", "rn", "win_start", "win_end", "center_idx")


@query
def window_text(spark, sf):
    got = W.window_contents(W.adaptive_windows(talk(spark, sf)))
    return got.select("rn", F.md5(W.window_text(F.col("chunks"), F.col("center_idx"))).alias("text_md5"))


@query
def window_size_stats(spark, sf):
    size = F.col("win_end") - F.col("win_start")
    return W.adaptive_windows(talk(spark, sf)).agg(F.min(size).alias("min_size"), F.max(size).alias("max_size"), F.round(F.avg(size), 6).alias("avg_size"), F.count(F.lit(1)).alias("n"))


@query
def resume_to_do(spark, sf):
    e = t(spark, sf, "events")
    done = e.filter(F.col("event_id") % 3 != 0).select(F.col("event_id").alias("win_idx"), F.when(F.col("event_id") % 5 == 0, "failed").otherwise("processed").alias("status"))
    return G.to_do(e.select(F.col("event_id").alias("win_idx")), done)


@query
def checkpoint_progress(spark, sf):
    return G.progress(t(spark, sf, "events").select(F.col("user_id").alias("win_idx"), F.when(F.col("event_id") % 5 == 0, "failed").otherwise("processed").alias("status")))


def tabled():
    """Page html with its list as a table."""
    return F.replace(F.replace(F.replace(F.replace("html", F.lit("<ul>"), F.lit("<table>")), F.lit("</ul>"), F.lit("</table>")), F.lit("<li>"), F.lit("<tr><td>")), F.lit("</li>"), F.lit("</td></tr>"))


@query
def table_extract(spark, sf):
    found = T.tables(tabled())
    return t(spark, sf, "pages").select("page_id", F.size(found).alias("n_tables"), F.md5(F.array_join(found, "|")).alias("tables_md5"), T.has_table(tabled()).alias("has_table"))


@query
def table_repair(spark, sf):
    return literal(spark, X.TABLES, "id int, text string").select("id", T.repair_tables(F.col("text")).alias("repaired"))


@query
def table_balance(spark, sf):
    return literal(spark, X.TABLES, "id int, text string").select("id", T.balance_tables(F.col("text")).alias("balanced"))


@query
def table_rowsplit(spark, sf):
    row = F.concat(F.lit("<table><tr><th>k v</th></tr>"), F.array_join(F.transform(F.sequence(F.lit(1), F.col("p_size").cast("int")), lambda i: F.concat(F.lit("<tr><td>r "), i.cast("string"), F.lit("</td></tr>"))), ""), F.lit("</table>"))
    parts = T.split_table(row, 20)
    # A table of small rows lies in few splits, but each row is long work
    rows = t(spark, sf, "part").select("p_partkey", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    made = rows.select("p_partkey", parts.alias("parts"))
    return made.select("p_partkey", F.size("parts").alias("n_parts"), F.md5(F.array_join("parts", "|")).alias("parts_md5"))


@query
def content_length_filter(spark, sf):
    return t(spark, sf, "documents").select("doc_id", T.content_length(F.col("text")).alias("n")).filter("n >= 500")


@query
def min_words_filter(spark, sf):
    return t(spark, sf, "documents").select("doc_id", T.word_count(F.col("text")).alias("n_words")).filter("n_words >= 10")


@query
def boilerplate_filter(spark, sf):
    return literal(spark, X.TITLES, "title string").select("title", T.clean_title(F.col("title")).alias("clean"), T.is_boilerplate(F.col("title")).alias("boilerplate"), T.is_toc_entry(F.col("title")).alias("toc_entry"))


@query
def toc_line_ratio(spark, sf):
    body = F.replace("text", F.lit("."), F.lit(" .. 12"))
    return t(spark, sf, "documents").select("doc_id", T.toc_lines(body).alias("n_toc"), F.round(T.toc_ratio(body), 6).alias("ratio"))


@query
def toc_clean(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.md5(T.clean_toc_lines(F.replace("text", F.lit("."), F.lit(" .. 12")))).alias("clean_md5"))


def derived(spark, sf):
    """Markdown from documents: lines become headings, sentences body lines."""
    md = F.replace(F.replace("text", F.lit("\n"), F.lit("\n## ")), F.lit(". "), F.lit(".\n"))
    return t(spark, sf, "documents").select(F.col("doc_id").alias("source"), md.alias("md"))


@query
def section_split(spark, sf):
    return C.sections(derived(spark, sf)).select("source", "pos", "header", F.md5("body").alias("body_md5"))


@query
def toc_state(spark, sf):
    return C.toc_states(C.sections(literal(spark, X.MARKDOWN, "source string, md string"))).select("source", "pos", "is_page", "in_toc", "page")


@query
def toc_state_documents(spark, sf):
    return C.toc_states(C.sections(derived(spark, sf))).select("source", "pos", "in_toc")


@query
def section_assemble(spark, sf):
    return C.assembled(C.toc_states(C.sections(literal(spark, X.MARKDOWN, "source string, md string")))).select("source", "sec", "title", "body", "page")


@query
def chunk_documents(spark, sf):
    name = F.concat(F.lit("Manuale_IVA_2025_"), F.col("source").cast("string"), F.lit(".md"))
    md = derived(spark, sf).select(name.alias("source"), "md")
    return C.with_ids(C.chunks(md, max_tokens=128, min_words=5, min_chars=100)).select("id", "source", "title", F.length("content").alias("n_chars"))


@query
def sentence_split(spark, sf):
    return literal(spark, X.SENTENCES, "id int, text string, want string").select("id", F.array_join(T.sentences(F.col("text")), "|").alias("sentences"))


@query
def sentence_split_documents(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.size(T.sentences(F.col("text"))).alias("n_sentences"), F.size(T.simple_sentences(F.col("text"))).alias("n_simple"))


@query
def paragraph_pack(spark, sf):
    parts = T.paragraph_pack(F.replace("text", F.lit("\n"), F.lit("\n\n")), 100)
    return t(spark, sf, "documents").select("doc_id", F.size(parts).alias("n_parts"), F.array_max(F.transform(parts, T.word_count)).alias("largest"))


@query
def legal_split(spark, sf):
    lines = F.split("text", "\n")
    items = F.array_join(F.transform(lines, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("\n*"), F.char(97 + i % 26), F.lit(")* "), x))), "")
    parts = T.legal_split(items, 120)
    return t(spark, sf, "documents").select("doc_id", F.size(parts).alias("n_parts"), F.size(lines).alias("n_items"))


@query
def safe_json(spark, sf):
    e = t(spark, sf, "events")
    noisy = F.concat(F.when(F.col("event_id") % 2 == 0, "Ecco: ").otherwise(""), F.col("props"), F.when(F.col("event_id") % 3 == 0, " fine").otherwise(""))
    return e.select("event_id", F.try_variant_get(T.safe_json(noisy), "$.k", "long").alias("k"))


def parsed(spark, sf):
    docs = F.array(F.lit("prima"), F.lit("centro"), F.lit("dopo"))
    rows = literal(spark, X.RESPONSES, "win_idx long, response string").select("win_idx", "response", docs.alias("docs"), F.lit(1).alias("center_idx"), (F.col("win_idx") + 100).alias("center_id"))
    return R.parsed(rows)


@query
def stage1_records(spark, sf):
    return R.stage1(parsed(spark, sf)).select("win_idx", "data_type", F.array_join("question", "|").alias("question"), F.array_join("answers", "|").alias("answers"), F.array_join("docs", "|").alias("docs"))


@query
def stage12_records(spark, sf):
    return R.stage12(parsed(spark, sf)).select("win_idx", "question", "answer", F.array_join("docs", "|").alias("docs"), F.array_join("pos_index", "|").alias("pos_index"), F.col("metadata.type").alias("type"), F.col("metadata.source_chunk_id").alias("source_chunk_id"))


@query
def qa_gate_statistics(spark, sf):
    return R.gate_statistics(parsed(spark, sf))


@query
def judge_allpass(spark, sf):
    d, q = t(spark, sf, "documents"), t(spark, sf, "labels")
    records = d.groupBy(F.col("source").alias("rec")).agg(F.count(F.lit(1)).alias("n")).withColumn("data_type", F.when(F.col("rec") == "src1", "paraphrase").otherwise("qa"))
    scores = d.join(q, "doc_id").select(F.col("source").alias("rec"), F.when(F.col("quality") == 1, 5).otherwise(2).alias("score"))
    return R.judged(records, scores)


def reviews(spark, sf):
    d = t(spark, sf, "documents").select((F.col("doc_id")).alias("line"), F.when(F.col("lang") == "en", "qa").otherwise("paraphrase").alias("data_type"), "text")
    c = t(spark, sf, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("line"), F.lit("qa").alias("data_type"), "text", "role")
    b = t(spark, sf, "benchmark").select(F.col("item_id").alias("line"), F.lit("qa").alias("data_type"), "text")
    q = t(spark, sf, "labels")
    state = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "approved").when(F.col("quality") == 1, "flagged").otherwise("rejected")
    return V.review_set(raw=d, s2=c, s3=b), q.select(F.concat(F.lit("raw_"), F.col("doc_id").cast("string")).alias("_id"), state.alias("status"))


@query
def review_union(spark, sf):
    return reviews(spark, sf)[0].groupBy("_stage", "data_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_id").alias("ids"))


@query
def review_filter(spark, sf):
    rows, status = reviews(spark, sf)
    return V.filtered(V.with_status(rows, status), stage="raw", data_type="qa", status="pending").select("_id", "_status")


@query
def review_page(spark, sf):
    rows, status = reviews(spark, sf)
    return V.page(V.with_status(rows, status), 3).select("_id", "_stage", "_status")


@query
def review_stats(spark, sf):
    return V.statistics(*reviews(spark, sf))


@query
def review_upsert(spark, sf):
    _, status = reviews(spark, sf)
    event = t(spark, sf, "events").select(F.concat(F.lit("raw_"), F.col("user_id").cast("string")).alias("_id"), F.element_at(F.array(*[F.lit(x) for x in ("approved", "rejected", "flagged", "pending", "unknown")]), (F.col("event_id") % 5 + 1).cast("int")).alias("status"), F.col("event_id").alias("seq"))
    return V.upsert(status, event)


@query
def review_export(spark, sf):
    rows, status = reviews(spark, sf)
    return V.approved(rows, status).select("line", "data_type", F.md5("text").alias("text_md5"))


@query
def page_markdown_sink(spark, sf):
    pages = t(spark, sf, "conversations").select(F.col("conv_id").alias("source"), F.col("turn").cast("int").alias("page"), "text")
    return C.pages_markdown(pages).select("source", F.md5("md").alias("md_md5"))


@query
def layout_resize_dims(spark, sf):
    r = T.resized((F.col("p_partkey") * 37 % 5000 + 1).cast("int"), (F.col("p_size") * 100).cast("int"))
    return t(spark, sf, "part").select("p_partkey", r["width"].alias("width"), r["height"].alias("height"))


@query
def page_ranges(spark, sf):
    from docloom.sources.io import page_ranges as ranges

    files = t(spark, sf, "part").select(F.col("p_partkey").alias("stem"), F.col("p_size").cast("int").alias("pages"))
    return ranges(files, 6, 20).select("stem", "first", "last")


@query
def generate_offline(spark, sf):
    from docloom.models import echo_client

    prompts = t(spark, sf, "documents").select(F.col("doc_id").alias("win_idx"), F.col("text").alias("prompt"))
    return G.generate(prompts, echo_client).select("win_idx", "ok", F.get_json_object("response", "$.mixed_qas[0].a").alias("answer"))
