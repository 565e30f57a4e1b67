"""Training records from model output: shape check, number gate, stage 1, stage 1.2, judge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.numbers import missing_numbers
from docloom.functions.text import safe_json, without_fence

_QA = "array<struct<type:string,q:string,a:string>>"
CATEGORIES = ("mixed_qas", "simple_qas", "complex_qas", "multi_hop_qas", "evolution_qas")
HEAVY = ("complex_qas", "multi_hop_qas", "evolution_qas")


def parsed(outputs: DataFrame) -> DataFrame:
    """``outputs`` (…, response) with ok and the five lists and paraphrase. A response that does not parse, or holds an item that is no object or has a null q, is not ok."""
    value = safe_json(without_fence(F.col("response")))
    rows = outputs.withColumn("v", value)
    lists = {c: F.coalesce(F.try_variant_get("v", f"$.{c}", _QA), F.array().cast(_QA)) for c in CATEGORIES}
    raw = {c: F.size(F.coalesce(F.try_variant_get("v", f"$.{c}", "array<variant>"), F.array())) for c in CATEGORIES}
    rows = rows.withColumns(lists | {"paraphrase": F.try_variant_get("v", "$.paraphrase", "string")})
    ok = F.col("v").isNotNull()
    for c in CATEGORIES:
        ok = ok & (F.size(c) == raw[c]) & F.forall(c, lambda x: x.isNotNull())
    return rows.withColumn("ok", F.coalesce(ok, F.lit(False))).drop("v")


def gated(c):
    """Items whose answer keeps all numbers of the question."""
    t = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)^\s+|\s+\z", "")
    items = F.transform(c, lambda x: F.struct(x["type"].alias("type"), t(x["q"]).alias("q"), t(x["a"]).alias("a")))
    return F.filter(items, lambda x: F.size(missing_numbers(x["q"], x["a"])) == 0)


def stage1(windows: DataFrame) -> DataFrame:
    """(win_idx, data_type, question, answers, docs, pos_index) of parsed windows (win_idx, docs, center_idx, lists): the gated questions and the paraphrase."""
    rows = windows.filter("ok").withColumn("source_qas", F.when(F.size("mixed_qas") > 0, F.col("mixed_qas")).otherwise(F.col("simple_qas"))).withColumn("g", gated(F.col("source_qas")))
    center = F.array(F.get("docs", "center_idx"))
    zero = F.array(F.lit(0))
    qa = rows.filter(F.size("g") > 0).select("win_idx", F.lit("qa").alias("data_type"), F.col("g.q").alias("question"), F.col("g.a").alias("answers"), center.alias("docs"), zero.alias("pos_index"))
    text = F.regexp_replace(F.coalesce("paraphrase", F.lit("")), r"(?U)^\s+|\s+\z", "")
    para = rows.withColumn("p", text).filter("p != ''").select("win_idx", F.lit("paraphrase").alias("data_type"), F.array(F.lit("")).alias("question"), F.array("p").alias("answers"), center.alias("docs"), zero.alias("pos_index"))
    return qa.unionByName(para)


def stage12(windows: DataFrame) -> DataFrame:
    """One row for each gated question: question, docs, answer, data_type, pos_index, metadata; the heavy categories carry the whole window."""

    def tag(c):
        return F.transform(gated(F.col(c)), lambda x: F.struct(F.coalesce(x["type"], F.lit(c)).alias("type"), x["q"].alias("q"), x["a"].alias("a"), F.lit(c in HEAVY).alias("heavy")))

    tagged = F.concat(*[tag(c) for c in CATEGORIES])
    rows = windows.filter("ok").select("win_idx", "docs", "center_idx", "center_id", F.explode(tagged).alias("x")).filter("x.q != '' and x.a != ''")
    docs = F.when(F.col("x.heavy"), F.col("docs")).otherwise(F.array(F.get("docs", "center_idx")))
    places = F.when(F.col("x.heavy"), F.sequence(F.lit(0), F.size("docs") - 1)).otherwise(F.array(F.lit(0)))
    return rows.select("win_idx", F.col("x.q").alias("question"), docs.alias("docs"), F.col("x.a").alias("answer"), F.lit("qa").alias("data_type"), places.alias("pos_index"), F.struct(F.col("x.type").alias("type"), F.col("center_id").alias("source_chunk_id")).alias("metadata"))


def gate_statistics(windows: DataFrame) -> DataFrame:
    """total and rejected questions; those of mixed_qas count once for each record kind."""
    both = F.concat(F.when(F.size("mixed_qas") > 0, F.col("mixed_qas")).otherwise(F.col("simple_qas")), *[F.col(c) for c in CATEGORIES])
    rows = windows.filter("ok").select(F.explode(both).alias("x"))
    return rows.agg(F.count(F.lit(1)).alias("total_qas"), F.count_if(F.size(missing_numbers(F.coalesce("x.q", F.lit("")), F.coalesce("x.a", F.lit("")))) > 0).alias("rejected_qas"))


def judged(records: DataFrame, scores: DataFrame, least: int = 4) -> DataFrame:
    """Records (rec, data_type, …) all of whose scores (rec, score) reach ``least``; a missing score counts as 0; paraphrases pass."""
    passed = scores.groupBy("rec").agg(F.bool_and(F.coalesce(F.col("score"), F.lit(0)) >= least).alias("passed"))
    return records.join(passed, "rec", "left").filter((F.col("data_type") == "paraphrase") | F.coalesce("passed", F.lit(False))).drop("passed")
