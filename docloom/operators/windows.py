"""Adaptive context windows over neighbouring chunks.

Chunks are ordered by (source, id). A run of equal titles gives each of its chunks a window of up to ``most`` chunks, to the left first; a
window below ``least`` is padded with its neighbours, across sources too unless ``cross_source`` is off. Global positions are made of positions within a source and
the sums of the sources' sizes, so that no single task sees all chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import running_sum, written


def positions(chunks: DataFrame) -> DataFrame:
    """``chunks`` with rn, the 0-based position by (source, id), and n, the number of all chunks. A null source is a source of its own, before the others."""
    sizes = running_sum(chunks.groupBy("source").agg(F.count(F.lit(1)).alias("size")), "source", "size", "upto")
    before = sizes.select(F.col("source").alias("same"), (F.col("upto") - F.col("size")).alias("before")).crossJoin(F.broadcast(sizes.agg(F.sum("size").alias("n"))))  # one row
    own = F.row_number().over(Window.partitionBy("source").orderBy("id")) - 1
    return chunks.withColumn("own", own).join(before, F.col("source").eqNullSafe(F.col("same"))).drop("same").withColumn("rn", (F.col("before") + F.col("own")).cast("long")).drop("before")


def _runs(placed: DataFrame) -> DataFrame:
    """Adds rs and re: first and last position of the chunk's run of equal titles. Runs are found within a source; those that touch at a
    source's edge are joined over the table of sources' edge runs."""
    w = Window.partitionBy("source").orderBy("own")
    title = F.coalesce("title", F.lit(""))
    starts = placed.withColumn("t", title).withColumn("new", (F.coalesce(F.lag("t").over(w) != F.col("t"), F.lit(True))).cast("int"))
    runs = starts.withColumn("run", F.sum("new").over(w))
    ends = runs.groupBy("source", "run").agg(F.min("rn").alias("rs"), F.max("rn").alias("re"), F.first("t").alias("t"))
    # Only a source's first and last runs can go on in another source
    last = runs.groupBy(F.col("source").alias("same")).agg(F.max("run").alias("last"))
    edge = ends.join(last, F.col("source").eqNullSafe(F.col("same"))).filter((F.col("run") == 1) | (F.col("run") == F.col("last")))
    edge = written(edge.select("source", "run", "rs", "re", "t"), "edges")
    ahead = edge.select((F.col("re") + 1).alias("rs"), "t", F.lit(0).alias("fresh"))
    chain = running_sum(edge.join(ahead, ["rs", "t"], "left").withColumn("fresh", F.coalesce("fresh", F.lit(1))), "rs", "fresh", "chain")
    whole = chain.groupBy("chain").agg(F.min("rs").alias("wrs"), F.max("re").alias("wre")).join(chain.select("chain", F.col("source").alias("same"), F.col("run").alias("nth")), "chain").drop("chain")
    one = F.col("source").eqNullSafe(F.col("same")) & (F.col("run") == F.col("nth"))
    joined = ends.drop("t").join(whole, one, "left").select(F.col("source").alias("same"), F.col("run").alias("nth"), F.coalesce("wrs", "rs").alias("rs"), F.coalesce("wre", "re").alias("re"))
    return runs.drop("new", "t").join(joined, one).drop("run", "same", "nth")


def adaptive_windows(chunks: DataFrame, least: int = 3, most: int = 7, cross_source: bool = True) -> DataFrame:
    """Per chunk: its columns, rn, win_start and win_end (positions, end exclusive) and center_idx."""
    placed = positions(chunks)
    if cross_source:
        runs = _runs(placed)
        lo, hi = F.lit(0), F.col("n")
    else:
        w = Window.partitionBy("source")
        runs = _runs(placed)
        runs = runs.withColumn("lo", F.min("rn").over(w)).withColumn("hi", F.max("rn").over(w) + 1)
        runs = runs.withColumn("rs", F.greatest("rs", "lo")).withColumn("re", F.least("re", F.col("hi") - 1))
        lo, hi = F.col("lo"), F.col("hi")
    i = F.col("rn")
    out = runs.withColumn("s0", i - F.least(i - F.col("rs"), F.lit(most - 1)))
    out = out.withColumn("e0", i + 1 + F.least(F.col("re") - i, F.lit(most) - (i - F.col("s0") + 1)))
    out = out.withColumn("d", F.greatest(F.lit(0), F.lit(least) - (F.col("e0") - F.col("s0"))))
    out = out.withColumn("s1", F.col("s0") - F.least(F.floor(F.col("d") / 2), F.col("s0") - lo))
    out = out.withColumn("e1", F.col("e0") + F.least(F.col("d") - (F.col("s0") - F.col("s1")), hi - F.col("e0")))
    short = (F.col("e1") - F.col("s1")) < least
    start = F.when(short & (F.col("s1") > lo), F.greatest(lo, F.col("e1") - least)).otherwise(F.col("s1"))
    end = F.when(short & (F.col("s1") <= lo) & (F.col("e1") < hi), F.least(hi, F.col("s1") + least)).otherwise(F.col("e1"))
    out = out.withColumn("win_start", start.cast("long")).withColumn("win_end", end.cast("long")).withColumn("center_idx", (F.col("rn") - start).cast("int"))
    return out.select(*chunks.columns, "rn", "win_start", "win_end", "center_idx")


def window_contents(windows: DataFrame) -> DataFrame:
    """Per window: rn, center_idx and chunks, its chunks in order; by an equi-join on positions."""
    asked = windows.select("rn", "center_idx", F.explode(F.sequence("win_start", F.col("win_end") - 1)).alias("at"))
    found = windows.select(F.col("rn").alias("at"), F.struct("id", "source", "title", "content").alias("chunk"))
    return asked.join(found, "at").groupBy("rn", "center_idx").agg(F.array_sort(F.collect_list(F.struct("at", "chunk"))).alias("c")).select("rn", "center_idx", F.transform("c", lambda x: x["chunk"]).alias("chunks"))


def window_text(chunks, center):
    """The text of a window's chunks for a prompt."""

    def one(c, i):
        mark = F.when(i == center, F.lit("CHUNK CENTRALE")).when(i < center, F.lit("Contesto Precedente")).otherwise(F.lit("Contesto Successivo"))
        return F.concat(
            F.lit("=== CHUNK #"), c["id"].cast("string"), F.lit(" ("), mark, F.lit(") ===\nFonte: "), F.coalesce(c["source"].cast("string"), F.lit("")),
            F.lit("\nTitolo: "), F.coalesce(c["title"], F.lit("")), F.lit("\n\n"), F.coalesce(c["content"], F.lit("")), F.lit("\n"),
        )

    return F.array_join(F.transform(chunks, one), "\n")
