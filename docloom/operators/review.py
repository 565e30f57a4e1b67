"""Review set: tagged union of the stages, filters, pages, counts, status upserts and the approved export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.sources.io import numbered_lines

STATUSES = ("approved", "rejected", "flagged", "pending")


def review_set(**stages: DataFrame) -> DataFrame:
    """Union of the stages, each with a column ``line`` (0-based): _id is ``<stage>_<line>``, _stage the name."""
    out = None
    for name, df in stages.items():
        rows = df.withColumn("_id", F.concat_ws("_", F.lit(name), F.col("line").cast("string"))).withColumn("_stage", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def stage_files(spark, paths: dict[str, str], schemas: dict[str, str]) -> dict[str, DataFrame]:
    """The stages whose files are there, each with ``line``: blank lines are left out but counted."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs, {}
    for name, path in paths.items():
        where = hadoop.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            rows = numbered_lines(spark, path).filter(F.trim("value") != "")
            out[name] = rows.select("line", F.from_json("value", schemas[name]).alias("r")).select("line", "r.*")
    return out


def with_status(rows: DataFrame, status: DataFrame) -> DataFrame:
    """_status from (_id, status); pending without one."""
    return rows.join(status.select("_id", F.col("status").alias("_status")), "_id", "left").withColumn("_status", F.coalesce("_status", F.lit("pending")))


def filtered(rows: DataFrame, stage: str = "all", data_type: str = "all", status: str = "all") -> DataFrame:
    for column, value in (("_stage", stage), ("data_type", data_type), ("_status", status)):
        if value != "all":
            rows = rows.filter(F.col(column) == value)
    return rows


def page(rows: DataFrame, number: int, per_page: int = 10) -> DataFrame:
    """One page in load order (_stage, line); the number is held within the pages that there are."""
    total = rows.count()
    pages = max(1, -(-total // per_page))
    number = min(max(1, number), pages)
    return rows.orderBy("_stage", "line").offset((number - 1) * per_page).limit(per_page)


def statistics(rows: DataFrame, status: DataFrame) -> DataFrame:
    """total, approved, rejected, flagged, pending; status rows of unknown ids count as well."""
    counts = status.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES[:3]])
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return total.crossJoin(counts).withColumn("pending", F.col("total") - F.col("approved") - F.col("rejected") - F.col("flagged"))  # one row each


def upsert(status: DataFrame, events: DataFrame) -> DataFrame:
    """Status after events (_id, status, seq): the last one of an id holds, pending deletes; events without id or with an unknown status are refused."""
    valid = events.filter((F.coalesce("_id", F.lit("")) != "") & F.col("status").isin(*STATUSES))
    both = status.select("_id", "status", F.lit(None).cast("long").alias("seq")).unionByName(valid.select("_id", "status", F.col("seq").cast("long").alias("seq")))
    return both.groupBy("_id").agg(F.max_by("status", F.coalesce("seq", F.lit(-(1 << 62)))).alias("status")).filter("status != 'pending'")


def approved(rows: DataFrame, status: DataFrame) -> DataFrame:
    """Approved rows without the underscore columns."""
    kept = rows.join(status.filter("status = 'approved'").select("_id"), "_id", "left_semi")
    return kept.drop(*[c for c in kept.columns if c.startswith("_")])


def sampled_rejects(rows: DataFrame, order: str, most: int = 10) -> DataFrame:
    w = Window.orderBy(order)
    return rows.orderBy(order).limit(most).withColumn("n", F.row_number().over(w))
