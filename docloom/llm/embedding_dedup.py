"""Near-duplicate embeddings: sign hashing with random hyperplanes in several tables, exact cosine, connected components.

Equal vectors form a class first. Each class gets one code of ``bits`` signs per table; classes that share a code in any table
are compared by cosine in double precision. The number of bits follows from the number of classes, the number of tables from the
bits, so that a pair right at the threshold is met with probability ``recall`` (more similar pairs more surely). A pair is counted in the
first table that it shares, so that no list of pairs is built: groups give each class its sum of links and a spanning forest.
Groups above ``block`` classes are cut into blocks, and each pair of blocks is a task of its own.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, not even with their
copies; vectors of other length never link; repeated rows count as vectors of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import materialize, prepare, table
from docloom.llm.components import components

THRESHOLD, RECALL, BLOCK, SEED = 0.95, 0.985, 1024, 17


def _keys(reader):
    """The class key: a digest of a valid vector's doubles; null for the others."""
    for batch in reader:
        keys, vectors = [], []
        for x in batch.column("embedding").to_pylist():
            ok = x is not None and len(x) > 0 and all(v is not None for v in x)
            v = np.array(x, dtype=np.float64) if ok else np.zeros(1)
            ok = ok and bool(np.isfinite(v).all()) and bool(v.any())
            keys.append(hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() if ok else None)
            vectors.append((v + 0.0).tobytes() if ok else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], ["vec_id", "key", "vector"])


def table_shape(n_classes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a code, tables)."""
    bits = min(30, max(6, math.ceil(math.log2(max(2, n_classes) / 16))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def _coder(bits: int, tables: int):
    planes: dict[int, np.ndarray] = {}

    def code(reader):
        for batch in reader:
            codes, rows, names = [], batch.column("vector").to_pylist(), batch.column("key").to_pylist()
            for raw in rows:
                v = np.frombuffer(raw)
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng(SEED + len(v)).standard_normal((tables * bits, len(v)))
                # Scaled first, so that a product of finite values stays finite
                signs = (planes[len(v)] @ (v / np.abs(v).max()) > 0).reshape(tables, bits)
                codes.append((signs @ (1 << np.arange(bits))).astype("<i4"))
            for t in range(tables):
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * n, pa.int32()), pa.array([int(c[t]) for c in codes], pa.int32()), pa.array(names, pa.binary()), pa.array(rows, pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column("n")],
                    ["tab", "code", "key", "vector", "codes", "n"],
                )

    return code


def _unit(rows: list[bytes]) -> np.ndarray:
    m = np.array([np.frombuffer(x) for x in rows])
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _compare(tab: int, left: list[dict], right: list[dict] | None, threshold: float):
    """(sums of links per class, forest edges) of two blocks, or within one."""
    sums: dict[bytes, int] = {}
    edges: list[tuple[bytes, bytes]] = []
    for size in {len(x["vector"]) for x in left}:
        a = [x for x in left if len(x["vector"]) == size]
        b = a if right is None else [x for x in right if len(x["vector"]) == size]
        if not b:
            continue
        near = _unit([x["vector"] for x in a]) @ _unit([x["vector"] for x in b]).T >= threshold
        if right is None:
            np.fill_diagonal(near, False)
        i, j = np.nonzero(near)
        if not len(i):
            continue
        ca, cb = (np.array([np.frombuffer(x["codes"], "<i4") for x in y]) for y in (a, b))
        new = ~(ca[i, :tab] == cb[j, :tab]).any(axis=1)
        na, nb = (np.array([x["n"] for x in y], dtype=np.int64) for y in (a, b))
        for who, got in ((a, np.bincount(i[new], weights=nb[j[new]], minlength=len(a))), *(() if right is None else ((b, np.bincount(j[new], weights=na[i[new]], minlength=len(b))),))):
            for k in np.flatnonzero(got):
                sums[who[k]["key"]] = sums.get(who[k]["key"], 0) + int(got[k])
        # A spanning forest by minimum labels
        n = len(a) if right is None else len(a) + len(b)
        label, to = np.arange(n), j if right is None else j + len(a)
        while True:
            was = label.copy()
            low = np.minimum(label[i], label[to])
            np.minimum.at(label, i, low)
            np.minimum.at(label, to, low)
            label = label[label]
            if (was == label).all():
                break
        names = [x["key"] for x in a] + ([] if right is None else [x["key"] for x in b])
        edges += [(names[k], names[label[k]]) for k in np.flatnonzero(label != np.arange(n))]
    return sums, edges


def _grouped(threshold: float):
    def flush(group, rows):
        tab, _, i, j = group
        left = [x for x in rows if x["block"] == i]
        sums, edges = _compare(tab, left, None if i == j else [x for x in rows if x["block"] == j], threshold)
        yield from ((k, None, v) for k, v in sums.items())
        yield from ((a, b, 0) for a, b in edges)

    def run(reader):
        group, rows, out = None, [], []

        def batch():
            a, b, n = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], ["a", "b", "links"])

        for some in reader:
            for x in some.to_pylist():
                now = x["tab"], x["code"], x["i"], x["j"]
                if now != group:
                    if len(rows) > 1:
                        out += flush(group, rows)
                    group, rows = now, []
                rows.append(x)
            if len(out) > 10_000:
                yield batch()
        if len(rows) > 1:
            out += flush(group, rows)
        if out:
            yield batch()

    return run


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    keyed = materialize(rows.mapInArrow(_keys, "vec_id long, key binary, vector binary"), "vectors")
    classes = materialize(keyed.filter(F.col("key").isNotNull()).groupBy("key").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep")), "classes")
    bits, tables = table_shape(classes.count(), threshold, recall)
    coded = classes.select("key", "vector", "n").mapInArrow(_coder(bits, tables), "tab int, code int, key binary, vector binary, codes binary, n long")
    coded = materialize(coded, "coded")
    sizes = coded.groupBy("tab", "code").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    # A row of block k meets each block m in the task (min(k, m), max(k, m))
    placed = (
        coded.join(sizes.drop("size"), ["tab", "code"])
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("tab", "code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "vector", "codes", "n")
    )
    keys = ["tab", "code", "i", "j"]
    found = placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_grouped(threshold), "a binary, b binary, links long")
    found = materialize(found, "found")
    links = found.filter("links > 0").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    joined = components(found.filter(F.col("b").isNotNull()).select("a", "b")).toDF("key", "root")
    own = classes.select("key", "n", "rep").join(links, "key", "left").join(joined, "key", "left").withColumn("root", F.coalesce("root", "key"))
    low = own.groupBy("root").agg(F.min("rep").alias("component_id"))
    own = own.join(low, "root").select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    component = F.coalesce(F.col("component_id"), F.col("vec_id"))
    return keyed.select("vec_id", "key").join(own, "key", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))
