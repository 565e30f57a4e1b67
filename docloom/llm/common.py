"""Helpers shared by the training-data operators: shared-folder tables and vectorised text kernels."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import ship_package

U64 = np.uint64
#: Bytes of text that a kernel works on at once (a longer single document is worked on whole).
CHUNK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
#: What operators keep in a worker between tasks; an operator that needs room for whole texts empties it.
WORKER_CACHES: list[dict] = []
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_powers: dict[int, np.ndarray] = {}


def prepare(spark: SparkSession) -> None:
    """Ship the package, and keep Arrow batches of whole texts small unless the session sets their size itself."""
    ship_package(spark)
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1500")


def release_memory() -> None:
    """Give memory that a worker has freed back to the system."""
    _powers.clear()
    for kept in WORKER_CACHES:
        kept.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where a session on one machine names none (tests)."""
    prepare(spark)
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.docloom_path = path
    return made


def discard(*made: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for df in made:
        if path := getattr(df, "docloom_path", None):
            context = df.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps: it does so when what referred to them is collected, in Python first, which a small driver seldom does by itself."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def releasing_shuffles(spark: SparkSession):
    """Within it, Spark deletes an execution's shuffle files as soon as it has ended. For steps whose results are written; what is left to run later keeps its files."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: The row number that operators give rows; no column of a user's is called so.
RID = "__docloom_rid"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``RID``, written once: numbers that are taken anew on each scan could change with its partitions."""
    return materialize(docs.withColumn(RID, F.monotonically_increasing_id()), "rows")


def bucketed(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` as a table bucketed by ``column`` in the shared folder: they move once, and joins by it leave them where they are."""
    spark, name = rows.sparkSession, f"docloom_{uuid.uuid4().hex}"
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    writer = rows.repartition(n, column).write.format("parquet").bucketBy(n, column).option("compression", "zstd")
    writer.option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def dealt_rows(docs: DataFrame) -> DataFrame:
    """``numbered`` rows, ``bucketed`` by ``RID``."""
    rows = numbered(docs)
    dealt = bucketed(rows, RID)
    discard(rows)
    return dealt


def content_key(column: str = "text"):
    """16 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null gives b''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def pieces(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) for runs of texts of at most ``most`` bytes, or of one text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, texts[first:]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of a hash depends on all its input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2)) if n <= 2 * CHUNK_BYTES else n
        got = np.full(size, U64(base), dtype=np.uint64)
        got[0] = U64(1)
        np.cumprod(got, out=got)
        if n <= 2 * CHUNK_BYTES:
            _powers[base] = got
    return got


class Substrings:
    """Hashes of any substrings of a sequence in constant time each: differences of prefix sums of x[k] * B**k."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * _power_table(_BASE, n + 1)[:n], out=self.sums[1:])
        self.inverse = _power_table(_BASE_INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[data]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """Word boundaries of several texts that are laid one after another, each followed by a newline.

    A word is a run of bytes other than 0x20 and 0x09-0x0D, so words never cross texts.
    """

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.lengths = lengths
        space = _SPACE[self.data]
        self.space = space
        before = np.concatenate([[True], space[:-1]])
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(space & ~before)
        self.doc = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flag: the key occurs twice or more, flag: it is the first occurrence)."""
    n = len(keys)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    last = np.concatenate([new[1:], [True]])
    many, first = np.empty(n, bool), np.empty(n, bool)
    many[order] = ~(new & last)
    first[order] = new
    return many, first


def shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each window of ``size`` words; a text with fewer words, but some, gives its whole sequence."""
    run = Substrings(hashes)
    n = len(hashes)
    left = np.arange(max(0, n - size + 1))
    left = left[words.doc[left] == words.doc[left + size - 1]] if len(left) else left
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    first = np.concatenate([[0], np.cumsum(words.counts)])
    got = np.concatenate([run(left, left + size), run(first[short], first[short + 1])])
    return got, np.concatenate([words.doc[left], short])


def batches(reader: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches, with their texts, of about CHUNK_BYTES each."""
    release_memory()
    for batch in reader:
        texts = as_bytes(batch.column(batch.schema.get_field_index(column)))
        for first, part in pieces(texts):
            yield batch.slice(first, len(part)), part
    release_memory()
