"""Best-fit packing of token pieces by exact-complement hashing.

Every document is encoded and followed by a separator id; only a longer one is cut, into pieces of the capacity. How pieces are
combined depends on their lengths alone, so the plan is made from the counts of lengths: at most ``capacity`` numbers, however
large the corpus. For a length L the gap ``capacity - L`` is looked up in an index of available lengths, of sums of two and of sums
of three; the combination is used as often as the availability counts allow, which uses up at least one length. So there
are at most ``capacity`` such steps. What is left goes, longest first, to the open sequence with the smallest gap that holds it.

Each piece then gets its rank among the pieces of its length, by counts per length and hash bucket (no single task
sees all pieces of a length), and the plan maps (length, rank) to a sequence and an offset.

Defined cases: null text is empty (it is one separator); repeated rows are each packed; extra columns are ignored, whatever their names; an empty table gives
an empty result; pieces of equal length are ranked by row and piece; a very long text is encoded whole by one task.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.common import materialize, prepare, table
from docloom.llm.token_counts import part_encoder

CAPACITY = 2048
BUCKETS = 256
_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass
class Plan:
    """runs[L]: (first rank, first sequence, offset) for consecutive ranks of the pieces of length L."""

    capacity: int
    n_sequences: int = 0
    runs: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)


def _complement(available: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to the gap; the fewest, and of these the one with the longest piece."""

    def pair(total: int, spared: np.ndarray) -> tuple[int, int] | None:
        a = np.arange(total - 1, (total - 1) // 2, -1)  # the longer of the two
        b = total - a
        fits = (spared[a] > 0) & (spared[b] > 0) & ((a != b) | (spared[a] > 1))
        at = np.argmax(fits) if len(fits) else 0
        return (int(a[at]), int(b[at])) if len(fits) and fits[at] else None

    if gap <= 0:
        return None
    if available[gap] > 0:
        return (gap,)
    if two := pair(gap, available):
        return two
    for longest in np.flatnonzero(available[: gap - 1] > 0)[::-1]:
        if 3 * longest < gap:
            break
        spared = available.copy()
        spared[longest] -= 1
        if two := pair(gap - int(longest), spared):
            return (int(longest), *two)
    return None


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """From the number of pieces of each length (1 to capacity)."""
    plan = Plan(capacity)
    available = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        available[length] = n
    used = dict.fromkeys(counts, 0)

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        plan.runs.setdefault(length, []).append((used[length], sequence, offset))
        used[length] += n

    left: list[tuple[int, int]] = []  # (length, pieces) without a complement
    for length in range(capacity, 0, -1):
        while available[length] > 0:
            if length == capacity:
                chosen, n = (), int(available[length])
            else:
                rest = available.copy()
                rest[length] -= 1
                rest[length + 1 :] = 0
                chosen = _complement(rest, capacity - length)
                if chosen is None:
                    left.append((length, int(available[length])))
                    available[length] = 0
                    break
                parts = (length, *chosen)
                n = min(int(available[x]) // parts.count(x) for x in set(parts))
            offset = 0
            for x in (length, *chosen):
                # Several pieces of one length in a sequence: each takes a run of ranks of its own.
                put(x, n, plan.n_sequences, offset)
                available[x] -= n
                offset += x
            plan.n_sequences += n
    # Best fit for the rest: open[gap] holds (first sequence, how many) of sequences filled alike.
    open_: dict[int, list[tuple[int, int]]] = {}
    for length, n in left:
        while n:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                gap, first, k = capacity, plan.n_sequences, -(-n // (capacity // length))
                plan.n_sequences += k
            else:
                first, k = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
            used_now = min(n, k)
            put(length, used_now, first, capacity - gap)
            if gap > length:
                open_.setdefault(gap - length, []).append((first, used_now))
            if k > used_now:
                open_.setdefault(gap, []).append((first + used_now, k - used_now))
            n -= used_now
    return plan


def _slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20):
    """Slices of a batch of about ``most`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, end - first)
        first = end


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = 0) -> DataFrame:
    """Per piece: row (of ``docs``), doc_id, piece, start, length, ids_crc32; written once."""

    def run(reader):
        encoder = part_encoder(path, "ids", lambda ids: np.array(ids, dtype="<u4").tobytes())
        end = int(separator).to_bytes(4, "little")
        for batch in reader:
            for part in _slices(batch, "text"):
                ids, at = encoder.joined(part.column("text"))
                view = memoryview(ids)
                n = np.diff(at) // 4 + 1
                many = -(-n // capacity)
                of = np.repeat(np.arange(len(n)), many)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(capacity, n[of] - start)
                first = at[of] + 4 * start
                last = piece == many[of] - 1
                crc = [zlib.crc32(view[x:y]) for x, y in zip(first.tolist(), (first + 4 * (length - last)).tolist(), strict=True)]
                for k in np.flatnonzero(last).tolist():
                    crc[k] = zlib.crc32(end, crc[k])
                columns = [part.column("row").take(pa.array(of)), part.column("doc_id").take(pa.array(of)), *(pa.array(c, t) for c, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(run, _PIECES), "pieces")


def best_fit_packing(docs: DataFrame, path: str, capacity: int = CAPACITY, separator: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = token_pieces(docs, path, capacity, separator).withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(BUCKETS)).cast("int"))
    sizes = materialize(made.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")  # at most capacity * BUCKETS rows
    plan = plan_packing({r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)  # at most capacity rows
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row", "piece")) - 1
    ranked = made.withColumn("own", own).join(before, ["length", "bucket"]).withColumn("rank", F.col("own") + F.col("before"))
    runs = {k: tuple(np.array(x, dtype=np.int64) for x in zip(*v, strict=True)) for k, v in plan.runs.items()}

    def place(reader):
        for batch in reader:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(some):
                    first, base, at = runs[int(length[some[0]])]
                    k = np.searchsorted(first, rank[some], side="right") - 1
                    sequence[some], offset[some] = base[k] + rank[some] - first[k], at[k]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, schema)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
