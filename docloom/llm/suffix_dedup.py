"""Exact removal of repeated byte strings by bucket-pointer refinement.

Every byte is removed that is covered by a ``length``-byte string which also starts anywhere else. Suffixes are sorted only as far as they
need to be: a string of ``length`` bytes has the bucket of its least q-gram (the first of equal ones) as its initial bucket, so equal strings fall into equal buckets
and only one position in about ``(length - q) / 2`` is dealt out. Buckets with one member are settled. The bytes of the others are brought together, and all positions
in them are sorted into q-gram buckets, which are refined by sorting on the identifiers of the buckets that a later offset is in by then: 64 bytes become 128, and those
200. Each refinement gives new identifiers, which the next one looks up; a position is settled when it is alone or points to one that is.

A bucket of more than ``hot`` members is not brought together: its strings' final identifiers, refined in the same steps, are dealt out by value instead and compared
there, packed. A slice of rows sends a value twice at most, however many strings have it, and the answers go back to the slice. Identifiers of the first q-grams are 64-bit hashes, and bytes are not compared.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing; repeated rows are different documents, so that all
their copies are removed; ids may be null; strings never cross documents; an empty table gives an empty result; other columns are kept as they are, whatever
their names; a very long text is worked on whole by one task, in memory of some 60 times its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import RID, Substrings, batches, byte_values, dealt_rows, materialize, mix, prepare, release_shuffles, repeated, table

LENGTH, Q, HOT = 200, 64, 400
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def anchors(texts: list[bytes], length: int = LENGTH, q: int = Q):
    """Runs of string starts with the same least q-gram: (text, first start, starts, anchor; both within the text) and the anchor's bucket."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    n = len(data) - q + 1
    width = length - q + 1
    if n < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.view(np.uint64)
    at = np.arange(n)
    grams = Substrings(byte_values(data))(at, at + q)
    # The least 32 bits of hash, then the first position
    least = (grams & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    least = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # for each start of a string
    text = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    valid = np.arange(len(least)) + length <= offsets[text + 1]
    starts, text, least = np.flatnonzero(valid), text[valid], least[valid]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.view(np.uint64)
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(starts)]]))
    of = text[first]
    return of, starts[first] - offsets[of], count, least[first] - offsets[of], grams[least[first]]


def _dealer(length: int, q: int, parts: int):
    def deal(reader):
        for batch, texts in batches(reader, "text"):
            of, _, _, anchor, bucket = anchors(texts, length, q)
            rids = batch.column("rid").to_numpy()[of]
            to = (bucket % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(parts + 1))
            rows = []
            for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                if b > a:
                    some = order[a:b]
                    rows.append((k, bucket[some].tobytes(), rids[some].astype("<i8").tobytes(), anchor[some].astype("<i4").tobytes()))
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["part", "buckets", "rids", "at"])

    return deal


def _crowded(hot: int):
    """Anchors whose bucket has two members or more: rid, position and whether it has more than ``hot``."""

    def close(rows):
        bucket, rid, at = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.argsort(bucket, kind="stable")
        s = bucket[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        size = np.diff(np.concatenate([first, [len(s)]]))
        many = np.repeat(size, size)
        keep = many > 1
        some = order[keep]
        return pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.array(at[some].astype(np.int32)), pa.array(many[keep] > hot)], ["rid", "at", "hot"])

    def run(reader):
        part, rows = None, []
        for batch in reader:
            for p, b, rids, at in zip(*(batch.column(c).to_pylist() for c in ("part", "buckets", "rids", "at")), strict=True):
                if p != part:
                    if rows:
                        yield close(rows)
                    part, rows = p, []
                rows.append((np.frombuffer(b, np.uint64), np.frombuffer(rids, "<i8"), np.frombuffer(at, "<i4")))
        if rows:
            yield close(rows)

    return run


_WORK = ["kind", "key", "rid", "start", "slice", "data", "rows", "starts"]
_WORK_SCHEMA = "kind int, key long, rid long, start int, slice string, data binary, rows binary, starts binary"


def _work(n: int, **columns) -> pa.RecordBatch:
    types = {"kind": pa.int32(), "key": pa.int64(), "rid": pa.int64(), "start": pa.int32(), "slice": pa.string(), "data": pa.binary(), "rows": pa.binary(), "starts": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items()], _WORK)


def refinements(length: int, q: int) -> list[tuple[int, int]]:
    """(later offset, bytes compared afterwards) of each refinement: a bucket of h bytes and the one at the offset make a bucket of up to 2h."""
    out, have = [], q
    while have < length:
        wide = min(2 * have, length)
        out.append((wide - have, wide))
        have = wide
    return out


def _spread(length: int, q: int, parts: int):
    """The strings of crowded anchors. kind 0: bytes that hold them, keyed by bucket; of hot buckets, kind 1: final identifiers, keyed by
    their value, with their numbers in the slice, and kind 2: the rows and (start, number) pairs of the slice's strings."""

    def run(reader):
        for batch, texts in batches(reader, "text"):
            rids = batch.column("rid").to_pylist()
            of, start, count, anchor, bucket = anchors(texts, length, q)
            cuts = np.searchsorted(of, np.arange(len(texts) + 1))
            cold, hot = [], []
            for k, (at, flags) in enumerate(zip(batch.column("at").to_pylist(), batch.column("hot").to_pylist(), strict=True)):
                if not at:
                    continue
                own = np.arange(cuts[k], cuts[k + 1])
                want = dict(zip(at, flags, strict=True))
                for i in own[np.isin(anchor[own], np.array(at))].tolist():
                    (hot if want[int(anchor[i])] else cold).append(i)
            for first in range(0, len(cold), 20_000):
                some = cold[first : first + 20_000]
                yield _work(
                    len(some), kind=[0] * len(some), key=bucket[some].view(np.int64), rid=[rids[of[i]] for i in some], start=start[some].astype(np.int32),
                    data=[texts[of[i]][start[i] : start[i] + count[i] - 1 + length] for i in some],
                )
            if hot:
                data = [texts[of[i]][start[i] : start[i] + count[i] - 1 + length] for i in hot]
                every, row, within = final_identifiers(data, length, q)
                ids, value, size = np.unique(every, return_inverse=True, return_counts=True)
                rid = np.array([rids[of[i]] for i in hot], dtype=np.int64)
                name = f"{rid[0]}:{start[hot[0]]}:{len(hot)}"
                yield _work(1, kind=[2], key=[int(mix(rid[:1].view(np.uint64))[0].view(np.int64))], slice=[name], rows=[rid[row].tobytes()], starts=[np.stack([start[hot][row] + within, value], axis=1).astype("<i4").tobytes()])
                # A value goes out once for the slice, twice if the slice has it more than once
                sent = np.repeat(np.arange(len(ids)), np.minimum(size, 2))
                ids = ids[sent]
                to = (ids % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                edge = np.searchsorted(to[order], np.arange(parts + 1))
                full = [k for k in range(parts) if edge[k + 1] > edge[k]]
                yield _work(len(full), kind=[1] * len(full), key=full, slice=[name] * len(full), data=[ids[order[edge[k] : edge[k + 1]]].tobytes() for k in full], rows=[sent[order[edge[k] : edge[k + 1]]].astype("<i4").tobytes() for k in full])

    return run


def _grams(data: list[bytes], q: int):
    """(start of each row and the end of all, end of each byte's row, positions of q-grams, their hashes) in the joined rows."""
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.repeat(offsets[1:], sizes)
    at = np.flatnonzero(np.arange(len(ends)) + q <= ends)
    return offsets, ends, at, Substrings(byte_values(np.frombuffer(b"".join(data), np.uint8)))(at, at + q)


def _located(at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.searchsorted(offsets, at, side="right") - 1
    return row, at - offsets[row]


def final_identifiers(data: list[bytes], length: int, q: int):
    """(identifier, row, start within it) of every string of ``length`` bytes: buckets refined as in ``refine``, but named by value, so that they mean the same everywhere."""
    offsets, ends, at, grams = _grams(data, q)
    ids = np.zeros(len(ends), np.uint64)
    ids[at] = grams
    for gap, wide in refinements(length, q):
        at = at[at + wide <= ends[at]]
        new = mix(ids[at] * _STEP + ids[at + gap])
        ids[at] = new
    return ids[at], *_located(at, offsets)


def refine(data: list[bytes], length: int = LENGTH, q: int = Q) -> tuple[np.ndarray, np.ndarray]:
    """(row, start within it) of every string of ``length`` bytes that occurs twice or more. Positions are sorted into buckets by their q-grams, then by their bucket and the
    one that the position ``gap`` further is in by now; a position is settled when its bucket has one member or points to one that is settled."""
    offsets, ends, at, keys = _grams(data, q)
    bucket = np.full(len(ends), -1, np.int64)
    for gap, wide in [*refinements(length, q), (0, 0)]:
        _, of, size = np.unique(keys, return_inverse=True, return_counts=True)
        bucket[:] = -1
        many = size[of] > 1
        at = at[many]
        bucket[at] = of[many]
        if wide:
            at = at[at + wide <= ends[at]]
            at = at[bucket[at + gap] >= 0]
            keys = bucket[at] * len(ends) + bucket[at + gap]
    return _located(at, offsets)


def _ranges(rid: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    order = np.lexsort((start, rid))
    r, s = rid[order], start[order]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] > s[:-1] + length)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(r)]]) - 1
    return pa.RecordBatch.from_arrays([pa.array(r[first]), pa.array(s[first].astype(np.int32)), pa.array((s[last] + length).astype(np.int32)), pa.nulls(len(first), pa.string()), pa.nulls(len(first), pa.binary()), pa.nulls(len(first), pa.binary())], _FOUND)


_FOUND = ["rid", "start", "end", "slice", "rows", "starts"]
_FOUND_SCHEMA = "rid long, start int, end int, slice string, rows binary, starts binary"


def _settle(length: int, q: int):
    """Rows in groups of (kind, key), sorted: ranges of repeated strings; for hot ones, which of a slice's strings are repeated."""

    def cold(rows):
        rid, start, data = zip(*rows, strict=True)
        row, within = refine(list(data), length, q)
        if len(row):
            yield _ranges(np.array(rid, dtype=np.int64)[row], np.array(start, dtype=np.int64)[row] + within, length)

    def hot(rows):
        name, data, index = zip(*rows, strict=True)
        many, _ = repeated(np.frombuffer(b"".join(data), np.uint64))
        cut = np.concatenate([[0], np.cumsum([len(x) // 8 for x in data])])
        out = [(n, np.frombuffer(x, "<i4")[many[a:b]].tobytes()) for n, x, a, b in zip(name, index, cut[:-1], cut[1:], strict=True)]
        out = [x for x in out if x[1]]
        if out:
            n = len(out)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.binary()), pa.nulls(n, pa.binary())], _FOUND)

    def run(reader):
        group, rows, size = None, [], 0
        for batch in reader:
            columns = [batch.column(c).to_pylist() for c in _WORK]
            for kind, key, rid, start, name, data, index, starts in zip(*columns, strict=True):
                if kind == 2:
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.array([name]), pa.array([index], pa.binary()), pa.array([starts], pa.binary())], _FOUND)
                    continue
                if (kind, key) != group:
                    if rows and (group[0] == 1 or kind != 0 or size > 1_500_000):
                        yield from (hot if group[0] else cold)(rows)
                        rows, size = [], 0
                    group = kind, key
                rows.append((name, data, index) if kind else (rid, start, data))
                size += len(data)
        if rows:
            yield from (hot if group[0] else cold)(rows)

    return run


def _answer(length: int):
    """Groups of one slice, sorted so that what its strings stand for comes first."""

    def run(reader):
        name, table_, hits = None, None, []

        def close():
            start, value = np.frombuffer(table_[1], "<i4").reshape(-1, 2).T.astype(np.int64)
            at = np.flatnonzero(np.isin(value, np.concatenate([np.frombuffer(x, "<i4") for x in hits])))
            return _ranges(np.frombuffer(table_[0], np.int64)[at], start[at], length).select(["rid", "start", "end"])

        for batch in reader:
            for n, rows, starts in zip(*(batch.column(c).to_pylist() for c in ("slice", "rows", "starts")), strict=True):
                if n != name:
                    if hits:
                        yield close()
                    name, table_, hits = n, None, []
                if starts is not None:
                    table_ = rows, starts
                else:
                    hits.append(rows)
        if hits:
            yield close()

    return run


def repeated_ranges(rows: DataFrame, length: int = LENGTH, q: int = Q, hot: int = HOT) -> DataFrame:
    """(rid, spans): for each row (rid, text) that has any, the sorted maximal ranges of bytes to remove."""
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.mapInArrow(_dealer(length, q, 4 * n), "part int, buckets binary, rids binary, at binary")
    crowded = materialize(dealt.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_crowded(hot), "rid long, at int, hot boolean"), "crowded")
    per_row = crowded.groupBy("rid").agg(F.collect_list(F.struct("at", "hot")).alias("c")).select("rid", F.col("c.at").alias("at"), F.col("c.hot").alias("hot"))
    work = rows.join(per_row, "rid").mapInArrow(_spread(length, q, 4 * n), _WORK_SCHEMA)
    found = work.repartition(n, "kind", "key").sortWithinPartitions("kind", "key").mapInArrow(_settle(length, q), _FOUND_SCHEMA)
    found = materialize(found, "ranges")
    del dealt, crowded, per_row, work
    release_shuffles(spark)  # what led to the ranges is not read again
    slices = found.filter("slice is not null").select("slice", "rows", "starts").repartition("slice").sortWithinPartitions("slice", F.col("starts").isNull())
    ranges = found.filter("slice is null").select("rid", "start", "end").union(slices.mapInArrow(_answer(length), "rid long, start int, end int"))
    return ranges.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


_SPANS = "__docloom_spans"


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x in spans or []:
        if out and x["start"] <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], x["end"])
        else:
            out.append((x["start"], x["end"]))
    return out


def _rest(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for s in spans for e in s), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _digest(reader):
    for batch, texts in batches(reader, "text"):
        found = [merged(x) for x in batch.column("spans").to_pylist()]
        removed = [sum(b - a for a, b in s) for s in found]
        sha = [hashlib.sha256(_rest(t, s)).hexdigest() for t, s in zip(texts, found, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(removed, pa.int64()), pa.array(map(len, found), pa.int64()), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup_digests(docs: DataFrame, length: int = LENGTH, q: int = Q, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    prepare(docs.sparkSession)
    rows = dealt_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).withColumnRenamed(RID, "rid")
    spans = repeated_ranges(rows.select("rid", "text"), length, q, hot)
    return rows.join(spans, "rid", "left").select("doc_id", "text", "spans").mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _cutter(fields: list[str]):
    def cut(reader):
        for batch in reader:
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column(_SPANS).to_pylist()):
                if spans:
                    # A character that is removed in part is removed whole
                    texts[i] = _rest(texts[i].encode(), merged(spans)).decode("utf-8", "ignore")
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if f == "text" else batch.column(f) for f in fields], fields)

    return cut


def apply_suffix_dedup(docs: DataFrame, length: int = LENGTH, q: int = Q, hot: int = HOT) -> DataFrame:
    """``docs`` without the repeated strings in their texts; n_chars follows the text."""
    prepare(docs.sparkSession)
    rows = dealt_rows(docs)
    spans = repeated_ranges(rows.select(F.col(RID).alias("rid"), "text"), length, q, hot).toDF(RID, _SPANS)
    out = rows.join(spans, RID, "left").select(*docs.columns, _SPANS).mapInArrow(_cutter(docs.columns), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup_digests(table(spark, sf_dir, "documents"))
