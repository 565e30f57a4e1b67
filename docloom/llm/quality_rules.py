"""Quality rules: document statistics and cross-document line frequency.

Lines are normalised (A-Z lower-cased, digits made 0, white space squeezed) and hashed to 64 bits. For each host (the
``source`` column) the operator counts the distinct documents that hold a line; exact copies of one text within a host
count as one document, because their removal is the job of the deduplication operators. A line is above the limit if
it is held by more than ``min_docs`` of them, however many documents the host has. Such lines are removed; a
document of which more than ``max_removed`` of the words went is depleted and rejected.

Defined cases: null text is empty; null host is a host of its own; an empty table gives an empty result; rows that are
repeated are judged alike and each returned; other columns are kept as they are, whatever
their names; a very long text is worked on whole by one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Substrings, Words, batches, byte_values, content_key, materialize, mix, prepare, repeated

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[ord("A") : ord("Z") + 1] += 32
_NORMAL[ord("0") : ord("9") + 1] = ord("0")
_DOC = np.uint64(0xD6E8FEB86659FD93)

MIN_DOCS, MAX_REMOVED = 20, 0.8
_BASE_SCHEMA = (
    "doc_id long, host string, key binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<struct<line:long,words:int>>"
)


def _line_hashes(words: Words, line_of: np.ndarray, first_word: np.ndarray) -> np.ndarray:
    """Of the normalised words of each line."""
    own = Substrings(byte_values(_NORMAL[words.data]))(words.starts, words.ends)
    return Substrings(own)(first_word[:-1], first_word[1:])


def text_statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Per text: the four base measures and n_words; and per distinct normalised line with a word: text, hash, words."""
    w = Words(texts)
    salt = mix(np.arange(len(texts), dtype=np.uint64) * _DOC)
    out = {"n_words": w.counts, "word_chars": w.per_text(~w.space & ((w.data & 0xC0) != 0x80)), "n_symbols": w.per_text(_SYMBOLS[w.data])}
    exact = Substrings(byte_values(w.data))
    hashes = exact(w.starts, w.ends)
    # Words in windows of three words that occur twice or more
    left = np.arange(max(0, len(hashes) - 2))
    left = left[w.doc[left] == w.doc[left + 2]] if len(left) else left
    many, _ = repeated(Substrings(hashes)(left, left + 3) ^ salt[w.doc[left]])
    flagged = np.zeros(len(hashes) + 3, dtype=bool)
    for k in range(3):
        flagged[left[many] + k] = True
    out["n_repeat_words"] = np.bincount(w.doc[flagged[: len(hashes)]], minlength=len(texts))
    # Lines
    ends = np.flatnonzero(w.data == 0x0A)
    starts = np.concatenate([[0], ends[:-1] + 1])
    line_first = np.concatenate([np.searchsorted(w.starts, starts), [len(w.starts)]])
    filled = np.flatnonzero(line_first[1:] > line_first[:-1])
    doc = np.searchsorted(w.offsets, starts, side="right") - 1
    _, first = repeated(exact(starts[filled], ends[filled]) ^ salt[doc[filled]])
    out["n_dup_lines"] = np.bincount(doc[filled[~first]], minlength=len(texts))
    hashed = _line_hashes(w, doc, line_first)[filled]
    n_words = (line_first[1:] - line_first[:-1])[filled]
    order = np.lexsort((hashed, doc[filled]))
    d, h, n = doc[filled][order], hashed[order], n_words[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])]) if len(d) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return out | {"line_doc": d[at], "line": h[at], "line_words": np.add.reduceat(n, at) if len(at) else n}


def _measure(reader):
    for batch, texts in batches(reader, "text"):
        s = text_statistics(texts)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(s["line_doc"], minlength=len(texts)))]).astype(np.int32)
        pair = pa.StructArray.from_arrays([pa.array(s["line"].view(np.int64)), pa.array(s["line_words"].astype(np.int32))], ["line", "words"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), batch.column("key")]
            + [pa.array(s[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            + [pa.ListArray.from_arrays(pa.array(offsets), pair)],
            ["doc_id", "host", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
        )


def measure(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): the base measures and the distinct lines; written once."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("\0null")).alias("host"), F.col("text"), content_key().alias("key"))
    return materialize(rows.mapInArrow(_measure, _BASE_SCHEMA), "quality")


def frequent_lines(measured: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(host, line) of the lines above the limit of their host. Every count is over all rows and is combined before the shuffle."""
    # Of the rows that hold one text within a host, one counts: the texts are made distinct by their key.
    texts = measured.groupBy("host", "key").agg(F.first("lines").alias("lines"))
    lines = texts.select("host", F.explode(F.col("lines.line")).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    return lines.filter(F.col("n") > min_docs).select("host", "line")


def quality_rules(docs: DataFrame, min_docs: int = MIN_DOCS, max_removed: float = MAX_REMOVED) -> DataFrame:
    """Per row of ``docs``: host, key (of the text), the measures, removed_lines (hashes), removed_words, base_failed and kept."""
    measured = measure(docs)
    frequent = materialize(frequent_lines(measured, min_docs), "frequent")
    hit = (
        measured.select("host", "key", F.explode("lines").alias("l")).select("host", "key", F.col("l.line").alias("line"), F.col("l.words").alias("words"))
        .join(frequent, ["host", "line"])
        .groupBy("host", "key", "line").agg(F.first("words").alias("words"))
        .groupBy("host", "key").agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    )
    removed = F.coalesce(F.col("removed_words"), F.lit(0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.drop("lines").join(hit, ["host", "key"], "left").select(
        "doc_id", "host", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        removed.alias("removed_words"), "removed_lines", failed.alias("base_failed"),
        (~failed & (removed <= max_removed * F.col("n_words"))).alias("kept"),
    )


#: Columns beside a user's own
_HOST, _KEY, _CUT = "__docloom_host", "__docloom_key", "__docloom_cut"


def _cutter(fields: list[str]):
    def cut(reader):
        for batch in reader:
            at = batch.schema.get_field_index("text")
            lists = batch.column(_CUT).to_pylist()
            texts = batch.column(at).to_pylist()
            for i, gone in enumerate(lists):
                if gone and texts[i]:
                    lines = texts[i].split("\n")
                    w = Words([x.encode() for x in lines])
                    first = np.concatenate([[0], np.cumsum(w.counts)])
                    hashed = _line_hashes(w, w.doc, first).view(np.int64)
                    drop = np.isin(hashed, np.array(gone, dtype=np.int64)) & (w.counts > 0)
                    texts[i] = "\n".join(x for x, out in zip(lines, drop, strict=True) if not out)
            columns = [pa.array(texts, pa.string()) if f == "text" else batch.column(f) for f in fields]
            yield pa.RecordBatch.from_arrays(columns, fields)

    return cut


def apply_quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """The kept rows of ``docs``, with their columns, without the lines above the limits; n_chars follows the text."""
    verdicts = quality_rules(docs, **limits).filter("kept").groupBy("host", "key").agg(F.first("removed_lines").alias(_CUT)).toDF(_HOST, _KEY, _CUT)
    keyed = docs.withColumns({_HOST: F.coalesce(F.col("source").cast("string"), F.lit("\0null")), _KEY: content_key()})
    kept = keyed.join(verdicts, [_HOST, _KEY]).select(*docs.columns, _CUT)
    out = kept.mapInArrow(_cutter(docs.columns), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    from docloom.llm.common import table

    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")
