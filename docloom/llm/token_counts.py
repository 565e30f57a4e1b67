"""Token counts through a digest cache.

A text's count is stored under two digests: of its normalised content (SHA-256 of the UTF-8 bytes; null counts as
empty; no other normalisation, so a count is exact for every tokenizer) and of the tokenizer file with the library's
version. A call joins the digests of its rows to the cache, encodes one text for each digest that the cache lacks,
appends these counts to the cache, and joins the counts to all rows.

Texts are encoded by the tokenizers library. For word_bpe_49k.json and files like it, whose pieces never hold white space,
a text is cut at blanks and newlines and the library encodes each distinct part once per worker; the parts' counts add up to
the text's. Special strings hold no blank, so that they stay whole.

Defined cases: null text counts as empty; repeated rows are each returned; extra columns are ignored, whatever their names; an empty table gives an
empty result; a very long text is encoded whole by one task.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import WORKER_CACHES, materialize, prepare, release_memory, shared_dir, table

LIMIT = 2048
#: Distinct parts that a worker keeps.
KEPT_PARTS = 1_200_000
#: Digests of 32 bytes that are broadcast at most (about 6 MB).
KNOWN_DIGESTS = 200_000
_CACHE_SCHEMA = "content binary, version string, n_tokens long"
_loaded: dict[str, object] = {}


def load_tokenizer(path: str):
    """The tokenizer of a file, without truncation and padding; loaded once per worker."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _loaded[path] = t
    return _loaded[path]


def splits_at_blanks(path: str) -> bool:
    """Whether no piece of the tokenizer can hold or depend on white space, by its file: see the module's text."""
    import json

    with open(path) as f:
        spec = json.load(f)
    squeezes = spec["normalizer"] == {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    split = steps[0]
    own = split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed" and split["pattern"].get("Regex", "").endswith("[^\\s\\p{L}\\p{N}]+")
    return bool(squeezes and own and spec["model"].get("end_of_word_suffix") == "</w>" and not any(" " in x["content"] or x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"]))


class PartEncoder:
    """ids of texts as the library gives them, with each distinct part between blanks encoded once.

    Parts that are a word of letters below U+0300, with a full stop or comma at most behind it, are encoded many at a time; word and mark give
    one piece each, so a part's ids end with the first or second next word-end token.
    """

    def __init__(self, path: str, convert):
        """``convert`` maps ids to their bytes or their number."""
        self.tokenizer, self.split, self.convert, self.known = load_tokenizer(path), splits_at_blanks(path), convert, {}
        WORKER_CACHES.append(self.known)
        if self.split:
            self.word_end = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
            self.word_end[[i for s, i in self.tokenizer.get_vocab().items() if s.endswith("</w>")]] = True
        release_memory()

    def _encode(self, parts: list[str]) -> None:
        for first in range(0, len(parts), 20_000):
            some = parts[first : first + 20_000]
            for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.known[p] = self.convert(e.ids)

    def _encode_words(self, words: list[str], marks: list[bool]) -> None:
        for first in range(0, len(words), 500):
            some = words[first : first + 500]
            ids = self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.word_end[np.array(ids, dtype=np.int64)]) + 1
            last = np.cumsum(np.array(marks[first : first + 500], dtype=np.int64) + 1) - 1
            if len(ends) != last[-1] + 1:
                self._encode(some)
                continue
            ends = ends[last]
            whole, step = self.convert(ids), self.convert([0])
            if isinstance(whole, bytes):
                ends = ends * len(step)
                self.known.update({p: whole[a:b] for p, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)})
            else:
                self.known.update(zip(some, np.diff(ends, prepend=0).tolist(), strict=True))

    def _learn(self, missing: set[str]) -> None:
        words, marks, others = [], [], []
        for p in missing:
            mark = p[-1:] in (".", ",")
            word = p[:-1] if mark else p
            if word.isalpha() and (word.isascii() or max(word.lower()) < "\u0300"):
                words.append(p)
                marks.append(mark)
            else:
                others.append(p)
        self._encode(others)
        self._encode_words(words, marks)

    def __call__(self, texts: list[str | None]) -> list[list]:
        """For each text, ``convert(ids)`` of its parts in order."""
        if not self.split:
            return [[self.convert(e.ids)] for e in self.tokenizer.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)]
        parts = [(x or "").replace("\n", " ").split(" ") for x in texts]
        if len(self.known) > KEPT_PARTS:
            self.known.clear()
        if missing := set().union(*parts).difference(self.known):
            self._learn(missing)
        get = self.known.__getitem__
        return [list(map(get, some)) for some in parts]

    def joined(self, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
        """For a ``convert`` to bytes: those of all texts' ids one after another, and where each text's begin and end. Only a batch's distinct parts are looked up."""
        if not self.split:
            some = [b"".join(x) for x in self(texts.to_pylist())]
            return pa.py_buffer(b"".join(some)), np.concatenate([[0], np.cumsum([len(x) for x in some], dtype=np.int64)])
        parts = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        code = pc.dictionary_encode(parts.flatten())
        distinct = code.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > KEPT_PARTS:
            self.known.clear()
        if missing := set(distinct).difference(self.known):
            self._learn(missing)
        ids = pa.array(list(map(self.known.__getitem__, distinct)), pa.large_binary()).take(code.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        first = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        return ids.buffers()[2] or pa.py_buffer(b""), ends[first]


def part_encoder(path: str, kind: str, convert) -> PartEncoder:
    key = f"{kind} {path}"
    if key not in _loaded:
        _loaded[key] = PartEncoder(path, convert)
    return _loaded[key]


def rows_of(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Slices of a batch of about ``most`` characters of text, with their texts."""
    texts = batch.column(column).to_pylist()
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t or "") > most:
            yield batch.slice(first, i - first), texts[first:i]
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield batch.slice(first), texts[first:]


def tokenizer_version(path: str) -> str:
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


def token_counts(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens. ``cache``: a folder that every executor reaches; made if missing."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    version = tokenizer_version(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("content", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    spark.createDataFrame([], _CACHE_SCHEMA).write.mode("append").parquet(cache)

    def stored() -> DataFrame:
        return spark.read.schema(_CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    def encode(reader):
        encoder = part_encoder(path, "counts", len)
        for batch in reader:
            for part, texts in rows_of(batch, "text"):
                counts = [sum(x) for x in encoder(texts)]
                yield pa.RecordBatch.from_arrays([part.column("content"), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())], ["content", "version", "n_tokens"])

    # Digests alone meet the cache. Texts move only for digests that it lacks; where those are few, they are known to each task before the shuffle.
    missing = materialize(rows.select("content").distinct().join(stored(), "content", "left_anti"), "missing")
    n = missing.count()
    if n:
        wanted = rows.join(F.broadcast(missing), "content", "left_semi") if n <= KNOWN_DIGESTS else rows
        misses = wanted.groupBy("content").agg(F.first("text").alias("text")).join(missing, "content", "left_semi")
        misses.mapInArrow(encode, _CACHE_SCHEMA).write.mode("append").parquet(cache)
    sized = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content")
    return sized.join(stored(), "content", "left").select("doc_id", "n_bytes", "n_tokens")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), f"{shared_dir(spark)}/token-counts-{uuid.uuid4().hex}")
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
