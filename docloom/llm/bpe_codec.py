"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a pre-token there is exactly one token that its encoding ends with. An automaton with suffix links over the
vocabulary gives, for each prefix, the tokens that are its suffixes; such a token is the last one exactly if it is compatible
with the last token of the shorter prefix that it leaves. Two tokens are compatible if merging their bytes from scratch
keeps the seam between them: no merge of a piece on the seam's left with a piece on its right comes before both pieces are taken
up by their own tokens. Back-pointers then give the ids; no merge is ever replayed over the text.

Defined cases: null text is empty and gives no ids; special strings inside a text give their special id, as the library does by
default; repeated rows are each returned; an empty table gives an empty result; other columns are ignored, whatever their names; a very long text
is worked on whole by one task.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import prepare, table
from docloom.llm.token_counts import load_tokenizer, rows_of

#: The byte-level pre-token pattern that goes with such vocabularies (a fixed value); white space as the library's regex engine has it.
_S = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
#: Distinct pre-tokens that a worker keeps.
KEPT = 400_000
_codecs: dict[str, BpeCodec] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BpeCodec:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path) as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.bytes = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = vocab[a], vocab[b]
            self.rank[ids] = r
            self.parts.setdefault(vocab[a + b], (*ids, r))
        self.automaton = ahocorasick.Automaton()
        for s, i in vocab.items():
            raw = self.bytes[i]
            if len(raw) == 1 or i in self.parts:
                self.automaton.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.automaton.make_automaton()
        self.library = load_tokenizer(path)
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else lambda t: [t]
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """(piece, rank of the merge that takes it up) on one side of a token: side 1 is its right edge."""
        out, taken = [], len(self.rank) + 1
        while True:
            out.append((token, taken))
            if token not in self.parts:
                return out
            taken = self.parts[token][2]
            token = self.parts[token][side]

    def fits(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' bytes together gives just them."""
        got = self.compatible.get((left, right))
        if got is None:
            got = True
            for a, a_taken in self.spine(left, 1):
                for b, b_taken in self.spine(right, 0):
                    r = self.rank.get((a, b))
                    # Equal merges go from left to right, so that at equal rank the piece on the left is taken first.
                    if r is not None and r < a_taken and r <= b_taken:
                        got = False
                        break
                if not got:
                    break
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
            self.compatible[left, right] = got
        return got

    def encode_piece(self, raw: bytes) -> list[int]:
        """ids of one pre-token."""
        last: list[int | None] = [None] * (len(raw) + 1)
        length = [0] * (len(raw) + 1)
        fits = self.fits
        for at, (token, size) in self.automaton.iter(raw.decode("latin-1")):
            end = at + 1
            if last[end] is None:
                before = end - size
                if before == 0 or (last[before] is not None and fits(last[before], token)):
                    last[end], length[end] = token, size
        ids, end = [], len(raw)
        while end:
            ids.append(last[end])
            end -= length[end]
        return ids[::-1]

    def pre_tokens(self, text: str) -> list[str]:
        """By the pattern; text past U+0530 is cut by the library itself, whose Unicode tables can be older than the regex module's."""
        if text.isascii() or max(text) < "\u0530":
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, text: str) -> bytes:
        """ids of a text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        known = self.known
        for part in self.cut(text):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            found = self.pre_tokens(part)
            if len(known) > KEPT:
                known.clear()
            for p in set(found).difference(known):
                known[p] = np.array(self.encode_piece(p.encode()), dtype="<u4").tobytes()
            out += map(known.__getitem__, found)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def codec(path: str) -> BpeCodec:
    """The codec of a file, made once per worker."""
    if path not in _codecs:
        _codecs[path] = BpeCodec(path)
    return _codecs[path]


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (little-endian unsigned 32-bit) and the text decoded from them."""

    def run(reader):
        for batch in reader:
            for part, texts in rows_of(batch, "text"):
                c = codec(path)
                ids = [c.encode(t or "") for t in texts]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(c.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary, decoded string")


def codec_digests(docs: DataFrame, path: str) -> DataFrame:
    """As encode_and_decode, with digests in place of the ids and texts, so that these do not travel back to the JVM."""

    def run(reader):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in reader:
            for part, texts in rows_of(batch, "text"):
                c = codec(path)
                ids = [c.encode(t or "") for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array((sha(c.decode(x).encode()) for x in ids), pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return codec_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
