"""Pluggable models: what the engine needs of OCR, tokenizers, stemmers and language models, with offline stand-ins."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable
from functools import cache
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class OcrModel(Protocol):
    def __call__(self, image: bytes) -> str: ...


class Stemmer(Protocol):
    def __call__(self, token: str) -> str: ...


def stemmed(tokens: Column, stemmer: Stemmer) -> Column:
    """Tokens through a stemmer, in Arrow batches, each distinct token once per batch."""

    @F.pandas_udf("array<string>")
    def run(lists: pd.Series) -> pd.Series:
        known: dict[str, str] = {}
        return lists.map(lambda xs: None if xs is None else [known[x] if x in known else known.setdefault(x, stemmer(x)) for x in xs])

    return run(tokens)


@cache
def _tokenizer(path: str):
    """Loaded once per worker."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_counter(path: str) -> Callable[[Column], Column]:
    """A counter for columns by a tokenizers file."""

    def count(c: Column) -> Column:
        @F.pandas_udf("int")
        def run(texts: pd.Series) -> pd.Series:
            return pd.Series([len(e.ids) for e in _tokenizer(path).encode_batch([x or "" for x in texts], add_special_tokens=False)])

        return run(c)

    return count


def png(image: np.ndarray) -> bytes:
    """An 8-bit image as PNG in RGB: grey is copied to all channels, an alpha channel is left out."""
    shaped = image[:, :, None] if image.ndim == 2 else image
    rgb = np.ascontiguousarray(np.repeat(shaped[:, :, :1], 3, axis=2) if shaped.shape[2] < 3 else shaped[:, :, :3], dtype=np.uint8)
    height, width = rgb.shape[:2]
    lines = np.zeros((height, 1 + 3 * width), np.uint8)  # each line begins with its filter: none
    lines[:, 1:] = rgb.reshape(height, -1)
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines.tobytes())) + part(b"IEND", b"")


def page_counts(files: DataFrame, count: Callable[[bytes], int]) -> DataFrame:
    """``files`` (with content) and their number of pages; 0 if they cannot be read, so that they give no blocks."""

    @F.pandas_udf("int")
    def pages(contents: pd.Series) -> pd.Series:
        def one(content: bytes) -> int:
            try:
                return count(content)
            except Exception:  # an unreadable file has no pages
                return 0

        return contents.map(one)

    return files.withColumn("pages", pages("content"))


_PAGE = "source string, page int, text string, missing boolean, image binary, blocks string"


def read_pages(blocks: DataFrame, render, make_model: Callable[[], OcrModel], layout=None, images: bool = False) -> DataFrame:
    """(source, page, text, missing, image, blocks) of page blocks (stem, content, first, last): a row for each page asked for. Pages that are not rendered are missing,
    without text; a page whose OCR fails reads ``> [Error]``. ``layout`` maps an image to a list of blocks (JSON; [] if it fails); images are kept if asked for."""

    def page(model, source: str, number: int, image: bytes | None):
        if image is None:
            return source, number, None, True, None, None
        try:
            text = model(image)
        except Exception as e:  # the page's text says that it failed
            text = f"> [Error] {e}"
        found = None
        if layout is not None:
            try:
                found = json.dumps(layout(image), ensure_ascii=False)
            except Exception:  # no layout is no block
                found = "[]"
        return source, number, text, False, image if images else None, found

    def run(batches):
        model = make_model()
        for batch in batches:
            for stem, content, first, last in zip(batch["stem"], batch["content"], batch["first"], batch["last"], strict=True):
                try:
                    rendered = dict(render(content, first, last))
                except Exception:  # an unreadable block has missing pages only
                    rendered = {}
                yield pd.DataFrame([page(model, stem, n, rendered.get(n)) for n in range(first, last + 1)], columns=[x.split()[0] for x in _PAGE.split(", ")])

    return blocks.select("stem", "content", "first", "last").mapInPandas(run, _PAGE)


def ocr_pages(blocks: DataFrame, render: Callable[[bytes, int, int], list[tuple[int, bytes]]], make_model: Callable[[], OcrModel]) -> DataFrame:
    """(source, page, text) of the pages that could be rendered."""
    return read_pages(blocks, render, make_model).filter("not missing").select("source", "page", "text")


def echo_client() -> Callable[[str], dict]:
    """An offline stand-in for a language model: one question about the prompt's length."""

    def call(prompt: str) -> dict:
        n = len(prompt)
        return {"response": json.dumps({"mixed_qas": [{"type": "len", "q": f"Lunghezza {n}?", "a": f"{n} caratteri"}], "paraphrase": prompt[:80]}), "prompt_tokens": n // 4, "completion_tokens": 20}

    return call
