"""Long texts cut to a token budget by a real tokenizer: the rules of ``functions.text`` on strings, for use in Arrow batches.

The column functions count words; a subword count is not the sum over a text's pieces, so every candidate is counted whole. Text within one section is bounded by
its document. Nothing is lost: where a part with several tables does not fit, each of its texts and tables is kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from docloom.functions.text import ABBREVIATIONS

TABLE = re.compile(r"<table[^>]*>.*?</table>", re.I | re.S)
ROW = re.compile(r"<tr[^>]*>.*?</tr>", re.I | re.S)
ITEM = re.compile(r"(?=\n\*(?:[a-z]|[a-z]+-[a-z]+|[0-9]+)\))", re.I)
PREAMBLE = re.compile(r"\d+\.\s+\*?[^*\n]+\*?\s*[:.]?\s*$", re.M)
BLANK_LINE = re.compile(r"\n\s*\n")
SENTENCE = re.compile(r"([.!?][\"']{0,2})\s+(?=[A-ZÀÈÉÌÒÙ0-9*])")
SIMPLE = re.compile(r"(?<=[.?!])\s+")
#: Tokens left free where a text is cut.
SPARE = 10


class Tokenizer(Protocol):
    def encode(self, text: str) -> list: ...

    def decode(self, tokens: list) -> str: ...


class Words:
    """White space as the tokenizer: what the column functions count."""

    def encode(self, text: str) -> list:
        return re.findall(r"\S+\s*", text)

    def decode(self, tokens: list) -> str:
        return "".join(tokens)


class Subwords:
    """A tokenizers file, without special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Loaded

        self.loaded = Loaded.from_file(path)

    def encode(self, text: str) -> list:
        return self.loaded.encode(text, add_special_tokens=False).ids

    def decode(self, tokens: list) -> str:
        return self.loaded.decode(tokens)


def sentences(text: str) -> list[str]:
    """As ``text.sentences``."""
    out, merged = [], False
    for piece in filter(None, (x.strip() for x in SENTENCE.sub("\\1\0", text).split("\0"))):
        last = re.sub(r"[.,;:]+$", "", out[-1].lower().split()[-1]) if out else ""
        merged = bool(out) and not merged and last in ABBREVIATIONS and not piece[0].isupper()
        if merged:
            out[-1] += " " + piece
        else:
            out.append(piece)
    return out


def simple_sentences(text: str) -> list[str]:
    return [x.strip() for x in SIMPLE.split(text) if x.strip()]


class Splitter:
    """Parts of a text within a budget of the tokenizer's tokens."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer

    def count(self, text: str) -> int:
        return len(self.tokenizer.encode(text))

    def packed(self, items: list[str], budget: int, joiner: str) -> list[str]:
        """Neighbours joined while the whole stays within the budget."""
        done: list[str] = []
        for item in items:
            longer = done[-1] + joiner + item if done else item
            if done and self.count(longer) <= budget:
                done[-1] = longer
            else:
                done.append(item)
        return done

    def legal(self, text: str, budget: int) -> list[str]:
        """Parts at lettered or numbered items; a numbered preamble stays with the first."""
        items = ITEM.split(text)
        if len(items) == 1:
            return items
        if PREAMBLE.search(items[0].strip()):
            items[:2] = [items[0] + items[1]]
        return [x.strip() for x in self.packed([x for x in items if x], budget, "") if x.strip()]

    def paragraphs(self, text: str, budget: int, cut: Callable[[str], list[str]]) -> list[str]:
        """Paragraphs packed; an oversize one is cut into sentences only if nothing is pending before it, and nothing is added to those."""
        done: list[str] = []
        pending = ""
        for p in filter(None, (x.strip() for x in BLANK_LINE.split(text))):
            longer = pending + "\n\n" + p if pending else p
            if self.count(longer) <= budget:
                pending = longer
            elif pending:
                done.append(pending)
                pending = p
            else:
                done += self.packed(cut(p), budget, " ")
        return done + [pending] * bool(pending)

    def table(self, html: str, budget: int) -> list[str]:
        """A table's rows in parts of at most 95 % of the budget, each with the header rows."""
        rows = ROW.findall(html)
        head = [x for x in rows if "<th" in x.lower()] or rows[:1]
        body = [x for x in rows if "<th" not in x.lower()] if head and "<th" in head[0].lower() else rows[1:]
        opening = re.match(r"<table[^>]*>", html, re.I).group() + "\n" + "\n".join(head) + "\n"
        room = int(0.95 * budget) - self.count(opening + "</table>")
        if not body or room <= 0:
            return [html]
        return [opening + x + "\n</table>" for x in self.packed(body, room, "\n")]

    def with_tables(self, text: str, budget: int) -> list[str]:
        """Paragraphs packed with each table counted as one mark; where the tables themselves do not fit, they are cut by rows between the texts around them."""
        found = TABLE.findall(text)
        if not found:
            return self.paragraphs(text, budget, sentences)
        marks = iter(range(len(found)))
        marked = TABLE.sub(lambda _: f"\1{next(marks)}\1", text)
        out = []
        for part in self.paragraphs(marked, budget, simple_sentences):
            pieces = [found[int(x)] if i % 2 else x for i, x in enumerate(part.split("\1"))]
            whole = "".join(pieces)
            if len(pieces) == 1 or self.count(whole) <= budget:
                out.append(whole)
                continue
            for i, x in enumerate(pieces):
                out += self.table(x, budget) if i % 2 else [x.strip()] * bool(x.strip())
        return out

    def parts(self, text: str, budget: int) -> list[str]:
        return [y for x in self.legal(text, budget) for y in self.with_tables(x, budget)]

    def truncated(self, text: str, budget: int) -> str:
        """Cut to ``SPARE`` tokens below the budget if above it, without a tag cut open near the end; open tables are closed, and count."""
        tokens = self.tokenizer.encode(text)
        if len(tokens) <= budget:
            return text
        for spare in range(SPARE, len(tokens)):
            cut = self.tokenizer.decode(tokens[: max(1, budget - spare)])
            if "<" in cut[-50:] and ">" not in cut[-20:]:
                cut = cut[: cut.rfind("<")].strip()
            missing = len(re.findall("<table", cut, re.I)) - len(re.findall("</table>", cut, re.I))
            cut = cut.rstrip() + "\n</table>" * missing if missing > 0 else cut
            if budget <= spare or self.count(cut) <= budget:  # a decoded text can have more tokens than it was made of
                return cut
        return cut


def split_sections(rows: DataFrame, make_tokenizer: Callable[[], Tokenizer], max_tokens: int, min_words: int) -> DataFrame:
    """(source, sec, clean, k, content) of ``rows`` (source, sec, clean, lead, body): each section's parts behind its lead, none above ``max_tokens``. One tokenizer for each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter(make_tokenizer())
        for batch in batches:
            out = []
            for source, sec, clean, lead, body in batch.itertuples(index=False):
                parts = splitter.parts(body, max_tokens - splitter.count(lead))
                out += [(source, sec, clean, k, splitter.truncated(lead + x, max_tokens)) for k, x in enumerate(parts) if len(x.split()) >= min_words]
            yield pd.DataFrame(out, columns=["source", "sec", "clean", "k", "content"])

    schema = f"source {rows.schema['source'].dataType.simpleString()}, sec {rows.schema['sec'].dataType.simpleString()}, clean string, k int, content string"
    return rows.select("source", "sec", "clean", "lead", "body").mapInPandas(run, schema)
