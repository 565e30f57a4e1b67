"""Prompt templates as configuration: a format string whose fields are columns."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a judge is asked when no template of one's own is given.
JUDGE = 'Text:\n{doc}\n\nQuestion: {question}\nAnswer: {answer}\n\nRate from 1 to 5 how far the text supports the answer. Reply as JSON: {{"score": n, "justification": "...", "external_info": []}}'


def fields(template: str) -> set[str]:
    return {name for _, name, _, _ in Formatter().parse(template) if name is not None}


def filled(template: str, **columns: Column) -> Column:
    """``template`` with each ``{name}`` replaced by its column (null: empty); ``{{`` and ``}}`` are braces. An unknown field is an error when the plan is made."""
    unknown = fields(template) - set(columns)
    if unknown:
        raise ValueError(f"no column for {sorted(unknown)}")
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        parts += [F.lit(text)] * bool(text) + ([] if name is None else [F.coalesce(columns[name].cast("string"), F.lit(""))])
    return F.concat(*parts) if parts else F.lit("")
