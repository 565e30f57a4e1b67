"""Numbers, amounts, dates and legal references in a text, normalised, and the check that an answer keeps a question's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names and units of time.
MONTHS = "gennaio|febbraio|marzo|aprile|maggio|giugno|luglio|agosto|settembre|ottobre|novembre|dicembre"
UNITS = "giorni|mesi|anni|rate|annualità"


def _all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def _dots(x: Column) -> Column:
    return F.replace(x, F.lit(","), F.lit("."))


def numbers(c: Column) -> Column:
    """Distinct normalised matches, lower-cased and stripped; one pattern per kind, so that alternation and overlap are the regex engine's."""
    amounts = F.transform(
        _all(c, r"(?iU)€\s*[\d.,]+|[\d.,]+\s*(?:euro|EUR)"),
        lambda x: F.when(x.contains(",") & x.contains("."), _dots(F.replace(x, F.lit("."), F.lit("")))).when(x.contains(","), _dots(x)).otherwise(x),
    )
    articles = _all(c, r"(?iU)\b(?:Art\.|Articolo)\s*(\d+)(?:[- ](?:bis|ter|quater))?\b", 1)
    percent = _all(c, r"(?iU)\b\d+(?:[.,]\d+)?\s*%|(\b\d+(?:[.,]\d+)?)\s+per\s+cento\b")
    signs = F.transform(F.filter(percent, lambda x: x.contains("%")), _dots)
    shares = F.transform(F.filter(percent, lambda x: ~x.contains("%")), lambda x: _dots(F.regexp_extract(x, r"^[\d.,]+", 0)))
    spans = _all(c, rf"(?iU)\b(\d+)(?:[.,](\d+))?\s+({UNITS})\b")
    whole = lambda x: F.regexp_extract(x, r"^\d+", 0)
    short = F.transform(
        F.filter(spans, lambda x: (F.length(whole(x)) <= 9) & (whole(x).try_cast("int") <= 100)),
        lambda x: F.concat_ws(" ", whole(x).try_cast("int").cast("string"), F.lower(F.regexp_extract(x, r"(?iU)(\w+)\z", 1))),
    )
    found = F.concat(
        _all(c, r"(?U)\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b"),
        _all(c, rf"(?iU)\b\d{{1,2}}°?\s+({MONTHS})\s+\d{{4}}\b"),
        amounts,
        F.transform(articles, lambda x: F.concat(F.lit("art. "), x)), F.transform(articles, lambda x: F.concat(F.lit("articolo "), x)),
        _all(c, r"(?iU)\b(?:D\.L\.|D\.Lgs\.|L\.)\s*\d+/\d{2,4}\b"),
        _all(c, r"(?iU)\bcomma\s+\d+\b"),
        signs, F.transform(shares, lambda x: F.concat(x, F.lit("%"))), F.transform(shares, lambda x: F.concat(x, F.lit(" per cento"))),
        F.transform(spans, _dots), short,
        _all(c, r"(?U)\b(?:19|20)\d{2}\b"),
    )
    return F.array_distinct(F.transform(found, lambda x: F.regexp_replace(F.lower(x), r"(?U)^\s+|\s+\z", "")))


def missing_numbers(question: Column, answer: Column) -> Column:
    """Sorted numbers of the question that the answer lacks."""
    return F.array_sort(F.array_except(numbers(question), numbers(answer)))
