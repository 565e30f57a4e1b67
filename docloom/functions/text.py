"""Text functions as Spark columns: tokens, sentences, tables, titles, tables of contents, file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentence-final abbreviations (Italian), topics by file-name keyword, boilerplate titles, editorial keywords.
ABBREVIATIONS = (
    "art artt c.c d.lgs d.l d.p.r d.m lett co comma commi ecc cfr etc es sig sigg prof dott ing avv geom arch rag dr mr mrs vol cap par fig tab pag pp ss"
).split()
TOPICS = (
    ((("IVA",),), "IVA / Imposta Valore Aggiunto"), ((("AMMORTAMENT",),), "Ammortamenti / Cespiti"), ((("CEDOLINO",), ("PAGA",), ("PAGHE",)), "Lavoro / Paghe"),
    ((("ISA",),), "ISA / Indici Affidabilità"), ((("CU", "CERTIFICAZIONE"),), "Certificazione Unica"), ((("BILANCIO",),), "Bilancio / Contabilità"),
    ((("ANTIRICIC",),), "Antiriciclaggio"), ((("INPS",), ("ENASARCO",), ("PREVIDEN",)), "Previdenza / Contributi"),
    ((("IMMOBILIAR",), ("LOCAZION",), ("IMU",)), "Immobili / Locazioni"), ((("TERZO SETTORE",), ("ETS",)), "Enti Terzo Settore"), ((("PRIVACY",), ("GDPR",)), "Privacy / GDPR"),
)
DEFAULT_TOPIC = "Fisco Generico"
BOILERPLATE_TITLES = (
    r"^introduzione$", r"istruzioni?\s+(per|di)\s+attivare", r"e-book\s+(on-?line|gratuito)", r"^come\s+usare", r"^avvertenze?$",
    r"^note\s+(editoriali?|legali?)", r"^copyright", r"^colophon", r"^responsabile\s+editoria", r"^centro\s+studi", r"^autori?$",
    r"^ringraziamenti?$", r"^prefazione$", r"^presentazione$", r"codice\s+(di\s+)?attivazione", r"registra(zione|ti)", r"^indirizzo\s+web",
)
EDITORIAL = ("isbn", "finito di stampare", "editore:", "prezzo:", "grafica di copertina", "stampato da", "stampa:", "tipografia", "copyright ©", "tutti i diritti riservati", "proprietà letteraria", "printed in italy")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TOC_LINE = r"(?iUd)(?:[.·]{2,}|\s+pag\.|\s*»\s*)\s*\d+$"
TOC_RATIO_LINE = r"(?iUd)(?:[\\.·]{2,}|\s+pag\.|\s*»\s*)\s*\d+$"


def stripped(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def bm25_tokens(c: Column) -> Column:
    """Lower-cased, ASCII punctuation as blanks, split at white space; a stemmer, if any, is applied by the caller."""
    return words(F.translate(F.lower(c), PUNCTUATION, " " * len(PUNCTUATION)))


def word_count(c: Column) -> Column:
    """The token counter that needs no model."""
    return F.size(words(c))


def sentences(c: Column) -> Column:
    """Split after ``.!?`` (and up to two quotes) before upper case, a digit or ``*``; an abbreviation's split is undone if what follows starts lower."""
    pieces = F.filter(F.transform(F.split(c, r"(?U)(?<=[.!?][\"']{0,2})\s+(?=[A-ZÀÈÉÌÒÙ0-9\*])"), stripped), lambda x: x != "")
    known = F.array(*[F.lit(x) for x in ABBREVIATIONS])

    def last_word(x: Column) -> Column:
        return F.regexp_replace(F.element_at(F.split(F.lower(x), r"(?U)\s+"), -1), r"[.,;:]+$", "")

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(False).alias("merged"))

    def step(acc: Column, x: Column) -> Column:
        previous = F.element_at(acc["done"], -1)
        joins = (F.size(acc["done"]) > 0) & ~acc["merged"] & F.array_contains(known, last_word(previous)) & ~x.rlike(r"^\p{Lu}")
        joined = F.concat(F.slice(acc["done"], 1, F.greatest(F.size(acc["done"]) - 1, F.lit(0))), F.array(F.concat_ws(" ", previous, x)))
        return F.when(joins, F.struct(joined.alias("done"), F.lit(True).alias("merged"))).otherwise(F.struct(F.concat(acc["done"], F.array(x)).alias("done"), F.lit(False).alias("merged")))

    return F.aggregate(pieces, start, step, lambda acc: acc["done"])


def simple_sentences(c: Column) -> Column:
    return F.split(c, r"(?U)(?<=[.?!])\s+")


def tables(c: Column) -> Column:
    """All complete HTML tables; a nested one ends at the first closing tag."""
    return F.regexp_extract_all(c, F.lit(r"(?is)<table[^>]*>.*?</table>"), F.lit(0))


def has_table(c: Column) -> Column:
    return F.lower(c).contains("<table") & F.lower(c).contains("</table>")


def repair_tables(c: Column) -> Column:
    """Close a table that is open when another opens, and one that is open at the end."""
    parts = F.split(c, r"(?i)(?=<table[^>]*>)|(?<=</table>)")
    start = F.struct(F.lit("").alias("out"), F.lit(False).alias("open"))

    def step(acc: Column, x: Column) -> Column:
        opens, closes = x.rlike(r"(?i)^<table[^>]*>"), x.rlike(r"(?i)</table>\z")
        return F.struct(
            F.concat(acc["out"], F.when(opens & acc["open"], F.lit("</table>\n")).otherwise(F.lit("")), x).alias("out"),
            F.when(closes, F.lit(False)).when(opens, F.lit(True)).otherwise(acc["open"]).alias("open"),
        )

    return F.aggregate(parts, start, step, lambda acc: F.concat(acc["out"], F.when(acc["open"], F.lit("\n</table>")).otherwise(F.lit(""))))


def balance_tables(c: Column) -> Column:
    """As many closing as opening tags: surplus ones go from the front, missing ones are added at the end."""
    return let(c, lambda c: let(F.struct(F.regexp_count(c, F.lit("(?i)<table")).alias("opens"), F.regexp_count(c, F.lit("(?i)</table>")).alias("closes")), lambda n: _balanced(c, n["opens"], n["closes"])))


def _balanced(c: Column, opens: Column, closes: Column) -> Column:
    fewer = F.aggregate(F.sequence(F.lit(1), F.greatest(closes - opens, F.lit(1))), c, lambda acc, _: F.regexp_replace(acc, r"(?isU)\A(.*?)\s*</table>\s*", "$1"))
    more = F.concat(F.regexp_replace(c, r"(?U)\s+\z", ""), F.repeat(F.lit("\n</table>"), F.greatest(opens - closes, F.lit(0))))
    return F.when(closes > opens, fewer).when(opens > closes, more).otherwise(c)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value made once: an expression that a lambda names is otherwise made anew for every element, and wherever it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_table(c: Column, budget: Column | int, count=word_count) -> Column:
    """A table's rows in parts of at most 95 % of the budget, each with the header rows; the table itself if that cannot be."""
    most = F.floor(F.lit(0.95) * (budget if isinstance(budget, Column) else F.lit(budget)))

    def split(c: Column, rows: Column, marked: Column) -> Column:
        head = F.when(F.size(marked) > 0, marked).otherwise(F.slice(rows, 1, 1))
        body = F.when(F.size(marked) > 0, F.filter(rows, lambda x: ~x.rlike("(?i)<th"))).otherwise(F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))))
        opening = F.concat(F.regexp_extract(c, r"(?is)<table[^>]*>", 0), F.lit("\n"), F.array_join(head, "\n"), F.lit("\n"))
        return let(F.struct(body.alias("body"), opening.alias("opening")), lambda x: made(c, x["body"], x["opening"]))

    def made(c: Column, body: Column, opening: Column) -> Column:
        def packed(room: Column) -> Column:
            parts = F.transform(pack(body, room, "\n", count), lambda x: F.concat(opening, x, F.lit("\n</table>")))
            return F.when((F.size(body) > 0) & (room > 0), parts).otherwise(F.array(c))

        return let(most - count(F.concat(opening, F.lit("</table>"))), packed)

    rows = lambda c: F.regexp_extract_all(c, F.lit(r"(?is)<tr[^>]*>.*?</tr>"), F.lit(0))
    return let(c, lambda c: let(rows(c), lambda r: let(F.filter(r, lambda x: x.rlike("(?i)<th")), lambda m: split(c, r, m))))


def pack(items: Column, budget: Column | int, joiner: str, count=word_count) -> Column:
    """Neighbours joined as long as the count of the whole stays within the budget. Words with white space between them add up, so they are counted once an item."""
    budget = budget if isinstance(budget, Column) else F.lit(budget)
    adds = count is word_count and joiner != "" and joiner.isspace()
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column, n: Column) -> Column:
        none = acc["cur"] == ""
        longer = F.when(none, x).otherwise(F.concat(acc["cur"], F.lit(joiner), x))
        total = acc["n"] + n if adds else count(longer)
        flushed = F.struct(F.concat(acc["done"], F.array(acc["cur"])).alias("done"), x.alias("cur"), n.alias("n"))
        return F.when(none | (total <= budget), F.struct(acc["done"].alias("done"), longer.alias("cur"), (acc["n"] + n).alias("n"))).otherwise(flushed)

    counted = lambda acc, x: let(count(x), lambda n: step(acc, x, n)) if adds else step(acc, x, F.lit(0))
    return F.aggregate(items, start, counted, lambda acc: F.when(acc["cur"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["cur"]))))


def legal_split(c: Column, budget: int, count=word_count) -> Column:
    """Parts at lettered or numbered items in italics (``*a)``), packed up to the budget; a numbered preamble stays with the first item."""
    return let(c, lambda c: let(F.split(c, r"(?i)(?=\n\*(?:[a-z]|[a-z]+-[a-z]+|[0-9]+)\))"), lambda pieces: _legal(c, pieces, budget, count)))


def _legal(c: Column, pieces: Column, budget, count) -> Column:
    glued = F.size(pieces).__gt__(1) & stripped(pieces[0]).rlike(r"(?md)\d+\.\s+\*?[^*\n]+\*?\s*[:.]?\s*$")
    items = F.when(glued, F.concat(F.array(F.concat(pieces[0], F.coalesce(F.get(pieces, F.lit(1)), F.lit("")))), F.slice(pieces, 3, F.greatest(F.size(pieces), F.lit(1))))).otherwise(pieces)
    packed = F.filter(F.transform(pack(items, budget, "", count), stripped), lambda x: x != "")
    return F.when(F.size(pieces) > 1, packed).otherwise(F.array(c))


def paragraph_pack(c: Column, budget: int, count=word_count, cut_at=sentences) -> Column:
    """Paragraphs packed up to the budget; an oversize one is cut into sentences only if nothing is pending before it."""
    paragraphs = F.filter(F.transform(F.split(c, r"(?U)\n\s*\n"), stripped), lambda x: x != "")
    adds = count is word_count
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column, n: Column) -> Column:
        longer = F.when(acc["cur"] == "", x).otherwise(F.concat(acc["cur"], F.lit("\n\n"), x))
        total = acc["n"] + n if adds else count(longer)
        flushed = F.struct(F.concat(acc["done"], F.array(acc["cur"])).alias("done"), x.alias("cur"), n.alias("n"))
        cut = F.struct(F.concat(acc["done"], pack(F.filter(F.transform(cut_at(x), stripped), lambda y: y != ""), budget, " ", count)).alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))
        return F.when(total <= budget, F.struct(acc["done"].alias("done"), longer.alias("cur"), (acc["n"] + n).alias("n"))).when(acc["cur"] == "", cut).otherwise(flushed)

    counted = lambda acc, x: let(count(x), lambda n: step(acc, x, n)) if adds else step(acc, x, F.lit(0))
    return F.aggregate(paragraphs, start, counted, lambda acc: F.when(acc["cur"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["cur"]))))


def truncated(c: Column, budget: int, count=word_count) -> Column:
    """A text above the budget cut to ten words less than it, without a tag that was cut open near the end, and with its tables closed."""
    pieces = F.split(c, r"(?U)(?<=\s)(?=\S)")
    cut = F.array_join(F.slice(pieces, 1, max(1, budget - 10)), "")
    open_tag = lambda cut: F.right(cut, F.lit(50)).contains("<") & ~F.right(cut, F.lit(20)).contains(">")
    closed = let(cut, lambda cut: balance_tables(F.when(open_tag(cut), F.regexp_replace(cut, r"(?s)<[^<]*\z", "")).otherwise(cut)))
    return F.when(count(c) <= budget, c).otherwise(closed)


def content_length(c: Column) -> Column:
    """Characters without context blocks, headings and rules; the metadata line counts."""
    bare = F.regexp_replace(c, r"(?s)\[CONTESTO\].*?\[/CONTESTO\]", "")
    return F.length(stripped(F.regexp_replace(F.regexp_replace(bare, r"(?md)^#+\s+.*$", ""), r"(?md)^---+$", "")))


def clean_title(c: Column) -> Column:
    return stripped(F.regexp_replace(F.regexp_replace(c, r"(?U)^#+\s*", ""), r"[*_]+", ""))


def is_boilerplate(c: Column) -> Column:
    return F.lower(clean_title(c)).rlike("(?iU)" + "|".join(BOILERPLATE_TITLES))


def is_editorial(c: Column) -> Column:
    """Off by default in the chunker: shorter chunks than it looks at are dropped before."""
    return (content_length(c) < 300) & reduce(lambda a, b: a | b, [F.lower(c).contains(x) for x in EDITORIAL])


def is_toc_entry(c: Column) -> Column:
    h = stripped(c)
    return F.upper(h).contains("INDICE") | h.rlike(r"(?U)\d+\z") | h.rlike(r"[.·]{2,}") | h.rlike(r"(?U)^##\s*\d+\.") | h.rlike(r"(?iU)\b(Sezione|Parte|Capitolo|Appendice)\b")


def toc_lines(c: Column, pattern: str = TOC_LINE) -> Column:
    return F.size(F.filter(F.split(stripped(c), "\n"), lambda x: stripped(x).rlike(pattern)))


def has_toc_lines(c: Column) -> Column:
    return toc_lines(c) > 0


def toc_ratio(c: Column) -> Column:
    return toc_lines(c, TOC_RATIO_LINE) / F.size(F.split(stripped(c), "\n"))


def clean_toc_lines(c: Column) -> Column:
    lines = F.transform(F.split(c, "\n"), lambda x: stripped(F.regexp_replace(F.regexp_replace(x, r"(?iU)(?:[.·]{2,}|\s*»\s*|\s+pag\.)", " "), r"(?U)\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def joins_previous(previous: Column) -> Column:
    """Whether text on a new page goes on with what stands before it."""
    return (stripped(previous) != "") & ~stripped(previous).rlike(r"[.!?:]\z")


def file_metadata(c: Column) -> Column:
    """struct<year, topic, source_cleaned> of a Markdown file's name."""
    year = F.regexp_extract(c, r"(20\d{2})", 1)
    upper = F.upper(c)
    topic = F.lit(DEFAULT_TOPIC)
    for keys, name in reversed(TOPICS):
        hit = reduce(lambda a, b: a | b, [reduce(lambda p, q: p & q, [upper.contains(x) for x in k]) for k in keys])
        topic = F.when(hit, F.lit(name)).otherwise(topic)
    name = F.regexp_replace(F.replace(F.replace(c, F.lit(".md"), F.lit("")), F.lit("_"), F.lit(" ")), r"(?iU)\s+(Digitale|PS|UO)\s*$", "")
    cleaned = F.when(year != "", F.replace(name, year, F.lit(""))).otherwise(name)
    return F.struct(F.when(year == "", F.lit("N/A")).otherwise(year).alias("year"), topic.alias("topic"), stripped(cleaned).alias("source_cleaned"))


def resized(width: Column, height: Column, most: int = 2048) -> Column:
    """struct<width, height> of an image within ``most`` on its longer side."""
    ratio = F.lit(float(most)) / F.greatest(width, height)
    fits = F.greatest(width, height) <= most
    return F.struct(F.when(fits, width).otherwise(F.floor(width * ratio).cast("int")).alias("width"), F.when(fits, height).otherwise(F.floor(height * ratio).cast("int")).alias("height"))


def without_fence(c: Column) -> Column:
    return stripped(F.regexp_replace(F.regexp_replace(stripped(c), r"^```(?:json)?\s*", ""), r"\s*```\z", ""))


def safe_json(c: Column) -> Column:
    """The text as JSON (variant): whole, or from the first ``{`` to the last ``}``; null if neither parses."""
    return F.coalesce(F.try_parse_json(c), F.try_parse_json(F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))))
