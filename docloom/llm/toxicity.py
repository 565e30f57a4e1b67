"""Toxicity by a weighted finite-state pattern grammar.

A clause with a word of the insult or threat lexicon becomes a string of symbols: I insult, W intent (will, going to), H harm, T target (second and third
person), N negation, R reported speech, O other. Four transducers run over it one after another, each reading what the one before wrote:
threat (intent followed by harm becomes an insult-like match), negation (a match up to three words after a negation becomes
``n``), reported speech (a match after a reporting word, or between quotation marks, becomes ``r``) and target (a match with a target in
reach becomes ``t``). Sums of the lexicon weights of all, targeted, negated and reported matches over the clauses go through a logistic
function.

Training: the insult lexicon (words, and word stems with several endings) has the words that are much likelier in toxic rows, the
logistic weights are fitted by Newton steps. Both come from at most ``sample`` labelled rows (a documented bound, default 20,000; by hash
of the id), never from held-out ones. Scoring never sees labels, languages, sources or ids.

Defined cases: null and empty texts have no matches and get the base rate's score; ids that are null are not held out; labels that are null or whose
document is missing are ignored; without labels of both kinds the lexicon is empty (threats alone match) and default weights hold; repeated rows are each returned; an empty table gives an empty result;
of words equally likely the first by name stay in the lexicon, which holds at most ``LEXICON`` entries; other columns are kept, whatever their names; a text is read once, however long.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import prepare, table

#: Labelled rows of the sample, score of a toxic row, entries of the lexicon at most.
SAMPLE, THRESHOLD, LEXICON = 20_000, 0.3, 5_000
MIN_SUPPORT, MIN_RATIO, MIN_ENDINGS = 8, 3.0, 4
STEMS = (4, 5, 6)
TARGETS = frozenset("you your yours u ur they them he him she her du dich dir ihr euch sie tu toi vous il elle tú usted vosotros ellos ella".split())
NEGATIONS = frozenset("not no never nobody isn't aren't wasn't don't doesn't without nicht kein keine nie niemals pas jamais ne nunca jamás".split())
REPORTING = frozenset("said says called calls wrote writes quoted quote reported claims claimed sagte nannte schrieb dit appelé écrit dijo llamó escribió".split())
INTENT = frozenset("will gonna shall i'll we'll werde werden vais allons voy vamos".split())
HARM = frozenset("kill hurt destroy shoot stab strangle beat töten verletzen tuer frapper matar golpear".split())
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”«»]")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_DEFAULT = (-3.0, 2.0, 2.5, 1.0, 1.0)


@dataclass
class Transducer:
    """Deterministic, with a default arc per state: arcs[state][symbol] = (next state, written symbol; None writes what was read)."""

    arcs: dict[str, dict[str, tuple[str, str | None]]]
    default: dict[str, str] = field(default_factory=dict)

    def run(self, symbols: str) -> str:
        state, out = "0", []
        for s in symbols:
            state, written = self.arcs[state].get(s, (self.default.get(state, state), None))
            out.append(written or s)
        return "".join(out)


#: Intent, then harm within four words: the harm word is a match.
THREAT = Transducer(
    {"0": {"W": ("1", None)}, **{str(k): {"H": ("0", "I"), "W": ("1", None)} for k in range(1, 5)}},
    {"1": "2", "2": "3", "3": "4", "4": "0"},
)
#: A negation holds for three words.
NEGATION = Transducer(
    {"0": {"N": ("1", None)}, **{str(k): {"I": ("0", "n"), "N": ("1", None)} for k in range(1, 4)}},
    {"1": "2", "2": "3", "3": "0"},
)
#: After a reporting word up to the clause's end, and within quotation marks.
REPORT = Transducer({"0": {"R": ("1", None), "Q": ("q", None)}, "1": {"I": ("1", "r")}, "q": {"I": ("q", "r"), "Q": ("0", None)}})
#: A target, then a match within three words; for the other order the clause is read backwards.
TARGET = Transducer(
    {"0": {"T": ("1", None)}, **{str(k): {"I": ("0", "t"), "T": ("1", None)} for k in range(1, 4)}},
    {"1": "2", "2": "3", "3": "0"},
)


def transduce(symbols: str) -> str:
    for t in (THREAT, NEGATION, REPORT, TARGET):
        symbols = t.run(symbols)
    return TARGET.run(symbols[::-1])[::-1]


class Grammar:
    """Scores texts with a lexicon of words and stems."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], weights=_DEFAULT):
        self.words, self.stems, self.weights = words, stems, weights
        sizes = sorted({len(x) for x in stems}, reverse=True)
        self.sizes = sizes
        entries = sorted({*words, *stems, *HARM}, key=len, reverse=True)
        import ahocorasick

        self.finder = ahocorasick.Automaton()
        for x in entries:
            self.finder.add_word(x, len(x))
        self.finder.make_automaton()

    def weight(self, word: str) -> float:
        got = self.words.get(word, 0.0)
        for n in self.sizes:
            if len(word) > n:
                got = max(got, self.stems.get(word[:n], 0.0))
        return got

    def clause(self, text: str) -> dict[str, float]:
        """Weights of a clause's matches by kind: I plain, t targeted, n negated, r reported."""
        tokens = _WORD.findall(text)
        weights = [self.weight(t) for t in tokens]
        symbols = "".join(
            "I" if w else "H" if t in HARM else "W" if t in INTENT else "N" if t in NEGATIONS else "R" if t in REPORTING else "T" if t in TARGETS else "Q" if not t[0].isalpha() else "O"
            for t, w in zip(tokens, weights, strict=True)
        )
        out = dict.fromkeys("Itnr", 0.0)
        for s, w in zip(transduce(symbols), weights, strict=True):
            if s in out:
                out[s] += w or 1.0
        return out

    def features(self, text: str | None) -> np.ndarray:
        """log(1 + sum of weights) of all matches (negated and reported ones by half), and of the targeted, negated and reported ones."""
        low = (text or "").lower()
        sums = np.zeros(4)
        done, starts, ends = -1, None, None
        for end, size in self.finder.iter(low):
            start = end - size + 1
            if start <= done or (start and (low[start - 1].isalpha())):
                continue
            if starts is None:
                cuts = [m.span() for m in _CLAUSE.finditer(low)]
                starts, ends = [0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(low)]
            at = bisect_right(starts, start) - 1
            left, right = starts[at], ends[at]
            done = right - 1
            got = self.clause(low[left:right])
            sums += [got["I"] + got["t"] + 0.5 * (got["n"] + got["r"]), got["t"], got["n"], got["r"]]
        return np.log1p(sums)

    def score(self, text: str | None) -> float:
        z = self.weights[0] + float(self.features(text) @ np.array(self.weights[1:]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_words(reader):
    """Per task: rows with each word and stem among the toxic and the other rows; and of each stem in toxic rows its first endings, as rows of their own.
    More than ``MIN_ENDINGS`` of one task would not change whether all tasks together have as many."""
    found: dict[int, Counter] = {0: Counter(), 1: Counter()}
    endings: dict[str, set] = {}
    rows = Counter()
    for batch in reader:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = set(_WORD.findall((text or "").lower()))
            rows[toxic] += 1
            stems = {(w[:n], w[n:]) for w in words for n in STEMS if len(w) > n}
            found[toxic].update(words)
            found[toxic].update({f"{s}*" for s, _ in stems})
            if toxic:
                for s, e in stems:
                    endings.setdefault(s, set()).add(e)
    out = [(k, found[1][k], found[0][k], None) for k in found[1].keys() | found[0].keys()]
    out += [(f"{s}*", 0, 0, e) for s, some in endings.items() for e in sorted(some)[:MIN_ENDINGS]]
    out.append(("", rows[1], rows[0], None))
    columns = list(zip(*out, strict=True))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["entry", "pos", "neg", "ending"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """A grammar fitted to at most ``sample`` labelled rows that are not held out."""
    spark = docs.sparkSession
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    )  # fmt: skip  at most ``sample`` rows
    seeds = Grammar({}, {})
    if chosen["toxic"].nunique() < 2:
        return seeds
    prepare(spark)
    small = spark.createDataFrame(chosen, "doc_id long, toxic int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(small), "doc_id").select("text", "toxic")
    counts = rows.mapInArrow(_count_words, "entry string, pos long, neg long, ending string").groupBy("entry", "ending").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # Endings are distinct over all sampled rows
    counts = counts.groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("ending").alias("endings"))
    totals = counts.filter("entry = ''").first()
    if not totals or not totals["pos"] or not totals["neg"]:
        return seeds
    n1, n0 = totals["pos"], totals["neg"]
    ratio = F.log((F.col("pos") + 0.5) / (n1 + 1)) - F.log((F.col("neg") + 0.5) / (n0 + 1))
    # The likeliest entries
    best = counts.filter((F.col("entry") != "") & (F.col("pos") >= MIN_SUPPORT)).withColumn("ratio", ratio).filter(F.col("ratio") >= MIN_RATIO).orderBy(F.desc("ratio"), "entry").limit(LEXICON).collect()
    words = {r["entry"]: min(1.0, r["ratio"] / 6) for r in best if not r["entry"].endswith("*")}
    stems = {r["entry"][:-1]: min(1.0, r["ratio"] / 6) for r in best if r["entry"].endswith("*") and r["endings"] >= MIN_ENDINGS}
    grammar = Grammar(words, stems)

    def measure(reader):
        for batch in reader:
            x = [grammar_of(words, stems).features(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])

    got = rows.mapInArrow(measure, "x array<double>, toxic int").toPandas()  # at most one row for each of the sample
    x, y = np.array(got["x"].tolist()), got["toxic"].to_numpy(dtype=np.float64)
    grammar.weights = fit(x, y)
    return grammar


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic weights, base first, by Newton steps with a ridge on all but the base."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


_made: dict[int, tuple] = {}


def grammar_of(words: dict, stems: dict, weights=_DEFAULT) -> Grammar:
    """One automaton for each lexicon and worker."""
    key = id(words)
    if key not in _made or _made[key][0] is not words:
        _made.clear()
        _made[key] = (words, Grammar(words, stems, weights))
    return _made[key][1]


def toxicity(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= threshold) appended; columns of these names are replaced."""
    words, stems, weights = grammar.words, grammar.stems, grammar.weights
    names = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(reader):
        for batch in reader:
            g = grammar_of(words, stems, weights)
            scores = [g.score(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], [*names, "score", "predicted"])

    from pyspark.sql import types as T

    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select(*names).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below the threshold, with all their columns as they are."""
    prepare(docs.sparkSession)
    words, stems, weights = grammar.words, grammar.stems, grammar.weights

    def run(reader):
        for batch in reader:
            g = grammar_of(words, stems, weights)
            yield batch.filter(pa.array([g.score(t) < threshold for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _score_ids(docs: DataFrame, grammar: Grammar) -> DataFrame:
    words, stems, weights = grammar.words, grammar.stems, grammar.weights

    def run(reader):
        for batch in reader:
            g = grammar_of(words, stems, weights)
            scores = [g.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    return docs.mapInArrow(run, "doc_id long, score double, predicted int")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _score_ids(docs, train(docs, table(spark, sf_dir, "labels"))).select("doc_id", held_out().alias("held_out"), "score", "predicted")
