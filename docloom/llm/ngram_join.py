"""N-gram Jaccard self-join by prefix filters under several global orders.

A document's set holds the 64-bit hashes of its distinct shingles of five words. Documents with Jaccard similarity t share a token among
the first ``n - ceil(t n) + 1`` tokens of both, under any global order of all tokens. Each order here puts frequent tokens last
(by counts over all documents, kept per task as mergeable summaries of bounded size) and shuffles the rest by its own hash. The
first order's prefixes are dealt out by token and give candidates. A candidate goes on only if its sizes and its counts per hash class
allow the threshold, and if the documents also share a token in the prefixes of the other orders; then its sets are intersected.

Documents with equal sets form a class, of which the first member stands for all. Prefix groups of at most ``small`` members give all their pairs. In a larger group
every member is first compared with a few pivots, then with its likeliest partners in other components, then with all partners that are still in other components. So no link
that joins two components is lost, and members that are connected already are not compared again.

Defined cases: A-Z are lower-cased; null text and texts without words have an empty set and link with nothing; with fewer than
five words, the whole sequence is the one shingle; ids may be null or repeated (rows are told apart by number); an empty table gives an
empty result; other columns are kept as they are, whatever their names; a very long text is worked on whole by one task.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import RID, Substrings, Words, batches, byte_values, materialize, mix, numbered, pieces, prepare, shingles, table
from docloom.llm.components import components

SIZE, PERCENT, SMALL, PIVOTS, LIKELIEST = 5, 75, 6, 3, 4
#: Counters in a summary of token frequencies; tokens of more than 1/SUMMARY of all occurrences are surely in it.
SUMMARY = 40_000
#: Token orders beside the first.
ORDERS = 2
#: A set has at least 2 ** CLASS_BITS hash classes, so that short sets get tight bounds too.
CLASS_BITS = 7
#: Names of large groups, the least ones, that a member carries to tell which group a pair is left to.
NAMES = 16
_PROFILE = ["rid", "doc_id", "n", "key", "classes", "tokens", "counts"]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(texts: list[bytes], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct shingle hashes in ascending order."""
    w = Words(texts)
    hashes, doc = shingles(w, Substrings(byte_values(_LOWER[w.data]))(w.starts, w.ends), size)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]) if len(h) else np.zeros(0, bool)
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(d[new], minlength=len(texts)))])


def prefix_length(n: np.ndarray | int, percent: int = PERCENT):
    """How many first tokens of a set of n can hold the first shared one of a pair at the threshold."""
    return n - -(-n * percent // 100) + 1


class Order:
    """Ranks of tokens: unlisted ones by hash, then the frequent ones by count."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, seed: int):
        at = np.argsort(frequent)
        self.frequent, self.level = frequent[at], np.floor(np.log2(np.maximum(counts[at], 1))).astype(np.uint64)
        self.seed = np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1)

    def rank(self, tokens: np.ndarray) -> np.ndarray:
        r = mix(tokens ^ self.seed) >> np.uint64(6)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, tokens), len(self.frequent) - 1)
            r = np.where(self.frequent[at] == tokens, r + (self.level[at] << np.uint64(58)), r)
        return r


def prefixes(tokens: np.ndarray, offsets: np.ndarray, order: Order, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(token, set index) of all prefixes."""
    n = np.diff(offsets)
    of = np.repeat(np.arange(len(n)), n)
    at = np.lexsort((order.rank(tokens), of))
    within = np.arange(len(tokens)) - offsets[:-1][of]
    keep = within < prefix_length(n, percent)[of]
    return tokens[at][keep], of[keep]


def class_counts(tokens: np.ndarray) -> bytes:
    """How many of the tokens fall into each hash class, about four to a class but never fewer than 2 ** CLASS_BITS classes; one byte each, the last value standing for any more."""
    k = 1 << max(CLASS_BITS, math.ceil(math.log2(max(1, len(tokens)) / 4)))
    return np.minimum(np.bincount((mix(tokens) & np.uint64(k - 1)).astype(np.int64), minlength=k), 255).astype(np.uint8).tobytes()


def may_link(n: int, counts: np.ndarray, sizes: np.ndarray, others: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(which of the sets ``others``, a row of counts each, can reach the threshold with a set of n; these ones' bounds on the shared tokens): no more are shared than the classes' lesser counts add up to."""
    small, large = np.minimum(sizes, n), np.maximum(sizes, n)
    ok = small * 100 >= percent * large
    most = np.zeros(0, np.int64)
    if ok.any():
        a, b = counts.astype(np.int32), others[ok].astype(np.int32)
        full = (a.max(initial=0) >= 255) | (b.max(axis=1, initial=0) >= 255)
        k = min(len(a), b.shape[1])
        a, b = a.reshape(-1, k).sum(axis=0), b.reshape(len(b), -1, k).sum(axis=1)
        most = np.minimum(a, b).sum(axis=1)
        fits = full | (100 * most >= percent * (n + sizes[ok] - most))
        ok[np.flatnonzero(ok)] = fits
        most = most[fits]
    return ok, most


def _possible(percent: int):
    """Drops pairs that cannot reach the threshold by their sizes and class counts."""

    def run(reader):
        for batch in reader:
            na, nb = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            near = np.minimum(na, nb) * 100 >= percent * np.maximum(na, nb)
            batch = batch.filter(pa.array(near))
            na, nb = na[near], nb[near]
            keep = [bool(may_link(x, np.frombuffer(p, np.uint8), np.array([y]), np.frombuffer(q, np.uint8)[None, :], percent)[0][0]) for x, y, p, q in zip(na.tolist(), nb.tolist(), batch.column("c_a").to_pylist(), batch.column("c_b").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _profile(reader):
    """Per row its set's size and digest; and per task one row with its summary of frequent tokens."""
    tokens, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch, texts in batches(reader, "text"):
        h, offsets = shingle_sets(texts)
        keys = [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        n = len(texts)
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(keys, pa.binary()), pa.array((class_counts(h[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)), pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], _PROFILE)
        everything, new = np.concatenate([tokens, h]), np.concatenate([counts, np.ones(len(h), np.int64)])
        order = np.argsort(everything, kind="stable")
        s = everything[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        tokens, counts = s[first], np.add.reduceat(new[order], first) if len(first) else new
        if len(tokens) > SUMMARY:
            cut = np.partition(counts, len(counts) - SUMMARY - 1)[len(counts) - SUMMARY - 1]
            tokens, counts = tokens[counts > cut], counts[counts > cut] - cut
    if len(tokens):
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([tokens.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())],
            _PROFILE,
        )


def _unpack(reader):
    for batch in reader:
        for t, c in zip(batch.column("tokens").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(t, np.int64)), pa.array(np.frombuffer(c, np.int64))], ["token", "n"])


def _dealer(order: Order, parts: int, percent: int):
    """Prefix tokens of each slice of rows, packed by part: (part, tokens, indices into rids, rids)."""

    def deal(reader):
        for batch, texts in batches(reader, "text"):
            h, offsets = shingle_sets(texts)
            tokens, of = prefixes(h, offsets, order, percent)
            rids = batch.column("rid").to_numpy()[of]
            to = (tokens % np.uint64(parts)).astype(np.int64)
            at = np.argsort(to, kind="stable")
            tokens, rids, to = tokens[at], rids[at], to[at]
            cuts = np.searchsorted(to, np.arange(parts + 1))
            rows = [(k, tokens[a:b].tobytes(), rids[a].item(), (rids[a:b] - rids[a]).astype("<i4").tobytes()) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.int64(), pa.binary()), strict=True)], ["part", "tokens", "rid", "steps"])

    return deal


def _grouper(small: int, pivots: int):
    """Groups of rows that share a prefix token. Small ones give all pairs; larger ones pairs with pivots and their members."""

    def close(tokens, rids):
        t, r = np.concatenate(tokens), np.concatenate(rids)
        order = np.lexsort((r, t))
        t, r = t[order], r[order]
        start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        size = np.diff(np.concatenate([start, [len(t)]]))
        left, right = [], []
        for k in range(2, small + 1):
            at = start[size == k]
            for i in range(k):
                for j in range(i + 1, k):
                    left.append(r[at + i])
                    right.append(r[at + j])
        token, member, known = [], [], set()
        for a, n in zip(start[size > small].tolist(), size[size > small].tolist(), strict=True):
            group = r[a : a + n]
            # Groups of the same members are one: their name is a digest of these. (Two that share a name by chance only give more pairs.)
            name = hashlib.blake2b(group.tobytes(), digest_size=8).digest()
            if name in known:
                continue
            known.add(name)
            # Pivots that other groups of the same documents choose too: the first, and the least by two hashes
            chosen = {int(group[0]), *(int(group[np.argmin(mix(group.view(np.uint64) ^ np.uint64(77 * k)))]) for k in range(1, pivots))}
            for p in chosen:
                others = group[group != p]
                left.append(np.minimum(others, p))
                right.append(np.maximum(others, p))
            token.append(np.repeat(np.frombuffer(name, np.int64), n))
            member.append(group)
        none = np.zeros(0, np.int64)
        left, right = (np.concatenate(x) if x else none for x in (left, right))
        if len(left):
            pair = np.unique(np.column_stack([left, right]), axis=0)
            left, right = pair[:, 0], pair[:, 1]
        token, member = (np.concatenate(x) if x else none for x in (token, member))
        n, m = len(left), len(token)
        for s in range(0, n + m, 100_000):
            e = s + 100_000
            a = np.concatenate([left, token])[s:e]
            b = np.concatenate([right, member])[s:e]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(s, min(e, n + m)) < n), pa.array(a), pa.array(b)], ["pair", "a", "b"])

    def run(reader):
        part, tokens, rids = None, [], []
        for batch in reader:
            for p, t, first, steps in zip(*(batch.column(c).to_pylist() for c in ("part", "tokens", "rid", "steps")), strict=True):
                if p != part:
                    if tokens:
                        yield from close(tokens, rids)
                    part, tokens, rids = p, [], []
                tokens.append(np.frombuffer(t, np.uint64))
                rids.append(np.frombuffer(steps, "<i4").astype(np.int64) + first)
        if tokens:
            yield from close(tokens, rids)

    return run


def _verifier(orders: list[Order], percent: int):
    """Links among candidate pairs: prefixes under the further orders must meet, then the sets decide."""

    def run(reader):
        for batch in reader:
            left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            names: dict[str, int] = {}
            at = [(names.setdefault(x or "", len(names)), names.setdefault(y or "", len(names))) for x, y in zip(left, right, strict=True)]
            sets, lengths, firsts = [], [], []
            texts = [x.encode() for x in names]
            for _, some in pieces(texts):
                h, offsets = shingle_sets(some)
                found = [prefixes(h, offsets, o, percent) for o in orders]
                cuts = [np.searchsorted(of, np.arange(len(some) + 1)) for _, of in found]
                for k in range(len(some)):
                    sets.append(h[offsets[k] : offsets[k + 1]])
                    firsts.append([t[c[k] : c[k + 1]] for (t, _), c in zip(found, cuts, strict=True)])
            keep = []
            for x, y in at:
                a, b = sets[x], sets[y]
                small, large = sorted((len(a), len(b)))
                ok = small * 100 >= percent * large and all(len(np.intersect1d(p, q)) for p, q in zip(firsts[x], firsts[y], strict=True))
                if ok:
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    ok = 100 * both >= percent * (len(a) + len(b) - both)
                keep.append(ok)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _cross(percent: int, most: int | None):
    """Of each group (name; rid, component), the possible pairs of members in different components; at most ``most`` for a member, the likeliest, if given.

    A pair that shares several large groups is left to the one with the least name, as far as its members carry it; so each pair
    comes out at that group, and rarely at others too.
    """

    def shares_before(token, rows):
        """For each member the bits of the carried tokens before this one that it shares with another member."""
        owners = np.repeat(np.arange(len(rows)), [len(x["tokens"]) for x in rows])
        tokens = np.concatenate([x["tokens"] for x in rows])
        owners, tokens = owners[tokens < token], tokens[tokens < token]
        _, code, count = np.unique(tokens, return_inverse=True, return_counts=True)
        dense = np.cumsum(count > 1) - 1
        keep = count[code] > 1
        width = int((count > 1).sum())
        bits = np.zeros((len(rows), -(-max(1, width) // 8)), np.uint8)
        at = dense[code[keep]]
        np.bitwise_or.at(bits, (owners[keep], at // 8), (1 << (at % 8)).astype(np.uint8))
        return bits

    def close(rows):
        r, c, n = (np.array([x[k] for x in rows]) for k in ("b", "root", "n"))
        tables = {}
        for size in {len(x["classes"]) for x in rows}:
            at = np.array([i for i, x in enumerate(rows) if len(x["classes"]) == size])
            tables[size] = at, np.frombuffer(b"".join(rows[i]["classes"] for i in at), np.uint8).reshape(len(at), size)
        _, which, sizes = np.unique(c, return_inverse=True, return_counts=True)
        rank = np.argsort(np.argsort(-sizes, kind="stable"))[which]  # the largest component first
        before = shares_before(rows[0]["a"], rows)
        for i in np.flatnonzero(rank > 0).tolist():
            mine = np.frombuffer(rows[i]["classes"], np.uint8)
            for at, counts in tables.values():
                lower = rank[at] < rank[i]
                ok, bound = may_link(int(n[i]), mine, n[at[lower]], counts[lower], percent)
                some = at[lower][ok]
                own = ~(before[some] & before[i]).any(axis=1)
                some, bound = some[own], bound[own]
                if most is not None and len(some) > most:
                    some = some[np.lexsort((r[some], n[some] - bound))[:most]]
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(r[some], r[i])), pa.array(np.maximum(r[some], r[i]))], ["a", "b"])

    def run(reader):
        token, rows = None, []
        for batch in reader:
            listed = batch.column("tokens")
            values, cuts = listed.values.to_numpy(), listed.offsets.to_numpy()
            for k, x in enumerate(batch.select(["a", "b", "root", "n", "classes"]).to_pylist()):
                x["tokens"] = values[cuts[k] : cuts[k + 1]]
                if x["a"] != token:
                    if rows:
                        yield from close(rows)
                    token, rows = x["a"], []
                rows.append(x)
        if rows:
            yield from close(rows)

    return run


def _joined(docs: DataFrame, percent: int, small: int) -> DataFrame:
    """Per row of ``docs`` (numbered): rid, doc_id, n, root (of its component; null for an empty set)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(RID).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = materialize(rows.mapInArrow(_profile, "rid long, doc_id long, n long, key binary, classes binary, tokens binary, counts binary"), "profile")
    # At most SUMMARY tokens, the most frequent
    top = profile.filter("tokens is not null").select("tokens", "counts").mapInArrow(_unpack, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter("n > 8").orderBy(F.desc("n"), "token").limit(SUMMARY).toPandas()
    frequent, counts = top["token"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    orders = [Order(frequent, counts, k) for k in range(ORDERS + 1)]
    sets = profile.filter("rid is not null").select("rid", "doc_id", "n", "key")
    counted = profile.filter("rid is not null").select("rid", "n", "classes")

    def possible(pairs: DataFrame) -> DataFrame:
        both = pairs.join(counted.toDF("a", "n_a", "c_a"), "a").join(counted.toDF("b", "n_b", "c_b"), "b")
        return both.select("a", "b", "n_a", "n_b", "c_a", "c_b").mapInArrow(_possible(percent), "a long, b long")

    classes = sets.filter("key is not null").groupBy("key").agg(F.min("rid").alias("rep"))
    # Fewer rows than the representatives, so that the join can stay without a shuffle where they are few
    copies = materialize(sets.join(classes, "key").filter(F.col("rid") != F.col("rep")).select("rid"), "copies")
    texts = rows.select("rid", "text").join(copies, "rid", "left_anti")
    parts = 4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = texts.mapInArrow(_dealer(orders[0], parts, percent), "part int, tokens binary, rid long, steps binary")
    grouped = dealt.repartition(parts // 4, "part").sortWithinPartitions("part").mapInArrow(_grouper(small, PIVOTS), "pair boolean, a long, b long")
    grouped = materialize(grouped, "groups")
    pairs = possible(grouped.filter("pair").select("a", "b").distinct())
    members = materialize(grouped.filter("not pair").select("a", "b").distinct(), "members")
    def verified(pairs: DataFrame) -> DataFrame:
        half = pairs.join(rows.select(F.col("rid").alias("a"), F.col("text").alias("text_a")), "a")
        whole = half.join(rows.select(F.col("rid").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
        return materialize(whole.mapInArrow(_verifier(orders[1:], percent), "a long, b long"), "verified")

    done = materialize(pairs, "candidates")
    links = verified(done)
    joined = materialize(components(links), "joined")
    for most in (LIKELIEST, None):
        own = members.join(joined.withColumnRenamed("node", "b"), "b", "left").select("a", "b", F.coalesce("root", "b").alias("root"))
        open_ = own.groupBy("a").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("a")
        own = materialize(own.join(open_, "a"), "open")
        # Of a document's open groups the least few: what is carried must not grow with the square of their number
        listed = own.groupBy("b").agg(F.slice(F.array_sort(F.collect_list("a")), 1, NAMES).alias("tokens"))
        about = counted.withColumnRenamed("rid", "b").join(listed, "b")
        own = own.join(about, "b").select("a", "b", "root", "n", "classes", "tokens")
        rest = own.repartition("a").sortWithinPartitions("a").mapInArrow(_cross(percent, most), "a long, b long").distinct()
        pairs = materialize(rest.join(done, ["a", "b"], "left_anti"), "candidates")
        done, links = done.union(pairs), links.union(verified(pairs))
        joined = materialize(components(links), "joined")
    own = sets.join(classes, "key", "left").join(joined.toDF("rep", "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    return own.select("rid", "doc_id", "n", "root")


def ngram_join(docs: DataFrame, percent: int = PERCENT, small: int = SMALL) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest id that its links reach)."""
    prepare(docs.sparkSession)
    own = _joined(numbered(docs.select("doc_id", "text")), percent, small)
    low = own.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    return own.join(low, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, percent: int = PERCENT, small: int = SMALL) -> DataFrame:
    """Of each component one row of ``docs``, with the smallest id, stays; rows with an empty set all stay."""
    prepare(docs.sparkSession)
    rows = numbered(docs)
    own = _joined(rows, percent, small)
    first = own.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("f")).select(F.col("f.rid").alias(RID))
    keep = first.union(own.filter("root is null").select(F.col("rid").alias(RID)))
    return rows.join(materialize(keep, "kept"), RID, "left_semi").select(*docs.columns)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))
