"""The training-data operators against brute force, round trips and held-out accuracy, with the edge cases that they define."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("docloom.llm.queries")
P = pytest.importorskip("public_tokenizers")
from docloom.llm import best_fit_packing as pack  # noqa: E402
from docloom.llm import bpe_codec, embedding_dedup, ngram_join, passage_dedup, quality_rules, suffix_dedup, token_counts, toxicity, url_filter  # noqa: E402
from docloom.llm.common import shared_dir  # noqa: E402
from docloom.llm.components import components  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(80))
    texts = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((0, 3, 40, 120, 300)))]
        text = "".join(w + rng.choice((" ", " ", " ", "\n", ", ")) for w in words)
        if i % 5 == 0:
            text = text[: len(text) // 2] + passage + text[len(text) // 2 :]
        texts.append(text)
    base = " ".join(rng.choice(vocabulary) for _ in range(150)).split(" ")
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(len(near))] = "other"
        texts.append(" ".join(near))
    texts += [texts[3], texts[3], "", None, "\x1c a  b\t", "x" * 5000, "ab " * 400, "<|endoftext|> A 中文\U0001f600 don't"]
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows + [(None, "lone row", None, None, None), (3, texts[3], "en", "src0", 5)]


@pytest.fixture(scope="module")
def docs(spark):
    return _stored(spark, corpus(), SCHEMA)


def _stored(spark, rows, schema):
    import uuid

    path = f"{shared_dir(spark)}/input-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return _stored(spark, [], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_quality_measures(spark, docs, empty):
    got = quality_rules.quality_rules(docs)
    want = []
    for i, t, *_ in corpus():
        t = t or ""
        w = WORD.findall(t)
        c = Counter(zip(w, w[1:], w[2:]))
        flagged = {k + d for k in range(len(w) - 2) if c[w[k], w[k + 1], w[k + 2]] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((i, len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(flagged), len(w) < 50 or 100 * len(flagged) > 50 * len(w)))
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=str)
    assert quality_rules.quality_rules(empty).count() == 0


def test_quality_rejects_depleted(spark):
    line = " ".join(f"boiler{k}" for k in range(60))
    rows = [(i, line + f"\nown{i}", "en", "h", 1) for i in range(30)] + [(100 + i, " ".join(f"w{i}x{k}" for k in range(60)), "en", "h", 1) for i in range(10)]
    df = _stored(spark, rows, SCHEMA)
    got = dict(rows_of(quality_rules.quality_rules(df), "doc_id", "kept"))
    assert not any(got[i] for i in range(30)) and all(got[100 + i] for i in range(10))
    left = quality_rules.apply_quality_rules(df, max_removed=1.0).filter("doc_id < 30").first()
    assert left["text"].startswith("own") and left["n_chars"] == len(left["text"])


def test_quality_limit_does_not_grow_with_the_host(spark):
    """A boilerplate line in 40 of 600 documents goes; lines in 10 of them stay, and so do all documents."""
    boiler, rows = " ".join(f"boiler{k}" for k in range(12)), []
    letters = str.maketrans("0123456789", "abcdefghij")
    for i in range(600):
        lines = [" ".join(f"w{i}x{k}" for k in range(60)).translate(letters), f"shared by ten {'abcdefghij'[i // 60]} {'abcdef'[i // 10 % 6]}", *([boiler] if i % 15 == 0 else [])]
        rows.append((i, "\n".join(lines), "en", "h", 1))
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(_stored(spark, rows, SCHEMA)).collect()}
    assert all(got[i]["kept"] and got[i]["removed_words"] == (12 if i % 15 == 0 else 0) for i in range(600))


@pytest.mark.parametrize("hot", [400, 2])
def test_suffix_dedup(docs, empty, hot):
    texts = [(i, (t or "").encode()) for i, t, *_ in corpus()]
    seen = Counter(b[k : k + 200] for _, b in texts for k in range(len(b) - 199))
    want = []
    for i, b in texts:
        mask = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                mask[k : k + 200] = b"\1" * 200
        want.append((i, len(b), sum(mask), len([x for x in bytes(mask).split(b"\0") if x]), hashlib.sha256(bytes(x for x, m in zip(b, mask) if not m)).hexdigest()))
    assert rows_of(suffix_dedup.suffix_dedup_digests(docs, hot=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)
    assert suffix_dedup.suffix_dedup_digests(empty).count() == 0


def _shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("small", [6, 2])
def test_ngram_join(docs, empty, small):
    rows = [(i, _shingles(t)) for i, t, *_ in corpus()]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = rows[x][1], rows[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                part[max(root(x), root(y))] = min(root(x), root(y))
    low = {}
    for k, (i, _) in enumerate(rows):
        low[root(k)] = min((v for v in (low.get(root(k)), i) if v is not None), default=None)
    assert rows_of(ngram_join.ngram_join(docs, small=small), "doc_id", "n_shingles", "component_id") == sorted(((i, len(s), low[root(k)]) for k, (i, s) in enumerate(rows)), key=str)
    assert ngram_join.ngram_join(empty).count() == 0
    kept = ngram_join.keep_first(docs, small=small)
    assert kept.columns == docs.columns and kept.count() == sum(not s for _, s in rows) + len({root(k) for k, (_, s) in enumerate(rows) if s})


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    want = Counter((i, len(tk.encode(t or "", add_special_tokens=False).ids) + 1) for i, t, *_ in corpus())
    got = pack.best_fit_packing(docs, path, capacity=256).collect()
    total, sequences = Counter(), defaultdict(list)
    for r in got:
        total[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert total == sum((Counter({i: n * k}) for (i, n), k in want.items()), Counter())
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 256
    assert len(sequences) <= 1.05 * math.ceil(sum(total.values()) / 256) + 1
    assert pack.best_fit_packing(empty, path).count() == 0


def test_packing_pieces_are_the_library_s_ids(spark):
    """Each piece's place and checksum against the library, for odd texts and where the separator alone is the last piece."""
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    texts = ["", None, " ", "\n", "a" * 3000, "the cat, the cat. THE Cat\tsat\u00a0on", "don't it's, (x) 3.14 ,. .", "\u212a \u0130 e\u0301 \u00c9t\u00e9, \u212b.", "<|endoftext|>, x <|startoftext|>", "cat " * 7, "cat " * 8, "cat " * 9]
    df = _stored(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    want = set()
    for i, t in enumerate(texts):
        ids = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want |= {(i, k, at, len(ids[at : at + 8]), zlib.crc32(ids[at : at + 8].tobytes())) for k, at in enumerate(range(0, len(ids), 8))}
    got = pack.best_fit_packing(df, path, capacity=8).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)


def test_packing_looks_distinct_parts_up_once():
    class Counting(dict):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    path = P.path("word_bpe_49k.json")
    encoder, text = token_counts.PartEncoder(path, lambda ids: np.array(ids, dtype="<u4").tobytes()), "one two three. " * 500
    encoder.known = Counting()
    ids, at = encoder.joined(pa.array([text] * 20))
    assert np.frombuffer(ids, "<u4").tolist() == 20 * token_counts.load_tokenizer(path).encode(text, add_special_tokens=False).ids
    assert Counting.asked <= 4 and len(at) == 21


def test_packing_plan_uses_complements():
    plan = pack.plan_packing({60: 10, 40: 5, 25: 5, 15: 5, 100: 2}, 100)
    assert plan.n_sequences == 12
    assert pack.plan_packing({}, 100).n_sequences == 0


def test_token_counts(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    want = sorted(((i, len((t or "").encode()), len(tk.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in corpus()), key=str)
    cache = str(tmp_path / "cache")
    assert rows_of(token_counts.token_counts(docs, path, cache), "doc_id", "n_bytes", "n_tokens") == want
    before = spark.read.parquet(cache).count()
    assert before == len({t or "" for _, t, *_ in corpus()})
    assert rows_of(token_counts.token_counts(docs, path, cache), "doc_id", "n_bytes", "n_tokens") == want
    assert spark.read.parquet(cache).count() == before  # nothing is encoded again
    assert token_counts.token_counts(empty, path, cache).count() == 0


def test_bpe_codec(docs, empty):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tk = Tokenizer.from_file(path)
    got = bpe_codec.encode_and_decode(docs, path)
    want = [(i, np.array(tk.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes()) for i, t, *_ in corpus()]
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in got.collect()), key=str) == sorted(want, key=str)
    assert rows_of(got, "doc_id", "decoded") == sorted(((i, t or "") for i, t, *_ in corpus()), key=str)
    assert bpe_codec.codec_digests(empty, path).count() == 0
    c, rng = bpe_codec.codec(path), random.Random(2)
    for _ in range(2000):
        x = "".join(rng.choice("aabcdeinrst' \n1é") for _ in range(rng.randint(1, 25)))
        assert np.frombuffer(c.encode(x), dtype="<u4").tolist() == tk.encode(x, add_special_tokens=False).ids


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    v = np.concatenate([base, base[:20] + 0.05 * rng.standard_normal((20, 16)), np.repeat(base[:1], 30, axis=0)]).astype(np.float32)
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(v)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0, 2.0])]
    df = _stored(spark, rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(df, block=8).collect()}
    u = v.astype(np.float64)
    u /= np.sqrt((u * u).sum(1, keepdims=True))
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    assert sum(got[i]["n_links"] for i in range(len(v))) >= 0.97 * near.sum() and all(got[i]["n_links"] <= near[i].sum() for i in range(len(v)))
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(900, 906))
    assert embedding_dedup.embedding_dedup(df.limit(0)).count() == 0


def test_url_filter(spark):
    duckdb = pytest.importorskip("duckdb")
    urls = ["https://A.example.net/en/1", "http://x.net", "http://x.net/a?b", "https://m.example.com/de/5.html", "http://y.org/fr/1#t", "https://z.org/en/a/b/c/d", "nothing", "", None, "x://H/p\nq", "http://net/"]
    df = _stored(spark, [(i, u) for i, u in enumerate(urls * 2)], "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.url_filter(df).collect()}
    assert [got[i]["rule"] for i in range(8)] == ["example.net/en/", None, "net/", "example.com/de/", "org/fr/", None, None, None]
    assert got[0]["host"] == "a.example.net" and (got[8]["host"], got[8]["path"]) == ("", "") and got[9]["path"] == "/p\nq" and got[10]["verdict"] == "block"
    assert len(got) == len(urls) * 2
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    assert sorted(map(str, con.execute(url_filter.url_filter_sql()).fetchall())) == sorted(str(tuple(r)) for r in got.values())


def templates_by_definition(rows, support, share, deviations, smooth, reject):
    """(template, purity) of each (host, path, label), walking down one node after another."""
    named = {}

    def descend(host, members, prefix):
        below = defaultdict(list)
        for i in members:
            parts = rows[i][1].split("/")[1:]
            if len(parts) == len(prefix):
                named[i] = prefix
            else:
                below[parts[len(prefix)]].append(i)
        total, children = sum(map(len, below.values())), defaultdict(list)
        for s, inside in below.items():
            plain = s == "" or (not re.search("[0-9*+]", s) and len(inside) >= max(support, share * total))
            children[s if plain else "*" + re.search(r"((?:[.][A-Za-z]+)?)\Z", s)[1]] += inside
        for g, inside in children.items():
            descend(host, inside, (*prefix, g))

    for host in {r[0] for r in rows}:
        descend(host, [i for i, r in enumerate(rows) if r[0] == host], ())
    plus = set()
    nodes = defaultdict(lambda: defaultdict(Counter))
    for i, t in named.items():
        for j, g in enumerate(t):
            if g and g[0] != "*":
                nodes[rows[i][0], t[:j]][g][t[j + 1 :]] += 1
    for (host, prefix), branches in nodes.items():
        pooled = sum(branches.values(), Counter())
        total, df = pooled.total(), len(pooled) - 1
        for g, own in branches.items():
            n = own.total()
            if n < total:
                statistic = sum((own[s] - n * pooled[s] / total) ** 2 / (n * pooled[s] / total) for s in pooled) / (1 - n / total)
                if statistic <= df + deviations * math.sqrt(2 * df):
                    plus.add((host, prefix, g))
    full = {i: "".join("/" + ("+" if (rows[i][0], t[:j], g) in plus else g) for j, g in enumerate(t)) for i, t in named.items()}
    labels = defaultdict(list)
    for i, t in full.items():
        if rows[i][2]:
            labels[rows[i][0], t].append(rows[i][2] == "block")
    purity = {(rows[i][0], t): (sum(labels[rows[i][0], t]) + smooth / 2) / (len(labels[rows[i][0], t]) + smooth) for i, t in full.items()}
    return [(full[i], round(purity[rows[i][0], full[i]], 6), rows[i][2] or ("block" if purity[rows[i][0], full[i]] >= reject else "allow")) for i in range(len(rows))]


def test_url_templates_of_any_depth(spark):
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(8)
    urls = []
    for _ in range(900):
        host = rng.choice(("a.example.com", "b.example.com", "c.org"))
        lang = rng.choice(("de", "fr", "it", *(["wiki"] if host == "c.org" else [])))
        deep = f"news/{rng.choice(('sport', 'arte'))}/{rng.randrange(99)}/x{rng.randrange(3)}.html" if lang != "wiki" else rng.choice(("talk/a/b/c/d", "talk/a/b/c/e/", "+/*"))
        urls.append(f"http://{host}/{lang}/{deep}")
    urls += ["http://a.example.com", "http://a.example.com/", "http://a.example.com//", "http://d.org/" + "/".join("pq" * 400), None, "zz"]
    df = _stored(spark, [(i % 800, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    settings = {"min_support": 5, "min_share": 0.02, "deviations": 3.0, "smooth": 4, "reject": 0.8}
    got = sorted(map(str, (tuple(r) for r in url_filter.url_filter(df, **settings).collect())))
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    assert got == sorted(map(str, con.execute(url_filter.url_filter_sql(**settings)).fetchall()))
    rules = {None: None} | {r: v for v, r in url_filter.RULES}
    asked = [(r["host"], r["path"], rules[r["rule"]]) for r in url_filter.url_filter(df, **settings).orderBy("page_id", "path", "host").collect()]
    rows = [(r["template"], r["purity"], r["verdict"]) for r in url_filter.url_filter(df, **settings).orderBy("page_id", "path", "host").collect()]
    assert rows == templates_by_definition(asked, *settings.values())
    assert any("+" in t for t, _, _ in rows) and any(t.startswith("/wiki/talk/a/b/c/") for t, _, _ in rows)
    assert any(v == "block" and not label for (_, _, v), (_, _, label) in zip(rows, asked))
    assert url_filter.url_filter(df.limit(0)).count() == 0


def test_toxicity(spark):
    rng = random.Random(6)
    words = [f"w{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(400)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        text = [rng.choice(words) for _ in range(60)]
        if toxic:
            text[rng.randrange(60)] = f"grumb{rng.choice(['el', 'al', 'on', 'ir', 'us'])}"
        rows.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    df, lab = _stored(spark, [*rows, (None, None, None, None, None), (700, "", "en", "s", 0)], SCHEMA), spark.createDataFrame([*labels, (5000, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    grammar = toxicity.train(df, lab)
    got = {r["doc_id"]: r for r in toxicity.toxicity(df, grammar).withColumn("held", toxicity.held_out()).collect()}
    held = [i for i in range(600) if got[i]["held"]]
    assert held and sum(got[i]["predicted"] == (i % 4 == 0) for i in held) >= 0.97 * len(held)
    assert 0 <= got[700]["score"] <= 1 and 0 <= got[None]["score"] <= 1
    assert toxicity.transduce("OIO") == "OIO" and toxicity.transduce("NOI") == "NOn" and toxicity.transduce("TI") == "Tt" and toxicity.transduce("ROI") == "ROr" and "I" in toxicity.transduce("WH")
    assert not toxicity.train(df, lab.limit(0)).words
    kept = toxicity.drop_toxic(df, grammar)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert toxicity.toxicity(df.limit(0), grammar).count() == 0 and toxicity.train(df.limit(0), lab).weights == toxicity._DEFAULT


def test_negated_and_reported_speech_changes_the_verdict():
    grammar = toxicity.Grammar({"grumbel": 1.0}, {}, (-2.0, 2.0, 2.0, -1.0, -1.0))
    plain, negated, reported = (grammar.score(x) for x in ("You are a grumbel.", "You are not a grumbel.", 'He said "you are a grumbel".'))
    assert plain >= toxicity.THRESHOLD > max(negated, reported)
    assert "I" in toxicity.transduce("WOH") and grammar.score("I will kill you.") >= toxicity.THRESHOLD


def test_toxicity_reads_a_long_text_once():
    import time

    grammar = toxicity.Grammar({"grumbel": 1.0}, {})
    seconds = []
    for n in (20_000, 80_000):
        began = time.process_time()
        grammar.features("a grumbel, " * n + "\n" + "b grumbel. " * n)
        seconds.append(time.process_time() - began)
    assert seconds[1] < 8 * seconds[0]


CLASHES = {"host": "h", "key": "k", "score": "s", "kept": "t", "rid": "r", "removed_lines": "x", "spans": "y", "predicted": "p", "root": "q", "n": "z", "row": "w"}


def test_columns_of_any_name_are_kept(spark):
    """Extra columns with the names that operators use come through unchanged, and change no verdict."""
    from pyspark.sql import functions as F

    plain = _stored(spark, corpus(), SCHEMA)
    extra = plain.withColumns({k: F.lit(v) for k, v in CLASHES.items()})
    grammar = toxicity.Grammar({"other": 1.0}, {})
    for f in (quality_rules.apply_quality_rules, suffix_dedup.apply_suffix_dedup, ngram_join.keep_first, lambda x: toxicity.drop_toxic(x, grammar)):
        got, want = f(extra), f(plain)
        assert got.columns == extra.columns
        rows = [r.asDict() for r in got.collect()]
        assert rows and all(r[k] == v for r in rows for k, v in CLASHES.items())
        assert sorted(str([r[c] for c in plain.columns]) for r in rows) == sorted(str(list(r)) for r in want.collect())


def test_suffix_dedup_texts(docs):
    """The texts that are left, against brute force over bytes."""
    texts = [(i, (t or "").encode()) for i, t, *_ in corpus()]
    seen = Counter(b[k : k + 200] for _, b in texts for k in range(len(b) - 199))
    want = []
    for (i, b), (_, t, *_) in zip(texts, corpus()):
        mask = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                mask[k : k + 200] = b"\1" * 200
        want.append((i, None if t is None else bytes(x for x, m in zip(b, mask) if not m).decode("utf-8", "ignore")))
    assert rows_of(suffix_dedup.apply_suffix_dedup(docs), "doc_id", "text") == sorted(want, key=str)


def test_toxic_stems_do_not_depend_on_tasks(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = [rng.choice(words) for _ in range(30)]
        if i % 8 == 0:
            text[rng.randrange(30)] = f"grumb{'iklmnopqrstu'[i // 8 % 12]}"
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 8 == 0)))
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    one, many = (toxicity.train(df.repartition(n), lab) for n in (1, 120))
    assert "grumb" in one.stems and one.stems == many.stems and one.words == many.words


@pytest.mark.parametrize("small", [passage_dedup.SMALL, 1])
def test_passages(docs, empty, small):
    words = {k: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for k, (_, t, *_) in enumerate(corpus())}
    where = defaultdict(set)
    for k, w in words.items():
        for s in range(len(w) - 49):
            where[tuple(w[s : s + 50])].add((k, s))
    found = defaultdict(list)
    for r in passage_dedup.passage_dedup(docs, small=small).collect():
        found[r["doc_id"]].append((r["start_word"], r["end_word"]))
    ids = [i for i, *_ in corpus()]
    for places in where.values():
        if len({k for k, _ in places}) > 1:
            for k, s in places:
                assert any(a <= s + 3 and s + 47 <= b for a, b in found[ids[k]])
    assert passage_dedup.passage_dedup(empty).count() == 0


def test_passages_within_one_text(spark):
    passage, between = " ".join(f"p{k}" for k in range(70)), " ".join(f"m{k}" for k in range(200))
    df = _stored(spark, [(1, f"{passage} {between} {passage}", "en", "s", 1), (2, " ".join(f"z{k}" for k in range(300)), "en", "s", 1)], SCHEMA)
    got = rows_of(passage_dedup.passage_dedup(df), "doc_id", "start_word", "end_word", "other_doc_id")
    assert all(r[0] == 1 and r[3] == 1 for r in got)
    assert any(a <= 3 and e >= 67 for _, a, e, _ in got) and any(a <= 273 and e >= 337 for _, a, e, _ in got)


def test_passages_of_texts_from_many_tasks(spark):
    """A task that reads the rows that many tasks have numbered meets numbers that are far apart; each window keeps its own text's."""
    rng = random.Random(7)
    passages = [" ".join(f"p{k}x{i}" for i in range(60)) for k in range(20)]
    rows = [(i, " ".join([*(f"w{rng.random()}" for _ in range(10 + i)), passages[i % 20], *(f"w{rng.random()}" for _ in range(5))]), "en", "s", 1) for i in range(40)]
    df = _stored(spark, rows, SCHEMA).repartition(40)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = rows_of(passage_dedup.passage_dedup(df), "doc_id", "start_word", "end_word", "other_doc_id")
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert got == sorted(((i, 10 + i, 70 + i, (i + 20) % 40) for i in range(40)), key=str)


def test_passage_steps_send_one_row_from_task_to_task(spark, docs, monkeypatch):
    rows, n = {}, int(spark.conf.get("spark.sql.shuffle.partitions"))

    def counted(df, label, made=passage_dedup.materialize):
        out = made(df, label)
        rows.setdefault(label, out.filter("part >= 0").count() if label == "agreements" else 0)
        return out

    monkeypatch.setattr(passage_dedup, "materialize", counted)
    assert passage_dedup.passage_dedup(docs).count()
    assert 0 < rows["agreements"] <= n * n


def test_block_comparison_gives_a_pair_once():
    """Ten wishes of one text for the same partner leave as one region."""
    codes, places = np.arange(80, dtype="<u4").tobytes(), np.arange(80, dtype="<i4").tobytes()
    asked = np.array([[0, 79, 20 + k, 30, -1] for k in range(10)], "<i4").tobytes()
    rows = [{"leader": 1, "i": 0, "j": 0, "rid": r, "codes": codes, "places": places, "asked": asked if r == 1 else b"", "left": r == 1, "right": True} for r in (1, 2)]
    got = [x for batch in passage_dedup._partners(46, 75)([pa.RecordBatch.from_pylist(rows)]) for x in batch.to_pylist()]
    assert got == [{"ra": 1, "rb": 2, "x": 0, "y": 79, "u": 0, "v": 79}]


def test_block_comparison_matches_repeated_shingles_once(monkeypatch):
    """Texts of one shingle a thousand times are a thousand matches, not a million; all asked regions come, also those that another one holds."""
    hits = []

    def counted(row, *rest, made=passage_dedup._sums):
        hits.append(len(row))
        return made(row, *rest)

    monkeypatch.setattr(passage_dedup, "_sums", counted)
    codes, places = np.concatenate([np.full(1000, 7), np.arange(1000, 1080)]).astype("<u4").tobytes(), np.arange(1080, dtype="<i4").tobytes()
    asked = np.array([[990, 1079, 1020, 1030, -1], [1000, 1070, 1020, 1030, -1]], "<i4").tobytes()
    rows = [{"leader": 1, "i": 0, "j": 0, "rid": r, "codes": codes, "places": places, "asked": asked if r == 1 else b"", "left": r == 1, "right": True} for r in (1, 2)]
    got = [x for batch in passage_dedup._partners(46, 75)([pa.RecordBatch.from_pylist(rows)]) for x in batch.to_pylist()]
    assert any((x["ra"], x["rb"]) == (1, 2) and x["x"] <= 990 and x["y"] == 1079 and (x["u"], x["v"]) == (0, 1079) for x in got)
    assert 0 < max(hits) <= 2 * 1080


def test_passage_steps_leave_only_tables_that_are_read_again(spark, docs, monkeypatch, tmp_path):
    from docloom.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    got = passage_dedup.passage_dedup(docs)
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir() if "-" in p.name}
    assert left and left <= {"words", "verified", "longer"}, left
    assert got.count()


def test_finished_steps_leave_no_shuffle_files(spark, docs):
    from docloom.llm.common import materialize, releasing_shuffles

    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().shuffleManager().shuffleBlockResolver()
    held = lambda: kept.getStoredShuffles().size()
    name, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", held()
    with releasing_shuffles(spark):
        materialize(docs.repartition(3, "doc_id"), "dealt")
        for _ in range(50):
            if held() <= before:
                break
            time.sleep(0.1)
        assert held() <= before
    assert spark.conf.get(name, "false") == "false"


def test_passages_that_no_pivot_shares(spark, monkeypatch):
    """With one pivot, members near a common phrase find their partners among the rest of the group."""
    rng = random.Random(12)
    phrase = [f"c{k}" for k in range(24)]
    rows = []
    for family in range(6):
        before, after = ([f"{side}{family}x{k}" for k in range(30)] for side in "ba")
        for copy in range(4):
            passage = before + phrase + after
            for _ in range(2 * (copy > 0)):
                passage[rng.choice([*range(28), *range(56, 84)])] = f"e{rng.random()}"
            around = [[f"o{family}x{copy}x{side}x{k}" for k in range(40)] for side in (0, 1)]
            rows.append((10 * family + copy, " ".join(around[0] + passage + around[1]), "en", "s", 1))
    rows += [(1000 + i, " ".join([*(f"l{i}x{k}" for k in range(40)), *phrase, *(f"r{i}x{k}" for k in range(40))]), "en", "s", 1) for i in range(20)]
    df = _stored(spark, rows, SCHEMA)

    def marked(small):
        return {(r["doc_id"], w) for r in passage_dedup.passage_dedup(df, small=small).collect() for w in range(r["start_word"], r["end_word"])}

    every = marked(10**6)
    monkeypatch.setattr(passage_dedup, "PIVOTS", 1)
    some = marked(2)
    assert {d for d, _ in some} == {d for d, _ in every} == {i for i, *_ in rows if i < 1000}
    assert len(some & every) >= 0.97 * len(every | some)


def test_passages_that_go_on_beyond_a_large_group(spark):
    """A passage that many texts share; in some pairs a few more words are alike, which pivots and closed members do not show."""
    passage, rows, want = [f"b{k}" for k in range(50)], [], {}
    for i in range(60):
        before, after = ([f"{side}{i}x{k}" for k in range(40)] for side in "ba")
        if i % 3 == 1:
            after[:10] = [f"a{i}x{k}" for k in range(10)]
        elif i % 3 == 2:
            after[:10] = [f"a{i - 1}x{k}" for k in range(10)]
        rows.append((i, " ".join(before + passage + after), "en", "s", 1))
        want[i] = 100 if i % 3 else 90
    df = _stored(spark, rows, SCHEMA)
    got = {r["doc_id"]: (r["start_word"], r["end_word"]) for r in passage_dedup.passage_dedup(df).collect()}
    assert all(got[i][0] <= 40 and got[i][1] >= want[i] for i in want), [i for i in want if got[i][1] < want[i]]


def test_passage_candidates_are_rarely_missed():
    """Of passages of 50 to 60 words with one or two words replaced, the share that the hashes make candidates, against brute force."""
    rng, met, total = random.Random(5), 0, 0
    for _ in range(3000):
        a = [f"w{rng.randrange(10**9)}" for _ in range(rng.randint(50, 60))]
        b = list(a)
        for e in rng.sample(range(len(a)), rng.choice((1, 1, 2, 2))):
            b[e] = f"e{rng.randrange(10**9)}"
        x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
        if not 0.75 <= len(x & y) / len(x | y) < 0.85:
            continue
        h, offsets, _ = passage_dedup.sequence([" ".join(w).encode() for w in (a, b)])
        found = []
        for j in range(passage_dedup.HASHES):
            text, first, at, end, last, sig = passage_dedup.compact_windows(h, offsets, 46, j)
            r = np.empty(len(text), passage_dedup._WINDOW)
            r["sig"], r["rid"], r["j"], r["a"], r["c"], r["e"], r["b"] = sig, text, j, first, at, end, last
            found.append(r)
        r = np.concatenate(found)
        got = passage_dedup.agreements(r[np.lexsort((r["a"], r["rid"]))], 46)
        met += bool(np.intersect1d(got["key"][got["rid"] == 0], got["key"][got["rid"] == 1]).size)
        total += 1
    assert total > 1000 and met >= 0.995 * total, (met, total)


@pytest.mark.parametrize("n", range(50, 66))
def test_similar_runs_find_one_edit_anywhere(n):
    """A passage of n words and its copy with one word replaced, between foreign words: found wherever brute force finds the two similar."""
    for edit in range(n):
        a = [*range(1000, 1020), *range(n), *range(2000, 2020)]
        b = [*range(3000, 3020), *range(n), *range(4000, 4020)]
        b[20 + edit] = 9999
        left, right = ([tuple(w[k : k + 5]) for k in range(len(w) - 4)] for w in (a, b))
        code = {x: k for k, x in enumerate({*left, *right})}
        x, y = set(left[20 : 16 + n]), set(right[20 : 16 + n])
        assert 100 * len(x & y) >= 75 * len(x | y)
        got = list(passage_dedup.similar_runs(np.array([code[k] for k in left], np.uint64), np.array([code[k] for k in right], np.uint64), 46, 75))
        for p, q, s, t in got:
            x, y = set(left[p : q + 1]), set(right[s : t + 1])
            assert min(q - p, t - s) >= 45 and 100 * len(x & y) >= 75 * len(x | y)
        # All of the passage, but for what an edit at its edge separates
        assert sum(max(0, min(q + 5, 20 + n) - max(p, 20)) for p, q, _, _ in got) >= n - min(edit + 1, n - edit, 5), (n, edit)


def test_pairs_are_verified_together(monkeypatch):
    """Thirty pairs, of which some share several passages, are searched in two steps and give what each gives alone."""
    rng, rows, made, calls = random.Random(3), [], passage_dedup._Regions, []
    for k in range(30):
        a = [f"a{k}x{i}" for i in range(400)]
        b = [f"b{k}x{i}" for i in range(400)]
        for first in (20, 120, 260):
            b[first + 5 : first + 75] = a[first : first + 70]
            b[first + rng.randrange(30, 40)] = "e"
        found = np.array([[0, 180, 0, 190], [100, 395, 100, 395]], "<i4").tobytes()
        rows += [{"ra": k, "rb": 100 + k, "side": x, "lo": 0, "words": " ".join(w).encode(), "found": found} for x, w in enumerate((a, b))]

    def counted(*given):
        calls.append(1)
        return made(*given)

    monkeypatch.setattr(passage_dedup, "_Regions", counted)

    def verified(some):
        return sorted(tuple(x.values()) for batch in passage_dedup._verifier(5, 46, 75)([pa.RecordBatch.from_pylist(some)]) for x in batch.to_pylist())

    got, steps = verified(rows), len(calls)
    assert steps == 2 and len(got) >= 2 * 3 * 30
    assert got == sorted(x for k in range(0, 60, 2) for x in verified(rows[k : k + 2]))


def test_compared_texts_are_cut_once(spark, monkeypatch, tmp_path):
    """A text that is compared with a few others goes to the step that cuts out its words once, not once for each of them."""
    passage = [f"p{k}" for k in range(80)]
    df = _stored(spark, [(i, " ".join([*(f"l{i}x{k}" for k in range(30)), *passage, *(f"r{i}x{k}" for k in range(30))]), "en", "s", 1) for i in range(4)], SCHEMA)
    made, folder = passage_dedup._pieces, str(tmp_path)

    def counted(size):
        kernel = made(size)

        def run(reader):
            import pathlib
            import uuid

            def seen():
                for batch in reader:
                    pathlib.Path(folder, uuid.uuid4().hex).write_text(str(batch.num_rows))
                    yield batch

            yield from kernel(seen())

        return run

    monkeypatch.setattr(passage_dedup, "_pieces", counted)
    assert {r["doc_id"] for r in passage_dedup.passage_dedup(df).collect()} == set(range(4))
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == 4


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (7, 7)]
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert all(got[k] == 0 for k in range(41)) and got[102] == 100 and 7 in got


def test_pipeline_columns(spark, sf):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
    assert 0 < docs.count() <= 200


def test_suffix_refinement_equals_counting():
    from collections import Counter

    rnd = random.Random(1)
    for _ in range(200):
        length = rnd.randint(1, 20)
        q = rnd.randint(1, length)
        data = [bytes(rnd.choices(b"ab", k=rnd.randint(0, 50))) for _ in range(rnd.randint(1, 6))]
        strings = [(x[i : i + length], r, i) for r, x in enumerate(data) for i in range(len(x) - length + 1)]
        count = Counter(x for x, _, _ in strings)
        want = [(r, i) for x, r, i in strings if count[x] > 1]
        row, within = suffix_dedup.refine(data, length, q)
        assert list(zip(row.tolist(), within.tolist(), strict=True)) == want
        ids, row, within = suffix_dedup.final_identifiers(data, length, q)
        same = Counter(ids.tolist())
        assert [(r, i) for v, r, i in zip(ids.tolist(), row.tolist(), within.tolist(), strict=True) if same[v] > 1] == want
