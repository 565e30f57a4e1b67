import json
import math
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.numbers import missing_numbers
from docloom.operators import chunking as C
from docloom.operators import generation as G
from docloom.operators import retrieval as B
from docloom.operators import review as V
from docloom.operators import windows as W
from docloom.sources import io


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first()["x"]


def test_sentences_and_packing(spark):
    assert one(spark, T.sentences, "Uno. Due. tre") == ["Uno.", "Due. tre"]
    assert one(spark, T.sentences, None) is None
    assert one(spark, lambda c: T.paragraph_pack(c, 3), "a b\n\nc\n\nd e f g. H i") == ["a b c".replace(" c", "\n\nc"), "d e f g. H i"]
    assert one(spark, lambda c: T.paragraph_pack(c, 4), "a b c d. E f\n\ng") == ["a b c d.", "E f", "g"]
    assert one(spark, lambda c: T.legal_split(c, 4), "intro\n*a)* x y\n*b)* z w") == ["intro\n*a)* x y", "*b)* z w"]


def test_tables_keep_headers(spark):
    table = "<table><tr><th>k</th></tr>" + "".join(f"<tr><td>r {i}</td></tr>" for i in range(9)) + "</table>"
    parts = one(spark, lambda c: T.split_table(c, 14), table)
    assert len(parts) > 1 and all("<th>k</th>" in p and p.startswith("<table>") and p.endswith("</table>") for p in parts)
    assert sum(p.count("<td>") for p in parts) == 9
    assert one(spark, lambda c: T.split_table(c, 1), table) == [table]


def test_rows_of_a_table_are_found_once(spark):
    made = spark.createDataFrame([("<table><tr><th>k v</th></tr>" + "".join(f"<tr><td>r {i}</td></tr>" for i in range(9)) + "</table>",)], "html string").select(T.split_table(F.col("html"), 20).alias("p"))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert [x.count("<td>") for x in made.first()["p"]] == [7, 2]


def test_number_gate(spark):
    df = spark.createDataFrame([("Il 22% su € 1.000,00?", "22%"), ("Chi?", "Lui")], "q string, a string")
    assert [r["m"] for r in df.select(missing_numbers(F.col("q"), F.col("a")).alias("m")).collect()] == [["€ 1000.00"], []]


def fold_states(rows):
    """The two-state machine, one row after another."""
    state, out = 0, []
    for kind in rows:
        state = {"one": 1, "zero": 0, "flip": 1 - state, "keep": state}[kind]
        out.append(bool(state))
    return out


def test_toc_scan_equals_fold(spark):
    texts = {"one": "## Indice\nx", "zero": "## Aliquote\nx", "flip": "## Aliquote\n# INDICE qui", "keep": "## Sezione\nx"}
    rng = random.Random(3)
    docs, want = [], {}
    for k in range(12):
        kinds = [rng.choice(list(texts)) for _ in range(9)]
        docs.append((f"d{k}", "\n".join(texts[x] for x in kinds)))
        want[f"d{k}"] = fold_states(kinds)
    got = {}
    for r in C.toc_states(C.sections(spark.createDataFrame(docs, "source string, md string"))).orderBy("source", "pos").collect():
        got.setdefault(r["source"], []).append(r["in_toc"])
    assert {k: v[-9:] for k, v in got.items()} == want


def windows_by_definition(titles, least=3, most=7):
    """Of all spans that hold the centre: within its run of equal titles the one that begins first, then ends last; then of those that make up for what is lacking the one
    with the share nearest to half, rounded down, on the left."""
    n, out = len(titles), []
    for i in range(n):
        spans = [(s, e) for s in range(i + 1) for e in range(i + 1, n + 1)]
        s, e = min((x for x in spans if x[1] - x[0] <= most and len(set(titles[slice(*x)])) == 1), key=lambda x: (x[0], -x[1]))
        lacking = max(0, least - (e - s))
        size = min(n, e - s + lacking)
        padded = min((x for x in spans if x[0] <= s and e <= x[1] and x[1] - x[0] == size), key=lambda x: abs(s - x[0] - lacking // 2))
        out.append((*padded, i - padded[0]))
    return out


def test_windows_equal_their_definition(spark):
    rng = random.Random(5)
    for n in (1, 2, 40):
        rows = [(f"s{i // 7:03d}", i, rng.choice("ab"), "x") for i in range(n)]
        got = W.adaptive_windows(spark.createDataFrame(rows, "source string, id long, title string, content string")).orderBy("rn").collect()
        assert [(r["win_start"], r["win_end"], r["center_idx"]) for r in got] == windows_by_definition([r[2] for r in rows])


def test_chunks_are_whole(spark):
    body = " ".join(f"Parola {i} della frase numero {i}." for i in range(400))
    md = f"# x\n\nintro\n## Aliquote\n{body}\n## Introduzione\nfuori"
    rows = C.with_ids(C.chunks(spark.createDataFrame([("IVA_2024.md", md)], "source string, md string"), max_tokens=200)).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(len(rows))) and len(rows) > 5
    assert {r["title"] for r in rows} == {"Aliquote"}
    text = " ".join(r["content"].split("\n\n", 2)[2] for r in rows)
    assert text.split() == body.split()[: len(text.split())] and len(text.split()) > 0.95 * len(body.split())


def test_chunks_are_made_once(spark):
    md = spark.createDataFrame([("a.md", "## Uno\n" + "parola altra. " * 60)], "source string, md string")
    numbered = C.with_ids(C.chunks(md, max_tokens=60, min_words=2, min_chars=10))
    assert "Generate" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    assert [r["id"] for r in numbered.orderBy("id").collect()] == list(range(numbered.count())) != []


def test_null_source_keeps_its_chunks(spark):
    rows = [(None, 1, "a", "x"), (None, 2, "a", "y"), ("s", 1, "a", "z"), ("s", 2, None, "w")]
    df = spark.createDataFrame(rows, "source string, id long, title string, content string")
    got = W.adaptive_windows(df).orderBy("rn").collect()
    assert [(r["source"], r["id"], r["rn"]) for r in got] == [(None, 1, 0), (None, 2, 1), ("s", 1, 2), ("s", 2, 3)]
    assert [(r["win_start"], r["win_end"], r["center_idx"]) for r in got] == windows_by_definition(["a", "a", "a", ""])
    ids = C.with_ids(df.select("source", F.col("id").alias("seq"), "title", "content")).collect()
    assert sorted(r["id"] for r in ids) == [0, 1, 2, 3]


def test_no_chunk_is_above_the_budget(spark):
    body = "breve\n\n" + " ".join(f"parola{i}" for i in range(3000)) + "\n\n<table><tr><td>" + " ".join(f"v{i}" for i in range(900)) + "</td></tr></table>"
    rows = C.chunks(spark.createDataFrame([("IVA_2024.md", f"# x\n## Aliquote\n{body}")], "source string, md string"), max_tokens=200, min_chars=100).collect()
    assert rows and all(len(r["content"].split()) <= 200 for r in rows)
    assert all("\n\n## Aliquote\n\n" in r["content"] and r["title"] == "Aliquote" and r["content"].count("<table") == r["content"].count("</table>") for r in rows)
    assert one(spark, lambda c: T.truncated(c, 20), "a " * 30 + "<b") == "a " * 10


def test_random_negatives_of_any_ids(spark):
    docs = spark.createDataFrame([(1000 * i, f"testo {i % 5}") for i in range(1, 41)], "doc_id long, text string")
    taken = spark.createDataFrame([(1, 1000), (2, 2000)], "question long, doc long")
    got = B.random_negatives(taken.select("question"), docs, taken, 12).collect()
    assert sorted(r["question"] for r in got) == [1] * 12 + [2] * 12
    assert all(r["doc"] // 1000 % 5 != r["question"] for r in got)
    assert sorted((r["place"], r["doc"]) for r in B.ranks(docs).collect()) == [(i, 1000 * (i + 1)) for i in range(40)]


def test_rankings_are_filled_up(spark):
    docs = spark.createDataFrame([(7 * i, "gatto" if i == 9 else f"testo {i}") for i in range(20)], "doc_id long, text string")
    got = B.bm25(docs, spark.createDataFrame([(1, "gatto")], "item_id long, text string"), k=5).orderBy("rank").collect()
    assert [r["doc"] for r in got] == [63, 0, 7, 14, 21] and got[0]["score"] > 0 == got[1]["score"]


def test_ranking_leaves_documents_where_they_are(spark, monkeypatch):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(12))
    rows = [(i, f"{text()}, È\x1c{text()}\u00a0x") for i in range(120)] + [(500, None), (501, ""), (3, " ".join(["w1"] * 25))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    questions = spark.createDataFrame([(i, text()) for i in range(7)] + [(9, "niente")], "item_id long, text string")
    # By hand: rows of one id are one document of their words, null texts count as documents alone
    tokens = {}
    for d, x in rows:
        tokens.setdefault(d, []).extend(one(spark, T.bm25_tokens, x) or [] if d in (3, 7, 500) else x.lower().replace(",", "").replace("\x1c", "\x01").split())
    tokens = {d: [x.replace("\x01", "\x1c") for x in t] for d, t in tokens.items()}
    size = {d: 25 if d == 3 else len(t) for d, t in tokens.items()}
    assert size[7] == len(tokens[7]) == 25 == len(tokens[3]) / 2
    mean_dl = sum(len(t) for t in tokens.values()) / (len(rows) - 1)
    df = {}
    for t in tokens.values():
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    idf = {x: math.log((len(rows) - n + 0.5) / (n + 0.5)) for x, n in df.items()}
    mean = sum(idf.values()) / len(idf)
    want = {}
    for q in questions.collect():
        score = {d: 0.0 for d in tokens}
        for x in q["text"].split():
            for d, t in tokens.items():
                tf = t.count(x)
                score[d] += (0.25 * mean if idf.get(x, 0) < 0 else idf.get(x, 0)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * size[d] / mean_dl))
        want[q["item_id"]] = sorted(((-round(v, 6), d) for d, v in score.items()))[:20]
    best = B.bm25(docs, questions, k=20)
    plan = best._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in plan and plan.count("MapInArrow") == 1
    for few in (False, True):
        if few:
            monkeypatch.setattr(B, "QUESTIONS", 3)
            monkeypatch.setattr(B, "CELLS", 40)
            monkeypatch.setattr(B, "HELD", 30)
            best = B.bm25(docs, questions, k=20)
        got = {}
        for r in best.orderBy("question", "rank").collect():
            got.setdefault(r["question"], []).append((-r["score"], r["doc"]))
        assert {q: sorted(x) for q, x in got.items()} == want


def test_strict_lines_fail_on_a_blank_one(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n')
    assert io.json_lines(spark, str(tmp_path), io.CHUNK).count() == 2
    with pytest.raises(Exception, match="blank line"):
        io.json_lines(spark, str(tmp_path), io.CHUNK, strict=True).collect()


def test_pool_places_gold(spark):
    docs = spark.createDataFrame([(i, f"testo {i} parola{i % 7} " + ("gatto " * (i % 3))) for i in range(60)], "doc_id long, text string")
    questions = spark.createDataFrame([(1, "gatto parola3"), (2, "testo parola5")], "item_id long, text string")
    best = B.bm25(docs, questions)
    gold = best.filter("rank = 1").select("question", "doc")
    hard = B.hard_negatives(best, docs, gold)
    rest = B.random_negatives(gold, docs, gold.union(hard.select("question", "doc")), 12)
    for r in B.pool(gold, hard, rest, docs).collect():
        g = gold.filter(F.col("question") == r["question"]).first()["doc"]
        assert len(r["docs"]) == 20 and [r["doc_ids"][p] for p in r["pos_index"]] == [g]


def test_review_upsert(spark):
    status = spark.createDataFrame([("raw_1", "approved"), ("raw_2", "flagged")], "_id string, status string")
    events = spark.createDataFrame([("raw_1", "pending", 1), ("raw_2", "bad", 2), ("", "approved", 3), ("raw_3", "rejected", 4), ("raw_3", "approved", 5)], "_id string, status string, seq long")
    assert {(r["_id"], r["status"]) for r in V.upsert(status, events).collect()} == {("raw_2", "flagged"), ("raw_3", "approved")}


def test_stage1_lines_round_trip(spark, tmp_path):
    rows = [("qa", ["a?", "b?"], ["1", "2"], ["d"], [0]), ("paraphrase", [""], ["p"], ["d"], [0])]
    df = spark.createDataFrame(rows, "data_type string, question array<string>, answers array<string>, docs array<string>, pos_index array<int>")
    io.write_stage1(df, str(tmp_path / "s1"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "s1")).collect()]
    assert sorted(map(str, (x["question"] for x in lines))) == ["", "['a?', 'b?']"]
    assert sorted(map(tuple, (r["question"] for r in io.stage1_lines(spark, str(tmp_path / "s1")).collect()))) == [("",), ("a?", "b?")]


def test_generation_failures_and_resume(spark):
    def client():
        def call(prompt):
            if prompt == "bad":
                raise ValueError("no")
            return {"response": '{"a": 1}', "prompt_tokens": 1, "completion_tokens": 1}

        return call

    prompts = spark.createDataFrame([(0, "ok"), (1, "bad")], "win_idx long, prompt string")
    assert {(r["win_idx"], r["ok"]) for r in G.generate(prompts, client).collect()} == {(0, True), (1, False)}
    done = spark.createDataFrame([(0, "processed"), (1, "failed")], "win_idx long, status string")
    assert [r["win_idx"] for r in G.to_do(prompts, done).collect()] == [1]


def test_markdown_source_and_stream(spark, tmp_path):
    from docloom.streaming.files import chunk_stream

    folder = tmp_path / "md"
    (folder / "sub").mkdir(parents=True)
    for name in ("b.md", "a.md"):
        (folder / name).write_text("# t\n## Aliquote\n" + "parola " * 200)
    assert [(r["source"], len(r["md"])) for r in io.markdown(spark, str(folder), 1).collect()] == [("a.md", 1416)]
    chunk_stream(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert {r["source"] for r in spark.read.parquet(str(tmp_path / "out")).select("source").collect()} == {"a.md", "b.md"}


def random_text(rnd):
    words = ["alfa", "Beta", "art.", "12", "gamma.", "Delta!", "e", "Sez."]
    table = lambda: "<table><tr><th>k</th></tr>" + "".join(f"<tr><td>r {i}</td></tr>" for i in range(rnd.randint(0, 12))) + "</table>"
    kinds = [lambda: " ".join(rnd.choices(words, k=rnd.randint(1, 30))), table, lambda: "\n*" + rnd.choice(["a", "b", "m-bis", "3"]) + ")* voce", lambda: "2. *Sono deducibili:*"]
    return "".join(rnd.choices(kinds, [6, 2, 1, 1])[0]() + rnd.choice(["\n\n", "\n", " "]) for _ in range(rnd.randint(1, 9)))


def test_splitting_by_tokenizer_equals_columns(spark):
    from docloom.operators.splitting import Splitter, Words

    rnd = random.Random(7)
    texts = [random_text(rnd) for _ in range(150)] + ["", "\n\n", "x"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    rows = df.select("i", C.split_long(F.col("t"), F.lit(20)).alias("p"), T.sentences(F.col("t")).alias("s")).collect()
    from docloom.operators import splitting as S

    splitter = Splitter(Words())
    for r in rows:
        text = texts[r["i"]]
        assert r["p"] == splitter.parts(text, 20), text
        assert r["s"] == S.sentences(text), text
        assert "".join(" ".join(r["p"]).split()).count("voce") == text.count("voce")


def test_tables_around_text_are_all_kept(spark):
    from docloom.operators.splitting import Splitter, Words

    tables = ["<table><tr><th>k</th></tr>" + "".join(f"<tr><td>{n} {i}</td></tr>" for i in range(9)) + "</table>" for n in "pq"]
    text = f"prima {tables[0]} mezzo {tables[1]} dopo"
    got = one(spark, lambda c: C.split_long(c, F.lit(12)), text)
    assert got == Splitter(Words()).parts(text, 12)
    assert got[0] == "prima" and got[-1] == "dopo" and "mezzo" in got
    assert all(f"{n} {i}</td>" in "".join(got) for n in "pq" for i in range(9))


def test_no_chunk_is_above_the_budget_in_subwords(spark):
    from docloom.operators.splitting import Subwords

    path = "/opt/tokenizers/byte_bpe_50k.json"
    body = " ".join(f"Frase numero {i}." for i in range(200)) + "\n\nbreve\n\n" + " ".join(f"parola{i}" for i in range(900))
    docs = spark.createDataFrame([("IVA_2024.md", f"# x\n## Aliquote\n{body}"), (None, None)], "source string, md string")
    rows = C.chunks(docs, max_tokens=200, min_chars=100, make_tokenizer=lambda: Subwords(path)).collect()
    sizes = [len(Subwords(path).encode(r["content"])) for r in rows]
    assert len(rows) > 4 and max(sizes) <= 200 and max(sizes) > 150
    assert all("\n\n## Aliquote\n\n" in r["content"] for r in rows)


def test_running_sum_equals_a_fold(spark):
    from docloom.session import running_sum

    rnd = random.Random(3)
    values = [(None, 4)] + [(k, rnd.randint(0, 9)) for k in rnd.sample(range(5000), 700)]
    got = {r["k"]: r["upto"] for r in running_sum(spark.createDataFrame(values, "k int, v int"), "k", "v", "upto").collect()}
    total = 0
    for k, v in sorted(values, key=lambda x: -1 if x[0] is None else x[0]):
        total += v
        assert got[k] == total
    assert running_sum(spark.createDataFrame([], "k int, v int"), "k", "v", "upto").count() == 0


def test_prompt_templates(spark):
    from docloom.operators.prompts import filled

    assert one(spark, lambda c: filled('{{"x": "{a}"}} {b}', a=c, b=F.lit(None)), "è") == '{"x": "è"} '
    with pytest.raises(ValueError):
        filled("{a} {c}", a=F.lit(1))


def test_judge_stops_at_the_first_low_score(spark, tmp_path):
    log = str(tmp_path / "calls")

    def client():
        def call(prompt):
            with open(log, "a") as f:
                f.write(prompt + "\n")
            if "rotto" in prompt:
                raise ValueError("no")
            return {"response": 'ecco {"score": %s}' % prompt.split("=")[1]}

        return call

    rows = [("qa", ["a", "b"], ["=5", "=4"]), ("qa", ["c", "d"], ["=3", "=5"]), ("qa", ["e"], ["rotto=5"]), ("paraphrase", [""], ["=1"]), ("qa", ["f"], ["=null"]), ("qa", None, None)]
    df = spark.createDataFrame([(i, *x, ["doc"]) for i, x in enumerate(rows)], "i int, data_type string, question array<string>, answers array<string>, docs array<string>")
    assert sorted(r["i"] for r in G.judge(df, client, "{question}{answer}", first_wait=0).collect()) == [0, 3, 5]
    calls = open(log).read().split()
    assert "d=5" not in calls and calls.count("erotto=5") == 3


def test_conversion_of_a_folder(spark, tmp_path):
    from docloom.operators import conversion

    for name, content in (("a", "uno|due|!|quattro"), ("b", "?"), ("c", "x"), ("d", "p|q")):
        (tmp_path / f"{name}.pdf").write_text(content)

    def count(content):
        return len(content.decode().split("|")) if content != b"?" else int("no")

    def render(content, first, last):
        return [(n, content.decode().split("|")[n - 1].encode()) for n in range(first, last + 1) if content.decode().split("|")[n - 1] != "due"]

    def model():
        def read(image):
            if image == b"!":
                raise ValueError("vuota")
            return image.decode().upper()

        return read

    def layout(image):
        return [{"kind": image.decode()}]

    made = spark.createDataFrame([("c",)], "stem string")
    md, pages, report = conversion.convert(io.pdfs(spark, str(tmp_path)), made, count, render, model, 3, 4, layout)
    assert {r["source"]: (r["pages"], r["missing"]) for r in report.collect()} == {"a": (4, 1), "d": (2, 0)}
    texts = {r["source"]: r["md"] for r in md.collect()}
    assert texts["a"] == "# a\n\n## Page 1\n\nUNO\n\n---\n\n## Page 3\n\n> [Error] vuota\n\n---\n\n## Page 4\n\nQUATTRO\n\n---\n\n"
    io.write_layout(pages, str(tmp_path / "layout"))
    listed = {r["source"]: json.loads(r["value"]) for r in spark.read.option("wholetext", True).text(str(tmp_path / "layout")).collect()}
    assert listed["d"] == [{"page": 1, "blocks": [{"kind": "p"}]}, {"page": 2, "blocks": [{"kind": "q"}]}] and [x["page"] for x in listed["a"]] == [1, 3, 4]


def test_png_is_rgb():
    import zlib

    import numpy as np

    from docloom.models import png

    for image in (np.arange(6, dtype=np.uint8).reshape(2, 3), np.arange(24, dtype=np.uint8).reshape(2, 3, 4)):
        data = png(image)
        start = data.index(b"IDAT") + 4
        lines = np.frombuffer(zlib.decompress(data[start : start + int.from_bytes(data[start - 8 : start - 4], "big")]), np.uint8).reshape(2, 10)
        want = np.stack([image] * 3, axis=2) if image.ndim == 2 else image[:, :, :3]
        assert (lines[:, 0] == 0).all() and (lines[:, 1:].reshape(2, 3, 3) == want).all()


def test_physical_line_numbers(spark, tmp_path):
    lines = [json.dumps({"question": f"q{i}"}) if i % 7 else "" for i in range(3000)]
    (tmp_path / "s.jsonl").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # many blocks
    try:
        stages = V.stage_files(spark, {"stage1": str(tmp_path / "s.jsonl"), "stage3": str(tmp_path / "none")}, {"stage1": "question string"})
        rows = stages["stage1"].collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(stages) == {"stage1"} and {r["line"]: r["question"] for r in rows} == {i: f"q{i}" for i in range(3000) if i % 7}


def test_command_lines(spark, tmp_path):
    from docloom.__main__ import main

    (tmp_path / "md").mkdir()
    for n in "ab":
        (tmp_path / "md" / f"{n}.md").write_text(f"# t\n## Aliquote {n}\n" + "Una parola di piu. " * 100)
    (tmp_path / "prompt").write_text('Testo {{"x"}}: {windows_text}')
    chunks, made = str(tmp_path / "chunks"), str(tmp_path / "made")
    main(["chunk", str(tmp_path / "md"), chunks, "--max-tokens", "150"])
    n = spark.read.json(chunks).count()
    assert n >= 4
    generate = ["generate", chunks, made, "--client", "docloom.models:echo_client", "--template", str(tmp_path / "prompt")]
    main([*generate, "--limit", "1"])
    main(generate)
    done = io.read_done(spark, f"{made}/done").collect()
    assert sorted(r["win_idx"] for r in done) == list(range(n)) and {r["status"] for r in done} == {"processed"}
    assert io.stage1_lines(spark, f"{made}/stage1").filter("data_type = 'paraphrase'").count() == n
