"""DuckDB SQL of the library's queries."""

from __future__ import annotations

from docloom.functions.text import BOILERPLATE_TITLES, DEFAULT_TOPIC, PUNCTUATION, TOPICS
from docloom.plans import fixtures as X


def q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def values(rows, names: str) -> str:
    body = ", ".join("(" + ", ".join(q(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({names}))"


_TOKENS = f"list_filter(string_split_regex(translate(lower(text), {q(PUNCTUATION)}, repeat(' ', {len(PUNCTUATION)})), '\\s+'), lambda x: x <> '')"
_POSTINGS = f"""
toks AS (SELECT doc_id, text, {_TOKENS} AS tk FROM documents),
post AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT doc_id, len(tk) AS dl, unnest(tk) AS term FROM toks) GROUP BY 1, 2),
stat AS (SELECT term, count(*) AS df, sum(tf) AS total FROM post GROUP BY 1)"""
_BM25 = f"""{_POSTINGS},
corpus AS (SELECT count(*) AS n, avg(len(tk)) AS avgdl FROM toks),
idf0 AS (SELECT term, ln((n - df + 0.5) / (df + 0.5)) AS idf FROM stat, corpus),
idf AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM idf0) ELSE idf END AS idf FROM idf0),
asked AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TOKENS}) AS term FROM benchmark) GROUP BY 1, 2),
score AS (SELECT item_id, doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
    FROM asked JOIN post USING (term) JOIN idf USING (term), corpus GROUP BY 1, 2),
scored AS (SELECT * FROM score UNION ALL SELECT item_id, doc_id, 0.0 FROM (SELECT DISTINCT item_id FROM benchmark) CROSS JOIN (SELECT doc_id FROM documents) ANTI JOIN score USING (item_id, doc_id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 50)"""
_HARD = f"""{_BM25},
cont AS (SELECT doc_id, md5(coalesce(text, '')) AS content FROM documents),
gold AS (SELECT item_id, doc_id FROM best WHERE rank = 1),
golden AS (SELECT DISTINCT item_id, content FROM gold JOIN cont USING (doc_id)),
hard AS (SELECT item_id, doc_id, place FROM (SELECT b.item_id, b.doc_id, row_number() OVER (PARTITION BY b.item_id ORDER BY rank) AS place
    FROM best b JOIN cont c USING (doc_id) WHERE NOT EXISTS (SELECT 1 FROM golden g WHERE g.item_id = b.item_id AND g.content = c.content)) WHERE place <= 7)"""
_RANDOM = f"""{_HARD},
used AS (SELECT DISTINCT item_id, content FROM (SELECT item_id, doc_id FROM gold UNION ALL SELECT item_id, doc_id FROM hard) JOIN cont USING (doc_id)),
drawn AS (SELECT item_id, draw, (item_id * 1000003 + draw * 7919 + 42) % n AS spot FROM gold, corpus, (SELECT unnest(range(1, 1025)) AS draw)),
places AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS spot FROM documents),
rnd AS (SELECT item_id, doc_id, place FROM (SELECT d.item_id, c.doc_id, row_number() OVER (PARTITION BY d.item_id ORDER BY draw) AS place
    FROM drawn d JOIN places USING (spot) JOIN cont c USING (doc_id) WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.item_id = d.item_id AND u.content = c.content)) WHERE place <= 12)"""
_TALK = "talk AS (SELECT conv_id AS source, turn AS id, role AS title, text AS content FROM conversations)"


def _windows(per_source: bool) -> str:
    lo, hi = ("min(rn) OVER (PARTITION BY source)", "max(rn) OVER (PARTITION BY source) + 1") if per_source else ("0", "count(*) OVER ()")
    part = "PARTITION BY source " if per_source else ""
    return f"""{_TALK},
p AS (SELECT *, row_number() OVER (ORDER BY source, id) - 1 AS rn FROM talk),
f AS (SELECT *, CASE WHEN lag(coalesce(title, '')) OVER ({part}ORDER BY rn) = coalesce(title, '') THEN 0 ELSE 1 END AS fresh FROM p),
r AS (SELECT *, sum(fresh) OVER (ORDER BY rn) AS run, {lo} AS lo, {hi} AS hi FROM f),
e AS (SELECT *, min(rn) OVER (PARTITION BY run) AS rs, max(rn) OVER (PARTITION BY run) AS re FROM r),
a AS (SELECT *, rn - least(rn - rs, 6) AS s0 FROM e), b AS (SELECT *, rn + 1 + least(re - rn, 7 - (rn - s0 + 1)) AS e0 FROM a),
c AS (SELECT *, greatest(0, 3 - (e0 - s0)) AS d FROM b), g AS (SELECT *, s0 - least(d // 2, s0 - lo) AS s1 FROM c),
h AS (SELECT *, e0 + least(d - (s0 - s1), hi - e0) AS e1 FROM g),
w AS (SELECT source, id, title, content, rn, CASE WHEN e1 - s1 < 3 AND s1 > lo THEN greatest(lo, e1 - 3) ELSE s1 END AS win_start,
    CASE WHEN e1 - s1 < 3 AND s1 <= lo AND e1 < hi THEN least(hi, s1 + 3) ELSE e1 END AS win_end FROM h)"""


_SENTENCE = """concat('Art. ', o_orderkey % 200, ' comma ', o_orderkey % 9 + 1, ': entro il ', o_orderkey % 28 + 1, '/03/', 2000 + o_orderkey % 30, ' versare € ', o_orderkey % 900 + 1, '.500,', o_orderkey % 90 + 10,
    ' pari al ', o_orderkey % 40, ',5 % in ', o_orderkey % 120 + 1, ' rate, L. ', o_orderkey % 400 + 1, '/2012')"""


def _numbers(s: str) -> str:
    """Independent of the Spark form: RE2 on the shapes that the sentences have."""
    return f"""list_distinct(list_transform(flatten([
        regexp_extract_all({s}, '\\b\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{2,4}}\\b'),
        list_transform(regexp_extract_all({s}, '€\\s*[\\d.,]+'), lambda x: replace(CASE WHEN contains(x, ',') THEN replace(x, '.', '') ELSE x END, ',', '.')),
        list_transform(regexp_extract_all({s}, '(?i)\\b(?:Art\\.|Articolo)\\s*(\\d+)', 1), lambda x: concat('art. ', x)),
        list_transform(regexp_extract_all({s}, '(?i)\\b(?:Art\\.|Articolo)\\s*(\\d+)', 1), lambda x: concat('articolo ', x)),
        regexp_extract_all({s}, '(?i)\\b(?:D\\.L\\.|D\\.Lgs\\.|L\\.)\\s*\\d+/\\d{{2,4}}\\b'),
        regexp_extract_all({s}, '(?i)\\bcomma\\s+\\d+\\b'),
        list_transform(regexp_extract_all({s}, '\\b\\d+(?:[.,]\\d+)?\\s*%'), lambda x: replace(x, ',', '.')),
        regexp_extract_all({s}, '(?i)\\b\\d+(?:[.,]\\d+)?\\s+(?:giorni|mesi|anni|rate)\\b'),
        regexp_extract_all({s}, '\\b(?:19|20)\\d{{2}}\\b')]), lambda x: trim(lower(x))))"""


def _topic() -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join('(' + ' AND '.join(f'contains(upper(name), {q(y)})' for y in k) + ')' for k in keys)} THEN {q(n)}" for keys, n in TOPICS) + f" ELSE {q(DEFAULT_TOPIC)} END"


_TABLED = "replace(replace(replace(replace(html, '<ul>', '<table>'), '</ul>', '</table>'), '<li>', '<tr><td>'), '</li>', '</td></tr>')"
_CLEAN = "trim(regexp_replace(regexp_replace(title, '^#+\\s*', ''), '[*_]+', '', 'g'))"
_DERIVED = "md AS (SELECT doc_id AS source, replace(replace(text, chr(10), chr(10) || '## '), '. ', '.' || chr(10)) AS md FROM documents)"
_SECTIONS = f"""{_DERIVED},
sec AS (SELECT source, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS part FROM (SELECT source, string_split(md, chr(10) || '## ') AS l FROM md)),
parts AS (SELECT source, pos, CASE WHEN pos = 0 THEN '' ELSE '## ' || split_part(part, chr(10), 1) END AS header,
    CASE WHEN pos = 0 THEN part ELSE substr(part, length(split_part(part, chr(10), 1)) + 2) END
    || CASE WHEN pos < max(pos) OVER (PARTITION BY source) AND (pos = 0 OR contains(part, chr(10))) THEN chr(10) ELSE '' END AS body FROM sec)"""
_TOC_BODY = "replace(text, '.', ' .. 12')"
_TOC_LINES = f"list_transform(string_split(trim({_TOC_BODY}, ' ' || chr(10) || chr(9)), chr(10)), lambda x: trim(x))"
_REVIEW = """
rev AS (SELECT 'raw_' || doc_id AS _id, 'raw' AS _stage, doc_id AS line, CASE WHEN lang = 'en' THEN 'qa' ELSE 'paraphrase' END AS data_type, text FROM documents
    UNION ALL SELECT 's2_' || (conv_id * 100 + turn), 's2', conv_id * 100 + turn, 'qa', text FROM conversations UNION ALL SELECT 's3_' || item_id, 's3', item_id, 'qa', text FROM benchmark),
status AS (SELECT 'raw_' || doc_id AS _id, CASE WHEN quality = 1 AND toxic = 0 THEN 'approved' WHEN quality = 1 THEN 'flagged' ELSE 'rejected' END AS status FROM labels),
stated AS (SELECT rev.*, coalesce(status, 'pending') AS _status FROM rev LEFT JOIN status USING (_id))"""

ORACLE_SQL = {
    "bm25_tokens": f"SELECT doc_id, len(tk) AS n_tokens, md5(array_to_string(tk, ' ')) AS tokens_md5 FROM (SELECT doc_id, {_TOKENS} AS tk FROM documents)",
    "bm25_df_tf": f"WITH {_POSTINGS} SELECT term, df, total AS total_tf FROM stat",
    "bm25_topk": f"WITH {_BM25} SELECT item_id, doc_id, rank, score FROM best",
    "hard_negatives": f"WITH {_HARD} SELECT item_id, doc_id, place FROM hard",
    "random_negatives": f"WITH {_RANDOM} SELECT item_id, doc_id, place FROM rnd",
    "stage3_pool": f"""WITH {_RANDOM},
        al AS (SELECT item_id, doc_id, 1 AS place, 0 AS kind FROM gold UNION ALL SELECT item_id, doc_id, place, 1 FROM hard UNION ALL SELECT item_id, doc_id, place, 2 FROM rnd),
        nu AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY kind, place, doc_id) AS nth FROM al),
        mi AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY md5('42|' || item_id || '|' || nth)) - 1 AS pos FROM nu WHERE nth <= 20)
        SELECT m.item_id, count(*) AS n_docs, string_agg(m.doc_id, ',' ORDER BY pos) AS doc_ids, string_agg(CASE WHEN g.content IS NOT NULL THEN pos END, ',' ORDER BY pos) AS pos_index
        FROM mi m JOIN cont c USING (doc_id) LEFT JOIN golden g ON g.item_id = m.item_id AND g.content = c.content GROUP BY 1""",
    "number_extract": f"SELECT o_orderkey, array_to_string(list_sort({_numbers('s')}), '|') AS numbers FROM (SELECT o_orderkey, {_SENTENCE} AS s FROM orders)",
    "number_gate": """SELECT o_orderkey, a = b AS valid, CASE WHEN a = b THEN '' ELSE concat('art. ', a, '|articolo ', a) END AS missing
        FROM (SELECT o_orderkey, o_orderkey % 200 AS a, o_orderkey % 100 AS b FROM orders)""",
    "filename_metadata": f"""SELECT name, CASE WHEN y = '' THEN 'N/A' ELSE y END AS year, {_topic()} AS topic, trim(CASE WHEN y = '' THEN c ELSE replace(c, y, '') END) AS source_cleaned
        FROM (SELECT name, regexp_extract(name, '(20\\d{{2}})', 1) AS y, regexp_replace(replace(replace(name, '.md', ''), '_', ' '), '(?i)\\s+(Digitale|PS|UO)\\s*$', '') AS c FROM {values(X.FILES, "name")})""",
    "adaptive_windows": f"WITH {_windows(False)} SELECT source, id, rn, win_start, win_end, CAST(rn - win_start AS INTEGER) AS center_idx FROM w",
    "adaptive_windows_per_source": f"WITH {_windows(True)} SELECT source, id, rn, win_start, win_end, CAST(rn - win_start AS INTEGER) AS center_idx FROM w",
    "window_text": f"""WITH {_windows(False)} SELECT w.rn, md5(string_agg(concat('=== CHUNK #', x.id, ' (', CASE WHEN x.rn = w.rn THEN 'CHUNK CENTRALE' WHEN x.rn < w.rn THEN 'Contesto Precedente' ELSE 'Contesto Successivo' END,
        ') ===', chr(10), 'Fonte: ', x.source, chr(10), 'Titolo: ', x.title, chr(10), chr(10), x.content, chr(10)), chr(10) ORDER BY x.rn)) AS text_md5
        FROM w JOIN p x ON x.rn >= w.win_start AND x.rn < w.win_end GROUP BY w.rn""",
    "window_size_stats": f"WITH {_windows(False)} SELECT min(win_end - win_start) AS min_size, max(win_end - win_start) AS max_size, round(avg(win_end - win_start), 6) AS avg_size, count(*) AS n FROM w",
    "resume_to_do": "SELECT event_id AS win_idx FROM events WHERE event_id % 3 = 0 OR event_id % 5 = 0",
    "checkpoint_progress": "SELECT count(DISTINCT CASE WHEN event_id % 5 <> 0 THEN user_id END) AS processed_count, count(DISTINCT CASE WHEN event_id % 5 = 0 THEN user_id END) AS failed_count FROM events",
    "table_extract": f"""SELECT page_id, len(l) AS n_tables, md5(array_to_string(l, '|')) AS tables_md5, contains(lower(h), '<table') AND contains(lower(h), '</table>') AS has_table
        FROM (SELECT page_id, h, regexp_extract_all(h, '(?is)<table[^>]*>.*?</table>') AS l FROM (SELECT page_id, {_TABLED} AS h FROM pages))""",
    "table_rowsplit": """WITH room AS (SELECT p_partkey, p_size, g AS row, (g - 1) // 7 AS part FROM part, unnest(range(1, p_size + 1)) AS u(g)),
        made AS (SELECT p_partkey, part, concat('<table>', chr(10), '<tr><th>k v</th></tr>', chr(10), string_agg(concat('<tr><td>r ', row, '</td></tr>'), chr(10) ORDER BY row), chr(10), '</table>') AS t FROM room GROUP BY 1, 2)
        SELECT p_partkey, count(*) AS n_parts, md5(string_agg(t, '|' ORDER BY part)) AS parts_md5 FROM made GROUP BY 1""",
    "content_length_filter": "SELECT doc_id, n FROM (SELECT doc_id, length(regexp_replace(regexp_replace(text, '(?m)^#+\\s+.*$', '', 'g'), '^\\s+|\\s+$', '', 'g')) AS n FROM documents) WHERE n >= 500",
    "min_words_filter": "SELECT doc_id, n_words FROM (SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS n_words FROM documents) WHERE n_words >= 10",
    "boilerplate_filter": f"""SELECT title, {_CLEAN} AS clean, regexp_matches(lower({_CLEAN}), {q("|".join(BOILERPLATE_TITLES))}) AS boilerplate,
        contains(upper(title), 'INDICE') OR regexp_matches(title, '\\d+$|[.·]{{2,}}|^##\\s*\\d+\\.|(?i:\\b(Sezione|Parte|Capitolo|Appendice)\\b)') AS toc_entry FROM {values(X.TITLES, "title")}""",
    "toc_line_ratio": f"SELECT doc_id, len(h) AS n_toc, round(len(h) / len(l), 6) AS ratio FROM (SELECT doc_id, l, list_filter(l, lambda x: regexp_matches(x, '(?:[.·]{{2,}}|\\s+pag\\.|\\s*»\\s*)\\s*\\d+$')) AS h FROM (SELECT doc_id, {_TOC_LINES} AS l FROM documents))",
    "toc_clean": f"""SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split({_TOC_BODY}, chr(10)), lambda x: trim(regexp_replace(regexp_replace(x, '(?i)(?:[.·]{{2,}}|\\s*»\\s*|\\s+pag\\.)', ' ', 'g'), '\\s+', ' ', 'g'))),
        lambda x: x <> ''), chr(10))) AS clean_md5 FROM documents""",
    "section_split": f"WITH {_SECTIONS} SELECT source, pos, header, md5(body) AS body_md5 FROM parts",
    "safe_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "stage1_records": """SELECT * FROM (VALUES (0, 'qa', 'Quanto vale?', 'Molto', 'centro'), (0, 'paraphrase', '', 'testo', 'centro'), (1, 'qa', 'Chi?', 'Lui', 'centro'), (4, 'qa', 'Dove?', 'Qui', 'centro'))
        AS v(win_idx, data_type, question, answers, docs)""",
    "stage12_records": """SELECT * FROM (VALUES (0, 'Quanto vale?', 'Molto', 'centro', '0', 'def', 100), (1, 'Chi?', 'Lui', 'centro', '0', 'simple_qas', 101),
        (1, 'Entro 30 giorni?', 'Si, 30 giorni', 'prima|centro|dopo', '0|1|2', 'complex_qas', 101), (2, 'A?', 'B', 'prima|centro|dopo', '0|1|2', 'multi_hop_qas', 102), (4, 'Dove?', 'Qui', 'centro', '0', 'simple_qas', 104))
        AS v(win_idx, question, answer, docs, pos_index, type, source_chunk_id)""",
    "judge_allpass": """WITH s AS (SELECT source, bool_and(quality = 1) AS ok FROM documents JOIN labels USING (doc_id) GROUP BY 1)
        SELECT d.source AS rec, n, CASE WHEN d.source = 'src1' THEN 'paraphrase' ELSE 'qa' END AS data_type FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1) d LEFT JOIN s USING (source) WHERE d.source = 'src1' OR coalesce(ok, FALSE)""",
    "review_union": f"WITH {_REVIEW} SELECT _stage, data_type, count(*) AS n, count(DISTINCT _id) AS ids FROM rev GROUP BY 1, 2",
    "review_filter": f"WITH {_REVIEW} SELECT _id, _status FROM stated WHERE _stage = 'raw' AND data_type = 'qa' AND _status = 'pending'",
    "review_page": f"WITH {_REVIEW} SELECT _id, _stage, _status FROM (SELECT *, row_number() OVER (ORDER BY _stage, line) AS n FROM stated) WHERE n BETWEEN 21 AND 30",
    "review_stats": f"""WITH {_REVIEW}, c AS (SELECT count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'flagged') AS flagged FROM status)
        SELECT total, approved, rejected, flagged, total - approved - rejected - flagged AS pending FROM (SELECT count(*) AS total FROM rev), c""",
    "review_upsert": f"""WITH {_REVIEW}, ev AS (SELECT 'raw_' || user_id AS _id, ['approved', 'rejected', 'flagged', 'pending', 'unknown'][event_id % 5 + 1] AS status, event_id AS seq FROM events),
        al AS (SELECT _id, status, -1 AS seq FROM status UNION ALL SELECT * FROM ev WHERE status <> 'unknown')
        SELECT _id, status FROM (SELECT _id, arg_max(status, seq) AS status FROM al GROUP BY 1) WHERE status <> 'pending'""",
    "review_export": f"WITH {_REVIEW} SELECT line, data_type, md5(text) AS text_md5 FROM stated WHERE _status = 'approved'",
    "page_markdown_sink": """SELECT conv_id AS source, md5(concat('# ', conv_id, chr(10), chr(10), string_agg(concat('## Page ', turn, chr(10), chr(10), text, chr(10), chr(10), '---', chr(10), chr(10)), '' ORDER BY turn, text))) AS md_md5
        FROM conversations WHERE text IS NOT NULL GROUP BY conv_id""",
    "layout_resize_dims": """SELECT p_partkey, CAST(CASE WHEN m <= 2048 THEN w ELSE floor(w * (2048.0::DOUBLE / m)) END AS INTEGER) AS width, CAST(CASE WHEN m <= 2048 THEN h ELSE floor(h * (2048.0::DOUBLE / m)) END AS INTEGER) AS height
        FROM (SELECT p_partkey, w, h, greatest(w, h) AS m FROM (SELECT p_partkey, p_partkey * 37 % 5000 + 1 AS w, p_size * 100 AS h FROM part))""",
    "page_ranges": "SELECT p_partkey AS stem, CAST(f AS INTEGER) AS first, CAST(least(f + 5, least(p_size, 20)) AS INTEGER) AS last FROM part, unnest(range(1, least(p_size, 20) + 1, 6)) AS u(f)",
    "generate_offline": "SELECT doc_id AS win_idx, TRUE AS ok, concat(length(text), ' caratteri') AS answer FROM documents",
    "number_cases": f"SELECT id, want AS numbers FROM {values(X.NUMBERS, 'id, text, want')}",
    "table_repair": f"SELECT id, want AS repaired FROM {values(X.REPAIRED, 'id, want')}",
    "table_balance": f"SELECT id, want AS balanced FROM {values(X.BALANCED, 'id, want')}",
    "toc_state": f"SELECT * FROM {values(X.STATES, 'source, pos, is_page, in_toc, page')}",
    "sentence_split": f"SELECT id, want AS sentences FROM {values(X.SENTENCES, 'id, text, want')}",
}
