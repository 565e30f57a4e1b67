"""URL filter: explicit rules, and for the rest a tree of path templates per host.

Each host has a tree of its urls' path segments, of any depth. Going down, a segment stays literal if it has none of ``0-9*+`` and at least
``max(min_support, min_share * urls of its parent)`` urls; other segments are variable and become a wildcard, ``*`` with the extension. Literal branches of
one node are merged (``+``) if the counts of the templates below them agree with those of all its literal branches together: Pearson's
statistic of the branch against the others, at ``df`` degrees of freedom (templates less one), is at most ``df + deviations * sqrt(2 * df)``.
A template's purity is the share of urls that the rules block among those they judge, smoothed by ``smooth`` pseudo-urls that count one half;
urls without a rule are blocked if the purity of their template is at least ``reject``. Urls without a rule do not change it, however many they are.

The tree is built over distinct (host, path) with their counts, one level after another; a node with fewer than ``min_support`` urls has wildcards
alone below it and is finished at once, so the levels end where ``min_support`` urls of a host last share a template. Only built-in expressions are used.
The SQL for DuckDB is written by itself, as one recursive statement.

Defined cases: null urls and urls without ``://`` have empty host and path and form a host of their own; repeated rows
are each returned and each count; an empty table gives an empty result; extra columns are ignored; long paths are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import materialize, table

#: (verdict, host/path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MIN_SUPPORT, MIN_SHARE, DEVIATIONS, SMOOTH, REJECT = 5, 0.02, 3.0, 4, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST, _PATH, _EXTENSION = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)", r"([.][A-Za-z]+)\z"


def _fits(rule: str) -> str:
    host, _, path = rule.partition("/")
    path = f"/{path}"
    return f"((host = '{host}' OR right(host, {len(host) + 1}) = '.{host}') AND substr(path, 1, {len(path)}) = '{path}')"


def _cases(rules) -> tuple[str, str]:
    """SQL of the rule that holds for (host, path), the longest first, and of its verdict."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    return "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{r}'" for _, r in ordered) + " END", "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in ordered) + " END"


def _wild(segment: Column) -> Column:
    return F.when(segment == "", "").otherwise(F.concat(F.lit("*"), F.regexp_extract(segment, _EXTENSION, 1)))


def path_templates(paths: DataFrame, min_support: int = MIN_SUPPORT, min_share: float = MIN_SHARE) -> DataFrame:
    """``paths`` (host, path, n: urls) with template: the segments of each path, variable ones generalised."""
    segments = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.expr("substr(path, 2)"), "/"))
    alive, done, k = paths.withColumn("segments", segments).withColumn("template", F.lit("")), [], 0
    while True:
        ended = F.size("segments") <= k
        done.append(alive.filter(ended).select(*paths.columns, "template"))
        rows = alive.filter(~ended).withColumn("s", F.col("segments")[k])
        child = rows.groupBy("host", "template", "s").agg(F.sum("n").alias("urls"))
        node = child.groupBy("host", "template").agg(F.sum("urls").alias("total"))
        literal = ~F.col("s").rlike("[0-9*+]") & (F.col("urls") >= min_support) & (F.col("urls") >= F.lit(min_share) * F.col("total"))
        general = child.join(node, ["host", "template"]).select("host", "template", "s", "total", F.when(literal, F.col("s")).otherwise(_wild(F.col("s"))).alias("g"))
        made = materialize(rows.join(general, ["host", "template", "s"]), f"urls-level{k}")
        if made.isEmpty():
            break
        few = F.col("total") < min_support
        rest = F.array_join(F.transform(F.slice("segments", k + 1, F.greatest(F.size("segments") - k, F.lit(0))), lambda x: F.concat(F.lit("/"), _wild(x))), "")
        done.append(made.filter(few).select(*paths.columns, F.concat("template", rest).alias("template")))
        alive = made.filter(~few).select(*paths.columns, "segments", F.concat("template", F.lit("/"), "g").alias("template"))
        k += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def merged_templates(templates: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """(host, template, merged): ``templates`` (host, template, n) with literal branches of like counts below them as ``+``."""
    parts = F.split(F.expr("substr(template, 2)"), "/")
    rows = templates.filter("template <> ''").withColumn("parts", parts).select("host", "template", "n", "parts", F.posexplode("parts").alias("j", "g"))
    literal = (F.col("g") != "") & ~F.col("g").startswith("*")
    levels = rows.select(
        "host", "template", "n", "j", "g", F.when(literal, F.array_join(F.slice("parts", 1, F.col("j")), "/")).alias("prefix"),
        F.when(literal, F.array_join(F.transform(F.slice("parts", F.col("j") + 2, F.size("parts")), lambda x: F.concat(F.lit("/"), x)), "")).alias("shape"),
    )
    levels = materialize(levels.withColumn("depth", F.when(literal, F.col("j"))), "urls-branches")
    node, branch = ["host", "depth", "prefix"], ["host", "depth", "prefix", "g"]
    cells = levels.filter("prefix IS NOT NULL").groupBy(*branch, "shape").agg(F.sum("n").alias("cell"))
    shapes = cells.groupBy(*node, "shape").agg(F.sum("cell").alias("in_shape"))
    branches = cells.groupBy(*branch).agg(F.sum("cell").alias("in_branch"))
    nodes = shapes.groupBy(*node).agg(F.sum("in_shape").alias("total"), (F.count(F.lit(1)) - 1).alias("df"))
    square = F.sum(F.col("cell").cast("double") * F.col("cell") / F.col("in_shape")).alias("square")
    found = cells.join(shapes, [*node, "shape"]).groupBy(*branch).agg(square).join(branches, branch).join(nodes, node).filter("in_branch < total")
    pearson = (F.col("square") * F.col("total") / F.col("in_branch") - F.col("in_branch")) / (1 - F.col("in_branch") / F.col("total"))
    like = found.filter(F.round(pearson, 6) <= F.col("df") + F.lit(deviations) * F.sqrt(2.0 * F.col("df"))).select(*branch, F.lit("+").alias("plus"))
    listed = levels.join(like, branch, "left").groupBy("host", "template").agg(F.array_sort(F.collect_list(F.struct("j", F.coalesce("plus", "g").alias("g")))).alias("l"))  # a path's depth
    named = listed.select("host", "template", F.concat(F.lit("/"), F.array_join(F.transform("l", lambda x: x["g"]), "/")).alias("merged"))
    return named.unionByName(templates.filter("template = ''").select("host", "template", F.lit("").alias("merged")))


def url_filter(pages: DataFrame, rules=RULES, min_support=MIN_SUPPORT, min_share=MIN_SHARE, deviations=DEVIATIONS, smooth=SMOOTH, reject=REJECT) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, template, purity."""
    rule, verdict = _cases(rules)
    url = F.coalesce(F.col("url"), F.lit(""))
    raw = pages.select("page_id", F.translate(F.regexp_extract(url, _HOST, 1), _UPPER, _LOWER).alias("host"), F.regexp_extract(url, _PATH, 1).alias("path"))
    urls = materialize(raw.withColumn("rule", F.expr(rule)).withColumn("label", F.expr(verdict)), "urls-ruled")
    paths = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "block").alias("blocked"), F.count("label").alias("judged"))
    paths = materialize(path_templates(paths, min_support, min_share), "urls-paths")
    templates = materialize(paths.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("judged").alias("judged")), "urls-templates")
    merged = materialize(templates.join(merged_templates(templates, deviations), ["host", "template"]), "urls-merged")
    purity = (F.sum("blocked") + smooth / 2) / (F.sum("judged") + float(smooth))
    judged = merged.select("host", "template", "merged").join(merged.groupBy("host", "merged").agg(purity.alias("purity")), ["host", "merged"])
    by_path = paths.select("host", "path", "template").join(judged, ["host", "template"]).select("host", "path", F.col("merged").alias("template"), "purity")
    method = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    return urls.join(by_path, ["host", "path"]).select("page_id", "host", "path", "rule", F.coalesce("label", method).alias("verdict"), "template", F.round("purity", 6).alias("purity"))


def url_filter_sql(rules=RULES, min_support=MIN_SUPPORT, min_share=MIN_SHARE, deviations=DEVIATIONS, smooth=SMOOTH, reject=REJECT) -> str:
    """One recursive DuckDB statement over the table ``pages``."""
    rule, verdict = _cases(rules)
    return rf"""WITH RECURSIVE
    raw AS MATERIALIZED (SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(coalesce(url, ''), '{_HOST}', 1), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '{_PATH}', 1) AS path FROM pages),
    urls AS (SELECT *, {verdict} AS label FROM (SELECT *, {rule} AS rule FROM raw)),
    walk AS (
        SELECT rid, host, label, CASE WHEN path = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(substr(path, 2), '/') END AS segments, CAST([] AS VARCHAR[]) AS g FROM urls
        UNION ALL
        SELECT rid, host, label, segments, list_append(g, CASE WHEN s = '' OR (NOT regexp_matches(s, '[0-9*+]') AND urls >= {min_support} AND urls >= {min_share} * total) THEN s
            ELSE '*' || regexp_extract(s, '{_EXTENSION}', 1) END)
        FROM (SELECT *, count(*) OVER (PARTITION BY host, g, s) AS urls, count(*) OVER (PARTITION BY host, g) AS total
            FROM (SELECT *, segments[len(g) + 1] AS s FROM walk WHERE len(g) < len(segments)))),
    ends AS (SELECT rid, host, label, g FROM walk WHERE len(g) = len(segments)),
    steps AS (SELECT rid, host, label, g, unnest(range(1, len(g) + 1)) AS j FROM ends),
    literal AS (SELECT rid, host, j, g[:j - 1] AS prefix, g[j] AS branch, g[j + 1:] AS shape FROM steps WHERE g[j] <> '' AND g[j][1] <> '*'),
    cells AS (SELECT host, prefix, branch, shape, count(*) AS o FROM literal GROUP BY ALL),
    expected AS (SELECT b.host, b.prefix, b.branch, s.shape, b.n AS n, t.n AS total, 1.0::DOUBLE * b.n * s.n / t.n AS e
        FROM (SELECT host, prefix, branch, sum(o) AS n FROM cells GROUP BY ALL) b JOIN (SELECT host, prefix, shape, sum(o) AS n FROM cells GROUP BY ALL) s USING (host, prefix)
        JOIN (SELECT host, prefix, sum(o) AS n FROM cells GROUP BY ALL) t USING (host, prefix)),
    alike AS (SELECT host, prefix, branch FROM expected LEFT JOIN cells USING (host, prefix, branch, shape) WHERE n < total GROUP BY host, prefix, branch
        HAVING round(sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) / (1 - any_value(n) / any_value(total)::DOUBLE), 6) <= count(*) - 1 + {deviations} * sqrt(2.0 * (count(*) - 1))),
    named AS (SELECT rid, s.host, label, s.g, string_agg('/' || CASE WHEN a.branch IS NULL THEN s.g[s.j] ELSE '+' END, '' ORDER BY s.j) AS template
        FROM steps s LEFT JOIN alike a ON s.host = a.host AND s.g[:s.j - 1] = a.prefix AND s.g[s.j] = a.branch GROUP BY ALL
        UNION ALL SELECT rid, host, label, g, '' FROM ends WHERE len(g) = 0),
    purity AS (SELECT host, template, (count(*) FILTER (label = 'block') + {smooth} / 2.0) / (count(label) + {float(smooth)}::DOUBLE) AS purity FROM named GROUP BY host, template)
    SELECT u.page_id, u.host, u.path, u.rule, coalesce(u.label, CASE WHEN p.purity >= {reject} THEN 'block' ELSE 'allow' END) AS verdict, p.template, CAST(round(p.purity, 6) AS DOUBLE) AS purity
    FROM urls u JOIN named n USING (rid) JOIN purity p ON n.host = p.host AND n.template = p.template"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))
