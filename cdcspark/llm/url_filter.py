"""URL filter: prefix rules, and trust and distrust propagated over the host graph.

A url's longest fitting rule decides. For urls that no rule fits, hosts are judged by the links
between them: personalised PageRank along the links from the hosts of allowed pages (trust), and
along the reversed links from the hosts of blocked pages (distrust). There are ``ROUNDS`` rounds, fewer only
where no score of any host moves any more, so that verdicts never depend on how much the many settle
while a few, far from all seeds, are still to be reached. Scores of a kind sum to 1 in the end: hosts without a
link onwards give theirs back to the seeds, which comes to the same factor for all. A host is blocked
when its distrust passes ``threshold`` times its trust. All steps are DataFrame operations.

Cases: a null url or one without ``://`` has an empty host and path, fits no rule and is allowed; a
null html has no links; links to the own host and repeated links of a page do not add weight;
without links the seeds keep their start scores; repeated pages each keep their row; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scope, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DAMPING, THRESHOLD = 0.85, 1.0
#: Rounds, and those between two looks at whether a score still moves.
ROUNDS, STRIDE = 48, 6
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z]+:)?//([^/?#"'\s>]+)"""


def host_and_path(url: str) -> tuple[Column, Column]:
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.expr(f"substring(coalesce(cast(`{url}` as string), ''), locate('://', coalesce(cast(`{url}` as string), '')) + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """Text and kind of the longest fitting rule, or nulls; of equally long ones block wins."""
    text, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, kind = F.when(fits, h + p).otherwise(text), F.when(fits, k).otherwise(kind)
    return text, kind


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): pages of ``src`` that link to ``dst``, as a share of all links of ``src``."""
    links = pages.select("host", F.explode(F.array_distinct(F.transform(F.expr(f"regexp_extract_all(html, r'{LINK.replace(chr(39), chr(92) + 'x27')}', 1)"), lambda x: F.translate(x, UPPER, LOWER)))).alias("dst"))
    n = links.filter("host <> '' and dst <> host").groupBy(F.col("host").alias("src"), "dst").agg(F.count(F.lit(1)).alias("n"))
    return n


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, rounds: int = ROUNDS) -> DataFrame:
    """Scores (kind, host, score) after ``rounds`` rounds; ``seeds`` has them at the start, summing to 1 by kind.

    Trust runs along an edge, distrust against it; one join and one sum a round do both.
    """
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n"))
    total = written(both.groupBy("kind", "host").agg(F.sum("n").alias("all")), "degrees")
    both = written(both.join(total, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all")).alias("w")), "edges")
    start = seeds.withColumn("score", F.col("score") * (1 - damping))
    score, done = seeds, 0
    while done < rounds:
        before = score
        for _ in range(min(STRIDE, rounds - done)):
            moved = both.join(score, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("w") * F.col("score") * damping).alias("score"))
            score = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
            done += 1
        score = written(score, "scores")
        if score.join(before, ["kind", "host", "score"], "left_anti").isEmpty():
            break
    total = F.broadcast(score.groupBy("kind").agg(F.sum("score").alias("all")))  # two rows
    return score.join(total, "kind").select("kind", "host", (F.col("score") / F.col("all")).alias("score"))


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, damping: float = DAMPING, rounds: int = ROUNDS, threshold: float = THRESHOLD, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    host, path = host_and_path(url)
    p = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html).cast("string").alias("html"))
    text, kind = rule_of(F.col("host"), F.col("path"), rules)
    with scope(pages.sparkSession) as keep:
        judged = written(p.select("page_id", "host", "path", text.alias("rule"), kind.alias("kind")), "judged")
        edges = written(host_edges(p), "links")
        seeds = judged.filter("kind is not null and host <> ''").groupBy(F.when(F.col("kind") == "allow", "trust").otherwise("distrust").alias("kind"), "host").agg(F.count(F.lit(1)).alias("n"))
        seeds = written(seeds, "seeds")
        sums = {r.kind: r.n for r in seeds.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
        whole = F.when(F.col("kind") == "trust", float(sums.get("trust", 1))).otherwise(float(sums.get("distrust", 1)))
        seeds = seeds.select("kind", "host", (F.col("n") / whole).alias("score"))
        scores = seeds if edges.isEmpty() else propagate(edges, seeds, damping, rounds)
        bad = scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"))
        bad = written(bad.filter(F.col("distrust") > threshold * F.col("trust")).select("host", F.lit(True).alias("bad")), "hosts")
        keep += [judged, bad]
    return judged.join(bad, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("kind", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def sql() -> str:
    """DuckDB SQL of ``filter_urls`` with its defaults over ``pages``, the rounds written out."""
    ranked = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1]))
    case = lambda out: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{out(k, h, p)}'" for k, h, p in ranked) + " END"
    step = f"SELECT kind, host, sum(score) AS score FROM (SELECT e.kind, e.dest AS host, e.w * s.score * {DAMPING} AS score FROM e JOIN %s s USING (kind, host) UNION ALL SELECT kind, host, score * (1 - {DAMPING}) FROM s0) GROUP BY kind, host"
    rounds = ", ".join(f"s{i + 1} AS ({step % f's{i}'})" for i in range(ROUNDS))
    link = LINK.replace("'", "''")
    return f"""
WITH r AS (SELECT page_id, html, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT page_id, html, host, path, {case(lambda k, h, p: h + p)} AS rule, {case(lambda k, h, p: k)} AS kind FROM h),
l AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1), lambda x: translate(x, '{UPPER}', '{LOWER}')))) AS dst FROM j),
n AS (SELECT src, dst, count(*) AS n FROM l WHERE src <> '' AND src <> dst GROUP BY src, dst),
b AS (SELECT 'trust' AS kind, src AS host, dst AS dest, n FROM n UNION ALL SELECT 'distrust', dst, src, n FROM n),
e AS (SELECT kind, host, dest, n / sum(n) OVER (PARTITION BY kind, host) AS w FROM b),
c AS (SELECT CASE kind WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM j WHERE kind IS NOT NULL AND host <> '' GROUP BY ALL),
s0 AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS score FROM c), {rounds},
f AS (SELECT kind, host, score / sum(score) OVER (PARTITION BY kind) AS score FROM s{ROUNDS} WHERE EXISTS (SELECT 1 FROM n) UNION ALL SELECT * FROM s0 WHERE NOT EXISTS (SELECT 1 FROM n)),
d AS (SELECT host FROM f GROUP BY host HAVING coalesce(sum(score) FILTER (kind = 'distrust'), 0) > {THRESHOLD} * coalesce(sum(score) FILTER (kind = 'trust'), 0))
SELECT page_id, host, path, rule, coalesce(kind, CASE WHEN host IN (SELECT host FROM d) THEN 'block' ELSE 'allow' END) AS verdict FROM j
"""
