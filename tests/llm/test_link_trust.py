"""Link trust: chains far from the seeds, hubs, repeated links, scores against a plain version."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cdcspark.llm import url_filter


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_sql(pages):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    out = con.sql(url_filter.sql())
    at = [out.columns.index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    return sorted((tuple(r[i] for i in at) for r in out.fetchall()), key=str)


def page(i, url, *links):
    return (i, url, " ".join(f'<a href="http://{h}/x">{h}</a>' for h in links))


def test_verdicts_far_from_many_seeds(spark):
    """3,000 trusted hosts without links take nearly all mass at once; a chain hangs on one, distrust on its far end."""
    pages = [page(i, f"http://h{i}.org/a") for i in range(3000)]
    pages.append(page(3000, "http://h0.org/b", "c1.net"))
    pages += [page(3000 + k, f"http://c{k}.net/", f"c{k + 1}.net") for k in range(1, 9)]
    pages.append(page(3100, "http://c9.net/", "d1.net", "b.com"))
    pages += [page(3200, "http://d1.net/", "d2.net"), page(3201, "http://d2.net/", "b.com"), page(3202, "http://b.com/de/x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    assert rows(url_filter.filter_urls(df).select("page_id", "host", "path", "rule", "verdict")) == by_sql(pages)


def test_scores_against_a_plain_version(spark):
    rng = random.Random(4)
    hosts = [f"h{i}.net" for i in range(30)]
    links = {(a, b): rng.randint(1, 5) for a in hosts for b in rng.sample(hosts, 3) if a != b} | {("hub.net", h): 1 for h in hosts} | {(h, "hub.net"): 2 for h in hosts[:20]}
    seeds = {("trust", "h0.net"): 0.25, ("trust", "lone.net"): 0.75, ("distrust", "h1.net"): 0.5, ("distrust", "h2.net"): 0.5}
    edges = spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "src string, dst string, n long")
    start = spark.createDataFrame([(k, h, s) for (k, h), s in seeds.items()], "kind string, host string, score double")
    for n in (1, 6, 13, 48):
        want = {}
        for kind in ("trust", "distrust"):
            e = {(a, b) if kind == "trust" else (b, a): w for (a, b), w in links.items()}
            out = {}
            for (a, _), w in e.items():
                out[a] = out.get(a, 0) + w
            own = {h: s for (k, h), s in seeds.items() if k == kind}
            score = dict(own)
            for _ in range(n):
                new = {h: 0.15 * s for h, s in own.items()}
                for (a, b), w in e.items():
                    if a in score:
                        new[b] = new.get(b, 0.0) + 0.85 * score[a] * w / out[a]
                score = new
            want |= {(kind, h): s / sum(score.values()) for h, s in score.items()}
        got = {(r.kind, r.host): r.score for r in url_filter.propagate(edges, start, 0.85, n).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("links", [True, False])
def test_repeated_links_clashing_columns_and_no_links(spark, links):
    own = ["a.net", "a.net", "A.NET", "b.org", "x.net"] if links else []
    pages = [page(1, "http://x.net/1", *own), page(1, "http://x.net/1", *own), page(2, "HTTP://B.org/p?q#f"), page(3, "http://a.net"), page(4, "http://y.com/de/1", *own), (5, None, None), (6, "no url", "href=//a.net"), (None, "http://sub.b.org#z", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "kind", "score", "rule", "n", "path")})
    assert rows(url_filter.filter_urls(df).select("page_id", "host", "path", "rule", "verdict")) == by_sql(pages)
