"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words: weights share the total, no target passes ``max_repeats`` times
its source, and what is cut there goes to the others by weight. A source with rate
``target / source size`` gives every document ``floor(rate)`` certain whole copies; the rest is a
sample of fixed size (in words) of unequal probabilities: the inclusion probability of a document
grows with the square root of its size, documents are ranked by the odds of a random number over
the odds of their inclusion, and the first of that order are taken until the rest is filled.

The random number is a hash of the document's id, its text and the seed, so reruns agree. The cut is
found from two levels of histograms over the order, so no task gathers a source; only the different
rows of one fine bin per source are ranked, with how often each is there.

Cases: a null text has size 0; a null source is a source of its own, the last; a source of no words
has target 0 and takes nothing; repeated rows share a rank, and where the cut falls among them so many
of them are taken as fit (by the other columns kept, where these differ); columns kept may have any
name but those of the result; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scope, written

BINS = 1024
#: Names of sources and their sums are handled on the driver; more than this many is an error.
MAX_SOURCES = 200_000


def n_words(text: str) -> Column:
    """Number of maximal runs outside space and 0x09-0x0D, as long; null counts 0."""
    squeezed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(squeezed, r"[\x20\x09-\x0D]", "")).cast("long")


def targets(sizes: list[int], weights: list[float], max_repeats: float) -> list[float]:
    """Targets that sum to all sizes: ``level * weight``, or the source's cap where that is lower."""
    total, rest = float(sum(sizes)), float(sum(weights))
    out = [0.0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (max_repeats * sizes[i] / weights[i], i)):
        level = total / rest
        out[i] = float(min(max_repeats * sizes[i], level * weights[i]))
        if max_repeats * sizes[i] < level * weights[i]:
            total -= max_repeats * sizes[i]
            rest -= weights[i]
    return out


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3, seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies and the columns ``keep``), a row per input row.

    ``weights`` go to the sources in code-point order, repeating, null last.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("_source"), n_words(text).alias("size"), F.col(text).cast("string").alias("_text"), *keep)
    # root: integer, so that its sums are exact in any order
    base = base.withColumn("_root", F.floor(F.sqrt("size")).cast("long") + 1)
    words = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("_text", F.lit("")))
    base = base.withColumn("_u", F.conv(F.substring(F.md5(words), 1, 13), 16, 10).cast("long")).drop("_text")
    with scope(spark) as kept:
        small = written(base.drop(*keep), "sizes")  # what the sums and the cut need; texts are read again at the end
        per = small.groupBy("_source").agg(F.sum("size").alias("s"), F.sum(F.col("size") * F.col("_root")).alias("r")).limit(MAX_SOURCES + 1).collect()
        if len(per) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        per.sort(key=lambda x: (x[0] is None, x[0] or ""))
        goal = targets([x.s for x in per], [float(weights[i % len(weights)]) for i in range(len(per))], max_repeats)
        plan = []
        for x, t in zip(per, goal, strict=True):
            whole = min(math.floor(t / x.s), max_repeats) if x.s else 0
            need = t - whole * x.s if x.s else 0.0
            plan.append((x[0], x.s, t, whole, need, need / x.r if x.r else 0.0))
        info = F.broadcast(spark.createDataFrame(plan, "_name string, source_size long, target double, _whole int, _need double, _c double"))  # MAX_SOURCES rows at most

        def ranked(d: DataFrame) -> DataFrame:
            d = d.join(info, F.col("_source").eqNullSafe(F.col("_name")), "left")
            u = (F.col("_u").cast("double") + 0.5) / float(16**13)
            p = F.col("_c") * F.col("_root")
            # odds of u over odds of p, turned to 0..1; certain ones (p >= 1) come first, in a bin of their own
            rank = F.when(p >= 1, F.lit(-1.0)).otherwise((u * (1 - p)) / (u * (1 - p) + p * (1 - u)))
            d = d.withColumn("_q", F.when((F.col("_need") > 0) & (F.col("size") > 0), rank))
            d = d.withColumn("_b1", F.when(F.col("_q") < 0, -1).otherwise(F.least(F.floor(F.col("_q") * BINS), F.lit(BINS - 1))).cast("int"))
            return d.withColumn("_b2", F.least(F.floor((F.col("_q") * BINS - F.col("_b1")) * BINS), F.lit(BINS - 1)).cast("int"))

        def with_cuts(d: DataFrame, *cuts: DataFrame) -> DataFrame:
            for i, cut in enumerate(cuts):
                d = d.join(F.broadcast(cut.withColumnRenamed("_n", f"_n{i}")), F.col("_name").eqNullSafe(F.col(f"_n{i}")), "left")  # a row per source
            return d

        def cut(d: DataFrame, level: str, done: Column, names: tuple[str, str]) -> DataFrame:
            """(_n, bin, words before it): where the sum over the bins of a level reaches the need; BINS rows a source at most."""
            w = Window.partitionBy("_name").orderBy(level)
            sums = d.groupBy("_name", "_need", done.alias("_done"), level).agg(F.sum("size").alias("s")).withColumn("upto", F.col("_done") + F.sum("s").over(w))
            at = F.min_by(F.struct(level, (F.col("upto") - F.col("s")).alias("before")), level).alias("x")
            return written(sums.filter("upto >= _need").groupBy("_name").agg(at).select(F.col("_name").alias("_n"), F.col(f"x.{level}").alias(names[0]), F.col("x.before").alias(names[1])), "cut")

        d = ranked(small)
        one = cut(d.filter("_q is not null"), "_b1", F.lit(0).cast("long"), ("_c1", "_w1"))
        d = with_cuts(d, one)
        two = cut(d.filter("_b1 = _c1"), "_b2", F.col("_w1"), ("_c2", "_w2"))
        d = with_cuts(ranked(small), one, two)
        # the different rows of the fine bin of the cut: taken while more than half of one fits
        at = (F.col("_b1") == F.col("_c1")) & (F.col("_b2") == F.col("_c2"))
        edge = d.filter(at).groupBy("_name", "_q", "doc_id", "size", "_u", "_need", "_w2").agg(F.count(F.lit(1)).alias("_rows"))
        order = Window.partitionBy("_name").orderBy("_q", "doc_id", "size", "_u").rowsBetween(Window.unboundedPreceding, 0)
        edge = edge.withColumn("_before", F.col("_w2") + F.sum(F.col("size") * F.col("_rows")).over(order) - F.col("size") * F.col("_rows"))
        fits = lambda k: F.col("_before") + k * F.col("size") - F.col("size") / 2 < F.col("_need")
        guess = F.ceil((F.col("_need") - F.col("_before")) / F.col("size") - 0.5)
        edge = edge.withColumn("_k", guess).withColumn("_k", F.when(fits(F.col("_k") + 1), F.col("_k") + 1).when(~fits(F.col("_k")), F.col("_k") - 1).otherwise(F.col("_k")))
        place = F.struct("_q", "doc_id", "size", "_u")
        last = edge.filter("_k > 0").groupBy("_name").agg(F.max_by(F.struct(place.alias("at"), F.least("_k", "_rows").alias("k"), F.col("_rows").alias("n")), place).alias("_last"))
        last = written(last.select(F.col("_name").alias("_n"), F.col("_last.at").alias("_last"), F.col("_last.k").alias("_k"), (F.col("_last.k") < F.col("_last.n")).alias("_part")), "cut")
        split = not last.filter("_part").isEmpty()
        kept += [one, two, last] if keep else [small, one, two, last]
    d = with_cuts(ranked(base if keep else small), one, two, last)
    extra = F.when(F.col("_q").isNull(), 0).when(F.col("_c1").isNull() | (F.col("_b1") < F.col("_c1")), 1).when(F.col("_b1") > F.col("_c1"), 0)
    extra = extra.when(F.col("_c2").isNull() | (F.col("_b2") < F.col("_c2")), 1).when(F.col("_b2") > F.col("_c2"), 0).otherwise(F.coalesce(place <= F.col("_last"), F.lit(False)).cast("int"))
    tied = F.coalesce(at & F.col("_part") & (place == F.col("_last")), F.lit(False))
    rows = (d.filter(~tied) if split else d).withColumn("_extra", extra)
    if split:
        rows = rows.select("doc_id", "size", "source_size", "target", "_whole", "_extra", *keep).unionByName(_some_of(d.filter(tied), keep))
    copies = F.least(F.col("_whole") + F.col("_extra"), F.lit(max_repeats))
    return rows.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.cast("int").alias("copies"), *keep)


def _some_of(tied: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Rows that are alike in all that ranks them, the first ``_k`` of each source with ``_extra`` 1.

    They are counted, not gathered, and made again from their counts, in stretches over many tasks.
    """
    same = ("_name", "doc_id", "size", "source_size", "target", "_whole", "_k")
    kinds = tied.groupBy(*same, (F.to_json(F.struct(*keep)) if keep else F.lit("")).alias("_kind")).agg(F.count(F.lit(1)).alias("n"), *[F.any_value(c).alias(c) for c in keep])
    before = F.sum("n").over(Window.partitionBy("_name").orderBy("_kind").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    one = F.greatest(F.lit(0), F.least(F.col("n"), F.col("_k") - before))
    kinds = kinds.withColumn("_one", one).withColumn("_e", F.explode(F.array(F.struct(F.lit(1).alias("e"), F.col("_one").alias("n")), F.struct(F.lit(0).alias("e"), (F.col("n") - F.col("_one")).alias("n"))))).filter("_e.n > 0")
    size = 4096
    parts = int(tied.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = kinds.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_e.n") - 1, F.lit(size).cast("long")))).repartition(parts)
    rows = runs.withColumn("_i", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + size, F.col("_e.n")) - 1)))
    return rows.select("doc_id", "size", "source_size", "target", "_whole", F.col("_e.e").alias("_extra"), *keep)


SQL = """
WITH d AS (
  SELECT doc_id, source, md5('mix' || coalesce(CAST(doc_id AS VARCHAR), 'null') || coalesce(text, '')) AS m, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
x AS (SELECT *, CAST(floor(sqrt(size)) AS BIGINT) + 1 AS root FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size * root) AS BIGINT) AS r FROM x GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s),
w AS (SELECT *, CAST(CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM n),
o AS (SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, k) AS pos FROM w),
l AS (SELECT *, sum(source_size) OVER () AS total,
        sum(3 * source_size) OVER (ORDER BY pos) - 3 * source_size AS capped,
        sum(weight) OVER () - (sum(weight) OVER (ORDER BY pos) - weight) AS rest FROM o),
v AS (SELECT *, CAST(total - capped AS DOUBLE) / rest AS level FROM l),
f AS (SELECT *, min(CASE WHEN 3 * source_size >= level * weight THEN pos END) OVER () AS stop FROM v),
t AS (SELECT *, CASE WHEN pos < coalesce(stop, 1e18) THEN CAST(3 * source_size AS DOUBLE)
        ELSE least(3 * source_size, max(CASE WHEN pos = stop THEN level END) OVER () * weight) END AS target FROM f),
p AS (SELECT source, source_size, r, target, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS whole FROM t),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target - whole * source_size ELSE 0 END AS need FROM p),
c AS (SELECT *, CASE WHEN r > 0 THEN need / r ELSE 0 END AS c FROM q),
u AS (SELECT x.doc_id, x.size, x.m, c.*, c.c * x.root AS p,
        (CAST(CAST('0x' || substr(x.m, 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
      FROM x JOIN c ON x.source IS NOT DISTINCT FROM c.source),
k AS (SELECT *, CASE WHEN need > 0 AND size > 0 THEN CASE WHEN p >= 1 THEN -1.0 ELSE (u * (1 - p)) / (u * (1 - p) + p * (1 - u)) END END AS rank FROM u),
y AS (SELECT *, sum(size) FILTER (rank IS NOT NULL) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id NULLS FIRST, size, m ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, size, source_size, target,
  CAST(size * least(whole + CASE WHEN rank IS NOT NULL AND upto - size / 2.0 < need THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken,
  CAST(least(whole + CASE WHEN rank IS NOT NULL AND upto - size / 2.0 < need THEN 1 ELSE 0 END, 3) AS INTEGER) AS copies
FROM y
"""
