"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Of a source with size s (characters), a share w of the target weights and a target total T, each document is repeated
at a mean rate of w * T / s. Its count inverts the Poisson distribution at a uniform number hashed from seed and key, so
it is the same on any cluster and after any retry. The copies are dealt out and ordered by another hash of seed, key and
copy.

Defined results. Documents of sources without a weight of their own (null among them) share `other`, pooled as one
source. A null key counts as the empty string; repeated keys are drawn alike. Null texts have size 0. A pool without
characters, or a weight of 0, gives rate 0 and no rows. Empty tables give empty results. Columns stay as they are,
whatever their names and types; an added one gets a number if its name is taken (copy_1).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import by_name, free_name, fresh, quoted, table, unit_hash

#: Weights by source; every other source, and a null one, is in the pool of OTHER.
WEIGHTS = {f"src{i}": 1.0 + (i % 4) for i in range(20)}
OTHER = 1.0
SEED = 17
#: Rates above this are drawn as the sum of several Poisson numbers of at most this mean each.
STEP = 8.0
#: Terms of the cumulative distribution for a mean of up to STEP: beyond these it is 1 in double precision.
TERMS = 64


def rates(docs: DataFrame, weights: dict[str, float], other: float, source: str = "source", text: str = "text", total: float | None = None) -> DataFrame:
    """Per pool: pool (null: all others), rate and the cumulative distribution of one step. As many rows as weights, plus one."""
    if any(not math.isfinite(w) or w < 0 for w in [*weights.values(), other]) or not sum([*weights.values(), other]):
        raise ValueError("weights must be finite, not negative, and not all 0")
    listed = F.array(*[F.struct(F.lit(k).alias("pool"), F.lit(float(w)).alias("weight")) for k, w in sorted(weights.items())], F.struct(F.lit(None).cast("string").alias("pool"), F.lit(float(other)).alias("weight")))
    named = F.array(*[F.lit(k) for k in weights]) if weights else F.array().cast("array<string>")
    own = by_name(docs, source).cast("string")
    sizes = docs.groupBy(F.when(F.array_contains(named, own), own).alias("pool")).agg(F.sum(F.coalesce(F.length(by_name(docs, text)), F.lit(0)).cast("long")).alias("size"))
    found = sizes.groupBy().agg(F.collect_list(F.struct("pool", "size")).alias("found"), F.sum("size").alias("all"))
    share = float(sum([*weights.values(), other]))
    target = F.col("all").cast("double") if total is None else F.lit(float(total))
    size = F.aggregate(F.filter("found", lambda x: x["pool"].eqNullSafe(F.col("w")["pool"])), F.lit(0).cast("long"), lambda a, x: a + x["size"])
    spread = found.select("found", "all", F.explode(listed).alias("w")).select(F.col("w")["pool"].alias("pool"), F.when(size > 0, F.col("w")["weight"] / F.lit(share) * target / size).otherwise(0.0).alias("rate"))
    spread = spread.withColumn("steps", F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int"))
    mean = F.col("rate") / F.col("steps")
    # p(0) = exp(-mean), p(n) = p(n-1) * mean / n; the sums of the first 1, 2, ... of them
    start = F.struct(F.array(F.exp(-mean)).alias("sums"), F.exp(-mean).alias("p"))
    more = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, lambda a, n: F.struct(F.concat(a["sums"], F.array(F.element_at(a["sums"], -1) + a["p"] * mean / n)).alias("sums"), (a["p"] * mean / n).alias("p")))
    return spread.select("pool", "rate", "steps", more["sums"].alias("sums"))


def replicate(docs: DataFrame, weights: dict[str, float], other: float = OTHER, seed: int = SEED, key: str = "doc_id", source: str = "source", text: str = "text", total: float | None = None, copy: str = "copy", order: str = "order_key", partitions: int | None = None) -> DataFrame:
    """Each document as often as drawn, with its copy number from 0 and order key, shuffled globally.

    The order is that of partitions and order keys. What is broadcast has as many rows as there are weights, plus one.
    """
    pool, count, copy_no, mixed = (fresh(docs, base=b) for b in ("pool", "count", "copy", "order"))
    per_pool = F.broadcast(rates(docs, weights, other, source, text, total).withColumnRenamed("pool", pool))
    named = F.array(*[F.lit(k) for k in weights]) if weights else F.array().cast("array<string>")
    own, names = by_name(docs, source).cast("string"), [quoted(c) for c in docs.columns]
    with_pool = docs.withColumn(pool, F.when(F.array_contains(named, own), own))
    joined = with_pool.alias("d").join(per_pool.alias("p"), F.col(f"d.{pool}").eqNullSafe(F.col(f"p.{pool}")))
    key_col = F.col(f"d.{quoted(key)}")
    # one number is hashed for each step; a step counts the sums that it isn't below
    numbers = F.transform(F.sequence(F.lit(1), F.col("p.steps")), lambda j: unit_hash(F.lit(seed), key_col, j))
    drawn = F.aggregate(numbers, F.lit(0), lambda a, u: a + F.size(F.filter("p.sums", lambda c: c <= u)))
    counted = joined.select(*[F.col(f"d.{c}") for c in names], drawn.alias(count)).where(F.col(count) > 0)
    copies = counted.select(*names, F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(copy_no))
    keyed = copies.withColumn(mixed, F.md5(F.concat_ws(":", F.lit(f"order/{seed}"), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")), F.col(copy_no).cast("string")).cast("binary")))
    dealt = keyed.repartition(partitions, mixed) if partitions else keyed.repartition(mixed)
    copy, order = free_name(docs, copy), free_name(docs, order)
    return dealt.sortWithinPartitions(mixed).withColumnsRenamed({copy_no: copy, mixed: order})


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return replicate(docs, WEIGHTS).select("doc_id", "source", "text", "copy", "order_key")


OP7_SQL = f"""
WITH w AS (SELECT * FROM (VALUES {", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in sorted(WEIGHTS.items()))}, (NULL, CAST({OTHER} AS DOUBLE))) t(pool, weight)),
d AS (SELECT doc_id, source, text, CASE WHEN source IN (SELECT pool FROM w WHERE pool IS NOT NULL) THEN source END AS pool FROM documents),
sizes AS (SELECT pool, sum(coalesce(length(text), 0)) AS size FROM d GROUP BY pool),
every AS (SELECT CAST(sum(size) AS DOUBLE) AS total FROM sizes),
rate AS (
  SELECT w.pool, CASE WHEN s.size > 0 THEN w.weight / CAST({float(sum([*WEIGHTS.values(), OTHER]))} AS DOUBLE) * total / s.size ELSE 0 END AS rate
  FROM w CROSS JOIN every LEFT JOIN sizes s ON w.pool IS NOT DISTINCT FROM s.pool),
steps AS (SELECT pool, greatest(1, CAST(ceil(rate / {STEP}) AS BIGINT)) AS steps, rate / greatest(1, CAST(ceil(rate / {STEP}) AS BIGINT)) AS mean FROM rate),
sums AS (
  SELECT pool, steps,
    list_reduce(list_prepend({{'sums': [exp(-mean)], 'p': exp(-mean), 'n': 0}}, list_transform(range(1, {TERMS + 1}), lambda n: {{'sums': CAST([] AS DOUBLE[]), 'p': CAST(0 AS DOUBLE), 'n': CAST(n AS INTEGER)}})),
      lambda a, b: {{'sums': list_append(a.sums, a.sums[-1] + a.p * mean / b.n), 'p': a.p * mean / b.n, 'n': b.n}}).sums AS sums
  FROM steps),
counts AS (
  SELECT doc_id, source, text,
    CAST(list_sum(list_transform(range(1, steps + 1), lambda j: len(list_filter(sums, lambda c: c <= (CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || j), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)))) AS BIGINT) AS n
  FROM d JOIN sums s ON d.pool IS NOT DISTINCT FROM s.pool)
SELECT doc_id, source, text, CAST(copy AS INTEGER) AS copy, md5('order/{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy) AS order_key
FROM (SELECT *, unnest(range(0, n)) AS copy FROM counts)
"""
