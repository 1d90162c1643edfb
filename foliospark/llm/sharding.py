"""Sharding by weighted rendezvous hashing of stable record keys.

Each (key, shard) pair draws a uniform number from md5; the record goes to the shard with the largest
-weight / ln(u). A shard's draws don't depend on the other shards, so one more shard takes records only into itself.

Defined results. A null key counts as the empty string. Repeated keys share a shard, whatever their other columns.
Null texts have size 1 and the CRC of no bytes. Empty tables give empty results. Other columns are kept as they are,
whatever their names: the added column gets a number if its name is taken (shard_1). Slots are numbered by (bucket of
the key, key as text, CRC of the text, size); rows alike in all of these are interchangeable, and are counted before they
are shuffled, so a key that repeats without end costs one row of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm.common import by_name, free_name, fresh, quoted, table

N_SHARDS = 8
#: Ranges of keys in which slots are counted apart, so that no task holds a whole shard.
SLOT_BUCKETS = 1024


def _draw(key: Column, shard: Column) -> Column:
    """52 uniform bits of a key and a shard, as an integer."""
    text = F.concat_ws("/", key, shard.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def rendezvous(key: Column, n_shards: int, weights: list[float] | None = None) -> Column:
    """The shard, 0 to n_shards - 1, of a string key; weights: one positive number per shard."""
    if weights is not None and (len(weights) != n_shards or min(weights) <= 0):
        raise ValueError("one positive weight per shard")
    if weights is None or len(set(weights)) == 1:  # the order of -w / ln(u) is that of u
        scored = [F.struct(_draw(key, F.lit(s)).alias("score"), F.lit(-s).alias("shard")) for s in range(n_shards)]
    else:
        u = [(_draw(key, F.lit(s)) + 0.5) / float(1 << 52) for s in range(n_shards)]
        scored = [F.struct((F.lit(-float(w)) / F.log(x)).alias("score"), F.lit(-s).alias("shard")) for s, (w, x) in enumerate(zip(weights, u, strict=True))]
    return -(F.greatest(*scored) if n_shards > 1 else scored[0])["shard"]


def shard_key(df: DataFrame, key: str) -> Column:
    return F.coalesce(by_name(df, key).cast("string"), F.lit(""))


def assign_shards(df: DataFrame, key: str = "doc_id", n_shards: int = N_SHARDS, weights: list[float] | None = None, into: str = "shard") -> DataFrame:
    """df with its shard, in a column `into` or, if df has one, the first free of `into`_1, ...: no shuffle."""
    return df.withColumn(free_name(df, into), rendezvous(shard_key(df, key), n_shards, weights))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", n_shards: int = N_SHARDS, weights: list[float] | None = None, tasks_per_shard: int = 16) -> None:
    """One folder of Parquet files per shard, shard=N (or shard_1=N, if df has a shard); each shard is written by several tasks.

    Rows are dealt to the tasks of a shard by a hash of their key and, as one key may hold many rows, of the partition
    that they come from.
    """
    part, shard = fresh(df, base="part"), free_name(df, "shard")
    spread = F.pmod(F.xxhash64(shard_key(df, key), F.spark_partition_id()), F.lit(tasks_per_shard))
    dealt = assign_shards(df, key, n_shards, weights).withColumn(part, spread)
    dealt.repartition(n_shards * tasks_per_shard, shard, part).drop(part).write.partitionBy(shard).parquet(path)


#: Slots of equal rows that one row of a number table makes at a time.
SLOT_RUN = 10_000


def number_slots(dealt: DataFrame, shard: str, key: str, ties: list[str], buckets: int = SLOT_BUCKETS, into: str = "slot") -> DataFrame:
    """dealt, which has no map columns, with gapless numbers from 0 in each shard.

    Equal rows are counted before the shuffle; a window over (shard, bucket of the key) numbers what is left, shifted by
    the counts of the buckets before: a table of at most shards x buckets rows, which is broadcast.
    """
    bucket, start, n, at = (fresh(dealt, base=b) for b in ("bucket", "start", "n", "at"))
    key_text = F.coalesce(by_name(dealt, key).cast("string"), F.lit(""))
    placed = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit("slot/"), key_text).cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")
    names, slot = [quoted(c) for c in dealt.columns], free_name(dealt, into)
    own = quoted(shard)
    found = dealt.withColumn(bucket, placed).groupBy(*names, bucket).agg(F.count(F.lit(1)).alias(n))
    counts = found.groupBy(own, bucket).agg(F.sum(n).alias(n))
    shift = Window.partitionBy(own).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(own).alias(f"{start}s"), F.col(bucket).alias(f"{bucket}s"), F.coalesce(F.sum(n).over(shift), F.lit(0)).alias(start))
    key_text = F.coalesce(F.col(quoted(key)).cast("string"), F.lit(""))
    before = Window.partitionBy(own, bucket).orderBy(key_text, *[quoted(t) for t in ties], *names).rowsBetween(Window.unboundedPreceding, -1)
    numbered = found.withColumn(at, F.coalesce(F.sum(n).over(before), F.lit(0)))
    met = numbered.join(F.broadcast(starts), F.col(own).eqNullSafe(F.col(f"{start}s")) & (F.col(bucket) == F.col(f"{bucket}s")))
    # first the starts of runs, then the numbers of each run: no array is longer than a run, or than the runs of a row
    runs = met.select(*names, (F.col(at) + F.col(start)).alias(at), n, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(SLOT_RUN).cast("long"))).alias(bucket))
    every = runs.select(*names, at, F.explode(F.sequence(F.col(bucket), F.least(F.col(bucket) + (SLOT_RUN - 1), F.col(n) - 1))).alias(n))
    return every.select(*names, (F.col(at) + F.col(n)).alias(slot))


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit("")).cast("binary")
    key = shard_key(docs, "doc_id")
    dealt = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, N_SHARDS).alias("shard"),
        rendezvous(key, N_SHARDS + 1).alias("grown_shard"),
    )
    return number_slots(dealt, "shard", "doc_id", ["text_crc32", "size"])


_DRAW = "CAST('0x' || substr(md5(k || '/' || {s}), 1, 13) AS BIGINT)"
_SHARD = "list_reduce({pairs}, lambda a, b: CASE WHEN b.u > a.u THEN b ELSE a END).s"


def _sql_shard(n: int) -> str:
    pairs = "[" + ", ".join(f"{{'u': {_DRAW.format(s=s)}, 's': {s}}}" for s in range(n)) + "]"
    return _SHARD.format(pairs=pairs)


#: The bytes' CRC steps are a recursion over positions: eight shifts a byte, no table.
OP5_SQL = f"""
WITH RECURSIVE
bits(b, i, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, encode(coalesce(text, '')) AS x FROM documents),
h AS (SELECT r, hex(x) AS hx, octet_length(x) AS n FROM d),
steps(r, i, n, hx, c) AS (
  SELECT r, CAST(0 AS BIGINT), CAST(n AS BIGINT), hx, CAST(4294967295 AS BIGINT) FROM h
  UNION ALL
  SELECT r, i + least(n - i, 256), n, hx,
    list_reduce(list_prepend(c, list_transform(range(i + 1, i + least(n - i, 256) + 1), lambda j: CAST('0x' || substr(hx, CAST(2 * j - 1 AS BIGINT), 2) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[CAST(xor(a & 255, b) AS INTEGER) + 1]))
  FROM steps, crc WHERE i < n),
s AS (
  SELECT d.r, doc_id, k, CAST(h.n + 1 AS BIGINT) AS size, xor(c, 4294967295) AS text_crc32,
    {_sql_shard(N_SHARDS)} AS shard, {_sql_shard(N_SHARDS + 1)} AS grown_shard,
    CAST('0x' || substr(md5('slot/' || k), 1, 8) AS BIGINT) % {SLOT_BUCKETS} AS bucket
  FROM d JOIN h USING (r) JOIN steps USING (r) WHERE i = h.n)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(grown_shard AS INTEGER) AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, k, text_crc32, size) - 1 AS slot
FROM s
"""
