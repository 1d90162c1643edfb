"""Exact top-k by inner product: norm-sorted vectors, SVD-rotated partial sums, Cauchy-Schwarz residual bounds.

Vectors become integer vectors. Candidates are dealt out by length, longest first, and each task works through its
vectors in blocks of descending length. Queries are a table too; they come in waves of about `query_wave`, each one job
with one broadcast, whose results are written before the next, so neither the plan nor what is held grows with their
number. Within a wave they form blocks of at most `query_block`, with thresholds from the longest `seed_rows` vectors. A
block of candidates is skipped for a query if |query| * |longest| can't reach its threshold; else the first `head`
coordinates after rotation give a partial sum, and what |rest of query| * |rest of vector| can't lift to the threshold
is dropped. Survivors get their exact integer score.

Any rotation gives the same results; that of the vectors' singular directions makes the first coordinates carry most of
the length. It comes from the sums of products over all vectors.

Defined results. Vectors that are null, or hold a null or non-finite component, take no part. Vectors of different
lengths are compared as if filled up with zeros; an empty one scores 0. Ties go to the smaller id. A repeated vec_id: its
query is asked once (of the smallest vector), every row with another id is a candidate. A null id takes no part. Fewer
candidates than k: all of them. Scores beyond a long are cut to its ends. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm.common import by_name, materialize, materialize_all, table

K = 5
QUERY_STRIDE = 50
#: Queries broadcast at a time, and compared at a time, candidates in a block, and longest vectors that give the first thresholds.
QUERY_WAVE = 32_768
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 2048
SEED_ROWS = 4096
#: Share of the squared length that the head coordinates carry at least, on average.
HEAD_SHARE = 0.7
#: Above this a double can't hold products exactly, and Python's integers take over.
EXACT = float(1 << 53)
LEAST_SCORE = -float(1 << 63)
#: Share of a block's pairs that survive from which all its products are cheaper than picking out pairs.
DENSE = 1 / 8


def integer_vectors(df: DataFrame, key: str, vector: str, scale: float = 256.0) -> DataFrame:
    """id, v (array<double> of whole numbers), norm2, longest first within partitions of equal size; ids are not null."""
    x = by_name(df, vector).cast("array<double>")
    whole = df.select(by_name(df, key).cast("long").alias("id"), x.alias("x")).where(F.col("id").isNotNull())
    good = F.coalesce(F.col("x").isNotNull() & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))
    floor = F.transform("x", lambda c: _whole(c * scale))
    return whole.where(good).select("id", floor.alias("v")).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))


def _whole(c: Column) -> Column:
    """floor as a double, whatever its size."""
    return F.when(F.abs(c) < EXACT, F.floor(c).cast("double")).otherwise(c)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list array, filled up with zeros."""
    lengths = np.asarray(vectors.value_lengths())
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    at = np.concatenate(([0], np.cumsum(lengths)))
    for i in range(len(lengths)):
        out[i, : lengths[i]] = flat[at[i] : at[i + 1]]
    return out


def rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Orthogonal directions, strongest first, from the sums of products over all vectors: dim squared numbers."""

    def sums(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            m = _matrix(batch.column(0), dim)
            with np.errstate(over="ignore", invalid="ignore"):
                total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["at", "total"])

    rows = vectors.select("v").mapInArrow(sums, "at long, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    gram = np.zeros(dim * dim)
    for r in rows:
        gram[r["at"]] = r["total"]
    if not np.isfinite(gram).all() or not gram.any():
        return np.eye(dim)
    _, _, directions = np.linalg.svd(gram.reshape(dim, dim))
    return directions.T


class Queries:
    """A block of queries: exact and rotated vectors, residual lengths, thresholds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, head: int, seeds: np.ndarray, seed_ids: np.ndarray, k: int):
        self.ids, self.vectors, self.k, self.head, self.turn = ids, vectors, k, head, turn
        with np.errstate(over="ignore", invalid="ignore"):
            rotated = vectors @ turn
            self.top, self.rest = rotated[:, :head], np.sqrt((rotated[:, head:] ** 2).sum(1))
            self.norm = np.sqrt((vectors**2).sum(1))
            self.least = np.full(len(ids), -np.inf)
            if len(seeds) > k:
                scores = vectors @ seeds.T
                scores[ids[:, None] == seed_ids[None, :]] = -np.inf
                self.least = np.clip(np.partition(scores, -k, axis=1)[:, -k], -np.inf, float(1 << 63))


def _bound(queries: np.ndarray, candidates: np.ndarray) -> float:
    """No sum of products of a row with a row, nor a part of it, is larger."""
    return float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with rows."""
    if not len(queries):
        return np.zeros(0, dtype=np.int64)
    if _bound(queries, candidates) < EXACT:
        return np.einsum("ij,ij->i", queries, candidates).astype(np.int64)
    most = (1 << 63) - 1
    return np.array([max(-most - 1, min(most, sum(int(a) * int(b) for a, b in zip(q, c, strict=True)))) for q, c in zip(queries, candidates, strict=True)], dtype=np.int64)


class Candidates:
    """A block of candidates: exact and rotated vectors, lengths and residual lengths."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, head: int):
        self.ids, self.vectors = ids, vectors
        with np.errstate(over="ignore", invalid="ignore"):
            self.norms = np.sqrt((vectors**2).sum(1))
            rotated = vectors @ turn
            self.top, self.rest = rotated[:, :head], np.sqrt((rotated[:, head:] ** 2).sum(1))


def best_of(block: Queries, found: Candidates, best: dict[int, list[tuple[int, int]]], least: np.ndarray) -> None:
    """Work a block of candidates into best: of each query row, its (score, -id) so far; least: the scores to reach."""
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 1 + 1e-9
        # what isn't below stays: so does anything beyond doubles
        alive = np.flatnonzero(~(block.norm * found.norms.max() * slack + 1 < least))
        if not len(alive):
            return
        reach = block.top[alive] @ found.top.T
        reach += block.rest[alive][:, None] * found.rest[None, :]
        reach += 1e-9 * block.norm[alive][:, None] * found.norms[None, :] + 1
        q, c = np.nonzero(~(np.maximum(reach, LEAST_SCORE) < least[alive][:, None]))
    dense = len(q) > DENSE * reach.size and _bound(block.vectors, found.vectors) < EXACT
    at, q = q, alive[q]
    scores = (block.vectors[alive] @ found.vectors.T)[at, c].astype(np.int64) if dense else _scores(block.vectors[q], found.vectors[c])
    near = (block.ids[q] != found.ids[c]) & (scores >= least[q])
    q, c, scores = q[near], c[near], scores[near]
    order = np.lexsort((found.ids[c], -scores, q))
    q, c, scores = q[order], c[order], scores[order]
    first = np.searchsorted(q, q, side="left")
    near = np.arange(len(q)) - first < block.k
    for row, score, name in zip(q[near].tolist(), scores[near].tolist(), found.ids[c[near]].tolist(), strict=True):
        best.setdefault(row, []).append((score, -name))
    for row in set(q[near].tolist()):
        best[row] = sorted(best[row], reverse=True)[: block.k]
        if len(best[row]) == block.k:
            least[row] = max(least[row], best[row][-1][0])


def _search(broadcast, dim: int, candidate_block: int):
    def search(batches):
        blocks = broadcast.value
        best: list[dict[int, list[tuple[int, int]]]] = [{} for _ in blocks]
        least = [b.least.copy() for b in blocks]
        for batch in batches:
            ids, vectors = np.asarray(batch.column(0)), _matrix(batch.column(1), dim)
            for at in range(0, len(ids), candidate_block):
                found = Candidates(ids[at : at + candidate_block], vectors[at : at + candidate_block], blocks[0].turn, blocks[0].head)
                for k, block in enumerate(blocks):
                    best_of(block, found, best[k], least[k])
        rows = [(int(block.ids[q]), -name, score) for block, own in zip(blocks, best, strict=True) for q, met in own.items() for score, name in met]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    return search


def _head(rotated: np.ndarray) -> int:
    """How many coordinates carry HEAD_SHARE of the squared length."""
    with np.errstate(over="ignore", invalid="ignore"):
        turned = rotated**2
        shares = np.nan_to_num(np.cumsum(turned.sum(0)) / max(1e-300, turned.sum()), nan=1.0)
    return int(min(rotated.shape[1], max(1, np.searchsorted(shares, HEAD_SHARE) + 1)))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, seed_rows: int = SEED_ROWS, scale: float = 256.0, query_wave: int = QUERY_WAVE) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query. is_query: a condition on the column `id`."""
    spark = vectors.sparkSession
    whole = materialize(integer_vectors(vectors, key, vector, scale), "vectors")
    dim = max(1, whole.agg(F.max(F.size("v"))).first()[0] or 0)
    turn = rotation(whole, dim)
    queries = materialize(whole.where(is_query).groupBy("id").agg(F.min("v").alias("v")), "queries")
    waves = max(1, -(-queries.count() // query_wave))
    # by length and then by id, so that equal vectors spread over several tasks
    dealt = whole.repartitionByRange(F.desc("norm2"), F.asc("id")).sortWithinPartitions(F.desc("norm2"), F.asc("id")).select("id", "v")
    dealt = dealt if waves == 1 else materialize(dealt, "dealt")
    seeds = whole.orderBy(F.desc("norm2"), "id").limit(seed_rows).select("id", "v").toArrow()
    seed_ids, seed_vectors = np.asarray(seeds.column("id")), _matrix(seeds.column("v").combine_chunks(), dim)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def results():
        for wave in range(waves):
            rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(waves)) == wave).orderBy("id").toArrow()
            ids, m = np.asarray(rows.column("id")), _matrix(rows.column("v").combine_chunks(), dim)
            with np.errstate(over="ignore", invalid="ignore"):
                head = _head(m @ turn)
            blocks = [Queries(ids[at : at + query_block], m[at : at + query_block], turn, head, seed_vectors, seed_ids, k) for at in range(0, max(1, len(ids)), query_block)]
            held = spark.sparkContext.broadcast(blocks)
            found = dealt.mapInArrow(_search(held, dim, candidate_block), "query_id long, vec_id long, score long")
            yield found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
            if waves > 1:
                held.destroy()

    return materialize_all(results(), "topk") if waves > 1 else next(results())


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % QUERY_STRIDE == 0)


OP2_SQL = f"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_STRIDE} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}
"""
