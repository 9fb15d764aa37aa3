"""Exact top-k search by inner product, by distributed histogram selection.

Every query is scored against every candidate. Instead of sorting or sending scores, each pass
counts them in a histogram per query; the counts of all tasks are added, the bin that holds the
k-th score is found, and the next pass counts inside that bin with finer bins, until bins are one
score wide. Where more candidates have the k-th score than places are left, the same selection
runs over their ids, so ties go to the smaller id. A last pass returns what lies at or above the
border: k rows for each query.

A task sends only the bins down to its own k-th score, which is all that can matter, so at most k
counts per query and task are shuffled. Queries come in blocks of ``query_block``; only a block's
vectors and its borders are held by the driver and sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries scored in one round of passes: 2,048 of 1,024 dimensions are 16 MB.
QUERY_BLOCK = 2048
BINS = 256
_CHUNK = 512


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers as doubles, padded with zeros to ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
    out = np.zeros((len(vectors), width))
    flat = np.asarray(vectors.flatten(), dtype=np.float64)
    inside = np.arange(width) < lengths[:, None]
    out[inside] = flat
    return out


def scaled(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component, as double; null if any component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(~bad, whole)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates, all if fewer.

    Candidates are all rows with another id. Rows without an id, and vectors that are null or hold
    a null or a non-finite component, take no part; a shorter vector counts as filled up with
    zeros. Repeated rows are candidates of their own; a repeated query row is answered once.
    Scores are exact; vectors so large that they would pass 2^53 raise an error.
    """
    spark = vectors.sparkSession
    data = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        scaled(F.col(vector_col), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    shape = data.agg(
        F.max(F.size("v")), F.max(F.sqrt(square)), F.min("id"), F.max("id")
    ).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if shape[0] is None:
        return empty
    width, reach, ids = shape[0], float(shape[1]), (shape[2], shape[3])
    if reach * reach >= 2**53:
        raise ValueError("scores of these vectors would not be exact")
    parts, after = [], None
    asking = data.where("asks").select("id", "v").distinct()
    while True:
        rest = asking if after is None else asking.where(F.col("id") > after)
        block = rest.orderBy("id").limit(query_block).toArrow()
        if not block.num_rows:
            break
        after = block["id"][-1].as_py()
        if block.num_rows == query_block:  # an id may have several vectors: take them all
            same = asking.where(F.col("id") == after).toArrow()
            block = pa.concat_tables([block.filter(pc.less(block["id"], after)), same])
        parts.append(_answer(data, block, k, width, reach, ids))
    for part in parts[1:]:
        parts[0] = parts[0].unionAll(part)
    return parts[0] if parts else empty


def _answer(data, block, k, width, reach, ids) -> DataFrame:
    sc = data.sparkSession.sparkContext
    queries = _matrix(block["v"], width)
    own = np.asarray(block["id"], dtype=np.int64)
    n = len(own)
    candidates = data.select("id", "v")

    def select(lowest: int, highest: int, value, need: np.ndarray, active: np.ndarray):
        """The need-th smallest value of each active query: (value, how many places it still has,
        how many have it). ``value``: of scores and ids, a whole number to rank by, and whether it takes part."""
        low = np.full(n, lowest, dtype=np.int64)
        span = int(highest) - int(lowest) + 1
        need, there = need.copy(), np.zeros(n, dtype=np.int64)
        while True:
            step = -(-span // BINS)
            state = sc.broadcast((queries, own, low, step, need, active))

            def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                q, own_ids, lo, wide, left, on = state.value
                sums = np.zeros((len(own_ids), BINS), dtype=np.int64)
                base = np.arange(len(own_ids))[:, None] * BINS
                for score, cand in _scores(batches, q, width):
                    rank, ok = value(score, cand)
                    place = (rank - lo[:, None]) // wide
                    ok = ok & on[:, None] & (place >= 0) & (place < BINS) & (cand != own_ids[:, None])
                    sums += np.bincount((base + place)[ok], minlength=sums.size).reshape(sums.shape)
                before = np.cumsum(sums, axis=1) - sums
                who, which = np.nonzero((sums > 0) & (before < left[:, None]))
                yield pa.record_batch(
                    [pa.array(who, pa.int64()), pa.array(which, pa.int64()), pa.array(sums[who, which], pa.int64())],
                    names=["q", "bin", "n"],
                )

            counted = candidates.mapInArrow(count, "q bigint, bin bigint, n bigint")
            got = counted.groupBy("q", "bin").agg(F.sum("n").alias("n")).toArrow()
            total = np.zeros((n, BINS), dtype=np.int64)
            total[np.asarray(got["q"]), np.asarray(got["bin"])] = np.asarray(got["n"])
            state.unpersist()
            sums = np.cumsum(total, axis=1)
            found = sums[:, -1] >= need
            at = np.where(found, np.argmax(sums >= need[:, None], axis=1), BINS - 1)
            rows = np.arange(n)
            # Too few candidates: everything counts, as if the border lay at the end.
            need = np.where(found, need - (sums[rows, at] - total[rows, at]), need)
            there = np.where(found, total[rows, at], 0)
            low = np.where(found, low + at * step, np.iinfo(np.int64).max // 4)
            active = active & found
            if step == 1:
                return low, need, there
            span = step

    bound = int(np.ceil(reach * reach)) + 1
    best, left, tied = select(
        -bound, bound, lambda s, c: (-s, True), np.full(n, k), np.ones(n, dtype=bool)
    )
    last = np.full(n, ids[1], dtype=np.int64)
    crowded = tied > left
    if crowded.any():
        border, _, _ = select(
            ids[0], ids[1], lambda s, c: (np.broadcast_to(c, s.shape), -s == best[:, None]), left, crowded
        )
        last = np.where(crowded, border, last)
    state = sc.broadcast((queries, own, best, last))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own_ids, edge, last_id = state.value
        for score, cand in _scores(batches, q, width):
            rank = -score
            tie = (rank == edge[:, None]) & (cand <= last_id[:, None])
            who, which = np.nonzero(((rank < edge[:, None]) | tie) & (cand != own_ids[:, None]))
            yield pa.record_batch(
                [
                    pa.array(who, pa.int64()),
                    pa.array(own_ids[who], pa.int64()),
                    pa.array(cand[which], pa.int64()),
                    pa.array(score[who, which], pa.int64()),
                ],
                names=["q", "query_id", "vec_id", "score"],
            )

    picked = candidates.mapInArrow(pick, "q bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return (
        picked.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)  # repeated rows of one id may share the last place
        .select("query_id", "rank", "vec_id", "score")
    )


def _scores(batches, queries: np.ndarray, width: int):
    """Scores of all queries (down) by some candidates (across), and those candidates' ids."""
    for batch in batches:
        for start in range(0, batch.num_rows, _CHUNK):
            part = batch.slice(start, _CHUNK)
            score = queries @ _matrix(part.column("v"), width).T
            yield score.astype(np.int64), np.asarray(part.column("id"), dtype=np.int64)
