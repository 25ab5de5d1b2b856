"""Operator 5: exact top-k inner-product search over norm buckets.

Candidates are dealt by descending length into buckets; each bucket is one
sorted block.  Queries are packed into blocks too, and every (query block,
bucket) pair is one row of work: a stated query set against all rows, in
blocks.  Work runs in two steps:

1. every query block meets the bucket of the longest vectors, which gives
   each query a first k-th best score;
2. every query block meets the other buckets.  Within a bucket the query's
   k-th best score and the bucket's longest vector give a local cosine
   threshold.  Above 1 the bucket cannot hold a better row.  A high threshold
   is pruned by coordinates (bounds on the candidate's share in the query's
   two largest coordinates), a low one by length (a prefix of the sorted
   block).  What is left is verified by its product.

Vectors are integer (floor(scale * x)); products are exact while
``|q| * |p| < 2**53`` (else Python integers are used).  Bounds get a margin
for rounding, and rows that could tie are never pruned.

Defined cases: vectors that are null, hold a null, NaN or infinite component,
or have another length than the query take no part; rows of the query's own
id are no candidates; ties go to the smaller id; repeated ids are separate
candidates; a null id takes no part; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import columns, ship, stored

BUCKET_ROWS = 4096
QUERY_ROWS = 256
COORDINATE_COSINE = 0.6
EXACT = float(1 << 53)
PACKED = pa.schema(
    [("dim", pa.int32()), ("n", pa.int64()), ("top", pa.float64()), ("ids", pa.binary()), ("id_list", pa.list_(pa.int64())), ("vecs", pa.binary())]
)
PACKED_SQL = "dim int, n long, top double, ids binary, id_list array<long>, vecs binary"


def _pack(rows_per_block: int):
    """(dim, block of a partition's sorted vectors): ids, components as float64."""

    def run(batches):
        held: dict[int, list] = {}

        def block(dim):
            ids, vecs = zip(*held.pop(dim), strict=True)
            m = np.array(vecs, dtype=np.float64).reshape(len(ids), dim)
            top = float(np.sqrt((m * m).sum(axis=1)).max(initial=0.0))
            return pa.RecordBatch.from_pydict(
                {"dim": [dim], "n": [len(ids)], "top": [top], "ids": [np.array(ids, "<i8").tobytes()],
                 "id_list": [list(ids)], "vecs": [m.tobytes()]},
                schema=PACKED,
            )

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                rows = held.setdefault(len(v), [])
                rows.append((i, v))
                if len(rows) >= rows_per_block:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return run


def _scores(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of q and p."""
    if np.sqrt((q * q).sum(1).max(initial=0)) * np.sqrt((p * p).sum(1).max(initial=0)) < EXACT:
        return (q @ p.T).astype(np.int64)
    big = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in p] for x in q]
    return np.array(big, dtype=object).reshape(len(q), len(p))


def _best(qid: int, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by score and then id."""
    ok = np.flatnonzero(ids != qid)
    return ok[np.lexsort((ids[ok], -score[ok]))[:k]]


def _left_over(q: np.ndarray, low: float, p: np.ndarray, norms: np.ndarray, top: float) -> np.ndarray:
    """Candidates of a sorted bucket whose product with q may reach ``low``."""
    size = float(np.sqrt(q @ q))
    if low <= 0 or size == 0:
        return np.arange(len(p))
    cosine = low / (size * top) * (1 - 1e-9) if top else 2.0
    if cosine > 1:
        return np.zeros(0, np.int64)
    # length: the block is sorted by descending length
    n = int(np.searchsorted(-norms, -(low / size) * (1 - 1e-9), "right"))
    if cosine < COORDINATE_COSINE or n == 0:
        return np.arange(n)
    need = low / (size * norms[:n]) * (1 - 1e-9)
    f = np.argsort(-np.abs(q))[:2]
    share, own = p[:n, f] / norms[:n, None], q[f] / size
    rest = np.sqrt(np.maximum(0, 1 - (share**2).sum(1))) * np.sqrt(max(0.0, 1 - float((own**2).sum())))
    return np.flatnonzero(share @ own + rest >= need - 1e-9)


def _meet(k: int):
    def run(batches):
        for batch in batches:
            out = {"query_id": [], "vec_id": [], "score": []}
            for r in batch.to_pylist():
                dim = r["dim"]
                qid, q = np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["q_vecs"]).reshape(-1, dim)
                pid, p = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["vecs"]).reshape(-1, dim)
                lows = np.frombuffer(r["lows"]) if r["lows"] is not None else np.full(len(qid), -np.inf)
                norms = np.sqrt((p * p).sum(1))
                order = np.argsort(-norms, kind="stable")
                pid, p, norms = pid[order], p[order], norms[order]
                whole = lows == -np.inf
                if whole.any():
                    all_scores = dict(zip(np.flatnonzero(whole).tolist(), _scores(q[whole], p), strict=True))
                for a in range(len(qid)):
                    if whole[a]:
                        at, score = np.arange(len(p)), all_scores[a]
                    else:
                        at = _left_over(q[a], lows[a], p, norms, r["top"])
                        if not len(at):
                            continue
                        score = _scores(q[a : a + 1], p[at])[0]
                    best = _best(qid[a], pid[at], score, k)
                    best = best[score[best] >= lows[a]]
                    out["query_id"] += [int(qid[a])] * len(best)
                    out["vec_id"] += pid[at][best].tolist()
                    out["score"] += [int(x) for x in score[best]]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    return run


def _with_lows(k: int):
    """Give each query block its queries' k-th best scores so far."""

    def run(batches):
        for batch in batches:
            lows = []
            for r in batch.to_pylist():
                kth = {x["query_id"]: x["low"] for x in r["found"] or [] if x["n"] >= k}
                lows.append(np.array([kth.get(i, -np.inf) for i in np.frombuffer(r["q_ids"], "<i8").tolist()]).tobytes())
            yield batch.select(["dim", "q_block", "q_ids", "q_vecs"]).append_column("lows", pa.array(lows, pa.binary()))

    return run


def topk_search(
    vectors: DataFrame,
    is_query: str,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k best candidates of each query: query_id, rank, vec_id, score.

    ``is_query`` is a SQL condition on the id, which it names ``id``."""
    spark = ship(vectors.sparkSession)
    vectors = columns(vectors, id=id_col, v=vector_col)
    whole = (
        vectors.withColumn("v", F.expr("transform(v, x -> cast(x as double))"))
        .where("id is not null and v is not null and size(v) > 0")
        .where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
        .select(F.col("id").cast("long").alias("id"), F.expr(f"transform(v, x -> double(floor({scale} * x)))").alias("v"))
        .withColumn("norm2", F.expr("aggregate(v, 0D, (s, x) -> s + x * x)"))
    )
    whole = stored(whole, "op5-vectors")
    total = whole.count()
    parts = max(1, -(-total // bucket_rows))
    buckets = stored(
        whole.repartitionByRange(parts, F.desc("norm2"), F.xxhash64("id")).sortWithinPartitions(F.desc("norm2"), "id")
        .select("id", "v").mapInArrow(_pack(bucket_rows), PACKED_SQL).drop("id_list"),
        "op5-buckets",
    )
    queries = whole.where(is_query)
    queries = stored(
        queries.repartition(max(1, -(-queries.count() // query_rows)), F.xxhash64("id")).select("id", "v")
        .mapInArrow(_pack(query_rows), PACKED_SQL)
        .select("dim", F.monotonically_increasing_id().alias("q_block"), F.col("ids").alias("q_ids"), "id_list", F.col("vecs").alias("q_vecs")),
        "op5-queries",
    )
    # the longest bucket of each dimension: one row each
    first = buckets.groupBy("dim").agg(F.max_by(F.xxhash64("ids"), F.struct("top", F.xxhash64("ids"))).alias("first"))
    buckets = buckets.join(first, "dim").withColumn("is_first", F.expr("xxhash64(ids) = first")).drop("first")
    tasks = max(1, parts)
    fields = ["dim", "top", "ids", "vecs", "q_ids", "q_vecs", "lows"]
    schema = "query_id long, vec_id long, score long"

    start = queries.join(buckets.where("is_first"), "dim").withColumn("lows", F.lit(None).cast("binary"))
    found1 = stored(start.select("q_block", *fields).repartition("q_block").select(*fields).mapInArrow(_meet(k), schema), "op5-first")

    low = found1.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    member = queries.select("q_block", F.explode("id_list").alias("query_id"))
    per_block = member.join(low, "query_id").groupBy("q_block").agg(F.collect_list(F.struct("query_id", "low", "n")).alias("found"))
    queries = queries.join(per_block, "q_block", "left").mapInArrow(
        _with_lows(k), "dim int, q_block long, q_ids binary, q_vecs binary, lows binary"
    )
    queries = stored(queries, "op5-lows")
    rest = queries.join(buckets.where("not is_first"), "dim")
    found2 = rest.select("q_block", *fields).repartition(tasks, "q_block", F.xxhash64("ids")).select(*fields).mapInArrow(_meet(k), schema)
    ranked = found1.unionAll(found2).selectExpr(
        "query_id", "int(row_number() over (partition by query_id order by score desc, vec_id)) as rank", "vec_id", "score"
    )
    return ranked.where(F.col("rank") <= k)
