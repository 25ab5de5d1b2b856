"""Operator 11: hard-negative mining by threshold joins over a partial inverted index.

A row's score is its integer inner product with the anchor; higher first, ties
by smaller id.  An anchor's positives are its first rows of the same label.
For an anchor and a positive of score s the window is
``ceil(low * s) .. s``: the negatives are the first rows of other labels in it.

Both searches are one threshold join, "for each anchor the first k rows within
score windows", over blocks of candidates:

* Candidates are sorted by label and length and cut into blocks; anchors too.
  Pairs of an anchor block and a candidate block are chosen by numbers alone
  (labels, the longest vector against the least threshold).  Only then are
  anchor vectors sent to the candidate block, which stands once for at most
  ``SLICE`` anchor blocks and meets them one at a time.
* Within a pair, dimensions are taken by falling weight.  A candidate x is
  indexed in its leading dimensions only, up to the first k with
  ``|x[k:]| * |q| < t`` for all anchors q and thresholds t of the block: the
  dimensions left out can't reach the threshold on their own, and a candidate
  with k = 0 is not in the index at all.  Candidates sorted by falling k make
  each dimension's posting list a leading run.
* Partial scores are accumulated list by list.  Some times on the way, and at
  the end, candidates whose partial score plus product of remaining norms is
  below the threshold of every anchor are dropped.  The scores of what is left
  are completed by the dimensions that were left out.

Positives first meet the block of the longest vectors that holds their label;
the k-th best score found is the threshold for the other blocks.  Negatives
are searched in ``LEVELS``: the upper part of each window first, and lower
parts only for windows that are not full.

Scores are exact: products stay below 2**53 in floating point, and rows for
which they might not are multiplied as Python integers.

Defined cases: rows with a null id, label or vector, an empty vector, or a
null or non-finite component (before or after scaling) take no part; vectors of
another length are no candidates of an anchor; repeated ids are separate rows,
anchors and candidates; scores beyond 2**63 - 1 either way count as that;
a positive with a negative score has an empty window; labels are compared as
text by a 64-bit hash; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import columns, ship, stored

BLOCK_ROWS = 4096
ANCHOR_ROWS = 256
SLICE = 64
STEPS = 4
LEVELS = (0.25, 0.5, 1.0)
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
BLOCK = "dim int, lab_lo long, lab_hi long, top double, least double, n long, keys binary, ids binary, labs binary, vecs binary, windows binary"
FIELDS = [
    ("dim", pa.int32()), ("lab_lo", pa.int64()), ("lab_hi", pa.int64()), ("top", pa.float64()), ("least", pa.float64()), ("n", pa.int64()),
    ("keys", pa.binary()), ("ids", pa.binary()), ("labs", pa.binary()), ("vecs", pa.binary()), ("windows", pa.binary()),
]


def _per_length(low: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Least length of a vector that can reach ``low`` with vectors of these lengths, less a margin."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(norms > 0, low / norms * (1 - 1e-9), np.inf)
    return np.where(low <= 0, -np.inf, out)


def _pack(rows_per_block: int):
    """Blocks of a partition's sorted rows; ``windows`` holds (row, window, lo, hi) of each window."""

    def run(batches):
        held: list = []

        def block():
            keys, ids, dims, labs, vecs, windows = zip(*held, strict=True)
            m = np.array(vecs, dtype=np.float64)
            norms = np.sqrt((m * m).sum(1))
            low = np.array([min((w["lo"] for w in ws), default=LONG) for ws in windows], dtype=np.float64)
            flat = [(i, w["w"], w["lo"], w["hi"]) for i, ws in enumerate(windows) for w in ws]
            held.clear()
            raw = [np.array(x, "<i8").tobytes() for x in (keys, ids, labs)]
            values = [dims[0], min(labs), max(labs), norms.max(), _per_length(low, norms).min(), len(keys), *raw, m.tobytes(), np.array(flat, "<i8").tobytes()]
            return pa.RecordBatch.from_pydict({f: [v] for (f, _), v in zip(FIELDS, values, strict=True)}, schema=pa.schema(FIELDS))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "dim", "lab", "v", "windows")), strict=True):
                if held and held[-1][2] != row[2]:
                    yield block()
                held.append(row)
                if len(held) >= rows_per_block:
                    yield block()
        if held:
            yield block()

    return run


class Index:
    """A block of candidates, its dimensions by falling weight."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labs: np.ndarray, x: np.ndarray):
        self.ids, self.keys, self.labs = ids, keys, labs
        self.order = np.argsort(-(x * x).sum(0), kind="stable")
        self.x = x[:, self.order]
        self.rest = _rest(self.x)  # rest[:, k] = |x[k:]|

    def scores(self, q: np.ndarray, low: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores by anchor and place) of all candidates that reach ``low`` of any anchor.

        Other entries of the scores may be any value below their threshold."""
        q = q[:, self.order]
        dims, q_rest = q.shape[1], _rest(q)
        most = low - np.abs(low) * 1e-9  # with a margin for rounding
        least = _per_length(low, q_rest[:, 0]).min()
        depth = (self.rest[:, :dims] >= least).sum(1)  # indexed dimensions of each candidate
        at = np.argsort(-depth, kind="stable")
        at = at[: np.count_nonzero(depth)]
        depth = depth[at]
        x = self.x[at]
        partial = np.zeros((len(q), len(at)))
        edges = np.unique(np.linspace(0, dims, steps + 1).astype(int))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            n = int(np.searchsorted(-depth, -a, "left"))  # posting lists from here on are leading runs of n and less
            listed = x[:n, a:b] * (np.arange(a, b) < depth[:n, None])
            partial[:, :n] += q[:, a:b] @ listed.T
            done = np.minimum(depth, b)
            bound = partial + q_rest[:, done] * self.rest[at, done]
            alive = (bound >= most[:, None]).any(0)
            if not alive.all():
                at, depth, x, partial = at[alive], depth[alive], x[alive], partial[:, alive]
        left_out = x * (np.arange(dims) >= depth[:, None])
        return at, partial + q @ left_out.T


def _rest(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), x.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])
    return out


def _clamped(x: list[float], y: list[float]) -> int:
    return max(-LONG, min(LONG, sum(int(a) * int(b) for a, b in zip(x, y, strict=True))))


def first_in_windows(ids, score, windows, k) -> Iterator[tuple[int, np.ndarray]]:
    """(window, places of its first k) for the windows (number, lo, hi) over scores of one anchor."""
    order = np.lexsort((ids, -score))
    falling = -score[order]
    for w, lo, hi in windows:
        a = int(np.searchsorted(falling, -hi, "left")) if hi < LONG else 0
        b = int(np.searchsorted(falling, -lo, "right"))
        yield w, order[a : min(b, a + k)]


def _meet(same: bool, k: int):
    """Rows (key, w, found_key, found_id, score): the first k of each window within each candidate block."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "w", "found_key", "found_id", "score")])

    def pairs(r, index):
        keys, labs = np.frombuffer(r["keys"], "<i8"), np.frombuffer(r["labs"], "<i8")
        q = np.frombuffer(r["vecs"]).reshape(len(keys), -1)
        windows = np.frombuffer(r["windows"], "<i8").reshape(-1, 4)
        rows, first = np.unique(windows[:, 0], return_index=True)
        low = np.minimum.reduceat(windows[:, 2], first).astype(np.float64)
        q_norms, norms = np.sqrt((q * q).sum(1)), index.rest[:, 0]
        large = norms * q_norms.max(initial=0) >= EXACT  # multiplied as integers, the others by the index
        small = np.flatnonzero(~large)
        part = index if len(small) == len(large) else Index(index.ids[small], index.keys[small], index.labs[small], _unordered(index)[small])
        at, scores = part.scores(q[rows], low) if len(part.ids) else (np.zeros(0, int), np.zeros((len(rows), 0)))
        at = small[at]
        big = np.flatnonzero(large)
        whole = _unordered(index)[big].tolist() if len(big) else []
        for i, r0 in enumerate(rows.tolist()):
            score, place = scores[i], at
            ok = (score >= low[i]) & (index.keys[place] != keys[r0]) & ((index.labs[place] == labs[r0]) == same)
            score, place = score[ok].astype(np.int64), place[ok]
            if len(big):
                exact = [_clamped(q[r0].tolist(), y) for y in whole]
                ok = (index.keys[big] != keys[r0]) & ((index.labs[big] == labs[r0]) == same)
                score = np.concatenate([score, np.array(exact, np.int64)[ok]])
                place = np.concatenate([place, big[ok]])
            if not len(place):
                continue
            mine = windows[first[i] : first[i + 1] if i + 1 < len(first) else None]
            for w, best in first_in_windows(index.ids[place], score, mine[:, 1:].tolist(), k):
                for b in best.tolist():
                    p = place[b]
                    yield int(keys[r0]), w, int(index.keys[p]), int(index.ids[p]), int(score[b])

    def run(batches):
        index, held = None, None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if r["kind"] == 0:
                    raw = [np.frombuffer(r[c], "<i8") for c in ("ids", "keys", "labs")]
                    index, held = Index(*raw, np.frombuffer(r["vecs"]).reshape(len(raw[0]), -1)), (r["block"], r["slice"])
                elif held == (r["block"], r["slice"]):
                    out.extend(pairs(r, index))
                else:
                    raise RuntimeError("an anchor block came before its candidates")
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 5, schema=schema)

    return run


def _unordered(index: Index) -> np.ndarray:
    out = np.empty_like(index.x)
    out[:, index.order] = index.x
    return out


class Blocks:
    """Stored blocks of candidates; ``meta`` has their numbers only."""

    def __init__(self, rows: DataFrame, block_rows: int):
        total = rows.count()
        self.parts = max(1, -(-total // block_rows))
        empty = F.expr("cast(array() as array<struct<w:int,lo:bigint,hi:bigint>>)")
        packed = (
            rows.withColumn("windows", empty).repartitionByRange(self.parts, "dim", "lab", F.desc("norm2"), "key")
            .sortWithinPartitions("dim", "lab", F.desc("norm2"), "key")
            .select("key", "id", "dim", "lab", "v", "windows").mapInArrow(_pack(block_rows), BLOCK)
        )
        self.rows = stored(packed.withColumn("block", F.monotonically_increasing_id()), "op11-blocks")
        self.buckets = max(1, self.parts // 16)
        self.meta = self.rows.select("block", "dim", "lab_lo", "lab_hi", "top").withColumn(
            "bucket", F.expr(f"pmod(xxhash64(block), {self.buckets})")
        )


def _anchor_blocks(anchors: DataFrame, anchor_rows: int) -> DataFrame:
    """Anchors (key, id, dim, lab, v, windows) in blocks of their own."""
    parts = max(1, -(-anchors.count() // anchor_rows))
    packed = (
        anchors.repartitionByRange(parts, "dim", "lab", "key").sortWithinPartitions("dim", "lab", "key")
        .select("key", "id", "dim", "lab", "v", "windows").mapInArrow(_pack(anchor_rows), BLOCK)
    )
    return stored(packed.withColumn("a_block", F.monotonically_increasing_id()), "op11-anchors")


def _pairs(anchors: DataFrame, blocks: Blocks, same: bool) -> DataFrame:
    """(a_block, block, top) of the pairs that labels and norms allow: numbers only."""
    a = anchors.selectExpr("a_block", "dim as a_dim", "lab_lo as a_lo", "lab_hi as a_hi", "least", f"explode(sequence(0, {blocks.buckets - 1})) as bucket")
    if same:
        labels = (F.col("a_lo") <= F.col("lab_hi")) & (F.col("lab_lo") <= F.col("a_hi"))
    else:
        labels = ~((F.col("a_lo") == F.col("a_hi")) & (F.col("lab_lo") == F.col("lab_hi")) & (F.col("a_lo") == F.col("lab_lo")))
    near = (F.col("a_dim") == F.col("dim")) & labels & (F.col("top") >= F.col("least"))
    return a.join(blocks.meta, "bucket").where(near).select("a_block", "block", "top")


def _search(anchors: DataFrame, pairs: DataFrame, blocks: Blocks, same: bool, k: int) -> DataFrame:
    """The first k rows of each window in each block of ``pairs``."""
    slices = max(1, -(-anchors.count() // SLICE))
    pairs = stored(pairs.select("a_block", "block", F.expr(f"pmod(xxhash64(a_block), {slices})").alias("slice")), "op11-pairs")
    payload = ["dim", "keys", "ids", "labs", "vecs", "windows"]
    sent = anchors.select("a_block", *payload).join(pairs, "a_block").select("block", "slice", F.lit(1).alias("kind"), "a_block", *payload)
    home = blocks.rows.select("block", *payload).join(pairs.select("block", "slice").distinct(), "block")
    home = home.select("block", "slice", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("a_block"), *payload)
    tasks = blocks.parts * slices
    work = home.unionAll(sent).repartition(tasks, "block", "slice").sortWithinPartitions("block", "slice", "kind", "a_block")
    return stored(work.mapInArrow(_meet(same, k), "key long, w long, found_key long, found_id long, score long"), "op11-found")


def _first(found: DataFrame, k: int) -> DataFrame:
    ranked = found.withColumn("rank", F.expr("row_number() over (partition by key, w order by score desc, found_id, found_key)"))
    return ranked.where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: str,
    positives: int = 5,
    negatives: int = 5,
    low: tuple[int, int] = (80, 100),
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
    levels: tuple[float, ...] = LEVELS,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a SQL condition on the id, which it names ``id``; ``low``
    is the least share of the positive's score as a fraction."""
    num, den = low
    spark = ship(vectors.sparkSession)
    rows = columns(vectors, id=id_col, v=vector_col, label=label_col)
    rows = (
        rows.withColumn("v", F.expr("transform(v, x -> cast(x as double))"))
        .where("id is not null and label is not null and v is not null and size(v) > 0")
        .where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
        .withColumn("v", F.expr(f"transform(v, x -> if(abs({scale} * x) < 9e15D, double(floor({scale} * x)), {scale} * x))"))
        .where("forall(v, x -> abs(x) < double('infinity'))")
        .selectExpr(
            "cast(id as long) as id", "xxhash64(cast(label as string)) as lab", "size(v) as dim", "v",
            "aggregate(v, 0D, (s, x) -> s + x * x) as norm2", "monotonically_increasing_id() as key",
        )
    )
    rows = stored(rows, "op11-rows")
    blocks = Blocks(rows, block_rows)
    anchors = rows.where(is_anchor).select("key", "id", "dim", "lab", "v")
    schema = "array<struct<w:int,lo:bigint,hi:bigint>>"

    # positives: the block of the longest vectors first, then all others from the k-th best score on
    def open_from(low):
        return F.array(F.struct(F.lit(0).alias("w"), low.alias("lo"), F.lit(LONG).alias("hi")))

    packed = _anchor_blocks(anchors.withColumn("windows", open_from(F.lit(-LONG))), anchor_rows)
    all_pairs = stored(_pairs(packed, blocks, True), "op11-same")
    start = all_pairs.groupBy("a_block").agg(F.max_by("block", F.struct("top", "block")).alias("block"))
    found = _first(_search(packed, start, blocks, True, positives), positives).drop("rank")
    kth = found.groupBy("key").agg(F.min("score").alias("low"), F.count("*").alias("n")).where(f"n >= {positives}").select("key", "low")
    again = anchors.join(kth, "key", "left").withColumn("windows", open_from(F.coalesce("low", F.lit(-LONG))))
    again = _anchor_blocks(again, anchor_rows)
    more = stored(_pairs(again, blocks, True), "op11-same")
    if more.count() > start.count():  # the first block is met once more, its rows are the same
        found2 = _search(again, more, blocks, True, positives)
        found = found.unionAll(found2).distinct()
    best = stored(_first(found, positives).select("key", "rank", "found_id", "score"), "op11-positives")

    # negatives: from the upper part of each window down, until it is full
    windows = best.select("key", F.col("rank").alias("w"), F.col("score").alias("top"), F.expr(f"cast(ceil(cast(score as decimal(20,0)) * {num} / {den}) as long)").alias("floor"))
    windows = windows.where("floor <= top")
    hits, left = None, windows.withColumn("hi", F.col("top"))
    for level in levels:
        lo = "floor" if level == levels[-1] else f"greatest(floor, least(hi, top - bigint(floor((top - floor) * {level}D))))"
        left = stored(left.withColumn("lo", F.expr(lo)), "op11-windows")
        if left.isEmpty():
            break
        spec = left.where("lo <= hi").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("w", "lo", "hi"))).cast(schema).alias("windows"))
        packed = _anchor_blocks(anchors.join(spec, "key"), anchor_rows)
        now = _first(_search(packed, _pairs(packed, blocks, False), blocks, False, negatives), negatives).drop("rank")
        hits = stored(now if hits is None else hits.unionAll(now), "op11-hits")
        full = hits.groupBy("key", "w").agg(F.count("*").alias("n")).where(f"n >= {negatives}").drop("n")
        left = left.where("lo > floor").join(full, ["key", "w"], "left_anti").withColumn("hi", F.col("lo") - 1).drop("lo")
    if hits is None:
        hits = spark.createDataFrame([], "key long, w long, found_key long, found_id long, score long")
    names = anchors.select("key", F.col("id").alias("anchor_id")).join(best.withColumnRenamed("rank", "w").withColumnRenamed("score", "positive_score"), "key")
    return _first(hits, negatives).join(names.withColumnRenamed("found_id", "positive_id"), ["key", "w"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
