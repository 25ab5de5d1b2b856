"""Operator 6: quality classifier by importance resampling.

Two hashed n-gram models, one of target text (documents labelled good and not
toxic) and one of the raw text (all documents), give each document the log
ratio of its probability under the two.  Documents are then drawn without
replacement by Gumbel top-k: the k largest ``sharpness * log_weight +
Gumbel noise``, with noise that depends on the id and a seed alone.

Features are counted once per document: lower-cased words, their first four
bytes, shapes of neighbouring words (case, digits, the last three bytes'
punctuation), and runs of one repeated word.  A feature's ratio is smoothed;
the weight of one within a factor of two of 1 is zero by definition, as
features that both texts use alike would add up to a bonus for length.

The raw model counts every document.  The target model uses a bounded sample
of the labels: the ``label_limit`` labels with the least hash of their id.
One half of it trains, the other half sets the cut: the log weight that
separates target from other labelled documents best.  k is the number of
documents at or above the cut, so the draw keeps as many as pass it.

Bounds: at most ``label_limit`` label rows reach the driver.  All features are
counted over all documents; those with a weight are broadcast.  With the
smoothing, a weight needs more than PSEUDO target documents, or more than
PSEUDO expected ones, so their number is at most 2 / PSEUDO times the target
documents (half of ``label_limit``) times the mean features of a document,
however large the corpus is: no limit on features is set.

Defined cases: a null or wordless text has log weight 0; null ids share one noise value; equal
ids get equal noise, and rows that tie with the k-th stay; repeated labels
count once, contradicting ones as not good; without any good label, or with
good labels alone, everything is kept; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import as_long, columns, ship, stored

U64 = np.uint64
LABEL_LIMIT = 20_000
PSEUDO = 10.0
LEAST_RATIO = float(np.log(2))
SHARPNESS = 8.0
RUNS = (3, 5, 8)

# letters to "a" (lower) or "A" (upper), digits to "9"; others stand for themselves
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 57


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each row: (hashes, bounds by row)."""
    rows = len(off) - 1
    low = K.LOWER[data]
    s, e, row = K.spans(~K.SPACE[data], off)
    letter = (low >= 97) & (low <= 122) | (low >= 128) | (low >= 48) & (low <= 57)
    ws, we, wrow = K.spans(letter, off)
    prefix = K.prefix_hash(low)
    word = K.span_hash(prefix, ws, we)
    stem = K.span_hash(prefix, ws, np.minimum(ws + 4, we)) ^ U64(0x5BD1E9955BD1E995)
    tail = _SHAPE[data]
    if len(s):
        n = e - s
        last = [np.where(n > k, tail[np.maximum(e - 1 - k, 0)], 0).astype(U64) for k in range(3)]
        shape = last[0] | last[1] << U64(8) | last[2] << U64(16)
        upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
        shape |= np.minimum(upper[e] - upper[s], 2).astype(U64) << U64(24)
        shape |= np.minimum(n, 2).astype(U64) << U64(28)
        one = K.mix(shape ^ U64(0x7F4A7C15))
        two, two_row = K.ngrams(one, row, 2)
        token = K.span_hash(prefix, s, e)
    else:
        one = two = token = np.zeros(0, U64)
        two_row = row
    parts, at = [word, stem, one, two], [wrow, wrow, row, two_row]
    for r in RUNS:  # r equal words in a row
        if len(token) >= r:
            same = row[: len(row) - r + 1] == row[r - 1 :]
            for k in range(1, r):
                same &= token[: len(token) - r + 1] == token[k : len(token) - r + 1 + k]
            hit = np.unique(row[: len(row) - r + 1][same])
            parts.append(np.full(len(hit), r, dtype=U64))
            at.append(hit)
    h, r = np.concatenate(parts), np.concatenate(at)
    order = np.argsort(r, kind="stable")
    h, r = h[order], r[order]
    bounds = np.searchsorted(r, np.arange(rows + 1))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        h[a:b].sort()
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[keep], np.concatenate([[0], np.cumsum(np.bincount(r[keep], minlength=rows))])


def _merge(parts):
    h = np.concatenate([p[0] for p in parts])
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], *(np.add.reduceat(np.concatenate([p[k] for p in parts])[order], first) if len(h) else np.zeros(0, np.int64) for k in (1, 2))


def _counts(target):
    """(feature, documents, target documents) of a partition; feature 0 counts the documents."""
    good = target.value

    def run(batches):
        parts, docs = [], [0, 0]
        for batch in batches:
            is_good = np.isin(batch.column("doc_id").to_numpy(zero_copy_only=False), good)
            for i, j, data, off in K.slices(batch.column("text")):
                h, b = features(data, off)
                g = np.repeat(is_good[i:j], np.diff(b)).astype(np.int64)
                docs[0] += j - i
                docs[1] += int(is_good[i:j].sum())
                parts.append(_merge([(h, np.ones(len(h), np.int64), g)]))
                if len(parts) >= 8:
                    parts = [_merge(parts)]
        parts.append((np.zeros(1, U64), np.array(docs[:1]), np.array(docs[1:])))
        h, n, t = _merge(parts)
        for a in range(0, len(h), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_long(h[a : a + (1 << 16)])), pa.array(n[a : a + (1 << 16)]), pa.array(t[a : a + (1 << 16)])],
                names=["feature", "docs", "good"],
            )

    return K.trimmed(run)


def _score(model, names):
    """Append the log weight to every row."""

    def run(batches):
        keys, ratios = model.value
        for batch in batches:
            out = []
            for _, _, data, off in K.slices(batch.column(batch.num_columns - 1)):
                h, b = features(data, off)
                if len(keys) and len(h):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    x = np.where(keys[at] == h, ratios[at], 0.0)
                else:
                    x = np.zeros(len(h))
                cs = np.concatenate([[0.0], np.cumsum(x)])
                out.append(np.round(cs[b[1:]] - cs[b[:-1]], 6) + 0.0)
            weight = pa.array(np.concatenate(out) if out else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], weight], names=names)

    return K.trimmed(run)


def _with_weight(docs: DataFrame, text_col: str, model) -> DataFrame:
    """All columns of docs and log_weight (a column of that name is replaced)."""
    kept = [c for c in docs.columns if c != "log_weight"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", log_weight double"
    return docs.select(*(docs[c] for c in kept), docs[text_col].cast("string").alias("scored text")).mapInArrow(
        _score(model, [*kept, "log_weight"]), schema
    )


def gumbel(id_col: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the id."""
    u = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, col: str, k: int) -> float | None:
    """The exact k-th largest value of a double column, by counting in ever finer ranges."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None or k <= 0:
        return None
    for _ in range(40):
        if lo == hi:
            return hi
        width = (hi - lo) / 4096
        if width == 0 or lo + width == lo or hi - width == hi:
            break
        slot = F.least(F.floor((F.col(col) - lo) / width), F.lit(4095))
        rows = (
            df.where(F.col(col).between(lo, hi)).groupBy(slot.alias("slot"))
            .agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).orderBy(F.desc("slot")).collect()
        )  # at most 4,096 rows
        for r in rows:
            if k <= r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            k -= r["n"]
    rows = df.where(F.col(col).between(lo, hi)).groupBy(col).count().orderBy(F.desc(col)).collect()
    for r in rows:
        if k <= r["count"]:
            return r[0]
        k -= r["count"]
    return lo


def importance_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_limit: int = LABEL_LIMIT,
):
    """(feature keys, log ratios, cut, good ids) fitted on all documents and a bounded sample of labels."""
    spark = ship(docs.sparkSession)
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min(F.expr("quality = 1 and coalesce(toxic, 0) = 0")).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(label_limit)
        .toPandas()
    )
    ids, good = known["doc_id"].to_numpy(dtype=np.int64), known["good"].to_numpy(dtype=bool)
    train = np.arange(len(ids)) % 2 == 0
    target = spark.sparkContext.broadcast(np.sort(ids[train & good]))
    texts = columns(docs, doc_id=id_col, text=text_col).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), "text")
    counts = texts.mapInArrow(_counts(target), "feature long, docs long, good long")
    counts = stored(counts.groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("good").alias("good")), "op6-counts")
    total = counts.where("feature = 0").first()
    empty = (np.zeros(0, U64), np.zeros(0)), None
    if total is None or not total["good"] or good.all():
        return empty
    share = total["good"] / total["docs"]
    ratio = F.log((F.col("good") + PSEUDO) / (F.col("docs") * share + PSEUDO))
    told = (
        counts.where("feature <> 0").withColumn("ratio", ratio).where(F.abs("ratio") > LEAST_RATIO)
        .select("feature", "ratio").toPandas()
    )  # bounded by the label sample, see the module
    keys = told["feature"].to_numpy(dtype=np.int64).view(U64)
    order = np.argsort(keys)
    model = keys[order], told["ratio"].to_numpy(dtype=float)[order]
    # the cut that separates the other half of the labels best
    held = spark.createDataFrame(known[~train].assign(good=good[~train].astype(int)), "doc_id long, good int")
    sample = texts.join(F.broadcast(held), "doc_id")  # at most label_limit rows
    scored = _with_weight(sample, "text", spark.sparkContext.broadcast(model)).select("log_weight", "good").toPandas()
    w, g = scored["log_weight"].to_numpy(float), scored["good"].to_numpy(bool)
    if not g.any() or g.all():
        return model, None
    cuts = np.unique(w)
    kept_good = 1 - np.searchsorted(np.sort(w[g]), cuts, "left") / g.sum()
    dropped = np.searchsorted(np.sort(w[~g]), cuts, "left") / (~g).sum()
    best = np.flatnonzero(kept_good + dropped == (kept_good + dropped).max())
    return model, float(cuts[best[0]])


def importance_resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sharpness: float = SHARPNESS,
    seed: int = 0,
    **bounds: int,
) -> DataFrame:
    """The drawn rows of docs, with log_weight (see the module)."""
    spark = ship(docs.sparkSession)
    model, cut = importance_model(docs, labels, id_col, text_col, **bounds)
    scored = _with_weight(docs, text_col, spark.sparkContext.broadcast(model))
    if cut is None:
        return scored
    drawn = F.col("log_weight") * sharpness + gumbel(F.col(id_col), seed)
    keys = stored(scored.select("log_weight", drawn.alias("key")), "op6-keys")
    k = keys.where(F.col("log_weight") >= cut).count()
    least = kth_largest(keys, "key", k)
    return scored.where(F.lit(False)) if least is None else scored.where(drawn >= F.lit(least))
