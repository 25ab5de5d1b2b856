"""Operator 10: long repeats by run-length indexes.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else.  The corpus is dealt so that equal strings meet:

1. every ``length``-byte window chooses its anchor (see ``anchors``); windows
   in a row with one anchor are a context.  Contexts are counted by hash;
   a context that occurs twice is repeated as a whole;
2. the distinct contexts of an anchor that has several of them are dealt by
   anchor to buckets (each distinct context once).  A bucket builds the Burrows-Wheeler transform
   of its contexts, keeps only its runs with the text places sampled at run
   heads and run ends, and streams matching statistics off them: at a run
   head the match with the suffix before is measured, at a run end the match
   with the suffix after, and every other place follows from the sample
   before it, one byte shorter each step.  Windows whose longest match is at
   least ``length`` are marked;
3. an anchor with more than ``hot_contexts`` distinct contexts is no bucket:
   its windows are hashed and counted one by one, which any number of tasks
   share (the same answer, at a larger shuffle);
4. marks go back to the texts by context hash and become byte spans.

Equal texts are handled once and get equal marks.  Hashes have 64 bits.

Defined cases: null text counts as empty; a text shorter than ``length``
keeps everything; equal rows and ids and null ids are kept; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .anchors import contexts
from .shared import as_long, bit_filter, columns, in_filter, ship, stored

U64 = np.uint64
LENGTH = 400
ANCHOR = 256
BUCKET_CONTEXTS = 1500
HOT_CONTEXTS = 8192
FILTER_BITS = 1 << 25


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of some strings with samples at run heads and ends."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        # symbols 1..256, and 0 after each string; the zeros differ by place
        raw = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8).astype(np.int64) + 1
        self.begin = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        raw[self.begin[1:] - 1] = 0
        n = len(raw)
        left = np.repeat(self.begin[1:] - 1, self.sizes + 1) - np.arange(n)  # bytes to the string's end
        self.left, self.text = left, raw
        suffix = self._sort(raw, left)
        before = raw[suffix - 1]  # what precedes each suffix; a string's begin has its own mark
        before[self.begin[np.searchsorted(self.begin, suffix, "right") - 1] == suffix] = 0
        head = np.ones(n, dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads = np.flatnonzero(head)
        self.runs = list(zip(before[heads].tolist(), np.diff(np.append(heads, n)).tolist(), strict=True)) if n < 1 << 16 else None
        ends = np.append(heads[1:], n) - 1
        # samples: (place of a run head, place of the suffix before it) and the same at run ends
        self.head_sample = suffix[heads], suffix[np.maximum(heads - 1, 0)], heads > 0
        self.end_sample = suffix[ends], suffix[np.minimum(ends + 1, n - 1)], ends < n - 1
        self.n_runs = len(heads)

    @staticmethod
    def _sort(raw: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Suffix array by prefix tripling; equal rests are in the order of their strings.

        Only places whose rank is shared are sorted again; a rank is the first
        place of its group in the order, so the others keep theirs."""
        n, longest = len(raw), int(left.max())
        code = (np.cumsum(np.bincount(raw, minlength=257) > 0) - 1)[raw]
        bits = max(1, int(code.max()).bit_length())
        width = 63 // bits
        padded = np.concatenate([code, np.zeros(width, np.int64)])
        key = np.zeros(n, dtype=np.int64)
        for j in range(width):
            key = key << bits | np.where(left >= j, padded[j : j + n], 0)
        order = np.argsort(key, kind="stable")
        rank, slots, key = np.empty(n, dtype=np.int64), np.arange(n), key[order]
        parts = 3 if n < 1 << 21 else 2  # ranks that fit into a key
        bits = 63 // parts
        while True:
            new = np.ones(len(key) + 1, dtype=bool)
            new[1:-1] = key[1:] != key[:-1]
            group = np.maximum.accumulate(np.where(new[:-1], slots, 0))
            rank[order[slots]] = group
            shared = ~(new[:-1] & new[1:])
            slots, group = slots[shared], group[shared]
            if not len(slots) or width > longest:
                return order
            at = order[slots]
            key = group
            for j in range(1, parts):
                ahead = np.minimum(at + j * width, n - 1)
                key = key << bits | np.where(left[at] >= j * width, rank[ahead] + 1, 0)
            again = np.argsort(key, kind="stable")
            order[slots], key = at[again], key[again]
            width *= parts

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes a and b, inside their strings."""
        if not hasattr(self, "_prefix"):
            self._prefix = np.zeros(len(self.text) + 1, dtype=U64)
            np.cumsum(self.text.astype(U64) * K.powers(K._BASE, len(self.text)), out=self._prefix[1:])
            self._back = K.powers(K._BASE_INV, len(self.text) + 1)
        low, high = np.zeros(len(a), np.int64), np.minimum(self.left[a], self.left[b])
        while (low < high).any():
            mid = (low + high + 1) >> 1
            x = (self._prefix[a + mid] - self._prefix[a]) * self._back[a]
            y = (self._prefix[b + mid] - self._prefix[b]) * self._back[b]
            low, high = np.where(x == y, mid, low), np.where(x == y, high, mid - 1)
        return low

    def matching_statistics(self) -> np.ndarray:
        """For each place, the longest match of what starts there with what starts at any other place."""
        best = np.zeros(len(self.text), dtype=np.int64)
        for at, other, ok in (self.head_sample, self.end_sample):
            measured = np.where(ok, self._common(at, np.where(ok, other, at)), 0)
            order = np.argsort(at)
            at, measured = at[order], measured[order]
            # each place follows from the last sample at or before it, one byte shorter per step
            last = np.searchsorted(at, np.arange(len(self.text)), "right") - 1
            follow = np.where(last >= 0, measured[last] - (np.arange(len(self.text)) - at[last]), 0)
            best = np.maximum(best, follow)
        return best


def _runs(flags: np.ndarray) -> list[dict]:
    """Maximal runs of marked window starts: first and last."""
    f = np.concatenate([[False], flags, [False]])
    a, b = np.flatnonzero(f[1:] & ~f[:-1]), np.flatnonzero(f[:-1] & ~f[1:]) - 1
    return [{"a": int(x), "b": int(y)} for x, y in zip(a, b, strict=True)]


RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
RANGES_SQL = "array<struct<a:int,b:int>>"


def mark_bucket(texts: list[bytes], length: int) -> list[list[dict]]:
    """For each distinct string, the ranges of window starts that also start elsewhere in the strings."""
    index = RunLengthIndex(texts)
    hit = index.matching_statistics() >= length
    return [
        _runs(hit[a : a + max(0, n - length + 1)]) for a, n in zip(index.begin[:-1].tolist(), index.sizes.tolist(), strict=True)
    ]


def _bucket(length: int):
    def run(table: pa.Table) -> pa.Table:
        texts: dict[int, bytes] = dict(zip(table.column("context").to_pylist(), table.column("bytes").to_pylist(), strict=True))
        ranges = mark_bucket(list(texts.values()), length) if len(texts) > 1 else [[] for _ in texts]
        return pa.table({"context": pa.array(list(texts), pa.int64()), "ranges": pa.array(ranges, RANGES)})

    return run


def _count(length: int, k: int):
    """(anchor, context, occurrences, windows), added up per slice."""

    def run(batches):
        for batch in batches:
            for _, _, data, off in K.slices(batch.column("text")):
                _, first, last, anchor, ctx = contexts(data, off, length, k)
                if len(ctx):
                    u, i, n = np.unique(ctx, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(as_long(anchor[i])), pa.array(as_long(u)), pa.array(n.astype(np.int64)),
                            pa.array((last[i] - first[i] + 1).astype(np.int32)),
                        ],
                        names=["anchor", "context", "n", "w"],
                    )

    return run


def _bytes(length: int, k: int, filt):
    """(anchor, context, bytes) of the wanted contexts, each once per partition."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, off in K.slices(batch.column("text")):
                _, first, last, anchor, ctx = contexts(data, off, length, k)
                raw, out = data.tobytes(), ([], [], [])
                for i in np.flatnonzero(in_filter(filt.value, ctx)).tolist():
                    if int(ctx[i]) not in seen:
                        seen.add(int(ctx[i]))
                        out[0].append(anchor[i])
                        out[1].append(ctx[i])
                        out[2].append(raw[first[i] : last[i] + length])
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(as_long(np.array(x, dtype=U64))) for x in out[:2]), pa.array(out[2], pa.binary())],
                        names=["anchor", "context", "bytes"],
                    )

    return run


def _window_hashes(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column("bytes"):
                p = K.prefix_hash(np.frombuffer(x.as_buffer(), np.uint8))
                s = np.arange(len(p) - length)
                out.append(as_long(K.span_hash(p, s, s + length)))
            yield pa.RecordBatch.from_arrays([batch.column("context"), pa.array(out, pa.list_(pa.int64()))], names=["context", "windows"])

    return run


def _key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _places(length: int, k: int, filt):
    """(text key, bytes, first window start, context) of marked contexts, each text once per partition."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, off in K.slices(batch.column("text")):
                row, first, _, _, ctx = contexts(data, off, length, k)
                hit = np.flatnonzero(in_filter(filt.value, ctx))
                if not len(hit):
                    continue
                keep, key_of = [], {}
                raw = data.tobytes()
                for r in np.unique(row[hit]).tolist():
                    key = _key(raw[off[r] : off[r + 1]])
                    if key not in seen:
                        seen.add(key)
                        key_of[r] = key
                keep = hit[np.isin(row[hit], list(key_of))]
                if len(keep):
                    r = row[keep]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key_of[x] for x in r.tolist()], pa.int64()), pa.array(off[r + 1] - off[r]),
                            pa.array(first[keep] - off[r]), pa.array(as_long(ctx[keep])),
                        ],
                        names=["text_key", "n_bytes", "first", "context"],
                    )

    return run


def _texts(filt):
    """(doc_id, text key, bytes, hash, and the text if it may have marks)."""

    def run(batches):
        for batch in batches:
            keys, sizes, shas, texts = [], [], [], []
            for t in batch.column("text"):
                raw = t.as_buffer().to_pybytes() if t.is_valid else b""
                key = _key(raw)
                marked = in_filter(filt.value, np.array([key]).view(U64))[0]
                keys.append(key)
                sizes.append(len(raw))
                shas.append(hashlib.sha256(raw).hexdigest())
                texts.append(raw if marked else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas), pa.array(texts, pa.binary())],
                names=["doc_id", "text_key", "n_bytes", "sha", "text"],
            )

    return run


def _cut(length: int):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            spans, kept, shas = [], [], []
            for text, ranges, sha in zip(*(batch.column(c) for c in ("text", "ranges", "sha")), strict=True):
                found = sorted((r["a"], r["b"] + length) for r in ranges.as_py() or [])
                merged: list[list[int]] = []
                for a, b in found:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                spans.append([{"start": a, "end": b} for a, b in merged])
                if not merged:
                    kept.append(None)
                    shas.append(sha.as_py())
                    continue
                raw, at, out = text.as_py(), 0, []
                for a, b in merged:
                    out.append(raw[at:a])
                    at = b
                out.append(raw[at:])
                kept.append(b"".join(out))
                shas.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(spans, spans_type), pa.array(kept, pa.binary()), pa.array(shas)],
                names=["doc_id", "n_bytes", "spans", "kept", "kept_sha256"],
            )

    return run


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
    bucket_contexts: int = BUCKET_CONTEXTS, hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """Rows (doc_id, n_bytes, removed spans, kept bytes or null if all, kept_sha256)."""
    if not 1 <= anchor <= length:
        raise ValueError("the anchor must fit into the window")
    spark = ship(docs.sparkSession)
    sc = spark.sparkContext
    docs = columns(docs, doc_id=id_col, text=text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    text = docs.select("text")

    rows = text.mapInArrow(_count(length, anchor), "anchor long, context long, n long, w int")
    counted = rows.repartition("anchor").groupBy("anchor", "context").agg(F.sum("n").alias("n"), F.max("w").alias("w"))
    counted = counted.selectExpr("*", "count(*) over (partition by anchor) as contexts").where("n > 1 or contexts > 1")
    counted = stored(counted, "op10-contexts")

    some = counted.where("contexts > 1")
    wanted = sc.broadcast(bit_filter(some, "context", FILTER_BITS))
    parts = text.mapInArrow(_bytes(length, anchor, wanted), "anchor long, context long, bytes binary")
    hot = some.where(F.col("contexts") > hot_contexts).select("anchor").distinct()
    has_hot = not hot.isEmpty()
    if has_hot:
        parts = stored(parts, "op10-parts")
    calm = parts.join(hot, "anchor", "left_anti") if has_hot else parts
    buckets = max(1, some.count() // bucket_contexts)
    found = calm.withColumn("bucket", F.expr(f"pmod(xxhash64(anchor), {buckets})")).select("bucket", "context", "bytes")
    found = found.groupBy("bucket").applyInArrow(_bucket(length), f"context long, ranges {RANGES_SQL}").where("size(ranges) > 0")
    if has_hot:
        each = parts.join(hot, "anchor", "left_semi").dropDuplicates(["context"]).select("context", "bytes")
        each = each.mapInArrow(_window_hashes(length), "context long, windows array<long>").selectExpr("context", "posexplode(windows) as (a, window)")
        twice = each.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
        single = each.join(twice, "window").groupBy("context").agg(F.collect_list(F.expr("struct(a as a, a as b)")).alias("ranges"))
        found = found.unionAll(single)
    whole = counted.where("n > 1").selectExpr("context", "array(struct(0 as a, w - 1 as b)) as ranges")
    marks = stored(whole.unionAll(found.join(whole.select("context"), "context", "left_anti").select("context", "ranges")), "op10-marks")

    marked = sc.broadcast(bit_filter(marks, "context", FILTER_BITS))
    places = text.mapInArrow(_places(length, anchor, marked), "text_key long, n_bytes long, first long, context long")
    spans = places.join(marks, "context").selectExpr("text_key", "n_bytes", "first", "inline(ranges)")
    spans = stored(
        spans.groupBy("text_key", "n_bytes").agg(F.collect_set(F.expr("struct(first + a as a, first + b as b)")).alias("ranges")),
        "op10-spans",
    )
    with_marks = sc.broadcast(bit_filter(spans, "text_key"))
    rows = docs.mapInArrow(_texts(with_marks), f"doc_id {id_type}, text_key long, n_bytes long, sha string, text binary")
    joined = rows.join(spans, ["text_key", "n_bytes"], "left").select("doc_id", "n_bytes", "sha", "text", "ranges")
    return joined.mapInArrow(
        _cut(length), f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string"
    )
