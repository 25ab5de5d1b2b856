"""Operator 13: line deduplication with two Bloom filters.

A line's key is the line without white space at its ends, A-Z lower-cased.
Keys of at least ``least_chars`` code points that stand in two or more
documents lose all their lines but those of the least document id.

1. Every document gives the 128-bit hashes of its distinct keys once; they
   are stored (16 bytes a key), split by the top bits of the hash into as many
   ranges as the filters need to stay within ``max_bits``.
2. For each range, every task fills two Bloom filters over its documents: keys
   seen once and keys seen twice.  The filters of all tasks are merged chunk
   by chunk: a bit stands in the merged second filter if it stands in a second
   one or in two first ones.  No key is shuffled for this.
3. Only keys that the second filter holds are suspected repeats.  They are
   shuffled by their whole hash, which confirms them (two different ids) and
   finds the least id.
4. The confirmed keys go back to the documents that lose lines; other
   documents are never shuffled.

The second filter alone reaches the driver and the executors: at most
``max_bits / 8`` bytes whatever the input.  A filter that is too full suspects
more keys and loses none.  Keys over one thousandth of the suspects are at
most a thousand by count and are joined by broadcast; the rest by shuffle.

Defined cases: null and empty text are one empty line; a key is its 128-bit
hash; rows of one id are one document (their common lines are no repeats);
a null id stands after all others, and rows with a null id are one document;
all lines of the least id stay, doubled ones too; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import bit_filter, columns, in_filter, ship, stored

U64 = np.uint64
LEAST_CHARS = 10
BITS_PER_KEY = 16
LEAST_BITS = 1 << 20
MAX_BITS = 1 << 29
CHUNK_WORDS = 1 << 10
HOT_SHARE = 1000
DROPS = pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int64())]))


def lines_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, key start, key end, code points of the key, row) of every line of every row.

    Rows are bytes[off[i]:off[i + 1]]; a row without bytes is one empty line."""
    n, rows = len(data), len(off) - 1
    at = np.flatnonzero(data == 10)
    row = np.searchsorted(off, at, "right") - 1
    ends = np.concatenate([at, off[1:]])
    starts = np.concatenate([off[:-1], at + 1])
    end_row = np.concatenate([row, np.arange(rows)])
    start_row = np.concatenate([np.arange(rows), row])
    ends = ends[np.lexsort((ends, end_row))]
    order = np.lexsort((starts, start_row))
    starts, row = starts[order], start_row[order]
    solid = ~K.SPACE[data]
    place = np.arange(n, dtype=np.int64)
    following = np.full(n + 1, n, dtype=np.int64)  # first solid byte from here on
    following[:n] = np.minimum.accumulate(np.where(solid, place, n)[::-1])[::-1]
    before = np.zeros(n + 1, dtype=np.int64)  # end of the last solid byte before here
    np.maximum.accumulate(np.where(solid, place + 1, 0), out=before[1:])
    key_start = np.minimum(following[starts], ends)
    key_end = np.maximum(before[ends], key_start)
    chars = np.zeros(n + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    return starts, ends, key_start, key_end, chars[key_end] - chars[key_start], row


def _hashed(data: np.ndarray, off: np.ndarray, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash as two uint64, row, line) of every line with a long enough key."""
    _, _, ks, ke, chars, row = lines_of(data, off)
    line = np.flatnonzero(chars >= least_chars)
    low = K.LOWER[data].tobytes()
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(low[a:b]) for a, b in zip(ks[line].tolist(), ke[line].tolist(), strict=True)])
    return np.frombuffer(raw, "<u8").reshape(-1, 2), row[line], line


def _keys(least_chars: int, ranges: int):
    """One row per document and range: its distinct key hashes."""
    shift = U64(64 - (ranges.bit_length() - 1)) if ranges > 1 else None

    def run(batches):
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("mark")
            for i, j, data, off in K.slices(batch.column("text")):
                h, row, _ = _hashed(data, off, least_chars)
                part = (h[:, 0] >> shift).astype(np.int64) if shift is not None else np.zeros(len(h), np.int64)
                order = np.lexsort((h[:, 1], h[:, 0], row, part))
                h, row, part = h[order], row[order], part[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]).any(1) | (row[1:] != row[:-1])
                h, row, part = h[new], row[new], part[new]
                cuts = np.flatnonzero((row[1:] != row[:-1]) | (part[1:] != part[:-1])) + 1
                bounds = np.concatenate([[0], cuts, [len(h)]]) if len(h) else np.zeros(1, np.int64)
                first = bounds[:-1]
                take = pa.array(row[first] + i)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[first]),
                        ids.take(take),
                        marks.take(take),
                        pa.array([h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                    ],
                    names=["part", "doc_id", "mark", "keys"],
                )

    return run


def _slots(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two bits of each hash, taken from its second half (the first half made the range)."""
    mask = U64(bits - 1)
    return [h[:, 1] & mask, K.mix(h[:, 1] ^ h[:, 0]) & mask]


def _has(words: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(slots[0]), dtype=bool)
    for s in slots:
        out &= (words[(s >> U64(6)).astype(np.int64)] >> (s & U64(63))) & U64(1) == 1
    return out


def _set(words: np.ndarray, slots: list[np.ndarray]) -> None:
    for s in slots:
        np.bitwise_or.at(words, (s >> U64(6)).astype(np.int64), U64(1) << (s & U64(63)))


def _fill(bits: int):
    """The two filters of a task, as compressed chunks that hold any bit."""

    def run(batches):
        once, twice, some = np.zeros(bits // 64, U64), np.zeros(bits // 64, U64), False
        for batch in batches:
            h = np.frombuffer(b"".join(batch.column("keys").to_pylist()), "<u8").reshape(-1, 2)
            if not len(h):
                continue
            some = True
            h = h[np.lexsort((h[:, 0], h[:, 1]))]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]).any(1)]))
            slots = _slots(h[first], bits)
            again = _has(once, slots) | (np.diff(first, append=len(h)) > 1)
            _set(twice, [s[again] for s in slots])
            _set(once, slots)
        if some:
            zc = zstandard.ZstdCompressor(level=1)
            words = min(CHUNK_WORDS, len(once))
            full = np.flatnonzero(once.reshape(-1, words).any(1))
            for a in range(0, len(full), 256):
                c = full[a : a + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int32))]
                    + [pa.array([zc.compress(f[k * words : (k + 1) * words].tobytes()) for k in c.tolist()], pa.binary()) for f in (once, twice)],
                    names=["chunk", "once", "twice"],
                )

    return run


def _merge(batches):
    """Second filter of all tasks; rows come sorted by chunk and are met one at a time."""
    zd, zc = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    now, once, twice = None, None, None
    for batch in batches:
        out = []
        for chunk, o, t in zip(*(batch.column(c).to_pylist() for c in ("chunk", "once", "twice")), strict=True):
            o, t = (np.frombuffer(zd.decompress(x), U64) for x in (o, t))
            if chunk == now:
                twice |= t | (once & o)
                once |= o
            else:
                if now is not None and twice.any():
                    out.append((now, zc.compress(twice.tobytes())))
                now, once, twice = chunk, o.copy(), t.copy()
        yield pa.RecordBatch.from_pydict(
            {"chunk": [c for c, _ in out], "twice": [b for _, b in out]}, schema=pa.schema([("chunk", pa.int32()), ("twice", pa.binary())])
        )
    if now is not None and twice.any():
        yield pa.RecordBatch.from_pydict(
            {"chunk": [now], "twice": [zc.compress(twice.tobytes())]}, schema=pa.schema([("chunk", pa.int32()), ("twice", pa.binary())])
        )


def twice_filter(keys: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter (two bits a key) that holds every key of two or more rows of ``keys``."""
    filled = keys.select("keys").mapInArrow(_fill(bits), "chunk int, once binary, twice binary")
    merged = filled.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merge, "chunk int, twice binary")
    out = np.zeros(bits // 64, U64)
    words, zd = min(CHUNK_WORDS, len(out)), zstandard.ZstdDecompressor()
    for r in merged.collect():  # at most bits / 8 bytes
        out[r["chunk"] * words : (r["chunk"] + 1) * words] = np.frombuffer(zd.decompress(bytes(r["twice"])), U64)
    return out


def _suspects(twice):
    """(hi, lo, doc_id, mark) of the keys that the second filter holds."""

    def run(batches):
        words = twice.value
        for batch in batches:
            blobs = batch.column("keys").to_pylist()
            h = np.frombuffer(b"".join(blobs), "<u8").reshape(-1, 2)
            row = np.repeat(np.arange(len(blobs)), [len(b) // 16 for b in blobs])
            k = np.flatnonzero(_has(words, _slots(h, len(words) * 64)))
            take = pa.array(row[k])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[k, 0].view(np.int64)),
                    pa.array(h[k, 1].view(np.int64)),
                    batch.column("doc_id").take(take),
                    batch.column("mark").take(take),
                ],
                names=["hi", "lo", "doc_id", "mark"],
            )

    return run


def _kept(least_chars: int):
    """Documents without the lines of their dropped keys."""

    def run(batches):
        for batch in batches:
            ids, drops = batch.column("doc_id"), batch.column("drops")
            size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(drops), 0).to_numpy(zero_copy_only=False))])
            bad_hi, bad_lo = (f.to_numpy(zero_copy_only=False).view(U64) for f in drops.flatten().flatten())
            for i, j, data, off in K.slices(batch.column("text")):
                starts, ends, *_, row = lines_of(data, off)
                gone = np.zeros(len(row), dtype=bool)
                if size[j] > size[i]:
                    h, at, line = _hashed(data, off, least_chars)
                    for r in range(i, j):
                        if size[r + 1] > size[r]:
                            a, b = np.searchsorted(at, [r - i, r - i + 1])
                            own = slice(size[r], size[r + 1])
                            bad = set(zip(bad_hi[own].tolist(), bad_lo[own].tolist(), strict=True))
                            gone[line[a:b]] = [x in bad for x in zip(h[a:b, 0].tolist(), h[a:b, 1].tolist(), strict=True)]
                raw = data.tobytes()
                bounds = np.searchsorted(row, np.arange(j - i + 1))
                texts = []
                for r, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    if not gone[a:b].any():
                        texts.append(raw[off[r] : off[r + 1]])
                    else:
                        stay = np.flatnonzero(~gone[a:b]) + a
                        texts.append(b"\n".join([raw[x:y] for x, y in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]))
                lost = np.concatenate([[0], np.cumsum(gone)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array((lost[bounds[1:]] - lost[bounds[:-1]]).astype(np.int64)),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_lines", "n_dropped", "kept"],
                )

    return run


def _plain(least_chars: int, touched):
    """Documents that surely lose no line, as _kept gives them."""
    kept = _kept(least_chars)

    def run(batches):
        for batch in batches:
            marks = batch.column("mark").to_numpy(zero_copy_only=False).view(U64)
            stay = batch.filter(pa.array(~in_filter(touched.value, marks)))
            yield from kept([stay.append_column("drops", pa.nulls(stay.num_rows, DROPS))])

    return run


def _touched(touched):
    def run(batches):
        for batch in batches:
            marks = batch.column("mark").to_numpy(zero_copy_only=False).view(U64)
            yield batch.filter(pa.array(in_filter(touched.value, marks)))

    return run


def _pow2(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    bits_per_key: int = BITS_PER_KEY,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept (the text without the dropped lines)."""
    spark = ship(docs.sparkSession)
    docs = columns(docs, doc_id=id_col, text=text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    marked = docs.withColumn("mark", F.xxhash64("doc_id", "text"))

    # an upper bound of the number of keys sizes the filters
    most = docs.agg(F.sum(F.expr(f"1 + least(char_length(text) - char_length(replace(text, '\\n', '')), char_length(text) div {least_chars})"))).first()[0] or 0
    wanted = max(LEAST_BITS, _pow2(most * bits_per_key))
    ranges = max(1, wanted // max_bits)
    keys = stored(
        marked.mapInArrow(_keys(least_chars, ranges), f"part long, doc_id {id_type}, mark long, keys binary"), "op13-keys"
    )
    found = []
    for part in range(ranges):
        of_part = keys.where(F.col("part") == part) if ranges > 1 else keys
        twice = spark.sparkContext.broadcast(twice_filter(of_part, wanted // ranges))
        found.append(
            stored(
                of_part.select("doc_id", "mark", "keys").mapInArrow(_suspects(twice), f"hi long, lo long, doc_id {id_type}, mark long"),
                "op13-suspects",
            )
        )
        twice.unpersist()
    suspects = found[0]
    for more in found[1:]:
        suspects = suspects.unionAll(more)

    # exact confirmation: two ids, or an id and null
    confirmed = (
        suspects.groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("doc_id").alias("with_id"), F.count("*").alias("n"))
        .where("least <> most or (with_id > 0 and with_id < n)")
        .selectExpr("hi as c_hi", "lo as c_lo", "least", "n")
    )
    confirmed = stored(confirmed, "op13-confirmed")
    total = suspects.count()
    same = (F.col("hi") == F.col("c_hi")) & (F.col("lo") == F.col("c_lo"))
    often = F.broadcast(confirmed.where(f"n * {HOT_SHARE} > {total}").select("c_hi", "c_lo", "least"))
    loses = suspects.join(often, same, "left")
    hot = loses.where("c_hi is not null and not (doc_id <=> least)").select("mark", "doc_id", "hi", "lo")
    rest = loses.where("c_hi is null").drop("c_hi", "c_lo", "least").join(
        confirmed.where(f"n * {HOT_SHARE} <= {total}").drop("n"), same
    )
    rest = rest.where("not (doc_id <=> least)").select("mark", "doc_id", "hi", "lo")
    dropped = (
        hot.unionAll(rest)
        .groupBy(F.col("mark").alias("d_mark"), F.col("doc_id").alias("d_id"))
        .agg(F.collect_set(F.struct("hi", "lo")).alias("drops"))
    )
    dropped = stored(dropped, "op13-dropped")

    touched = spark.sparkContext.broadcast(bit_filter(dropped, "d_mark"))
    schema = f"doc_id {id_type}, n_lines long, n_dropped long, kept string"
    plain = marked.mapInArrow(_plain(least_chars, touched), schema)
    losing = marked.mapInArrow(_touched(touched), marked.schema).join(
        dropped, (F.col("mark") == F.col("d_mark")) & F.col("doc_id").eqNullSafe(F.col("d_id")), "left"
    )
    return plain.unionAll(losing.select("doc_id", "mark", "text", "drops").mapInArrow(_kept(least_chars), schema))
