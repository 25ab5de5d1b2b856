"""Operator 3: token ids in binary shard files with a shared zstandard dictionary.

A dictionary is trained once on the serialized id arrays of a bounded sample
(the ``dictionary_docs`` documents with the least hash of their id, of each at
most ``dictionary_ids`` ids); it is stored beside the shards and named in each
by its SHA-256.  Documents are dealt by ranges of their id, sorted, encoded
and written as one file per range, each document an own zstandard frame, so
one short document is read without its neighbours.

Shard layout (little-endian):

    8 bytes   magic
    32 bytes  SHA-256 of the dictionary
    1 byte    bytes of an id (2 or 4)
    frames    one per document
    index     per document: doc_id int64, null flag int8 (as three arrays
              doc_id, n_tokens int64, null), then n + 1 frame offsets int64
    16 bytes  number of documents int64, place of the index int64

A task writes under a name of its own attempt; only files that the stored
manifest names are ever read, so a lost executor leaves no wrong shard.

Defined cases: null text counts as empty (the end id alone); order is by id
(null first), then hash and text for equal ids; an empty table writes no shard
and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .pieces import byte_level_memo, byte_level_split, tokenizer
from .shared import columns, ship, stored

MAGIC = b"LSTOKID1"
DICTIONARY_BYTES = 64 << 10
DICTIONARY_DOCS = 2000
DICTIONARY_IDS = 4096


def _encoded(batches, path: str, end_id: int, slice_bytes: int = K.SLICE_BYTES):
    """(doc_id, ids with the end id) of every row."""
    memo, cut, end = byte_level_memo(path), byte_level_split(path), np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for i, j, data, off in K.slices(batch.column("text"), slice_bytes):
            raw = data.tobytes()
            split = [cut(raw[a:b].decode()) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            values = memo.values(list(chain.from_iterable(split)))
            b = 0
            for doc_id, s in zip(ids[i:j], split, strict=True):
                a, b = b, b + len(s)
                yield doc_id, np.frombuffer(b"".join(values[a:b]) + end, dtype="<u4")


def _sample(path: str, end_id: int, width: int, most: int):
    def run(batches):
        out = [ids[:most].astype(f"<u{width}").tobytes() for _, ids in _encoded(batches, path, end_id)]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    return run


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples: their bytes serve as the dictionary
        return b"".join(samples)[:DICTIONARY_BYTES]


def _write(path: str, folder: str, end_id: int, width: int, dictionary: bytes):
    def run(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        rows = _encoded(batches, path, end_id)
        first = next(rows, None)
        if first is None:
            return
        store, root = pafs.FileSystem.from_uri(folder)
        name = f"{root}/shard-{part:06d}-{attempt}.ids"
        zc = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=3)
        at, doc_ids, counts, offsets = 0, [], [], []
        with store.open_output_stream(name) as out:
            head = MAGIC + hashlib.sha256(dictionary).digest() + bytes([width])
            out.write(head)
            at = len(head)
            while first is not None:
                doc_id, ids = first
                frame = zc.compress(ids.astype(f"<u{width}").tobytes())
                out.write(frame)
                doc_ids.append(doc_id)
                counts.append(len(ids))
                offsets.append(at)
                at += len(frame)
                first = next(rows, None)
            offsets.append(at)
            out.write(np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes())
            out.write(np.array(counts, dtype="<i8").tobytes())
            out.write(np.array([x is None for x in doc_ids], dtype="<i1").tobytes())
            out.write(np.array(offsets, dtype="<i8").tobytes())
            out.write(struct.pack("<qq", len(counts), at))
        yield pa.RecordBatch.from_pydict(
            {"shard": [part], "file": [name.rsplit("/", 1)[1]], "n_docs": [len(counts)], "n_tokens": [sum(counts)]},
            schema=pa.schema([("shard", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
        )

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    dictionary_docs: int = DICTIONARY_DOCS,
    dictionary_ids: int = DICTIONARY_IDS,
) -> DataFrame:
    """Write the shards into ``folder``; the manifest (shard, file, n_docs, n_tokens)."""
    spark = ship(docs.sparkSession)
    docs = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    width = 2 if tokenizer(tokenizer_path).get_vocab_size() <= 1 << 16 else 4
    # chosen by ids alone, so that no text is sorted; rows of one id come along up to the same number
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(dictionary_docs).distinct()
    sample = docs.join(F.broadcast(chosen.withColumnRenamed("doc_id", "s_id")), F.col("doc_id").eqNullSafe(F.col("s_id")), "left_semi").limit(dictionary_docs)
    samples = [bytes(r["ids"]) for r in sample.mapInArrow(_sample(tokenizer_path, end_id, width, dictionary_ids), "ids binary").collect()]
    dictionary = _dictionary(samples)
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/ids.dict") as out:
        out.write(dictionary)
    dealt = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    written = dealt.select("doc_id", "text").mapInArrow(
        _write(tokenizer_path, folder, end_id, width, dictionary), "shard long, file string, n_docs long, n_tokens long"
    )
    return stored(written, "op3-manifest")


def _read(folder: str):
    def run(batches):
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{file}") as f:
                    size = f.size()
                    head = f.read_at(41, 0)
                    dictionary = store.open_input_file(f"{root}/ids.dict").read()
                    if head[:8] != MAGIC or head[8:40] != hashlib.sha256(dictionary).digest():
                        raise ValueError(f"{file}: not a shard of this dictionary")
                    zd = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
                    n, at = struct.unpack("<qq", f.read_at(16, size - 16))
                    index = f.read_at(size - 16 - at, at)
                    doc_ids, counts = np.frombuffer(index, "<i8", n), np.frombuffer(index, "<i8", n, 8 * n)
                    null, offsets = np.frombuffer(index, "<i1", n, 16 * n), np.frombuffer(index, "<i8", n + 1, 17 * n)
                    starts = base + np.concatenate([[0], np.cumsum(counts)])[:-1]
                    i = 0
                    while i < n:  # some megabytes of frames at a time
                        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (4 << 20), "right")) - 1)
                        block = f.read_at(int(offsets[j] - offsets[i]), int(offsets[i]))
                        out = []
                        for k in range(i, j):
                            raw = zd.decompress(block[offsets[k] - offsets[i] : offsets[k + 1] - offsets[i]])
                            out.append(np.frombuffer(raw, f"<u{head[40]}").astype("<u4").tobytes())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(doc_ids[i:j], mask=null[i:j].astype(bool)),
                                pa.array(starts[i:j]),
                                pa.array([len(x) // 4 for x in out], pa.int64()),
                                pa.array(out, pa.binary()),
                                pa.array([zlib.crc32(x) for x in out], pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                        )
                        i = j

    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids, ids_crc32) of the manifest's shards, one task per few shards."""
    ship(manifest.sparkSession)
    # one row per shard, so this window is as small as the list of files
    base = manifest.selectExpr(
        "shard", "file", "sum(n_tokens) over (order by shard rows between unbounded preceding and current row) - n_tokens as base"
    )
    files = max(1, manifest.count())
    return base.repartition(files, "shard").mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long"
    )
