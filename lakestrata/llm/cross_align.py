"""Operator 12: alignment of two tokenizers by pointer jumping.

A byte-level BPE (A) and a sentencepiece model (B) cut the same bytes, a space
and the text, into tokens.  Tokens of A and B overlap in chains; the offsets
where both end cut the chains into groups.  Every token points to the token of
the other side that covers its last byte, the farthest right of those that it
overlaps; where both end there, to that token of A, which points to itself.
Successor doubling over whole arrays of many documents (``succ = succ[succ]``)
ends when all point to the terminal token of their group, after as many steps
as the logarithm of the longest chain.

1. Texts are encoded once; the ids are stored, two or four bytes each.
2. Links, the overlapping pairs, are counted per task and summed over the
   corpus by one shuffle of (pair, count).
3. Pairs over one ``HOT_PAIRS``-th of all links, hence fewer than that, are
   broadcast with their counts; a document's links of other pairs go to the
   counts by a shuffle on the pair, of which none is frequent.

A is encoded by tiktoken on the vocabulary and merges read from the
tokenizers file, which gives the same ids as that library with special strings
as plain text (tested), at a fifth of the time.

Defined cases: null and empty texts, and texts whose joined token bytes differ
from a space and the text on either side, have no tokens; equal rows and equal
or null ids are separate documents; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .pieces import _byte_chars
from .shared import columns, ship, stored

HOT_PAIRS = 1 << 20
HELD_PAIRS = 1 << 21
SLICE_BYTES = 1 << 19
SPACE_MARK = "▁"


@dataclass
class Vocabulary:
    """encode(list of texts) -> lists of ids; bytes of token i are data[off[i]:off[i + 1]]."""

    encode: object
    data: np.ndarray
    off: np.ndarray

    @classmethod
    def of(cls, encode, tokens: list[bytes]) -> Vocabulary:
        off = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        return cls(encode, np.frombuffer(b"".join(tokens), np.uint8), off)

    @cached_property
    def length(self) -> np.ndarray:
        return np.diff(self.off)

    @property
    def size(self) -> int:
        return len(self.off) - 1

    @property
    def id_type(self) -> str:
        return "<u2" if self.size <= 1 << 16 else "<u4"

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all tokens in order."""
        n = self.length[ids]
        shift = self.off[ids] - (np.cumsum(n) - n)
        return self.data[np.repeat(shift, n) + np.arange(n.sum())]


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """Byte-level BPE of a tokenizers file; special strings are plain text."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    model, split = d["model"], d["pre_tokenizer"]
    if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or d["normalizer"]:
        raise ValueError(f"{path}: not a plain byte-level BPE")
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if sorted(merged) != merged:
        raise ValueError(f"{path}: ids do not follow the merges")
    byte = {c: b for b, c in _byte_chars().items()}
    special = {t["content"]: t["id"] for t in d["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    tokens = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
    enc = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Vocabulary.of(lambda texts: [enc.encode_ordinary(" " + t) for t in texts], [tokens.get(i, b"") for i in range(max(tokens) + 1)])


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> Vocabulary:
    """Sentencepiece model that puts a space before the text itself."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
    return Vocabulary.of(lambda texts: sp.encode(texts, num_threads=1), tokens)


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter((i for x in lists for i in x), np.int64, int(n.sum())), n


def _exact(voc: Vocabulary, ids: np.ndarray, n: np.ndarray, raw: list[bytes]) -> np.ndarray:
    """Which documents' tokens join to their bytes."""
    size = np.array([len(x) for x in raw], dtype=np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    got = np.bincount(doc, voc.length[ids], minlength=len(n)).astype(np.int64)
    ok = got == size
    if ok.any():
        joined = voc.joined(ids[ok[doc]])
        want = np.frombuffer(b"".join([x for x, k in zip(raw, ok.tolist(), strict=True) if k]), np.uint8)
        starts = np.cumsum(size[ok]) - size[ok]
        ok[ok] = ~np.logical_or.reduceat(joined != want, starts)
    return ok


def _encoded(a_path: str, b_path: str):
    def run(batches):
        a_voc, b_voc = byte_level(a_path), sentence_pieces(b_path)
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, data, off in K.slices(batch.column("text")):
                whole = data.tobytes()
                raw = [whole[x:y] for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                some = [k for k, t in enumerate(raw) if t]
                texts, spaced = [raw[k].decode() for k in some], [b" " + raw[k] for k in some]
                out, ok = [], np.ones(len(some), dtype=bool)
                for voc in (a_voc, b_voc):
                    tokens, n = _flat(voc.encode(texts))
                    ok &= _exact(voc, tokens, n, spaced)
                    out.append((tokens.astype(voc.id_type), np.concatenate([[0], np.cumsum(n)]).tolist()))
                cols = []
                for tokens, at in out:
                    col = [b""] * (j - i)
                    for k, r in enumerate(some):
                        if ok[k]:
                            col[r] = tokens[at[k] : at[k + 1]].tobytes()
                    cols.append(pa.array(col, pa.binary()))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *cols], names=["doc_id", "a_ids", "b_ids"])

    return run


class Aligned:
    """Tokens of some documents: ids of both sides, their groups and their links."""

    def __init__(self, a_voc: Vocabulary, b_voc: Vocabulary, a_raw: list[bytes], b_raw: list[bytes]):
        self.a, self.b = (np.frombuffer(b"".join(x), v.id_type).astype(np.int64) for x, v in ((a_raw, a_voc), (b_raw, b_voc)))
        a_size, b_size = (int(v.id_type[2]) for v in (a_voc, b_voc))
        self.n_a = np.array([len(x) // a_size for x in a_raw], dtype=np.int64)
        self.n_b = np.array([len(x) // b_size for x in b_raw], dtype=np.int64)
        self.a_end, self.b_end = np.cumsum(a_voc.length[self.a]), np.cumsum(b_voc.length[self.b])
        n = int(self.a_end[-1]) if len(self.a) else 0
        # by byte: does a token end here, and how many have ended before
        self.in_a, self.in_b = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        self.in_a[self.a_end - 1] = True
        self.in_b[self.b_end - 1] = True
        self.a_before, self.b_before = (np.cumsum(x, dtype=np.int32) - x for x in (self.in_a, self.in_b))

    def per_document(self, of_a: np.ndarray) -> np.ndarray:
        """Sum by document of a value of each A token."""
        total = np.concatenate([[0], np.cumsum(of_a)])
        at = np.concatenate([[0], np.cumsum(self.n_a)])
        return total[at[1:]] - total[at[:-1]]

    @cached_property
    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Group number of each A token and of each B token, by pointer jumping."""
        n = len(self.a)
        shared = self.in_b[self.a_end - 1]
        succ = np.concatenate([
            np.where(shared, np.arange(n), n + self.b_before[self.a_end - 1]),
            self.a_before[self.b_end - 1],
        ]).astype(np.int32)
        while True:
            further = succ[succ]
            if np.array_equal(further, succ):
                break
            succ = further
        number = np.cumsum(shared) - 1
        return number[succ[:n]], number[succ[n:]]

    @cached_property
    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(A id, B id) of each overlapping pair, and the number of links by document."""
        at = np.flatnonzero(self.in_a | self.in_b)
        a = self.a_before[at]
        n = np.bincount(a, minlength=len(self.a)) if len(self.a) else np.zeros(0, np.int64)
        return self.a[a], self.b[self.b_before[at]], self.per_document(n)

    def text(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets by document) of ``a1,a2|b1;a3|b2,b3``: groups in order, decimal ids."""
        ga, gb = self.groups
        na, nb = len(ga), len(gb)
        count = int(ga[-1]) + 1 if na else 0
        a_to = np.cumsum(np.bincount(ga, minlength=count))  # A tokens up to each group
        b_to = np.cumsum(np.bincount(gb, minlength=count))
        place_a = np.arange(na) + np.concatenate([[0], b_to])[ga]
        place_b = np.arange(nb) + a_to[gb]
        ids = np.empty(na + nb, dtype=np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        sign = np.full(na + nb, ord(","), dtype=np.uint8)
        new = np.concatenate([[True], ga[1:] != ga[:-1]]) if na else np.zeros(0, bool)
        sign[place_a[new]] = ord(";")
        new = np.concatenate([[True], gb[1:] != gb[:-1]]) if nb else np.zeros(0, bool)
        sign[place_b[new]] = ord("|")
        digits, length = _decimals(int(ids.max(initial=0)) + 1)
        chars = np.empty((na + nb, digits.shape[1] + 1), dtype=np.uint8)
        chars[:, 0], chars[:, 1:] = sign, digits[ids]
        wanted = np.arange(digits.shape[1] + 1) <= length[ids][:, None]
        bounds = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        some = bounds[:-1][np.diff(bounds) > 0]
        wanted[some, 0] = False  # no sign before a document's first token
        size = np.concatenate([[0], np.cumsum(wanted.sum(1))])
        return chars[wanted], size[bounds]


_digits: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Left-aligned digits and their number of all integers below the next power of two."""
    n = 1 << max(0, n - 1).bit_length()
    if n not in _digits:
        width = len(str(n))
        _digits[n] = (
            np.frombuffer("".join(f"{i:<{width}}" for i in range(n)).encode(), np.uint8).reshape(n, width),
            np.array([len(str(i)) for i in range(n)]),
        )
    return _digits[n]


def _aligned(batches, a_path: str, b_path: str):
    """(key column, Aligned) of some documents at a time."""
    a_voc, b_voc = byte_level(a_path), sentence_pieces(b_path)
    for batch in batches:
        a, b = batch.column("a_ids"), batch.column("b_ids")
        upto = np.concatenate([[0], np.cumsum(pc.binary_length(a).to_numpy(zero_copy_only=False).astype(np.int64))])
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(i, j - i), Aligned(a_voc, b_voc, a[i:j].to_pylist(), b[i:j].to_pylist())
            i = j


def _documents(a_path: str, b_path: str):
    def run(batches):
        for rows, x in _aligned(batches, a_path, b_path):
            chars, off = x.text()
            raw = chars.tobytes()
            groups = [raw[s:t].decode("ascii") for s, t in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            terminal = x.in_b[x.a_end - 1] if len(x.a) else np.zeros(0, bool)
            numbers = (x.n_a, x.n_b, x.per_document(terminal), x.links[2])
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), rows.column("doc_id"), *(pa.array(v.astype(np.int64)) for v in numbers), pa.array(groups, pa.string())],
                names=["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"],
            )

    return run


def _counted(a_path: str, b_path: str):
    """(pair, times), at most about HELD_PAIRS distinct ones held at a time."""

    def run(batches):
        size, held, waiting = sentence_pieces(b_path).size, [], 0

        def summed():
            pair, n = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(pair, kind="stable")
            pair, n = pair[order], n[order]
            at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            return pair[at], np.add.reduceat(n, at)

        def batch_of(pair, n):
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "times"])

        for _, x in _aligned(batches, a_path, b_path):
            a, b, _ = x.links
            if not len(a):
                continue
            held.append(np.unique(a * size + b, return_counts=True))
            waiting += len(held[-1][0])
            if waiting > HELD_PAIRS:
                held = [summed()]
                waiting = len(held[0][0])
                if 2 * waiting > HELD_PAIRS:
                    yield batch_of(*held[0])
                    held, waiting = [], 0
        if held:
            yield batch_of(*summed())

    return run


def _summed(a_path: str, b_path: str, hot):
    """Per document its sums over the broadcast pairs (pair null), and its links of each other pair."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "pair", "times", "n_best", "count_sum")])

    def run(batches):
        size = sentence_pieces(b_path).size
        pairs, counts, best = hot.value
        for rows, x in _aligned(batches, a_path, b_path):
            a, b, per = x.links
            key = rows.column("key").to_numpy()
            link = a * size + b
            at = np.minimum(np.searchsorted(pairs, link), max(0, len(pairs) - 1))
            hit = pairs[at] == link if len(pairs) else np.zeros(len(link), dtype=bool)
            n = np.where(hit, counts[at], 0) if len(pairs) else np.zeros(len(link), np.int64)
            top = hit & best[at] if len(pairs) else hit
            bounds = np.concatenate([[0], np.cumsum(per)])
            sums = [np.concatenate([[0], np.cumsum(v, dtype=np.int64)]) for v in (top, n)]
            top, n = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
            none = pa.nulls(len(key), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(key), none, none, pa.array(top), pa.array(n)], schema=schema)
            rare, doc = link[~hit], np.repeat(np.arange(len(key)), per)[~hit]
            if len(rare):
                order = np.lexsort((rare, doc))
                rare, doc = rare[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (doc[1:] != doc[:-1])]))
                none = pa.nulls(len(first), pa.int64())
                times = np.diff(first, append=len(rare))
                yield pa.RecordBatch.from_arrays([pa.array(key[doc[first]]), pa.array(rare[first]), pa.array(times), none, none], schema=schema)

    return run


class CrossAlignment:
    """Alignment of all documents: ``documents()``, ``link_counts()`` and ``link_sums()``, rows of a document by ``key``."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = ship(docs.sparkSession)
        self.paths = (a_path, b_path)
        docs = columns(docs, doc_id=id_col, text=text_col)
        self.id_type = docs.schema["doc_id"].dataType.simpleString()
        ids = docs.mapInArrow(_encoded(*self.paths), f"doc_id {self.id_type}, a_ids binary, b_ids binary")
        self.ids = stored(ids.withColumn("key", F.monotonically_increasing_id()), "op12-ids")

    def documents(self) -> DataFrame:
        """key, doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``; empty without tokens)."""
        schema = f"key long, doc_id {self.id_type}, n_a long, n_b long, n_groups long, n_links long, groups string"
        return self.ids.mapInArrow(_documents(*self.paths), schema)

    @cached_property
    def _counts(self) -> DataFrame:
        size = sentence_pieces(self.paths[1]).size
        counted = self.ids.select("a_ids", "b_ids").mapInArrow(_counted(*self.paths), "pair long, times long")
        counted = counted.groupBy("pair").agg(F.sum("times").alias("n"))
        counted = stored(counted.withColumn("b_id", F.expr(f"pair % {size}")), "op12-counts")
        most = counted.groupBy("b_id").agg(F.max("n").alias("most"))
        return stored(counted.join(most, "b_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "op12-best")

    def link_counts(self) -> DataFrame:
        """a_id, b_id, n (links in the corpus), best (the highest of its B id, ties included)."""
        size = sentence_pieces(self.paths[1]).size
        return self._counts.selectExpr(f"int(pair div {size}) as a_id", f"int(pair % {size}) as b_id", "n", "best")

    def link_sums(self, hot_pairs: int | None = None) -> DataFrame:
        """key, n_best (links of a best pair), count_sum (corpus counts over the document's links)."""
        most = hot_pairs or HOT_PAIRS
        total = self._counts.agg(F.sum("n")).first()[0] or 0
        # fewer than ``most`` pairs have over total / most links
        hot = self._counts.where(f"n * {most} > {total}").toPandas().sort_values("pair")
        arrays = (hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64), hot["best"].to_numpy(bool))
        found = self.ids.select("key", "a_ids", "b_ids").mapInArrow(
            _summed(*self.paths, self.spark.sparkContext.broadcast(arrays)), "key long, pair long, times long, n_best long, count_sum long"
        )
        found = stored(found, "op12-sums")
        rest = found.where("pair is not null").select("key", "pair", "times").join(self._counts.where(f"n * {most} <= {total}"), "pair")
        rest = rest.selectExpr("key", "if(best, times, 0L) as n_best", "times * n as count_sum")
        both = found.where("pair is null").select("key", "n_best", "count_sum").unionAll(rest)
        return both.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
