"""Operator 2: BPE encoding and decoding by tree concatenation.

The vocabulary drops white space and splits on it and between letters and
signs, so a text is encoded unit by unit (:mod:`.pieces`).  A unit has no such
safe cut.  A long one is cut into leaves at any character, the leaves are encoded together,
and neighbours are joined pairwise up a tree.  At each join a window around
the cut is encoded anew.  The window grows until it holds a token that is
also in the left part and, further right, one that is also in the right part
(same place, same id, clean character boundary).  Left part up to the first,
window between, right part from the second: every pair of neighbouring
tokens then is a pair of some valid encoding, which makes the whole the
encoding of the whole text.  Without agreement the window ends as the whole
text of both parts, so the result never depends on luck.

Defined cases: null text counts as empty and gives no ids and an empty
decoded text; equal rows and equal or null ids are kept as they are; an
empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .pieces import space_free_memo, space_free_split, tokenizer
from .shared import columns, ship

LEAF = 512
WINDOW = 64
SLICE_BYTES = 1 << 18


class Part:
    """Encoding of text[at:end]: ids with character spans of the whole text."""

    __slots__ = ("at", "end", "ids", "spans")

    def __init__(self, at, end, ids, spans):
        self.at, self.end, self.ids, self.spans = at, end, ids, spans


def _parts(tok, text: str, cuts: list[tuple[int, int]]) -> list[Part]:
    out = []
    encoded = tok.encode_batch([text[a:b] for a, b in cuts], add_special_tokens=False)
    for (a, b), e in zip(cuts, encoded, strict=True):
        out.append(Part(a, b, e.ids, [(x + a, y + a) for x, y in e.offsets]))
    return out


def _marks(p: Part) -> dict[tuple[int, int, int], int]:
    """Tokens that begin at a clean character boundary, with their index."""
    out = {}
    for k in range(1, len(p.ids) - 1):
        if p.spans[k][0] >= p.spans[k - 1][1] and p.spans[k + 1][0] >= p.spans[k][1]:
            out[(*p.spans[k], p.ids[k])] = k
    return out


def join_parts(tok, text: str, left: Part, right: Part, window: int = WINDOW) -> Part:
    """The exact encoding of the text of two neighbouring parts."""
    cut = left.end
    while True:
        a, b = max(left.at, cut - window), min(right.end, cut + window)
        mid = _parts(tok, text, [(a, b)])[0]
        in_mid = _marks(mid)
        i, k = 0, 0
        if a > left.at:
            agreed = [(in_mid[m], k0) for m, k0 in _marks(left).items() if m[1] < cut and m in in_mid]
            k, i = min(agreed, default=(None, 0))
        j, n = len(right.ids), len(mid.ids)
        if b < right.end:
            agreed = [(in_mid[m], k0) for m, k0 in _marks(right).items() if m[0] > cut and m in in_mid]
            n, j = max(agreed, default=(None, 0))
        if k is not None and n is not None and k <= n:
            ids = left.ids[:i] + mid.ids[k:n] + right.ids[j:]
            return Part(left.at, right.end, ids, left.spans[:i] + mid.spans[k:n] + right.spans[j:])
        window *= 2


def encode_long(tok, text: str, leaf: int = LEAF) -> list[int]:
    """ids of one unsplit piece by tree concatenation."""
    if len(text) <= leaf:
        return tok.encode(text, add_special_tokens=False).ids
    parts = _parts(tok, text, [(a, min(a + leaf, len(text))) for a in range(0, len(text), leaf)])
    while len(parts) > 1:
        parts = [
            join_parts(tok, text, parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)
        ]
    return parts[0].ids


def _encode(path: str, leaf: int):
    def run(batches):
        cut, memo = space_free_split(path), space_free_memo(path, leaf, encode_long)
        names = token_names(path)
        try:
            for batch in batches:
                ids = batch.column("doc_id")
                for i, j, data, off in K.slices(batch.column("text"), SLICE_BYTES):
                    raw = data.tobytes()
                    split = [cut(raw[a:b].decode()) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                    get = memo.of(chain.from_iterable(split)).__getitem__
                    rows = [b"".join(map(get, s)) for s in split]
                    # without a decoder of its own, the vocabulary's decode joins tokens by a space
                    decoded = [" ".join(map(names.__getitem__, np.frombuffer(r, "<u4").tolist())) for r in rows]
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(i, j - i), pa.array(rows, pa.binary()), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
                    )
        finally:
            memo.rest()

    return K.trimmed(run)


@lru_cache(maxsize=4)
def token_names(path: str) -> list[str]:
    """Token of each id."""
    by_id = {i: t for t, i in tokenizer(path).get_vocab(with_added_tokens=True).items()}
    return [by_id.get(i, "") for i in range(max(by_id) + 1)]


def bpe_encode_decode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF
) -> DataFrame:
    """Rows (doc_id, ids as little-endian unsigned 32-bit integers, decoded text).

    For BPE vocabularies that drop white space, split on it and have no
    decoder of their own (checked)."""
    ship(docs.sparkSession)
    tok = tokenizer(tokenizer_path)
    if tok.decoder is not None or tok.encode("a \n b", add_special_tokens=False).ids != [
        x for p in "ab" for x in tok.encode(p, add_special_tokens=False).ids
    ]:
        raise ValueError("the vocabulary keeps white space or has a decoder")
    docs = columns(docs, doc_id=id_col, text=text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_encode(tokenizer_path, leaf), f"doc_id {id_type}, ids binary, decoded string")
