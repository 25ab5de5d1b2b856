"""Operator 4: word-piece token counts by a linear longest-match automaton.

The vocabulary's pieces form a trie with two roots, one for the piece that
begins a word and one for continuation pieces.  Every node has a failure link
and the number of pieces that are popped on the way there, computed once
breadth first, so a word's greedy longest-match length is read in one pass over its
bytes; no piece is ever built.  A word that the pieces cannot spell counts as
one unknown piece.

Words are runs of bytes other than 0x20 and 0x09-0x0D.  Pieces come from a
byte-level vocabulary file: entries with the leading-space mark begin words,
the others continue them.

Defined cases: null or wordless text counts 0; equal rows and ids are kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import columns, ship

MEMO_WORDS = 400_000
START, CONTINUE = 0, 1


def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


def read_pieces(path: str) -> tuple[set[bytes], set[bytes]]:
    """(pieces that begin a word, continuation pieces) of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["content"] for t in data.get("added_tokens") or ()}
    alphabet = byte_alphabet()
    begin, inside = set(), set()
    for token in data["model"]["vocab"]:
        if token in special:
            continue
        raw = bytes(alphabet[c] for c in token)
        if raw.startswith(b" "):
            begin.add(raw[1:])
        else:
            inside.add(raw)
    return begin - {b""}, inside


class Automaton:
    """Longest-match lengths of words over two piece sets."""

    def __init__(self, begin: set[bytes], inside: set[bytes]):
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        final = [False, False]
        for root, pieces in ((START, begin), (CONTINUE, inside)):
            for piece in pieces:
                v = root
                for c in piece:
                    k = v * 256 + c
                    if k not in self.child:
                        self.child[k] = len(final)
                        final.append(False)
                    v = self.child[k]
                final[v] = True
        self.fail, self.pops = [-1] * len(final), [0] * len(final)
        below: list[list[tuple[int, int]]] = [[] for _ in final]
        for k, v in self.child.items():
            below[k >> 8].append((k & 255, v))
        queue = [START, CONTINUE]
        for u in queue:
            for c, v in below[u]:
                if final[v]:
                    self.fail[v], self.pops[v] = CONTINUE, 1
                else:
                    z, popped = self.fail[u], 0
                    while z >= 0 and z * 256 + c not in self.child:
                        popped += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.child[z * 256 + c], self.pops[u] + popped
                queue.append(v)

    def length(self, word: bytes) -> int:
        """Number of greedy pieces; 1 for a word that cannot be spelled."""
        child, fail, pops = self.child, self.fail, self.pops
        v, n = START, 0
        for c in word:
            k = v * 256 + c
            while k not in child:
                n += pops[v]
                v = fail[v]
                if v < 0:
                    return 1
                k = v * 256 + c
            v = child[k]
        while v != CONTINUE:  # pop what the word's end leaves open
            n += pops[v]
            v = fail[v]
            if v < 0:
                return 1
        return n


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(*read_pieces(path))


class _Lengths(dict):
    def __init__(self, length):
        self.length = length

    def __missing__(self, word):
        if len(self) >= MEMO_WORDS:
            self.clear()
        n = self.length(word)
        if len(word) <= 64:
            self[word] = n
        return n


def _count(path: str):
    def run(batches):
        get = _Lengths(automaton(path).length).__getitem__
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                n_tokens.append(sum(map(get, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_tokens)."""
    ship(docs.sparkSession)
    docs = columns(docs, doc_id=id_col, text=text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_count(vocabulary_path), f"doc_id {id_type}, n_words long, n_tokens long")
