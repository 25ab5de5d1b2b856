"""Cross-tokenizer alignment against plain Python and the libraries themselves."""

import collections
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakestrata.llm import cross_align as C
from lakestrata.llm.pieces import _byte_chars

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, key string, pair int, groups string, n_best int"


def _libraries():
    tok = Tokenizer.from_file(A_PATH)
    tok.no_truncation()
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def brute(rows):
    tok, sp = _libraries()
    byte = {c: b for b, c in _byte_chars().items()}
    docs, counts = [], collections.Counter()
    for i, text in rows:
        a = b = []
        if text:
            a = [(x, bytes(byte[c] for c in tok.id_to_token(x))) for x in tok.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for x in sp.encode(text):
                piece = sp.id_to_piece(x)
                b.append((x, bytes([int(piece[3:5], 16)]) if sp.is_byte(x) else piece.replace("▁", " ").encode()))
            whole = (" " + text).encode()
            if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
                a = b = []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for x, t in side:
                out.append((at, at + len(t), x))
                at += len(t)
            spans.append(out)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        links = [(x, y) for s, e, x in spans[0] for t, f, y in spans[1] if s < f and t < e] if len(a) < 400 else []
        if len(a) >= 400:  # the same, without all pairs
            j = 0
            for s, e, x in spans[0]:
                while j < len(b) and spans[1][j][1] <= s:
                    j += 1
                k = j
                while k < len(b) and spans[1][k][0] < e:
                    links.append((x, spans[1][k][2]))
                    k += 1
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(x) for s, e, x in side if low < e <= cut) for side in spans) if len(a) < 4000 else "")
            low = cut
        counts.update(links)
        docs.append((i, len(a), len(b), len(cuts), links, ";".join(groups)))
    best = collections.defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        ((i, na, nb, ng, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), g) for i, na, nb, ng, ls, g in docs), key=str
    )


def _texts(seed=1, n=120):
    r = random.Random(seed)
    atoms = ["the ", "of", " river", "stone", "é", "ß", "日本", "\n", "\t", "  ", "123", "2024", "!?", "...", "'s", "can't ", "😀", "​", "Ünï", "x" * 9, "</s>", "ab"]
    out = ["".join(r.choice(atoms) for _ in range(r.randint(1, 80))) for _ in range(n)]
    return [*out, None, "", " ", "\n", "a ▁ b", "<|endoftext|> and <unk> <s> <0x41>", "x" * 3000, "\x00\x01 nul", out[0], out[0], "ﬁ é ﻿"]


def _frame(spark, texts):
    rows = [(None if i == 5 else i % 100, t, "k", 1, "g", 2) for i, t in enumerate(texts)]
    return [(r[0], r[1]) for r in rows], spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize(("hot_pairs", "held"), [(C.HOT_PAIRS, C.HELD_PAIRS), (1, 50), (40, 3000)])
def test_alignment(spark, monkeypatch, hot_pairs, held):
    monkeypatch.setattr(C, "HELD_PAIRS", held)
    rows, df = _frame(spark, _texts())
    al = C.CrossAlignment(df, A_PATH, B_PATH)
    got = al.documents().join(al.link_sums(hot_pairs), "key").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_link_counts(spark):
    _, df = _frame(spark, ["stone river", "stone", "river stone"])
    al = C.CrossAlignment(df, A_PATH, B_PATH)
    counts = al.link_counts().collect()
    assert sum(r.n for r in counts) == al.documents().agg({"n_links": "sum"}).first()[0]
    most = {}
    for r in counts:
        most[r.b_id] = max(most.get(r.b_id, 0), r.n)
    assert all(r.best == (r.n == most[r.b_id]) for r in counts)


def test_empty_table(spark):
    al = C.CrossAlignment(spark.createDataFrame([], SCHEMA), A_PATH, B_PATH)
    assert al.documents().count() == 0 and al.link_sums().count() == 0


def test_ids_equal_the_tokenizers_library():
    tok, _ = _libraries()
    r = random.Random(7)
    atoms = ["a", "B", "é", "日", "́", "😀", "‍", "1", "²", "Ⅷ", "'", "'ll", "'S", " ", "  ", "\n", "\r", "\t", "\xa0", " ", "　", "\x1c", "\x85",
             ".", "_", "-", "ǅ", "ª", "ـ", "ไ", "\U0001e900", "", " ", "<|endoftext|>", "the", " and"]
    texts = ["".join(r.choice(atoms) for _ in range(r.randint(1, 30))) for _ in range(6000)]
    texts += ["".join(chr(c) for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x30000, 64) if not 0xD800 <= a < 0xE000]
    got = C.byte_level(A_PATH).encode(texts)
    want = [e.ids for e in tok.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    bad = [t for t, x, y in zip(texts, got, want, strict=True) if x != y]
    assert bad == []


def test_pointer_jumping_over_a_long_chain():
    # tokens of two bytes against tokens of two bytes, one off: no shared end but the last
    side = C.Vocabulary.of(None, [b"a", b"aa"])
    n = 5000
    a, b = np.array([1] * n + [0], "<u2").tobytes(), np.array([0] + [1] * n, "<u2").tobytes()
    x = C.Aligned(side, side, [a, a], [b, b])
    ga, gb = x.groups
    assert ga.tolist() == [0] * (n + 1) + [1] * (n + 1) and gb.tolist() == ga.tolist()
    assert x.links[2].tolist() == [2 * n + 1] * 2
