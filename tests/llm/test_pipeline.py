"""The corpus pipeline: each stage held against plain Python on what it was given, and run() against the stages."""

import collections
import os
import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402

ITEM = "Every river in the old country runs from the cold hills of the north down to the warm sea in the south"
SCHEMA = "doc_id long, text string, lang string, n_chars long, spans int, log_weight string"


def _rows():
    r = random.Random(8)
    rows = []

    def add(i, text):
        rows.append((i, text, "en", len(text or ""), 7, "w"))

    for i in range(260):
        words = [r.choice(brute.WORDS) for _ in range(r.randint(20, 70))]
        if i % 10 == 1:
            words[3] = "scum"
        add(i, " ".join(words))
    for i in range(260, 300):  # near copies of clean documents
        words = rows[(i - 260) * 10 + 2 if (i - 260) < 25 else 5][1].split()
        words[-1] = "changed"
        add(i, "  ".join(words))
    add(400, rows[12][1])
    add(401, "before it " + ITEM + " after it " + " ".join(r.choice(brute.WORDS) for _ in range(20)))
    add(402, "write to a.b@c.de or call +1 (456) 555-2186 about " + " ".join(r.choice(brute.WORDS) for _ in range(30)))
    add(None, "a row without an id " + " ".join(r.choice(brute.WORDS) for _ in range(25)))
    add(None, None)
    add(403, None)
    add(404, "")
    add(405, "word " * 20_000)
    rows.append(rows[3])  # a repeated row
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pipeline"))
    rows = _rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(i % 10 != 1), int(i % 10 == 1)) for i in range(0, 260) if i % 3 == 0 or i % 10 == 1]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_and_run(spark, folder):
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    given, outs = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(P.STAGES):
        path = f"{folder}/stage{k}"
        stage(spark, given, folder).write.parquet(path)
        given = spark.read.parquet(path)
        assert k == 4 or given.columns == columns, name
        outs.append(sorted([tuple(x) for x in given.collect()], key=str))
    quality, near, leaks, pii, tokens = outs
    assert not set(quality) - set(_rows())

    # one of each group of similar texts, repeated rows once; texts without words stay
    rows = [x for x in dict.fromkeys(quality) if (x[1] or "").split()]
    group = [c for _, c in brute.jaccard_components([x[1] for x in rows])]
    least = {}
    for x, c in zip(rows, group, strict=True):
        key = (x[0] is None, x[0] or 0)
        if c not in least or key < least[c][0]:
            least[c] = key, x
    alone = [x for x in dict.fromkeys(quality) if not (x[1] or "").split()]
    assert near == sorted([x for _, x in least.values()] + alone, key=str)

    assert leaks == [x for x in near if not (x[1] and ITEM in x[1])] and len(leaks) == len(near) - 1

    by_id = collections.Counter((x[0], x[2]) for x in pii)
    assert by_id == collections.Counter((x[0], x[2]) for x in leaks)
    texts = {x[0]: x for x in pii if x[0] is not None}
    for i, text, *_ in leaks:
        if i is not None and not brute.pii_spans(text):
            assert texts[i][1] == (text or "")
    if 402 in texts:
        assert texts[402][1].startswith("write to [EMAIL] or call [PHONE] about") and texts[402][3] == len(texts[402][1])

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter((x[0], len(tok.encode(x[1] or "", add_special_tokens=False).ids)) for x in pii)
    assert collections.Counter((x[0], x[1]) for x in tokens) == want

    got = P.run(spark, folder)
    assert sorted([tuple(x) for x in got.collect()], key=str) == tokens


def test_run_over_an_empty_table(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
