"""Operators against brute force and on odd input: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from lakestrata.llm import bpe, ngram_jaccard, pieces  # noqa: E402
from lakestrata.llm.bpe import bpe_encode_decode, encode_long  # noqa: E402
from lakestrata.llm.decontaminate import find_leaks  # noqa: E402
from lakestrata.llm.importance import importance_resample, kth_largest  # noqa: E402
from lakestrata.llm.ngram_jaccard import ngram_jaccard_join, one_of_each  # noqa: E402
from lakestrata.llm.pii import digest_spans, find_pii, redacted  # noqa: E402
from lakestrata.llm.run_length_index import RunLengthIndex, drop_repeats, mark_bucket  # noqa: E402
from lakestrata.llm.shared import components  # noqa: E402
from lakestrata.llm.token_counts import Automaton, read_pieces, token_counts  # noqa: E402
from lakestrata.llm.token_files import read_token_files, write_token_files  # noqa: E402
from lakestrata.llm.topk_search import topk_search  # noqa: E402
from lakestrata.llm.warc import derivatives, plain_text, read_warc, write_warc  # noqa: E402

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
# columns named as the operators' own
CLASH = "token long, set_key long, spans string, text_hash long, log_weight string"


def _texts(seed=1, n=60):
    r = random.Random(seed)
    out = [" ".join(r.choice(brute.WORDS) for _ in range(r.randint(1, 60))) for _ in range(n)]
    for _ in range(n):
        w = out[r.randrange(n)].split()
        if w and r.random() < 0.7:
            w[r.randrange(len(w))] = "changed"
        out.append("  ".join(w).title())
    return [*out, None, "", " \n", "one two", "ONE  two", "x" * 30_000, out[0], out[0]]


def _docs(spark, texts):
    rows = [(i, t, 1, 2, "s", 3, "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASH}").repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark, _texts()).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.mark.parametrize("limit", [2])
def test_jaccard_components(docs, limit):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(docs, rare_limit=limit).collect()}
    want = brute.jaccard_components(_texts())
    assert [got[i] for i in range(len(want))] == want


def test_jaccard_with_a_full_filter_of_frequent_tokens(spark, monkeypatch):
    # nearly every token is flagged as frequent, whether it is or not
    monkeypatch.setattr(ngram_jaccard, "COMMON_BITS", 64)
    r = random.Random(13)
    # passages in ten texts each: more frequent tokens than the filter has bits
    passages = [" ".join(f"p{i}w{j}" for j in range(10)) for i in range(150)] * 10
    r.shuffle(passages)
    texts = [" ".join([*passages[i : i + 5], *(str(r.random()) for _ in range(20))]) for i in range(0, 1500, 5)]
    for _ in range(8):  # each text reaches the threshold with its neighbours alone
        stream = [str(r.random()) for _ in range(140)]
        texts += [" ".join(stream[i : i + 39]) for i in range(0, 100, 5)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(_docs(spark, texts), rare_limit=8).collect()}
    want = brute.jaccard_components(texts)
    assert [got[i] for i in range(len(want))] == want


def test_jaccard_empty_table_and_one_of_each(spark, docs, empty):
    assert ngram_jaccard_join(empty).count() == 0
    kept = sorted(r.doc_id for r in one_of_each(docs).collect())
    assert kept == [i for i, (_, c) in enumerate(brute.jaccard_components(_texts())) if c == i]
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q")], "doc_id long, text string")
    assert sorted(one_of_each(twice).collect(), key=str) == sorted([(1, "a b c d e f"), (None, "q")], key=str)


def test_jaccard_cells_of_one_large_family(spark, monkeypatch):
    r = random.Random(9)
    base = [str(r.random()) for _ in range(60)]
    texts = []
    for _ in range(300):  # distinct sets, one least set for nearly all
        w = list(base)
        w[r.randrange(50, 60)] = str(r.random())
        texts.append(" ".join(w))
    sizes = spark.sparkContext.accumulator(0)
    similar = ngram_jaccard._similar

    def watched(num, den):
        def run(sets, pairs):
            if sets.num_rows > 60:
                sizes.add(1)
            return similar(num, den)(sets, pairs)

        return run

    monkeypatch.setattr(ngram_jaccard, "_similar", watched)
    monkeypatch.setattr(ngram_jaccard, "CELL_PAIRS", 20)
    got = {r.doc_id: r.component_id for r in ngram_jaccard_join(_docs(spark, texts)).collect()}
    assert [got[i] for i in range(300)] == [c for _, c in brute.jaccard_components(texts)]
    assert sizes.value == 0


def test_jaccard_pairs_of_a_large_group_of_near_copies(spark, monkeypatch):
    r = random.Random(31)
    stream = [str(r.random()) for _ in range(260)]
    texts = [" ".join(stream[i : i + 160]) for i in range(100)]  # each text is similar to its neighbours alone
    for i in range(100):
        w = texts[i].split()
        w[3 + i % 150] = str(r.random())
        texts.append(" ".join(w))
    made = []
    verify = ngram_jaccard._verify

    def watched(docs, *how):
        if how[-1] == "op1-cross":
            made.append(how[-5].count())
        return verify(docs, *how)

    monkeypatch.setattr(ngram_jaccard, "_verify", watched)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(_docs(spark, texts)).collect()}
    want = brute.jaccard_components(texts)
    assert [got[i] for i in range(len(want))] == want
    assert sum(made) < 1000


def test_jaccard_pairs_meet_in_one_of_the_commonest_entries(spark):
    # 30 sets hold all of 300 tokens, more than there are slots, and some of 20 combinations
    rows = [(t, s, s, 400, t >= 280, 0, 30) for s in range(30) for t in range(300) if t < 280 or (s + t) % 2]
    entries = spark.createDataFrame(rows, "token long, set_key long, comp long, n long, combo boolean, flagged long, comps long")
    slotted, _ = ngram_jaccard._slotted(entries)
    words = range(ngram_jaccard.SLOT_WORDS)
    slots = ngram_jaccard.SLOT_BITS * ngram_jaccard.SLOT_WORDS
    a, b = (slotted.select("token", *(F.col(c).alias(c + x) for c in slotted.columns if c != "token")) for x in "ab")
    first = " | ".join(f"(earlier{w}a & m{w}b)" for w in words)
    rows = a.join(b, "token").where(f"set_keya < set_keyb and ({first}) = 0")
    assert rows.where("slota is not null").count() == 435  # one for each pair
    assert slotted.where("slot is not null").select("token").distinct().count() == slots
    stats = spark.createDataFrame([(s, 0, [0] * 20) for s in range(30)], "set_key long, cut int, ranks array<int>")
    pairs = ngram_jaccard._candidates(entries, entries.where("false"), stats, 75, 100, 1)
    assert pairs.agg(F.min("c"), F.max("c"), F.min("cc"), F.max("cc")).first() == (280, 280, 0, 10)


def test_memo_values_are_those_of_the_mapping():
    made = []

    def make(units):
        made.extend(units)
        return [u.encode() for u in units]

    memo = pieces.Memo(make, limit=4)
    long = "x" * (pieces.LONG + 1)
    for units in (["a", "b", "a", long, long], [], [long, "c", "a"], list("defgh"), ["a", "d", "z"]):
        assert memo.values(units) == [u.encode() for u in units]
    assert long not in memo.values(["a"]) and sorted(made) == sorted([*"abcdefghz", long, long])


def test_a_worker_between_tasks_keeps_few_units():
    words = [f"w{i}x" for i in range(30_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [" ".join(words), "a " + " ".join(reversed(words))]})
    run = bpe._encode(WORD_BPE, 64)
    first = [r for b in run(iter([batch])) for r in b.to_pylist()]
    memo = pieces.space_free_memo(WORD_BPE, 64, encode_long)
    assert 0 < len(memo.new) + len(memo.old) <= 20_000
    assert [r for b in run(iter([batch])) for r in b.to_pylist()] == first
    ids = Tokenizer.from_file(WORD_BPE).encode(" ".join(words), add_special_tokens=False).ids
    assert np.frombuffer(first[0]["ids"], "<u4").tolist() == ids


def test_memo_at_rest():
    memo = pieces.Memo(lambda units: [u.encode() for u in units], limit=4)
    long = "x" * (pieces.LONG + 1)
    for units in (["a", long, "b", "c", "d", "e"], [], ["a", long]):
        memo.of(units)
        memo.rest(2)
        assert len(memo.new) + len(memo.old) <= 2 and long not in memo.new
        assert memo.values(["e", long, "a"]) == [b"e", long.encode(), b"a"]


def test_components_of_few_links_take_few_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    conf = {"shuffle.partitions": str(10 * cores), "adaptive.coalescePartitions.enabled": "false", "autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in conf}
    for k, v in conf.items():
        spark.conf.set(f"spark.sql.{k}", v)
    spark.sparkContext.setJobGroup("few links", "")
    try:
        links = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 10], "a long, b long")
        got = sorted(components(links).collect())
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)
    assert got == [(i, i - (i - 1) % 10) for i in range(1, 41)]
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few links") for s in tracker.getJobInfo(j).stageIds}
    tasks = [x.numTasks for x in map(tracker.getStageInfo, stages) if x and x.numCompletedTasks]
    assert max(tasks) <= 4 * cores


def test_bpe_tree_concatenation_is_exact():
    tok, r = Tokenizer.from_file(WORD_BPE), random.Random(5)
    for _ in range(120):
        letters = r.choice(["ab", "abcdefghijklmnop", "aé'st!1́", "abc'sß"])
        text = "".join(r.choice(letters) for _ in range(r.randint(1, 2000)))
        if r.random() < 0.3:
            text = text.replace("b", "<|endoftext|>")
        assert encode_long(tok, text, r.choice([16, 64, 512])) == tok.encode(text, add_special_tokens=False).ids


def test_bpe_encode_decode(docs, empty):
    tok = Tokenizer.from_file(WORD_BPE)
    got = {r.doc_id: r for r in bpe_encode_decode(docs, WORD_BPE, leaf=64).collect()}
    for i, text in enumerate(_texts()):
        ids = tok.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        assert got[i].decoded == tok.decode(ids, skip_special_tokens=False)
    assert bpe_encode_decode(empty, WORD_BPE).count() == 0


def test_token_files(spark, docs, empty, tmp_path):
    tok = Tokenizer.from_file(BYTE_BPE)
    folder = f"file://{tmp_path}/ids"
    got = {r.doc_id: r for r in read_token_files(write_token_files(docs, folder, BYTE_BPE), folder).collect()}
    start = 0
    for i, text in enumerate(_texts()):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        assert bytes(got[i].ids) == ids
        start += len(ids) // 4
    none = f"file://{tmp_path}/none"
    assert read_token_files(write_token_files(empty, none, BYTE_BPE), none).count() == 0
    odd = spark.createDataFrame([(None, "a"), (3, "b"), (3, "b")], "doc_id long, text string")
    rows = read_token_files(write_token_files(odd, none + "2", BYTE_BPE), none + "2").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 3, 3]


def test_token_counts(docs, empty):
    begin, inside = read_pieces(BYTE_BPE)
    automaton = Automaton(begin, inside)
    for word in [b"unbelievable", b"x" * 50, "日本".encode(), b"\xff\xfe", b"a"]:
        assert automaton.length(word) == brute.longest_match(word, begin, inside)
    small = Automaton({b"a", b"abcd"}, {b"b", b"c", b"cd"})
    assert [small.length(w) for w in (b"abcd", b"abc", b"abcz", b"z", b"ab")] == [1, 3, 1, 1, 2]
    got = {r.doc_id: r.n_tokens for r in token_counts(docs, BYTE_BPE).collect()}
    for i, text in enumerate(_texts()):
        assert got[i] == sum(brute.longest_match(w, begin, inside) for w in (text or "").encode().split())
    assert token_counts(empty, BYTE_BPE).count() == 0


def test_topk_search(spark):
    rng = np.random.default_rng(3)
    vecs = (rng.normal(size=(400, 8)) * rng.lognormal(0, 1, size=(400, 1))).tolist()
    vecs[5], vecs[7][2], vecs[9][1], vecs[100] = None, float("nan"), None, vecs[11]
    vecs[50], vecs[51] = vecs[11], vecs[11]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vecs)], "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(r) for r in topk_search(df, "id % 50 = 0", bucket_rows=64, query_rows=4).select("query_id", "rank", "vec_id", "score").collect())
    ok = [i for i, v in enumerate(vecs) if v and all(x is not None and x == x for x in v)]
    m = {i: np.floor(256 * np.array(vecs[i])).astype(int) for i in ok}
    want = []
    for q in (i for i in ok if i % 50 == 0):
        best = sorted((-int(m[q] @ m[i]), i) for i in ok if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk_search(df.where("false"), "id % 50 = 0").count() == 0


def test_importance_resample(spark, empty):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(4000):  # the smoothing wants some dozens of documents per feature
        words = [r.choice(brute.WORDS) for _ in range(r.randint(20, 80))]
        kind = i % 10
        if kind == 0:
            words = [w.upper() + "!!" for w in words]
        if kind == 1:
            words[5] = "scum"
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            labels.append((i, int(kind != 0), int(kind == 1)))
    rows += [(10_000, None), (10_001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {x.doc_id for x in importance_resample(docs, marks).collect()}
    assert kept == {i for i, _ in rows if i >= 10_000 or i % 10 > 1}  # unlabelled ones too
    assert importance_resample(docs, marks.where("false")).count() == len(rows)
    assert importance_resample(empty, marks).count() == 0
    scores = spark.createDataFrame([(float(x),) for x in [5, 1, 3, 3, 9, -2]], "s double")
    assert [kth_largest(scores, "s", k) for k in (1, 2, 3, 4, 6)] == [9, 5, 3, 3, -2]


def test_pii(spark, docs, empty):
    texts = [
        "mail a.b@c.de, ip 10.0.0.256 or 10.0.0.1 card 4242 4242 4242 4242 call +1 (456) 555-2186",
        "x@y.zz+q@r.ss 1.2.3.4.5.6.7.8 \U0001f600 é a@b.c", "iban GB82 WEST 1234 5698 7654 32 account", None, "", "1" * 5000, "+1 2", "a@" * 500,
    ]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kind string")
    base = digest_spans("filter(spans, y -> y.rank < 4)")
    out = find_pii(df, keep=("kind",)).select("doc_id", "kind", F.expr(base).alias("b"), F.expr(digest_spans("spans")).alias("s"), redacted("text", "spans").alias("t"))
    rows = {r.doc_id: r for r in out.collect()}
    assert [rows[i].b for i in range(len(texts))] == [brute.pii_spans(t) for t in texts]
    assert rows[2].s == "iban:5:32" and rows[2].t == "iban [IBAN] account"
    assert rows[0].t.startswith("mail [EMAIL], ip 10.0.0.256 or [IP] card [CARD] call [PHONE]") and rows[0].kind == "k"
    assert find_pii(empty).count() == 0


def test_decontaminate(spark, empty):
    q = "If the baker sells 24 rolls to Anna for 18 euros then how many rolls does the baker sell to her in a whole week"
    other = "Every river in the old country runs from the cold hills of the north down to the warm sea in the south"
    items = spark.createDataFrame([(1, q), (2, other), (3, None), (4, "too short")], "item_id long, text string")
    pad = "some filler words before it and after it as well. "
    texts = [
        pad + q + " " + pad, pad + q.replace("24", "37").replace("18", "99").replace("Anna", "Berta"), pad + q.upper(),
        pad + "If the baker sells bread to people then they are happy in a whole week", None, "", other, "1 2 3 4 5 6 7 8 9 10 11 12 13 14",
        pad + other[:30],
    ]
    docs = _docs(spark, texts)
    got = {(r.doc_id, r.item_id): r.exact for r in find_leaks(docs, items).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 1), (6, 2)}
    assert got[(0, 1)] and not got[(1, 1)]
    # short items: leaks as whole documents only
    brief = spark.createDataFrame([(1, "Yes"), (2, "42"), (3, "the answer is 42"), (4, "it is in the sea")], "item_id long, text string")
    answers = _docs(spark, ["yes", "42", "the Answer is  42", "well yes it is 42 and the answer is 42 too", "they say it is in the sea now", None])
    assert {(r.doc_id, r.item_id) for r in find_leaks(answers, brief).collect()} == {(0, 1), (1, 2), (2, 3), (3, 3), (4, 4)}
    # 24 stands for two numbers: another text, not the item with other values
    clash = q.replace("how many rolls", "how many 24 rolls")
    two = spark.createDataFrame([(1, clash)], "item_id long, text string")
    bad = clash.replace("24", "37", 1).replace("24", "55")
    assert find_leaks(_docs(spark, [bad]), two, window=24).count() == 0
    assert find_leaks(empty, items).count() == 0 and find_leaks(docs, items.where("false")).count() == 0


def test_decontaminate_copies_with_their_own_values(spark):
    q = "Then 24 rolls go to Anna each day while 18 cakes go with Otto by cart and 7 pies stay for Emma as gifts at noon"
    other = lambda *v: q.replace("24", v[0]).replace("18", v[1]).replace("Anna", v[2]).replace("7", v[3])
    first, second = other("37", "99", "Berta", "5"), other("55", "61", "Clara", "8")
    pad = " some filler words that stand between the one and the next passage of it. "
    twin = "then 3 red hens lay eggs for the old farmer by the mill and so 4 red hens lay eggs for the old farmer by the mill"
    items = spark.createDataFrame([(1, q), (2, twin)], "item_id long, text string")
    edited = [x.replace("go with", "go along with") for x in (first, second)]
    texts = [first + pad + second, edited[0] + pad + edited[1], first + pad * 50 + " ".join(second.split()[4:17]), pad + twin.replace("3", "8").replace("4", "9")]
    got = {(r.doc_id, r.item_id): r.exact for r in find_leaks(_docs(spark, texts), items, least_share=0.2).collect()}
    assert got == {(0, 1): False, (1, 1): False, (2, 1): False, (3, 2): False}


def test_decontaminate_literal_windows(spark):
    dense, short, q = "What is 12 + 7 * 3 - 4?", "name the capital", "Which of the boys has the oldest blue bicycle at home today"
    long = "The baker in Rome sells 24 rolls to Anna and Otto for 18 euros in a week and 30 more to Emma"
    items = spark.createDataFrame(list(enumerate([dense, short, q, long])), "item_id long, text string")
    pad = "Some filler words before it, "
    texts = [pad + dense, pad + short + " of it", pad + q, pad + q.upper(), pad + long.upper(), long.lower(), "What is 13 + 8?", pad + "name a capital"]
    got = {(r.doc_id, r.item_id): r.exact for r in find_leaks(_docs(spark, texts), items).collect()}
    assert got == {k: True for k in [(0, 0), (1, 1), (2, 2), (3, 2), (4, 3), (5, 3)]}
    # with other values, inside a sentence or at its beginning
    two = spark.createDataFrame([(1, "Give Anna 24 rolls and 18 cakes for the long day"), (2, "Anna has 24 rolls and 18 cakes for the long day")], "item_id long, text string")
    texts = ["They said Give Berta 37 rolls and 99 cakes for the long day", "Berta has 37 rolls and 99 cakes for the long day"]
    got = {(r.doc_id, r.item_id): r.exact for r in find_leaks(_docs(spark, texts), two).collect()}
    assert got == {(0, 1): False, (1, 2): False}


def test_decontaminate_upper_case_copy(spark):
    q = "If the baker sells 24 rolls to Anna for 18 euros then how many rolls does the baker sell to her in a whole week"
    items = spark.createDataFrame([(1, q)], "item_id long, text string")
    assert [r.exact for r in find_leaks(_docs(spark, ["some words. " + q.upper()]), items).collect()] == [True]


def test_leak_stage_keeps_clean_rows_of_a_leaked_id(spark, tmp_path):
    import corpus_pipeline

    q = "If the baker sells 24 rolls to Anna for 18 euros then how many rolls does the baker sell to her in a whole week"
    spark.createDataFrame([(1, q)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    other = q.replace("24", "37").replace("18", "99")
    rows = [(None, q), (None, "a clean text"), (None, None), (7, other), (7, "another clean text"), (7, q.replace("24", "55")), (8, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[2], rows[4], rows[6]], key=str)


def test_warc(spark, tmp_path):
    html = '<html lang="en"><head><title>A &amp; B</title><script>x</p></script></head><body><p>One<br>two <b>three</b></p><a href="/u">l</a><!-- c --></body>'
    assert plain_text(html) == "One\ntwo three\nl" and plain_text("<script>open") == "" and plain_text("1 < 2") == "1 < 2"
    pages = spark.createDataFrame([(1, "http://a/", html, "z"), (2, None, None, "z"), (2, None, None, "z")], "page_id long, url string, html string, block string")
    rows = derivatives(pages, types=("response", "metadata", "conversion"))
    by = {(r.page_id, r.record_type): r for r in rows.collect()}
    first = by[(1, "response")]
    assert by[(1, "conversion")].refers_to == by[(1, "metadata")].refers_to == first.record_id
    assert by[(1, "conversion")].source_payload_digest == first.payload_digest
    assert b"title: A & B" in by[(1, "metadata")].block and b"outlink: /u" in by[(1, "metadata")].block
    folder = f"file://{tmp_path}/warc"
    back = read_warc(write_warc(rows, folder), folder)
    keys = ["record_id", "refers_to", "block_digest", "block"]
    assert sorted(map(str, back.select(*keys).collect())) == sorted(map(str, rows.select(*keys).collect()))
    assert derivatives(pages.where("false")).count() == 0


def test_warc_query_is_whole(spark, tmp_path):
    from lakestrata.llm.queries import op9_warc_derivatives

    spark.createDataFrame([(1, "http://a/", "<p>One</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = op9_warc_derivatives(spark, str(tmp_path)).collect()
    by = {r.record_type: r for r in rows}
    assert set(by) == {"response", "metadata", "conversion"} and bytes(by["conversion"].block) == b"One"
    assert {r.refers_to for r in rows} == {None, by["response"].record_id}


def test_suffix_order_by_few_sorts(monkeypatch):
    rnd = np.random.default_rng(3)
    stem = rnd.integers(97, 123, 500, dtype=np.uint8).tobytes()
    texts = [stem[: 400 + i] + rnd.integers(97, 123, 60, dtype=np.uint8).tobytes() for i in range(40)] + [stem, stem, b"", b"a"]
    index = RunLengthIndex(texts)
    sorted_places, real = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, **how: sorted_places.append(len(x)) or real(x, **how))
    order = RunLengthIndex._sort(index.text, index.left)
    by_rest = sorted(range(len(order)), key=lambda p: (index.text[p : p + index.left[p]].tolist(), p))
    assert order.tolist() == by_rest
    assert sum(sorted_places) <= 5 * len(order)  # doubling from 7 bytes: 8 sorts of all places


def test_run_length_index():
    r = random.Random(4)
    for _ in range(150):
        base = "".join(r.choice("ab") for _ in range(40))
        texts = list({(base[r.randint(0, 9) : r.randint(10, 40)] + "".join(r.choice("ab") for _ in range(r.randint(0, 9)))).encode() for _ in range(5)})
        length = r.randint(1, 8)
        seen = [t[i : i + length] for t in texts for i in range(len(t) - length + 1)]
        for t, ranges in zip(texts, mark_bucket(texts, length), strict=True):
            starts = {i for x in ranges for i in range(x["a"], x["b"] + 1)}
            assert starts == {i for i in range(len(t) - length + 1) if seen.count(t[i : i + length]) > 1}
    copies = RunLengthIndex([b"abcabcabd" * 20 + bytes([i]) for i in range(65, 75)])
    assert copies.n_runs < len(copies.text) / 5


@pytest.mark.parametrize("hot", [8192, 2])
def test_drop_repeats(spark, hot):
    r = random.Random(6)
    pool = ["".join(r.choice("abcdef ") for _ in range(60)) for _ in range(5)]
    texts = ["".join(r.choice([r.choice(pool), "é" + str(r.random()), "xyz" * 20]) for _ in range(r.randint(0, 4))) for _ in range(120)]
    texts += [None, "", "a" * 500, texts[3], texts[3]]
    out = drop_repeats(_docs(spark, texts), length=40, anchor=16, bucket_contexts=50, hot_contexts=hot)
    rows = out.selectExpr("doc_id", "n_bytes", "aggregate(spans, 0L, (s, x) -> s + x.end - x.start) as m", "size(spans) as k", "kept_sha256")
    got = {x[0]: tuple(x[1:]) for x in rows.collect()}
    assert [got[i] for i in range(len(texts))] == brute.repeats(texts, 40)
    assert drop_repeats(_docs(spark, texts).where("false")).count() == 0


def test_hashes_are_of_whole_texts(docs):
    ids = bpe_encode_decode(docs, WORD_BPE).where("doc_id = 0").select(F.sha2("ids", 256).alias("h"), "ids").first()
    assert ids.h == hashlib.sha256(bytes(ids.ids)).hexdigest()


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_units_are_encoded_as_whole_texts(path):
    tok, r = pieces.tokenizer(path), random.Random(5)
    cut = pieces.byte_level_split(path) if path == BYTE_BPE else pieces.space_free_split(path)
    memo = pieces.byte_level_memo(path) if path == BYTE_BPE else pieces.space_free_memo(path, 64, encode_long)
    atoms = ["a", "Word", "\xe9", "\xdf", "\u03a9", "\u03c2", "\xb2", "7", "'", "'s", "'ll", "don't", ".", ",", "!", "=\u0338", "\n", "\r", " ", "  ", "\t", "\xa0", "\u3000",
             "<|endoftext|>", "<|startoftext|>", "<|", "_", "\u5b57", "x\u0301", "\x1c", "\x85", "\u0130", "\u017f", "\u212a", "\u01c5", "\U0001f600", "x" * 70]
    texts = ["".join(r.choices(atoms, k=r.randint(0, 12))) for _ in range(6000)]
    texts += [f"a{chr(c)}b {chr(c)} 1{chr(c)}!" for c in range(1, 0x3100)]
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, want, strict=True):
        units = cut(text)
        of = memo.of(units)
        assert np.frombuffer(b"".join(of[u] for u in units), "<u4").tolist() == ids, repr(text)
