"""Line deduplication against plain Python, on odd input and with many filter ranges."""

import random

import numpy as np
import pytest

from lakestrata.llm import line_dedup as L

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, least=10):
    """(doc_id, text) rows -> sorted (doc_id, lines, dropped, kept)."""
    rank = {None: (1, 0)}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    first = {k: min(v, key=lambda i: rank.get(i, (0, i))) for k, v in holders.items() if len(v) > 1}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in first or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def _rows(seed=3, n=150):
    r = random.Random(seed)
    common = [" ".join(r.choice(["ab", "Çé", "the", "xyz", "日本"]) for _ in range(r.randint(1, 9))) for _ in range(40)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(r.randint(0, 12)):
            line = r.choice(common) if r.random() < 0.5 else f"own line {r.random()}"
            lines.append(r.choice(["", " ", "\t", "\x0b"]) + r.choice([line, line.upper(), line.title()]) + r.choice(["", "\r", "  "]))
        rows.append((i, "\n".join(lines)))
    hot = "a line that a third of all documents holds"
    rows += [(1000 + i, f"{hot}\n{hot}\nnumber {i} of them all") for i in range(n // 2)]
    rows += [(None, hot + "\nshared by null ids only"), (None, "shared by null ids only\nand so on and on")]
    rows += [(7, "a second row of id seven\nown words of it here"), (7, "a second row of id seven"), (2000, None), (2001, "")]
    rows += [(2002, "\n\n"), (2003, "x" * 30_000 + "\n" + "short\n" * 500), (2004, "X" * 30_000 + " "), (2005, "nine char\nNINE CHAR"), (2006, "nine char")]
    return rows


SCHEMA = "doc_id long, text string, mark string, keys int, kept string, hi int"


@pytest.mark.parametrize("max_bits", [L.MAX_BITS, 1 << 17])
def test_line_dedup(spark, max_bits):
    rows = _rows()
    df = spark.createDataFrame([(*r, "m", 1, "k", 2) for r in rows], SCHEMA).repartition(5)
    got = sorted([tuple(r) for r in L.line_dedup(df, max_bits=max_bits).select("doc_id", "n_lines", "n_dropped", "kept").collect()], key=str)
    assert got == brute(rows)


def test_full_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(L, "LEAST_BITS", 64)
    rows = _rows(seed=4)
    df = spark.createDataFrame([(*r, "m", 1, "k", 2) for r in rows], SCHEMA).repartition(4)
    got = sorted([tuple(r) for r in L.line_dedup(df, bits_per_key=0, max_bits=64).collect()], key=str)
    assert got == brute(rows)


def test_empty_table_and_string_ids(spark):
    assert L.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([("b", "one long line here"), ("a", "One long line here "), (None, None)], "doc_id string, text string")
    assert sorted([tuple(r) for r in L.line_dedup(df).collect()], key=str) == sorted(
        [("b", 1, 1, ""), ("a", 1, 0, "One long line here "), (None, 1, 0, "")], key=str
    )


def test_only_suspects_are_shuffled(spark):
    rows = [(i, f"a line of document {i} alone\nand a second one {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = df.withColumnRenamed("text", "t").selectExpr("doc_id", "t as text", "xxhash64(doc_id, t) as mark")
    keys = keys.mapInArrow(L._keys(10, 1), "part long, doc_id long, mark long, keys binary")
    # 600 keys set 1,200 bits of a million: hardly two tasks share one
    assert int(np.bitwise_count(L.twice_filter(keys, 1 << 20)).sum()) < 20
