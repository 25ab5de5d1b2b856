"""Operator 1: n-gram Jaccard join by token-combination prefixes.

A document's tokens are its distinct n-word shingles (64-bit hashes).  Two
sets of sizes a, b with Jaccard >= t share at least ``ceil(t * a)`` tokens, so
under any one global token order their prefixes of ``a - ceil(t * a) + k``
tokens share at least k tokens.  The order is (class, hash): rare tokens
first, tokens of the frequent class last.

* rare tokens of the prefix are indexed alone;
* frequent tokens are only indexed as combinations of k = 2 tokens of the
  prefix extended by one, so two documents that merely share one common
  shingle never meet;
* candidates are verified on the whole sets.

The index runs in rounds.  Round 0 knows no frequent token; it links copies to
the least set of their entries and finds the tokens that more than
``rare_limit`` different components hold.  These are the frequent class of
round 1, which indexes every set and pairs them.  Should tokens further back
turn out frequent, the sets that hold them are indexed once more, unless
pairing them at once makes few rows; a pair that a
round could have missed has all its shared single entries frequent, so both
its sets are indexed again.  Common combinations are always paired, and the
last round pairs whatever is left, so nothing is dropped.

Groups of copies: equal sets are one set from the start.  In every round each
set is first checked against the least set of its index entries (one row per
set and entry, never all pairs); sets already in one component are not paired
again, which loses no component.  While frequent entries remain and it finds
links, each set is also checked against a few sets drawn for each of its
frequent entries, so a large group of near copies is one component before its
sets are paired.  Pairs that share several of the commonest entries are made
once, not once for each.

Defined cases: null or wordless text has n_shingles 0 and is its own
component; a text of fewer than n words is one shingle; equal ids are
separate rows and the component id is the least id of all; a null id stays
null and takes the least non-null id of its component, if any; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .shared import as_long, bit_filter, columns, components, few_tasks, in_filter, ship, stored

U64 = np.uint64
COMMON_BITS = 1 << 25
RARE_LIMIT = 24
MAX_ROUNDS = 3
CELL_PAIRS = 1000
PIVOTS = 4
PIVOT_TURNS = 4
SLOT_BITS, SLOT_WORDS = 63, 4
#: hash values at which every set's number of smaller tokens is kept, up to 20/64 of all values
CUTS = np.arange(1, 21, dtype=U64) << U64(58)


def _members(n: int, num: int, den: int):
    """Size and key of each document's set; ranks: tokens up to each of CUTS; cut: the CUTS inside the prefix."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, data, off in K.slices(batch.column("text")):
                sets, b = K.shingle_sets(data, off, n)
                keys = K.set_keys(sets, b)
                ranks, cut = np.zeros((j - i, len(CUTS)), np.int32), np.zeros(j - i, np.int32)
                for r in np.flatnonzero(np.diff(b)).tolist():
                    h = sets[b[r] : b[r + 1]]
                    ranks[r] = np.searchsorted(h, CUTS, "right")
                    cut[r] = np.searchsorted(CUTS, h[len(h) - -(-num * len(h) // den)], "right")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        batch.column("text_hash").slice(i, j - i),
                        pa.array(np.diff(b).astype(np.int64)),
                        pa.array(as_long(keys)),
                        pa.array(cut),
                        pa.FixedSizeListArray.from_arrays(pa.array(ranks.ravel()), len(CUTS)).cast(pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set_key", "cut", "ranks"],
                )

    return K.trimmed(run)


def _chosen(batch: pa.RecordBatch, filt: np.ndarray) -> pa.RecordBatch:
    """The rows whose text hash the filter may hold."""
    return batch.filter(pa.array(in_filter(filt, batch.column("text_hash").to_numpy().view(U64))))


def _index(n: int, num: int, den: int, todo, common):
    """Index entries of each distinct set: (token, set_key, meta); of the texts that ``todo`` holds, if given.

    ``meta`` is flagged << 32 | size << 1 | whether a combination; flagged
    counts the tokens up to the set's last cut that the filter ``common``
    keeps from the single entries, rightly or not."""

    def run(batches):
        todo_v = todo.value if todo is not None else None
        common_v = common.value if common is not None else None
        seen: set[int] = set()
        for batch in batches:
            if todo_v is not None:
                batch = _chosen(batch, todo_v)
            for _, _, data, off in K.slices(batch.column("text")):
                sets, b = K.shingle_sets(data, off, n)
                keys = K.set_keys(sets, b)
                toks, lens, rows, meta = [], [], [], []
                flag = in_filter(common_v, sets) if common_v is not None else None
                for r in np.flatnonzero(np.diff(b)).tolist():
                    key = int(keys[r])
                    if key in seen:
                        continue
                    seen.add(key)
                    h = sets[b[r] : b[r + 1]]
                    size = len(h)
                    p = size - -(-num * size // den) + 1
                    if flag is None:
                        toks.append(h[:p])
                        meta.append(np.full(p, size << 1))
                    else:
                        f = flag[b[r] : b[r + 1]]
                        q = min(size, p + 1)
                        cut = int(np.searchsorted(CUTS, h[p - 1], "right"))
                        flagged = int(f[: np.searchsorted(h, CUTS[cut - 1], "right")].sum()) if cut else 0
                        about = (flagged << 32) + (size << 1)
                        rare = h[~f][:q]
                        toks.append(rare)
                        lens.append(len(rare))
                        rows.append(r)
                        meta.append(np.full(len(rare), about))
                        hot = h[f][: q - len(rare)]
                        x, y = np.triu_indices(len(hot), 1)
                        toks.append(K.mix(hot[x] * U64(K._LANES[20]) + hot[y] * U64(K._LANES[21])))
                    lens.append(len(toks[-1]))
                    rows.append(r)
                    if flag is not None:
                        meta.append(np.full(len(toks[-1]), about + 1))
                if not toks:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(as_long(np.concatenate(toks))),
                        pa.array(as_long(np.repeat(keys[np.array(rows)], np.array(lens)))),
                        pa.array(np.concatenate(meta).astype(np.int64)),
                    ],
                    names=["token", "set_key", "meta"],
                )

    return K.trimmed(run)


def _wanted_sets(n: int, wanted):
    def run(batches):
        wanted_v = wanted.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, off in K.slices(_chosen(batch, wanted_v).column("text")):
                sets, b = K.shingle_sets(data, off, n)
                keys = K.set_keys(sets, b)
                out_k, out_s = [], []
                for r in np.flatnonzero(np.diff(b)).tolist():
                    if int(keys[r]) not in seen:
                        seen.add(int(keys[r]))
                        out_k.append(keys[r])
                        out_s.append(sets[b[r] : b[r + 1]].tobytes())
                if out_k:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(as_long(np.array(out_k, dtype=U64))), pa.array(out_s, pa.binary())],
                        names=["set_key", "tokens"],
                    )

    return K.trimmed(run)


def _similar(num: int, den: int):
    def run(sets: pa.Table, pairs: pa.Table) -> pa.Table:
        tokens = {k: np.frombuffer(t.as_buffer(), U64) for k, t in zip(sets["set_key"].to_pylist(), sets["tokens"], strict=True)}
        keep = []
        for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True):
            s, t = tokens[a], tokens[b]
            if len(s) > len(t):
                s, t = t, s
            if den * len(s) < num * len(t):
                keep.append(False)
                continue
            at = np.searchsorted(t, s)
            both = int(np.count_nonzero(t[np.minimum(at, len(t) - 1)] == s))
            keep.append(den * both >= num * (len(s) + len(t) - both))
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _texts(sets: DataFrame, key: str, stats: DataFrame) -> DataFrame:
    """The hash of one text of each set."""
    return sets.join(stats.select("set_key", "text_hash"), sets[key] == stats["set_key"]).select("text_hash")


def _dealt(pairs: DataFrame, cell_pairs: int) -> DataFrame:
    """Pairs (a, b) with the cell they are verified in.

    Cells are dealt by a.  An a with more than ``cell_pairs`` pairs has cells
    of its own, as many as hold about ``cell_pairs`` of them, dealt by b."""
    cells = max(16, pairs.count() // cell_pairs)
    many = pairs.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > cell_pairs)
    many = many.select(F.col("a").alias("many a"), F.ceil(F.col("n") / cell_pairs).alias("own"))
    cell = f"if(own is null, pmod(xxhash64(a), {cells}), xxhash64(a, pmod(xxhash64(b), own)))"
    return pairs.join(many, pairs["a"] == many["many a"], "left").select("a", "b", F.expr(cell).alias("cell"))


def _verify(docs: DataFrame, stats: DataFrame, pairs: DataFrame, n: int, num: int, den: int, name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold.

    Only texts of these sets, one of each, are cut into shingles.  A set goes to a cell once, however many of the cell's pairs hold it.  A
    cell holds some thousand sets, however many pairs one set is in: only that
    set itself is repeated in each of its cells."""
    spark = docs.sparkSession
    pairs = stored(pairs.select("a", "b"), f"{name}-pairs")
    rows = 2 * pairs.count()
    pairs = stored(few_tasks(_dealt(pairs, CELL_PAIRS), rows), f"{name}-dealt")
    nodes = few_tasks(pairs.select("cell", F.explode(F.array("a", "b")).alias("k")).distinct().selectExpr("cell + 0 as cell", "k"), rows)
    wanted = few_tasks(_texts(nodes.select("k").distinct(), "k", stats), rows)
    wanted = spark.sparkContext.broadcast(bit_filter(wanted, "text_hash"))
    sets = docs.select("text", "text_hash").mapInArrow(_wanted_sets(n, wanted), "set_key long, tokens binary")
    sets = sets.dropDuplicates(["set_key"]).join(nodes, F.col("set_key") == F.col("k")).select("cell", "set_key", "tokens")
    sets = few_tasks(sets, rows)
    similar = sets.groupBy("cell").cogroup(pairs.groupBy("cell")).applyInArrow(_similar(num, den), "a long, b long")
    similar = stored(few_tasks(similar, rows), f"{name}-links")
    wanted.destroy()
    return similar


def _slotted(entries: DataFrame) -> tuple[DataFrame, dict[bool, list[int]]]:
    """Entries with a slot for those of the commonest tokens, and the words of slots of (False) single tokens and (True) combinations.

    ``m0``.. are the slots that the entry's set holds, ``earlier0``.. those
    before the entry's own; both are 0 for the other entries.  Two sets share
    the slots that both hold, and meet in the first of them."""
    rows = entries.count()
    top = entries.groupBy("token").agg(F.max("comps").alias("comps"), F.max("combo").alias("combo"))
    top = top.orderBy(F.desc("comps"), "token").limit(SLOT_WORDS * SLOT_BITS).collect()
    words = {kind: [sum(1 << i for i, r in enumerate(top[w * SLOT_BITS : (w + 1) * SLOT_BITS]) if r["combo"] == kind) for w in range(SLOT_WORDS)] for kind in (False, True)}
    slots = entries.sparkSession.createDataFrame([(r["token"], i) for i, r in enumerate(top)], "token long, slot int")
    entries = entries.join(F.broadcast(slots), "token", "left")
    held = [F.expr(f"bit_or(if(slot div {SLOT_BITS} = {w}, shiftleft(1L, slot % {SLOT_BITS}), 0L)) as m{w}") for w in range(SLOT_WORDS)]
    held = entries.where("slot is not null").groupBy(F.col("set_key").alias("holder")).agg(*held)
    entries = few_tasks(entries.join(held, F.expr("slot is not null and set_key = holder"), "left"), rows)
    before = [f"if(slot div {SLOT_BITS} > {w}, -1L, if(slot div {SLOT_BITS} = {w}, shiftleft(1L, slot % {SLOT_BITS}) - 1, 0L))" for w in range(SLOT_WORDS)]
    marks = [x for w in range(SLOT_WORDS) for x in (f"coalesce(m{w}, 0L) as m{w}", f"coalesce(m{w} & {before[w]}, 0L) as earlier{w}")]
    return entries.selectExpr("token", "set_key", "comp", "n", "combo", "flagged", "slot", *marks), words


def _pivoted(often: DataFrame, num: int, den: int, turn: int) -> DataFrame:
    """Pairs (a, b) of a set and one of the PIVOTS sets drawn for each of its frequent entries.

    They share three tenths of a prefix, so a set has at most 3.4 * PIVOTS
    such pairs by its own entries, however many sets hold these."""
    drawn = [
        F.min(F.struct(F.xxhash64("set_key", F.lit(PIVOTS * turn + i)).alias("by"), "set_key", "comp", "n")) for i in range(PIVOTS)
    ]
    pivots = often.groupBy("token").agg(F.array_distinct(F.array(*drawn)).alias("pivots"))
    p, rows = F.expr(f"n - ceil({num} * n / {den}) + 1"), PIVOTS * often.count()
    fits = f"x -> x.comp <> comp and {den} * least(n, x.n) >= {num} * greatest(n, x.n)"
    near = (
        few_tasks(often.join(pivots, "token"), rows)
        .select("set_key", p.alias("p"), F.explode(F.expr(f"filter(pivots, {fits})")).alias("x"))
        .groupBy(F.least("set_key", "x.set_key").alias("a"), F.greatest("set_key", "x.set_key").alias("b"), F.col("set_key").alias("of"))
        .agg(F.count("*").alias("c"), F.max("p").alias("p"))
        .where("10 * c >= 3 * p")
        .select("a", "b")
    )
    return few_tasks(few_tasks(near, rows).distinct(), rows)


def _candidates(
    rare: DataFrame, often: DataFrame, stats: DataFrame, num: int, den: int, extended: int
) -> DataFrame:
    """Pairs of sets of different components that share entries, as far as the whole sets may reach the threshold.

    Up to a hash value X inside both round-0 prefixes, two sets share only
    what their single entries show, but for tokens found frequent in this round
    (``often``) and those that the filter flagged, whether frequent or mere
    collisions: of these at most the smaller number that a set has up to its
    own last cut.  Beyond X at most the smaller number of tokens left.
    Likewise, the prefixes of this round share what the entries show, frequent
    tokens by their number of common combinations, but for those found
    frequent in this round (``often``), and at most the rest of a set besides.

    A pair that shares many of the commonest entries is one row, not one of each: see :func:`_slotted`."""
    rare, combos = _slotted(rare)
    found = often.groupBy(F.col("set_key").alias("finder")).agg(F.count("*").alias("g"))
    rare = rare.join(found, rare["set_key"] == found["finder"], "left").withColumn("g", F.expr("coalesce(g, 0L)"))
    bits = range(SLOT_WORDS)
    cols = ["token", "set_key as {0}", "comp as c{0}", "n as n{0}", "flagged as f{0}", "g as g{0}", *(f"m{w} as m{w}{{0}}" for w in bits)]
    left = rare.selectExpr("combo", "slot", *(x.format("a") for x in cols), *(f"earlier{w}" for w in bits))
    right = rare.selectExpr(*(x.format("b") for x in cols))
    first = " | ".join(f"(earlier{w} & m{w}b)" for w in bits)
    shared = {k: " + ".join(f"bit_count(m{w}a & m{w}b & {m[w]}L)" for w in bits) for k, m in combos.items()}
    hot = f"if(cc > 0, ceil((1 + sqrt(1 + 8 * cc)) / 2), {extended})"
    by_prefix = f"{hot} + ceil({num} * greatest(na, nb) / {den}) - {1 + extended}"
    enough = f"ceil({num} * (na + nb) / {num + den})"
    pairs = (
        left.join(right, "token")
        .where(f"a < b and ca <> cb and {den} * least(na, nb) >= {num} * greatest(na, nb) and ({first}) = 0")
        .groupBy("a", "b")
        .agg(
            F.sum(F.expr(f"if(slot is null, if(combo, 0, 1), {shared[False]})")).alias("c"),
            F.sum(F.expr(f"if(slot is null, if(combo, 1, 0), {shared[True]})")).alias("cc"),
            F.max("na").alias("na"), F.max("nb").alias("nb"),
            F.max(F.expr("least(fa, fb)")).alias("f"), F.max(F.expr("least(ga, gb)")).alias("g"),
        )
        .where(f"c + g + {by_prefix} >= {enough}")  # the pairs left meet their sets' ranks
    )
    for x in "ab":
        pairs = pairs.join(stats.selectExpr("set_key as " + x, "cut as cut_" + x, "ranks as ranks_" + x), x)
    at = "least(cut_a, cut_b)"
    by_rank = f"if({at} = 0, least(na, nb), least(na - element_at(ranks_a, {at}), nb - element_at(ranks_b, {at})))"
    return pairs.where(f"c + g + f + {by_rank} >= {enough}")


def ngram_jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: tuple[int, int] = (75, 100),
    rare_limit: int = RARE_LIMIT,
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, class (see the module).

    ``class`` names the component also where ids are null; it is null without words."""
    num, den = threshold
    spark = ship(docs.sparkSession)
    docs = columns(docs, doc_id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    members = stored(
        docs.mapInArrow(
            _members(n, num, den), f"doc_id {id_type}, text_hash long, n_shingles long, set_key long, cut int, ranks array<int>"
        ),
        "op1-members",
    )

    stats = members.where("n_shingles > 0").dropDuplicates(["set_key"]).select("set_key", "text_hash", "cut", "ranks")
    todo, common, frequent, turn = None, None, None, 0
    for level in range(max_rounds):
        rows = docs.select("text", "text_hash").mapInArrow(_index(n, num, den, todo, common), "token long, set_key long, meta long")
        # one shuffle by token; entries that only one set has end here
        span = rows.repartition("token").selectExpr(
            "*", "min(set_key) over (partition by token) as lo", "max(set_key) over (partition by token) as hi"
        )
        entries = span.where("lo < hi").drop("hi").distinct().selectExpr(
            "token", "set_key", "lo", "(meta & 4294967295) >> 1 as n", "(meta & 1) = 1 as combo", "meta >> 32 as flagged"
        )
        entries = stored(entries, "op1-entries")
        n_entries = entries.count()
        for filt in (todo, common):
            if filt is not None:
                filt.destroy()

        if level == 0:  # each set against the least set of its entries
            p = F.expr(f"n - ceil({num} * n / {den}) + 1")
            star = (
                entries.where("set_key <> lo")
                .groupBy(F.col("lo").alias("a"), F.col("set_key").alias("b"))
                .agg(F.count("*").alias("c"), F.max(p).alias("p"))
                .where("10 * c >= 3 * p")
            )
            links = _verify(docs, stats, star, n, num, den, "op1-star")

        while True:
            # the rest: entries that different components share
            comp = components(links, "op1-cc")
            e = few_tasks(entries.drop("lo").join(comp, entries["set_key"] == comp["node"], "left"), n_entries).select(
                "token", "set_key", "n", "combo", "flagged", F.coalesce("comp", "set_key").alias("comp")
            )
            by_token = few_tasks(e.groupBy("token", "comp").agg(F.lit(1).alias("x")), n_entries)
            by_token = by_token.groupBy("token").agg(F.count("*").alias("comps")).where("comps > 1")
            e = stored(few_tasks(e.join(by_token, "token"), n_entries), "op1-shared")
            often = e.where((F.col("comps") > rare_limit) & ~F.col("combo"))
            # frequent entries are paired at once if that makes few rows, else demoted
            cost = often.select("token", "comps").distinct().agg(F.coalesce(F.sum(F.expr("comps * comps / 2")), F.lit(0))).first()[0]
            few = 16 * cost <= n_entries
            if few or turn == PIVOT_TURNS:
                break
            # large groups of near copies: each set against few sets of its frequent entries
            near = stored(_pivoted(often, num, den, turn), "op1-near")
            found = _verify(docs, stats, near, n, num, den, "op1-pivot")
            tried, hits = near.count(), found.count()
            if hits:
                links = stored(links.unionAll(found), "op1-links")
            turn = turn + 1
            if 20 * hits <= tried:  # no such groups are left
                turn = PIVOT_TURNS
                break
        last = level == max_rounds - 1 or few
        often = often.where(F.lit(False)) if last else often
        if level > 0 or last:
            rare = e if last else e.where((F.col("comps") <= rare_limit) | F.col("combo"))
            pairs = _candidates(rare, often, stats, num, den, int(common is not None))
            links = stored(links.unionAll(_verify(docs, stats, pairs, n, num, den, "op1-cross")), "op1-links")
        if last:
            break
        tokens = few_tasks(often.select("token").distinct(), n_entries)
        frequent = stored(tokens if frequent is None else frequent.unionAll(tokens), "op1-frequent")
        if level > 0:  # round 1 indexes every set, later ones those that met a new frequent token
            todo = spark.sparkContext.broadcast(bit_filter(_texts(often.select("set_key").distinct(), "set_key", stats), "text_hash"))
        common = spark.sparkContext.broadcast(bit_filter(frequent, "token", COMMON_BITS))

    comp = components(links, "op1-cc")
    m = members.join(comp, members["set_key"] == comp["node"], "left").withColumn(
        "class", F.when(F.col("n_shingles") > 0, F.coalesce("comp", "set_key"))
    )
    least = m.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least_id"))
    return m.join(least, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", F.expr("if(class is null, doc_id, least_id)").alias("component_id"), "class"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs without near copies: of each component the row of the least id.

    A null id stands after all others; rows equal in id and text are one row;
    documents without words are copies of nothing and stay."""
    classes = ngram_jaccard_join(docs, id_col, text_col, **how)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    chosen = classes.where("class is not null").groupBy("class").agg(F.min(row).alias("row")).select("row.doc_id", "row.text_hash")
    alone = classes.where("class is null").select("doc_id", "text_hash").distinct()
    chosen = chosen.unionAll(alone).select(F.col("doc_id").alias("chosen id"), F.col("text_hash").alias("chosen text"))
    hashed = docs.withColumn("text hash", F.xxhash64(docs[text_col].cast("string")))
    kept = hashed.join(chosen, hashed[id_col].eqNullSafe(chosen["chosen id"]) & (hashed["text hash"] == chosen["chosen text"]), "left_semi")
    return kept.dropDuplicates([id_col, "text hash"]).select(*(F.col(f"`{c}`") for c in docs.columns))
