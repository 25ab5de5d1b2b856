"""Operator 8: benchmark decontamination by template canonicalisation.

A text becomes a template: words lower-cased, numbers, names (capitalised
words that do not begin a sentence) and units after numbers replaced by typed
placeholders.  Windows of ``window`` template tokens of documents and
benchmark items are hash-joined, so a question with other numbers or names
still meets its item.  A met pair of document and item is a leak only if its
slots are consistent: each value the item has in a slot kind stands for one
value of the document, and the other way round.  Windows of nearly nothing
but placeholders are not used.

A document may hold several copies of an item, each with values of its own.
The met windows of one copy stand at one distance from the item's, or at near
ones where words were put in or left out.  Slots and share are therefore
judged three ways: over the windows of each distance, of each band of near
distances, and over all of the pair.  One way that holds makes the pair a leak.

The first word of a sentence counts as written, so where a window begins with
one it is also indexed as if that word were a name, whose slot is then free:
a copy may stand inside a sentence, or begin one.

Besides, every item's case-folded words are indexed as they are, in windows
or whole if it is short, whatever share of them are placeholders.  These
literal windows need no slot check; a pair that has ``least_share`` of them is
a leak, and the larger of the two shares is reported.  An item of fewer than
``TELLING_WORDS`` words ("Yes", "42") says nothing about a document that holds it
among others: it is a leak only where it is the whole document.

The document side is thinned by a fixed-size bit filter of the benchmark's
window hashes before the join; the join itself is exact on the hash.

A leak needs ``least_share`` of the item's windows.

A row of documents is its id and the hash of its text: rows of one id, or
without one, are judged each for itself; rows equal in both are one.

Defined cases: null or wordless texts and items meet nothing; items shorter
than the window count as one window, as a template only if they have at least
``LEAST_WORDS`` tokens; equal items are one row per item id; null ids are kept; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .shared import as_long, bit_filter, columns, in_filter, ship, stored

U64 = np.uint64
WINDOW = 12
LEAST_WORDS = 5
TELLING_WORDS = 3
LEAST_LITERAL = 0.5
LEAST_SHARE = 0.25

# unit words that a number may have (fixed values)
UNITS = """
g kg mg gram grams kilogram kilograms tonne tonnes ton tons lb lbs pound pounds oz ounce ounces
m km cm mm metre metres meter meters kilometre kilometres kilometer kilometers centimetres centimeters mile miles
foot feet ft inch inches yard yards s sec second seconds min minute minutes h hr hour hours day days week weeks
month months year years l ml litre litres liter liters gallon gallons dollar dollars cent cents euro euros usd eur
percent degrees degree watt watts volt volts joule joules byte bytes kb mb gb
""".split()

_KIND = np.zeros(256, dtype=np.uint8)  # 1 letter, 2 digit
_KIND[48:58] = 2
_KIND[97:123] = _KIND[65:91] = 1
_KIND[128:] = 1
_END = np.zeros(256, dtype=bool)  # what ends a sentence
_END[[10, 13, 33, 46, 58, 63]] = True
NUMBER, NAME, UNIT = (U64(x) for x in (0xA1, 0xA2, 0xA3))
LITERAL = U64(0x94D049BB133111EB)


def _unit_hashes() -> np.ndarray:
    data, off = K.text_buffers(pa.array(UNITS))
    return np.sort(K.span_hash(K.prefix_hash(data), off[:-1], off[1:]))


_UNIT_HASHES = _unit_hashes()


def template(low: np.ndarray, low_off: np.ndarray, raw: np.ndarray, raw_off: np.ndarray):
    """(template hash, literal hash, row, whether a word that begins a sentence) of every token; a placeholder's two hashes differ."""

    def tokens(data, off):
        kind = _KIND[data]
        if len(kind) > 2:  # a point or comma inside a number
            inner = (data == 46) | (data == 44)
            inner[1:-1] &= (kind[:-2] == 2) & (kind[2:] == 2)
            inner[[0, -1]] = False
            kind = np.where(inner, 2, kind)
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[off] = True
        change = np.ones(len(data), dtype=bool)
        change[1:] = (kind[1:] != kind[:-1]) | edge[1 : len(data)]
        s = np.flatnonzero(change)
        e = np.append(s[1:], len(data)) if len(s) else s
        ok = kind[s] > 0
        return s[ok], e[ok], kind

    s, e, kind = tokens(low, low_off)
    row = np.searchsorted(low_off, s, "right") - 1
    literal = K.span_hash(K.prefix_hash(low), s, e)
    form = literal.copy()
    begins = np.zeros(len(s), dtype=bool)
    if not len(s):
        return form, literal, row, begins
    number = kind[s] == 2
    at = np.minimum(np.searchsorted(_UNIT_HASHES, literal), len(_UNIT_HASHES) - 1)
    unit = ~number & (_UNIT_HASHES[at] == literal)
    unit[1:] &= number[:-1] & (row[1:] == row[:-1])
    unit[0] = False
    rs, _, _ = tokens(raw, raw_off)
    name = np.zeros(len(s), dtype=bool)
    if len(rs) == len(s):  # lower-casing keeps the tokens
        first = raw[rs]
        second = raw[np.minimum(rs + 1, len(raw) - 1)]
        name = (first >= 65) & (first <= 90) | (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        # not where a sentence begins: after the last token's end there is a sentence end, or the text begins
        ends = np.concatenate([[0], np.cumsum(_END[raw])])
        fresh = np.ones(len(s), dtype=bool)
        fresh[1:] = (row[1:] != row[:-1]) | (ends[rs[1:]] > ends[rs[:-1]])
        name &= ~fresh & ~number
        begins = fresh & ~number & ~unit
    form[number], form[unit], form[name & ~unit] = NUMBER, UNIT, NAME
    return form, literal, row, begins


def _window_sums(h: np.ndarray, row: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, sum) of every window of w tokens of one row; mix() of a sum is its hash."""
    m = max(0, len(h) - w + 1)
    acc = np.zeros(m, dtype=U64)
    for j in range(w):
        acc += h[j : j + m] * U64(K._LANES[j])
    at = np.flatnonzero(row[:m] == row[w - 1 :]) if m else np.zeros(0, np.int64)
    return at, acc[at]


def _windows(lengths: list[int], whole_below: int, filt):
    """Windows of tokens: id, hash to meet by, own hash, place, tokens, whether literal, whether its first slot is free, slots (place, kind, value)."""

    def run(batches):
        for batch in batches:
            ids, text_hashes = batch.column("id"), batch.column("text_hash")
            col = batch.column("text")
            text = pc.fill_null(col.cast(pa.large_string()), "")
            pos = 0
            while pos < len(text):
                # rows of about a slice of text
                _, off = K.text_buffers(text)
                end = max(pos + 1, int(np.searchsorted(off, off[pos] + K.SLICE_BYTES, "right")) - 1)
                part = text.slice(pos, end - pos)
                raw, raw_off = K.text_buffers(part)
                low, low_off = K.text_buffers(pc.utf8_lower(part))
                raw, raw_off = raw[raw_off[0] : raw_off[-1]], raw_off - raw_off[0]
                low, low_off = low[low_off[0] : low_off[-1]], low_off - low_off[0]
                form, literal, row, begins = template(low, low_off, raw, raw_off)
                slot = form != literal
                per = np.bincount(row, minlength=end - pos)
                first = np.concatenate([[0], np.cumsum(per)])
                filled = np.concatenate([[0], np.cumsum(slot)])
                out = []

                def wanted(h, at, w, row=row, per=per):
                    if filt is None:  # benchmark side: an item has windows of one length
                        return per[row[at]] == w if w < whole_below else per[row[at]] >= whole_below
                    return in_filter(filt.value, h)

                for w in lengths:
                    at, acc = _window_sums(literal, row, w)
                    if not len(at):
                        continue
                    h = K.mix(acc ^ LITERAL)
                    ok = wanted(h, at, w)
                    if w < TELLING_WORDS:  # too short to tell anything but as a whole document
                        ok &= per[row[at]] == w
                    # each literal window once a row
                    for x, r in set(zip(h[ok].tolist(), row[at[ok]].tolist(), strict=True)):
                        out.append((pos + r, x, x, 0, w, True, False, [], [], []))
                    if w < LEAST_WORDS:
                        continue
                    at, acc = _window_sums(form, row, w)
                    dense = (filled[at + w] - filled[at]) > (1 - LEAST_LITERAL) * w
                    own = K.mix(acc)
                    for free in (False, True):
                        h = K.mix(acc + (NAME - form[at]) * U64(K._LANES[0])) if free else own
                        ok = ~dense & wanted(h, at, w)
                        if free:
                            ok &= begins[at]
                        for x, i, r, a in zip(h[ok].tolist(), own[ok].tolist(), row[at[ok]].tolist(), at[ok].tolist(), strict=True):
                            k = np.flatnonzero(slot[a : a + w])
                            if free:
                                k = np.concatenate([[0], k])
                            kinds = form[a + k].tolist()
                            values = as_long(literal[a + k]).tolist()
                            out.append((pos + r, x, i, a - int(first[r]), w, False, free, k.tolist(), kinds, values))
                if out:
                    r, x, i, a, w, lit, free, k, kinds, values = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(r)), text_hashes.take(pa.array(r)), pa.array(as_long(np.array(x, dtype=U64))), pa.array(as_long(np.array(i, dtype=U64))),
                            pa.array(a, pa.int64()), pa.array(w, pa.int32()), pa.array(lit), pa.array(free),
                            pa.array(k, pa.list_(pa.int32())), pa.array([[y if y < 256 else 0 for y in z] for z in kinds], pa.list_(pa.int32())),
                            pa.array(values, pa.list_(pa.int64())),
                        ],
                        names=["id", "text_hash", "h", "own", "place", "tokens", "literal", "free", "slots", "kinds", "filled"],
                    )
                pos = end

    return K.trimmed(run)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left with the other columns of right; null keys are equal."""
    right = right.select(*(F.col(c).alias("right " + c if c in keys else c) for c in right.columns))
    same = [left[c].eqNullSafe(right["right " + c]) for c in keys]
    return left.join(right, reduce(and_, same), how).drop(*("right " + c for c in keys))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """One row per leak: doc_id, item_id, n_windows, item_windows, share, exact, text_hash (xxhash64 of the document's text)."""
    spark = ship(docs.sparkSession)
    docs, items = columns(docs, id=id_col, text=text_col), columns(items, id=item_col, text=item_text_col)
    docs, items = (df.withColumn("text_hash", F.xxhash64(F.col("text").cast("string"))) for df in (docs, items))

    def schema(df):
        kind = df.schema["id"].dataType.simpleString()
        return f"id {kind}, text_hash long, h long, own long, place long, tokens int, literal boolean, free boolean, slots array<int>, kinds array<int>, filled array<long>"

    short = list(range(1, window + 1))
    b = stored(items.mapInArrow(_windows(short, window, None), schema(items)), "op8-items")
    lengths = sorted(r[0] for r in b.select("tokens").distinct().collect())  # at most `window` rows
    b = b.select(
        F.col("id").alias("item_id"), "h", "literal", "own", F.col("free").alias("item_free"), F.col("place").alias("item_place"),
        F.col("filled").alias("item_filled"), "kinds",
    )
    totals = b.groupBy("item_id", "literal").agg(F.countDistinct("own").alias("item_windows"))
    filt = spark.sparkContext.broadcast(bit_filter(b, "h"))
    d = docs.mapInArrow(_windows(lengths, window, filt), schema(docs)).select(
        F.col("id").alias("doc_id"), "text_hash", "h", "free", "place", "filled"
    )
    met = stored(d.join(b, "h"), "op8-met")
    literal, met = met.where("literal"), met.where("not literal")
    # the windows of one copy: of one distance, of a band of near distances, or all of the pair
    pair = ["doc_id", "text_hash", "item_id"]
    met = met.withColumn("shift", F.col("place") - F.col("item_place"))
    by_shift = Window.partitionBy(*pair).orderBy("shift")
    bands = met.select(*pair, "shift").distinct().withColumn("apart", F.col("shift") - F.lag("shift").over(by_shift) > window)
    bands = bands.select(*pair, "shift", F.count(F.when(F.col("apart"), 1)).over(by_shift).alias("band"))
    met = _joined(met, bands, [*pair, "shift"]).withColumn("copy", F.explode(F.expr("array('s' || shift, 'b' || band, 'all')")))
    copy = [*pair, "copy"]
    # consistent slots: one document value for an item's value of a kind, and the other way round
    slots = met.where("size(filled) > 0").select(*copy, F.col("free") | F.col("item_free"), F.posexplode(F.arrays_zip("kinds", "item_filled", "filled"))).toDF(
        *copy, "free", "at", "s"
    ).where("at > 0 or not free").select(
        *copy, F.col("s.kinds").alias("kind"), F.col("s.item_filled").alias("x"), F.col("s.filled").alias("y")
    )
    slots = slots.distinct()
    twice = (
        slots.groupBy(*copy, "kind", "x").agg(F.count("*").alias("n")).where("n > 1").select(*copy)
        .unionAll(slots.groupBy(*copy, "kind", "y").agg(F.count("*").alias("n")).where("n > 1").select(*copy))
        .distinct().withColumn("clash", F.lit(True))
    )
    copies = (
        met.groupBy(*copy, "own").agg(F.max(F.expr("filled = item_filled")).alias("same"))
        .groupBy(*copy).agg(
            F.count("*").alias("n_windows"), F.count(F.when(F.col("same"), 1)).alias("n_same"), F.min("same").alias("exact")
        )
    )
    copies = _joined(copies, twice, copy, "left")
    # windows that agree word for word need no slot check
    used = F.when(F.col("clash").isNull(), F.col("n_windows")).otherwise(F.col("n_same"))
    leaks = copies.groupBy(*pair).agg(F.max(used).alias("n_windows"), F.max(F.when(F.col("copy") == "all", F.col("exact"))).alias("exact"))
    leaks = leaks.withColumn("literal", F.lit(False)).unionByName(
        literal.groupBy(*pair).agg(F.countDistinct("own").alias("n_windows")).withColumn("exact", F.lit(True)).withColumn("literal", F.lit(True))
    )
    leaks = (
        _joined(leaks, totals, ["item_id", "literal"]).withColumn("share", F.col("n_windows") / F.col("item_windows"))
        .where((F.col("n_windows") > 0) & (F.col("share") >= least_share))
    )
    # of the two kinds of windows the larger share, of equal ones the templates
    found = F.struct("share", ~F.col("literal"), "n_windows", "item_windows", "exact")
    return leaks.groupBy(*pair).agg(F.max(found).alias("f")).select(
        "doc_id", "item_id", "f.n_windows", "f.item_windows", "f.share", "f.exact", "text_hash"
    )
