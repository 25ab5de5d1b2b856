"""Operator 7: personal data by patterns, checksums and context words (native).

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod 97 for account numbers), digit counts and number ranges do the same for
phones and addresses, and words nearby move the score.  All of it is
DataFrame expressions.  The places of matches come from the text between
them: ``split`` gives the gaps and ``regexp_extract_all`` the matches, and
their running lengths are the spans in code points.

Base kinds (email, ip, card, phone) keep every confirmed match whatever its
score; the added kind ``iban`` needs the mod-97 check and a score of at least
``MIN_SCORE``.  Score: 0.6 for a confirmed match, +0.3 with a word of
its kind among the CONTEXT_CHARS characters before it, -0.2 with a word that
speaks against it (an order, part or version number).

The patterns are written so that a match never backtracks into a repeated
group and a failed start is not tried again inside the same run, which keeps
very long words linear.  They match the same spans as the plain forms.

Defined cases: null text counts as empty; equal rows and ids are kept; an
empty table gives no rows; only the named columns and those listed in
``keep`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
MIN_SCORE = 0.5

# patterns of the kinds (fixed values); \G lets a match follow the one before it
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]{4}){2,7}+(?:\x20?+[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
}
KINDS = list(PATTERNS)
# words near a span that speak for its kind, and for none (fixed values)
CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|write to)\b",
    "ip": r"(?i)\b(ip|address|host|server|login)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|debit|payment)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax|cell)\b",
    "iban": r"(?i)\b(iban|account|bank|bic|swift|transfer)\b",
}
AGAINST = r"(?i)\b(order|part|serial|version|isbn|sku|ticket)\b"


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """Luhn check of a string of digits."""
    return f"""aggregate(sequence(1, length({digits})), 0L, (s, i) -> s +
        if(i % 2 = 1, int(substring({digits}, -i, 1)),
           (2 * int(substring({digits}, -i, 1))) div 10 + (2 * int(substring({digits}, -i, 1))) % 10)) % 10 = 0"""


def _mod97(number: str) -> str:
    """mod-97 check: first four characters to the end, letters as 10 to 35."""
    moved = f"concat(substring({number}, 5), substring({number}, 1, 4))"
    value = "if(c between '0' and '9', int(c), ascii(c) - 55)"
    return f"""aggregate(filter(split({moved}, ''), c -> c <> ''), 0,
        (s, c) -> (s * if({value} > 9, 100, 10) + {value}) % 97) = 1"""


_CONFIRM = {
    "email": "true",
    "ip": "forall(split(m, '\\\\.'), x -> length(ltrim('0', x)) <= 3 and coalesce(try_cast(ltrim('0', x) as int), 0) <= 255)",
    "card": f"length(regexp_replace(m, '[ -]', '')) between 12 and 19 and {_luhn("regexp_replace(m, '[ -]', '')")}",
    "phone": "length(regexp_replace(m, '[^0-9]', '')) between 9 and 15",
    "iban": f"length(replace(m, ' ', '')) between 15 and 34 and {_mod97("replace(m, ' ', '')")}",
}
#: a text without this cannot hold the kind
_NEEDS = {
    "email": "instr(text, '@') > 0",
    "ip": "text rlike '[0-9]\\\\.[0-9]'",
    "card": "text rlike '[0-9][ -]?[0-9]'",
    "phone": "instr(text, '+') > 0",
    "iban": "text rlike '[A-Z][A-Z][0-9][0-9]'",
}


def _raw(kind: str) -> Column:
    """struct(gaps, matches) of a kind, null if there can be none."""
    p = _sql_text(PATTERNS[kind])
    return F.expr(f"if({_NEEDS[kind]}, struct(split(text, {p}, -1) as gaps, regexp_extract_all(text, {p}, 0) as found), null)")


def _placed(kind: str, rank: int) -> Column:
    """Confirmed spans of a kind: start, rank, kind, end, text before."""
    walk = f"""aggregate(
        sequence(1, size({kind}.found)),
        struct(0 as at, cast(array() as array<struct<start:int,end:int,m:string>>) as out),
        (s, i) -> struct(
            s.at + length(element_at({kind}.gaps, i)) + length(element_at({kind}.found, i)) as at,
            array_append(s.out, struct(
                s.at + length(element_at({kind}.gaps, i)) as start,
                s.at + length(element_at({kind}.gaps, i)) + length(element_at({kind}.found, i)) as end,
                element_at({kind}.found, i) as m)) as out),
        s -> s.out)"""
    listed = f"if(size({kind}.found) > 0, {walk}, cast(array() as array<struct<start:int,end:int,m:string>>))"
    confirmed = f"filter({listed}, y -> {_CONFIRM[kind].replace('(m,', '(y.m,').replace('(m ', '(y.m ')})"
    before = f"substring(text, greatest(0, y.start - {CONTEXT_CHARS}) + 1, least(y.start, {CONTEXT_CHARS}))"
    score = (
        f"0.6D + if({before} rlike {_sql_text(CONTEXT[kind])}, 0.3D, 0D) - if({before} rlike {_sql_text(AGAINST)}, 0.2D, 0D)"
    )
    kept = f"transform({confirmed}, y -> struct(y.start as start, {rank} as rank, '{kind}' as kind, y.end as end, {score} as score))"
    if rank >= 4:
        kept = f"filter({kept}, y -> y.score >= {MIN_SCORE}D)"
    return F.expr(f"if({kind} is null, cast(array() as array<struct<start:int,rank:int,kind:string,end:int,score:double>>), {kept})")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, text, spans): spans are structs (start, rank, kind, end, score) by start, then kind.

    ``keep`` names further columns of the input to carry."""
    kept = [docs[c].alias(f"kept_{i}") for i, c in enumerate(keep)]
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), *kept)
    raw = rows.withColumns({k: _raw(k) for k in KINDS})
    spans = raw.withColumn("spans", F.array_sort(F.concat(*(_placed(k, i) for i, k in enumerate(KINDS)))))
    out = spans.select("doc_id", "text", "spans", *(f"kept_{i}" for i in range(len(keep))))
    return out.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


def redacted(text: str, spans: str) -> Column:
    """Text with every span replaced by ``[KIND]``; a span that begins inside an earlier one is part of it."""
    walk = f"""aggregate({spans},
        struct('' as out, 0 as at),
        (s, y) -> if(y.start < s.at, struct(s.out as out, greatest(s.at, y.end) as at),
            struct(concat(s.out, substring({text}, s.at + 1, y.start - s.at), '[', upper(y.kind), ']') as out, y.end as at)),
        s -> concat(s.out, substring({text}, s.at + 1)))"""
    return F.expr(f"if(size({spans}) = 0, {text}, {walk})")


def digest_spans(spans: str) -> str:
    """SQL text of kind:start:end, comma-joined."""
    return f"array_join(transform({spans}, y -> concat(y.kind, ':', y.start, ':', y.end)), ',')"
