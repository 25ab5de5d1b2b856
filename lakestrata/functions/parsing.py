"""Column expressions for landed JSON records and their typed fields.

All are built-in Catalyst expressions (codegen, no Python per row).  Casts
are "guarded": each returns NULL where the text is not acceptable, so a
caller can turn the NULL into a reject reason or a failed job instead of a
silent NULL or a rounded number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The record fields each dataset carries (all landed as text).
ENVELOPE_FIELDS = "event_id string, updated_at string"
ORDER_FIELDS = "order_id string, customer_id string, order_date string, status string, net_amount string"
CUSTOMER_FIELDS = "customer_id string, market string"
ISO_TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


CORRUPT = "_corrupt_record"


def json_struct(text: Column | str, ddl: str) -> Column:
    """parse JSON text into a struct with an explicit schema.

    Malformed text does not raise: its fields come back NULL and the raw text
    lands in the extra ``_corrupt_record`` field (NULL text gives a NULL
    struct).  Use :func:`well_formed` on the result."""
    return F.from_json(col_of(text), f"{ddl}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})


def well_formed(parsed: Column | str) -> Column:
    """True when a :func:`json_struct` result came from a parsable JSON object."""
    p = col_of(parsed)
    return p.isNotNull() & p.getField(CORRUPT).isNull()


def json_field(text: Column | str, field: str) -> Column:
    """one top-level field of a JSON object, as text (numbers keep their literal text)."""
    return F.get_json_object(col_of(text), f"$.{field}")


def present(c: Column | str) -> Column:
    """F16: the value exists and is not the empty string (missing, NULL and '' all fail)."""
    return F.coalesce(col_of(c), F.lit("")) != F.lit("")


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text to a UTC instant; a trailing Z or an offset converts,
    text without an offset is read as UTC (session zone).  Text that is not a
    full date with an optional time (a lone time, a year, a zone name) gives NULL."""
    c = col_of(c)
    return F.when(c.rlike(ISO_TIMESTAMP_PATTERN), c.try_cast("timestamp"))


def strict_date(c: Column | str) -> Column:
    """only the zero-padded YYYY-MM-DD form is a date; anything else gives NULL."""
    c = col_of(c)
    return F.when(c.rlike(ISO_DATE_PATTERN), c.try_cast("date"))


def strict_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """exact text-to-decimal conversion.

    Spark's cast rounds extra fractional digits (10.005 -> 10.01); the source
    contract does not allow that, so the value is kept only when the cast to
    (precision, scale) equals a wide cast, i.e. nothing was rounded away and
    nothing overflowed.  Trailing zeros and exponents (10.500, 1e2) are legal."""
    c = col_of(c)
    narrow = c.try_cast(f"decimal({precision},{scale})")
    wide = c.try_cast("decimal(38,18)")
    return F.when(narrow == wide, narrow)


def sorted_key_json(*cols: str) -> Column:
    """JSON object text with keys in sorted order and NULL fields kept."""
    names = sorted(cols)
    return F.to_json(F.struct(*[F.col(n) for n in names]), {"ignoreNullFields": "false"})
