"""Text cleaning and typing as column expressions, no UDFs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of the latin-1 range, accepted boolean spellings.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
TRUE_WORDS = ("y", "yes", "true", "1")
FALSE_WORDS = ("n", "no", "false", "0")

# Accepted date shapes with their Spark patterns.
DATE_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
)


def normalize_header(name: str) -> str:
    """Lower-case identifier made of letters, digits and single underscores."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def clean_text(col: Column) -> Column:
    """Strip white space on both sides; blank becomes NULL."""
    return F.nullif(F.btrim(col, F.lit(WHITESPACE)), F.lit(""))


def _clean(col: Column, cleaned: bool) -> Column:
    return col if cleaned else clean_text(col)


def parse_bool(col: Column, cleaned: bool = False) -> Column:
    """TRUE / FALSE for the known words, NULL for all else.

    Here and below, ``cleaned`` says that ``col`` comes from ``clean_text``, which is then not repeated.
    """
    word = F.lower(_clean(col, cleaned))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def parse_int(col: Column, cleaned: bool = False) -> Column:
    return _clean(col, cleaned).try_cast("int")


def parse_decimal(col: Column, cleaned: bool = False) -> Column:
    """Exact decimal; thousands separators are dropped."""
    return F.replace(_clean(col, cleaned), F.lit(","), F.lit("")).try_cast("decimal(38,10)")


def parse_date(col: Column, cleaned: bool = False) -> Column:
    """Date from one of the known shapes, NULL when none fits.

    The shape picks the pattern, so at most one parse is tried per value.
    """
    text = _clean(col, cleaned)
    parsed = F.lit(None).cast("timestamp")
    for shape, pattern in reversed(DATE_SHAPES):
        parsed = F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern))).otherwise(parsed)
    return parsed.cast("date")


def is_unparsable(raw: Column, parsed: Column) -> Column:
    """True where text was given but could not be typed."""
    return clean_text(raw).isNotNull() & parsed.isNull()


def decimal_id_text(col: Column, parsed: Column | None = None) -> Column:
    """Number text for record ids: digits as given, zero and NULL both empty.

    ``parsed`` is the number that ``parse_decimal`` gives, if it is there as a
    column; ``col`` then comes from ``clean_text``.
    """
    given = F.replace(_clean(col, parsed is not None), F.lit(","), F.lit(""))
    # A text that is a number has no letter but the exponent's.
    given = F.replace(given, F.lit("e"), F.lit("E"))
    text = F.regexp_replace(given, r"^\+", "")
    text = F.regexp_replace(text, r"^0+(?=[0-9])", "")
    text = F.regexp_replace(text, r"^\.", "0.")
    text = F.regexp_replace(text, r"\.$", "")
    # Few texts need the expressions above.
    untidy = F.left(given, F.lit(1)).isin("+", "0", ".") | given.endswith(".")
    number = parse_decimal(col) if parsed is None else parsed
    return F.when(F.coalesce(number == 0, F.lit(True)), F.lit("")).when(untidy, text).otherwise(given)


def record_id(parts: Sequence[Column]) -> Column:
    """SHA-256 over the parts joined with a bar; NULL counts as empty text."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def row_fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 over the raw row as JSON with sorted names."""
    row = F.struct(*[F.col(f"`{name}`") for name in sorted(columns)])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def composite_key(*parts: Column) -> Column:
    """Parts joined with a bar; NULL parts count as empty text."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.concat_ws("|", *texts)


def fixed_digits(col: Column, digits: int) -> Column:
    """Number as text with a fixed count of decimals, rounded half up."""
    return F.round(col.cast("double"), digits).cast(f"decimal(18,{digits})").cast("string")
