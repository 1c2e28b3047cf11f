"""Normalisers for identifiers, phone numbers, names and amounts held as text."""
from functools import reduce

from pyspark.sql import Column, functions as F

# Tokens that stand for "no value" in landed files.
NULL_TOKENS = ("000000000", "0", "nan", "None", "-1", "null", "nan--", "")

# Characters left behind by a wrong encoding.
SPECIAL_CHARACTERS = ("½", "¿", "~", "�", "ï", "Â", "Ã¯")

# Digits a phone number must have, by its first digits.
PHONE_LENGTHS = (("254", 12), ("0", 10), ("7", 9), ("1", 9))


def strip_decimal_suffix(c: Column) -> Column:
    """'12345.0' → '12345'; only a trailing '.0' goes."""
    return F.regexp_replace(F.trim(c), r"\.0$", "")


def null_tokens(c: Column, tokens=NULL_TOKENS) -> Column:
    return F.when(F.trim(c).isin(*tokens) | c.rlike(r"^\s*$"), F.lit(None)).otherwise(c)


def null_if_equal(c: Column, other: Column) -> Column:
    return F.nullif(c, other)


def strip_leading_zeros(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "^0+", "")


def standard_phone(c: Column, country_code: str = "254") -> Column:
    """Letters make it null, a trunk '0' becomes the country code, '+' goes."""
    return (
        F.when(c.rlike("[a-zA-Z]"), F.lit(None))
        .when(c.startswith("0"), F.concat(F.lit(country_code), F.substr(c, F.lit(2))))
        .when(c.startswith("+"), F.substr(c, F.lit(2)))
        .otherwise(c)
    )


def valid_phone(c: Column, lengths=PHONE_LENGTHS) -> Column:
    """Null unless the digit count fits the prefix; unknown prefixes pass."""
    wrong = reduce(
        lambda a, b: a | b,
        [c.startswith(prefix) & (F.length(F.trim(c)) != n) for prefix, n in lengths],
    )
    return F.when(wrong, F.lit(None)).otherwise(c)


def before_underscore(c: Column) -> Column:
    return F.trim(F.split_part(c, F.lit("_"), F.lit(1)))


def drop_special_characters(c: Column, characters=SPECIAL_CHARACTERS) -> Column:
    """Characters go one kind after the other, so a pair whose parts were
    removed earlier can no longer match; the words around them may fuse."""
    return reduce(lambda acc, ch: F.replace(acc, F.lit(ch), F.lit("")), characters, c)


def split_names(c: Column) -> Column:
    """First word, second word, and all further words joined by a space."""
    words = F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")
    return F.struct(
        F.get(words, F.lit(0)).alias("first_name"),
        F.get(words, F.lit(1)).alias("middle_name"),
        F.when(F.size(words) > 2, F.array_join(F.slice(words, 3, F.size(words)), " ")).alias("last_name"),
    )


def letters_title(c: Column) -> Column:
    return F.initcap(F.regexp_replace(c, r"[^\p{L}]", ""))


def minor_units(c: Column) -> Column:
    """1234.5 → '123450'."""
    return F.regexp_replace(F.format_string("%.2f", c), r"\.", "")


def parse_amount(c: Column) -> Column:
    """'1,234.50' → 1234.5; text that is no number becomes null."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


def parse_timestamp(c: Column, *formats: str) -> Column:
    """First format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def compact_date(c: Column) -> Column:
    """'20230105' or '20230105.0' → date."""
    return F.to_date(F.try_to_timestamp(strip_decimal_suffix(c), F.lit("yyyyMMdd")))


def any_missing(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def is_plain_id(c: Column, max_length: int = 8) -> Column:
    """Digits and points only, short enough, and not a run of zeros."""
    return c.rlike(r"^[0-9.]+$") & (F.length(c) <= max_length) & ~c.rlike("^0+$")


def map_codes(c: Column, mapping: dict, default: Column | None = None) -> Column:
    """Code → value; codes outside the mapping get ``default`` (null if not given)."""
    out = None
    for code, value in mapping.items():
        out = F.when(c == code, F.lit(value)) if out is None else out.when(c == code, F.lit(value))
    return out if default is None else out.otherwise(default)


def canonical_reason(c: Column, needle: str) -> Column:
    return F.when(c.contains(needle), F.lit(needle)).otherwise(c)


def full_name(*parts: Column) -> Column:
    """Lower-cased parts joined by a space; missing parts leave no trace."""
    return F.lower(F.trim(F.concat_ws(" ", *parts)))


def pick_names(score: Column, registry: list, own: list, threshold: int = 60) -> list:
    """Registry names when the similarity score is high enough, own names otherwise."""
    return [F.when(score >= threshold, r).otherwise(o) for r, o in zip(registry, own)]


def narration_parts(c: Column, names: tuple, sep: str = ":") -> list:
    parts = F.split(c, sep)
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]
