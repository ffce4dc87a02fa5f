"""Column expressions: text clean-up, number parsing, labels, scores, predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlight import fixed_values as fv

# A plain decimal number, with optional exponent, or an infinity.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- text ------------------------------------------------------------------

def clean_key(c: Column | str) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def code(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c).cast("string")))


def initcap_alnum(c: Column | str) -> Column:
    """Capital at the start of every run of letters or digits, lower case elsewhere.

    The built-in `initcap` starts words at blanks only, so it would leave
    ``mary's-clinic`` as one word.
    """
    parts = F.regexp_extract_all(
        F.lower(_col(c).cast("string")), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0)
    )
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))
    return F.array_join(F.transform(parts, capital), "")


def zip5(c: Column | str) -> Column:
    digits = F.regexp_replace(F.coalesce(_col(c).cast("string"), F.lit("")), fv.NOT_DIGITS, "")
    return F.lpad(digits, 5, "0")


def coalesce_text(*cs: Column | str) -> Column:
    return F.coalesce(*[_col(c).cast("string") for c in cs], F.lit(""))


def measure_key(*cs: Column | str) -> Column:
    return F.lower(coalesce_text(*cs))


# ---- numbers ---------------------------------------------------------------

def _is_null_text(c: Column, tokens: Iterable[str]) -> Column:
    return F.lower(F.coalesce(c.cast("string"), F.lit(""))).isin(*tokens)


def parse_numeric(c: Column | str, tokens: Sequence[str]) -> Column:
    """Dirty text to a number; null tokens and unreadable leftovers become NULL.

    Stripping turns ``1e-05`` into ``1-05`` and leaves ``10-20`` as it is;
    neither is a number.
    """
    text = _col(c).cast("string")
    stripped = F.regexp_replace(text, fv.NOT_NUMERIC_CHARS, "")
    return F.when(~_is_null_text(text, tokens), stripped.try_cast("double"))


def parse_rating(c: Column | str, tokens: Sequence[str] = fv.RATING_NULLS) -> Column:
    text = _col(c).cast("string")
    digits = F.regexp_replace(text, fv.NOT_DIGITS, "").try_cast("int")
    return F.when(~_is_null_text(text, tokens), digits)


def rating_to_100(c: Column | str, tokens: Sequence[str] = fv.TREND_RATING_NULLS) -> Column:
    return parse_rating(c, tokens).cast("double") * F.lit(20.0)


def to_number(c: Column | str) -> Column:
    """Lenient numeric cast: what is not a number becomes NULL, never an error."""
    text = _col(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def coerce_numeric(c: Column | str) -> Column:
    """As `to_number` after dropping percent signs and commas.

    Null tokens are matched as they stand (case and blanks count).
    """
    text = F.translate(_col(c).cast("string"), "%,", "")
    return F.when(~text.isin(*fv.COERCE_NULLS), to_number(text))


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


# ---- scores ----------------------------------------------------------------

def weighted_score(weights: Mapping[str, float], fill: float) -> Column:
    """Sum of ``coalesce(column, fill) * weight`` in the order of the mapping."""
    terms = [F.coalesce(F.col(c), F.lit(fill)) * F.lit(w) for c, w in weights.items()]
    return reduce(lambda a, b: a + b, terms)


def invert_score(c: Column | str, fill: float = fv.NEUTRAL_SCORE) -> Column:
    return F.lit(100.0) - F.coalesce(_col(c), F.lit(fill))


def star_to_100(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c <= 5, c * 20).otherwise(c)


def piecewise_scale(c: Column | str, max_c: Column | str) -> Column:
    """Stars (up to 5) times 20; above 100, 100 minus the share of the maximum; else as is."""
    c, max_c = _col(c), _col(max_c)
    share = F.least(F.lit(100.0), F.try_divide(c, max_c) * 100.0)
    return F.when(c <= 5, c * 20.0).when(c > 100, F.lit(100.0) - share).otherwise(c)


def min_max_100(c: Column | str, low: Column, high: Column, invert: bool = False,
                fill_null_when_constant: bool = False) -> Column:
    """Position between `low` and `high` as 0-100; 50 when they are equal."""
    c = _col(c)
    share = (c - low) / F.nullif(high - low, F.lit(0.0)) * 100.0
    scaled = F.lit(100.0) - share if invert else share
    constant = F.lit(fv.NEUTRAL_SCORE)
    if fill_null_when_constant:
        return F.when(low.isNull() | (low == high), constant).otherwise(scaled)
    return F.when(c.isNotNull() & (low == high), constant).otherwise(scaled)


# ---- labels and encodings --------------------------------------------------

_COMPARE = {
    ">=": lambda c, v: c >= F.lit(v),
    "<=": lambda c, v: c <= F.lit(v),
}


def _first_match(branches: Iterable[tuple[Column, object]], default: Column) -> Column:
    """``case when`` over the branches; the first condition that holds decides."""
    out = None
    for condition, value in branches:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return default if out is None else out.otherwise(default)


def bucket_label(c: Column | str, rules: Sequence[tuple[str, float, str]], default: str) -> Column:
    c = _col(c)
    return _first_match(((_COMPARE[op](c, v), F.lit(label)) for op, v, label in rules), F.lit(default))


def band(c: Column | str, cuts: Sequence[tuple[float, str]], default: str) -> Column:
    return bucket_label(c, [(">=", v, label) for v, label in cuts], default)


def value_case(c: Column | str, mapping: Mapping, default) -> Column:
    c = _col(c)
    return _first_match(((c == F.lit(k), F.lit(v)) for k, v in mapping.items()), F.lit(default))


def keyword_case(c: Column | str, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """Class of the first rule one of whose keywords occurs in the lower-cased text."""
    return _first_match(((any_like(F.lower(coalesce_text(c)), words), F.lit(label)) for words, label in rules),
                        F.lit(default))


def encode(c: Column | str, mapping: Mapping[str, int], default: int) -> Column:
    """Code of a category, `default` for anything unlisted or NULL."""
    return value_case(c, mapping, default)


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def features_map(cols: Sequence[str]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                             F.array(*[F.col(c).cast("double") for c in cols]))


# ---- predicates ------------------------------------------------------------

def any_like(c: Column | str, words: Sequence[str]) -> Column:
    """True when one of the words occurs in the text."""
    c = _col(c)
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def in_or_like(c: Column | str, ids: Sequence[str], words: Sequence[str]) -> Column:
    c = _col(c)
    return c.isin(*ids) | any_like(c, words)


def eq_ci(c: Column | str, value: str) -> Column:
    """Case-insensitive equality in which NULL counts as an empty text."""
    return F.lower(coalesce_text(c)) == F.lit(value.lower())


def search_like(cols: Sequence[str], term: str) -> Column:
    """Case-insensitive substring in any column; `%` and `_` stay wildcards; '' finds all."""
    if term == "":
        return F.lit(True)
    return reduce(lambda a, b: a | b, [F.col(c).ilike(f"%{term}%") for c in cols])


def search_regex(cols: Sequence[str], term: str) -> Column:
    """Regular expression found in any lower-cased column; NULL counts as empty."""
    return reduce(lambda a, b: a | b, [F.lower(coalesce_text(c)).rlike(term.lower()) for c in cols])


def filter_in(**choices: Sequence | None) -> Column:
    """AND of membership tests; an empty or missing list does not filter."""
    return reduce(lambda a, b: a & b,
                  [F.col(c).isin(*values) for c, values in choices.items() if values], F.lit(True))


def seeded_hash(key: Column, seed: int) -> Column:
    """60 bits of the md5 of an id and a seed as a whole number; the same in every engine. NULL ids hash as empty text."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
