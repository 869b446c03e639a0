"""Column expressions: dates, text keys, tokens, labels, JSON, formatting."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered name patterns of drink categories, first match wins.
DRINK_CATEGORY_RULES = [
    ("whiskies|whisky|whiskey|scotch|single malt", "Whiskey"),
    ("vodka", "Vodka"),
    ("schnapps|amaretto|liqueur|creme|triple sec", "Liqueur"),
    ("rum", "Rum"),
    ("^gin", "Gin"),
    ("brandy", "Brandy"),
    ("tequila", "Tequila"),
    ("bourbon", "Bourbon"),
    ("cocktails", "Cocktails"),
    ("spirit", "Other Spirits"),
]

# Brand codes of the product table and the names shown for them.
PRODUCT_BRAND_NAMES = {
    "bj": "Ben & Jerry's",
    "breyers": "Breyers",
    "hd": "Häagen-Dazs",
    "talenti": "Talenti",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- dates ---------------------------------------------------------------------


def month_key(day: Column | str) -> Column:
    """``'YYYY-MM'``, which sorts as text the way months sort in time."""
    return F.date_format(_col(day), "yyyy-MM")


def month_start(month: Column | str) -> Column:
    return F.to_date(F.concat(_col(month), F.lit("-01")))


def day_label(day: Column | str) -> Column:
    return F.date_format(_col(day), "MMM dd, yyyy")


def before_month_of(day: Column | str, as_of: dt.date) -> Column:
    """Rows of complete months only.

    The bound is a literal on the bare column, so the scan can skip row groups.
    """
    return _col(day) < F.lit(as_of.replace(day=1))


def local_day(stamp: Column | str, zone: str) -> Column:
    """Calendar day in ``zone`` of a UTC ``timestamp_ntz``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(stamp)))


def in_local_days(stamp: Column | str, zone: str, first: dt.date, last: dt.date) -> Column:
    """Local day between ``first`` and ``last``, both included.

    The day in a zone is computed per row and cannot reach the scan; a UTC range one day
    wider on each side is added because it can.
    """
    wide_from = F.lit(first - dt.timedelta(days=1))
    wide_to = F.lit(last + dt.timedelta(days=2))
    exact = local_day(stamp, zone).between(F.lit(first), F.lit(last))
    return (_col(stamp) >= wide_from) & (_col(stamp) < wide_to) & exact


# -- text ----------------------------------------------------------------------


def first_space_to_underscore(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "^([^ ]*) ", "$1_")


def page_key(name: Column | str, suffix: Column | str | None = None) -> Column:
    """Lower-case title key; only the first space is replaced, a present suffix is added."""
    key = first_space_to_underscore(F.lower(_col(name)))
    if suffix is None:
        return key
    tail = F.when(_col(suffix).isNull(), F.lit("")).otherwise(F.concat(F.lit("_"), _col(suffix)))
    return F.concat(key, tail)


def file_name(*parts: Column | str, extension: str) -> Column:
    """``a_b_c.ext`` with spaces replaced, parts given as columns."""
    text = F.concat_ws("_", *[_col(p).cast("string") for p in parts])
    return F.concat(F.replace(text, F.lit(" "), F.lit("_")), F.lit(f".{extension}"))


def object_link(root: str, folder: str, key: Column | str, extension: str) -> Column:
    return F.concat(F.lit(f"{root}/{folder}/"), _col(key).cast("string"), F.lit(f".{extension}"))


def word_tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(text)), F.lit("[a-z]+"), F.lit(0))


def first_match_label(
    text: Column | str, rules: Sequence[tuple[str, str]], default: str | None = None
) -> Column:
    """Label of the first pattern found in the lower-cased text."""
    low = F.lower(_col(text))
    out = None
    for pattern, label in rules:
        test = low.rlike(pattern)
        out = F.when(test, label) if out is None else out.when(test, label)
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def code_label(code: Column | str, labels: Mapping[str, str]) -> Column:
    out = None
    for key, label in labels.items():
        test = _col(code) == key
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(None).cast("string") if out is None else out


def suffix_if_present(lead: str, text: Column | str) -> Column:
    """``lead`` + text, or nothing at all when the text is NULL."""
    return F.coalesce(F.concat(F.lit(lead), _col(text).cast("string")), F.lit(""))


def null_if_text(text: Column | str, sentinel: str) -> Column:
    """NULL where the trimmed text is a placeholder answer."""
    return F.when(F.trim(_col(text)) == sentinel, None).otherwise(_col(text))


def parse_number(text: Column | str, to: str, missing: str = "..") -> Column:
    """Typed number from text; a missing mark or bad text gives NULL."""
    return F.nullif(F.trim(_col(text)), F.lit(missing)).try_cast(to)


def json_scalar(json: Column | str, path: str) -> Column:
    """Scalar at ``path``; an object or array there gives NULL."""
    value = F.get_json_object(_col(json), path)
    # a string may begin like an object: only there the JSON is parsed again, for its type
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(_col(json)), path, "variant"))
    return F.when(~F.substring(value, 1, 1).isin("[", "{"), value).otherwise(F.when(kind == "STRING", value))


# -- display -------------------------------------------------------------------


def ordinal(number: Column | str) -> Column:
    """1st, 2nd, 3rd, 4th, and 11th to 13th."""
    n = _col(number)
    last = F.pmod(n, F.lit(10))
    teen = F.pmod(n, F.lit(100)).between(11, 13)
    ending = (
        F.when(teen, "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd")
    ).otherwise("th")
    return F.concat(n.cast("string"), ending)


def text_or_na(value: Column | str) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit("NA"))


def tied_note(ties: Column | str, counted: bool) -> Column:
    """Empty for a rank held alone, otherwise ``(tied)`` or ``(n tied)``."""
    n = _col(ties)
    note = F.concat(F.lit(" ("), n.cast("string"), F.lit(" tied)")) if counted else F.lit(" (tied)")
    return F.when(n > 1, note).otherwise("")
