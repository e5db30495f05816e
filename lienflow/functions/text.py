"""Text expressions: trimming, names, codes, postal fields and search keys."""

from __future__ import annotations

from lienflow import fixed_values as fixed
from lienflow.functions.sql import coalesce, listing, lookup, quote, replace_all


def strip(value: str) -> str:
    """Trim every Unicode white-space character, not only the blank."""
    return f"btrim({value}, {quote(fixed.WHITESPACE)})"


def clean(value: str) -> str:
    """Trimmed text, or null when nothing is left."""
    return f"nullif({strip(value)}, '')"


def first_clean(*values: str) -> str:
    """The first value that is not blank, trimmed."""
    return coalesce(*map(clean, values))


def normalize_name(value: str, uppercase: bool = False) -> str:
    one_blank = replace_all(value, (r"(?U)[\s\x1C-\x1F]+", " "))
    text = f"nullif(trim({one_blank}), '')"
    return f"upper({text})" if uppercase else text


def normalize_filing_type(value: str) -> str:
    code = f"upper({clean(value)})"
    return coalesce(lookup(f"translate({code}, '- ', '')", fixed.FILING_TYPES), code)


def normalize_status(value: str) -> str:
    text = clean(value)
    return coalesce(lookup(f"upper({text})", fixed.STATUSES), f"lower({text})")


def normalize_zip(value: str) -> str:
    """Five digits or five plus four; with fewer than five digits the text stays as it is."""
    tidy = quote(r"^\d{5}(-\d{4})?\z")
    digits = replace_all(value, ("[^0-9]", ""))
    short = replace_all(digits, (r"^(\d{5})(\d{4})$", "$1-$2"), (r"^(\d{5})\d+$", "$1"))
    return f"CASE WHEN {value} RLIKE {tidy} THEN {value} WHEN length({digits}) >= 5 THEN {short} ELSE {clean(value)} END"


def normalize_state(value: str) -> str:
    return f"upper({clean(value)})"


def question_key(question: str) -> str:
    """A short key: the first four telling words joined by underscores."""
    bare = normalize_name(replace_all(f"lower({question})", (r"(?U)[^\w\s]", "")))
    telling = f"filter(split({bare}, ' '), word -> word NOT IN ({listing(fixed.KEY_STOP_WORDS)}))"
    return coalesce(f"nullif(array_join(slice({telling}, 1, 4), '_'), '')", "'unknown'")


def search_key(name: str) -> str:
    """The form under which a debtor name is searched.

    Case, accents, punctuation and spaces do not count, nor do "the" at either end and ending noise words.
    """
    plain = f"translate(upper({name}), {quote(fixed.ACCENTED)}, {quote(fixed.PLAIN)})"
    words = replace_all(plain, (r"(?U)[^\p{L}\p{N}\s]", ""), (r"(?U)[\s\x1C-\x1F]+", " "))
    endings = "|".join([*fixed.NAME_NOISE_WORDS, "THE"])
    telling = replace_all(f"trim({words})", (rf"^THE |( ({endings}))+$", ""))
    return f"nullif(translate({telling}, ' ', ''), '')"
