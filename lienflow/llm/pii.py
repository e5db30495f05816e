"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Everything is a SQL expression.  ``split`` gives the text between the matches of a pattern and
``regexp_extract_all`` the matches; their lengths add up to the positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lienflow.llm.common import text_or_empty

#: Kinds in the order of the report; the first four are the base.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "secret"]
BASE = KINDS[:4]

# The patterns of the four base kinds.  The first two may begin only where a run of their first
# characters begins or the last match ended: a start within the run would meet the same end, so nothing is lost and
# the search stays linear.  Possessive repeats change no match here.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9_-]{16,64}(?![A-Za-z0-9_-])",
}

#: A cheap test that every text with a match passes.
HINTS = {
    "email": "contains({t}, '@')",
    "ip": "{t} rlike '[0-9]\\\\.[0-9]'",
    "card": "{t} rlike '[0-9][ -]?[0-9]'",
    "phone": "{t} rlike '\\\\+[0-9]'",
    "iban": "{t} rlike '[A-Z]{{2}}[0-9]{{2}}'",
    "ssn": "{t} rlike '[0-9]-[0-9]'",
    "secret": "{t} rlike '[A-Za-z0-9_-]{{16}}'",
}

#: Words before or after a span that raise its score, and how far off they may be (code points).
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|transfer",
    "ssn": "ssn|social|security",
    "secret": "password|passwd|secret|token|api[_-]?key",
}
NEARBY = 24

#: Score of a span without context, what context adds, and the score that a span has to reach.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.5, "secret": 0.2}
CONTEXT_BONUS = 0.4
THRESHOLD = 0.6


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def luhn(digits: str) -> str:
    """SQL: whether a text of digits passes the Luhn check."""
    return (
        f"aggregate(transform(reverse(split({digits}, '')), (d, i) -> "
        "if(i % 2 = 0, int(d), if(int(d) > 4, 2 * int(d) - 9, 2 * int(d)))), 0, (a, d) -> a + d) % 10 = 0"
    )


def mod97(iban: str) -> str:
    """SQL: whether an IBAN without spaces has check digits of remainder 1."""
    moved = f"concat(substr({iban}, 5), substr({iban}, 1, 4))"
    return (
        f"aggregate(split({moved}, ''), 0, (a, c) -> "
        "if(c rlike '[0-9]', (a * 10 + int(c)) % 97, (a * 100 + ascii(c) - 55) % 97)) = 1"
    )


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_IBAN = "replace(m, ' ')"

#: Confirmation of a match ``m``; nested so that a checksum is worked out for plausible lengths only.
VALID = {
    "email": "true",
    "ip": "forall(split(m, '[.]'), o -> length(regexp_replace(o, '^0+', '')) < 4 AND int(right(o, 3)) <= 255)",
    "card": f"if(length({_DIGITS}) BETWEEN 16 AND 19, {luhn(_DIGITS)}, false)",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "iban": f"if(length({_IBAN}) BETWEEN 15 AND 34, {mod97(_IBAN)}, false)",
    "ssn": "substr(m, 1, 3) NOT IN ('000', '666') AND substr(m, 1, 1) != '9' AND substr(m, 5, 2) != '00' "
    "AND substr(m, 8) != '0000'",
    "secret": "m rlike '[0-9]' AND m rlike '[A-Za-z]'",
}

#: The text before and after match number i; ``p`` holds the pieces between matches as ``g``, the matches as ``ms``.
_BEFORE, _AFTER = "element_at(p.g, i + 1)", "element_at(p.g, i + 2)"


def _parts(text: str, kind: str) -> str:
    pattern = _literal(PATTERNS[kind])
    return f"named_struct('g', split({text}, {pattern}, -1), 'ms', regexp_extract_all({text}, {pattern}, 0))"


def _score(kind: str) -> str:
    near = _literal(f"(?i)(?:{CONTEXT[kind]})")
    found = f"right({_BEFORE}, {NEARBY}) rlike {near} OR left({_AFTER}, {NEARBY}) rlike {near}"
    return f"{SCORES[kind]}D + if({found}, {CONTEXT_BONUS}D, 0D)"


def _accepted(kind: str) -> str:
    """Whether match ``m`` is confirmed and, where context decides, reaches the threshold."""
    confirmed = VALID[kind]
    return confirmed if SCORES[kind] >= THRESHOLD else f"{confirmed} AND {_score(kind)} >= {THRESHOLD}D"


def spans(kind: str, text: str) -> str:
    """SQL: array of (kind, start, end, score) of the accepted spans, by start."""
    matches = (
        f"transform(p.ms, (m, i) -> named_struct('skip', length({_BEFORE}), 'size', length(m), "
        f"'ok', {_accepted(kind)}, 'score', {_score(kind)}))"
    )
    span = f"named_struct('kind', '{kind}', 'start', s.at + x.skip, 'end', s.at + x.skip + x.size, 'score', x.score)"
    step = (
        "(s, x) -> named_struct('at', s.at + x.skip + x.size, "
        f"'found', if(x.ok, array_append(s.found, {span}), s.found))"
    )
    none = "cast(array() AS array<struct<kind:string,start:int,end:int,score:double>>)"
    found = f"aggregate({matches}, named_struct('at', 0, 'found', {none}), {step}).found"
    # An array of one, so that the parts are worked out once and get a name.
    return f"if({HINTS[kind].format(t=text)}, element_at(transform(array({_parts(text, kind)}), p -> {found}), 1), {none})"


def find_spans(documents: DataFrame) -> DataFrame:
    """doc_id and ``found``: the spans (kind, start, end in code points, score) of each row, by kind, then start.

    Null texts are empty.  Base kinds are reported whenever their check passes; context only raises their
    score.  The others (IBAN by mod 97, social security number, key or password) have to reach ``THRESHOLD``.
    Spans of different kinds may overlap.  Repeated rows are reported each.
    """
    rows = documents.select("doc_id", text_or_empty("text").alias("text"))
    each = rows.select("doc_id", *[F.expr(spans(kind, "text")).alias(kind) for kind in KINDS])
    return each.select("doc_id", F.concat(*KINDS).alias("found"))


def mask(text: str) -> str:
    """SQL: the text with every accepted span replaced by its kind, one kind after the other."""
    for kind in KINDS:
        pieces = f"transform(p.ms, (m, i) -> concat({_BEFORE}, if({_accepted(kind)}, '[{kind.upper()}]', m)))"
        joined = f"concat(array_join({pieces}, ''), element_at(p.g, -1))"
        masked = f"element_at(transform(array({_parts('t', kind)}), p -> {joined}), 1)"
        text = f"element_at(transform(array({text}), t -> if({HINTS[kind].format(t='t')}, {masked}, t)), 1)"
    return text


def mask_documents(documents: DataFrame) -> DataFrame:
    """The rows with personal data masked in ``text``; ``n_chars`` follows; null texts stay null."""
    masked = F.expr(mask("text"))
    rows = documents.withColumn("text", masked)
    if "n_chars" in documents.columns:
        rows = rows.withColumn("n_chars", F.expr("coalesce(length(text), n_chars)"))
    return rows
