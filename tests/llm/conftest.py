import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from made_up import prose  # noqa: E402

#: Names that the operators use for columns of their own.
CLASHING = ["row", "words", "text_key", "runs", "found", "key", "weight", "node", "k1", "t", "p", "m", "n_tokens", "changed"]


@pytest.fixture(scope="session")
def docs():
    """(id, text) rows: null and empty texts, a null id, repeated rows, copies, near copies, a long text, odd characters."""
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(5, 220))) for i in range(40)]
    base = prose(rng, 150)
    rows += [(100, base), (101, base), (102, base.upper()), (100, base)]
    for i in range(8):
        words = base.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((110 + i, " ".join(words)))
    passage = prose(rng, 90)
    rows += [(130 + i, prose(rng, 60) + "\n" + passage + "\n" + prose(rng, 60)) for i in range(4)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, None), (204, "!!! ???"), (205, "one two"), (206, "one two")]
    rows += [(None, "no id here"), (None, None), (210, prose(rng, 9000)), (211, "a" * 3000), (212, "x y " * 700)]
    rows += [
        (220, "Schöne Grüße an ééé   日本語 😀 ▁ 　 İ ﬁ T̈ \x00 \x85 <|endoftext|> <s>"),
        (221, "mail a.b@c.de, ip 10.0.0.255 and 1.2.3.256, card 4111 1111 1111 1111, call +49 (30) 1234-567."),
        (222, "a@b.c_d@e.f é x@y 1.2.3.4.5.6.7.8 4111-1111-1111-1112 +1 23 +123456789012345678"),
        (223, "line\nline\nline \n\nother | a & b # $ % < > *"),
        (224, "LINE LINE " * 30),
    ]
    return rows


@pytest.fixture(scope="session")
def frame(spark, docs):
    """The rows as a documents table with more columns, some of clashing names."""
    extra = ", ".join(f"{name} string" for name in CLASHING)
    wide = [(i, t, "en", None, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in docs]
    return spark.createDataFrame(wide, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")


@pytest.fixture(scope="session")
def empty(frame):
    return frame.limit(0)
