import hashlib
from collections import defaultdict

import pytest

from cellar.llm import line_dedup as ld

WHITE = " \t\n\x0b\x0c\r"


def _lower(s):
    return "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in s)


def brute(rows, min_docs=10):
    seen = defaultdict(set)
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            key = _lower(line.strip(WHITE))
            if key:
                seen[key].add(i)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(seen[_lower(x.strip(WHITE))]) < min_docs]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    out = [(i, f"Common Line\nown line {i}\n common line\t\n Common line") for i in range(12)]
    out += [(20, None), (21, ""), (22, "\n\n \n"), (None, "common LINE"), (None, None)]
    out += [(23, "x" * 50_000 + "\n" + "\n".join(f"row {i % 7}" for i in range(3_000)))] + [(24 + i, "row 1\nrow 2") for i in range(8)]
    out += [(40, "twice the same row\nCOMMON line")] * 2 + [(41, "Ünï\nünï")]
    return out


@pytest.mark.parametrize("bits", [27, 6])
def test_against_brute_force(spark, docs_of, bits):
    """Also with filters that are far too small: more suspects, same result."""
    from pyspark.sql import functions as F
    got = ld.dedup_lines(docs_of(rows()), filter_bits=bits).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows())


def test_first_occurrence_stays(spark, docs_of):
    data = [(5, "b\nrepeat\nc"), (2, "repeat\nd\nRepeat"), (9, "repeat")]
    got = {r.doc_id: r.kept_text for r in ld.dedup_lines(docs_of(data), min_docs=2, keep_first=True).collect()}
    assert got == {2: "repeat\nd", 5: "b\nc", 9: ""}


def test_empty_table_and_carried_columns(spark, docs_of):
    assert ld.dedup_lines(docs_of([])).count() == 0
    out = ld.dedup_lines(docs_of([(1, "a")])).first()
    assert out.rest.row_key == "x" and out.rest.lang == "en"
