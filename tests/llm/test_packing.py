import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellar.llm import packing as pk

try:
    TOKENIZER = pk.default_tokenizer()
except ImportError:
    TOKENIZER = None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_runs_are_best_fit_decreasing(sizes):
    """The runs place every piece as plain best fit, longest first, does."""
    capacity = 30
    counts = {s: sizes.count(s) for s in set(sizes)}
    runs, n = pk.best_fit(counts, capacity)
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    assert n == len(gaps)
    held = {}
    for size in counts:
        mine = sorted(r for r in runs if r[0] == size)
        for rank in range(counts[size]):
            _, first, bin0, each, offset = [r for r in mine if r[1] <= rank][-1]
            held.setdefault(bin0 + (rank - first) // each, []).append((offset + (rank - first) % each * size, size))
    assert len(held) == n
    for places in held.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= capacity


@pytest.mark.skipif(TOKENIZER is None, reason="no tokenizer files here")
def test_ids_of_added_tokens():
    """As the tokenizer file gives them, not spelled out."""
    from tokenizers import Tokenizer
    ids = pk.word_ids(TOKENIZER).text
    t = Tokenizer.from_file(TOKENIZER)
    for text in ("end <|endoftext|> of", "<|startoftext|>a", "A <|EndOfText|> b"):
        assert np.frombuffer(ids(text), np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.skipif(TOKENIZER is None, reason="no tokenizer files here")
def test_round_trip(spark, docs_of):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    odd = "Ünḯ CAFÉ's İstanbul ΣΑΣ x²½ \x1c\x1d a b 日本 <|endoftext|> don't 12,5€ ﬁ ǅͅ \x7f" + " é  x"
    data = [(1, None), (2, ""), (3, odd), (None, "a b c"), (4, "same text"), (4, "same text"), (5, "word " * 20_000),
            (6, "x" * 3_000), (7, "end <|endoftext|> of"), (8, "é x<|endoftext|>y<|startoftext|> <|ENDOFTEXT|> z"),
            (9, "<|endoftext|>"), (91, "<| endoftext |>"), (92, " ".join(f"long{'y' * 70}{i}" for i in range(300))), *[(10 + i, "copy of a text") for i in range(50)]]
    out = pk.pack(pk.cut_pieces(docs_of(data), TOKENIZER, 512, with_ids=True), 512).collect()
    want = {}
    for doc, text in data:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault((doc, tuple(ids)), 0)
        want[doc, tuple(ids)] += 1
    texts = {}
    for r in out:
        assert r.length == len(r.ids) and r.start == r.piece * 512
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        texts.setdefault(r.doc_id, []).append((r.piece, tuple(r.ids)))
    for (doc, ids), n in want.items():
        cut = [ids[i:i + 512] for i in range(0, len(ids), 512)]
        assert all(texts[doc].count((k, x)) == n for k, x in enumerate(cut))
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(bins) <= -(-sum(r.length for r in out) // 512) + 1
    assert pk.pack(pk.cut_pieces(docs_of([]), TOKENIZER)).count() == 0
