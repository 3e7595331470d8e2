import numpy as np
import public_tokenizers
import pytest
from corpus_rows import odd_rows, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statline.llm.tokencount import PrefixCounter, prefix_counts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["the", " the", "  ", "\n", "\n\n", " ", "'re", "'ll", "'s", "don't", "12", ".", "!!", "é", "ß", "中", "\t", "<|endoftext|>",
         "<|endo", "ing", "tion", "A", " ", " ", "x1"]


def count(text: str) -> int:
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=9).map("".join))
def test_every_prefix_equals_the_library(text):
    got = PrefixCounter.load(PATH).counts(text)
    assert got.tolist() == [count(text[:i]) for i in range(1, len(text) + 1)]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_any_text_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    got = PrefixCounter.load(PATH).counts(text)
    assert (got[-1] if len(got) else 0) == count(text)


def longest(text: str, limit: int) -> int:
    return max((i for i in range(len(text) + 1) if count(text[:i]) <= limit), default=0)


def test_odd_documents(odd):
    got = sorted(token_counts(odd, PATH, limit=20).collect(), key=repr)
    want = sorted((r[0], len((r[1] or "").encode()), count(r[1] or "")) for r in odd_rows() if r[0] is not None)
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got if r.doc_id is not None) == want
    texts = {r[0]: r[1] or "" for r in odd_rows() if len(r[1] or "") < 500}
    for r in got:
        assert r.over_limit == (r.n_tokens > 20)
        if r.doc_id in texts and r.doc_id is not None:
            assert r.keep_chars == longest(texts[r.doc_id], 20)


def test_prefix_table(odd):
    got = {r.doc_id: r.counts for r in prefix_counts(odd, PATH).collect()}
    for doc_id, text, *_ in odd_rows():
        if doc_id is not None and len(text or "") < 200:
            assert got[doc_id] == [count(text[:i]) for i in range(1, len(text) + 1)] if text else got[doc_id] == []


def test_empty_and_clashing(empty, odd, clashing):
    assert token_counts(empty, PATH).collect() == []
    assert rows_of(token_counts(odd, PATH)) == rows_of(token_counts(clashing, PATH))


@pytest.mark.parametrize("name", ["op6_token_counts"])
def test_query(spark, docs, name):
    from conftest import SMALL

    from statline.llm.queries import QUERIES
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES[name](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (count(texts[r.doc_id]), len(texts[r.doc_id].encode()), r.n_tokens > 512)
    some = sorted(rows, key=lambda r: r.doc_id)[::9]
    for r in some:
        text = texts[r.doc_id]
        at = np.arange(max(0, r.keep_chars - 3), min(len(text), r.keep_chars + 12) + 1)
        fits = [int(i) for i in at if count(text[:i]) <= 512]
        assert fits[-1] == r.keep_chars


def test_unspaced_text_equals_the_library_in_bounded_memory(monkeypatch):
    """Long texts without spaces: counts at every prefix, parts cut where no token crosses, nothing long kept."""
    import random

    from statline.llm import tokencount
    from statline.llm.queries import tokenizer_path
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    monkeypatch.setattr(tokencount, "KEPT_BYTES", 200_000)
    counter, library = tokencount.PrefixCounter(path), Tokenizer.from_file(path)
    draw = random.Random(5)
    kinds = [(0x4E00, 0x9FA5), (0x3040, 0x30FF), (0xAC00, 0xD7A3), (0x61, 0x7A), (0x1F300, 0x1F5FF), (0x0E01, 0x0E2E)]
    for i in range(60):
        low, high = kinds[i % len(kinds)]
        text = "".join(chr(draw.randint(low, high)) for _ in range(300))
        counts = counter.counts(text)
        for end in (1, 2, 63, 64, 65, 66, 150, 299, 300):
            assert counts[end - 1] == len(library.encode(text[:end], add_special_tokens=False).ids)
    assert not any(len(t) > tokencount.LONGEST_KEPT for kept in (counter.chunks, counter.pieces, counter.parts_of) for t in kept)
    assert all(kept.size <= 200_000 for kept in (counter.chunks, counter.pieces, counter.parts_of))
