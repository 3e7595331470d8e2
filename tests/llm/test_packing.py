from collections import defaultdict
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from corpus_rows import odd_rows, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statline.llm.packing import best_fit, pack, token_pieces
from statline.llm.wordbpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_words_equal_the_library(words):
    library = Tokenizer.from_file(PATH)
    words = [w for text in words for w in pa.compute.ascii_split_whitespace(pa.array([text]))[0].as_py() if w]
    lengths, starts, ids = WordBpe.load(PATH).encode_words(pa.array(words, pa.string()))
    for w, n, s in zip(words, lengths, starts):
        assert ids[s:s + n].tolist() == library.encode(w, add_special_tokens=False).ids


def test_best_fit_takes_the_tightest_bin():
    assert best_fit([6, 5, 4, 3, 2], 10).tolist() == [0, 1, 0, 1, 1]


def check_packing(rows, texts, capacity=2048):
    library = Tokenizer.from_file(PATH)
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for doc_id, text in texts:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            one = ids[at:at + capacity]
            want[doc_id].append((k, at, len(one), zlib.crc32(one.tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    total = sum(n for v in want.values() for _, _, n, _ in v)
    return len(sequences), -(-total // capacity)


def test_odd_documents_pack_whole(odd):
    used, least = check_packing(pack(token_pieces(odd, PATH)).collect(), [r[:2] for r in odd_rows()])
    assert used <= least + 1


def test_whole_table_near_the_least_number(spark, docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    # small tasks make several rounds of bins as items
    used, least = check_packing(pack(token_pieces(docs, PATH), items_per_task=30).collect(), texts)
    assert used <= 1.03 * least + 1


def test_pieces_that_share_no_bin_end(spark):
    rows = spark.range(500).selectExpr("id doc_id", "0 piece", "0L start", "1100L length", "0L ids_crc32")
    out = pack(rows, items_per_task=50).collect()
    assert len({r.sequence_id for r in out}) == 500 and all(r.offset == 0 for r in out)


def test_empty_and_clashing(empty, odd, clashing):
    assert pack(token_pieces(empty, PATH)).collect() == []
    assert rows_of(token_pieces(odd, PATH)) == rows_of(token_pieces(clashing, PATH))


@pytest.mark.parametrize("name", ["op5_pack"])
def test_query(spark, docs, name):
    from conftest import SMALL

    from statline.llm.queries import QUERIES
    used, least = check_packing(QUERIES[name](spark, SMALL).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= 1.02 * least + 1


def test_few_megabytes_of_text_are_tokenized_at_once(spark, monkeypatch):
    import pyarrow as pa

    from statline.llm import packing

    class Docs:  # hands out the function that tasks run
        sparkSession = spark

        def select(self, *_):
            return self

        def mapInArrow(self, function, schema):
            return function

    seen = []
    split = packing.split_words
    monkeypatch.setattr(packing, "split_words", lambda texts: seen.append(texts.nbytes) or split(texts))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": [f"word{i} of text " * 7000 for i in range(60)]})
    out = list(packing.token_pieces(Docs(), PATH)(iter([batch])))
    assert max(seen) < 3 << 20 < batch.nbytes
    got = pa.Table.from_batches(out)
    assert sorted(set(got.column("doc_id").to_pylist())) == list(range(60))
