import itertools
import math
import zlib

import numpy as np
import public_tokenizers
from corpus_rows import odd_rows, rows_of
from pyspark.sql import functions as F

from statline.llm import langid
from statline.llm.langid import LanguageModel, identify, piece_keys, usable_pieces, word_scores


def by_listing(word: str, pieces: dict[str, float]) -> float:
    """Log of the sum over all segmentations, one by one."""
    marked, total = "▁" + word, 0.0
    for k in range(len(marked)):
        for cuts in itertools.combinations(range(1, len(marked)), k):
            parts = [marked[a:b] for a, b in zip((0, *cuts), (*cuts, len(marked)))]
            p = 1.0
            for part in parts:
                p *= pieces.get(part, langid.UNSEEN if len(part) == 1 else 0.0)
            total += p
    return math.log(total)


def test_forward_sums_all_segmentations():
    pieces = {"▁": .1, "a": .2, "b": .1, "ab": .15, "▁a": .12, "ba": .05, "aba": .02, "▁ab": .03}
    names = list(pieces)
    keys = piece_keys(names)
    order = np.argsort(keys)
    table = np.append(np.array(list(pieces.values()))[order], 0.0)[:, None]
    words = ["a", "ab", "aba", "abab", "bbaab", "axb", "é"]
    got = word_scores(words, keys[order], table)[:, 0]
    assert np.allclose(got, [by_listing(w, pieces) for w in words])
    long = "ab" * 100
    parts = [("▁" + long)[i:i + langid.LONGEST_WORD] for i in range(0, 201, langid.LONGEST_WORD)]
    one = sum(by_parts(p, pieces) for p in parts)
    assert math.isclose(word_scores([long], keys[order], table)[0, 0], one)


def by_parts(part: str, pieces: dict[str, float]) -> float:
    alpha = [1.0] + [0.0] * len(part)
    for end in range(1, len(part) + 1):
        for n in range(1, min(end, langid.LONGEST_PIECE) + 1):
            piece = part[end - n:end]
            alpha[end] += alpha[end - n] * pieces.get(piece, langid.UNSEEN if n == 1 else 0.0)
    return math.log(alpha[-1])


def test_pieces_have_distinct_keys():
    pieces = usable_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert len(set(piece_keys(pieces).tolist())) == len(pieces) > 5000


def test_held_out_accuracy(spark, docs):
    from conftest import SMALL

    from statline.llm.queries import QUERIES
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = QUERIES["op4_language_id"](spark, SMALL).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.97


def test_only_the_other_rows_teach(docs):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    spoiled = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))) \
                  .withColumn("text", F.when(held, F.lit("zzz")).otherwise(F.col("text")))
    a, b = LanguageModel.fit(docs), LanguageModel.fit(spoiled)
    assert a.languages == b.languages and np.array_equal(a.keys, b.keys) and np.allclose(a.probability, b.probability)


def test_odd_documents(odd, docs, clashing):
    model = LanguageModel.fit(docs)
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify(odd, model).collect()]
    assert len(got) == len(odd_rows())
    for doc_id, lang, score in got:
        if doc_id in (3, 4, 5):
            assert (lang, score) == ("und", 0.0)
        elif doc_id is not None:
            assert lang in model.languages and 0 <= score <= 1
    assert rows_of(identify(odd, model)) == rows_of(identify(clashing, model))
    kept = {r.doc_id for r in odd.where(model.accepts(F.col("text"))).collect()}
    assert not kept & {3, 4, 5}


def test_empty(spark, empty, odd, docs):
    assert identify(empty, LanguageModel.fit(docs)).collect() == []
    untaught = LanguageModel.fit(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in identify(odd, untaught).collect()} == {"und"}


def test_clean_documents_stay(spark, docs):
    model = LanguageModel.fit(docs)
    assert docs.where(~model.accepts(F.col("text"))).count() == 0


def test_long_words_are_summed_and_taught_whole(monkeypatch):
    """Blocks of 8, 512 and all characters agree, and the tail of a long word teaches."""
    pieces = {"▁": .1, "a": .2, "b": .1, "ab": .15, "▁a": .12, "ba": .05, "aba": .02, "babbab": .03, "c": .1, "ccb": .05}
    keys = piece_keys(list(pieces))
    order = np.argsort(keys)
    table = np.append(np.array(list(pieces.values()))[order], 0.0)[:, None]
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("abcx"), n, p=[.4, .4, .1, .1])) for n in (1, 2, 5, 7, 8, 9, 15, 16, 17, 31, 40, 40, 100)]
    marked, weight = ["▁" + w for w in words], draw.random(len(words)) + 0.5
    uses = np.zeros(len(pieces))
    for word, w in zip(marked, weight):  # every piece at every place: alpha times piece times beta over the whole
        n = len(word)
        chance = lambda a, b: pieces.get(word[a:b], langid.UNSEEN if b - a == 1 else 0.0)  # noqa: B023, E731
        alpha, beta = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        for e in range(1, n + 1):
            alpha[e] = sum(alpha[a] * chance(a, e) for a in range(max(0, e - 6), e))
        for a in range(n - 1, -1, -1):
            beta[a] = sum(chance(a, e) * beta[e] for e in range(a + 1, min(n, a + 6) + 1))
        for i, piece in enumerate(np.array(list(pieces))[order]):
            uses[i] += sum(w * alpha[a] * pieces[piece] * beta[a + len(piece)] / alpha[n]
                           for a in range(n - len(piece) + 1) if word.startswith(piece, a))
    for block, rescale, at_once in ((8, 4, 1), (512, 16, 640_000), (7, 16, 60), (1 << 20, 3, 640_000)):
        monkeypatch.setattr(langid, "BLOCK", block)
        monkeypatch.setattr(langid, "RESCALE", rescale)
        monkeypatch.setattr(langid, "CHARS_AT_ONCE", at_once)
        assert np.allclose(word_scores(words, keys[order], table)[:, 0], [by_parts(m, pieces) for m in marked], rtol=1e-10)
        assert np.allclose(langid._expectation(marked, weight, keys[order], table), uses, rtol=1e-8)
    endless = word_scores(["ab" * 20_000], keys[order], table)[0, 0]  # far below the least float
    assert np.isfinite(endless) and math.isclose(endless, 2 * word_scores(["ab" * 10_000], keys[order], table)[0, 0], rel_tol=1e-3)


def test_tail_of_unspaced_text_teaches(spark):
    """Both languages' texts start alike for 40 characters."""
    rows = [(i, "天地人" * 14 + ("水木火土" if i % 2 else "金銀銅鉄") * 10, "xy"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = identify(docs.withColumn("text", F.substring("text", 43, 20)), LanguageModel.fit(docs)).collect()
    assert {(r.doc_id % 2, r.lang_pred) for r in got} == {(0, "x"), (1, "y")}
