import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import odd_rows, rows_of
from pyspark.sql import functions as F

from statline.llm import quality
from statline.llm.quality import QualityModel, classify, counts


def test_votes_equal_one_by_one(spark, docs):
    from conftest import SMALL
    model = QualityModel.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    texts = [r.text for r in docs.orderBy("doc_id").limit(30).collect()]
    got = model.votes(pa.array(texts))
    for text, score in zip(texts, got):
        x = np.log1p(counts(pa.array([text]))[0].astype(float)) * model.idf
        x = x / max(np.linalg.norm(x), 1e-9) @ model.basis
        cosine = model.vectors @ (x / max(np.linalg.norm(x), 1e-9))
        near = np.argsort(-cosine)[:quality.NEIGHBOURS]
        w = np.maximum(cosine[near], 0) ** quality.SHARPNESS
        tied = np.isclose(np.sort(cosine)[::-1][quality.NEIGHBOURS - 1], np.sort(cosine)[::-1][quality.NEIGHBOURS])
        assert tied or abs(score - (w * model.labels[near]).sum() / w.sum()) < 1e-3


def test_held_out_accuracy(spark):
    from statline.llm.queries import QUERIES
    mid = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{mid}/labels.parquet").collect()}
    rows = QUERIES["op9_quality"](spark, mid).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    good, bad = (np.array([s for s, l in held if l == k]) for k in (1, 0))
    assert (good[:, None] > bad).mean() >= 0.95 and (good >= 0.3).mean() >= 0.97


def test_labels_of_held_out_rows_do_not_teach(spark, docs):
    from conftest import SMALL
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    spoiled = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = QualityModel.fit(docs, labels), QualityModel.fit(docs, spoiled)
    assert np.array_equal(a.labels, b.labels) and np.array_equal(a.vectors, b.vectors)


def test_odd_documents(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(0, 1, 0), (1, None, 0), (6, 0, 0), (None, 1, 0), (6, 0, 0), (4, 0, 0), (23, 1, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = QualityModel.fit(odd, labels)
    rows = classify(odd, model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    base = float(model.labels.mean())
    assert all(r.score == base for r in rows if r.doc_id in (3, 4, 5))  # nothing to compare: the mean label
    assert rows_of(classify(odd, model)) == rows_of(classify(clashing, model))
    assert classify(empty, model).collect() == []
    untaught = QualityModel.fit(odd, labels.limit(0))
    assert {(r.score, r.predicted) for r in classify(odd, untaught).collect()} == {(0.5, 1)}


def test_texts_of_other_words_with_like_marks_differ():
    hello, bye, kanji, other = counts(pa.array(["Hello hello another", "Goodbye goodbye someone", "言語処理の研究", "天気予報を見る"]))
    assert not np.array_equal(hello, bye) and np.array_equal(hello[:quality.MARKS], bye[:quality.MARKS])
    assert (np.minimum(kanji, other)[quality.MARKS:]).sum() == 0 and kanji[quality.MARKS:].sum() == 6
    same = counts(pa.array(["a-b $$$ C.", "A b c"]))
    assert np.array_equal(same[0][quality.MARKS:], same[1][quality.MARKS:])


@pytest.mark.parametrize("good, bad, gap", [("tree river stone cloud meadow", "casino bonus winner prize click", " "),
                                            ("言語処理研究論文本", "賭博勝利賞金無料券", "")])
def test_words_alone_tell_spam(spark, good, bad, gap):
    """Both kinds have words of like shapes, and no mark or repeat."""
    draw = np.random.default_rng(1)
    rows = []
    for i in range(400):
        text = good if i % 2 else bad
        rows.append((i, gap.join(draw.permutation(text.split() if gap else list(text))[:4]), i % 2))
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = classify(table, QualityModel.fit(table, table.select("doc_id", "quality"))).where("held_out").collect()
    assert len(got) > 40 and all(r.predicted == r.doc_id % 2 for r in got)


def test_axes_are_the_singular_vectors(spark, monkeypatch):
    monkeypatch.setattr(quality, "LATENT", 5)
    monkeypatch.setattr(quality, "SETTLED", 1e-7)
    monkeypatch.setattr(quality, "TASK_BYTES", 2000)  # several tasks, whose products are added up
    draw = np.random.default_rng(2)
    n = draw.integers(1, 9, (40, 60)) * (draw.random((40, 60)) < 0.3)
    n[:, :3] = draw.integers(1, 40, (40, 3))
    n[7] = 0
    rows = [(i, float(i % 2), np.flatnonzero(r).astype("<i4").tobytes(), r[r > 0].astype("<f4").tobytes()) for i, r in enumerate(n)]
    table = spark.createDataFrame(rows, "doc_id long, quality double, features binary, counts binary").repartition(5)
    taught = quality._Taught(table, np.flatnonzero(n.any(axis=0)))
    idf = np.ones(quality.FEATURES)
    dense = np.log1p(n)
    dense = dense / np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    assert taught.size > quality.TASK_BYTES
    got, place, marks = taught.main_axes(idf)
    want = np.linalg.svd(dense[:, taught.used])[2][:5].T
    assert np.allclose(got @ got.T, want @ want.T, atol=2e-2)
    assert np.allclose(taught.product(idf, got), dense[:, taught.used].T @ (dense[:, taught.used] @ got), atol=1e-4)
    assert np.allclose(place, dense[:, taught.used] @ got, atol=1e-5) and list(marks) == [i % 2 for i in range(40)]
    monkeypatch.setattr(quality, "TASK_BYTES", 1 << 20)  # all rounds in one task
    one, place, marks = quality._Taught(table, taught.used).main_axes(idf)
    first = one[:, :5]  # workers keep the module's own number of axes
    assert np.allclose(first @ first.T, want @ want.T, atol=2e-2) and list(marks) == [i % 2 for i in range(40)]
    assert np.allclose(place, dense[:, taught.used] @ one, atol=1e-5)


def test_labelled_rows_without_words(spark):
    table = spark.createDataFrame([(i, " ", i % 2) for i in range(20)], "doc_id long, text string, quality int")
    model = QualityModel.fit(table, table.select("doc_id", "quality"))
    assert {r.score for r in classify(table, model).collect()} == {float(model.labels.mean())}


def test_few_megabytes_of_text_are_counted_at_once(monkeypatch):
    from statline.llm import quality

    seen = []
    count = quality.sparse_counts
    monkeypatch.setattr(quality, "sparse_counts", lambda texts: seen.append(texts.nbytes) or count(texts))
    model = quality.QualityModel(np.ones(quality.FEATURES), np.ones((quality.FEATURES, 2), np.float32), np.ones((3, 2)), np.ones(3))

    class Shared:
        value = (model.idf, model.basis, model.vectors, model.labels)

    class Spark:
        class sparkContext:
            broadcast = staticmethod(lambda value: Shared)

    functions = []
    monkeypatch.setattr(quality.F, "arrow_udf", lambda function, kind: functions.append(function) or (lambda column: column))
    model.spark = Spark
    model.score(None)
    texts = pa.array([f"word{i} of text " * 7000 for i in range(90)])
    assert len(functions[0](texts)) == 90
    assert max(seen) < 5 << 20 < texts.nbytes
