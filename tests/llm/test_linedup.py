import hashlib
import re
from collections import defaultdict

from corpus_rows import odd_rows, rows_of

from statline.llm.linedup import LineRuns, hashed_lines, without_shared_lines

SPACE = " \t\n\x0b\f\r"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def brute(docs, least_length=20, least=3):
    held = defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= least_length:
                held[key_of(line)].add(d)
    keeper = {k: max((d for d in ids if d is not None), default=None) for k, ids in held.items() if len(ids) >= least}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        stays = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == d]
        out.append((d, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return sorted(out, key=repr)


def found(spark, docs, **how):
    return rows_of(without_shared_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), **how))


def lines_in_common(n, seed=0):
    import random
    rnd = random.Random(seed)
    pool = [f"Shared Line number {i} of them all" for i in range(30)]
    return [(i, "\n".join(rnd.choice(pool).upper() if rnd.random() < 0.2 else rnd.choice((rnd.choice(pool), f" own line of document {i} {rnd.random()}", "short"))
                          for _ in range(rnd.randrange(1, 12)))) for i in range(n)]


def test_equals_counting(spark):
    docs = lines_in_common(150)
    assert found(spark, docs) == brute(docs)
    assert found(spark, docs, batches=4, fan=2, least=5, least_length=6) == brute(docs, 6, 5)
    assert found(spark, docs, batches=1) == brute(docs)


def test_odd_rows(spark):
    hot = "a line that a third of all documents have in common"
    docs = [r[:2] for r in odd_rows()]
    docs += [(100 + i, f"\n{hot}\n own {i}\n\t{hot.upper()} \r\n") for i in range(40)]
    docs += [(None, hot), (None, "x" * 30), (200, "x" * 30), (200, "x" * 30), (201, "y" * 19 + " "), (202, "y" * 19), (203, "y" * 19)]
    docs += [(205, "é" * 20), (206, "É" * 20), (207, "é" * 20), (208, "é" * 20)]  # only A-Z are folded
    docs += [(300, "\n".join(f"line {i % 700} of a very long document" for i in range(20_000)))]
    docs += [(301 + i, "\n".join(f"line {j} of a very long document" for j in range(0, 700, 2))) for i in range(2)]
    docs += [(100, "another text under an id that came before\n" + hot)]
    assert found(spark, docs) == brute(docs)


def test_every_document_equal(spark):
    docs = [(i, "one and the same line of text\nand a second one, as long") for i in range(30)]
    got = found(spark, docs)
    assert got == brute(docs) and [r for r in got if r[2] == 0] == [(29, 2, 0, docs[0][1])]


def test_empty_and_clashing(empty, odd, clashing):
    assert without_shared_lines(empty).collect() == []
    assert rows_of(without_shared_lines(odd)) == rows_of(without_shared_lines(clashing))


def test_levels_and_settled_lines(spark):
    """Runs are merged level by level, a settled line is written once, and any order of batches settles the same."""
    hot = "this line is part of every document"
    rows = [(i, f"{hot}\nonly in document number {i}, nowhere else") for i in range(80)]
    lines = hashed_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    runs = LineRuns(spark, fan=3)
    for b in reversed(range(8)):
        runs.add(lines.where(f"doc_id between {10 * b} and {10 * b + 9}"))
        assert all(len(level) < 3 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [2, 2]
    entries = [spark.table(name).count() for name in runs.runs()]
    assert sum(entries) == 81  # 80 lines of their own and the hot one once
    assert [r.keeper for r in runs.shared().collect()] == [79]
    upward = LineRuns(spark, fan=3)
    for b in range(8):
        upward.add(lines.where(f"doc_id between {10 * b} and {10 * b + 9}"))
    assert rows_of(upward.shared()) == rows_of(runs.shared())
    plan = spark.table(runs.runs()[0])._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan or "bucket" in plan.lower()
    names = runs.runs()
    runs.drop()
    upward.drop()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_query_equals_its_sql(spark, duck):
    from conftest import SMALL

    from statline.llm.queries import ORACLES, QUERIES
    want = duck.execute("SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM (" + ORACLES["op12_line_dedup"] + ")").fetchall()
    got = QUERIES["op12_line_dedup"](spark, SMALL).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert rows_of(got) == sorted(want, key=repr)
    assert {len(r[3]) for r in want} == {len(hashlib.sha256(b"").hexdigest())}


def test_plan_is_native(spark, docs):
    plan = without_shared_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
