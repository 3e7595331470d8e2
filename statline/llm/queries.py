"""Queries ``opN_<name>`` over whole tables, their SQL where it can state them, and the pipeline's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def tokenizer_path(name: str) -> str:
    """Where the installed package of public vocabularies has the file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_register("op2_mix_sources")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(_table(spark, sf_dir, "documents"))


@_register("op3_shard")
def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(_table(spark, sf_dir, "documents"))


@_register("op5_pack")
def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack, token_pieces

    return pack(token_pieces(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


@_register("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokencount import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@_register("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import LanguageModel, identify

    docs = _table(spark, sf_dir, "documents")
    return identify(docs, LanguageModel.fit(docs))


@_register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import QualityModel, classify

    docs = _table(spark, sf_dir, "documents")
    return classify(docs, QualityModel.fit(docs, _table(spark, sf_dir, "labels")))


@_register("op7_near_copies")
def op7_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_copies

    return near_copies(_table(spark, sf_dir, "documents"), words=2).drop("text_hash")


@_register("op1_top_k", """
WITH t AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM t q JOIN t c ON q.vec_id % 20 = 0 AND c.r <> q.r),
r AS (SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""")
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .maxscore import top_k

    return top_k(_table(spark, sf_dir, "embeddings")).drop("query_row")


@_register("op10_nearest")
def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vamana import nearest

    return nearest(_table(spark, sf_dir, "embeddings")).drop("query_row")


@_register("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .licenses import scan

    return scan(_table(spark, sf_dir, "documents")).withColumn("sentences", F.concat_ws(",", "sentences"))


@_register("op11_ranked_search", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
f AS (SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
t AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM f),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
u AS (SELECT r, doc_id, n, unnest(terms) AS term FROM f),
p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM u WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, t GROUP BY term),
s AS (SELECT i.item_id, p.doc_id, p.r, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
      FROM i JOIN p USING (term) JOIN w USING (term), t GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 50""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .accumulators import ranked

    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_register("op12_line_dedup", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 3),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone FROM k LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY r""")
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .linedup import without_shared_lines

    kept = without_shared_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _codes_sql(rounds: int = 4, entries: int = 256, parts: int = 4) -> str:
    """Product codes with every distance written out; ``rounds`` moves of the entries."""
    nearest = """SELECT p.r, p.part, min({{'d': p.xx - 2 * list_dot_product(p.x, c.x) + list_dot_product(c.x, c.x), 'entry': c.entry}}) AS best
      FROM p JOIN c{n} c ON p.part = c.part GROUP BY p.r, p.part"""
    steps = [f"""e AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""p AS MATERIALIZED (SELECT r, vec_id, part, x, list_dot_product(x, x) AS xx FROM (
           SELECT r, vec_id, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x
           FROM e, (SELECT unnest(range({parts})) AS part)))""",
             f"""c0 AS MATERIALIZED (SELECT part, entry, x FROM (
           SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < {entries})"""]
    for n in range(rounds):
        steps.append(f"a{n} AS MATERIALIZED ({nearest.format(n=n)})")
        steps.append(f"""m{n} AS (SELECT part, entry, list(middle ORDER BY pos) AS x FROM (
           SELECT part, entry, pos, floor(sum(v) / count(*)) AS middle FROM (
             SELECT a.part, a.best.entry AS entry, unnest(p.x) AS v, generate_subscripts(p.x, 1) AS pos
             FROM a{n} a JOIN p ON a.r = p.r AND a.part = p.part) GROUP BY part, entry, pos) GROUP BY part, entry)""")
        steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{n} c
           LEFT JOIN m{n} m ON c.part = m.part AND c.entry = m.entry)""")
    steps.append(f"z AS MATERIALIZED ({nearest.format(n=rounds)})")
    steps.append(f"""h AS (SELECT sha256(string_agg(x_text, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (
           SELECT part, entry, array_to_string(list_transform(x, lambda v: v::BIGINT::VARCHAR), ',') AS x_text FROM c{rounds}))""")
    steps.append("""g AS (SELECT r, string_agg(printf('%02x', best.entry::INTEGER), '' ORDER BY part) AS code,
           sum(best.d)::BIGINT AS error FROM z GROUP BY r)""")
    return "WITH " + ",\n".join(steps) + """
SELECT e.vec_id, g.code, g.error, sum(g.error) OVER (PARTITION BY e.label)::BIGINT AS label_error, h.codebooks_sha256
FROM e JOIN g ON e.r = g.r, h"""


@_register("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .anchors import compress, digest, with_label_error

    coded, books = compress(_table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
