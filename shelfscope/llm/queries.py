"""The operators applied to the given tables, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm.collocations import mine_phrases
from shelfscope.llm.exact_search import nearest_products
from shelfscope.llm.graph_index import nearest_vectors
from shelfscope.llm.lexical_search import search_documents
from shelfscope.llm.line_dedup import dedup_lines
from shelfscope.llm.lm_scoring import score_texts
from shelfscope.llm.mixing import ROUNDS, mix_sources
from shelfscope.llm.ngram_join import jaccard_groups
from shelfscope.llm.packing import pack_documents
from shelfscope.llm.page_text import extract_pages
from shelfscope.llm.quality import fit_quality, score_quality
from shelfscope.llm.substring_dedup import drop_repeated_passages
from shelfscope.llm.vector_dedup import near_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Components by following links from every document; fit for small tables.
COMPONENT_SQL = """
, both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links)
, reached(a, b) AS (
    SELECT a, b FROM both_ways
    UNION
    SELECT reached.a, both_ways.b FROM reached JOIN both_ways ON reached.b = both_ways.a
)
, smallest AS (SELECT a, min(b) AS component FROM reached GROUP BY a)
"""

LOWER_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x20\\x09-\\x0D]+')"
)


@query(f"""
WITH RECURSIVE words AS (SELECT doc_id, {LOWER_WORDS} AS w FROM documents)
, shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM words, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS r(i)
)
, sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id)
, shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS in_common
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
)
, links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * in_common >= 80 * (p.n + q.n - in_common)
)
{COMPONENT_SQL}
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, least(words.doc_id, coalesce(component, words.doc_id)) AS component_id
FROM words LEFT JOIN sizes ON sizes.doc_id = words.doc_id LEFT JOIN smallest ON a = words.doc_id
""")
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose five-word shingle sets overlap by 0.8 or more."""
    return jaccard_groups(table(spark, sf_dir, "documents")).drop("set_id")


# ---- 1: mixing

#: Target shares of tokens. Every value not named is "(other)".
TARGETS = {
    "source": {"src0": 0.1, **{f"src{i}": 0.047 for i in range(1, 20)}, "(other)": 0.007},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.13, "(other)": 0.02},
    "topic": {"contact": 0.05, "legal": 0.1, "table": 0.05, "long prose": 0.5, "short prose": 0.25, "(other)": 0.05},
}
BUDGET = 0.8

#: The tables have no topic; this rule gives a coarse one and is SQL for both engines.
TOPIC_SQL = """CASE WHEN text IS NULL OR text = '' THEN NULL WHEN contains(text, '@') THEN 'contact'
    WHEN contains(lower(text), 'license') THEN 'legal' WHEN contains(text, ' | ') THEN 'table'
    WHEN length(text) >= 3000 THEN 'long prose' ELSE 'short prose' END"""


def _target_rows(margin: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {v!r}::DOUBLE)" for k, v in TARGETS[margin].items()) + ") AS t(name, share)"


def _group_sql(column: str, margin: str) -> str:
    names = ", ".join(f"'{k}'" for k in TARGETS[margin] if k != "(other)")
    return f"CASE WHEN {column} IN ({names}) THEN {column} ELSE '(other)' END"


def _raked(step: str, margin: str) -> str:
    """One step of the fitting: weights times goal over present sum of a margin."""
    column = f"mix_{margin}"
    return f"""SELECT i, mix_source, mix_lang, mix_topic, n, source_goal, lang_goal, topic_goal,
        weight * {margin}_goal / sum(weight * n) OVER (PARTITION BY i, {column}) AS weight FROM ({step})"""


_STEP = "SELECT * FROM fitted WHERE i < " + str(ROUNDS)
for _margin in ("source", "lang", "topic"):
    _STEP = _raked(_STEP, _margin)

MIXING_SQL = f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, text, {_group_sql('source', 'source')} AS mix_source, {_group_sql('lang', 'lang')} AS mix_lang,
        {_group_sql('topic', 'topic')} AS mix_topic,
        greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1) AS mix_tokens
    FROM (SELECT *, {TOPIC_SQL} AS topic FROM documents)
)
, cells AS (SELECT mix_source, mix_lang, mix_topic, sum(mix_tokens)::DOUBLE AS n FROM rows GROUP BY ALL)
, goals AS (
    SELECT margin, name, share / sum(share) OVER (PARTITION BY margin) * (SELECT sum(n) FROM cells) AS goal
    FROM (
        SELECT 'source' AS margin, * FROM ({_target_rows('source')}) WHERE name IN (SELECT mix_source FROM cells)
        UNION ALL SELECT 'lang', * FROM ({_target_rows('lang')}) WHERE name IN (SELECT mix_lang FROM cells)
        UNION ALL SELECT 'topic', * FROM ({_target_rows('topic')}) WHERE name IN (SELECT mix_topic FROM cells)
    )
)
, fitted AS (
    SELECT 0 AS i, cells.*, s.goal AS source_goal, l.goal AS lang_goal, t.goal AS topic_goal, 1.0::DOUBLE AS weight
    FROM cells JOIN goals s ON s.margin = 'source' AND s.name = mix_source JOIN goals l ON l.margin = 'lang' AND l.name = mix_lang
        JOIN goals t ON t.margin = 'topic' AND t.name = mix_topic
    UNION ALL
    SELECT i + 1, mix_source, mix_lang, mix_topic, n, source_goal, lang_goal, topic_goal, weight FROM ({_STEP})
)
, heaviest AS (
    SELECT mix_source, mix_lang, mix_topic, weight, n,
        coalesce(sum(n) OVER (ORDER BY weight DESC, mix_source, mix_lang, mix_topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
        sum(n * weight) OVER (ORDER BY weight DESC, mix_source, mix_lang, mix_topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS below
    FROM fitted WHERE i = {ROUNDS}
)
, factor AS (
    SELECT max_by(({BUDGET} * (SELECT sum(n) FROM cells) - above) / below, weight) AS f FROM heaviest
    WHERE ({BUDGET} * (SELECT sum(n) FROM cells) - above) / below * weight <= 1
)
, chances AS (SELECT mix_source, mix_lang, mix_topic, least(1.0, f * weight) AS probability FROM heaviest, factor)
SELECT doc_id, mix_source, mix_lang, mix_topic, mix_tokens, round(probability, 9) AS probability,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE < probability AS kept
FROM rows JOIN chances USING (mix_source, mix_lang, mix_topic)
"""


def mixed(docs: DataFrame) -> DataFrame:
    return mix_sources(docs, F.expr(TOPIC_SQL), TARGETS, BUDGET)


@query(MIXING_SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probabilities of all documents for the target mix, and the sample."""
    return mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "mix_source", "mix_lang", "mix_topic", "mix_tokens", F.round("probability", 9).alias("probability"), "kept"
    )


# ---- 2: embedding near-dedup


@query(f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)
, links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.93
)
{COMPONENT_SQL}
, counted AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(component, vec_id)) AS component_id,
    vec_id = least(vec_id, coalesce(component, vec_id)) AS kept
FROM embeddings LEFT JOIN counted ON counted.a = vec_id LEFT JOIN smallest ON smallest.a = vec_id
""")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.93 or more, and their groups."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


# ---- 3: nearest neighbours


@query()
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, by inner product."""
    return nearest_vectors(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


# ---- 5: substring dedup


@query("""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)
, windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM words, unnest(range(1, greatest(len(w) - 48, 1))) AS r(i)
)
, firsts AS (SELECT h, min(doc_id) AS holder FROM windows GROUP BY h)
, gone AS (
    SELECT DISTINCT doc_id, i + j AS i FROM (SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE doc_id > holder), unnest(range(0, 50)) AS r(j)
)
, marked AS (
    SELECT words.doc_id, r.i, w[r.i] AS word, gone.i IS NOT NULL AS removed
    FROM words, unnest(range(1, len(w) + 1)) AS r(i) LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = r.i
)
, kept AS (
    SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS t
    FROM marked GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word passages that a smaller id has."""
    return drop_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


# ---- 6: language-model scoring


def crc32_remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query()
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all texts under the filter model and the word baseline."""
    return score_texts(table(spark, sf_dir, "documents"), crc32_remainder(7) == 2)


# ---- 7: quality classifier


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str):
    return fit_quality(docs, table(spark, sf_dir, "labels").where(crc32_remainder(5) != 0))


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc32_remainder(5) == 0, F.lit(False)).alias("held_out")
    return score_quality(docs.select("doc_id", "text"), quality_model(docs, spark, sf_dir)).select("doc_id", held_out, "score", "predicted")


# ---- 8: page text


@query()
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract_pages(table(spark, sf_dir, "pages"), "html", "page_id", "url").withColumn("n_chars", F.length("text").cast("long"))


# ---- 9: packing


@query()
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


# ---- 10: line dedup


@query("""
WITH lines AS (
    SELECT doc_id, i, parts[i] AS line, translate(trim(parts[i], E' \\t\\n\\x0B\\x0C\\r'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, string_split(coalesce(text, ''), E'\\n') AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS r(i)
)
, often AS (
    SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id <> keeper) AS n_dropped,
    sha256(coalesce(string_agg(line, E'\\n' ORDER BY i) FILTER (WHERE keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM lines LEFT JOIN often USING (k) GROUP BY doc_id
""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that five or more share, but for their last holder."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


# ---- 11: phrase collocation mining


@query("""
WITH pieces AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang, r.i AS piece, regexp_extract_all(parts[r.i], '[^\\x20\\x09]+') AS w
    FROM (
        SELECT doc_id, lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\\x0A-\\x0D]') AS parts FROM documents
    ), unnest(range(1, len(parts) + 1)) AS r(i)
)
, totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang)
, counted AS (
    SELECT lang, w[r.i:r.i + s.size - 1] AS p, count(*) AS f
    FROM pieces, (VALUES (1), (2), (3), (4)) AS s(size), unnest(range(1, greatest(len(w) - s.size + 2, 1))) AS r(i) GROUP BY ALL HAVING count(*) >= 30
)
, candidates AS (SELECT lang, p, f AS a FROM counted WHERE len(p) >= 2)
, cuts AS (
    SELECT c.lang, c.p, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
        JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN counted y ON y.lang = c.lang AND y.p = c.p[k + 1:len(c.p)]
)
, lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
, inside AS (
    SELECT lang, p[r.i:r.i + s.size - 1] AS p, max(a) AS most
    FROM candidates, (VALUES (2), (3)) AS s(size), unnest(range(1, greatest(len(p) - s.size + 2, 1))) AS r(i) WHERE len(p) > s.size GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase,
    a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, p) JOIN totals USING (lang)
WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a QUALIFY rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of every language."""
    return mine_phrases(table(spark, sf_dir, "documents"))


# ---- 12: exact top-k search


@query("""
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
, scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
""")
def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer products of every fiftieth vector."""
    return nearest_products(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


# ---- 13: ranked lexical search

TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)


@query(f"""
WITH bags AS (SELECT doc_id, {TERMS} AS w FROM documents)
, corpus AS (SELECT count(*) AS total_docs, sum(len(w))::BIGINT AS total_terms FROM bags WHERE len(w) > 0)
, asked AS (SELECT DISTINCT item_id, unnest({TERMS}) AS t FROM benchmark)
, held AS (SELECT doc_id, len(w) AS n, r.t, count(*) AS tf FROM bags, unnest(w) AS r(t) WHERE r.t IN (SELECT t FROM asked) GROUP BY ALL)
, weights AS (
    SELECT t, floor(1000 * ln((2 * total_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM held, corpus GROUP BY t, total_docs
)
, scores AS (
    SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * total_docs) // total_terms))))::BIGINT AS score
    FROM asked JOIN held USING (t) JOIN weights USING (t), corpus GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
