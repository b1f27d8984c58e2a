"""Registered queries of this subpackage, with production parameters, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stocktide.llm.store import workers_see_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_see_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_byte_bpe")
def byte_bpe(spark, sf_dir):
    from stocktide.llm.bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))


@query("op9_packing")
def packing(spark, sf_dir):
    from stocktide.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op1_language_id")
def language_id(spark, sf_dir):
    from stocktide.llm import langid

    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@query("op7_toxicity")
def toxic_text(spark, sf_dir):
    from stocktide.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op8_quality")
def quality_votes(spark, sf_dir):
    from stocktide.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.predict(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query("op2_bit_sliced_top_k", """
WITH v AS (
    SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = len(embedding)
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""")
def bit_sliced_top_k(spark, sf_dir):
    from stocktide.llm.topk import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query("op6_nn_descent", """
WITH RECURSIVE v AS (
    SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = len(embedding)
      AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
    WHERE list_cosine_similarity(a.q, b.q) >= 0.9
), reach(u, w) AS (
    SELECT u, w FROM links
    UNION
    SELECT reach.u, links.w FROM reach JOIN links ON reach.w = links.u
), least AS (
    SELECT u, min(w) AS w FROM reach GROUP BY u
), counted AS (
    SELECT u, count(*) AS n FROM links GROUP BY u
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(w, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(w, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counted ON e.vec_id = counted.u LEFT JOIN least ON e.vec_id = least.u""")
def nn_descent(spark, sf_dir):
    from stocktide.llm.neighbours import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_ngram_jaccard", """
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FOR i IN range(1, len(w) - 2)]) END AS g
    FROM d
), grams AS (
    SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM s
), links AS (
    SELECT a.doc_id AS u, b.doc_id AS v
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(u, v) AS (
    SELECT u, v FROM links
    UNION
    SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), least AS (
    SELECT u, min(v) AS v FROM reach GROUP BY u
)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(v, s.doc_id)) AS component_id
FROM s LEFT JOIN least ON s.doc_id = least.u""")
def ngram_jaccard(spark, sf_dir):
    from stocktide.llm.jaccard import similarity_groups

    return similarity_groups(table(spark, sf_dir, "documents"))


@query("op10_main_text")
def page_text(spark, sf_dir):
    from stocktide.llm import html

    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages))


@query("op5_suffix_dedup", """
WITH d AS (
    SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS x FROM documents
), bytes AS (
    SELECT doc_id, unnest(range(0, len(x))) AS i, unnest(x) AS h FROM d
), windows AS (
    SELECT doc_id, i AS s, string_agg(h, '') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS g
    FROM bytes QUALIFY length(g) = 100
), least AS (
    SELECT g, min(doc_id) AS first FROM windows GROUP BY g
), repeated AS (
    SELECT doc_id, s FROM windows JOIN least USING (g) WHERE doc_id > first
), marked AS (
    SELECT b.doc_id, i, h, max(s) OVER (PARTITION BY b.doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
    FROM bytes b LEFT JOIN repeated r ON b.doc_id = r.doc_id AND b.i = r.s
), begun AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM marked
), summed AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
           string_agg(h, '' ORDER BY i) FILTER (NOT gone) AS kept
    FROM begun GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(x) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN summed ON d.doc_id = summed.doc_id""")
def suffix_dedup(spark, sf_dir):
    from stocktide.llm.substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def token_alignment(spark, sf_dir):
    from stocktide.llm.alignment import align_documents

    docs = table(spark, sf_dir, "documents")
    return align_documents(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")).documents


@query("op12_chat_format")
def chat_format(spark, sf_dir):
    from stocktide.llm import chat

    own = spark.createDataFrame([(-7, k, role, "\\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))],
                                "conv_id bigint, turn bigint, role string, text string")
    given = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "role", "text")
    return chat.read_back(chat.format_conversations(given.union(own)))


@query("op13_collocations", """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)
), lengths AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), f AS (
    SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
), held AS (
    SELECT lang, unnest(flatten([[array_to_string(w[i : i + m - 1], ' ') FOR i IN range(1, k - m + 2)] FOR m IN range(2, k)])) AS phrase, f
    FROM f WHERE k > 2
), longer AS (
    SELECT lang, phrase, max(f) AS f FROM held GROUP BY lang, phrase
), chosen AS (
    SELECT f.* FROM f LEFT JOIN longer USING (lang, phrase) WHERE k > 1 AND (longer.f IS NULL OR 100::HUGEINT * longer.f < 80::HUGEINT * f.f)
), cuts AS (
    SELECT lang, phrase, f AS a, w, unnest(range(1, k)) AS cut FROM chosen
), scored AS (
    SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r,
           CAST((2000000::HUGEINT * a) // (x.f + y.f) AS BIGINT) AS score,
           row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (2000000::HUGEINT * a) // (x.f + y.f), cut) AS place
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : cut], ' ')
                JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1 :], ' ')
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN lengths USING (lang) WHERE rank <= 2000""")
def phrase_collocations(spark, sf_dir):
    from stocktide.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))
