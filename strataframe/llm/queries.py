"""The operators applied to the whole tables: one query each, in the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.bpe import encode_documents
from strataframe.llm.common import table
from strataframe.llm.hard_negatives import hard_negatives
from strataframe.llm.html_text import extract_pages
from strataframe.llm.jaccard import jaccard_components
from strataframe.llm.language_id import identify
from strataframe.llm.licenses import license_scan
from strataframe.llm.mixing import mixed_sizes
from strataframe.llm.neighbours import nearest
from strataframe.llm.prefix_trie import prefix_trie
from strataframe.llm.quality import quality_rules
from strataframe.llm.secret_scan import scan
from strataframe.llm.substrings import substring_dedup
from strataframe.llm.va_file import top_products

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return keep


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, symbols, repeats, base verdict and the verdict of the robust outlier test."""
    return quality_rules(table(spark, sf_dir, "documents"), "doc_id")


_LINKED = """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS v, a AS c FROM both_ways UNION SELECT e.b, r.c FROM reach r JOIN both_ways e ON e.a = r.v)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN (SELECT v, min(c) AS c FROM reach GROUP BY 1) r ON r.v = d.doc_id"""


@query("op5_ngram_jaccard_join", _LINKED)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under four-word shingles and a Jaccard similarity of 0.85."""
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids of every document and of the bytes decoded from them."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(table(spark, sf_dir, "documents"), "doc_id", vocabulary=vocabulary, pattern=public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_REPEATS = """WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, r, unnest(generate_series(1, len(w) - 49)) AS i, unnest(list_transform(generate_series(1, len(w) - 49), lambda i: sha256(array_to_string(list_slice(w, i, i + 49), ' ')))) AS k FROM w WHERE len(w) >= 50),
lowest AS (SELECT k, min(doc_id) AS lo FROM windows GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 49)) AS j FROM windows JOIN lowest USING (k) WHERE lo < doc_id),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM w),
kept AS (SELECT words.r, count(gone.j) AS lost, string_agg(word, ' ' ORDER BY words.j) FILTER (gone.j IS NULL) AS t FROM words LEFT JOIN gone ON words.r = gone.r AND words.j = gone.j GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (r)"""


@query("op10_substring_dedup", _REPEATS)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, words lost to repeats of 50 words or more, and the digest of those left."""
    return substring_dedup(table(spark, sf_dir, "documents")).drop("left_text")


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, with the size and target of its source."""
    return mixed_sizes(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's score and verdict; offsets count code points."""
    return scan(table(spark, sf_dir, "documents"), "doc_id")


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places and labels of every document, and the labels of templates found by rare words."""
    return license_scan(table(spark, sf_dir, "documents"), "doc_id")


@query("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"), "page_id", "url")


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from four of five documents."""
    return identify(table(spark, sf_dir, "documents"))


@query("op6_nearest_neighbours")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors by cosine of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))


_TRIE = """WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY i) AS xs FROM t GROUP BY 1),
h AS (SELECT conv_id, xs, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 9 AS h FROM o),
s AS (SELECT a.conv_id, list_concat(coalesce(list_slice(b.xs, 1, h), []), coalesce(list_slice(a.xs, h + 1, len(a.xs)), [])) AS s FROM h a LEFT JOIN o b ON b.conv_id = a.conv_id - a.conv_id % 5),
p AS (SELECT conv_id, s, unnest(generate_series(0, len(s))) AS depth FROM s),
m AS (SELECT conv_id, depth, list_slice(s, 1, depth) AS k, depth = len(s) AS ends FROM p),
n AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS e, CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(k[depth].t)) END AS b FROM m GROUP BY k, depth),
c AS (SELECT list_slice(k, 1, depth - 1) AS k, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (k, depth)),
u AS (SELECT k, n_children, (n_convs - 1) * b AS saved, unnest(generate_series(0, depth)) AS up FROM v),
w AS (SELECT list_slice(k, 1, up) AS k, up AS depth, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM u GROUP BY ALL)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(coalesce(v.e, '')) AS ends_sha256
FROM v JOIN w USING (k, depth) LEFT JOIN v q ON q.depth = v.depth - 1 AND q.k = list_slice(v.k, 1, v.depth - 1)"""


@query("op11_prefix_trie", _TRIE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


_INTEGERS = """SELECT DISTINCT vec_id, {columns}list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

_TOP_PRODUCTS = f"""WITH e AS ({_INTEGERS.format(columns="", scale=64)}),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(max(list_inner_product(q.v, c.v)) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs QUALIFY rank <= 20"""


@query("op12_exact_top_k", _TOP_PRODUCTS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty highest integer inner products of every vector whose id is divisible by 20."""
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


_NEGATIVES = f"""WITH e AS ({_INTEGERS.format(columns="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, ", scale=256)} AND label IS NOT NULL),
pairs AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM pairs WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
windows AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score FROM positives p JOIN pairs n USING (anchor_id) WHERE n.label <> n.own AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows QUALIFY rank <= 5"""


@query("op13_hard_negatives", _NEGATIVES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hardest negatives under each of five positives of every vector whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
