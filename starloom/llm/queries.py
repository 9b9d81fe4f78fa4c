"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import (
    bpe,
    jaccard,
    language,
    lines,
    maxent,
    packing,
    phrases,
    quality,
    simhash,
    substrings,
    trie,
    vectors,
)
from starloom.llm.common import table

SEQUENCE_TOKENS = 2048


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, their digest and that of the text decoded from them."""
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the passages that repeat earlier ones."""
    found = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_bytes_removed")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of 3-word shingles and the component of links at a Jaccard similarity of 0.9."""
    return jaccard.components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every vector whose id is divisible by 50."""
    return vectors.exact_top(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op5_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's log probability under counts and under the model, learned from nine tenths."""
    return maxent.scored(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's quality score, learned from two thirds of the labels."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's language, learned from three quarters of the documents."""
    return language.identify(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every vector whose id is divisible by 100."""
    return vectors.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the repeated chunks of lines."""
    found = lines.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines_removed")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary(), SEQUENCE_TOKENS)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's SimHash and the component of links at a distance of at most 2 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words in every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, first=2_000)


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_maxent_scores": op5_maxent_scores,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_line_dedup": op9_line_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_simhash": op12_simhash,
    "op13_phrases": op13_phrases,
}

ORACLES = {
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM cut
), rows_ AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM rows_ a JOIN rows_ b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS v, doc_id AS r FROM documents
  UNION
  SELECT reach.v, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.r) AS component_id
FROM sets s JOIN reach r ON r.v = s.doc_id GROUP BY s.doc_id, s.s""",
    "op4_exact_top_k": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
    "op9_line_dedup": r"""
WITH split_ AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents
), hashed AS (
  SELECT doc_id, text, l, list_transform(l, lambda x: md5(x)) AS h FROM split_
), ended AS (
  SELECT doc_id, text, l, list_filter(range(1, len(l) + 1), lambda i: i = len(l)
    OR h[i][1] IN ('0', '1', '2', '3', '4', '5', '6', '7', '8', '9', 'a', 'b')
    OR md5(CASE WHEN i > 1 THEN h[i - 1] ELSE '' END || h[i])[1] IN ('0', '1', '2', '3')) AS e FROM hashed
), chunk AS (
  SELECT doc_id, unnest(range(1, len(e) + 1)) AS k, l, e FROM ended
), body AS (
  SELECT doc_id, k, e[k] - coalesce(e[k - 1], 0) AS n,
    array_to_string(l[coalesce(e[k - 1], 0) + 1 : e[k]], chr(10)) AS body
  FROM chunk
), paired AS (
  SELECT *, trim(body, E' \t\r\n') <> '' AS counts, lead(body) OVER (PARTITION BY doc_id ORDER BY k) AS next
  FROM body
), repeats AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) > 1 AS later,
    counts AND trim(next, E' \t\r\n') <> ''
      AND row_number() OVER (PARTITION BY body, next ORDER BY doc_id, k) > 1 AS pair
  FROM paired
), ranked AS (
  SELECT *, counts AND (n > 1 AND later OR coalesce(pair, false)
    OR coalesce(lag(pair) OVER (PARTITION BY doc_id ORDER BY k), false)) AS gone
  FROM repeats
)
SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (NOT gone), '') AS text,
  CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS n_lines_removed
FROM ranked GROUP BY doc_id""",
    "op11_prefix_trie": r"""
WITH checks AS (
  SELECT DISTINCT conv_id, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
      lambda i: list_prepend(CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT),
        list_transform(range(8), lambda j: CAST(-1 AS BIGINT)))))),
    lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b)
      ELSE xor(crc >> 1, CAST(3988292384 AS BIGINT) * (crc & 1)) END) AS crc
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(
      CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), opened AS (
  SELECT conv_id, xor(crc, 4294967295) % 4 AS h FROM checks
), whole AS (
  SELECT c.conv_id, o.place, o.role, o.text FROM opened c JOIN own o
    ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.place <= c.h
  UNION ALL
  SELECT c.conv_id, o.place, o.role, o.text FROM opened c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS d,
    CAST(length(role) AS VARCHAR) || ':' || role || text AS turn,
    CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS words
  FROM whole
), paths AS (
  SELECT conv_id, 0 AS d, [] AS path, CAST(0 AS BIGINT) AS words FROM opened
  UNION ALL
  SELECT conv_id, d, list(md5(turn)) OVER (PARTITION BY conv_id ORDER BY d) AS path, words FROM turns
), ended AS (
  SELECT *, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM paths
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends
  FROM ended GROUP BY path, d
), children AS (
  SELECT path[:len(path) - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), sized AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)
), below AS (
  SELECT n.path[:k] AS path, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves,
    sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM sized) n GROUP BY 1
)
SELECT s.conv_id, CAST(s.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(s.n_convs AS BIGINT) AS n_convs,
  CAST(s.n_children AS BIGINT) AS n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, sha256(s.ends) AS ends_sha256
FROM sized s JOIN below b USING (path) LEFT JOIN nodes p ON s.d > 0 AND p.path = s.path[:len(s.path) - 1]""",
    "op13_phrases": r"""
WITH pieces AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, string_split_regex(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
  FROM documents
), cut AS (
  SELECT lang, list_filter(string_split_regex(unnest(p), '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM cut, range(1, 4) t(k)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r,
    CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE k = 3) GROUP BY ALL
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.most IS NULL OR 100 * i.most < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
