"""One registered query per operator, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm import (
    chat_format,
    collocations,
    hamming_search,
    hmm,
    license_scan,
    minhash,
    mixing,
    ngram_join,
    piece_sampling,
    quality_rules,
    ranked_search,
    resampling,
    string_kernel,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the target weights of their sources."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLES["op8_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS BIGINT) AS w
  FROM docs GROUP BY source),
ranked AS (
  SELECT *, 3 * s AS most, row_number() OVER (ORDER BY CAST(3 * s AS DOUBLE) / w, source IS NULL, source) AS k FROM sizes),
filled AS (
  SELECT a.source, a.s, a.w, a.k, a.most,
         (SELECT sum(s) FROM ranked) - coalesce(sum(b.most), 0) AS words_left,
         (SELECT sum(w) FROM ranked) - coalesce(sum(b.w), 0) AS weight_left
  FROM ranked a LEFT JOIN ranked b ON b.k < a.k GROUP BY ALL),
free AS (
  SELECT CAST(words_left AS BIGINT) AS words_left, CAST(weight_left AS BIGINT) AS weight_left
  FROM filled WHERE words_left * w <= most * weight_left ORDER BY k LIMIT 1),
targets AS (
  SELECT source, s, CASE WHEN f.words_left * f.weight_left IS NULL OR a.words_left * w > most * a.weight_left THEN CAST(most AS DOUBLE)
         ELSE CAST(f.words_left * w AS DOUBLE) / f.weight_left END AS target
  FROM filled a LEFT JOIN free f ON true),
placed AS (
  SELECT d.doc_id, d.size, t.s, t.target, CASE WHEN t.s > 0 THEN CAST(floor(t.target / t.s) AS BIGINT) ELSE 0 END AS passes,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS through,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS tied
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, passes + CASE WHEN 2 * through - tied < 2 * (target - passes * s) THEN 1 ELSE 0 END AS copies FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size, target,
       CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM counted
"""


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_chars", "removed_words"
    )


ORACLES["op10_quality_rules"] = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
  SELECT doc_id, unnest(range(0, len(w) - 7)) AS i, unnest(list_transform(range(0, len(w) - 7), lambda i: w[i + 1:i + 8])) AS win
  FROM words WHERE len(w) >= 8),
starts AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM starts) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, md5(text) AS body, line,
         md5(regexp_replace(lower(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))),
             '[\x20\x09-\x0D0-9]+', ' ', 'g')) AS h, length(line) AS n, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
same AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT source, greatest(4.0, 0.05 * count(DISTINCT body)) AS most FROM lines GROUP BY source),
hot AS (
  SELECT l.source, l.h FROM lines l JOIN hosts o ON l.source IS NOT DISTINCT FROM o.source
  GROUP BY l.source, l.h HAVING count(DISTINCT body) > any_value(most)),
gone AS (
  SELECT doc_id, sum(n) AS n, sum(words) AS words FROM lines l JOIN hot ON l.h = hot.h AND l.source IS NOT DISTINCT FROM hot.source GROUP BY doc_id),
joined AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) AS chars, coalesce(s.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(g.n, 0) AS removed_chars,
         coalesce(g.words, 0) AS removed_words
  FROM words d LEFT JOIN same s USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN gone g USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND NOT (removed_chars > 0 AND (chars - removed_chars < 0.5 * chars OR n_words - removed_words < 20)) AS kept,
       CAST(removed_chars AS BIGINT) AS removed_chars, CAST(removed_words AS BIGINT) AS removed_words
FROM joined
"""


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under the 5-gram Jaccard join."""
    found = ngram_join.similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


ORACLES["op7_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
         ELSE list_transform(range(0, len(w) - 4), lambda i: w[i + 1:i + 5]) END) AS s FROM words),
kinds AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY 1),
shingles AS (SELECT rep, len(s) AS n, unnest(s) AS shingle FROM kinds),
shared AS (SELECT rep, n, shingle FROM shingles QUALIFY count(*) OVER (PARTITION BY shingle) > 1),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM shared a JOIN shared b ON a.shingle = b.shingle AND a.rep <> b.rep
  AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached AS (
  SELECT rep AS node, rep AS seen FROM kinds
  UNION
  SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.seen),
least_seen AS (SELECT node, min(seen) AS component FROM reached GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id
FROM sets d LEFT JOIN kinds k ON list_sort(d.s) = k.s LEFT JOIN least_seen c ON c.node = k.rep
"""


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase places and fuzzy notices of every document."""
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted form."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat_format.conversation_digests(chat_format.read_back(chat_format.format_turns(turns.union(extra))))


ORACLES["op6_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, len(regexp_extract_all(role || chr(0) || text,
    '<\\*(\|turn\|>|\|body\|>|\|end\|>|s>|/s>|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|\|user\|>|\|assistant\|>|\|system\|>)|\[\\*(INST\]|/INST\])')) AS escapes
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(23 + length(role) + length(text) + escapes) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def good_label() -> Column:
    return F.col("quality") == 1


@query
def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight and verdict of every document."""
    return resampling.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), good_label())


@query
def op5_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = string_kernel.fit(docs)
    rows = docs.select("doc_id", string_kernel.held_out("doc_id").alias("held_out"), "text")
    return string_kernel.predict(rows, model)


@query
def op3_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log probability of every document."""
    return hmm.score_documents(table(spark, sf_dir, "documents"))


@query
def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every query vector."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hamming_search.search(rows, rows.filter(F.col("vec_id") % 20 == 0))


@query
def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document and the check of their round trip."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = piece_sampling.decode_documents(piece_sampling.encode_documents(docs))
    return rows.select(
        "doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"), "piece_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_ranked_search"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
stats AS (SELECT CAST(count(*) FILTER (len(t) > 0) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS length FROM docs),
counts AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT row, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM docs) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, stats GROUP BY term),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term), stats GROUP BY item_id, row, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under MinHash near-duplicate links."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op12_minhash_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
         ELSE list_transform(range(0, len(w) - 3), lambda i: w[i + 1:i + 4]) END) AS s FROM words),
kinds AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY 1),
shingles AS (SELECT rep, len(s) AS n, unnest(s) AS shingle FROM kinds),
shared AS (SELECT rep, n, shingle FROM shingles QUALIFY count(*) OVER (PARTITION BY shingle) > 1),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM shared a JOIN shared b ON a.shingle = b.shingle AND a.rep <> b.rep
  AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (
  SELECT rep AS node, rep AS seen FROM kinds
  UNION
  SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.seen),
least_seen AS (SELECT node, min(seen) AS component FROM reached GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
       d.doc_id IS NOT DISTINCT FROM coalesce(c.component, d.doc_id) AS kept
FROM sets d LEFT JOIN kinds k ON list_sort(d.s) = k.s LEFT JOIN least_seen c ON c.node = k.rep
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i])) AS g FROM pieces
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) FROM pieces
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) FROM pieces),
f AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE len(g) > 1 AND f >= 10),
longer AS (
  SELECT lang, part, max(f) AS most
  FROM (SELECT lang, f, unnest([g[1:2], g[2:3]]) AS part FROM candidates WHERE len(g) = 3) GROUP BY lang, part),
kept AS (
  SELECT c.lang, c.g, c.f FROM candidates c LEFT JOIN longer o ON o.lang = c.lang AND o.part = c.g
  WHERE o.most IS NULL OR 100 * o.most < 50 * c.f),
cuts AS (
  SELECT k.*, c AS k, x.f AS l, y.f AS r, (CAST(1000000 AS HUGEINT) * k.f * k.f) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS c FROM kept) k
  JOIN f x ON x.lang = k.lang AND x.g = k.g[1:c] JOIN f y ON y.lang = k.lang AND y.g = k.g[c + 1:len(k.g)]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, array_to_string(g, ' ')) AS rank FROM lowest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
