"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from daybook.llm import (
    dart_minhash, decontaminate, exact_dedup, language_id, line_windows, packing, phrase_graph, preference, prefix_trie, run_length_index,
    substring_dedup, toxicity, trie_join,
)
from daybook.llm.rows import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spans(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


def _sha(text: str):
    return F.sha2(F.col(text).cast("binary"), 256)


def op1_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = preference.preference_examples(turns, preference.neighbouring_pairs(turns))
    return out.select(
        "pair_id", "chosen_id", "rejected_id", "n_shared", "prompt", "chosen", "rejected",
        _spans(F.col("chosen_loss")).alias("chosen_loss"), _spans(F.col("rejected_loss")).alias("rejected_loss"))


def op2_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_units(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_removed", _spans(F.col("removed")).alias("removed"), _sha("kept_text").alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels, teaches=~held_out(F.col("doc_id")))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_windows.remove_repeated_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", _sha("kept_text").alias("kept_sha256"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.select("doc_id", "text", "lang"), teaches=~held_out(F.col("doc_id")))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_length_index.remove_long_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of the documents with the digest of their ids."""
    path = public_tokenizers.path
    pieces = packing.pack(docs.select("doc_id", "text"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_graph.collocations(table(spark, sf_dir, "documents").select("lang", "text")).withColumnRenamed("grp", "lang")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation begins with some turns of the first one of its five; how many comes from a checksum of its id."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    five, length = F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.prefix_nodes(prefix_trie.with_shared_heads(prefix_trie.turn_sequences(turns), five, length))


QUERIES = {
    "op1_preference": op1_preference,
    "op2_repeated_lines": op2_repeated_lines,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_line_windows": op5_line_windows,
    "op6_near_dedup": op6_near_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_language": op8_language,
    "op9_long_repeats": op9_long_repeats,
    "op10_packing": op10_packing,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = r"lower(trim(regexp_replace({}, '[\x20\x09-\x0D]+', ' ', 'g'), ' '))"

ORACLES = {
    "op1_preference": r"""
WITH said AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
    SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS n
    FROM said
), pairs AS (
    SELECT a.conv_id // 2 AS pair_id, a.conv_id AS chosen_id, b.conv_id AS rejected_id
    FROM (SELECT DISTINCT conv_id FROM numbered) a JOIN (SELECT DISTINCT conv_id FROM numbered) b
      ON a.conv_id % 2 = 0 AND b.conv_id = a.conv_id + 1
), facing AS (
    SELECT p.pair_id, c.n AS cn, r.n AS rn,
           c.n IS NOT NULL AND r.n IS NOT NULL AND c.role = r.role AND c.text = r.text AS same, coalesce(c.n, r.n) AS n
    FROM (SELECT pair_id, n, role, text FROM pairs JOIN numbered ON conv_id = chosen_id) c
    FULL JOIN (SELECT pair_id, n, role, text FROM pairs JOIN numbered ON conv_id = rejected_id) r
      ON c.pair_id = r.pair_id AND c.n = r.n
    JOIN pairs p ON p.pair_id = coalesce(c.pair_id, r.pair_id)
), shared AS (
    SELECT pair_id, CAST(coalesce(min(n) FILTER (NOT same) - 1, max(n)) AS INTEGER) AS n_shared FROM facing GROUP BY pair_id
), parts AS (
    SELECT pair_id, side, n, n <= n_shared AS is_prompt, role,
           '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS piece
    FROM (SELECT pair_id, 'c' AS side, chosen_id AS conv_id FROM pairs UNION ALL SELECT pair_id, 'r', rejected_id FROM pairs)
    JOIN numbered USING (conv_id) JOIN shared USING (pair_id)
), placed AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY pair_id, side, is_prompt ORDER BY n) AS stop FROM parts
), strings AS (
    SELECT pair_id,
           coalesce(string_agg(piece, '' ORDER BY n) FILTER (side = 'c' AND is_prompt), '') AS prompt,
           coalesce(string_agg(piece, '' ORDER BY n) FILTER (side = 'c' AND NOT is_prompt), '') AS chosen,
           coalesce(string_agg(piece, '' ORDER BY n) FILTER (side = 'r' AND NOT is_prompt), '') AS rejected,
           coalesce(string_agg((stop - length(piece) + length(role) + 5) || '-' || stop, ',' ORDER BY n)
               FILTER (side = 'c' AND NOT is_prompt AND role = 'assistant'), '') AS chosen_loss,
           coalesce(string_agg((stop - length(piece) + length(role) + 5) || '-' || stop, ',' ORDER BY n)
               FILTER (side = 'r' AND NOT is_prompt AND role = 'assistant'), '') AS rejected_loss
    FROM placed GROUP BY pair_id
)
SELECT pair_id, chosen_id, rejected_id, n_shared, prompt, chosen, rejected, chosen_loss, rejected_loss
FROM pairs JOIN shared USING (pair_id) JOIN strings USING (pair_id)""",
    "op2_repeated_lines": rf"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), units AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split
), placed AS (
    SELECT *, {_NORMAL.format('line')} AS normal, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(line) - 1 AS start
    FROM units
), judged AS (
    SELECT *, normal <> '' AND len(string_split(normal, ' ')) >= 5
        AND row_number() OVER (PARTITION BY normal ORDER BY doc_id NULLS LAST, pos) > 1 AS gone
    FROM placed
), runs AS (
    SELECT *, pos - row_number() OVER (PARTITION BY doc_id, gone ORDER BY pos) AS run FROM judged
), spans AS (
    SELECT doc_id, string_agg(span, ',' ORDER BY first) AS removed
    FROM (SELECT doc_id, min(start) AS first, min(start) || '-' || max(start + length(line)) AS span
          FROM runs WHERE gone GROUP BY doc_id, run) GROUP BY doc_id
)
SELECT j.doc_id, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed, coalesce(any_value(removed), '') AS removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged j LEFT JOIN spans s ON j.doc_id = s.doc_id GROUP BY j.doc_id""",
    "op4_exact_dedup": r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
       sha AS text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents)
WINDOW same AS (PARTITION BY sha)""",
    "op5_line_windows": rf"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), units AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split
), normal AS (
    SELECT doc_id, pos, line, {_NORMAL.format('line')} AS a FROM units
), windows AS (
    SELECT doc_id, pos, a, lead(a) OVER lines AS b, lead(a, 2) OVER lines AS c FROM normal
    WINDOW lines AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
    SELECT doc_id, pos FROM windows WHERE c IS NOT NULL AND (a <> '' OR b <> '' OR c <> '')
    QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS LAST, pos) > 1
), gone AS (
    SELECT DISTINCT doc_id, pos + i AS pos FROM later, range(3) AS r(i)
)
SELECT n.doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(g.pos) AS INTEGER) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n.pos) FILTER (g.pos IS NULL), '')) AS kept_sha256
FROM normal n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.pos = g.pos GROUP BY n.doc_id""",
    "op11_jaccard_join": rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(string_split_regex({_SMALL}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
        list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)""",
    "op12_collocations": rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_SMALL}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM split, (SELECT unnest(range(1, 5)) AS k)
), f AS (
    SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL
), candidates AS (
    SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 30
), inside AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS most
    FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates WHERE k > 2)) GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, a, cut, l.n AS l, r.n AS r, (2000000::HUGEINT * a) // (l.n + r.n) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r,
       CAST(t.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
JOIN (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang) t ON t.lang = b.lang
WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
QUALIFY rank <= 2000""",
    "op13_prefix_trie": r"""
WITH said AS (
    SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), sized AS (
    SELECT *, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))) % 9 AS h
    FROM said
), rebuilt AS (
    SELECT s.conv_id, coalesce(b.turns[1:s.h], []) || s.turns[s.h + 1:] AS path
    FROM sized s LEFT JOIN said b ON b.conv_id = s.conv_id - s.conv_id % 5
), members AS (
    SELECT conv_id, path[1:d] AS prefix, d, len(path) = d AS ends FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY prefix, d
), children AS (
    SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), worth AS (
    SELECT prefix, d, CASE WHEN d > 0 THEN (n - 1) * strlen(prefix[d].t) ELSE 0 END AS saved,
           NOT EXISTS (SELECT 1 FROM children c WHERE c.prefix = nodes.prefix AND c.d = nodes.d) AS leaf
    FROM nodes
), totals AS (
    SELECT prefix[1:j] AS prefix, j AS d, sum(saved) AS saved, sum(leaf::INT) AS leaves
    FROM (SELECT *, unnest(range(d + 1)) AS j FROM worth) GROUP BY ALL
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
       CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.prefix = n.prefix AND t.d = n.d LEFT JOIN children c ON c.prefix = n.prefix AND c.d = n.d
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.prefix = n.prefix[1:n.d - 1]""",
}
