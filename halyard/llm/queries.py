"""Driver queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm import chat_format, conversation_repair, decontaminate, license_scan, line_templates, media, pivot_search, quality, simhash, suffix_dedup, token_counts, trie_bpe, whitening
from halyard.llm.common import table


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_templates(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_dropped").alias("n_dropped"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS ln, unnest(string_split(text, chr(10))) AS raw FROM documents
), words AS (
  SELECT doc_id, text, ln, string_split_regex(regexp_replace(trim(raw), '[^ \t\r\f]*[0-9][^ \t\r\f]*', '<*>', 'g'), '[ \t\r\f]+') AS w FROM lines
), placed AS (
  SELECT doc_id, text, ln, w, array_to_string([len(w)::VARCHAR, w[1], w[2], w[3]], chr(10)) AS leaf, array_to_string(w, ' ') AS line FROM words WHERE len(w) >= 3
), kinds AS (
  SELECT leaf, w, count(DISTINCT (doc_id, text)) AS docs FROM placed GROUP BY leaf, w
), leaves AS (
  SELECT leaf, sum(docs) AS of FROM kinds GROUP BY leaf HAVING sum(docs) >= 5
), words_in AS (
  SELECT leaf, of, w, docs, unnest(range(len(w))) AS place, unnest(w) AS word FROM kinds JOIN leaves USING (leaf)
), common AS (
  SELECT leaf, place, word, sum(docs) >= 0.1::DOUBLE * any_value(of) AS wide FROM words_in WHERE word <> '<*>' GROUP BY leaf, place, word HAVING sum(docs) >= 5
), held AS (
  SELECT leaf, w, string_agg(place || ' ' || word, chr(10) ORDER BY place) FILTER (wide) AS t1, count(*) FILTER (wide AND place >= 3) AS n1,
    string_agg(place || ' ' || word, chr(10) ORDER BY place) AS t2, count(*) FILTER (place >= 3) AS n2 FROM words_in JOIN common USING (leaf, place, word) GROUP BY leaf, w
), shaped AS (
  SELECT leaf, w, CASE WHEN n1 > 0 AND n1 >= 0.5 * (len(w) - 3) THEN t1 ELSE t2 END AS template FROM held WHERE (n1 > 0 AND n1 >= 0.5 * (len(w) - 3)) OR (n2 > 0 AND n2 >= 0.5 * (len(w) - 3))
), told AS (
  SELECT p.doc_id, p.text, p.ln, p.leaf, coalesce(template, 'line ' || p.line) AS template
  FROM placed p JOIN leaves USING (leaf) LEFT JOIN shaped s ON s.leaf = p.leaf AND s.w = p.w
), again AS (
  SELECT leaf, template, min(doc_id) AS first_id FROM told GROUP BY leaf, template HAVING count(DISTINCT (doc_id, text)) >= 5
), ranked AS (
  SELECT told.*, row_number() OVER (PARTITION BY leaf, template ORDER BY doc_id, ln) AS nth FROM told JOIN again USING (leaf, template)
), gone AS (
  SELECT DISTINCT doc_id, ln FROM ranked WHERE nth > 1
)
SELECT l.doc_id, count(*) AS n_lines, count(g.ln) AS n_dropped,
  length(coalesce(string_agg(raw, chr(10) ORDER BY l.ln) FILTER (g.ln IS NULL), '')) AS kept_chars,
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY l.ln) FILTER (g.ln IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.ln = l.ln GROUP BY l.doc_id
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"), 200)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(hard))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    chats = chat_format.format_chats(rows.withColumn("parts", chat_format.text_part(F.col("text"))))
    back = chats.select("conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = back.withColumn("loss", chat_format.loss_text(F.col("formatted"), chat_format.loss_spans(F.col("formatted"))))
    return masked.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The template's length is that of its marks, the role, and the text with one more character for each \, < and >.
OP4_SQL = r"""
WITH rows_in AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g') AS etext,
            replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g') AS erole FROM rows_in
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, erole, etext)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, erole, etext) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(erole) + length(etext) + 15)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), items AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS width, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(2, len(w) - 3))]) AS s FROM b WHERE len(w) > 0
), sizes AS (
  SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id
), docs AS (
  SELECT DISTINCT doc_id, 5 AS width, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS s FROM d WHERE len(w) >= 5
), shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM docs JOIN items USING (width, s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM shared JOIN sizes USING (item_id) WHERE 5 * n_shared >= 4 * n_shingles
"""


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "shard", "offset", "length", "width", "height"
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = license_scan.notice_table(license_scan.template_table(spark))
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"), notices=notices)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = trie_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return pivot_search.search(pivot_search.build(rows), rows.where("vec_id % 20 = 0"), 20)


OP11_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = conversation_repair.repair(conversation_repair.damage(rows))
    digests = conversation_repair.digests(fixed.slices)
    every, counts = rows.select("conv_id").distinct().alias("i"), ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    joined = every.join(fixed.conversations.alias("c"), F.expr("i.conv_id <=> c.conv_id"), "left").join(digests.alias("d"), F.expr("i.conv_id <=> d.conv_id"), "left")
    return joined.select(
        "i.conv_id",
        *[F.coalesce(f"c.{c}", F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("d.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _op12_sql() -> str:
    """The cheapest edits by a walk over the turns that carries, for each state, cost, audit and text of the best way there.

    A way is a list (cost and audit, text); lists compare as repairs do. Costs have eight digits.
    """

    def step(way: str, cost: int, letter: str, line: str = "") -> str:
        added = f", {way}[2] || {line}" if line else f", {way}[2]"
        return f"CASE WHEN {way} IS NOT NULL THEN [lpad((substr({way}[1], 1, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || substr({way}[1], 9) || '{letter}'{added}] END"

    user, helper = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    stays = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"

    def kept(way: str, cost: int, letter: str, line: str, only: str) -> str:
        return f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND {only} THEN {step(way, f'{cost} + {stays}', letter, line)} END"

    own = "chr(10) || role || ':' || text"
    return rf"""
WITH RECURSIVE spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), summed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)), lambda h, b: list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS kind FROM spaced
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS time FROM summed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS n FROM hurt
), told AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'sound' END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before, count(*) OVER (PARTITION BY conv_id) AS of FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (n > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv_id
), walked AS (
  SELECT conv_id, 0::BIGINT AS n, ['00000000', ''] AS v0, NULL::VARCHAR[] AS v1, NULL::VARCHAR[] AS v2, NULL::VARCHAR[] AS v3, any_value(of) AS of FROM told GROUP BY conv_id
  UNION ALL
  SELECT conv_id, n, {step("w0", 2, "D")}, least({step("w1", 2, "D")}, {kept("w0", 0, "K", own, "left(role, 1) = 's'")}),
    least({step("w2", 2, "D")}, {kept("u", 0, "K", own, "left(role, 1) = 'u'")}, {kept("u", 1, "R", user + " || text", "true")}),
    least({step("w3", 2, "D")}, {kept("w2", 0, "K", own, "left(role, 1) = 'a'")}, {kept("w2", 1, "R", helper + " || text", "true")}), of
  FROM (
    SELECT *, least(w0, w1, w3) AS u FROM (
      SELECT *, least(v3, {step("w2", 5, "I", helper)}) AS w3 FROM (
        SELECT t.conv_id, t.n, t.role, t.text, t.fault, w.of, v0 AS w0, v1 AS w1, v3, least(v2, {step("v0", 5, "I", user)}, {step("v1", 5, "I", user)}, {step("v3", 5, "I", user)}) AS w2
        FROM walked w JOIN told t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.n + 1
      )
    )
  )
), last AS (
  SELECT conv_id, least(v0, v3, {step("v2", 5, "I", helper)}, {step("(" + step("v1", 5, "I", user) + ")", 5, "I", helper)}) AS way FROM walked WHERE n = of
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(substr(way[1], 1, 8)::BIGINT, 0) AS cost, coalesce(substr(way[1], 9), '') AS audit, sha256(coalesce(substr(way[2], 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN last l ON l.conv_id IS NOT DISTINCT FROM i.conv_id
"""


OP12_SQL = _op12_sql()


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "one")
    return white.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "one.whitened", "one.explained", "identity_error"
    )


QUERIES = {
    "op1_line_templates": op1_line_templates,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality": op3_quality,
    "op4_chat_format": op4_chat_format,
    "op5_simhash": op5_simhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_media": op7_media,
    "op8_license_scan": op8_license_scan,
    "op9_token_counts": op9_token_counts,
    "op10_trie_bpe": op10_trie_bpe,
    "op11_pivot_search": op11_pivot_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_templates": OP1_SQL,
    "op4_chat_format": OP4_SQL,
    "op6_decontaminate": OP6_SQL,
    "op11_pivot_search": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
}
