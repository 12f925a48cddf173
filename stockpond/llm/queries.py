"""One query for each operator of the package, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from stockpond.llm import bloom_search, bpe, decontaminate, fingerprints, gray_index, line_templates, quality, repeats, secret_scan, shards, spelling, surrogates, tool_calls
from stockpond.llm.registry import query
from stockpond.session import materialize
from stockpond.sources.tables import read_table


# Stands for the secret that a caller passes; results repeat only under the same key.
SURROGATE_KEY = b"stockpond demonstration key"


@query("op1_keyed_surrogates")
def keyed_surrogates(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(docs, SURROGATE_KEY, replaced="n_replaced")


@query("op2_prefix_intervals")
def prefix_intervals(spark, sf_dir):
    """After the digest columns, what is left as text (a character that was cut in two becomes U+FFFD) and the share that went."""
    cleaned = repeats.without_repeats(read_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        (F.col("n_removed") / F.greatest("n_bytes", F.lit(1))).alias("removed_share"),
    )


@query(
    "op3_line_templates",
    r"""WITH lines AS (
  SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
cut AS (
  SELECT doc_id, pos, list_filter(string_split_regex(regexp_replace(line, '[^ \t\x0B\f\r]*[0-9][^ \t\x0B\f\r]*', '<*>', 'g'), '[ \t\x0B\f\r]+'), lambda t: t <> '') AS tokens FROM lines),
long AS (SELECT doc_id, pos, tokens, len(tokens) AS n, [CAST(len(tokens) AS VARCHAR), tokens[1], tokens[2], tokens[3]] AS leaf FROM cut WHERE len(tokens) >= 5),
fields AS (SELECT doc_id, pos, leaf, n, generate_subscripts(tokens, 1) AS place, unnest(tokens) AS token FROM long),
common AS (SELECT leaf, place, token FROM fields WHERE place > 3 GROUP BY leaf, place, token HAVING COUNT(*) >= 20),
templates AS (
  SELECT doc_id, pos, f.leaf, n, COUNT(c.token) + 3 AS kept,
         string_agg(CASE WHEN c.token IS NULL THEN '' ELSE CAST(place AS VARCHAR) || ' ' || f.token END, '|' ORDER BY place) AS pattern
  FROM fields f LEFT JOIN common c USING (leaf, place, token) GROUP BY doc_id, pos, f.leaf, n),
good AS (SELECT doc_id, pos, leaf, pattern FROM templates WHERE kept * 10 >= n * 7),
recurring AS (SELECT leaf, pattern, MIN(doc_id) AS first_doc FROM good GROUP BY leaf, pattern HAVING COUNT(DISTINCT doc_id) >= 20),
gone AS (SELECT doc_id, pos FROM good JOIN recurring USING (leaf, pattern) WHERE doc_id <> first_doc),
kept AS (
  SELECT doc_id, COUNT(*) AS n_lines, COUNT(g.pos) AS n_dropped, string_agg(CASE WHEN g.pos IS NULL THEN line END, chr(10) ORDER BY pos) AS text
  FROM lines LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CAST(COALESCE(n_lines, 0) AS INTEGER) AS n_lines, CAST(COALESCE(n_dropped, 0) AS INTEGER) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN COALESCE(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)""",
)
def recurring_line_templates(spark, sf_dir):
    kept = line_templates.without_recurring(read_table(spark, sf_dir, "documents"), lines="n_lines", dropped="n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


@query("op4_permuted_fingerprints")
def permuted_fingerprints(spark, sf_dir):
    """Besides the likeness columns, ids divisible by 100 are searched for: how many other documents lie within the radius."""
    rows = materialize(fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents")), "edited")
    copies = materialize(rows.groupBy("fingerprint").agg(F.count("*").alias("copies")), "copies")
    asked = materialize(rows.where(F.col("doc_id") % 100 == 0).select("fingerprint").distinct(), "asked")
    found = fingerprints.within_radius(copies, asked).join(copies.withColumnRenamed("fingerprint", "found"), "found")
    counts = materialize(found.groupBy(F.col("asked").alias("fingerprint")).agg((F.sum("copies") - 1).alias("_others")), "within")
    return rows.join(counts, "fingerprint", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        *[F.lpad(F.lower(F.hex(c)), 16, "0").alias(c) for c in ("fingerprint", "edited_fingerprint")],
        "near_edited",
        "near_next",
        F.when(F.col("doc_id") % 100 == 0, F.col("_others")).alias("n_within_3"),
    )


@query("op5_quality_ranking")
def quality_ranking(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    features = quality.described(docs)
    ranking = quality.learn_described(features, read_table(spark, sf_dir, "labels"))
    scores = features.select("doc_id", ranking.score_of(F.col("features")).alias("score"))
    return scores.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


@query("op6_lpt_shards")
def lpt_shards(spark, sf_dir):
    placed = shards.with_shards(read_table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op7_gray_near_groups")
def gray_near_groups(spark, sf_dir):
    groups = gray_index.near_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query("op10_prefix_bpe")
def prefix_bpe(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))


def digests(encoded):
    return encoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_window_leaks")
def window_leaks(spark, sf_dir):
    found = decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_windows"), F.max("similarity").alias("similarity"))


TOOLS = [
    ("lookup", "query", "string", True),
    ("lookup", "limit", "integer", True),
    ("lookup", "exact", "boolean", False),
    ("search", "query", "string", True),
    ("search", "limit", "integer", True),
    ("search", "filter", "object", True),
]

OP8_SQL = r"""
WITH RECURSIVE asked AS (
  SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, CASE WHEN conv_id % 2 = 0 THEN 'lookup' ELSE 'search' END AS name,
         CAST(to_json(text) AS VARCHAR) AS query, (turn // 4) * 2 + turn % 2 AS parent
  FROM conversations WHERE role = 'user'),
leveled AS (
  SELECT conv_id, turn, 0 AS level FROM asked a
  WHERE parent = turn OR NOT EXISTS (SELECT 1 FROM asked p WHERE p.conv_id = a.conv_id AND p.turn = a.parent)
  UNION ALL
  SELECT a.conv_id, a.turn, l.level + 1 FROM leveled l JOIN asked a ON a.conv_id = l.conv_id AND a.parent = l.turn AND a.parent <> a.turn),
answers AS (SELECT conv_id, turn - 1 AS turn, COUNT(*) AS n_results, MIN(text) AS content FROM conversations WHERE role = 'assistant' GROUP BY ALL),
errors AS (
  SELECT conv_id, turn, list_sort(list_filter([
      CASE WHEN conv_id % 5 = 0 THEN 'argument limit is no integer' END,
      CASE WHEN conv_id % 7 = 0 THEN 'missing argument query' END,
      CASE WHEN conv_id % 11 = 0 THEN 'unknown argument mode' END,
      CASE WHEN name = 'lookup' AND turn > 3 THEN 'unknown argument filter' END,
      CASE WHEN name = 'search' AND turn <= 3 THEN 'missing argument filter' END], lambda e: e IS NOT NULL)) AS errors FROM asked)
SELECT conv_id, call_id, name, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY level, call_id) - 1 AS position, CAST(level AS INTEGER) AS level,
       len(errors) = 0 AS valid, array_to_string(errors, '; ') AS errors, CAST(1 AS BIGINT) AS n_calls, CAST(COALESCE(n_results, 0) AS BIGINT) AS n_results,
       '{"arguments":{' || CASE WHEN turn > 3 THEN '"filter":{"from":' || turn || ',"words":[1,2.5,"a/b"]},' ELSE '' END
         || '"limit":' || CASE WHEN conv_id % 5 = 0 THEN '"many"' ELSE CAST(turn * 5 AS VARCHAR) END
         || CASE WHEN conv_id % 11 = 0 THEN ',"mode":null' ELSE '' END
         || CASE WHEN conv_id % 7 <> 0 THEN ',"query":' || query ELSE '' END
         || '},"call_id":"' || call_id || '","conv_id":' || conv_id || ',"name":"' || name || '","result":' || COALESCE(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS record
FROM asked JOIN leveled USING (conv_id, turn) JOIN errors USING (conv_id, turn) LEFT JOIN answers USING (conv_id, turn)"""


def derived_calls(turns):
    """Each user turn asks a tool, with arguments in no fixed order or spacing; some break the schema. Later turns wait for earlier ones."""
    conv, turn = F.col("conv_id"), F.col("turn")
    quoted = F.to_json(F.array("text"))
    pieces = F.array_compact(
        F.array(
            F.when(conv % 7 != 0, F.concat(F.lit('"query" : '), F.substring(quoted, F.lit(2), F.length(quoted) - 2))),
            F.when(conv % 11 == 0, F.lit('"mode":null')),
            F.concat(F.lit('"limit": '), F.when(conv % 5 == 0, F.lit('"many"')).otherwise((turn * 5).cast("string"))),
            F.when(turn > 3, F.concat(F.lit('"filter" :{"words":[1, 2.50,"a\\/b"] , "from": '), turn.cast("string"), F.lit("}"))),
        )
    )
    call_id = lambda t: F.concat(F.lit("c"), conv.cast("string"), F.lit("-"), t.cast("string"))
    parent = F.floor(turn / 4) * 2 + turn % 2
    return turns.where("role = 'user'").select(
        "conv_id",
        call_id(turn).alias("call_id"),
        F.when(conv % 2 == 0, "lookup").otherwise("search").alias("name"),
        F.concat(F.lit("{ "), F.array_join(pieces, " ,"), F.lit(" }")).alias("arguments"),
        F.when(parent != turn, F.array(call_id(parent))).otherwise(F.array().cast("array<string>")).alias("after"),
    )


@query("op8_tool_call_links", OP8_SQL)
def tool_call_links(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    answers = turns.where("role = 'assistant'").select(
        "conv_id", F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("text").alias("content")
    )
    tools = spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")
    rows = tool_calls.linked(derived_calls(turns), answers, tools)
    return rows.withColumn("errors", F.array_join("errors", "; "))


@query("op11_spelling_variants")
def spelling_variants(spark, sf_dir):
    words = spelling.run_counts(read_table(spark, sf_dir, "documents"), spoil=199)
    return spelling.variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    "op12_bloom_search",
    f"""WITH tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM (SELECT doc_id, unnest({TERMS_SQL}) AS term FROM documents) GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(SUM(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT COUNT(*) AS n_docs, CAST(SUM(n) AS BIGINT) AS total FROM lengths),
asked AS (SELECT item_id, term, COUNT(*) AS times FROM (SELECT item_id, unnest({TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS weight
  FROM tf, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id, CAST(SUM(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), corpus GROUP BY item_id, doc_id)
SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20""",
)
def bloom_ranked(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bloom_search.search(read_table(spark, sf_dir, "benchmark"), docs)


def listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op13_secret_scan")
def secrets(spark, sf_dir):
    found = secret_scan.with_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
