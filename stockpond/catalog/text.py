"""Extraction and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpond.catalog.registry import plain, query
from stockpond.operators import retrieve
from stockpond.session import materialize
from stockpond.sources.tables import read_table

K = 3


@query(
    "invoice_extract",
    """SELECT o_orderkey AS doc_id, CASE WHEN o_orderstatus <> 'P' THEN 'INV-' || CAST(o_orderkey AS VARCHAR) END AS invoice_id,
              strftime(o_orderdate, '%Y-%m-%d') AS due_date,
              CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount_due
       FROM orders""",
)
def invoice_extract(spark, sf_dir):
    """Invoice texts written from the orders; some lack a number, some a readable amount."""
    o = read_table(spark, sf_dir, "orders")
    number = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("INVOICE \t INV-"), F.col("o_orderkey").cast("string"))).otherwise("DRAFT")
    amount = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).otherwise("1.2.3")
    text = F.concat(
        number,
        F.lit("\nBill To: Customer "),
        F.col("o_custkey").cast("string"),
        F.lit("\nDue Date: "),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("\nAmount Due: "),
        amount,
        F.lit(" USD"),
    )
    docs = o.select(F.col("o_orderkey").alias("doc_id"), text.alias("doc_text"))
    return plain(retrieve.extract_fields(docs, "doc_text", retrieve.INVOICE_PATTERNS, numeric=("amount_due",)))


def questions(spark, sf_dir):
    return read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))


def documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")


SCORES_SQL = """
words AS (
  SELECT item_id AS question_id, unnest(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: length(w) > 3)[1:6]) AS token
  FROM benchmark
  UNION ALL SELECT item_id, 'policy' FROM benchmark WHERE len(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: length(w) > 3)) = 0),
asked AS (SELECT question_id, token, COUNT(*) AS times FROM words GROUP BY 1, 2),
corpus AS (SELECT doc_id, lower(text) AS text FROM documents{where}),
matches AS (SELECT doc_id, token FROM corpus, (SELECT DISTINCT token FROM asked) WHERE contains(text, token)),
weights AS (SELECT token, CAST(ROUND(LN(((SELECT COUNT(*) FROM corpus) + 1) / (COUNT(*) + 0.5)) * 1000000) AS BIGINT) AS weight FROM matches GROUP BY token),
scores AS (SELECT question_id, doc_id, CAST(SUM(times * weight) AS BIGINT) AS score
           FROM asked JOIN matches USING (token) JOIN weights USING (token) GROUP BY 1, 2)"""

HITS_SQL = f"""{SCORES_SQL.format(where="")},
hits AS (SELECT question_id, doc_id, score, CAST(ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
         FROM scores QUALIFY rank <= {K})"""


@query("keyword_retrieve", f"WITH {HITS_SQL} SELECT * FROM hits")
def keyword_retrieve(spark, sf_dir):
    return retrieve.keyword_retrieve(questions(spark, sf_dir), documents(spark, sf_dir), K)


def hybrid_sql(where: str) -> str:
    # All word matches, and the K most similar of all vectors.
    return f"""WITH {SCORES_SQL.format(where=where)},
    vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    likeness AS (
      SELECT q.vec_id AS question_id, d.vec_id AS doc_id, CAST(ROUND(COALESCE(list_cosine_similarity(d.v, q.v), 0) * 1000000) AS BIGINT) AS similarity
      FROM vectors q JOIN benchmark ON item_id = q.vec_id, vectors d JOIN corpus ON corpus.doc_id = d.vec_id),
    by_vector AS (
      SELECT question_id, doc_id FROM likeness
      QUALIFY ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY similarity DESC, doc_id) <= {K}),
    candidates AS (SELECT question_id, doc_id FROM scores UNION SELECT question_id, doc_id FROM by_vector),
    hybrid AS (
      SELECT c.question_id, c.doc_id, COALESCE(s.score, 0) + COALESCE(similarity, 0) AS score
      FROM candidates c LEFT JOIN scores s ON s.question_id = c.question_id AND s.doc_id = c.doc_id
           LEFT JOIN likeness m ON m.question_id = c.question_id AND m.doc_id = c.doc_id)
    SELECT question_id, doc_id, score, CAST(ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM hybrid QUALIFY rank <= {K}"""


def vectors(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))


def hybrid_hits(spark, sf_dir, source=None, k=K, matches=None):
    known = vectors(spark, sf_dir)
    asked = questions(spark, sf_dir).join(known.withColumnRenamed("doc_id", "question_id"), "question_id", "left")
    return retrieve.hybrid_retrieve(asked, documents(spark, sf_dir), known, k, source, matches=matches)


@query("hybrid_retrieve", hybrid_sql(""))
def hybrid_retrieve(spark, sf_dir):
    return hybrid_hits(spark, sf_dir)


@query("hybrid_retrieve_source", hybrid_sql(" WHERE source = 'src1'"))
def hybrid_retrieve_source(spark, sf_dir):
    """Only documents of one source are searched."""
    return hybrid_hits(spark, sf_dir, "src1")


def hits_with_text(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return retrieve.with_text(retrieve.keyword_retrieve(questions(spark, sf_dir), docs, K), docs)


@query(
    "grounded_prompt",
    f"""WITH {HITS_SQL}, context AS (
      SELECT question_id, string_agg('[' || CAST(doc_id AS VARCHAR) || '] (' || source || ') ' || text, chr(10) || chr(10) ORDER BY rank) AS context
      FROM hits JOIN documents USING (doc_id) GROUP BY question_id)
    SELECT b.item_id AS question_id, '{retrieve.SYSTEM_TEXT}' || chr(10) || chr(10) || 'Context:' || chr(10) || COALESCE(context, '')
           || chr(10) || chr(10) || 'Question: ' || b.text || chr(10) || 'Answer:' AS prompt
    FROM benchmark b LEFT JOIN context c ON c.question_id = b.item_id""",
)
def grounded_prompt(spark, sf_dir):
    return retrieve.prompts(questions(spark, sf_dir), hits_with_text(spark, sf_dir))


@query(
    "extractive_answer",
    f"""WITH {HITS_SQL}
    SELECT b.item_id AS question_id, COALESCE(d.text || ' [' || CAST(d.doc_id AS VARCHAR) || ']', '{retrieve.NO_ANSWER}') AS answer
    FROM benchmark b LEFT JOIN (SELECT * FROM hits WHERE rank = 1) h ON h.question_id = b.item_id LEFT JOIN documents d USING (doc_id)""",
)
def extractive_answer(spark, sf_dir):
    return retrieve.extractive_answers(questions(spark, sf_dir), hits_with_text(spark, sf_dir))


@query(
    "recall_at_k",
    f"""WITH {HITS_SQL}, best AS (SELECT * FROM ({hybrid_sql("")}) WHERE rank = 1)
    SELECT best.question_id, best.doc_id, hits.doc_id IS NOT NULL AS retrieved
    FROM best LEFT JOIN hits ON hits.question_id = best.question_id AND hits.doc_id = best.doc_id""",
)
def recall_at_k(spark, sf_dir):
    """Whether the best hybrid hit is among the keyword hits; one scan of the texts serves both."""
    matches = retrieve.searched_words(questions(spark, sf_dir), documents(spark, sf_dir))
    expected = materialize(hybrid_hits(spark, sf_dir, k=1, matches=matches).select("question_id", "doc_id"), "expected")
    hits = retrieve.keyword_retrieve(questions(spark, sf_dir), documents(spark, sf_dir), K, matches)
    return retrieve.recall_at_k(hits, expected, K)
