"""Batch text extraction, keyword and hybrid retrieval, prompts and quoted answers."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stockpond.functions.scalars import cosine, first_group, search_tokens, try_to_number
from stockpond.operators.vectors import build, nearest
from stockpond.session import materialize

# The instruction put before the retrieved context, and the empty answer.
SYSTEM_TEXT = (
    "You answer only from the retrieved context. "
    "If the context does not contain the answer, say you do not know. "
    "Cite the document id in brackets, for example [faq-returns]."
)
NO_ANSWER = "I do not know. No retrieved context."

# Field patterns of the invoice texts.
INVOICE_PATTERNS = {
    "invoice_id": r"INVOICE\s+(INV-[0-9]+)",
    "due_date": r"Due Date:\s*([0-9]{4}-[0-9]{2}-[0-9]{2})",
    "amount_due": r"Amount Due:\s*([0-9.]+)",
}

# Searched words that one automaton holds.
TOKENS_AT_ONCE = 50_000
SCORE_UNIT = 1_000_000


def extract_fields(docs: DataFrame, text: str, patterns: dict[str, str], numeric: tuple[str, ...] = ()) -> DataFrame:
    """The first capture of each pattern, as a number where asked; NULL without a match."""
    fields = []
    for name, pattern in patterns.items():
        found = first_group(F.col(text), pattern)
        fields.append((try_to_number(found) if name in numeric else found).alias(name))
    return docs.select(*[c for c in docs.columns if c != text], *fields)


def question_tokens(questions: DataFrame) -> DataFrame:
    """(question_id, token, times): the words searched for, repeated words counted."""
    tokens = questions.select("question_id", F.explode(search_tokens(F.col("question"))).alias("token"))
    return tokens.groupBy("question_id", "token").agg(F.count("*").alias("times"))


def matched_tokens(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """(doc_id, token): which of the searched words occur anywhere in each document.

    One automaton over all searched words finds them in one scan of each lower-cased text, so no
    word of the corpus is shuffled. The words come to the tasks in blocks of ``TOKENS_AT_ONCE``,
    each of which scans the documents once.
    """
    lowered = docs.select("doc_id", F.lower("text").alias("text"))
    schema = StructType([lowered.schema["doc_id"], StructField("token", StringType())])

    def scan(words: list[str]) -> DataFrame:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = ahocorasick.Automaton()
            for word in words:
                automaton.add_word(word, word)
            automaton.make_automaton()
            for batch in batches:
                rows, found = [], []
                for i, text in enumerate(batch.column("text")):
                    words_here = {word for _, word in automaton.iter(text.as_py() or "")}
                    rows += [i] * len(words_here)
                    found += words_here
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], names=schema.names)

        return lowered.mapInArrow(find, schema)

    searched = tokens.where("token <> ''").select("token").distinct()
    matches = lowered.select("doc_id", F.lit("").alias("token")).limit(0)
    for block in batched(searched.toLocalIterator(), TOKENS_AT_ONCE):
        matches = matches.unionByName(scan([r.token for r in block]))
    return matches.distinct()


def searched_words(questions: DataFrame, docs: DataFrame) -> DataFrame:
    """A written table (doc_id, token) of the documents that hold words of the questions; retrievals over the same documents can share it."""
    return materialize(matched_tokens(docs, question_tokens(questions)), "matched-tokens")


def question_weights(questions: DataFrame, docs: DataFrame, matches: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The words of each question that occur, with the number of documents they occur in, and these documents.

    ``matches`` are the ``searched_words`` of the same questions and documents, if they are known.

    A word weighs ln((1 + N) / (df + 0.5)) for each time it is asked, in whole millionths so that
    the order of summation cannot change a score; ``rest`` is the weight of all commoner words.
    """
    asked = materialize(question_tokens(questions), "question-tokens")
    if matches is None:
        matches = materialize(matched_tokens(docs, asked), "matched-tokens")
    corpus = docs.agg(F.count("*").alias("n")).scalar()
    frequency = matches.groupBy("token").agg(F.count("*").alias("df"))
    weight = F.col("times") * F.round(F.log((corpus + 1) / (F.col("df") + 0.5)) * SCORE_UNIT).cast("bigint")
    # A handful of words per question.
    rarest_first = Window.partitionBy("question_id").orderBy("df", "token")
    later = rarest_first.rowsBetween(1, Window.unboundedFollowing)
    weighted = asked.join(frequency, "token").select("question_id", "token", "df", weight.alias("weight"))
    return materialize(weighted.withColumn("rest", F.coalesce(F.sum("weight").over(later), F.lit(0))), "question-weights"), matches


def lexical_candidates(weights: DataFrame, matches: DataFrame, k: int, margin: int = 0) -> DataFrame:
    """(question_id, doc_id, score): the ``k`` best documents of each question and all within ``margin`` of them.

    A word in ``k`` documents or more gives ``k`` documents its weight, so the heaviest such word is a
    bar that the k-th best reaches. The commonest words whose weights together stay below it bring in no
    document by themselves. One round expands the other words to documents; a second one looks the
    common words up for those documents that can still reach the k-th best of the first.
    """
    of_question = Window.partitionBy("question_id")
    bar = F.max(F.when(F.col("df") >= k, F.col("weight"))).over(of_question) - margin
    split = weights.withColumn("needed", F.coalesce(F.col("rest") + F.col("weight") >= bar, F.lit(True)))
    needed = split.where("needed").select("question_id", "token", "weight")
    common = split.where("NOT needed").select("question_id", "token", "weight")
    first = matches.join(needed, "token").groupBy("question_id", "doc_id").agg(F.sum("weight").alias("score"))
    floors = best_k(first, k).groupBy("question_id").agg(F.when(F.count("*") == k, F.min("score") - margin).alias("floor"))
    rest = common.groupBy("question_id").agg(F.sum("weight").alias("rest"))
    reach = floors.join(rest, "question_id", "left").select("question_id", (F.col("floor") - F.coalesce("rest", F.lit(0))).alias("least"))
    kept = first.join(reach, "question_id").where("coalesce(score >= least, true)").drop("least")
    looked_up = kept.join(common, "question_id").select("question_id", "doc_id", "token", "weight").join(matches, ["doc_id", "token"])
    both = kept.unionByName(looked_up.select("question_id", "doc_id", F.col("weight").alias("score")))
    return both.groupBy("question_id", "doc_id").agg(F.sum("score").alias("score"))


def best_k(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents per question; every task keeps only its own ``k`` before the shuffle."""
    best_first = Window.partitionBy("question_id").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def keyword_retrieve(questions: DataFrame, docs: DataFrame, k: int = 3, matches: DataFrame | None = None) -> DataFrame:
    return best_k(lexical_candidates(*question_weights(questions, docs, matches), k), k)


def hybrid_retrieve(
    questions: DataFrame, docs: DataFrame, vectors: DataFrame, k: int = 3, source: str | None = None, exact: bool = True, matches: DataFrame | None = None
) -> DataFrame:
    """Candidates by word and by vector, ranked by keyword score plus cosine similarity.

    ``questions`` carries a ``vector``; ``vectors`` is (doc_id, vector). A document or
    question without a vector counts with similarity 0, one without a shared word with score 0.
    Without ``exact`` only the nearest cells of the inverted file are looked into. ``matches`` are the ``searched_words``
    of these questions and of the documents of the source, if they are known.
    """
    corpus = docs if source is None else docs.where(F.col("source") == source)
    weights, matches = question_weights(questions.select("question_id", "question"), corpus, matches)
    # Similarity moves a score by one unit up or down, so whatever lies more than two units
    # below the k-th best keyword score cannot come back among the best k.
    lexical = materialize(lexical_candidates(weights, matches, k, 2 * SCORE_UNIT), "lexical-candidates")
    known = vectors if source is None else vectors.join(corpus.select("doc_id"), "doc_id", "left_semi")
    by_vector = materialize(nearest(questions, build(known), k, exact=exact).select("question_id", "doc_id"), "vector-candidates")
    added = by_vector.join(lexical.select("question_id", "doc_id"), ["question_id", "doc_id"], "left_anti")
    # A document that came by its vector may still share words, only too few to be a word candidate.
    words = added.join(weights.select("question_id", "token", "weight"), "question_id").join(matches, ["doc_id", "token"])
    scores = words.groupBy("question_id", "doc_id").agg(F.sum("weight").alias("score"))
    added = added.join(scores, ["question_id", "doc_id"], "left").select("question_id", "doc_id", F.coalesce("score", F.lit(0)).cast("bigint").alias("score"))
    candidates = materialize(lexical.unionByName(added), "candidates")
    asked = questions.select("question_id", F.col("vector").alias("_question_vector"))
    similar = (
        known.join(candidates.select("question_id", "doc_id"), "doc_id")
        .join(asked, "question_id")
        .select("question_id", "doc_id", cosine(F.col("vector"), F.col("_question_vector")).alias("_similarity"))
    )
    similarity = F.coalesce("_similarity", F.lit(0.0))
    scored = candidates.join(similar, ["question_id", "doc_id"], "left").select(
        "question_id", "doc_id", (F.col("score") + F.round(similarity * SCORE_UNIT).cast("bigint")).alias("score")
    )
    return best_k(scored, k)


def with_text(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Hits with the text and source of their document.

    The hits, k per question, are written first: their size is then known and the join
    does not have to shuffle the documents.
    """
    return docs.select("doc_id", "text", "source").join(materialize(hits, "hits"), "doc_id")


def prompts(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """The grounded prompt per question, chunks in rank order; ``hits`` carry text and source."""
    chunk = F.concat(F.lit("["), F.col("doc_id").cast("string"), F.lit("] ("), "source", F.lit(") "), "text")
    context = hits.groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", chunk.alias("chunk")))).alias("_chunks")
    )
    joined = questions.join(context, "question_id", "left")
    text = F.concat_ws("\n\n", F.transform(F.coalesce("_chunks", F.array().cast("array<struct<rank:int,chunk:string>>")), lambda c: c["chunk"]))
    return joined.select(
        "question_id",
        F.concat(
            F.lit(f"{SYSTEM_TEXT}\n\nContext:\n"), text, F.lit("\n\nQuestion: "), "question", F.lit("\nAnswer:")
        ).alias("prompt"),
    )


def extractive_answers(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """The best document quoted with its id, or the fixed answer when nothing was found."""
    top = hits.where("rank = 1").select(
        "question_id", F.concat("text", F.lit(" ["), F.col("doc_id").cast("string"), F.lit("]")).alias("_quote")
    )
    return questions.join(top, "question_id", "left").select(
        "question_id", F.coalesce("_quote", F.lit(NO_ANSWER)).alias("answer")
    )


def recall_at_k(hits: DataFrame, expected: DataFrame, k: int) -> DataFrame:
    """Per question, whether the expected document is among the first ``k`` hits."""
    found = hits.where(F.col("rank") <= k).select("question_id", "doc_id", F.lit(True).alias("_found"))
    return expected.join(found, ["question_id", "doc_id"], "left").select(
        "question_id", "doc_id", F.coalesce("_found", F.lit(False)).alias("retrieved")
    )
