"""Recurring lines by a template tree of fixed depth: token count, leading tokens, then the rest by vote.

A line walks from its token count over its first tokens to a leaf; tokens with a digit count as
a variable field. In a leaf, a token that enough lines have at a place is part of the template,
any other token there is a variable field. Lines that only differ in variable fields so have
one template. A template recurs if enough documents have it and most of its tokens are constant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockpond.llm.native import bit_filter, free_name, may_hold, row_digest
from stockpond.session import materialize

FIELD = "<*>"
LEADING = 3
FEWEST_TOKENS = 5
MIN_DOCS = 20
# Share of constant tokens that a recurring template needs, as a fraction of whole numbers.
CONSTANT = (7, 10)
SPACE = r"[ \t\x0B\f\r]+"


def tokens(line: Column) -> Column:
    """Words of a line, those with a digit as a variable field."""
    fielded = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"[^ \t\x0B\f\r]*[0-9][^ \t\x0B\f\r]*", FIELD)).otherwise(line)
    return F.filter(F.split(fielded, SPACE), lambda t: t != "")


def _lines(docs: DataFrame, id_col: str, text: str, fewest: int, short: bool) -> DataFrame:
    """``_digest``, ``_id``, ``at`` (place of the line from 0), ``tokens``, ``leaf`` of every line that is judged.

    With ``short`` a line of fewer than ``fewest`` tokens has all its tokens as they are for a path.
    """
    if short:
        cut = docs.select(
            row_digest(id_col, text).alias("_digest"), F.col(id_col).alias("_id"),
            F.posexplode_outer(F.transform(F.split(text, "\n"), lambda line: F.struct(line.alias("line"), tokens(line).alias("tokens")))).alias("at", "cut"),
        ).select("_digest", "_id", "at", "cut.line", "cut.tokens")
        few = F.size("tokens") < fewest
        as_is = F.filter(F.split("line", SPACE), lambda t: t != "")
        cut = cut.where((~few) | F.col("line").rlike(r"\p{L}")).select("_digest", "_id", "at", F.when(few, as_is).otherwise(F.col("tokens")).alias("tokens"))
        leading = F.xxhash64(F.size("tokens"), *[F.get("tokens", F.lit(i)) for i in range(LEADING)])
        few = F.size("tokens") < fewest
        return cut.select("_digest", "_id", "at", "tokens", F.size("tokens").alias("n"), F.when(few, F.xxhash64(F.size("tokens"), "tokens")).otherwise(leading).alias("leaf"))
    # Tokens are made before the explode: filters on what an explode gives stay above it, so no line is cut twice.
    cut = docs.select(
        row_digest(id_col, text).alias("_digest"), F.col(id_col).alias("_id"), F.posexplode_outer(F.transform(F.split(text, "\n"), tokens)).alias("at", "tokens")
    ).where("tokens IS NOT NULL")
    leaf = F.xxhash64(F.size("tokens"), *[F.get("tokens", F.lit(i)) for i in range(LEADING)])
    return cut.select("_digest", "_id", "at", "tokens", F.size("tokens").alias("n"), leaf.alias("leaf"))


def recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, constant: tuple[int, int] = CONSTANT, fewest: int = FEWEST_TOKENS,
    short: bool = False, fields_count: bool = True,
) -> DataFrame:
    """Every line with a recurring template: ``_digest`` (of the document's id and text), ``_id``, ``at``, ``template``, ``n_docs``, ``first_doc``.

    Documents are told apart by id; a null id counts as one document that comes last. Null texts
    have no lines. Lines of fewer than ``fewest`` tokens are too short for a template: they stay, or
    with ``short`` recur where all their tokens are equal and hold a letter. A line without spaces
    is one token, whatever its script and length. Without ``fields_count`` no variable field counts
    as a constant token, wherever it stands, so that rows of numbers do not pass for one template.
    Two passes: the first counts the lines of each leaf, the second looks at leaves with at least
    ``min_docs`` lines only, as no other can hold a template of that many documents.
    """
    long_enough = F.lit(True) if short else F.col("n") >= fewest
    crowds = materialize(_lines(docs, id_col, text, fewest, short).where(long_enough).groupBy("leaf").agg(F.count("*").alias("lines")).where(F.col("lines") >= min_docs).select("leaf"), "crowded-leaves")
    crowded = bit_filter(crowds, "leaf")
    places = materialize(
        _lines(docs, id_col, text, fewest, short).where(long_enough & may_hold(crowded, F.col("leaf")))
        .join(crowds, "leaf", "left_semi")
        .select("_digest", "_id", "at", "leaf", "n", F.xxhash64("leaf", "tokens").alias("line"), "tokens"),
        "crowded-lines",
    )
    # The template of a line depends on its leaf and tokens only, so equal lines are worked out once.
    counted = places.groupBy("leaf", "line").agg(F.count("*").alias("lines"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    distinct = materialize(counted, "distinct-lines")
    fields = distinct.select("leaf", "line", "n", "lines", F.posexplode_outer("tokens").alias("place", "token")).withColumn("token", F.xxhash64("token"))
    leading = F.lit(LEADING)
    if not fields_count:
        fields = fields.where(F.col("token") != F.xxhash64(F.lit(FIELD)))
        leading = F.size(F.filter(F.slice("tokens", 1, LEADING), lambda t: t != FIELD))
    common = materialize(
        fields.where(F.col("place") >= LEADING).groupBy("leaf", "place", "token").agg(F.sum("lines").alias("having")).where(F.col("having") >= min_docs).select("leaf", "place", "token"),
        "constant-tokens",
    )
    # The hashes of the constant tokens with their places name the template; their sum needs no list.
    constants = fields.where(F.col("place") >= LEADING).join(common, ["leaf", "place", "token"]).groupBy("line").agg(
        F.count("*").alias("kept"), F.bit_xor(F.xxhash64("place", "token")).alias("pattern")
    )
    templates = (
        distinct.select("leaf", "line", "n", leading.alias("leading")).join(constants, "line", "left")
        .withColumn("kept", F.coalesce("kept", F.lit(0)) + F.col("leading"))
        .where(F.col("kept") * constant[1] >= F.col("n") * constant[0])
        .select("line", F.xxhash64("leaf", F.coalesce("pattern", F.lit(0)), "kept").alias("template"))
    )
    marked = materialize(places.select("_digest", "_id", "at", "line").join(materialize(templates, "templates"), "line").drop("line"), "template-lines")
    per_doc = marked.groupBy("template", "_id").agg(F.lit(1).alias("one"))
    recurring = per_doc.groupBy("template").agg(F.count("*").alias("n_docs"), F.min("_id").alias("first_doc")).where(F.col("n_docs") >= min_docs)
    return marked.join(materialize(recurring, "recurring"), "template")


def without_recurring(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep_first: bool = True, lines: str | None = None, dropped: str | None = None, **limits) -> DataFrame:
    """``docs`` without lines whose template recurs across documents.

    With ``keep_first`` the document with the smallest id keeps its lines, so that nothing that
    recurs is lost for good; without it all go. All rows stay, a text may become empty, a null text
    stays null; an ``n_chars`` column gets the new length. ``lines`` and ``dropped`` name columns for
    the number of lines before, and of lines dropped. Rows that share an id are one document.
    """
    found = recurring_lines(docs, id_col, text, **limits)
    if keep_first:
        found = found.where(~F.col("_id").eqNullSafe(F.col("first_doc")))
    # At most as many places as the document has lines.
    key, places = free_name(docs, "_digest"), free_name(docs, "_gone")
    gone = materialize(found.groupBy(F.col("_digest").alias(key)).agg(F.collect_set("at").alias(places)), "dropped-lines")
    joined = docs.withColumn(key, row_digest(id_col, text)).join(gone, key, "left")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line, at: ~F.array_contains(places, at)), "\n")
    none = F.col(places).isNull()
    out = joined
    if lines:
        out = out.withColumn(lines, F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, "\n"))))
    if dropped:
        out = out.withColumn(dropped, F.when(none, 0).otherwise(F.size(places)))
    out = out.withColumn(text, F.when(none, F.col(text)).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(none, F.col("n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType)))
    return out.drop(key, places)
