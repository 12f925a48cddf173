"""SimHash of weighted word pairs, and permuted block tables that find all fingerprints within a radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockpond.llm.native import signs, votes, words
from stockpond.session import materialize

BITS = 64
RADIUS = 3
BLOCKS = 6


def with_terms(df: DataFrame, text: str, alias: str) -> DataFrame:
    """``df`` with an array of (term, weight): the hash of two words next to each other, and the length of the shorter one.

    Short function words say little about a text, so their pairs weigh little. A single word is a
    term by itself. Only an outer explode may follow (see ``with_shingles``).
    """
    listed = df.withColumn("_words", words(F.col(text)))
    n = F.size("_words")

    def pair(i: Column) -> Column:
        a, b = F.get("_words", i), F.get("_words", i + 1)
        return F.struct(F.xxhash64(a, b).alias("term"), F.least(F.length(a), F.length(b)).cast("bigint").alias("weight"))

    one = F.get("_words", F.lit(0))
    single = F.array(F.struct(F.xxhash64(one).alias("term"), F.length(one).cast("bigint").alias("weight")))
    none = F.array().cast("array<struct<term:bigint,weight:bigint>>")
    terms = F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), pair)).when(n == 1, single).otherwise(none)
    return listed.withColumn(alias, terms).drop("_words")


def fingerprints(df: DataFrame, keys: list[str], text: str, alias: str = "fingerprint") -> DataFrame:
    """``keys`` and the fingerprint of ``text``; rows with equal keys must have equal texts. No words: zero."""
    terms = with_terms(df.select(*keys, F.col(text).alias("_text")), "_text", "terms").select(*keys, F.explode_outer("terms").alias("t"))
    return terms.groupBy(*keys).agg(*votes(F.col("t.term"), F.col("t.weight"))).select(*keys, signs().alias(alias))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def permuted_tables(print_col: str, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """One entry per choice of ``blocks - radius`` blocks: the number of the table and the bits that lead in it.

    At most ``radius`` blocks hold a changed bit, so two fingerprints within the radius have
    the same leading bits in one table at least.
    """
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    chosen = [sum(c) for c in combinations(masks, blocks - radius)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in chosen]
    return F.array(*[F.struct(F.lit(i).alias("table"), F.col(print_col).bitwiseAND(F.lit(m)).alias("leading")) for i, m in enumerate(signed)])


def within_radius(prints: DataFrame, asked: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``asked``, ``found``: each distinct fingerprint of ``asked`` with all distinct ones of ``prints`` within ``radius`` bits, itself included."""
    index = prints.select("fingerprint").distinct().select(F.col("fingerprint").alias("found"), F.explode(permuted_tables("fingerprint", radius, blocks)).alias("t"))
    probes = asked.select("fingerprint").distinct().select(F.col("fingerprint").alias("asked"), F.explode(permuted_tables("fingerprint", radius, blocks)).alias("t"))
    pairs = index.join(probes, "t").where(F.bit_count(F.col("asked").bitwiseXOR(F.col("found"))) <= radius)
    return pairs.select("asked", "found").distinct()


def _ranges(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with ``_key`` (the id, null as the smallest) and ``_range``: a run of ids, numbered from the largest ids."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.withColumn("_key", F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))))
    # At most one bound per shuffle partition.
    shares = [(i + 1) / parts for i in range(parts - 1)] or [0.5]
    bounds = keyed.agg(F.percentile_approx("_key", F.array(*map(F.lit, shares)), F.lit(10_000))).first()[0] or []
    after = F.filter(F.lit(sorted(set(bounds))).cast("array<bigint>"), lambda b: b > F.col("_key"))
    return keyed.withColumn("_range", F.size(after))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half of its code points replaced by the first as many of the next document.

    The next document has the next smaller id, that of the last is the first; equal ids are
    ordered by a hash of the text, and a null id comes last. Null texts count as empty. Each
    row stays a row. ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` (bigint), ``near_edited``, ``near_next``.

    Texts are shuffled once, by ranges of ids; what a range needs from the next one is one row.
    """
    rows = _ranges(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")), "_id")
    order = [F.col("_key").desc(), F.xxhash64("_text")]
    inside = Window.partitionBy("_range").orderBy(*order)
    top = materialize(rows.groupBy("_range").agg(F.max("_key").alias("_key")), "range-tops")
    heads = rows.select("_range", "_key", "_text").join(top, ["_range", "_key"]).withColumn("_place", F.row_number().over(inside)).where("_place = 1")
    heads = materialize(heads.select("_range", F.col("_text").alias("_head")), "range-heads")
    # One row for each range.
    following = Window.orderBy("_range")
    numbers = heads.select("_range", F.lead("_range").over(following).alias("_later"), F.min("_range").over(Window.partitionBy(F.lit(1))).alias("_lowest"))
    next_range = numbers.select("_range", F.coalesce("_later", "_lowest").alias("_next_range"))
    after = materialize(next_range.join(heads.select(F.col("_range").alias("_next_range"), "_head"), "_next_range"), "next-heads")

    placed = rows.select("_id", "_range", "_text", F.row_number().over(inside).alias("_place"), F.lead("_text").over(inside).alias("_after"))
    half = F.floor(F.length("_text") / 2).cast("int")
    joined = placed.join(after, "_range").withColumn("_following", F.coalesce("_after", "_head"))
    edited = F.concat(F.substring("_text", F.lit(1), F.length("_text") - half), F.substring("_following", F.lit(1), half))
    here = F.col("_after").isNotNull()
    keys = ["_id", "_range", "_place", "_next_range", "_next_place", "n_chars", "edited_sha256", "_which"]
    both = joined.select(
        "_id",
        "_range",
        "_place",
        F.when(here, F.col("_range")).otherwise(F.col("_next_range")).alias("_next_range"),
        F.when(here, F.col("_place") + 1).otherwise(1).alias("_next_place"),
        F.length("_text").cast("bigint").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("_text").alias("text")), F.struct(F.lit(1).alias("which"), edited.alias("text")))).alias("v"),
    ).select("*", F.col("v.which").alias("_which"), F.col("v.text").alias("_version"))
    printed = fingerprints(both, keys, "_version")
    own = keys[:-1]
    wide = printed.groupBy(*own).agg(
        F.max(F.when(F.col("_which") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("_which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    wide = materialize(wide, "fingerprints")
    nexts = wide.select(F.col("_range").alias("_next_range"), F.col("_place").alias("_next_place"), F.col("fingerprint").alias("_next_print"))
    return wide.join(nexts, ["_next_range", "_next_place"]).select(
        F.col("_id").alias(id_col),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_print")).alias("near_next"),
    )
