"""Column expressions that the native operators share: row digests, shingle hashes, bit votes, a bit filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockpond.session import materialize

# The bit filter: 2^21 bits, three probes. Its size never grows; with very many keys it only lets more rows pass.
FILTER_BITS = 21
PROBES = 3
WORD = 6  # log2 of the bits of a bigint

LANES = 32


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_digest(id_col: str, text: str) -> Column:
    """One key for rows equal in id and text, whatever is null; 128 bits."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_shingles(df: DataFrame, text: str, size: int = 5, alias: str = "shingles") -> DataFrame:
    """``df`` with an array of the hashes of all runs of ``size`` words, in order; fewer words: one hash of them all; none: no hash.

    Explode the array with an outer explode only: for an inner one Spark filters by its size further
    down, where the whole expression would be worked out again for each of its elements.
    """
    hashed = df.withColumn("_words", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
    n = F.size("_words")
    runs = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(size)]))
    few = F.array(F.xxhash64(F.concat_ws(" ", F.transform("_words", lambda w: w.cast("string")))))
    none = F.array().cast("array<bigint>")
    return hashed.withColumn(alias, F.when(n >= size, runs).when(n > 0, few).otherwise(none)).drop("_words")


def votes(term: Column, weight: Column) -> list[Column]:
    """Sums that hold, two bits to a bigint, the weight of the terms with each bit set; the last one is the total weight."""
    both = F.lit((1 << LANES) + 1)
    lanes = [F.sum(F.shiftrightunsigned(term, i).bitwiseAND(both) * weight).alias(f"_v{i}") for i in range(LANES)]
    return [*lanes, F.sum(weight).alias("_weight")]


def signs() -> Column:
    """The fingerprint of summed ``votes``: a bit is set where more weight is for it than against it. Weights up to 2^31 in all."""
    bits = F.lit(0).cast("bigint")
    for i in range(LANES):
        for value, bit in ((F.col(f"_v{i}").bitwiseAND(F.lit((1 << LANES) - 1)), i), (F.shiftrightunsigned(f"_v{i}", LANES), i + LANES)):
            one = F.lit((1 << bit) if bit < 63 else -(1 << 63))
            bits = bits.bitwiseOR(F.when(value * 2 > F.col("_weight"), one).otherwise(F.lit(0).cast("bigint")))
    return bits


def _slot(key: Column, probe: int) -> Column:
    return F.shiftrightunsigned(key, probe * FILTER_BITS).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def bit_filter(keys: DataFrame, key: str) -> DataFrame:
    """One row with the filter of 64-bit hashes as an array of bigints: 256 KB, however many keys."""
    size = 1 << (FILTER_BITS - WORD)
    slots = keys.select(F.explode(F.array(*[_slot(F.col(key), p) for p in range(PROBES)])).alias("slot"))
    bit = F.expr(f"shiftleft(1L, cast(slot & {(1 << WORD) - 1} as int))")
    held = slots.groupBy(F.shiftright("slot", WORD).alias("place")).agg(F.bit_or(bit).alias("bits"))
    filled = keys.sparkSession.range(size).withColumnRenamed("id", "place").join(held, "place", "left")
    ordered = F.sort_array(F.collect_list(F.struct("place", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return materialize(filled.agg(F.transform(ordered, lambda x: x.bits).alias("bits")), "bit-filter")


def may_hold(filter_row: DataFrame, key: Column) -> Column:
    """False only for hashes that are not in the filter."""
    bits = filter_row.scalar()
    passes = F.lit(True)
    for probe in range(PROBES):
        slot = _slot(key, probe)
        word = F.get(bits, F.shiftright(slot, WORD).cast("int"))
        passes = passes & (F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit((1 << WORD) - 1)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return passes
