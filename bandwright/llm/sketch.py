"""Threshold-scaled sketches: a document is known by those of its shingle hashes that lie below a fixed fraction of
all hashes.

Sketches of any two documents hold the same choice of shingles, however unequal they are in length, so the share of
one that lies in the other estimates containment, and the sketch of a union is the union of the sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import shielded, unshielded, words

SIZE = 5
#: One hash in 2 ** 2 is retained.
FRACTION_BITS = 2
_TOP = -(1 << 63)


def with_sketch(df: DataFrame, text: str, name: str, size: int = SIZE, fraction_bits: int = FRACTION_BITS) -> DataFrame:
    """Add the sketch of a text as a sorted array of hashes.

    Shingles are runs of `size` lower-case words; a shorter text is one shingle. If no hash lies below the threshold
    the least is retained alone, so that only a text without words has an empty sketch.
    """
    hashed = df.withColumn("__words", F.transform(words(F.lower(text)), lambda x: F.xxhash64(x)))
    w = F.col("__words")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size)))
    )
    shingles = F.when(F.size(w) >= size, windows).when(F.size(w) > 0, F.array(F.xxhash64(w)))
    hashed = hashed.withColumn("__all", shingles).drop("__words")
    limit = 1 << (64 - fraction_bits)
    low = F.filter("__all", lambda x: (x >= 0) & (x < limit) if fraction_bits else F.lit(True))
    hashed = hashed.withColumn("__low", F.array_distinct(low))
    # The least as an unsigned number: flip the sign bit around a signed minimum.
    least = F.array_min(F.transform("__all", lambda x: x.bitwiseXOR(F.lit(_TOP)))).bitwiseXOR(F.lit(_TOP))
    whole = F.when(F.size("__low") > 0, F.array_sort("__low")).when(F.col("__all").isNotNull(), F.array(least))
    return hashed.withColumn(name, F.coalesce(whole, F.array().cast("array<long>"))).drop("__all", "__low")


def merged(a: Column, b: Column, fraction_bits: int = FRACTION_BITS) -> Column:
    """The sketch of two texts together, from their sketches. Shingles that reach over the joint are not in it."""
    both = F.array_union(a, b)
    low = F.filter(both, lambda x: (x >= 0) & (x < (1 << (64 - fraction_bits))) if fraction_bits else F.lit(True))
    least = F.array_min(F.transform(both, lambda x: x.bitwiseXOR(F.lit(_TOP)))).bitwiseXOR(F.lit(_TOP))
    return F.when(F.size(low) > 0, F.array_sort(low)).when(F.size(both) > 0, F.array(least)).otherwise(both)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of `a` that are in `b`; of an empty sketch, 1 in another empty one, else 0."""
    shared = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when(F.size(a) > 0, shared).otherwise((F.size(b) == 0).cast("double"))


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among those of both; 1 for two empty sketches."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total > 0, shared / total).otherwise(1.0)


def hex_digest(sketch: Column) -> Column:
    """The sketch as a string, 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def sketch_documents(
    docs: DataFrame, text: str = "text", size: int = SIZE, fraction_bits: int = FRACTION_BITS
) -> DataFrame:
    """All rows with `sketch`. NULL and empty texts have an empty one, equal texts equal ones; texts of any length are
    read whole. No shuffle. An input column named `sketch` gives way to the output."""
    inner, names = shielded(docs, text)
    whole = inner.withColumn("text", F.coalesce(names[text], F.lit("")))
    sketched = with_sketch(whole, "text", "sketch", size, fraction_bits)
    return unshielded(sketched, docs.columns, {"sketch": F.col("sketch")})
