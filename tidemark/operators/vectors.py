"""The vertical split: vectors in a side table, their keys in the event rows.

A row's two vectors are the widest columns by far. Stored rows have a key of
the vector's content in place of each, under the same column name, so folds, dedups and
compactions move 32 characters, and an update that leaves a vector alone stores no
copy. The side table ``(vec_key, vec)`` has each content once. Reads that
want vectors join them to their final rows (:func:`with_vectors`).

A key is the hex of 128 bits of hash; NULL stands for NULL and ``''`` for the empty
vector, which the side table leaves out. Vectors that are equal as SQL values
(0.0 and -0.0) share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark.functions.exprs import empty_floats
from tidemark.schema import ARRAY_FIELDS, FLOAT_ARRAY

VECTOR_SCHEMA = StructType([StructField("vec_key", StringType()), StructField("vec", FLOAT_ARRAY)])


def keyed_schema(schema: StructType) -> StructType:
    """The schema of rows that hold keys in place of vectors."""
    return StructType([StructField(f.name, StringType() if isinstance(f.dataType, ArrayType) else f.dataType) for f in schema.fields])


def vector_key(vector: Column | str) -> Column:
    v = F.col(vector) if isinstance(vector, str) else vector
    hashed = F.concat(F.lpad(F.hex(F.xxhash64(v)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(11), v, F.size(v))), 16, "0"))
    return F.when(v.isNotNull(), F.when(F.size(v) == 0, F.lit("")).otherwise(hashed))


def split_vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with keys in place of vectors, and ``vec_key, vec`` of all vectors that are not empty (copies included)."""
    keyed = rows.withColumns({c: vector_key(c) for c in ARRAY_FIELDS})
    pairs = F.array(*[F.struct(vector_key(c).alias("vec_key"), F.col(c).alias("vec")) for c in ARRAY_FIELDS])
    return keyed, rows.select(F.inline(pairs)).where(F.col("vec_key") != "")


def with_vectors(rows: DataFrame, vectors: DataFrame, columns: tuple[str, ...] = ARRAY_FIELDS) -> DataFrame:
    """Keys replaced by the vectors they stand for.

    Only vectors that the rows name pass a join: for a few final rows AQE
    broadcasts their keys, and the side table is scanned without a shuffle.
    A row without a vector meets nothing, so it joins by a hash of its own: by
    the one key ``''`` all such rows would be one task's.
    """
    wanted = rows.select(F.explode(F.array(*columns)).alias("vec_key")).where(F.col("vec_key") != "").distinct()
    some = vectors.join(wanted, "vec_key", "left_semi")
    out = rows
    apart = F.concat(F.lit("-"), F.xxhash64(*([c for c in rows.columns if c not in columns] or columns)).cast("string"))
    for c in columns:
        own = some.select(F.col("vec_key").alias(f"_key_{c}"), F.col("vec").alias(f"_vec_{c}"))
        out = out.join(own, F.when(F.col(c) != "", F.col(c)).otherwise(apart) == F.col(f"_key_{c}"), "left")
        out = out.withColumn(c, F.when(F.col(c) == "", empty_floats()).otherwise(F.col(f"_vec_{c}"))).drop(f"_key_{c}", f"_vec_{c}")
    return out
