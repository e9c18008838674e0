"""Operator 12: vectors as four one-byte codes, with distances from per-dimension value dictionaries.

A vector's components become integers and are cut into four parts. Each part has a
codebook of at most 256 entries, which starts as that part of the vectors of least id
and is moved four times to the (floored) means of the parts nearest to its entries.

A task takes the distinct integers of each dimension of a chunk, tabulates their squared
differences to all entries, and adds up, dimension by dimension, the rows of the table
that the vectors' dictionary codes point to: no vector meets an entry by itself. What a
task hands on in a round are sums and counts of its entries; Spark adds them, so a round
shuffles the size of the codebooks per task, whatever the table, and only the codebooks
reach the driver. All arithmetic is exact: sums travel as 32-bit limbs, and where 64 bits
are too few for a distance the same tables hold Python integers.

Defined cases: a vector that is null or holds a null or non-finite component is left out.
Vectors that share an id are ordered by their components. The length of the least id's
vector is the length; a vector of another length (or any, if no id is known) is kept
with null code and error. Lengths that are no multiple of four are filled with zeros. A
null id is no seed but gets a code. An error beyond a long is null, and so is the sum
over its label. Repeated rows stay as often as they occur; no vectors give no rows.
All columns are kept; made ones replace columns of their names, whatever their case.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from martweave.session import work_folder

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
CHUNK = 1024

#: Entries by part, entry and position; 64-bit integers, or Python's where those are too small.
Codebooks = np.ndarray


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(vector).isNotNull() & finite)


def integers(column: pa.Array, length: int) -> np.ndarray:
    """floor(1024 * x) of vectors of one length, filled up with zeros to a multiple of ``PARTS``."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)
    if x.size and np.abs(x).max() >= 2.0**50:
        # Beyond 2^53 a double is whole, so nothing is left to floor.
        whole = [int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE) for v in x.ravel().tolist()]
        made = np.array(whole, object).reshape(x.shape)
    else:
        made = np.floor(x * SCALE).astype(np.int64)
    return np.concatenate([made, np.zeros((len(made), -length % PARTS), made.dtype)], 1)


def nearest(books: Codebooks, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part (of equals the first), and the vectors' squared distances to them."""
    parts, entries, width = books.shape
    largest = max((int(np.abs(x).max()) for x in (books, vectors) if x.size), default=0)
    bound = max(width, 1) * (2 * largest) ** 2
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object
    books = books.astype(kind)
    codes = np.zeros((len(vectors), parts), np.int64)
    error = np.zeros(len(vectors), object if kind is object else np.int64)
    for first in range(0, len(vectors), CHUNK):
        some = vectors[first : first + CHUNK]
        each = np.arange(len(some))
        for part in range(parts):
            distance = np.zeros((len(some), entries), kind)
            for k in range(width):
                value, code = np.unique(some[:, part * width + k], return_inverse=True)
                table = (value.astype(kind)[:, None] - books[part, :, k][None, :]) ** 2
                distance += table[code]
            best = distance.argmin(1)
            codes[first : first + CHUNK, part] = best
            error[first : first + CHUNK] += distance[each, best]
    return codes, error


def _sums(books: Codebooks, vectors: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the parts nearest to each entry, and how many there are."""
    parts, entries, width = books.shape
    total = np.zeros(books.shape, object)
    count = np.zeros((parts, entries), np.int64)
    exact = vectors.dtype != object and len(vectors) * max(int(np.abs(vectors).max(initial=0)), 1) < 2**53
    for part in range(parts):
        code = codes[:, part]
        count[part] = np.bincount(code, minlength=entries)
        for k in range(width):
            column = vectors[:, part * width + k]
            if exact:
                total[part, :, k] = np.bincount(code, weights=column, minlength=entries).astype(np.int64).astype(object)
            else:
                np.add.at(total[part, :, k], code, column.astype(object))
    return total, count


def _limbs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """slot, limb and 32 bits of each value that is not 0; the last limb has the sign."""
    for slot, value in enumerate(values.tolist()):
        limb = 0
        while value:
            rest = value if -(2**31) <= value < 2**31 else value & 0xFFFFFFFF
            yield slot, limb, rest
            value, limb = (value - rest) >> 32, limb + 1


def fit(df: DataFrame, id: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS) -> tuple[Codebooks, int]:
    """Codebooks of the usable vectors of ``df``, and the vectors' length (-1: there are none with an id)."""
    vectors = usable(df, vector).select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    known = vectors.where("id IS NOT NULL").orderBy("id", "vector")
    seeds = known.limit(ENTRIES).collect()
    if not seeds:
        return np.zeros((PARTS, 0, 0), np.int64), -1
    length = len(seeds[0]["vector"])
    fitting = vectors.where(F.size("vector") == length)
    if any(len(s["vector"]) != length for s in seeds):
        seeds = fitting.where("id IS NOT NULL").orderBy("id", "vector").limit(ENTRIES).collect()
    first = integers(pa.array([s["vector"] for s in seeds], pa.list_(pa.float64())), length)
    width = first.shape[1] // PARTS
    books = np.ascontiguousarray(first.reshape(len(seeds), PARTS, width).transpose(1, 0, 2))

    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], books: Codebooks = books) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(books.shape, object), np.zeros(books.shape[:2], object)
            for batch in batches:
                made = integers(batch.column(0), length)
                more, many = _sums(books, made, nearest(books, made)[0])
                total, count = total + more, count + many
            rows = list(_limbs(np.concatenate([count.ravel(), total.ravel()])))
            columns = zip(*rows) if rows else ([], [], [])
            kinds = (pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["slot", "limb", "value"]
            )

        partial = fitting.select("vector").mapInArrow(run, "slot int, limb int, value long")
        sums = np.zeros(books.shape[0] * books.shape[1] * (1 + width), object)
        for row in partial.groupBy("slot", "limb").agg(F.sum("value").alias("value")).collect():
            sums[row["slot"]] += row["value"] << (32 * row["limb"])
        count, total = np.split(sums, [books.shape[0] * books.shape[1]])
        count, total = count.reshape(books.shape[:2]), total.reshape(books.shape)
        moved = np.where(count[:, :, None] > 0, total // np.maximum(count, 1)[:, :, None], books.astype(object))
        small = all(abs(v) < 2**62 for v in moved.ravel().tolist())
        books = moved.astype(np.int64) if small else moved
    return books, length


def assign(df: DataFrame, books: Codebooks, length: int, vector: str = "embedding") -> DataFrame:
    """The usable rows of ``df`` with ``codes`` (entry of each part) and ``error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            fits = np.flatnonzero(column.value_lengths().to_numpy(zero_copy_only=False) == length)
            codes: list[list[int] | None] = [None] * len(column)
            error: list[int | None] = [None] * len(column)
            if len(fits):
                made, far = nearest(books, integers(column.take(pa.array(fits)), length))
                for i, code, e in zip(fits.tolist(), made.tolist(), far.tolist()):
                    codes[i], error[i] = code, e if e < 2**63 else None
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(codes, pa.list_(pa.int32())), pa.array(error, pa.int64())],
                names=[*batch.schema.names[:-1], "codes", "error"],
            )

    kept = usable(df, vector).select(
        *(f"`{c}`" for c in df.columns if c.lower() not in ("codes", "error")), F.col(vector).alias("_vector")
    )
    fields = kept.schema.fields[:-1] + [StructField("codes", ArrayType(IntegerType())), StructField("error", LongType())]
    return kept.mapInArrow(run, StructType(fields))


def label_errors(assigned: DataFrame, label: str = "label") -> DataFrame:
    """``assigned`` with ``label_error``: the error summed over equal labels, nulls together.

    The sums are a written table, so Spark knows their size and broadcasts them only if
    they are small; else a label with very many rows is a skewed partition to split.
    """
    spark = assigned.sparkSession
    rows, sums = work_folder(spark, "vector_codes"), work_folder(spark, "vector_labels")
    assigned.write.parquet(rows)
    stored = spark.read.parquet(rows)
    beyond = F.max(F.col("codes").isNotNull() & F.col("error").isNull())
    total = F.coalesce(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    per_label = stored.groupBy(F.col(label).alias("_label")).agg(F.when(~beyond, total).try_cast("long").alias("label_error"))
    per_label.write.parquet(sums)
    per_label = spark.read.parquet(sums)
    joined = stored.drop("label_error").join(per_label, stored[label].eqNullSafe(per_label["_label"]))
    return joined.drop("_label")


def digest(books: Codebooks) -> str:
    """Of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def digests(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Fit, assign and add up: id, code in hex, error, label_error and the digest of the codebooks."""
    plain = df.select(F.col(id).alias("vec_id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    books, length = fit(plain)
    found = label_errors(assign(plain, books, length).select("vec_id", "label", "codes", "error"))
    two = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return found.select(
        "vec_id", F.array_join(two, "").alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def sql(dimensions: int = 64) -> str:
    """The same for tables of vectors of ``dimensions`` components and unique ids."""
    width = dimensions // PARTS
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""
    a{k} AS MATERIALIZED (
        SELECT r, p, least % 256 AS e, least // 256 AS d
        FROM (SELECT x.r, x.p, min((x.s + b.s - 2 * list_inner_product(x.c, b.c))::BIGINT * 256 + b.e) AS least
              FROM parts x JOIN b{k} b ON x.p = b.p GROUP BY x.r, x.p)
    )""")
        if k < ROUNDS:
            steps.append(f"""
    b{k + 1} AS MATERIALIZED (
        SELECT p, e, c, list_inner_product(c, c) AS s
        FROM (SELECT b.p, b.e, coalesce(m.c, b.c) AS c
              FROM b{k} b LEFT JOIN (
                  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c
                  FROM (SELECT x.p, a.e, i, sum(x.c[i]::BIGINT) AS s, count(*) AS n
                        FROM parts x JOIN a{k} a ON x.r = a.r AND x.p = a.p, range(1, {width + 1}) t(i)
                        GROUP BY x.p, a.e, i)
                  GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)
    )""")
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v,
               row_number() OVER (ORDER BY vec_id) AS r
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    parts AS MATERIALIZED (
        SELECT r, p, c, list_inner_product(c, c) AS s
        FROM (SELECT r, p, v[p * {width} + 1 : (p + 1) * {width}] AS c FROM kept, range({PARTS}) t(p))
    ),
    b0 AS MATERIALIZED (SELECT p, r - 1 AS e, c, s FROM parts WHERE r <= {ENTRIES}),{",".join(steps)},
    coded AS (
        SELECT k.vec_id, k.label, string_agg(printf('%02x', a.e), '' ORDER BY a.p) AS code, sum(a.d)::BIGINT AS error
        FROM kept k JOIN a{ROUNDS} a USING (r) GROUP BY k.r, k.vec_id, k.label
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i))
            FROM (SELECT p, e, i, c[i] AS x FROM b{ROUNDS}, range(1, {width + 1}) t(i))) AS codebooks_sha256
    FROM coded
    """
