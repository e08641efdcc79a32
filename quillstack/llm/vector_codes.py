"""Vector code compression: codebooks for the parts of vectors, refined by RDD tree aggregation.

Vectors whose components are all finite numbers are kept. Each component x becomes the integer
floor(256 * x), and the vector is cut into ``PARTS`` equal consecutive parts. Each part position has
a codebook of ``ENTRIES`` entries, which starts as that part of the vectors with the smallest ids.

Blocks. Rows are packed into blocks of component-major NumPy integers, some megabytes each, once;
blocks keep ids and labels beside them and are checkpointed, so every round reads the shared files.

Rounds. A round is one ``treeAggregate`` over the blocks: in a block the squared distances of all
rows to the entries of a codebook are accumulated one component at a time, the nearest entry (ties to
the lower index) is taken, and ``np.add.at`` adds rows to int64 tensors of sums and counts. The tensors
have the size of the codebooks, whatever the table, and merge through a tree of reducers, so the driver
adds up a few of them. Entries become the floor of their means; unused ones stay.

The last assignment gives each vector its code (an index a part), its error and its label's error.
All of it is in integers, so results don't depend on partitions or the order of rows.

Cases. Null vectors and those with null, NaN or infinite components are dropped. Null ids come last,
equal ids in the order of their vectors; repeated rows count each. Null labels are one label. Vectors
shorter than the longest kept one, and lengths that 16 doesn't divide, are filled up with zeros. Fewer
than 64 kept vectors make smaller codebooks, none an empty result. Integers beyond the magnitude at
which squared distances would no longer fit in 64 bits are held at it (for 64 components from values of
740,000 on); a label whose error doesn't fit in a long has a null there.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint, join_named

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integers of one block at most.
BLOCK = 1 << 20
#: Totals of labels are broadcast up to so many rows of about 30 bytes, and joined by a shuffle beyond.
BROADCAST_LABELS = 100_000
#: Tensors that one reducer of the tree merges, about.
FAN_IN = 32


@dataclass(frozen=True)
class Codebooks:
    """entries[part, entry, component], all integers."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        """Of the decimal integers by part, entry and component, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, block: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry for the part of each row of a component-major block."""
        entries = self.entries[part]
        n, width = entries.shape
        distance = np.zeros((block.shape[1], n), np.int64)
        for k in range(width):
            gap = block[part * width + k].astype(np.int64)[:, None] - entries[None, :, k]
            distance += gap * gap
        index = distance.argmin(axis=1)  # the first of equal ones
        return index, distance[np.arange(len(index)), index]


def integers(vectors: DataFrame, id_col: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """(id, label, v) of the kept rows, v being integers of one length, and that length."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.where(x.isNotNull() & finite).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("label"), x.alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    size = max(1, math.ceil(longest / PARTS)) * PARTS
    most = math.isqrt((2**63 - 1) // size) // 2
    held = F.transform("v", lambda c: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(c.cast("double") * SCALE))).cast("int"))
    return kept.select("id", "label", F.concat(held, F.array_repeat(F.lit(0), F.lit(size) - F.size("v"))).alias("v")), size


def _blocks(size: int):
    rows = max(1, BLOCK // size)

    def made(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                n = batch.num_rows
                flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                columns = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(c)) for c in ("id", "label")]
                block = np.ascontiguousarray(flat.reshape(n, size).T)
                yield pa.RecordBatch.from_arrays([*columns, pa.array([block.tobytes()], pa.binary())], names=["ids", "labels", "block"])

    return made


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """(ids, labels, block): the rows of integers(), packed."""
    kinds = rows.select(F.array("id").alias("ids"), F.array("label").alias("labels"), F.lit(b"").alias("block")).schema
    return rows.mapInArrow(_blocks(size), kinds)


def first_entries(rows: DataFrame, size: int) -> Codebooks:
    """The parts of the ENTRIES kept vectors with the smallest ids."""
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(ENTRIES).select("v").collect()  # bounded: ENTRIES rows
    whole = np.array([r.v for r in first], np.int64).reshape(len(first), PARTS, size // PARTS)
    return Codebooks(whole.transpose(1, 0, 2).copy())


def refined(packed: DataFrame, books: Codebooks, size: int) -> Codebooks:
    """The codebooks after one round over all blocks."""
    parts, n, width = books.entries.shape
    rdd = packed.select("block").rdd

    def gather(so_far, row):
        sums, counts = so_far
        block = np.frombuffer(row.block, np.int32).reshape(size, -1)
        for part in range(parts):
            index, _ = books.nearest(block, part)
            np.add.at(counts[part], index, 1)
            for k in range(width):
                np.add.at(sums[part, :, k], index, block[part * width + k])
        return sums, counts

    def merge(a, b):
        return a[0] + b[0], a[1] + b[1]

    zero = (np.zeros((parts, n, width), np.int64), np.zeros((parts, n), np.int64))
    depth = max(2, math.ceil(math.log(max(rdd.getNumPartitions(), 1), FAN_IN)))
    sums, counts = rdd.treeAggregate(zero, gather, merge, depth)
    return Codebooks(np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], books.entries))


def _coded(books: Codebooks, size: int):
    digits = np.array([f"{k:02x}" for k in range(ENTRIES)])

    def made(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block = np.frombuffer(batch.column("block")[k].as_py(), np.int32).reshape(size, -1)
                error = np.zeros(block.shape[1], np.int64)
                codes = []
                for part in range(PARTS):
                    index, distance = books.nearest(block, part)
                    codes.append(digits[index])
                    error += distance
                code = ["".join(x) for x in zip(*(c.tolist() for c in codes))]
                ids, labels = (batch.column(c)[k].values for c in ("ids", "labels"))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code), pa.array(error)], names=["id", "label", "code", "error"])

    return made


def encode(packed: DataFrame, books: Codebooks, size: int) -> DataFrame:
    """(id, label, code, error) of every row in the blocks."""
    kinds = packed.select(F.col("ids")[0].alias("id"), F.col("labels")[0].alias("label"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    return packed.mapInArrow(_coded(books, size), kinds.schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """coded with ``label_error``, the sum of the errors of its label's rows."""
    key = F.concat(F.when(F.col("label").isNull(), "-").otherwise("="), F.coalesce(F.col("label").cast("string"), F.lit("")))
    keyed = coded.withColumn("key", key)
    totals = checkpoint(keyed.groupBy("key").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("times")))
    n, rows = totals.agg(F.count(F.lit(1)), F.sum("times")).first()
    if n <= BROADCAST_LABELS:
        return keyed.join(broadcast_if_small(totals.drop("times"), n, BROADCAST_LABELS), "key").drop("key")
    return join_named(keyed, totals, ["key"], rows or 0).drop("key")


def compress(vectors: DataFrame, id_col="vec_id", vector="embedding", label="label", rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """((id, label, code, error, label_error) of every kept row, the codebooks that decode them)."""
    rows, size = integers(vectors, id_col, vector, label)
    books = first_entries(rows, size)
    packed = checkpoint(blocks(rows, size))
    for _ in range(rounds if books.entries.size else 0):
        books = refined(packed, books, size)
    coded = with_label_errors(checkpoint(encode(packed, books, size)))
    return coded.withColumnsRenamed({"id": id_col, "label": label}), books


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """coded with ``decoded``, the vector of the entries that each code names, back in the scale of the input."""
    entries = books.entries / SCALE

    def made(batches):
        for batch in batches:
            index = np.array([list(bytes.fromhex(c)) for c in batch.column("code").to_pylist()], np.int64).reshape(-1, len(entries))
            whole = np.concatenate([entries[p][index[:, p]] for p in range(len(entries))], axis=1)
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(whole.ravel()), whole.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, vectors], names=[*batch.schema.names, "decoded"])

    return coded.mapInArrow(made, coded.withColumn("decoded", F.array(F.lit(0.0))).schema)
