"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits.

Shingles. A text's A-Z are lower-cased and its runs of five words are hashed to 64 bits, each word by XXH3
and the run by a multiply-and-add over its words; texts with fewer words are one shingle.

Bins. Every shingle is hashed once. Its first bits name one of ``BINS`` bins, which keeps the smallest hash.
Bins without a shingle are filled by optimal densification: each has a fixed random order of all bins,
the same for every text, and takes from the first in it that is not empty, so a value is borrowed from any
full bin with equal chance, and by two texts from the same bin whenever both have it.

Bits. A bin's value is mixed with the bin's number, or bins that borrow one value would agree by chance
together, and its low ``BITS`` bits are stored: 256 bytes a text. Unequal values agree in them with a chance
of 2^-BITS, so a share m of agreeing bins means a likeness of (m - 2^-BITS) / (1 - 2^-BITS), held at 0.

Order of documents. ``print_and_compare`` needs each text beside the next one in the order of ids. Rows are
range partitioned and read in order, one row kept back; a partition gives its first and last text as
rows of their own, and these, a pair a partition, are joined by the numbers of the partitions. So no task
sees more than its partition, and texts move once.

Cases. Null and empty texts and those without words have no shingle and one fingerprint, all zeros; their
likeness is 1 among themselves and 0 to any other text (others are never all zeros). Equal texts have
equal fingerprints, and a likeness of 1. Null ids come last in the descending order, rows with one id in
the order of their texts' hashes; rows that agree in both are next to each other. A table of one row has
itself as the next. Texts are read whole, 65,536 shingles at a time. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, partitions

SHINGLE, BINS, BITS = 5, 512, 4
_SHIFT = np.uint64(64 - (BINS - 1).bit_length())
_CHUNK = 1 << 16
_NONE = np.uint64(2**64 - 1)
_STARTS = np.arange(BINS, dtype=np.uint64) << _SHIFT


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all of theirs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: _TURN[i, j]: when bin i asks bin j; the smaller the sooner, no two alike in a row.
_TURN = _mixed(np.arange(1, BINS * BINS + 1, dtype=np.uint64)).reshape(BINS, BINS)
_TIMES = _mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
_SALT = _mixed(np.arange(BINS, dtype=np.uint64) + np.uint64(1 << 32))


def word_hashes(text: str | None) -> np.ndarray:
    """The hashes of a text's words."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()], np.uint64)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """The hashes of the shingles of a run of words; of all words as one if they are fewer."""
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1 if size else 0
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = _mixed(total + words[k : k + n]) * _TIMES[k]
    return _mixed(total)


def bins(words: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin; _NONE for an empty one."""
    least = np.full(BINS, _NONE)
    for at in range(0, max(1, len(words) - SHINGLE + 1), _CHUNK):
        hashes = np.sort(shingle_hashes(words[at : at + _CHUNK + SHINGLE - 1]))
        if len(hashes):
            first = np.searchsorted(hashes, _STARTS)
            found = hashes[np.minimum(first, len(hashes) - 1)]
            own = (first < len(hashes)) & (found >> _SHIFT == np.arange(BINS, dtype=np.uint64))
            least = np.where(own, np.minimum(least, found), least)
    return least


def densified(least: np.ndarray) -> np.ndarray:
    """least with the empty bins filled from full ones."""
    full = np.flatnonzero(least != _NONE)
    empty = np.flatnonzero(least == _NONE)
    if not len(full) or not len(empty):
        return least
    out = least.copy()
    out[empty] = least[full[_TURN[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def fingerprint(text: str | None) -> bytes:
    """The packed low-order bits of a text's bins; all zeros for a text without words."""
    words = word_hashes(text)
    if not len(words):
        return bytes(BINS * BITS // 8)
    low = (_mixed(densified(bins(words)) ^ _SALT) & np.uint64(2**BITS - 1)).astype(np.uint8)
    if not low.any():
        low[0] = 1
    shifts = np.arange(8 // BITS, dtype=np.uint8) * BITS
    return (low.reshape(-1, 8 // BITS) << shifts).sum(axis=1, dtype=np.uint8).tobytes()


def likeness(one: bytes, other: bytes) -> float:
    """The estimated Jaccard similarity of two texts, from 0 to 1, without the bias of agreeing by chance."""
    if one == other:
        return 1.0
    if not any(one) or not any(other):
        return 0.0
    apart = np.frombuffer(one, np.uint8) ^ np.frombuffer(other, np.uint8)
    mask = 2**BITS - 1
    same = sum(int((apart >> k & mask == 0).sum()) for k in range(0, 8, BITS)) / BINS
    chance = 0.5**BITS
    return max(0.0, (same - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """text with its last third, in code points, replaced by as much of the beginning of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, text="text", out="fingerprint") -> DataFrame:
    """docs with the fingerprint of the text as bytes in ``out``, in place of a column of that name in any case."""
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))

    def made(batches):
        for batch in batches:
            prints = pa.array([fingerprint(t) for t in batch.column("__text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], prints], names=[*kept, out])

    schema = rows.select(*[F.col(f"`{c}`") for c in kept], F.lit(b"").alias(out)).schema
    return rows.mapInArrow(made, schema)


_MADE = {"n_chars": pa.int64(), "edited_sha256": pa.binary(), "fingerprint": pa.binary(), "edited_fingerprint": pa.binary(), "near_edited": pa.float64(), "near_next": pa.float64()}
_MADE_SQL = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_AS_HEX = ("edited_sha256", "fingerprint", "edited_fingerprint")


def _compared(text: str, own: bytes, following: str, its: bytes) -> tuple:
    """The columns of _MADE for a text and the next one, with their fingerprints."""
    changed = edited(text, following)
    after = own if changed == text else fingerprint(changed)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).digest()
    return len(text), sha, own, after, likeness(own, after), likeness(own, its)


def _rows(ids, found: list, names: list[str], further: list[pa.Array]) -> pa.RecordBatch:
    columns = [pa.array([f and f[k] for f in found], kind) for k, kind in enumerate(_MADE.values())]
    return pa.RecordBatch.from_arrays([ids, *columns, *further], names=names)


def _in_order(batches):
    """Each row with the next of its partition. The last, without one, and the first come as texts too."""
    names = ["id", *_MADE, "part", "first", "last"]
    kept = None  # the row that waits for its next: (id, text, fingerprint)
    first = part = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        texts = [t or "" for t in batch.column("text").to_pylist()]
        prints = [fingerprint(t) for t in texts]
        ids = batch.column("id")
        waiting = [] if kept is None else [kept]
        if first is None:
            first = texts[0]
        pairs = [*((t, p) for _, t, p in waiting), *zip(texts, prints)]
        found = [_compared(*a, *b) for a, b in zip(pairs, pairs[1:])]
        whole = pa.concat_arrays([*(i for i, _, _ in waiting), ids])
        kept = (whole.slice(len(whole) - 1), texts[-1], prints[-1])
        if found:
            n = len(found)
            none = pa.nulls(n, pa.string())
            yield _rows(whole.slice(0, n), found, names, [pa.array([part] * n, pa.int32()), none, none])
    if kept is not None:
        yield _rows(kept[0], [None], names, [pa.array([part], pa.int32()), pa.array([first]), pa.array([kept[1]])])


def _across(batches):
    """The last rows of partitions, with the first text of the next one."""
    for batch in batches:
        texts, following = (batch.column(c).to_pylist() for c in ("last", "following"))
        yield _rows(batch.column("id"), [_compared(a, fingerprint(a), b, fingerprint(b)) for a, b in zip(texts, following)], ["id", *_MADE], [])


def print_and_compare(docs: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is that with the next smaller id, and the first of all after the last.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("same"))
    # equal rows may lie anywhere among themselves; the number of a row spreads very many of them
    order = [F.desc_nulls_last("id"), F.col("same"), F.xxhash64(F.monotonically_increasing_id()).alias("spread")]
    ranged = rows.withColumn("spread", order.pop()).repartitionByRange(partitions(docs.sparkSession), *order, F.col("spread"))
    ranged = ranged.sortWithinPartitions(*order).select("id", "text", F.spark_partition_id().alias("part"))
    kinds = rows.select("id").schema.simpleString().removeprefix("struct<id:").removesuffix(">")
    found = checkpoint(ranged.mapInArrow(_in_order, f"id {kinds}, {_MADE_SQL}, part int, first string, last string"))
    ends = found.where("last IS NOT NULL")  # a row a partition
    turn = Window.orderBy("part")
    after = ends.select("part").withColumn("next", F.lead("part").over(turn))
    after = after.select("part", F.coalesce("next", F.min("part").over(Window.partitionBy())).alias("next"))
    heads = ends.select(F.col("part").alias("next"), F.col("first").alias("following"))
    tails = ends.select("part", "id", "last").join(F.broadcast(after), "part").join(heads, "next").select("id", "last", "following")
    tails = tails.mapInArrow(_across, f"id {kinds}, {_MADE_SQL}")
    out = found.where("last IS NULL").drop("part", "first", "last").unionByName(tails)
    return out.withColumns({c: F.lower(F.hex(c)) for c in _AS_HEX}).withColumnRenamed("id", id_col)
