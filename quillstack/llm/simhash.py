"""SimHash near-dedup with BK-trees.

Fingerprints. A text's A-Z are lower-cased, its shingles of three words, repeats included, are
hashed with XXH64 (seed 42), and a bit of the fingerprint is set if it is set in more than half
of the hashes. Texts with fewer words are one shingle; texts without words, and null, have
fingerprint zero.

Shards. Fingerprints that differ in three bits or fewer agree in one of four blocks of the bits,
in two of five, and so on. Each distinct fingerprint goes to one shard for each choice of blocks,
keyed by the first bits of these blocks, as many as make shards of about ``SHARD`` fingerprints;
more of them than 2^16 times that need two blocks. So shards do not grow with the corpus. One
that is larger all the same, as many near copies have many bits in common, is cut into pieces.

Trees. Each piece of a shard is a BK-tree: the first fingerprint is the root, the children of a
node are keyed by their integer Hamming distance to it, and every node holds one fingerprint. A
search compares a query with a node and follows only the edges whose key is within the radius of
that distance. The trees are broadcast if all of them together have at most ``BROADCAST_BYTES``,
which is measured, and are dealt by a shuffle beyond. Each piece is searched in the trees of its
own number and of those after it in the shard, each such pair being a row of its own, so no shard
meets in one task as a whole. Searches give a spanning forest of the links they find, not all pairs.

Components of links come from star steps (see graph). Exact copies share a fingerprint and are
grouped before anything else. Null ids are the smallest only if a component has no other; rows
may repeat. Texts are read whole, however long, 65,536 shingles at a time. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint, join_named, partitions
from .graph import components

SHINGLE, SEED, RADIUS, BITS = 3, 42, 3, 64
#: Fingerprints of a shard on average, and of one tree at most.
SHARD, PIECE = 512, 2048
#: Shard trees are broadcast up to so many bytes together, and dealt by a shuffle beyond.
BROADCAST_BYTES = 8 << 20
#: Shards of several pieces are broadcast up to so many rows of about 20 bytes, and joined by a shuffle beyond.
BROADCAST_SHARDS = 200_000
#: Documents that go are broadcast up to so many rows of about 20 bytes, and joined by a shuffle beyond.
BROADCAST_GONE = 500_000
_CHUNK = 1 << 16
_QUERIES = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        hashes = np.fromiter(
            (digest(joined[a : b - 1], SEED) for a, b in zip(starts[at:to], ends[at + shingle - 1 : to + shingle - 1])), np.uint64, to - at
        )
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        fps = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("same"), pa.array(fps, pa.int64())], names=["id", "same", "fp"])


class BKTree:
    """A BK-tree over distinct unsigned 64-bit integers, one a node; child[v, k] is v's child at distance k, or -1."""

    __slots__ = ("value", "child", "followed", "pruned")

    def __init__(self, value: np.ndarray, child: np.ndarray):
        self.value, self.child = value, child
        #: Edges that searches followed, and those they did not.
        self.followed = self.pruned = 0

    @classmethod
    def grown(cls, values: np.ndarray) -> BKTree:
        """The tree of values put in one after the other, all values moving down a level at a time."""
        child = np.full((len(values), BITS + 1), -1, np.int32)
        waiting = np.arange(1, len(values), dtype=np.int32)
        at = np.zeros(len(waiting), np.int32)
        while len(waiting):
            edge = at.astype(np.int64) * (BITS + 1) + np.bitwise_count(values[waiting] ^ values[at])
            edges, first, which = np.unique(edge, return_index=True, return_inverse=True)
            child.ravel()[edges] = waiting[first]
            at = waiting[first][which]
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            waiting, at = waiting[rest], at[rest]
        return cls(values, child)

    def packed(self) -> bytes:
        """13 bytes a node: its value, its parent and its distance to it."""
        parent, key = np.zeros(len(self.value), np.int32), np.zeros(len(self.value), np.uint8)
        up, distance = np.nonzero(self.child >= 0)
        parent[self.child[up, distance]], key[self.child[up, distance]] = up, distance
        return self.value.tobytes() + parent.tobytes() + key.tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> BKTree:
        value = values_of(data)
        n = len(value)
        child = np.full((n, BITS + 1), -1, np.int32)
        if n > 1:
            child[np.frombuffer(data, np.int32, n, 8 * n)[1:], np.frombuffer(data, np.uint8, n, 12 * n)[1:]] = np.arange(1, n)
        return cls(value, child)

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(places of queries, nodes) of all pairs within the radius."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int32)
        near_q, near_node = [], []
        width = np.arange(-radius, radius + 1)
        fan = (self.child >= 0).sum(axis=1)
        while len(q):
            distance = np.bitwise_count(queries[q] ^ self.value[node]).astype(np.int32)
            near = distance <= radius
            near_q.append(q[near])
            near_node.append(node[near])
            key = distance[:, None] + width
            below = np.where((key >= 0) & (key <= BITS), self.child[node[:, None], np.clip(key, 0, BITS)], -1)
            edge = np.nonzero(below >= 0)
            self.followed += len(edge[0])
            self.pruned += int(fan[node].sum()) - len(edge[0])
            q, node = q[edge[0]], below[edge]
        return np.concatenate(near_q), np.concatenate(near_node)


def values_of(data: bytes) -> np.ndarray:
    """The fingerprints of a packed tree."""
    return np.frombuffer(data, np.uint64, len(data) // 13)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def tree_links(queries: np.ndarray, tree: BKTree, own: bool, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between queries and the tree's values; own: the queries are these values."""
    n = len(tree.value)
    values = tree.value if own else np.concatenate([tree.value, queries])
    forest, links = _Forest(len(values)), []
    for k in range(0, len(queries), _QUERIES):
        q, t = tree.search(queries[k : k + _QUERIES], radius)
        q = q + (k if own else k + n)
        keep = q != t
        pairs = q[keep].astype(np.int64) * len(values) + t[keep]
        pairs.sort()
        q, t = pairs // len(values), pairs % len(values)
        # neighbours of one query are linked one to the next, so equal links of many queries fall together
        first = np.ones(len(q), bool)
        first[1:] = q[1:] != q[:-1]
        left = np.where(first, q, np.concatenate([t[:1] * 0, t[:-1]]))
        for pair in np.unique(left * len(values) + t):
            a, b = divmod(int(pair), len(values))
            if forest.join(a, b):
                links.append((int(values[a]), int(values[b])))
    return links


def _trees(batches):
    """Rows sorted by (c, key, piece) to one packed tree each."""
    names = ["c", "key", "piece", "pieces"]
    group, values = None, []

    def made(found):
        columns = [pa.array([g[i] for g, _ in found], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.int32()))]
        trees = [BKTree.grown(np.concatenate(v)).packed() for _, v in found]
        return pa.RecordBatch.from_arrays([*columns, pa.array(trees, pa.binary())], names=[*names, "tree"])

    for batch in batches:
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(fp):
            continue
        cut = np.nonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:3]]))[0] + 1
        found = []
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)]):
            here = tuple(int(c[a]) for c in columns)
            if here != group:
                if values:
                    found.append((group, values))
                group, values = here, []
            values.append(fp[a:b])
        yield made(found)
    if values:
        yield made([(group, values)])


def _links(radius: int):
    def run(batches):
        for batch in batches:
            links = []
            for own, asked, tree in zip(*[batch.column(n).to_pylist() for n in ("own", "asked", "tree")]):
                links += tree_links(values_of(asked), BKTree.unpacked(tree), own, radius)
            found = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def shard_masks(n: int, radius: int = RADIUS, shard: int = SHARD) -> list[int]:
    """Masks whose bits key the shards of n fingerprints: for every choice of ``matched`` blocks, their first bits.

    Two fingerprints within the radius agree in all bits of one mask at least. ``matched`` is the
    fewest blocks that have bits enough for shards of that size.
    """
    needed = max(0, math.ceil(math.log2(max(1, n) / shard)))
    matched = next(m for m in range(1, BITS - radius) if m * (BITS // (radius + m)) >= needed)
    blocks = radius + matched
    bits = -(-needed // matched)
    # a block has every blocks-th bit, as neighbouring ones may go together
    one = [sum(1 << (b + blocks * k) for k in range(bits)) for b in range(blocks)]
    return [sum(x) for x in combinations(one, matched)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def shard_trees(fingerprints: DataFrame, radius: int = RADIUS, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """(c, key, piece, pieces, tree): the packed trees of all shards of distinct fingerprints (fp)."""
    masks = shard_masks(fingerprints.count(), radius, shard)
    keys = F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])
    keyed = fingerprints.select("fp", F.explode(keys).alias("k")).select("k.c", "k.key", "fp")
    counted = keyed.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n"))
    large = checkpoint(counted.where(F.col("n") > piece).select("c", "key", F.ceil(F.col("n") / piece).cast("int").alias("pieces")))
    dealt = keyed.join(broadcast_if_small(large, large.count(), BROADCAST_SHARDS), ["c", "key"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
    dealt = dealt.repartition(partitions(fingerprints.sparkSession), "c", "key", "piece").sortWithinPartitions("c", "key", "piece")
    return dealt.mapInArrow(_trees, "c int, key long, piece int, pieces int, tree binary")


def near_links(fingerprints: DataFrame, radius: int = RADIUS, shard: int = SHARD, piece: int = PIECE, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (fp) within the radius of each other."""
    trees = checkpoint(shard_trees(fingerprints, radius, shard, piece).where("pieces > 1 OR length(tree) > 13"))
    size = trees.agg(F.sum(F.length("tree"))).first()[0] or 0
    asked = trees.select("c", "key", F.col("piece").alias("asks"), F.col("tree").alias("asked"), F.explode(F.sequence("piece", F.col("pieces") - 1)).alias("piece"))
    units = asked.join(broadcast_if_small(trees.select("c", "key", "piece", "tree"), size, limit), ["c", "key", "piece"])
    dealt = units.repartition(partitions(fingerprints.sparkSession), "c", "key", "piece", "asks")
    return dealt.select((F.col("asks") == F.col("piece")).alias("own"), "asked", "tree").mapInArrow(_links(radius), "a long, b long").distinct()


def _rooted(docs: DataFrame, id_col: str, text: str, radius: int = RADIUS) -> DataFrame:
    """(id, same, fp, root, component): as near_duplicates, with the fingerprint that names each component."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("same"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("id", "same", F.lit(0).cast("long").alias("fp")).schema
    prints = checkpoint(rows.mapInArrow(_fingerprints, schema))
    distinct = checkpoint(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    roots = components(near_links(distinct.select("fp"), radius))
    labelled = checkpoint(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")))
    least = labelled.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("times"))
    named = checkpoint(join_named(labelled, least, ["root"], labelled.count()).select("fp", "root", "component", F.col("rows").alias("times")))
    return join_named(prints, named, ["fp"], prints.count()).select("id", "same", "fp", "root", "component")


def near_duplicates(docs: DataFrame, id_col="doc_id", text="text", radius: int = RADIUS) -> DataFrame:
    """(id, same, fp, component): every row of docs with a hash of its text, its fingerprint and the smallest id of its component."""
    return _rooted(docs, id_col, text, radius).select(F.col("id").alias(id_col), "same", "fp", "component")


def as_hex(fp):
    """A fingerprint column as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_least(docs: DataFrame, found: DataFrame, id_col: str, text: str) -> DataFrame:
    """docs with one document of each root of found (id, same, root).

    Which ones stay is decided on ids and hashes; the texts meet the decision in one join.
    Components are told apart by their roots, as unrelated texts may share an id or have none.
    """
    found = checkpoint(found)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "same")).alias("x"))
    first = first.select(F.col("x.id").alias("__id"), F.col("x.same").alias("__same"))
    # the documents that go are told to the texts, as they are the fewer ones
    gone = checkpoint(found.select(F.col("id").alias("__of"), F.col("same").alias("__as")).distinct().join(
        first, F.col("__of").eqNullSafe(F.col("__id")) & (F.col("__as") == F.col("__same")), "left_anti"))
    whole = F.col(f"`{text}`")
    on = F.col(f"`{id_col}`").eqNullSafe(F.col("__of")) & (F.xxhash64(whole) == F.col("__as"))
    kept = docs.join(broadcast_if_small(gone, gone.count(), BROADCAST_GONE), on, "left_anti")
    repeated = not found.groupBy("id", "same").count().where("count > 1").isEmpty()
    return kept.dropDuplicates([id_col, text]) if repeated else kept


def keep_one(docs: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """docs with one document of each component: that with the smallest id, of equal ids that with the smallest text hash."""
    return keep_least(docs, _rooted(docs, id_col, text), id_col, text)
