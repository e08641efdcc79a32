"""Near copies by the Jaccard similarity of their five-word shingles.

Shingles. A text's A-Z are lower-cased and its runs of five words are hashed with XXH64 (seed 42)
into a set; texts with fewer words are one shingle, texts without words, and null, the empty set.
Texts with equal sets are grouped before anything else. Two sets are near if they share four
fifths or more of their union.

Candidates. Each set has the SimHash fingerprint of its hashes, and the BK-trees of simhash link
fingerprints that differ in three bits or fewer. Sets at 0.8 differ in about ten bits, which no tree
prunes, so BANDS x ROWS minimum hashes make BANDS keys a set besides. Sets that share a key or are linked
are joined into clusters by star steps (see graph). Sets of similarity s share no key with a chance of
(1 - s^ROWS)^BANDS, that is one in 20,000 at 0.8 and less above; those of them that no fingerprint
links are the only loss.

Confirmation. Within a cluster of up to ``PIECE`` sets every pair is compared exactly. A larger one is
cut into pieces, and each piece is compared with ``ANCHORS`` sets of the cluster first. In a group
of near copies nearly all sets are near to one of them, so after work in proportion to the group
most of it hangs together. Only the sets that do not belong to the cluster's largest part by then
are compared with all others, a piece of them with a piece of the cluster at a time. So no link is
lost, no cluster meets in one task, and pairs within the largest part are not looked at. The confirmed
links, of which a spanning forest a task group is kept, give the components.

Texts are read whole, however long, some thousands of shingles at a time. Null ids and repeated rows
are told apart by a hash of the text only. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint, join_named, partitions
from .graph import components
from .simhash import BITS, _Forest, keep_least, near_links

SHINGLE, SEED = 5, 42
BANDS, ROWS = 25, 5
#: Sets are near if NEAR[1] * shared >= NEAR[0] * union.
NEAR = (4, 5)
#: Sets of one piece of a cluster.
PIECE = 256
#: Sets that all pieces of a larger cluster are compared with first.
ANCHORS = 16
#: Sets to compare are broadcast to their texts up to so many rows of about 40 bytes, and joined by a shuffle beyond.
BROADCAST_SETS = 200_000
_CHUNK = 4096
_RANDOM = np.random.Generator(np.random.PCG64(20))
_TIMES = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_JOIN = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return np.unique(np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])), np.uint64))


def band_keys(tokens: np.ndarray) -> np.ndarray:
    """The BANDS keys of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), _CHUNK):
        np.minimum(least, (tokens[at : at + _CHUNK, None] * _TIMES + _PLUS).min(axis=0), out=least)
    return (least.reshape(BANDS, ROWS) * _JOIN).sum(axis=1, dtype=np.uint64)


def set_fingerprint(tokens: np.ndarray) -> int:
    """The SimHash fingerprint of a set: a bit is 1 if it is set in more than half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(tokens), _CHUNK):
        part = np.ascontiguousarray(tokens[at : at + _CHUNK]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(tokens), bitorder="little").view(np.uint64)[0])


def _set_name(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes(), SEED)


def _keyed(batches):
    for batch in batches:
        names, prints, keys = [], [], []
        for text in batch.column("text").to_pylist():
            tokens = shingles(text)
            names.append(_set_name(tokens))
            prints.append(set_fingerprint(tokens))
            keys.append(band_keys(tokens).view(np.int64) if len(tokens) else np.zeros(0, np.int64))
        hashed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (names, prints)]
        columns = [batch.column("id"), batch.column("same"), *hashed, pa.array(keys, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "same", "fp", "sim", "keys"])


def _sets(batches):
    for batch in batches:
        sets = pa.array([shingles(x).tobytes() for x in batch.column("text").to_pylist()], pa.binary())
        kept = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], sets], names=[*kept, "tokens"])


def set_links(sets: list[np.ndarray], asked: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the near pairs of which one place at least is asked for."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[token] > 1
    token, owner = token[shared], owner[shared]
    order = np.argsort(token, kind="stable")
    posted = owner[order]
    first = np.searchsorted(token[order], np.arange(len(times)))
    bounds = np.searchsorted(owner, np.arange(len(sets) + 1))
    forest, links = _Forest(len(sets)), []
    for q in asked:
        own = token[bounds[q] : bounds[q + 1]]
        common = np.zeros(len(sets), np.int64)
        for at in range(0, len(own), _CHUNK):
            part = own[at : at + _CHUNK]
            n = times[part]
            places = np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            common += np.bincount(posted[places], minlength=len(sets))
        for t in np.nonzero((common > 0) & (NEAR[1] * common >= NEAR[0] * (sizes[q] + sizes - common)))[0]:
            if forest.join(q, int(t)):
                links.append((q, int(t)))
    return links


def _confirmed(batches):
    """Rows sorted by (root, low, high) to the links of their near pairs of which one at least is asked."""
    group, rows = None, []

    def links():
        if len(rows) < 2:
            return []
        found = set_links([np.frombuffer(r[2], np.uint64) for r in rows], [k for k, r in enumerate(rows) if r[0]])
        return [(rows[a][1], rows[b][1]) for a, b in found]

    def emit(found):
        a, b = (pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))
        return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    for batch in batches:
        found = []
        columns = [batch.column(n).to_pylist() for n in ("root", "low", "high", "asked", "fp", "tokens")]
        for root, low, high, *row in zip(*columns):
            if (root, low, high) != group:
                found += links()
                group, rows = (root, low, high), []
            rows.append(row)
        yield emit(found)
    yield emit(links())


def _links_of(units: DataFrame) -> DataFrame:
    dealt = units.repartition(partitions(units.sparkSession), "root", "low", "high").sortWithinPartitions("root", "low", "high")
    return dealt.mapInArrow(_confirmed, "a long, b long").where("a <> b").distinct()


def confirmed_links(made: DataFrame, piece: int = PIECE) -> DataFrame:
    """(a, b): links that connect all near sets of each cluster. made: (root, pieces, piece, fp, tokens)."""
    def units(rows, low, high, asked):
        return rows.select("root", low.alias("low"), high.alias("high"), F.lit(asked).alias("asked"), "fp", "tokens")

    zero, each = F.lit(0), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    whole = units(made.where("pieces = 1"), zero, zero, True)
    big = made.where("pieces > 1")
    slot = F.pmod(F.xxhash64("fp", F.lit("anchor")), F.lit(ANCHORS))
    chosen = checkpoint(big.groupBy("root", slot.alias("slot")).agg(F.min("fp").alias("fp")).select("fp"))
    n_chosen = chosen.count()
    first = checkpoint(_links_of(whole.unionByName(units(big, zero, F.col("piece"), False)).unionByName(
        units(big.join(broadcast_if_small(chosen, n_chosen, BROADCAST_SETS), "fp"), zero, each, True))))
    if not n_chosen:
        return first
    parts = big.select("root", "fp").join(components(first).withColumnRenamed("root", "part"), F.col("fp") == F.col("node"), "left")
    parts = checkpoint(parts.select(F.col("root").alias("of"), "fp", F.coalesce("part", "fp").alias("part")))
    sizes = parts.groupBy("of", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("of").agg(F.max_by("part", F.struct("n", "part")).alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"))
    largest = checkpoint(largest.where(F.col("all") > F.col("most")).select("of", "largest", F.ceil((F.col("all") - F.col("most")) / piece).cast("int").alias("rests")))
    n_open = largest.count()
    if not n_open:
        return first
    held = broadcast_if_small(largest, n_open, BROADCAST_SETS)
    rest = parts.join(held, "of").where(F.col("part") != F.col("largest")).select("fp", F.pmod(F.xxhash64("fp", F.lit("rest")), "rests").cast("int").alias("rest"))
    asked = big.join(broadcast_if_small(rest, rest.count(), BROADCAST_SETS), "fp")
    others_ = big.join(held.select(F.col("of").alias("root"), "rests"), "root")
    second = units(asked, F.col("rest"), each, True).unionByName(units(others_, F.explode(F.sequence(F.lit(0), F.col("rests") - 1)), F.col("piece"), False))
    return first.unionByName(_links_of(second))


def linked_sets(sims: DataFrame) -> DataFrame:
    """(a, b): links that connect all sets (fp) whose SimHash fingerprints (sim) are near by the trees of simhash."""
    least = checkpoint(sims.groupBy("sim").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("times")))
    n = least.count()
    equal = join_named(sims, least.where("times > 1"), ["sim"], sims.count()).select(F.col("fp").alias("a"), "b")
    links = near_links(least.select(F.col("sim").alias("fp")))
    for end in ("a", "b"):
        links = links.join(broadcast_if_small(least.select(F.col("sim").alias(end), F.col("b").alias(f"set_{end}")), n, BROADCAST_SETS), end)
    return equal.unionByName(links.select(F.col("set_a").alias("a"), F.col("set_b").alias("b")))


def near_components(docs: DataFrame, id_col="doc_id", text="text", piece: int = PIECE) -> DataFrame:
    """(id, same, root): every row of docs with a hash of its text and the set that names its component."""
    whole = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(whole).alias("same"), whole.alias("text"))
    schema = rows.select("id", "same", *[F.lit(0).cast("long").alias(c) for c in ("fp", "sim")], F.array().cast("array<long>").alias("keys")).schema
    prints = checkpoint(rows.mapInArrow(_keyed, schema))
    sets = checkpoint(prints.groupBy("fp").agg(F.first("sim").alias("sim"), F.first("keys").alias("keys"), F.min("same").alias("same"), F.count(F.lit(1)).alias("rows")))
    keyed = sets.select("fp", F.explode("keys").alias("key"))
    least = keyed.groupBy("key").agg(F.min("fp").alias("b"), F.max("fp").alias("most"), F.count(F.lit(1)).alias("times"))
    least = checkpoint(least.where("b <> most").select("key", "b", "times"))
    shared = join_named(keyed, least, ["key"], least.agg(F.sum("times")).first()[0] or 0)
    linked = linked_sets(sets.where(F.size("keys") > 0).select("fp", "sim"))
    clusters = checkpoint(components(shared.select(F.col("fp").alias("a"), "b").unionByName(linked))).select("root", F.col("node").alias("fp"))
    counted = checkpoint(clusters.groupBy("root").agg(F.count(F.lit(1)).alias("times"), F.ceil(F.count(F.lit(1)) / piece).cast("int").alias("pieces")))
    n_near = clusters.count()
    dealt = join_named(clusters, counted, ["root"], n_near).withColumn("piece", F.pmod(F.xxhash64("fp"), "pieces").cast("int"))
    named = sets.select("fp", "same", "rows")
    dealt = dealt.join(named.select("fp", F.col("same").alias("of")), "fp")
    asked = rows.select("same", "text")
    if n_near > BROADCAST_SETS:  # each text once, as very many rows may have one
        asked = asked.dropDuplicates(["same"])
    texts = asked.join(broadcast_if_small(dealt, n_near, BROADCAST_SETS), F.col("same") == F.col("of")).select("root", "pieces", "piece", "fp", "text")
    made = texts.mapInArrow(_sets, "root long, pieces int, piece int, fp long, tokens binary")
    made = made.groupBy("fp").agg(*[F.first(c).alias(c) for c in ("root", "pieces", "piece", "tokens")])
    roots = components(confirmed_links(checkpoint(made), piece))
    rooted = named.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), F.col("rows").alias("times"))
    return join_named(prints.select("id", "same", "fp"), checkpoint(rooted), ["fp"], prints.count()).select("id", "same", "root")


def keep_one(docs: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """docs with one document of each component: that with the smallest id, of equal ids that with the smallest text hash."""
    return keep_least(docs, near_components(docs, id_col, text), id_col, text)
