"""Similarity join on word shingles: partitioned universe, one-deletion neighbourhoods, exact verification.

A document is the set of its distinct five-word shingles. Two sets of sizes a and b are similar only if they
differ in at most H = (a + b) * (1 - t) / (1 + t) shingles. Shingles are hashed into the segments of a size
band; each difference spoils at most one segment, so of the segments that a set fills, all but H are filled
equally by a similar set. A signature is the hash of the shingles that a set has in one segment. The allocation
decides, per set, which signatures to index, until their credit exceeds H:

- A count sketch over all documents tells which shingles are frequent. Signatures made of frequent shingles
  alone are expensive: their lists are long. The others are taken first, larger subsets before smaller ones.
  This order depends on the signature only, so two sets that share signatures take the first shared one both.
- A set with too few inexpensive signatures takes all of them, and the one-deletion neighbourhoods of the
  segments with at least two rare shingles, each of which earns a second credit.
- A set whose credit is still too small takes expensive signatures too, up to H + 1, and a set that fills
  fewer than H + 1 segments takes its shingles themselves. No pair is lost, whatever the frequencies.

Sets with equal signatures are candidates. Short lists are paired off. Groups of similar sets are not expanded
into all pairs: every set is first compared with the one it shares most lists with, in long lists with the
list's hub only, and verified links are contracted into components. After that, pairs of short lists that
are not in one component are verified, and long lists are treated the same way until all pairs of sets that
share a list but not a component are few enough to be verified one by one. Where they are not, the sets outside a
list's largest component are held against the texts of all open lists, block by block. Equal sets are one node from the
start. Shingles, sets and signatures are 64-bit hashes; texts are compared by their full sets of shingles.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.llm.common import LOWER, UPPER, gathered, ship, store, veiled
from souklake.llm.components import Forest, connected_components

SHINGLE = 5
THRESHOLD = (75, 100)
# Segments per band, as a share of the band's largest size.
SEGMENT_SHARE = 0.6
# Sets index more signatures than they must, one per so many shingles and MOST_SPARE at most; each is one more
# that similar sets are known to share, and rules out pairs that share fewer.
SIZE_PER_SPARE, MOST_SPARE = 16, 16
# Counters of the sketch; a shingle is frequent when its counter reaches this share of the documents.
SKETCH_BITS = 19
SKETCH_BLOCKS = 32
FREQUENT_SHARE, FREQUENT_LEAST = 0.004, 32
# Bytes of signatures that one task of the index sorts at once.
PART_BYTES = 32 << 20
# Entries that a task collects before it hands them on.
FLUSH_ENTRIES = 1_000_000
# A list of up to so many sets is paired off at once; in a batch, one of more than BATCH_LIST counts as long.
SHORT_LIST, BATCH_LIST = 32, 64
# Star rounds over the long lists go on while all their open pairs are more than this many per row of theirs,
# as long as a round still links at least so large a share of the sets that it compares.
OPEN_PAIRS, FRUITFUL, MAX_ROUNDS = 16, 0.05, 6
# Open pairs are scanned for instead, in blocks of so many sets, where they outnumber the scanned rows so many times.
BLOCK_SETS, PAIRS_PER_SCAN = 500, 32
# Candidates, or pairs of them, up to this many (some 64 bytes each) find their texts by a broadcast, more by a shuffle.
BROADCAST_NODES = 500_000
# Bytes of a pair of nodes, of a pair with both profiles, and of one with both texts: how many pairs a task gets.
PAIR_BYTES, PROFILED_BYTES, TEXTS_BYTES = 16, 1 << 10, 16 << 10

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_U = np.uint64
_K = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; of all its words, if there are fewer than ``size``."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(word) for word in words), dtype=np.uint64, count=len(words))
    n = min(size, len(words))
    rolled = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        rolled = rolled * _K + hashes[k : len(words) - n + 1 + k]
    return np.unique(_mix(rolled))


def node_of(items: np.ndarray) -> int:
    """One number per set, signed as Spark's long."""
    number = xxhash.xxh3_64_intdigest(items.tobytes())
    return number - (1 << 64) if number >> 63 else number


class Allocation:
    """Which signatures of a set are indexed; the same for all tasks of a run."""

    def __init__(self, threshold: tuple[int, int], frequent: bytes):
        self.num, self.den = threshold
        self.frequent = np.unpackbits(np.frombuffer(frequent, dtype=np.uint8)).astype(bool)

    def largest_partner(self, n: int) -> int:
        return n * self.den // self.num

    def differences(self, a: int, b: int) -> int:
        """The most shingles by which similar sets of these sizes differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def bands(self, n: int) -> range:
        """A set is indexed in its own band, and in those of larger sets that it may be similar to."""
        return range(n.bit_length() - 1, self.largest_partner(n).bit_length())

    def signatures(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures, and for each how many of them a similar set must share."""
        rare = ~self.frequent[items & _U((1 << SKETCH_BITS) - 1)]
        values = _mix(items + _K)
        found = [self._in_band(items, rare, values, band) for band in self.bands(len(items))]
        return np.concatenate([sigs for sigs, _ in found]), np.repeat([s for _, s in found], [len(x) for x, _ in found])

    def _in_band(self, items: np.ndarray, rare: np.ndarray, values: np.ndarray, band: int) -> tuple[np.ndarray, int]:
        n, top = len(items), (2 << band) - 1
        need = self.differences(n, min(self.largest_partner(n), top)) + 1
        segments = max(1, int(SEGMENT_SHARE * (top + 1)))
        place = ((items >> _U(32)) * _U(segments)) >> _U(32)
        # Items are sorted by hash, so the segments come in order.
        start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        size = np.diff(np.append(start, n))
        n_rare = np.add.reduceat(rare, start, dtype=np.int64)
        total = np.add.reduceat(values, start)
        salt = place[start] * _U(0xD6E8FEB86659FD93) + _U(band + 1)
        whole = _mix(total + salt)
        cheap = n_rare > 0
        order = np.lexsort((whole, -size, ~cheap))
        # With s signatures beyond H, two sets share at least the smaller of their s.
        spare = min(1 + n // SIZE_PER_SPARE, MOST_SPARE, int(cheap.sum()) - need + 1)
        if spare >= 1:
            return whole[order[: need - 1 + spare]], spare
        taken = [whole[cheap]]
        rich = np.repeat(n_rare > 1, size)
        of = np.repeat(np.arange(len(start)), size)[rich]
        taken.append(_mix(total[of] - values[rich] + salt[of]))
        if np.minimum(n_rare, 2).sum() < need:
            taken.append(whole[order[:need]])
            if len(start) < need:
                single = np.lexsort((values, ~rare))[:need]
                taken.append(_mix(values[single] ^ _U(0xA0761D6478BD642F * (band + 1) % (1 << 64))))
        return np.unique(np.concatenate(taken)), 1


def _describe(size: int):
    """Per row its node and number of shingles; per partition a sketch of how many sets have each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
                            ("block", pa.int32()), ("counts", pa.binary())])
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        mask = _U((1 << SKETCH_BITS) - 1)

        def rows(doc, node, n, block, data) -> pa.RecordBatch:
            columns = (doc, node, n, block, data)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            nodes, sizes, seen, waiting = [], [], [], 0
            for body in batch.column(1):
                items = shingles(body.as_py(), size)
                nodes.append(node_of(items) if len(items) else None)
                sizes.append(len(items))
                seen.append(items & mask)
                waiting += len(items)
                if waiting >= FLUSH_ENTRIES:
                    counts += np.bincount(np.concatenate(seen).astype(np.int64), minlength=len(counts)).astype(np.uint32)
                    seen, waiting = [], 0
            if waiting:
                counts += np.bincount(np.concatenate(seen).astype(np.int64), minlength=len(counts)).astype(np.uint32)
            none = [None] * len(nodes)
            yield rows(batch.column(0), nodes, sizes, none, none)
        if counts.any():
            parts = [zlib.compress(part.tobytes(), 1) for part in np.split(counts, SKETCH_BLOCKS)]
            none = [None] * SKETCH_BLOCKS
            yield rows(none, none, none, range(SKETCH_BLOCKS), parts)

    return run


def _add_sketches(least: int):
    """Sum the sketches of a block as they stream by; keep one bit per counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = np.frombuffer(zlib.decompress(data.as_py()), dtype=np.uint32).astype(np.int64)
                sums[block] = sums[block] + counts if block in sums else counts
        bits = [np.packbits(one >= least).tobytes() for one in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], ["block", "bits"])

    return run


def _frequent(described: DataFrame, n_docs: int) -> bytes:
    """One bit per counter of the sketch: a fixed size, whatever the number of documents."""
    least = max(FREQUENT_LEAST, int(FREQUENT_SHARE * n_docs))
    blocks = (
        described.where("block is not null")
        .select("block", "counts")
        .repartition(SKETCH_BLOCKS, "block")
        .mapInArrow(_add_sketches(least), "block int, bits binary")
        .collect()
    )
    bits = {row["block"]: bytes(row["bits"]) for row in blocks}
    empty = bytes((1 << SKETCH_BITS) // SKETCH_BLOCKS // 8)
    return b"".join(bits.get(block, empty) for block in range(SKETCH_BLOCKS))


_BLOB = "part int, kind int, sigs binary, nodes binary, sizes binary"
_FOUND = "sig long, u long, v long, n int, need int"
# A row's size and the number of lists that a similar set must share, in one number.
_NEED = 40
# Rows of signatures; one row of each signature that is crowded in a batch; the rows of those signatures.
PLAIN, CROWDED, MEMBER = 0, 1, 2


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of a sorted array."""
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, int)
    return start, np.diff(np.append(start, len(values)))


def _index(threshold: tuple[int, int], frequent: bytes, parts: int, size: int):
    """Packed signature rows by part. A signature that many sets of a batch have is known to be crowded there:
    its rows go anywhere, and one of them tells its own part, which stays small that way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allocation = Allocation(threshold, frequent)
        schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("sigs", pa.binary()),
                            ("nodes", pa.binary()), ("sizes", pa.binary())])

        def packed(found: list[tuple[np.ndarray, int, np.ndarray]]) -> pa.RecordBatch:
            lengths = [len(sigs) for sigs, _, _ in found]
            sigs = np.concatenate([sigs for sigs, _, _ in found])
            nodes = np.repeat(np.array([node for _, node, _ in found], dtype=np.int64), lengths)
            sizes = np.concatenate([told for _, _, told in found])
            order = np.argsort(sigs, kind="stable")
            start, count = _runs(sigs[order])
            many = np.repeat(count > BATCH_LIST, count)
            first = order[start[count > BATCH_LIST]]
            out = []
            for kind, rows in ((PLAIN, order[~many]), (CROWDED, first), (MEMBER, order[many])):
                rows = np.sort(rows)  # rows of a node stay together and pack well
                part = ((sigs if kind != MEMBER else nodes.view(np.uint64))[rows] % _U(parts)).astype(np.int32)
                by_part = np.argsort(part, kind="stable")
                rows, part = rows[by_part], part[by_part]
                for at, n in zip(*_runs(part)):
                    own = rows[at : at + n]
                    out.append((int(part[at]), kind, sigs[own].tobytes(), nodes[own].tobytes(), sizes[own].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        found, seen, waiting = [], set(), 0
        for batch in batches:
            for body in batch.column(0):
                items = shingles(body.as_py(), size)
                if not len(items):
                    continue
                node = node_of(items)
                if node in seen:
                    continue
                seen.add(node)
                sigs, need = allocation.signatures(items)
                found.append((sigs, node, (need.astype(np.int64) << _NEED) + len(items)))
                waiting += len(sigs)
                if waiting >= FLUSH_ENTRIES:
                    yield packed(found)
                    found, seen, waiting = [], set(), 0
        if found:
            yield packed(found)

    return run


def _join_part(threshold: tuple[int, int]):
    """Of one part: pairs of sets (u, v) with the number n of short lists they share and the number they need, and
    members (sig, u) of size n of the lists that are too long to be paired off at once."""
    num, den = threshold

    def run(table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind").to_pylist())

        def rows_of(*wanted: int) -> tuple[np.ndarray, ...]:
            types = {"sigs": np.uint64, "nodes": np.int64, "sizes": np.int64}
            pick = np.flatnonzero(np.isin(kinds, wanted))
            return tuple(
                np.concatenate([np.frombuffer(table.column(c)[int(i)].as_py(), dtype=t) for i in pick])
                if len(pick) else np.empty(0, dtype=t)
                for c, t in types.items()
            )

        sigs, nodes, sizes = rows_of(PLAIN, CROWDED)
        told = np.unique(rows_of(CROWDED)[0])
        order = np.lexsort((nodes, sigs))
        sigs, nodes, sizes = sigs[order], nodes[order], sizes[order]
        fresh = np.ones(len(sigs), dtype=bool)
        fresh[1:] = (sigs[1:] != sigs[:-1]) | (nodes[1:] != nodes[:-1])
        sigs, nodes, sizes = sigs[fresh], nodes[fresh], sizes[fresh]
        start, count = _runs(sigs)
        long_ = (count > SHORT_LIST) | np.isin(sigs[start], told)
        member = np.repeat(long_, count)
        live = rows_of(MEMBER)
        live = tuple(np.concatenate((a[member], b)) for a, b in zip((sigs, nodes, sizes), live))

        needs, sizes = sizes >> _NEED, sizes & ((1 << _NEED) - 1)
        pairs_u, pairs_v, pairs_need = [], [], []
        for k in range(2, SHORT_LIST + 1):
            lists = start[(count == k) & ~long_]
            for i in range(k if len(lists) else 0):
                for j in range(i + 1, k):
                    a, b = lists + i, lists + j
                    small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
                    fit = small * den >= large * num
                    pairs_u.append(nodes[a[fit]])
                    pairs_v.append(nodes[b[fit]])
                    pairs_need.append(np.minimum(needs[a[fit]], needs[b[fit]]))
        none = [np.empty(0, dtype=np.int64)]
        # Nodes are sorted within a list, so u < v; the smallest need of a pair comes first.
        u, v, need = (np.concatenate(x or none) for x in (pairs_u, pairs_v, pairs_need))
        order = np.lexsort((need, v, u))
        u, v, need = u[order], v[order], need[order]
        new = np.ones(len(u), dtype=bool)
        new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
        at = np.flatnonzero(new)
        votes = np.diff(np.append(at, len(u)))
        schema = pa.schema([("sig", pa.int64()), ("u", pa.int64()), ("v", pa.int64()), ("n", pa.int32()),
                            ("need", pa.int32())])
        lone, paired = len(live[0]), len(at)
        columns = [
            pa.concat_arrays([pa.array(live[0].view(np.int64)), pa.nulls(paired, pa.int64())]),
            pa.array(np.concatenate((live[1], u[at]))),
            pa.concat_arrays([pa.nulls(lone, pa.int64()), pa.array(v[at])]),
            pa.array(np.concatenate((live[2] & ((1 << _NEED) - 1), votes)).astype(np.int32)),
            pa.array(np.concatenate((live[2] >> _NEED, need[at])).astype(np.int32)),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _compare(threshold: tuple[int, int], size: int):
    """The pairs (u, v) whose texts are similar. Texts are shingled once for all pairs of a batch."""
    num, den = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, texts_u, texts_v = (column for column in batch.columns)
            sets: dict[int, np.ndarray] = {}
            similar = []
            for i, (a, b) in enumerate(zip(u.to_pylist(), v.to_pylist())):
                for node, texts in ((a, texts_u), (b, texts_v)):
                    if node not in sets:
                        sets[node] = shingles(texts[i].as_py(), size)
                x, y = sets[a], sets[b]
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if common * den >= (len(x) + len(y) - common) * num:
                    similar.append(i)
            rows = pa.array(similar, pa.int64())
            yield pa.RecordBatch.from_arrays([u.take(rows), v.take(rows)], ["u", "v"])

    return run


def profile(items: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of a power of two of buckets, some three per bucket; 255 at most.

    The profiles of two sets differ by no more than the sets do, so they rule pairs out without the texts.
    """
    buckets = 1 << max(3, len(items).bit_length() - 2)
    counts = np.bincount((items & _U(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8)


def profile_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Total difference, after folding the longer profile onto the shorter one."""
    n = min(len(a), len(b))
    a, b = (x.reshape(-1, n).sum(axis=0, dtype=np.int64) for x in (a, b))
    return int(np.abs(a - b).sum())


def _profiles(size: int):
    """node, text, n, counts for rows (node, text) whose text gives that node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sizes, counts = [], [], []
            for i, (node, body) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                items = shingles(body.as_py(), size)
                if len(items) and node_of(items) == node:
                    keep.append(i)
                    sizes.append(len(items))
                    counts.append(profile(items).tobytes())
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(sizes, pa.int64()),
                 pa.array(counts, pa.binary())],
                ["node", "text", "n", "counts"],
            )

    return run


def _close(threshold: tuple[int, int]):
    """The pairs (u, v) that their sizes and profiles do not rule out."""
    allocation = Allocation(threshold, b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, sizes_u, sizes_v, counts_u, counts_v = batch.columns
            close = [
                i
                for i, (m, n) in enumerate(zip(sizes_u.to_pylist(), sizes_v.to_pylist()))
                if profile_distance(
                    *(np.frombuffer(c[i].as_py(), dtype=np.uint8) for c in (counts_u, counts_v))
                ) <= allocation.differences(m, n)
            ]
            rows = pa.array(close, pa.int64())
            yield pa.RecordBatch.from_arrays([u.take(rows), v.take(rows)], ["u", "v"])

    return run


def _verify(pairs: DataFrame, texts: DataFrame, threshold: tuple[int, int], size: int) -> DataFrame:
    """The pairs (u, v) that are similar, by the shingles of their texts; texts travel only for close pairs."""

    def side(node: str, *columns: str) -> DataFrame:
        return texts.select(F.col("node").alias(node), *(F.col(c).alias(f"{node}_{c}") for c in columns))

    told = pairs.join(side("u", "n", "counts"), "u").join(side("v", "n", "counts"), "v")
    told = gathered(told.select("u", "v", "u_n", "v_n", "u_counts", "v_counts"), pairs.count() * PROFILED_BYTES)
    close = store(told.mapInArrow(_close(threshold), "u long, v long"), "jaccard-close")
    n_close, first, second = close.count(), close, side("v", "text")
    if n_close <= BROADCAST_NODES:
        # Only texts of these pairs enter the shuffle, not those of all candidates in every round.
        first, second = F.broadcast(close), second.join(F.broadcast(close.select("v").distinct()), "v", "left_semi")
    both = first.join(side("u", "text"), "u").join(second, "v").select("u", "v", "u_text", "v_text")
    return gathered(both, n_close * TEXTS_BYTES).mapInArrow(_compare(threshold, size), "u long, v long")


def _texts(docs: DataFrame, info: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, text, n, counts for the given nodes, from one document each."""
    first = info.groupBy("node").agg(F.min("doc").alias("doc"))
    wanted = store(gathered(nodes.join(first, "node")), "jaccard-wanted")
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    # Rows that repeat an id with another text belong to another node and fall out here.
    found = docs.join(wanted, "doc").select("node", "text").mapInArrow(
        _profiles(size), "node long, text string, n long, counts binary"
    )
    if info.groupBy("doc").count().where("count > 1").limit(1).count():
        found = found.dropDuplicates(["node"])
    return store(found, "jaccard-texts")


def _scan(threshold: tuple[int, int], size: int, block: list[tuple[int, int, np.ndarray]]):
    """Links (u, v) between the sets (node, component, shingles) of a block and every text (node, component, text)
    that streams by, by counting common shingles. A task hands on a link only where it ties components that
    were apart so far, so it makes fewer rows than it has met components, however many pairs are linked."""
    num, den = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        names = np.array([node for node, _, _ in block], dtype=np.int64)
        groups = np.array([component for _, component, _ in block], dtype=np.int64)
        sizes = np.array([len(items) for _, _, items in block], dtype=np.int64)
        tokens = np.concatenate([items for _, _, items in block])
        order = np.argsort(tokens, kind="stable")
        owners, tokens = np.repeat(np.arange(len(block)), sizes)[order], tokens[order]
        for batch in batches:
            u, v = [], []
            for node, group, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                items = shingles(body.as_py(), size)
                first, last = np.searchsorted(tokens, items, "left"), np.searchsorted(tokens, items, "right")
                met = last > first
                first, count = first[met], (last - first)[met]
                places = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                common = np.bincount(owners[places], minlength=len(block))
                similar = np.flatnonzero((common * den >= (len(items) + sizes - common) * num) & (names != node))
                met_groups, one_of = np.unique(groups[similar], return_index=True)
                for other, place in zip(met_groups.tolist(), similar[one_of].tolist()):
                    if forest.tie(group, other):
                        u.append(min(node, int(names[place])))
                        v.append(max(node, int(names[place])))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _block_links(members: DataFrame, stragglers: DataFrame, texts: DataFrame, n: int, threshold, size: int) -> DataFrame:
    """Links of the straggling sets to all sets of open lists: block after block of the stragglers, each held by
    the driver for one pass over the others' texts. Sets bring the component
    they are in, and only links that tie components become rows."""
    blocks = -(-n // BLOCK_SETS)
    queries = store(
        stragglers.join(texts, "node").select("node", "c", "text", F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("block")),
        "jaccard-stragglers",
    )
    others = members.select("node", "c").distinct().join(texts, "node").select("node", "c", "text")
    others = store(gathered(others), "jaccard-others")
    links = None
    # Two tasks may hand on the same link; few do, and an exchange for each block costs more than they do.
    for block in range(blocks):
        rows = queries.where(F.col("block") == block).select("node", "c", "text").collect()
        if rows:
            held = [(row["node"], row["c"], shingles(row["text"], size)) for row in rows]
            found = store(others.mapInArrow(_scan(threshold, size, held), "u long, v long"), "jaccard-links")
            links = found if links is None else links.union(found)
    return links


def _name(frame: DataFrame, node: str, name: str, components: DataFrame) -> DataFrame:
    """``frame`` with the component of a node, which is the node itself where it has no links."""
    known = components.select(F.col("node").alias(node), F.col("component").alias(name))
    return frame.join(known, node, "left").withColumn(name, F.coalesce(name, node))


def similar_nodes(
    docs: DataFrame, described: DataFrame, n_docs: int, threshold=THRESHOLD, size: int = SHINGLE
) -> DataFrame:
    """node, component for all nodes that are linked to another. ``docs`` has doc and text, ``described``
    what ``_describe`` found out about them."""
    num, den = threshold
    spark = docs.sparkSession
    info = described.where("node is not null").select("doc", "node", "n")
    entries = info.agg(F.sum("n")).first()[0] or 0
    # Some 20 bytes for each of up to half as many signatures as shingles.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), entries * 10 // PART_BYTES + 1)
    found = store(
        docs.select("text")
        .mapInArrow(_index(threshold, _frequent(described, n_docs), parts, size), _BLOB)
        .groupBy("part")
        .applyInArrow(_join_part(threshold), _FOUND),
        "jaccard-found",
    )
    summed = found.where("v is not null").groupBy("u", "v").agg(F.sum("n").alias("votes"), F.min("need").alias("need"))
    votes = store(gathered(summed), "jaccard-votes")
    # A pair that also shares a long list is looked at there, so here the lists it shares are all it has.
    pairs = votes.where("votes >= need")
    listed = found.where("sig is not null").select("sig", F.col("u").alias("node"), "n", "need").distinct()
    live = store(gathered(listed), "jaccard-live")
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).union(live.select("node")).distinct()
    texts = _texts(docs, info, nodes, size)

    def fits(a: str, b: str):
        return F.least(a, b).cast("long") * den >= F.greatest(a, b).cast("long") * num

    def stars(members: DataFrame, round_: int) -> DataFrame:
        """node, partner, votes: every member with the hub of its list, the first in this round's order."""
        rank = F.xxhash64(F.lit(round_), "node").alias("r")
        hubs = members.groupBy("sig").agg(F.min(F.struct(rank, "node", "n", "c")).alias("hub"))
        met = members.join(hubs, "sig").where((F.col("c") != F.col("hub.c")) & fits("n", "hub.n"))
        return met.groupBy("node", F.col("hub.node").alias("partner")).agg(F.count("*").alias("votes"))

    def best(votes: DataFrame) -> DataFrame:
        """Per node the pair with the partner it shares most lists with."""
        summed = votes.groupBy("node", "partner").agg(F.sum("votes").alias("votes"))
        one = summed.groupBy("node").agg(F.max(F.struct("votes", "partner"))["partner"].alias("partner"))
        return one.select(F.least("node", "partner").alias("u"), F.greatest("node", "partner").alias("v"))

    both_ways = pairs.select(F.col("u").alias("node"), F.col("v").alias("partner"), "votes").union(
        pairs.select("v", "u", "votes")
    )
    todo = best(both_ways.union(stars(live.withColumn("c", F.col("node")), 0)))
    tried = store(gathered(todo.distinct()), "jaccard-tried")
    first = store(_verify(tried, texts, threshold, size), "jaccard-links")
    components = store(gathered(connected_components(first)), "jaccard-components")

    rest, round_, done, fruitful = pairs.select("u", "v"), 0, False, True
    while not done:
        round_ += 1
        named = _name(live, "node", "c", components)
        sizes = named.groupBy("sig", "c").agg(F.count("*").alias("k")).groupBy("sig").agg(
            F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"), F.count("*").alias("n_c")
        )
        open_ = sizes.where("n_c > 1").select("sig", ((F.col("k") * F.col("k") - F.col("kk")) / 2).alias("pairs"))
        members = store(gathered(named.join(open_, "sig")), "jaccard-open")
        total = members.groupBy("sig").agg(F.count("*").alias("k"), F.first("pairs").alias("p")).agg(
            F.sum("k").alias("k"), F.sum("p").alias("p")
        ).first()
        done = not total["k"] or total["p"] <= OPEN_PAIRS * total["k"] or round_ > MAX_ROUNDS or not fruitful
        scanned = None
        if done and total["k"]:
            # Of any two components in a list, one is not the list's largest: its sets straggle.
            largest = members.groupBy("sig", "c").agg(F.count("*").alias("k")).groupBy("sig").agg(
                F.max(F.struct("k", "c")).alias("largest")
            )
            stragglers = members.join(largest, "sig").where(F.col("c") != F.col("largest.c")).select("node", "c").distinct()
            stragglers = store(gathered(stragglers), "jaccard-stragglers")
            n_open, n_stragglers = members.select("node").distinct().count(), stragglers.count()
            if total["p"] > PAIRS_PER_SCAN * n_open * -(-n_stragglers // BLOCK_SETS):
                scanned = _block_links(members, stragglers, texts, n_stragglers, threshold, size)
        if not total["k"] or scanned is not None:
            todo = None
        elif done:
            a, b = (
                members.select("sig", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "c", "need")))
                for side in "ab"
            )
            crossed = a.join(b, "sig").where((F.col("c_a") < F.col("c_b")) & fits("n_a", "n_b"))
            shared = crossed.groupBy(
                F.least("node_a", "node_b").alias("u"), F.greatest("node_a", "node_b").alias("v")
            ).agg(F.count("*").alias("long"), F.min(F.least("need_a", "need_b")).alias("needed"))
            enough = F.col("long") + F.coalesce("votes", F.lit(0)) >= F.least("needed", "need")
            todo = shared.join(votes, ["u", "v"], "left").where(enough).select("u", "v")
        else:
            todo = best(stars(members, round_))
        if rest is not None:
            # Pairs of short lists: all that are still open, once.
            crossed = _name(_name(rest, "u", "cu", components), "v", "cv", components).where("cu <> cv")
            todo = crossed.select("u", "v") if todo is None else todo.union(crossed.select("u", "v"))
            rest = None
        if todo is None and scanned is None:
            break
        new = scanned
        if todo is not None:
            todo = todo.distinct().join(tried, ["u", "v"], "left_anti")
            # A round has no more pairs than the tables it is made from have rows, the last turn as many as are open.
            open_bytes = int(total["p"] or 0) * PAIR_BYTES if done else 0
            todo = store(gathered(todo, open_bytes), "jaccard-tried")
            tried = tried.union(todo)
            new = store(_verify(todo, texts, threshold, size), "jaccard-links")
            new = new if scanned is None else new.union(scanned)
        n_new = new.count()
        fruitful = done or n_new >= FRUITFUL * todo.count()
        if n_new:
            # Components so far are stars; new links join them.
            known = components.select(F.col("node").alias("u"), F.col("component").alias("v"))
            components = store(gathered(connected_components(known.union(new))), "jaccard-components")
    return components


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD,
    size: int = SHINGLE,
) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, the document itself included. Documents
    without words link with nothing, not even with each other. Documents without an id cannot be named: they
    link with nothing and have a null component. Repeated rows each get the result of their text and id; an id
    that is repeated with other texts belongs to the components of all of them, and each row names its own.
    An empty table gives no rows; other columns are ignored.
    """
    ship(docs.sparkSession)
    named = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    described = store(
        named.mapInArrow(_describe(size), "doc long, node long, n long, block int, counts binary"), "jaccard-sizes"
    )
    info = described.where("block is null").select("doc", "node", "n")
    n_docs = info.count()
    linkable = described.where("block is not null or doc is not null")
    components = similar_nodes(named.where("doc is not null"), linkable, n_docs, threshold, size)

    nodes = info.where("doc is not null and node is not null").groupBy("node").agg(F.min("doc").alias("least"))
    labelled = nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = labelled.join(least, "component").select("node", "component_id")
    # Rows without a node are not matched; those without an id stay unnamed.
    return info.join(answer, "node", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc")).alias("component_id"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, and of rows that repeat it one.

    Documents without words or without an id stay.
    """
    given, name = veiled(docs)
    key, body = name[doc_id], name[text]
    answer = near_duplicates(given, key, body, **settings)
    gone = answer.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = given.join(gone, F.col(key).cast("long") == F.col("doc_id"), "left_anti")
    # Only rows that share their id need to be told apart; the others are never numbered or written.
    ids = answer.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    repeated = store(ids.where("n_rows > 1").select("doc_id"), "jaccard-repeated")
    if repeated.limit(1).count():
        same = F.col(key).cast("long") == F.col("doc_id")
        several = store(
            kept.join(repeated, same, "left_semi").withColumn("_row", F.monotonically_increasing_id()), "jaccard-several"
        )
        has_words = F.coalesce(F.col(body).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        first = several.where(has_words).groupBy(key).agg(F.min("_row").alias("_row")).select("_row")
        stay = several.where(has_words).join(first, "_row", "left_semi").unionByName(several.where(~has_words))
        kept = kept.join(repeated, same, "left_anti").unionByName(stay.drop("_row"))
    return kept.select(*(F.col(name[c]).alias(c) for c in docs.columns))
