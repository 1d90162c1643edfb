"""SimHash near-dedup by bit-sliced comparison.

A fingerprint bit is 1 if it is set in over half of the shingles' XXH64 hashes. Fingerprints are compared inside buckets
of equal key bits: the bit planes of a bucket are stored vertically, so one machine word holds one bit of 64
fingerprints; differing bits of all of them at once go through carry-save adders into bitwise counters, and a block is
abandoned once every counter is over the radius. A bucket gives a spanning forest of its links, never all pairs.

`exact_masks` gives keys that lose no link: of the fingerprint cut into more blocks than the radius, any two within it
agree on enough whole blocks. The more fingerprints there are, the more blocks, so buckets stay small at any size.

The pipeline's near copies are defined by the exact similarity of shingle sets. Fingerprints of 64 bits can't tell all of
these, so `near_edges` checks what they link, and then searches what isn't joined by common rare shingles, which lose none.

Defined results. Null and wordless texts: fingerprint 0, linked like any other. Fewer words than a shingle: the whole
sequence is one. Equal texts share a fingerprint, and are one node from there on: a hot group of copies costs one row.
Repeated ids: each row gets its own fingerprint and component. Rows with a null id link like any others, but never name a
component (null, if there's no other). Empty tables give empty results. Very long texts are hashed in whole. Other
columns are not read by `near_components`, and kept as they are by `drop_near_copies`.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import as_bytes, bounded_batches, by_name, discard, fresh, materialize, scratch, table
from foliospark.llm.components import components

SEED = 42
RADIUS = 4
WIDTH = 4
#: Rows that are compared at a time, and rows of a bucket beyond which it is split into pairs of parts.
BLOCK = 512
PART = 4096

#: The pipeline's near-duplicates: shingles of five words, at least this Jaccard similarity of their sets.
NEAR_WIDTH = 5
NEAR_SIMILARITY = 0.8
#: Share of a set's shingles that two near copies must have in common among their least hashes.
NEAR_COMMON = 0.2
#: Keys that two near copies must have in common, if their sets are large enough for that.
NEAR_KEYS = 4
#: Nodes of a key up to which its pairs are counted one by one; nodes of more frequent keys are searched as groups.
PAIR_ROWS = 16
#: Rows and bytes of the sets of a group of candidates that are compared at a time.
GROUP_ROWS = 1024
GROUP_BYTES = 16 << 20


def shingle_hashes(text: bytes, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle, repeats included, as uint64. Words are runs of bytes other than \\x20 and \\x09-\\x0D."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(line, seed)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    return np.array([xxh64_intdigest(line[a:z], seed) for a, z in zip(starts, ends[width - 1 :].tolist(), strict=True)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _remix(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Another 64 bits of each hash: a splitmix64 step."""
    if not lane:
        return hashes
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(lane) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(text: Column, width: int = WIDTH, lanes: int = 1) -> Column:
    """array<long>: lanes words of 64 bits of a string column."""

    def scan(column: pa.Array) -> pa.Array:
        out = np.zeros((len(column), lanes), dtype=np.uint64)
        for k, data in enumerate(as_bytes(column)):
            h = shingle_hashes(data, width)
            out[k] = [majority(_remix(h, lane)) for lane in range(lanes)]
        flat = pa.array(out.view(np.int64).ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(column) * lanes + 1, lanes, dtype=np.int32)), flat)

    return F.arrow_udf(scan, "array<bigint>")(text)


def exact_masks(radius: int, rows: int, bits: int = 64) -> np.ndarray:
    """Key masks (tables, lanes): any two fingerprints within the radius agree on all bits of one mask at least.

    Of B blocks, radius of them at most differ, so B - radius agree: a table for each choice of these. B is the least
    for which buckets of evenly spread fingerprints stay below about 2048.
    """
    for blocks in range(radius + 1, radius + 5):
        if rows >> int(bits * (blocks - radius) / blocks) < 2048:
            break
    cuts = [round(bits * i / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in itertools.combinations(range(blocks), blocks - radius):
        own = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        masks.append([(own >> (64 * k)) & ((1 << 64) - 1) for k in range(bits // 64)])
    return np.array(masks, dtype=np.uint64)


def _keys(masks: np.ndarray):
    lanes = masks.shape[1]

    def keyed(batches):
        for batch in batches:
            own = np.asarray(batch.column(1).flatten()).view(np.uint64).reshape(-1, lanes)
            for t, mask in enumerate(masks):
                with np.errstate(over="ignore"):
                    key = np.full(len(own), np.uint64(t + 1) * np.uint64(0x9E3779B97F4A7C15), dtype=np.uint64)
                    for k in range(lanes):
                        key = _remix(key ^ (own[:, k] & mask[k]), k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), *[pa.array(own[:, k].view(np.int64).copy()) for k in range(lanes)]], names=["key", "id", *[f"l{k}" for k in range(lanes)]])

    return keyed


def _csa(a, b, c):
    """Carry-save adder: sum and carry of three planes."""
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def _over(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose bit-sliced count is above the radius."""
    over, even = np.zeros_like(counters[0]), np.full_like(counters[0], ~np.uint64(0))
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            even &= counters[k]
        else:
            over |= even & counters[k]
            even &= ~counters[k]
    return over


def within(planes: np.ndarray, queries: np.ndarray, radius: int, n: int) -> np.ndarray:
    """Bool (queries, n): which stored fingerprints lie within the radius of which query.

    planes: (bits, words) uint64, bit b of 64 stored fingerprints in each word; queries: (m, bits) of 0 and 1.
    """
    shape = (len(queries), planes.shape[1])
    spread = (np.uint64(0) - queries.astype(np.uint64)).T[:, :, None]
    width = max(4, int(radius).bit_length() + 1)
    ones, twos, fours = (np.zeros(shape, dtype=np.uint64) for _ in range(3))
    high = [np.zeros(shape, dtype=np.uint64) for _ in range(width - 3)]
    spilled = np.zeros(shape, dtype=np.uint64)
    for b in range(0, len(planes), 8):
        d = [planes[b + i][None, :] ^ spread[b + i] for i in range(8)]
        ones, t0 = _csa(ones, d[0], d[1])
        ones, t1 = _csa(ones, d[2], d[3])
        twos, f0 = _csa(twos, t0, t1)
        ones, t0 = _csa(ones, d[4], d[5])
        ones, t1 = _csa(ones, d[6], d[7])
        twos, f1 = _csa(twos, t0, t1)
        fours, carry = _csa(fours, f0, f1)
        for h in high:
            both = h & carry
            h ^= carry
            carry = both
        spilled |= carry
        if b + 8 < len(planes):
            far = spilled | _over([ones, twos, fours, *high], radius)
            if (far == ~np.uint64(0)).all():
                return np.zeros((len(queries), n), dtype=bool)
    far = spilled | _over([ones, twos, fours, *high], radius)
    return np.unpackbits((~far).view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)


def _planes(bits: np.ndarray) -> np.ndarray:
    n = len(bits)
    padded = np.zeros((bits.shape[1], -(-n // 64) * 64), dtype=np.uint8)
    padded[:, :n] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def links(prints: np.ndarray, keys: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest (row, row) of the links between rows of equal keys, closest first for each row."""
    n = len(prints)
    bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little")
    planes, label, out = _planes(bits), np.arange(n), []
    for at in range(0, n, BLOCK):
        near = within(planes, bits[at : at + BLOCK], radius, n)
        near &= keys[at : at + BLOCK, None] == keys[None, :]
        for i in np.flatnonzero(near.sum(axis=1) > 1).tolist():
            row = at + i
            met = np.flatnonzero(near[i])
            apart = label[met] != label[row]
            if not apart.any():
                continue
            order = np.argsort(np.bitwise_count(prints[met] ^ prints[row]).sum(axis=1), kind="stable")
            met = met[order][apart[order]]
            _, first = np.unique(label[met], return_index=True)
            out += [(row, int(j)) for j in met[first]]
            label[np.isin(label, label[met])] = label[row]
    return out


def _compare(lanes: int, radius: int, part: int):
    """Edges (a, b) of the buckets of sorted rows; rows of buckets above `part` come back as they are, to be split."""

    def compare(batches):
        held: list[np.ndarray] = []
        waiting = 0

        def work(rows: np.ndarray, keys: np.ndarray):
            """Whole buckets, taken together up to BLOCK rows."""
            cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))).tolist() + [len(keys)]
            edges, large, start = [], [], 0

            def flush(a: int, z: int) -> None:
                if z - a > 1:
                    edges.extend((i + a, j + a) for i, j in links(rows[a:z, 1:], keys[a:z], radius))

            for a, z in itertools.pairwise(cuts):
                if z - a > part:
                    flush(start, a)
                    large.append((a, z))
                    start = z
                elif z - start > BLOCK:
                    flush(start, a)
                    start = a
            flush(start, len(keys))
            ids = rows[:, 0].view(np.int64)
            if edges:
                e = np.array(edges)
                yield _edge_batch(ids[e[:, 0]], ids[e[:, 1]], None, None, lanes)
            for a, z in large:
                yield _edge_batch(ids[a:z], None, keys[a:z], rows[a:z, 1:], lanes)

        for batch in batches:
            keys = np.asarray(batch.column(0))
            rows = np.stack([np.asarray(batch.column(1 + k)).view(np.uint64) for k in range(lanes + 1)], axis=1)
            held.append((keys, rows))
            waiting += len(keys)
            if held[0][0][0] != keys[-1] and waiting > 4 * BLOCK:
                keys, rows = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                cut = int(np.searchsorted(keys, keys[-1], side="left"))
                yield from work(rows[:cut], keys[:cut])
                held, waiting = [(keys[cut:], rows[cut:])], len(keys) - cut
        if waiting:
            yield from work(np.concatenate([h[1] for h in held]), np.concatenate([h[0] for h in held]))

    return compare


def _edge_batch(a, b, key, prints, lanes):
    n = len(a)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(a), none if b is None else pa.array(b), none if key is None else pa.array(key), *[none if prints is None else pa.array(prints[:, k].view(np.int64).copy()) for k in range(lanes)]],
        names=["a", "b", "key", *[f"l{k}" for k in range(lanes)]])


def link_edges(nodes: DataFrame, masks: np.ndarray, radius: int, part: int = PART, tag: str = "links") -> DataFrame:
    """Edges (a, b) that join every two rows of nodes(id, prints array<long>) within the radius that share a key.

    Buckets above `part` rows are cut into parts, and every two parts meet in a task of their own. Rows of a bucket are
    compared in the order of their ids, so the edges are the same in every run.
    """
    lanes = masks.shape[1]
    kinds = ", ".join(f"l{k} long" for k in range(lanes))
    names = [f"l{k}" for k in range(lanes)]
    keyed = nodes.select("id", "prints").mapInArrow(_keys(masks), f"key long, id long, {kinds}")
    found = keyed.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_compare(lanes, radius, part), f"a long, b long, key long, {kinds}")
    found = materialize(found, tag)
    edges = found.where(F.col("b").isNotNull()).select("a", "b")
    large = found.where(F.col("b").isNull())
    sizes = large.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / (part // 2)).cast("int")
    dealt = large.join(sizes, "key").withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), F.col("a").alias("id"), *names)
    more = pairs.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_compare(lanes, radius, 1 << 40), f"a long, b long, key long, {kinds}")
    return edges.unionByName(more.select("a", "b"))


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """id, print (long), component: the smallest id reachable over links of at most radius differing bits; each row of docs.

    A vertex is a fingerprint, named by itself: rows of one fingerprint are one vertex, whatever their ids, and rows of one
    id may be several. A component gets its name, the smallest id of all its rows, once it is known.
    """
    bounded_batches(docs.sparkSession)
    with scratch() as keep:
        prints = keep(materialize(docs.select(by_name(docs, key).cast("long").alias("id"), fingerprint(by_name(docs, text), width)[0].alias("print")), "prints"))
        nodes = materialize(prints.groupBy("print").agg(F.min("id").alias("id")), "vertices")
        roots = components(link_edges(nodes.select(F.col("print").alias("id"), F.array("print").alias("prints")), exact_masks(radius, nodes.count()), radius))
        rooted = materialize(nodes.join(roots, nodes["print"] == roots["node"], "left").select("print", "id", F.coalesce("root", "print").alias("root")), "rooted")
        names = materialize(rooted.groupBy("root").agg(F.min("id").alias("component")), "names")
        # tables of their own, so that the joins have plain shuffles, and Spark can split a large component or fingerprint
        placed = keep(materialize(rooted.select("print", "root").join(names, "root").select("print", "component"), "placed"))
    return prints.join(placed, "print")


def similar_links(sets: list[np.ndarray], similarity: float, labels: list | None = None) -> list[tuple[int, int]]:
    """Links (row, row) that join all pairs of at least that Jaccard similarity, rows of a label being joined already.

    An inverted index gives a row's exact overlap with all others at once. Every row is looked at but those of the largest
    label, whose links the others find; the work ends when all rows are joined.
    """
    n, out = len(sets), []
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, token, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(n), sizes)[np.argsort(token, kind="stable")]
    starts, cuts = np.cumsum(counts) - counts, np.concatenate(([0], np.cumsum(sizes)))
    group = np.arange(n) if labels is None else np.unique(np.asarray(labels), return_inverse=True)[1]
    largest, left = int(np.argmax(np.bincount(group))), len(np.unique(group))
    for row in np.flatnonzero(group != largest).tolist():
        if left == 1:
            break
        own = token[cuts[row] : cuts[row + 1]]
        own = own[counts[own] > 1]
        many = counts[own]
        at = np.arange(many.sum()) + np.repeat(starts[own] - (np.cumsum(many) - many), many)
        both = np.bincount(holders[at], minlength=n)
        near = np.flatnonzero((group != group[row]) & (both / np.maximum(1, sizes + sizes[row] - both) >= similarity))
        met, first = np.unique(group[near], return_index=True)
        out += [(row, int(j)) for j in near[first]]
        if len(met):
            group[np.isin(group, met)] = group[row]
            left -= len(met)
    return out


def _check(similarity: float):
    """Edges (a, b) of the groups of sorted rows (key, node, label, set)."""

    def check(batches):
        nodes, labels, sets, last = [], [], [], None

        def edges():
            found = similar_links(sets, similarity, labels) if len(sets) > 1 else []
            return [nodes[i] for i, _ in found], [nodes[j] for _, j in found]

        for batch in batches:
            a, b = [], []
            own = batch.column(3)
            flat, ends = np.asarray(own.flatten()), np.cumsum(np.concatenate(([0], np.asarray(own.value_lengths()))))
            for k, (key, node, label) in enumerate(zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True)):
                if key != last:
                    for out, more in zip((a, b), edges(), strict=True):
                        out += more
                    nodes, labels, sets, last = [], [], [], key
                nodes.append(node)
                labels.append(label)
                sets.append(flat[ends[k] : ends[k + 1]].copy())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in edges()], names=["a", "b"])

    return check


def checked_edges(members: DataFrame, similarity: float, rows: int = GROUP_ROWS, size: int = GROUP_BYTES) -> DataFrame:
    """Edges (a, b) that join every two of members(node, label, root, set) of one root whose sets reach the similarity.

    Members of one label are joined already. Groups above `rows` rows or `size` bytes are cut into parts of half of that,
    and every two parts meet by themselves.
    """
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum(8 * F.size("set").cast("long")).alias("bytes"))
    over = F.greatest(F.col("n") / rows, F.col("bytes") / size)
    sizes = sizes.select("root", F.when(over <= 1, 1).otherwise(F.ceil(2 * over)).cast("int").alias("parts"))
    dealt = members.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where((F.col("parts") == 1) | (F.col("own") != F.col("other")))
    pairs = pairs.select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "node", "label", "set")
    return pairs.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_check(similarity), "a long, b long")


def _ceil(share: float, n):
    """The least whole number that isn't below share * n."""
    return np.ceil(share * n - 1e-9).astype(np.int64)


def least_hashes(n, similarity: float, common: float = NEAR_COMMON, needed: int = NEAR_KEYS):
    """Of a set of n: how many least hashes are looked at, how many of the rarest of these are keys, how many keys near copies share.

    Near copies share at least similarity * n of either's n hashes. So the first common * n that they share, by value, are
    among the (1 - similarity + common) * n least of either; n is that of the smaller set, similarity * n at least. Of
    the hashes looked at, put in any other order that all sets follow, so many at least are shared: all but so many, less
    the number needed, come before the last of as many shared ones.
    """
    n = np.asarray(n, dtype=np.int64)
    looked = np.minimum(n, n - _ceil(similarity, n) + _ceil(common, n))
    shared = _ceil(common, _ceil(similarity, n))
    needed = np.minimum(needed, shared)
    return looked, np.minimum(looked, looked - shared + needed), needed


_READ = "struct<digest:binary,size:bigint,needed:int,spare:int,print:bigint,least:array<bigint>>"


def _read(width: int, similarity: float):
    """Of a text's shingle set: digest, size, SimHash fingerprint, and the hashes that keys are chosen from, `spare` of which are none."""
    from xxhash import xxh3_128_digest

    def scan(column: pa.Array) -> pa.Array:
        digests, sizes, least, prints = [], [], [], []
        for data in as_bytes(column):
            own = np.unique(shingle_hashes(data, width))
            digests.append(xxh3_128_digest(own.tobytes()))
            sizes.append(len(own))
            prints.append(majority(own))
            least.append(own)
        n = np.array(sizes, dtype=np.int64)
        looked, keys, needed = least_hashes(n, similarity)
        cut = [own[:k] for own, k in zip(least, looked.tolist(), strict=True)]
        flat = np.concatenate(cut) if cut else np.zeros(0, dtype=np.uint64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(looked))), pa.int32()), pa.array(flat.view(np.int64)))
        columns = [pa.array(digests, pa.binary()), pa.array(n), pa.array(needed.astype(np.int32)), pa.array((looked - keys).astype(np.int32)), pa.array(np.array(prints, dtype=np.uint64).view(np.int64)), lists]
        return pa.StructArray.from_arrays(columns, names=["digest", "size", "needed", "spare", "print", "least"])

    return F.arrow_udf(scan, _READ)


def _sets(width: int):
    def scan(column: pa.Array) -> pa.Array:
        sets = [np.unique(shingle_hashes(data, width)) for data in as_bytes(column)]
        flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(flat.view(np.int64)))

    return F.arrow_udf(scan, "array<bigint>")


def shared_keys(nodes: DataFrame) -> DataFrame:
    """node, size, needed, key of nodes(node, size, needed, spare, least): near copies have `needed` keys of either in common.

    Of the least hashes of a node, all but the `spare` most common ones are keys. A hash that no other node has is a key
    that joins nothing.
    """
    hashes = nodes.select("node", F.explode("least").alias("hash"))
    common = materialize(hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "common")
    shared = hashes.join(common, "hash").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "hash"))).alias("own"))
    rest = nodes.select("node", "size", "needed", "spare")
    shared = shared.join(rest, "node").where(F.size("own") > F.col("spare"))
    return shared.select("node", "size", "needed", F.explode(F.slice("own", F.lit(1), F.size("own") - F.col("spare"))["hash"]).alias("key"))


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of pairs(a, b) whose sets(node, set) reach the Jaccard similarity."""
    left, right = (sets.select(F.col("node").alias(c), F.col("set").alias(f"{c}s")) for c in ("a", "b"))
    met = pairs.join(left, "a").join(right, "b")
    both = F.size(F.array_intersect("as", "bs"))
    return met.where(both / (F.size("as") + F.size("bs") - both) >= similarity).select("a", "b")


def near_edges(nodes: DataFrame, keys: DataFrame, sets: DataFrame, similarity: float = NEAR_SIMILARITY, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """Edges (a, b) that join all near copies among the nodes(node, print): links of exact similarity, none is lost.

    First the links that bit-sliced SimHash comparison finds are checked: they join most copies. What may still be near
    copies and isn't joined has common keys. Of keys with few nodes, pairs with enough keys in common are checked; nodes
    that a more frequent key joins are searched group by group.
    """
    met = keys.select("node").distinct()
    prints = materialize(nodes.select("node", "print").join(met, "node").select(F.col("node").alias("id"), F.array("print").alias("prints")), "met")
    found = materialize(link_edges(prints, exact_masks(RADIUS, prints.count()), RADIUS).distinct(), "found")
    first = materialize(alike(found, sets, similarity), "first")
    joined = components(first)
    named = keys.join(joined, "node", "left").select("key", "node", "size", "needed", F.coalesce("root", "node").alias("label"))
    named = materialize(named, "named")
    spread = named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    spread = materialize(spread.where(F.col("low") < F.col("high")).select("key", "n"), "spread")
    apart = materialize(named.join(spread, "key"), "apart")
    rare = apart.where(F.col("n") <= pair_rows).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("node", "label", "size", "needed"))).alias("rows"))
    rare = rare.select(F.posexplode("rows").alias("k", "x"), "rows").select("x", F.explode(F.slice("rows", F.col("k") + 2, F.size("rows"))).alias("y"))
    low, high = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    rare = rare.where((F.col("x.label") != F.col("y.label")) & (low / high >= similarity)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.least("x.needed", "y.needed").alias("needed"))
    pairs = rare.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("needed").alias("needed")).where(F.col("n") >= F.col("needed")).select("a", "b")
    second = alike(materialize(pairs, "pairs"), sets, similarity)
    frequent = apart.where(F.col("n") > pair_rows)
    heads = materialize(frequent.groupBy("key").agg(F.min("node").alias("head")), "heads")
    groups = components(frequent.join(heads, "key").where(F.col("node") != F.col("head")).select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    members = groups.join(joined.withColumnRenamed("root", "label"), "node", "left").select("node", "root", F.coalesce("label", "node").alias("label"))
    third = checked_edges(materialize(members.join(sets, "node"), "members"), similarity)
    return first.unionByName(materialize(second, "second")).unionByName(materialize(third, "third"))


def _holds_map(kind) -> bool:
    return "map<" in kind.simpleString()


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = NEAR_SIMILARITY, width: int = NEAR_WIDTH) -> DataFrame:
    """docs with one row of each group of near copies: that of the smallest id. Same columns, of any names and types.

    Near copies are all rows joined by links of at least this exact Jaccard similarity of their shingle sets; rows of
    equal sets (of no words too) are copies of each other. Null ids come last. A row is told from others by its id and a
    128-bit hash of all its columns; of rows alike in all of these, one stays.
    """
    bounded_batches(docs.sparkSession)
    hashed = [F.to_json(F.struct(by_name(docs, f.name))) if _holds_map(f.dataType) else by_name(docs, f.name) for f in docs.schema.fields]
    tie = F.concat(F.hex(F.xxhash64(*hashed)), F.lit("/"), F.hex(F.xxhash64(F.lit(1), *hashed)))
    own = by_name(docs, key).cast("long")
    with scratch() as keep:
        rows = materialize(docs.select(own.alias("id"), tie.alias("tie"), _read(width, similarity)(by_name(docs, text)).alias("set")).select("id", "tie", "set.*"), "rows")
        twins = not rows.groupBy("id", "tie").count().where(F.col("count") > 1).isEmpty()
        same = ("size", "needed", "spare", "print", "least")
        nodes = rows.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tie")).alias("first"), *[F.first(c).alias(c) for c in same])
        # nodes are numbered, so that no two sets can share a name
        nodes = keep(materialize(nodes.select(F.monotonically_increasing_id().alias("node"), "first.*", *same), "nodes"))
    with scratch() as keep:
        keys = materialize(shared_keys(nodes), "keys")
        wanted = nodes.select("node", F.col("id").alias("wid"), F.col("tie").alias("wtie")).join(keys.select("node").distinct(), "node")
        texts = docs.select(own.alias("id"), tie.alias("tie"), by_name(docs, text).alias("body"))
        sets = texts.join(wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.col("tie") == F.col("wtie"))).select("node", _sets(width)("body").alias("set"))
        sets = materialize(sets.dropDuplicates(["node"]) if twins else sets, "sets")
        roots = components(near_edges(nodes, keys, sets, similarity))
        grouped = nodes.select("node", "last", "id", "tie").join(roots, "node", "left")
        kept = grouped.groupBy(F.coalesce("root", "node").alias("group")).agg(F.min(F.struct("last", "id", "tie")).alias("first"))
        kept = keep(materialize(kept.select("first.id", "first.tie"), "kept"))
    discard(nodes)
    id_name, tie_name, own_id, own_tie = (fresh(docs, base=b) for b in ("kept_id", "kept_tie", "id", "tie"))
    kept = kept.select(F.col("id").alias(id_name), F.col("tie").alias(tie_name))
    marked = docs.withColumns({own_id: own, own_tie: tie})
    out = marked.join(kept, F.col(own_id).eqNullSafe(F.col(id_name)) & (F.col(own_tie) == F.col(tie_name)), "left_semi")
    return (out.dropDuplicates([own_id, own_tie]) if twins else out).drop(own_id, own_tie)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
