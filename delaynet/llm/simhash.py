"""SimHash near-duplicates by a hierarchical index in Gray order.

Equal fingerprints are folded first, so only distinct ones are searched. The 64
bits are cut into blocks; two fingerprints at most `distance` bits apart agree in
all but `distance` blocks, so one row per choice of the agreeing blocks brings
every such pair into a common bucket. The number of blocks follows from the number
of fingerprints, so buckets stay small as the corpus grows.

Rows are range-partitioned by bucket and Gray rank, so neighbours share most bits
and a crowded bucket is spread over partitions. Consecutive rows form groups, and
groups form nodes; each keeps the bits that all its members share. A search goes
down from the upper nodes, adds up the differing shared bits, and drops whole
groups once the sum is above the distance. A bucket is cut into chunks; pairs of
chunks that their shared bits do not rule out are searched in tasks of their own.

Every search returns the links of a spanning forest, not all pairs, and the links
are contracted to components by rounds of star operations over written tables.
"""

from __future__ import annotations

from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaynet.llm.common import map_batches, slices, texts_of, unused
from delaynet.session import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 3
GROUP = 16  # members of a group, and groups of a node
CHUNK = 2048  # rows of one chunk of a bucket
BUCKET = 32  # fingerprints that a bucket holds on average, about


# Fingerprints


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of `shingle` words, or of all words if there are fewer; A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *[end + 1 for end in ends]]
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    return np.array([digest(joined[a:b]) for a, b in zip(starts, ends[shingle - 1 :])], dtype=np.uint64)


def majority(hashes: list[np.ndarray], step: int = 16_384) -> np.ndarray:
    """For each row, the bits that are set in over half of its hashes; zero without any."""
    sizes = np.array([len(h) for h in hashes])
    counts = np.zeros((len(hashes), 64), dtype=np.int64)
    flat = np.concatenate(hashes) if len(hashes) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(hashes)), sizes)
    for low in range(0, len(flat), step):
        part, rows = flat[low : low + step], owner[low : low + step]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        counts[rows[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    chosen = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(chosen, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, signature, fp` of every row's whole text; null and blank texts get the fingerprint zero.

    `signature` is a hash of the exact text, which tells apart rows that repeat an id.
    """

    def run(batches):
        for batch in batches:
            texts = texts_of(batch)
            found = [
                majority([shingle_hashes(content, shingle) for content in texts[low:high]])
                for low, high in slices([len(t or "") for t in texts])
            ]
            fp = np.concatenate(found or [np.zeros(0, "<u8")]).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("signature"), pa.array(fp)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "signature", "fp"])

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("signature"), F.col(text).alias("text")
    )
    return map_batches(rows, run, "doc_id bigint, signature bigint, fp bigint")


# Search


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in Gray order, where neighbours differ in one bit."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Index:
    """Groups over fingerprints in Gray order, with the bits that all members of a group share."""

    def __init__(self, fp: np.ndarray):
        self.fp = fp
        pattern, shared = fp, np.full(len(fp), np.uint64(2**64 - 1))
        self.levels = [(pattern, shared)]  # rows, groups, nodes and so on
        while len(pattern) > GROUP:
            first = np.arange(0, len(pattern), GROUP)
            lead = np.repeat(pattern[first], np.diff(np.r_[first, len(pattern)]))
            same = ~(pattern ^ lead) & shared
            shared = np.bitwise_and.reduceat(same, first)
            pattern = pattern[first] & shared
            self.levels.append((pattern, shared))

    def links(self, other: Index, distance: int, step: int = 4096):
        """Row pairs at most `distance` bits apart, in parts; with itself, each pair once."""
        alone = self is other
        top = min(len(self.levels), len(other.levels)) - 1
        a, b = (x.ravel() for x in np.meshgrid(np.arange(len(self.levels[top][0])), np.arange(len(other.levels[top][0])), indexing="ij"))
        nothing = np.zeros(len(a), dtype=np.int64)
        stack = [(top, a, b, nothing, nothing.astype(np.uint64))]
        while stack:
            level, a, b, differing, seen = stack.pop()
            if len(a) > step * GROUP:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half], differing[:half], seen[:half])]
                stack += [(level, a[half:], b[half:], differing[half:], seen[half:])]
                continue
            (pattern_a, shared_a), (pattern_b, shared_b) = self.levels[level], other.levels[level]
            both = shared_a[a] & shared_b[b]
            differing = differing + np.bitwise_count((pattern_a[a] ^ pattern_b[b]) & both & ~seen)
            keep = differing <= distance
            if alone:
                keep &= (a < b) if level == 0 else (a <= b)
            a, b, differing, both = a[keep], b[keep], differing[keep], both[keep]
            if not len(a):
                continue
            if level == 0:
                yield a, b
                continue
            size_a, size_b = len(self.levels[level - 1][0]), len(other.levels[level - 1][0])
            inner = np.arange(GROUP)
            a = np.broadcast_to((a[:, None] * GROUP + inner)[:, :, None], (len(a), GROUP, GROUP)).ravel()
            b = np.broadcast_to((b[:, None] * GROUP + inner)[:, None, :], (len(b), GROUP, GROUP)).ravel()
            inside = (a < size_a) & (b < size_b)
            grown = [np.repeat(x, GROUP * GROUP)[inside] for x in (differing, both)]
            stack.append((level - 1, a[inside], b[inside], *grown))


class Forest:
    """Smallest connected row of each row, as links come in."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up

    def links(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inner = np.flatnonzero(self.root != np.arange(len(fp)))
        return fp[inner], fp[self.root[inner]]


def linked_within(fp: np.ndarray, bucket: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among rows of the same bucket; rows come by bucket and Gray rank."""
    forest = Forest(len(fp))
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[starts, len(fp)])
    small = np.repeat(sizes <= GROUP, sizes)
    for gap in range(1, min(GROUP, len(fp))):
        near = small[gap:] & (bucket[gap:] == bucket[:-gap])
        at = np.flatnonzero(near)
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + gap]) <= distance]
        forest.add(at, at + gap)
    for start, size in zip(starts[sizes > GROUP], sizes[sizes > GROUP]):
        index = Index(fp[start : start + size])
        for a, b in index.links(index, distance):
            forest.add(a + start, b + start)
    return forest.links(fp)


_FOUND = "a bigint, b bigint, bucket bigint, choice int, chunk bigint, pattern bigint, shared bigint, members binary"
_NAMES = [column.split()[0] for column in _FOUND.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _search(distance: int):
    """Links within chunks, and the chunks of buckets that may go on outside of one."""

    def rows(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in zip(_NAMES, _TYPES)], names=_NAMES
        )

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        fp, bucket, choice = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        opened = True  # whether the bucket at the front may have begun before

        def chunks(low: int, high: int) -> pa.RecordBatch:
            nonlocal made
            parts = [fp[at : min(at + CHUNK, high)] for at in range(low, high, CHUNK)]
            shared = [np.bitwise_and.reduce(~(part ^ part[0])) for part in parts]
            made += len(parts)
            return rows(
                bucket=[int(bucket[low])] * len(parts), choice=[int(choice[low])] * len(parts),
                chunk=[(task << 32) + made - 1 - i for i in range(len(parts))],
                pattern=np.array([part[0] & s for part, s in zip(parts, shared)], np.uint64).view(np.int64),
                shared=np.array(shared, np.uint64).view(np.int64), members=[part.tobytes() for part in parts],
            )

        def searched(low: int, high: int, numbers: np.ndarray) -> pa.RecordBatch:
            a, b = linked_within(fp[low:high], numbers, distance)
            return rows(a=a.view(np.int64), b=b.view(np.int64))

        def take(last: bool):
            """Everything up to the bucket that may go on; of that one, whole chunks."""
            nonlocal fp, bucket, choice, opened
            if not len(fp):
                return
            starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (choice[1:] != choice[:-1])])
            ends = np.r_[starts[1:], len(fp)]
            done = len(fp) if last else int(starts[-1])
            if not last and len(fp) - done > CHUNK:
                done += (len(fp) - done) // CHUNK * CHUNK
            if not done:
                return
            begun = starts[starts < done]
            numbers = np.repeat(np.arange(len(begun)) << 32, np.diff(np.r_[begun, done]))
            within = np.arange(done) - np.repeat(begun, np.diff(np.r_[begun, done]))
            yield searched(0, done, numbers + within // CHUNK)  # a chunk is searched as one
            for number, (low, high) in enumerate(zip(starts, ends)):
                outer = (number == 0 and opened) or (number == len(starts) - 1)
                if low < done and (outer or high - low > CHUNK):
                    yield chunks(int(low), min(int(high), done))
            opened = done > starts[-1]
            fp, bucket, choice = fp[done:], bucket[done:], choice[done:]

        for batch in batches:
            fp = np.r_[fp, batch.column("fp").to_numpy().view(np.uint64)]
            bucket = np.r_[bucket, batch.column("bucket").to_numpy()]
            choice = np.r_[choice, batch.column("choice").to_numpy()]
            yield from take(last=False)
        yield from take(last=True)

    return run


def _cross(distance: int):
    """Spanning links between two chunks."""

    def run(batches):
        for batch in batches:
            found: list[np.ndarray] = [np.zeros((2, 0), np.uint64)]
            for left, right in zip(batch.column("members").to_pylist(), batch.column("other_members").to_pylist()):
                a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                forest = Forest(len(a) + len(b))
                for i, j in Index(a).links(Index(b), distance):
                    forest.add(i, j + len(a))
                found.append(np.array(forest.links(np.r_[a, b])))
            a, b = np.concatenate(found, axis=1).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def blocks_for(count: int, distance: int = DISTANCE) -> list[int]:
    """Masks over the 64 bits, one per choice of agreeing blocks, for so many fingerprints."""
    wanted = max(1.0, np.log2(max(2, count) / BUCKET))
    blocks = distance + 1
    while blocks < 2 * distance + 2 and 64 * (blocks - distance) // blocks < wanted:
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - distance)]


def links_between(distinct: DataFrame, count: int, distance: int = DISTANCE) -> DataFrame:
    """`a, b`: links that connect all of the distinct `fp` that are at most `distance` bits apart."""
    masks = blocks_for(count, distance)

    def keyed(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            gray = (gray_rank(fp) ^ np.uint64(2**63)).view(np.int64)
            for choice, mask in enumerate(masks):
                columns = [np.full(len(fp), choice, np.int32), (fp & np.uint64(mask)).view(np.int64), gray, fp.view(np.int64)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["choice", "bucket", "gray", "fp"])

    order = ["choice", "bucket", "gray"]
    rows = map_batches(distinct.select("fp"), keyed, "choice int, bucket bigint, gray bigint, fp bigint")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("choice", "bucket", "fp")
    found = materialize(map_batches(ranged, _search(distance), _FOUND), "simhash-links")

    chunks = found.filter("chunk is not null").select("choice", "bucket", "chunk", "pattern", "shared", "members")
    left = chunks.drop("members")
    right = left.select(
        "choice", "bucket", F.col("chunk").alias("other"), F.col("pattern").alias("other_pattern"), F.col("shared").alias("other_shared")
    )
    differing = F.col("pattern").bitwiseXOR(F.col("other_pattern")).bitwiseAND(F.col("shared")).bitwiseAND(F.col("other_shared"))
    pairs = left.join(right, ["choice", "bucket"]).filter((F.col("chunk") < F.col("other")) & (F.bit_count(differing) <= distance))
    members = chunks.select("chunk", "members")
    pairs = pairs.select("chunk", "other").join(members, "chunk").join(
        members.select(F.col("chunk").alias("other"), F.col("members").alias("other_members")), "other"
    )
    across = map_batches(pairs.select("members", "other_members"), _cross(distance), "a bigint, b bigint")
    return found.filter("a is not null").select("a", "b").union(across)


# Components


def components(links: DataFrame) -> DataFrame:
    """`node, root`: every linked node with the smallest one that it reaches.

    Alternates large stars (greater neighbours move to the smallest one) and small
    stars (smaller neighbours do) until nothing moves; each round's links are
    written, so a lost executor costs one round at most.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = materialize(links.filter("a <> b").select(u, v).distinct(), "stars")

    def state(rows: DataFrame):
        return rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "stars")
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = materialize(small.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), "stars")
        after = state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """`doc_id, signature, fp, root, component_id` of every row.

    `component_id` is the smallest doc_id that links of fingerprints reach, and
    `root` the component's smallest fingerprint. Null and blank texts share the
    fingerprint zero. Rows without an id name their component only if no member
    has an id (it is null then). Repeated rows are rows like any other. Other
    columns are not read.
    """
    rows = materialize(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links_between(distinct, distinct.count(), distance))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left")
    rooted = materialize(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "signature", "fp", "root", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row, with all its columns, of each component: that of its smallest doc_id.

    Of rows that repeat this id within the component, and of components without
    ids, the row with the smallest signature stays, once.
    """
    found = near_duplicates(docs, doc_id, text, shingle, distance)
    nameless = F.lit(-(2**63)).cast("bigint")
    keys = [unused(docs, "kept_id"), unused(docs, "kept_signature")]
    winners = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.coalesce(F.min("doc_id"), nameless).alias(keys[0]), F.min("signature").alias(keys[1])
    )
    tagged = docs.withColumns({keys[0]: F.coalesce(F.col(doc_id).cast("bigint"), nameless), keys[1]: F.xxhash64(text)})
    return tagged.join(winners.select(*keys), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
