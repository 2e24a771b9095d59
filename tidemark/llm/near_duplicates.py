"""Exact Jaccard self-join of word-shingle sets by PartEnum signatures.

Sets are dealt to size bands [l, l / similarity]; sets that link lie in the same or in neighbouring bands, so a set takes
part in its own band's instance and the next one's. There two linked sets differ in at most k elements. An instance
partitions the hashed feature domain into n1 = k // 2 + 1 parts; in one of these two linked sets differ in at most one
element. Each part is partitioned again into n2, and a signature is the set's projection on all but one of those: of the
n2 such subsets one holds no difference, so linked sets share a signature of the n1 * n2 that each set has.

Sets that share signatures in groups of thousands aren't paired out:

* documents of equal sets are one class, represented by its smallest doc_id;
* within a signature, packed parity bitmaps (a lower bound of the difference) say which classes may link, and a spanning
  forest of those makes families;
* within a family, sets are compared exactly, skipping pairs that are connected already; the verified links again form a
  spanning forest, and their components are the result.

No signature's pairs are listed when it has more than ``block`` members. Those members are signed again, with another seed and
more subparts; linked ones share a signature of the second round too. One that is large again makes one family of its members.
In a family of more than ``block`` members every member is compared with a few hubs, again and again while that connects
many; then the members outside the largest cluster, which the hubs left over, are compared with all. Both steps grow with the
members, unless most of a family share signatures without being linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import mark, release, stage
from .components import connected_components, join_minima
from .rows import map_texts

BLOCK = 2048
FLUSH_ENTRIES = 600_000
ENTRIES_A_BUCKET = 800_000
#: Members of a large family that all others are compared with in one round.
HUBS = 64
#: Elements that a signature's subset should hold, so that few unrelated sets agree in it by being empty there.
LEAST_ELEMENTS = 6

ENTRY = np.dtype([("signature", "<u8"), ("node", "<i8")])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-word shingles of a text, A-Z in lower case; words are runs of other than
    ASCII white space. Fewer words make one shingle of them all, none an empty set."""
    words = (text or "").encode("utf-8").lower().split()
    if len(words) < n:
        if not words:
            return np.empty(0, np.uint64)
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    rolled = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + len(rolled)])
    return np.unique(rolled)


def set_digest(elements: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None


def node_of(digest: bytes) -> int:
    """A class's number in the graph of candidates, where a collision only makes a family larger."""
    return int.from_bytes(digest[:8], "little", signed=True)


def allowed_difference(total: np.ndarray | int, percent: int):
    """Elements in which two sets of ``total`` elements together may differ: 100 * i >= percent * u, solved for u - i."""
    return total * (100 - percent) // (100 + percent)


class Bands:
    """The size bands of a similarity and what an instance needs: k, n1, and the bitmap's width."""

    def __init__(self, percent: int):
        self.percent = percent
        self.upper = [0]

    def band(self, size: int) -> int:
        while self.upper[-1] < size:
            self.upper.append((self.upper[-1] + 1) * 100 // self.percent)
        return int(np.searchsorted(self.upper, size))

    def differences(self, band: int) -> int:
        while len(self.upper) <= band:
            self.upper.append((self.upper[-1] + 1) * 100 // self.percent)
        return int(allowed_difference(2 * self.upper[band], self.percent))

    def width(self, band: int) -> int:
        """Bits of the parity bitmap: three for each difference allowed, in whole words of 64."""
        return 64 * max(1, -(-3 * self.differences(band) // 64))


@cache
def bands(percent: int) -> Bands:
    return Bands(percent)


def subparts_for(percent: int) -> int:
    """The fewest subparts n2, 2 to 6, with which the subsets of a set hold LEAST_ELEMENTS in the mean."""
    a_part = (100 + percent) / (100 - percent)  # elements of a first-level part: twice the set over k
    return next((n2 for n2 in range(2, 6) if a_part * (n2 - 1) / n2 >= LEAST_ELEMENTS), 6)


@cache
def subsets(n2: int, left_out: int) -> np.ndarray:
    """Rows of 0 and 1: the ways to take all but ``left_out`` of n2 parts."""
    rows = np.ones((0, n2), np.uint64)
    for out in combinations(range(n2), left_out):
        row = np.ones((1, n2), np.uint64)
        row[0, list(out)] = 0
        rows = np.concatenate([rows, row])
    return rows


def signatures(elements: np.ndarray, band: int, percent: int, subparts: int, seed: int = 0) -> np.ndarray:
    """PartEnum signatures of a sorted set in the instance of a band; the lowest bit is that of the band's number.

    Another ``seed`` partitions the features in another way."""
    if seed:
        elements = np.sort(mix(elements ^ mix(np.full(1, seed, np.uint64))))
    k = bands(percent).differences(band)
    n1, n2, left_out = (k // 2 + 1, subparts, 1) if k else (1, 1, 0)
    part = (elements >> np.uint64(32)) * np.uint64(n1 * n2) >> np.uint64(32)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements + np.uint64(1)), dtype=np.uint64)])
    bounds = np.searchsorted(part, np.arange(n1 * n2 + 1, dtype=np.uint64))
    sums = (upto[bounds[1:]] - upto[bounds[:-1]]).reshape(n1, n2)
    taken = subsets(n2, left_out)
    projected = sums @ taken.T
    place = np.arange(projected.size, dtype=np.uint64) + np.uint64(band << 40)
    return mix(projected.ravel() + mix(place)) & ~np.uint64(1) | np.uint64(band & 1)


def bitmap(elements: np.ndarray, width: int) -> np.ndarray:
    """For each of ``width`` buckets, whether an odd number of elements fall there."""
    bucket = (elements & np.uint64(0xFFFFFFFF)) * np.uint64(width) >> np.uint64(32)
    return np.packbits(np.bincount(bucket.astype(np.int64), minlength=width).astype(np.uint8) & 1)


def distinct_entries(found: np.ndarray) -> np.ndarray:
    """Entries in order of signature and node, each once."""
    found = found[np.lexsort((found["node"], found["signature"]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found["signature"][1:] != found["signature"][:-1]) | (found["node"][1:] != found["node"][:-1])
    return found[fresh]


class Forest:
    """Trees over 0 .. n - 1, each node labelled with its tree's smallest one."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.trees = n

    def root(self, i: int) -> int:
        return int(self.label[i])

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.label[self.label == max(a, b)] = min(a, b)
            self.trees -= 1
        return a != b

    def others(self, i: int, among: np.ndarray) -> np.ndarray:
        """Those of ``among`` that are in other trees than ``i``."""
        return among[self.label[among] != self.label[i]]


def possible_partners(bits: np.ndarray, sizes: np.ndarray, i: int, percent: int) -> np.ndarray:
    """Members after ``i`` whose bitmaps differ from its by no more than their sizes allow."""
    apart = np.bitwise_count(bits[i + 1 :] ^ bits[i]).sum(axis=1)
    return i + 1 + np.flatnonzero(apart <= allowed_difference(sizes[i + 1 :] + sizes[i], percent))


def candidate_forest(bits: list[np.ndarray], sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the members that may link."""
    packed = np.stack(bits).view(np.uint64)
    forest = Forest(len(bits))
    for i in range(len(bits) - 1):
        if forest.trees == 1:
            return
        apart = forest.others(i, possible_partners(packed, sizes, i, percent))
        for j in apart[np.unique(forest.label[apart], return_index=True)[1]].tolist():
            forest.join(i, j)
            yield i, j


def link_forest(
    sets: list[np.ndarray], percent: int, probes: list[int] | None = None, joined: np.ndarray | None = None
) -> Iterator[tuple[int, int]]:
    """A spanning forest of the members that do link: 100 * intersection >= percent * union.

    With ``probes``, only pairs with one of them are compared; members of equal number in ``joined`` are connected beforehand.
    """
    sizes = np.array([len(s) for s in sets])
    width = bands(percent).width(bands(percent).band(int(sizes.max())))
    packed = np.stack([bitmap(s, width) for s in sets]).view(np.uint64)
    forest = Forest(len(sets))
    if joined is not None:
        _, first, of = np.unique(joined, return_index=True, return_inverse=True)
        forest.label, forest.trees = first[of], len(first)
    for i in range(len(sets) - 1) if probes is None else probes:
        if probes is None:
            partners = possible_partners(packed, sizes, i, percent)
        else:
            apart = np.bitwise_count(packed ^ packed[i]).sum(axis=1)
            partners = np.flatnonzero(apart <= allowed_difference(sizes + sizes[i], percent))
        if forest.trees == 1:
            return
        for j in forest.others(i, partners).tolist():
            if forest.label[i] == forest.label[j]:
                continue
            small, large = sorted((sets[i], sets[j]), key=len)
            at = np.searchsorted(large, small)
            common = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
            if 100 * common >= percent * (len(small) + len(large) - common):
                forest.join(i, j)
                yield i, j


def _set_table(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """key (doc_id, and a hash of the text), n_shingles, digest, node, band, and the bitmaps of the set's own and the next band."""

    def run(ids, texts):
        counts, digests, nodes, levels, own, following = [], [], [], [], [], []
        known = bands(percent)
        for text in texts:
            elements = shingle_set(text, n)
            digest = set_digest(elements)
            counts.append(len(elements))
            digests.append(digest)
            nodes.append(node_of(digest) if digest else None)
            band = known.band(len(elements)) if digest else 0
            levels.append(band)
            own.append(bitmap(elements, known.width(band)).tobytes() if digest else None)
            following.append(bitmap(elements, known.width(band + 1)).tobytes() if digest else None)
        return [ids, counts, digests, nodes, levels, own, following]

    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_key")).alias("doc_id"), "text")
    rows = "key struct<doc_id: long, text_key: long>, n_shingles long, digest binary, node long, band int, own binary, following binary"
    return map_texts(keyed, run, rows).select("key.doc_id", "key.text_key", *[c.split()[0] for c in rows.split(", ")[2:]])


def _shared_signatures(texts: DataFrame, n: int, percent: int, subparts: int, buckets: int, block: int, seed: int = 0) -> DataFrame:
    """(task, node, hub): the members of each signature that several classes have; hub is null up to ``block`` members, beyond
    that the smallest of them."""

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        found = distinct_entries(np.concatenate(parts))
        bucket = (found["signature"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([found[order[bounds[b] : bounds[b + 1]]].tobytes()], pa.binary())],
                names=["bucket", "entries"],
            )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, known = [], 0, bands(percent)
        for batch in batches:
            for text in batch.column(0):
                elements = shingle_set(text.as_py(), n)
                if not len(elements):
                    continue
                band = known.band(len(elements))
                both = np.concatenate([signatures(elements, band + d, percent, subparts, seed) for d in (0, 1)])
                part = np.empty(len(both), ENTRY)
                part["signature"], part["node"] = both, node_of(set_digest(elements))
                parts.append(part)
                held += len(part)
                if held >= FLUSH_ENTRIES:
                    yield from flush(parts)
                    parts, held = [], 0
        yield from flush(parts)

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        found = distinct_entries(np.frombuffer(b"".join(pdf["entries"]), ENTRY))
        signature, node = found["signature"], np.ascontiguousarray(found["node"])
        starts = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]]))
        counts = np.diff(np.append(starts, len(found)))
        keep, large = np.repeat(counts > 1, counts), np.repeat(counts > block, counts)
        # A task is named after its members, so signatures with the same members make the same task; its lowest bit is the instance's.
        names = mix(np.add.reduceat(mix(node.view(np.uint64)), starts))
        names = (names & ~np.uint64(1) | signature[starts] & np.uint64(1)).view(np.int64)
        hubs = pd.array(np.repeat(node[starts], counts), dtype="Int64")
        hubs[~large] = pd.NA
        return pd.DataFrame({"task": np.repeat(names, counts)[keep], "node": node[keep], "hub": hubs[keep]})

    packed = texts.select("text").mapInArrow(emit, "bucket int, entries binary")
    return packed.groupBy("bucket").applyInPandas(gather, "task long, node long, hub long").distinct()


def _candidates(docs: DataFrame, classes: DataFrame, n: int, percent: int, subparts: int, entries: int, block: int) -> tuple[DataFrame, DataFrame | None]:
    """((task, node) of signatures with a bounded number of members, (a, b) edges of those that are large in both rounds)."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def buckets(many: int) -> int:
        return max(partitions, -(-many // ENTRIES_A_BUCKET))

    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    shared = stage(_shared_signatures(texts, n, percent, subparts, buckets(entries), block), "shared")
    large = stage(shared.where("hub IS NOT NULL").select("node").distinct().join(classes, "node").select("cid", "rep", "rep_text", "n_shingles"), "large")
    total = large.agg(F.count(F.lit(1)), F.sum("n_shingles")).first()
    usual = shared.where("hub IS NULL").select("task", "node")
    if not total[0]:
        return usual, None
    finer = subparts + 2
    entries = 2 * finer * (total[1] * (100 - percent) // (100 + percent) + total[0])
    again = stage(_shared_signatures(_texts(docs, large), n, percent, finer, buckets(entries), block, seed=1), "shared")
    return usual.union(again.where("hub IS NULL").select("task", "node")), again.where("hub IS NOT NULL AND hub <> node").selectExpr("node AS a", "hub AS b")


def _texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (rep, rep_text and others) with the text of their representatives."""
    texts = docs.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("rep_text"), "text")
    return texts.join(members.hint("shuffle_hash"), ["rep", "rep_text"])


def _families(classes: DataFrame, shared: DataFrame, stars: DataFrame | None, percent: int, tasks: int) -> DataFrame:
    """(node, component): classes joined to families by a forest of the pairs that may link in some signature."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in pdf.groupby("task"):
            nodes, sizes = group["node"].tolist(), group["n_shingles"].to_numpy()
            bits = [np.frombuffer(b, np.uint8) for b in group["bits"]]
            out.extend((nodes[i], nodes[j]) for i, j in candidate_forest(bits, sizes, percent))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    # A task is of its set's own instance where their lowest bits agree, else of the next one.
    same = F.pmod("task", F.lit(2)) == F.col("band") % 2
    members = shared.join(classes.select("node", "n_shingles", "band", "own", "following").hint("shuffle_hash"), "node").select(
        "task", "node", "n_shingles", F.when(same, F.col("own")).otherwise(F.col("following")).alias("bits")
    )
    edges = members.groupBy(F.pmod(F.xxhash64("task"), F.lit(tasks)).alias("share")).applyInPandas(run, "a long, b long")
    return connected_components(edges if stars is None else edges.union(stars))


def _verified(rows: DataFrame, n: int, percent: int, tasks: int) -> DataFrame:
    """(a, b): for each task of ``rows`` (task, cid, cluster, probe, text) a forest of the links between its members, beyond what
    their clusters connect; with probes, of the links with those."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in pdf.groupby("task"):
            ids, probe = group["cid"].to_numpy(), np.flatnonzero(group["probe"].to_numpy())
            if len(ids) > 1:
                sets = [shingle_set(t, n) for t in group["text"]]
                found = link_forest(sets, percent, probe.tolist() if len(probe) else None, group["cluster"].to_numpy())
                out.extend((int(ids[i]), int(ids[j])) for i, j in found)
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy(F.pmod("task", F.lit(tasks)).alias("share")).applyInPandas(run, "a long, b long")


def _links(docs: DataFrame, classes: DataFrame, families: DataFrame, n: int, percent: int, tasks: int, block: int) -> DataFrame:
    """(a, b): links between the classes of each family that connect what any links connect."""
    sizes = families.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    members = join_minima(families, sizes.withColumn("n", F.col("members")), "component", "members", "n", families.count()).join(classes.select("node", "cid", "rep", "rep_text"), "node")
    members = stage(members.select("cid", "rep", "rep_text", F.col("component").alias("family"), "members"), "members")
    lone = F.lit(False).alias("probe")
    small = _texts(docs, members.where(F.col("members") <= block)).select(F.xxhash64("family").alias("task"), "cid", F.col("cid").alias("cluster"), lone, "text")
    found = [stage(_verified(small, n, percent, tasks), "links")]
    large = members.where(F.col("members") > block)
    if not large.isEmpty():
        found += _large_families(docs, large, n, percent, tasks, block)
    return reduce(DataFrame.union, found)


def _large_families(docs: DataFrame, members: DataFrame, n: int, percent: int, tasks: int, block: int) -> list[DataFrame]:
    """Links of families (cid, rep, rep_text, family, members) too large for a task: hubs first, then what they left over."""
    step = block // 2
    chunks = F.ceil(F.col("members") / F.lit(step)).cast("int")
    texts = stage(_texts(docs, members).select("cid", "family", "members", "text"), "large-families")
    labels, left, found, turn = texts.select("cid", "family", F.col("cid").alias("cluster"), F.lit(True).alias("outside")), None, [], 0
    while True:
        turn += 1
        labelled = texts.join(labels.select("cid", "cluster", "outside"), "cid")
        chunk = F.pmod(F.xxhash64("cid"), chunks).cast("int")
        own = labelled.select("family", chunk.alias("chunk"), "cid", "cluster", F.lit(False).alias("probe"), "text")
        draw = F.row_number().over(Window.partitionBy("family").orderBy(F.xxhash64("cid", F.lit(turn)), "cid"))
        hubs = labels.where("outside").select("cid", draw.alias("n")).where(F.col("n") <= HUBS).select("cid")
        every = F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")
        hubs = labelled.join(hubs, "cid").select("family", every, "cid", "cluster", F.lit(True).alias("probe"), "text")
        rows = own.union(hubs).select(F.xxhash64("family", "chunk").alias("task"), "cid", "cluster", "probe", "text")
        found.append(stage(_verified(rows, n, percent, tasks), "links"))
        clusters = connected_components(reduce(DataFrame.union, found)).select(F.col("node").alias("cid"), F.col("component").alias("__c"))
        now = texts.select("cid", "family").join(clusters, "cid", "left").select("cid", "family", F.coalesce("__c", "cid").alias("cluster"))
        now = stage(now, "clusters")
        counted = now.groupBy("family", "cluster").agg(F.count(F.lit(1)).alias("n"))
        largest = counted.groupBy("family").agg(F.max(F.struct("n", "cluster")).alias("top")).select("family", F.col("top.cluster").alias("main"))
        labels = stage(now.join(largest, "family").select("cid", "family", "cluster", (F.col("cluster") != F.col("main")).alias("outside")), "labels")
        before, left = left, labels.where("outside").count()
        if not left:
            return found
        if left <= step or before is not None and 2 * left > before:
            break
    labelled = texts.join(labels.select("cid", "cluster", "outside"), "cid")
    outside = labels.where("outside").groupBy("family").agg(F.ceil(F.count(F.lit(1)) / F.lit(step)).cast("int").alias("parts"))
    labelled = labelled.join(outside, "family")
    part = F.pmod(F.xxhash64("cid", F.lit(turn)), F.col("parts")).cast("int")
    probes = labelled.where("outside").select("family", part.alias("part"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), "cid", "cluster", F.lit(True).alias("probe"), "text")
    all_parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    chunk = F.pmod(F.xxhash64("cid"), chunks).cast("int").alias("chunk")
    own = labelled.select("family", all_parts, chunk, "cid", "cluster", F.lit(False).alias("probe"), "text")
    rows = own.union(probes).select(F.xxhash64("family", "part", "chunk").alias("task"), "cid", "cluster", "probe", "text")
    return [*found, stage(_verified(rows, n, percent, tasks), "links")]


def _resolve(docs: DataFrame, n: int, percent: int, subparts: int | None, block: int) -> DataFrame:
    """doc_id, text_key (a hash of the text), n_shingles, component (a number, null where nothing links), component_id of every
    row, in the shared folder."""
    subparts = subparts or subparts_for(percent)
    docs, began = docs.select("doc_id", "text"), mark()
    sets = stage(_set_table(docs, n, percent), "sets")
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    classes = (
        sets.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest", "node", "n_shingles", "band").agg(first, F.min("own").alias("own"), F.min("following").alias("following"), F.count(F.lit(1)).alias("copies"))
        .select("digest", "node", "n_shingles", "band", "copies", F.col("first.doc_id").alias("rep"), F.col("first.text_key").alias("rep_text"), "own", "following")
    )
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count(F.lit(1))).first()
    entries = 2 * subparts * (total[0] * (100 - percent) // (100 + percent) + total[1])
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entries // ENTRIES_A_BUCKET))
    shared, stars = _candidates(docs, classes, n, percent, subparts, entries, block)
    families = stage(_families(classes, shared, stars, percent, tasks), "families")
    found = stage(connected_components(_links(docs, classes, families, n, percent, tasks, block)), "linked")
    reps = found.join(classes.select(F.col("cid").alias("node"), "rep", "digest"), "node").select("digest", "component", "rep")
    least = reps.groupBy("component").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n"))
    of_class = join_minima(reps.select("digest", "component"), least, "component", "least", "n", found.count()).select("digest", "component", "least")
    copies = classes.select("digest", F.col("cid").alias("own_cid"), "rep", "copies").join(of_class, "digest", "left").select(
        "digest", "copies", F.struct(F.coalesce("component", "own_cid").alias("component"), F.coalesce("least", "rep").alias("least")).alias("of")
    )
    has = F.col("doc_id").isNotNull() & F.col("digest").isNotNull()
    matched = join_minima(sets.where(has).select("doc_id", "text_key", "n_shingles", "digest"), copies, "digest", "of", "copies", total[1])
    alone = sets.where(~has).select("doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    result = matched.select("doc_id", "text_key", "n_shingles", F.col("of.component").alias("component"), F.col("of.least").alias("component_id")).union(alone)
    result = stage(result, "resolved")
    release(docs.sparkSession, began, result)
    return result


def near_duplicate_components(
    docs: DataFrame, n: int = 5, percent: int = 80, subparts: int | None = None, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: the smallest doc_id that it reaches by links.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of n-word shingles. A text that is
    null or without words has an empty set and links with nothing; so does a document without an id, whose component is
    null. Equal sets always link. Repeated rows get equal values. Rows with one id and different texts are documents of their
    own, each with the links of its text. An empty table gives no rows; texts are read whole; other columns aren't read.
    """
    return _resolve(docs, n, percent, subparts, block).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, subparts: int | None = None, block: int = BLOCK) -> DataFrame:
    """Of each component one row: that of the smallest doc_id (of several texts under it, the one with the smallest hash).

    A row without links is a component; rows of one id whose texts aren't linked all stay, repeated rows stay once (if they
    differ in other columns, the one whose columns have the smallest hash). Documents without an id all stay.
    """
    found = _resolve(docs, n, percent, subparts, block).where("doc_id IS NOT NULL")
    alone = found.where("component IS NULL").select("doc_id", "text_key")
    kept = found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("k")).select("k.*")
    kept = stage(alone.union(kept).distinct().toDF("__kept", "__text"), "kept")
    others = F.xxhash64(*[c for c in docs.columns if c not in ("doc_id", "text")], F.lit(0))
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__of"), others.alias("__others"))
    left = keyed.join(kept, (F.col("__id") == F.col("__kept")) & (F.col("__of") == F.col("__text")), "left_semi")
    unique = left.groupBy("__id", "__of").agg(F.min_by("row", "__others").alias("row")).select("row.*")
    return unique.unionByName(docs.where("doc_id IS NULL"))


def components_sql(n: int, percent: int, docs: str = "documents") -> str:
    """DuckDB SQL for the rows of :func:`near_duplicate_components`, for small tables: it counts common shingles pairwise."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
    return f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM {docs}),
sets AS (SELECT doc_id, CASE WHEN len(w) >= {n} THEN list_distinct(list_transform(range(1, len(w) - {n - 2}), lambda i: {gram}))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
classes AS (SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
grams AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM classes),
links AS MATERIALIZED (SELECT a.rep AS a, b.rep AS b FROM grams a JOIN grams b ON a.g = b.g AND a.rep <> b.rep AND a.n * 100 >= b.n * {percent} AND b.n * 100 >= a.n * {percent}
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component, doc_id) AS component_id
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN least USING (rep)"""
