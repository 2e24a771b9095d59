"""The trie of conversation prefixes, by an LCP-aware external mergesort.

A turn is the 16-byte digest of its role and text, so a conversation is a byte string whose prefixes of whole turns are the
trie's nodes. Every map task sorts its conversations into runs that carry, with each entry, the number of leading turns it
shares with the entry before (its LCP), and stores only the rest. Runs are cut at common range bounds; the task of a range
merges its runs by a loser tree that compares LCPs first and looks only at turns beyond them. The merged stream drives a
stack of open nodes: an entry closes what it doesn't share with the one before, and a closed node knows its members,
children, leaves and saved tokens.

A node that lies in several ranges is a prefix of a range bound, and bounds are cut to :data:`BOUND_TURNS` turns. Ranges report
such nodes in parts, which one aggregation joins; all others are final where they are closed.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..staging import stage
from .rows import range_partitions

#: Bytes of a turn's digest and of its stored length.
KEY, SIZE = 16, 4
#: Conversations of a run and bytes of its keys, at most.
RUN_ROWS, RUN_BYTES = 50_000, 32_000_000
#: Bytes of keys that a range gets in the mean, keys that the bounds are drawn from, and turns of a bound, at most.
RANGE_BYTES, SAMPLE, BOUND_TURNS = 8_000_000, 20_000, 64
#: Bytes of ids that one row carries to its node's digest.
CHUNK = 1 << 20


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, keys, sizes): digests and code points of a conversation's turns, in order of turn (null first), role, text.

    Turns are range-partitioned in that order, so a conversation of any length is spread over as many tasks as it needs; each
    task packs its part, and the parts are put together. Rows without a conv_id are left out.
    """
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    keyed = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    ordered = keyed.repartitionByRange(range_partitions(turns), *order).sortWithinPartitions(*order)
    framed = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    packed = ordered.select("conv_id", F.unhex(F.md5(framed)).alias("key"), F.length("text").alias("size"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, keys, sizes = TaskContext.get().partitionId(), None, [], []

        def piece() -> pa.RecordBatch:
            columns = [pa.array([at], pa.int64()), pa.array([part], pa.int32()), pa.array([b"".join(keys)], pa.binary()), pa.array([np.array(sizes, "<u4").tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "keys", "sizes"])

        for batch in batches:
            for conv, key, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != at:
                    if at is not None:
                        yield piece()
                    at, keys, sizes = conv, [], []
                keys.append(key)
                sizes.append(size)
        if at is not None:
            yield piece()

    pieces = packed.mapInArrow(pack, "conv_id long, part int, keys binary, sizes binary")
    listed = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "keys", "sizes"))).alias("pieces"))
    joined = lambda name: F.aggregate("pieces", F.lit(b""), lambda all, piece: F.concat(all, piece[name]))
    return listed.select("conv_id", joined("keys").alias("keys"), joined("sizes").alias("sizes"))


def rebuilt(own: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % ``group``, h = crc32(c) % ``heads``."""
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    firsts = own.select(F.col("conv_id").alias("__base"), *(F.substring(c, 1, n * (heads - 1)).alias(f"__{c}") for c, n in (("keys", KEY), ("sizes", SIZE))))
    joined = own.withColumns({"__h": taken.cast("int"), "__base": F.expr(f"conv_id - conv_id % {group}")}).join(firsts, "__base", "left")

    def cut(name: str, width: int) -> Column:
        head = F.coalesce(F.substring(F.col(f"__{name}"), F.lit(1), F.col("__h") * width), F.lit(b""))
        return F.concat(head, F.substring(F.col(name), F.col("__h") * width + 1, F.octet_length(name))).alias(name)

    return joined.select("conv_id", cut("keys", KEY), cut("sizes", SIZE))


def shared_turns(one: bytes, two: bytes, known: int = 0) -> int:
    """Leading turns that two sequences have in common, ``known`` of which needn't be looked at."""
    at, end = known * KEY, min(len(one), len(two))
    step = KEY
    while at + step <= end and one[at : at + step] == two[at : at + step]:
        at += step
        step *= 2
    while step >= KEY:
        while at + step <= end and one[at : at + step] == two[at : at + step]:
            at += step
        step //= 2
    return at // KEY


class LoserTree:
    """Merges sorted runs of (lcp, rest of keys, rest of sizes, count, smallest id); yields the same with keys and sizes whole."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs, self.n = runs, len(runs)
        self.heads: list[tuple | None] = [None] * self.n
        #: Turns that a run's head shares with the entry given out last.
        self.lcp = [0] * self.n
        for r in range(self.n):
            self.advance(r, b"", b"")
        self.losers = [0] * self.n
        self.winner = self.build(1) if self.n > 1 else 0

    def advance(self, r: int, keys: bytes, sizes: bytes) -> None:
        entry = next(self.runs[r], None)
        if entry is None:
            self.heads[r] = None
            return
        lcp, more, more_sizes, count, smallest = entry
        self.heads[r] = (keys[: lcp * KEY] + more, sizes[: lcp * SIZE] + more_sizes, count, smallest)
        self.lcp[r] = lcp

    def build(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        win, self.losers[node] = self.play(self.build(2 * node), self.build(2 * node + 1))
        return win

    def play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two heads whose LCPs are with the same entry; the loser's becomes that with the winner."""
        if self.heads[a] is None or self.heads[b] is None:
            return (b, a) if self.heads[a] is None else (a, b)
        if self.lcp[a] != self.lcp[b]:  # the one that shares more with the last entry is the smaller
            return (a, b) if self.lcp[a] > self.lcp[b] else (b, a)
        one, two = self.heads[a][0], self.heads[b][0]
        shared = shared_turns(one, two, self.lcp[a])
        win, lose = (a, b) if one[shared * KEY : (shared + 1) * KEY] <= two[shared * KEY : (shared + 1) * KEY] else (b, a)
        self.lcp[lose] = shared
        return win, lose

    def __iter__(self) -> Iterator[tuple[int, bytes, bytes, int, int]]:
        while self.n and self.heads[self.winner] is not None:
            r = self.winner
            keys, sizes, count, smallest = self.heads[r]
            yield self.lcp[r], keys, sizes, count, smallest
            self.advance(r, keys, sizes)
            node = (r + self.n) // 2
            while node:
                r, self.losers[node] = self.play(r, self.losers[node])
                node //= 2
            self.winner = r


def one_run(rows: list[tuple[bytes, bytes, int]]) -> list[tuple[bytes, bytes, int, int]]:
    """(keys, sizes, count, smallest id), sorted; equal sequences are one entry."""
    rows.sort()
    out: list[tuple[bytes, bytes, int, int]] = []
    for keys, sizes, conv in rows:
        if out and out[-1][0] == keys:
            out[-1] = (keys, sizes, out[-1][2] + 1, min(conv, out[-1][3]))
        else:
            out.append((keys, sizes, 1, conv))
    return out


RUN = "range int, n int, lcps binary, counts binary, smallest binary, lengths binary, keys binary, sizes binary"


def packed_run(place: int, entries: list[tuple[bytes, bytes, int, int]]) -> list:
    """One row for a sorted run's part in a range: each entry is its LCP with the entry before, and the turns beyond."""
    lcps, lengths, keys, sizes, before = [], [], [], [], b""
    for key, size, _, _ in entries:
        lcp = shared_turns(before, key)
        lcps.append(lcp)
        keys.append(key[lcp * KEY :])
        sizes.append(size[lcp * SIZE :])
        lengths.append(len(keys[-1]) // KEY)
        before = key
    numbers = [np.array(c, "<i8").tobytes() for c in (lcps, [e[2] for e in entries], [e[3] for e in entries], lengths)]
    return [place, len(entries), *numbers, b"".join(keys), b"".join(sizes)]


def unpacked_run(n: int, lcps: bytes, counts: bytes, smallest: bytes, lengths: bytes, keys: bytes, sizes: bytes) -> Iterator[tuple]:
    at = 0
    for lcp, count, least, turns in zip(*(np.frombuffer(c, "<i8").tolist() for c in (lcps, counts, smallest, lengths)), strict=True):
        yield lcp, keys[at * KEY : (at + turns) * KEY], sizes[at * SIZE : (at + turns) * SIZE], count, least
        at += turns


def range_bounds(rows: DataFrame) -> list[bytes]:
    """Keys that cut the order into ranges of RANGE_BYTES in the mean, by a bounded sample; prefixes of BOUND_TURNS turns."""
    total, n = rows.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    drawn = rows.select("conv_id", F.substring("keys", 1, BOUND_TURNS * KEY).alias("keys")).orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLE)
    keys = sorted(drawn.select("keys").toArrow().column(0).to_pylist())
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)} - {b""}) if keys else []


def sorted_runs(rows: DataFrame, bounds: list[bytes]) -> DataFrame:
    """RUN rows: what each task's sorted runs hold for each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(wanted)
        held: list[tuple[bytes, bytes, int]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            entries = one_run(held)
            starts = [0, *(bisect.bisect_left(entries, (bound,)) for bound in bounds), len(entries)]
            for place, (start, end) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                if end > start:
                    row = packed_run(place, entries[start:end])
                    yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for conv, keys, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((keys, sizes, conv))
                size += len(keys)
                if len(held) >= RUN_ROWS or size >= RUN_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    wanted = StructType.fromDDL(RUN)
    return rows.select("conv_id", "keys", "sizes").mapInArrow(run, RUN)


NODE = (
    "bound_key binary, parent_key binary, path array<binary>, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, last_size long, ends_key binary, n_ends long"
)


def prefix_key(keys: bytes, depth: int) -> bytes:
    return hashlib.md5(keys[: depth * KEY]).digest() + depth.to_bytes(4, "big")


def range_nodes(merged: Iterator[tuple[int, bytes, bytes, int, int]], bounds: list[bytes]) -> Iterator[dict]:
    """The nodes of one range, closed by a stack, deepest first.

    A node that is a prefix of one of the range's ``bounds`` (or the root) may go on in another range: it carries a key, and
    its members, inner children, inner leaves and the inner nodes' saved tokens are parts. ``n_leaves`` and ``saved_tokens``
    of such nodes leave out themselves and other nodes with keys.
    """
    # Open nodes from the root: members, smallest id, children, leaves, saved tokens, size, ends, children that wait for its id.
    opened = [[0, None, 0, 0, 0, 0, 0, []]]
    before, limit = b"", 0

    def close(keys: bytes) -> Iterator[dict]:
        depth = len(opened) - 1
        n, smallest, children, leaves, saved, size, ends, waiting = opened.pop()
        shared = depth <= limit
        row = {"bound_key": None, "parent_key": None, "path": None, "conv_id": smallest, "depth": depth, "parent_conv_id": None, "n_convs": n,
               "n_children": children, "last_size": size, "ends_key": prefix_key(keys, depth) if ends else None, "n_ends": ends}
        if shared:
            row |= {"bound_key": prefix_key(keys, depth), "path": [prefix_key(keys, d) for d in range(depth)], "n_leaves": leaves, "saved_tokens": saved}
        else:
            row |= {"n_leaves": leaves if children else 1, "saved_tokens": saved + (n - 1) * size}
        for child in waiting:
            child["parent_conv_id"] = smallest
            yield child
        if depth:
            above = opened[-1]
            above[0] += n
            above[1] = smallest if above[1] is None else min(above[1], smallest)
            above[2] += not shared
            above[3] += row["n_leaves"]
            above[4] += row["saved_tokens"]
        if shared or depth - 1 <= limit:
            row["parent_key"] = prefix_key(keys, depth - 1) if depth else None
            yield row
        else:
            above[7].append(row)

    for lcp, keys, sizes, count, smallest in merged:
        while len(opened) - 1 > lcp:
            yield from close(before)
        # Turns of this entry that a bound shares; only nodes up to there can lie in other ranges.
        limit_here = max((shared_turns(keys, bound) for bound in bounds), default=0)
        turns = np.frombuffer(sizes, "<u4").tolist()
        for depth in range(lcp, len(keys) // KEY):
            opened.append([0, None, 0, 0, 0, turns[depth], 0, []])
        limit, before = limit_here, keys
        top = opened[-1]
        top[0] += count
        top[6] += count
        top[1] = smallest if top[1] is None else min(top[1], smallest)
    if opened[0][0] or len(opened) > 1:
        while opened:
            yield from close(before)


def nodes_by_range(runs: DataFrame, bounds: list[bytes]) -> DataFrame:
    """NODE rows of all ranges; a task holds the runs of one range at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(wanted)

        def merge(place: int, held: list[list]) -> Iterator[pa.RecordBatch]:
            edges = [bounds[i] for i in (place - 1, place) if 0 <= i < len(bounds)]
            out = []
            for node in range_nodes(iter(LoserTree([unpacked_run(*row) for row in held])), edges):
                out.append(node)
                if len(out) == 4096:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

        at, held = None, []
        for batch in batches:
            for place, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != at and held:
                    yield from merge(at, held)
                    held = []
                at = place
                held.append(row)
        if held:
            yield from merge(at, held)

    wanted = StructType.fromDDL(NODE)
    dealt = runs.repartition(len(bounds) + 1, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, NODE)


def joined_nodes(nodes: DataFrame) -> DataFrame:
    """All nodes, whole: those that several ranges report in parts are summed, then what lies between them is added."""
    # Row 1: all that ranges said of one node. Its own leaf and saved tokens can be told once its members are known.
    parts = nodes.where("bound_key IS NOT NULL").groupBy("bound_key").agg(
        F.first("parent_key").alias("parent_key"), F.first("path").alias("path"), F.first("depth").alias("depth"), F.first("last_size").alias("last_size"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_key").alias("ends_key"), F.sum("n_ends").alias("n_ends"),
    )
    parts = stage(parts, "bound-nodes")
    shared = parts.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("bound_key")).agg(F.count(F.lit(1)).alias("__children"))
    parts = parts.join(shared, "bound_key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("__children", F.lit(0)))
    own = parts.withColumns({"__leaf": (F.col("n_children") == 0).cast("long"), "__saved": (F.col("n_convs") - 1) * F.col("last_size")})
    # What ranges said of a node's insides already holds the insides of the nodes below; only these nodes' own shares are missing.
    up = own.select(F.explode(F.concat("path", F.array("bound_key"))).alias("bound_key"), "__leaf", "__saved")
    below = up.groupBy("bound_key").agg(F.sum("__leaf").alias("__leaves"), F.sum("__saved").alias("__tokens"))
    whole = parts.join(below, "bound_key").withColumns({"n_leaves": F.col("n_leaves") + F.col("__leaves"), "saved_tokens": F.col("saved_tokens") + F.col("__tokens")})
    fields = ["conv_id", "depth", "parent_key", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_key", "n_ends"]
    whole = whole.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*fields)
    every = whole.unionByName(nodes.where("bound_key IS NULL").select(*fields))
    smallest = parts.select(F.col("bound_key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    return every.join(smallest, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "__parent")).drop("__parent", "parent_key")


def end_digests(rows: DataFrame) -> DataFrame:
    """(ends_key, ends_sha256): the digest of the ids that end at a node, ascending, joined by commas.

    Ids are range-partitioned by node and id. A task digests the nodes it has whole and passes on the first and last node's
    ids as chunks of text, which one task a node then reads in order: one row for each CHUNK of bytes, never a list of all.
    """
    key = F.concat(F.unhex(F.md5("keys")), F.unhex(F.lpad(F.hex((F.octet_length("keys") / KEY).cast("int")), 8, "0")))
    ends = rows.select(key.alias("ends_key"), "conv_id")
    ordered = ends.repartitionByRange(range_partitions(ends), "ends_key", "conv_id").sortWithinPartitions("ends_key", "conv_id")
    schema = "ends_key binary, part int, chunk int, ids binary"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, n, held, size = TaskContext.get().partitionId(), None, 0, [], 0

        def row() -> pa.RecordBatch:
            columns = [pa.array([at], pa.binary()), pa.array([part], pa.int32()), pa.array([n], pa.int32()), pa.array([b",".join(held)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["ends_key", "part", "chunk", "ids"])

        for batch in batches:
            for key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (key != at or size >= CHUNK):
                    yield row()
                    held, size, n = [], 0, n + 1
                at = key
                held.append(b"%d" % conv)
                size += len(held[-1]) + 1
        if held:
            yield row()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            keys, found = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if key != at:
                    if at is not None:
                        keys.append(at)
                        found.append(state.hexdigest())
                    at, state = key, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["ends_key", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], names=["ends_key", "ends_sha256"])

    pieces = ordered.mapInArrow(chunks, schema)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(parts, "ends_key").sortWithinPartitions("ends_key", "part", "chunk").mapInArrow(digests, "ends_key binary, ends_sha256 string")


def build_trie(rows: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of the nodes of ``rows``,
    which are (conv_id, keys, sizes); conversations of no turns belong to the root only, and no rows give no nodes.

    A conversation's digests and sizes (20 bytes a turn) are one value, so a conversation has up to 100 million turns.
    """
    rows = stage(rows, "conversations")
    bounds = range_bounds(rows)
    nodes = stage(nodes_by_range(sorted_runs(rows, bounds), bounds), "trie-nodes")
    whole = joined_nodes(nodes).join(end_digests(rows), "ends_key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return whole.select(*columns, F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie (see :func:`build_trie`) of the rebuilt conversations (see :func:`rebuilt`) of (conv_id, turn, role, text).

    A null role or text is an empty one; rows with a null conv_id are left out; turns of one number stand in order of role and
    text, and repeated rows are turns of their own; other columns aren't read; an empty table gives no rows.
    """
    return build_trie(rebuilt(stage(sequences(turns), "own-turns")))


def trie_sql(group: int = 100, heads: int = 6) -> str:
    """DuckDB SQL of the rows of :func:`prefix_trie`; every node is compared with every other, so it is for small tables."""
    step = "lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"""WITH tab AS MATERIALIZED (SELECT list(list_reduce(range(8), {step}, i) ORDER BY i) AS tab FROM range(256) r(i)),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT DISTINCT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)) AS b FROM t),
c AS (SELECT conv_id, xor(list_reduce(b, lambda a, x: xor(a >> 8, tab[xor(a & 255, x) + 1]), 4294967295::BIGINT), 4294967295) % {heads} AS h FROM i, tab),
r AS (SELECT t.conv_id, n, role, txt FROM t JOIN c USING (conv_id) WHERE n > h
  UNION ALL SELECT c.conv_id, n, role, txt FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % {group} WHERE n <= h),
k AS MATERIALIZED (SELECT conv_id, row_number() OVER w AS depth, length(txt) AS size, string_agg(md5(length(role) || ':' || role || txt), '') OVER w AS path FROM r
  WINDOW w AS (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING) UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS MATERIALIZED (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved FROM k GROUP BY path, depth),
p AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
s AS (SELECT n.path, sum((b.path IS NULL)::BIGINT)::BIGINT AS n_leaves, sum(d.saved)::BIGINT AS saved_tokens
  FROM n JOIN n d ON starts_with(d.path, n.path) LEFT JOIN p b ON b.path = d.path GROUP BY n.path),
e AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM (SELECT conv_id, arg_max(path, depth) AS path FROM k GROUP BY conv_id) GROUP BY path)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(p.n_children, 0) AS n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n JOIN s ON s.path = n.path LEFT JOIN p ON p.path = n.path LEFT JOIN e ON e.path = n.path LEFT JOIN n u ON n.depth > 0 AND u.path = left(n.path, length(n.path) - 32)"""
