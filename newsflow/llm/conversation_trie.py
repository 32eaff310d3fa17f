"""Prefix trie of conversations from sorted turn sequences: LCPs, a sparse table, and binary searches for member intervals.

A turn is a 128-bit hash of its role and text. Conversations are sorted by their turns, so the members of every common
prefix are neighbours. ``lcp[i]`` is how many turns row i shares with the row before it: row i begins exactly the nodes
of depths ``lcp[i] + 1`` to its length. A sparse table holds the minima of all runs of 1, 2, 4.. LCPs; with it each node
finds the first and last row of an interval by binary search, independently of all others, without a stack. Sums over a
subtree are differences of running sums: ``P[i]``, the bytes of the first ``lcp[i]`` turns of row i, gives the bytes that
the rows of an interval share with the row before them, which is what storing a node once saves.

For large inputs:
- Rows are range-partitioned by their turns and conversation, so equal conversations, and a first turn that most of them
  share, spread over many slices. Each slice knows the last row before it and the first row after it. Only prefixes that
  cross a border (as many as a block has turns at most) are sent on as partial results, merged by prefix, and sent back.
- A conversation is cut into blocks of ``BLOCK`` turns, and block k is sorted among the blocks with the same turns before
  it, so no row grows with its conversation. Neighbouring blocks overlap by a turn: block k yields the nodes of depths
  k * BLOCK to (k + 1) * BLOCK - 1 and holds their parents and children. What lies below a block is added to the row of its
  smallest member in the blocks above.
- Ids of conversations that end in a node lie together in order. Only where they cross slices are they sorted once more
  by node and streamed through a digest, one batch at a time (a digest has no parts that could be merged).

Defined cases: rows without conv_id belong to no conversation and are left out. A null turn comes first; turns that tie
are ordered by the hash of role and text, so results do not depend on arrival; repeated rows are turns each. A null role
or text is empty, and ("a", "b") differs from ("", "ab"). A conversation may have no turns. Very long conversations are many
blocks, very long texts are hashed where they are read. An empty table gives no nodes. Extra columns of the input are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.tables import broadcast_up_to, materialize
from newsflow.operators.totals import running_total

BLOCK = 256
SLICE_TURNS = 400_000
SALT_TURNS = 4096
BROADCAST_ROWS = 200_000
WIDTH = 16  # bytes of a turn's hash


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, n, digest, bytes): the turns of each conversation in order, counted from 0, and how many there are."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.lit(1).alias("one"),
    )
    stored = materialize(turns, "turns")
    return running_total(stored, ["conv_id"], ["turn", "digest"], "one", "at", total="n").select("conv_id", "at", "n", "digest", "bytes")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, t, digest, bytes) from turn 1 on, and (conv_id, length)."""
    return turns.select("conv_id", (F.col("at") + 1).alias("t"), "digest", "bytes"), turns.filter("at = 0").select("conv_id", F.col("n").alias("length"))


def regrown(turns: DataFrame, family: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that continue others: c begins with the first h turns of c - c % ``family``, and goes on with its own after its first h.

    h is the checksum of c modulo ``most`` + 1. A head that is missing or short is taken as far as it goes.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    elder = F.col("conv_id") - F.col("conv_id") % family
    first = turns.filter(F.col("at") < most).filter(F.col("conv_id") % family == 0)
    heads = first.groupBy(F.col("conv_id").alias("elder")).agg(F.sort_array(F.collect_list(F.struct("at", "digest", "bytes"))).alias("head"))
    ids = turns.filter("at = 0").select("conv_id", "n", h.alias("h"), elder.alias("elder"))
    none = F.array().cast(heads.schema["head"].dataType)
    grown = ids.join(heads, "elder", "left").withColumn("head", F.slice(F.coalesce("head", none), F.lit(1), F.col("h").cast("int")))
    added = grown.withColumn("added", F.size("head").cast("long")).withColumn("length", F.col("added") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    stored = materialize(added.select("conv_id", "n", "added", "head", "length"), "heads")
    # One row per so many turns of a conversation, so that a long one is no single key of the join.
    salted = stored.select("conv_id", "added", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {SALT_TURNS}"))).alias("salt"))
    own = turns.filter(F.col("at") >= h).withColumn("salt", F.expr(f"at div {SALT_TURNS}")).join(salted, ["conv_id", "salt"])
    own = own.select("conv_id", (F.col("at") - h + F.col("added") + 1).alias("t"), "digest", "bytes")
    head = stored.select("conv_id", F.posexplode("head").alias("p", "turn")).select("conv_id", (F.col("p") + 1).cast("long").alias("t"), "turn.digest", "turn.bytes")
    return own.union(head), stored.select("conv_id", "length")


def _blocks(turns: DataFrame, lengths: DataFrame, block: int) -> DataFrame:
    """(conv_id, k, grp, key, sizes): the turns of each block, and a hash of all turns before it."""
    k = F.expr(f"t div {block}")
    cells = F.when(F.col("t") % block == 0, F.array(k - 1, k)).otherwise(F.array(k))
    filled = turns.select("conv_id", F.explode(cells).alias("k"), "t", "digest", "bytes")
    # A block without turns stands for a conversation that ends just before it, or that has none at all.
    ends = F.array_compact(F.array(F.when(F.col("length") == 0, F.lit(0).cast("long")), F.when((F.col("length") + 1) % block == 0, F.expr(f"(length + 1) div {block}"))))
    bare = lengths.select("conv_id", F.explode(ends).alias("k"), F.lit(None).cast("long").alias("t"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("bytes"))
    own = k == F.col("k")
    sums = [F.coalesce(F.sum(F.when(own, F.xxhash64(F.lit(seed), "t", "digest").cast("decimal(38,0)"))), F.lit(0).cast("decimal(38,0)")).alias(f"p{seed}") for seed in (1, 2)]
    listed = F.sort_array(F.collect_list(F.when(F.col("t").isNotNull(), F.struct("t", F.hex("digest").alias("digest"), "bytes"))))
    made = filled.union(bare).groupBy("conv_id", "k").agg(listed.alias("turns"), *sums)
    key, sizes = F.unhex(F.array_join("turns.digest", "")), F.col("turns.bytes")
    stored = materialize(made.select("conv_id", "k", key.alias("key"), sizes.alias("sizes"), "p1", "p2"), "blocks")
    head = stored.filter("k = 0").select("conv_id", "k", F.lit("").alias("grp"), "key", "sizes")
    before = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations with a second block take part in the running sums.
    longer = stored.filter("k > 0").select("conv_id").distinct()
    narrow = stored.select("conv_id", "k", "p1", "p2").join(longer, "conv_id", "left_semi")
    summed = narrow.select("conv_id", "k", F.concat(F.sum("p1").over(before).cast("string"), F.lit("/"), F.sum("p2").over(before).cast("string")).alias("grp")).filter("k > 0")
    tail = stored.filter("k > 0").select("conv_id", "k", "key", "sizes").join(summed, ["conv_id", "k"])
    return head.union(tail.select(head.columns))


def _neighbours(stored: DataFrame) -> DataFrame:
    """Per slice: the last row of the one before, and the first row of the one after."""
    row = F.struct("k", "grp", "key")
    ends = materialize(stored.groupBy("slice").agg(F.min_by(row, "at").alias("first"), F.max_by(row, "at").alias("last")), "slice-ends")
    # Numbers of slices only: as many as there are partitions.
    order = Window.orderBy("slice")
    around = ends.select("slice", F.lag("slice").over(order).alias("p"), F.lead("slice").over(order).alias("q"))
    before = ends.select(F.col("slice").alias("p"), F.col("last").alias("before"))
    after = ends.select(F.col("slice").alias("q"), F.col("first").alias("after"))
    return around.join(before, "p", "left").join(after, "q", "left").select("slice", "before", "after")


def _shared(a: dict | None, b: dict | None) -> int:
    """Turns that two rows share, -1 if they are of different groups."""
    if a is None or b is None or (a["k"], a["grp"]) != (b["k"], b["grp"]):
        return -1
    x, y = (np.frombuffer(r["key"], f"V{WIDTH}") for r in (a, b))
    m = min(len(x), len(y))
    differ = np.flatnonzero(x[:m] != y[:m])
    return int(differ[0]) if len(differ) else m


class Slice:
    """Sorted rows of one slice with their LCPs, the sparse tables and the running sums."""

    def __init__(self, table: pa.Table, info: pa.Table, block: int):
        table = table.take(pa.compute.sort_indices(table["at"])).combine_chunks()
        self.block, self.n = block, table.num_rows
        self.conv, self.k = table["conv_id"].to_numpy(), table["k"].to_numpy()
        self.grp, self.key = table["grp"].to_pylist(), table["key"].to_pylist()
        extra = [table[c].to_numpy() if c in table.column_names else np.zeros(self.n, np.int64) for c in ("extra_leaves", "extra_saved")]
        self.len = np.array([len(x) // WIDTH for x in self.key], np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.len)])
        self.info = info.to_pylist()[0]
        self.lcp = self._lcps()
        self.after = _shared(self._row(-1), self.info["after"])
        self.low = self._powers(self.lcp)
        self.least = self._powers(self.conv)
        # Bytes of the turns whose nodes belong to the block: all but one at the end of a full block.
        sizes = table["sizes"].combine_chunks().flatten().to_numpy() if self.off[-1] else np.zeros(0, np.int64)
        place = np.arange(self.off[-1]) - np.repeat(self.off[:-1], self.len)
        full = np.repeat(np.where(self.k == 0, block - 1, block), self.len)
        self.cum = np.concatenate([[0], np.cumsum(np.where(place < full, sizes, 0))])
        following = np.append(self.lcp[1:], self.after)
        final = np.where(self.k == 0, self.len <= block - 1, (self.len >= 1) & (self.len <= block))
        self.leaves = _running((final & (following < self.len)).astype(np.int64) + extra[0])
        self.extra = _running(extra[1])
        self.common = _running(self._bytes(np.arange(self.n), np.maximum(self.lcp, 0)))
        born = np.flatnonzero(self.len > self.lcp)
        self.span = block + 3  # more than any LCP
        self.born = np.sort((self.lcp[born] + 1) * (self.n + 1) + born)

    def _row(self, i: int) -> dict:
        return {"k": int(self.k[i]), "grp": self.grp[i], "key": self.key[i]}

    def _lcps(self) -> np.ndarray:
        turns = np.frombuffer(b"".join(self.key), np.uint64).reshape(-1, 2)
        same = np.array([False, *(a == b for a, b in zip(self.grp[1:], self.grp, strict=False))]) & np.concatenate([[False], self.k[1:] == self.k[:-1]])
        m = np.where(same, np.minimum(self.len, np.concatenate([[0], self.len[:-1]])), 0)
        pair = np.repeat(np.arange(self.n), m)
        x = np.arange(len(pair)) - np.repeat(np.cumsum(m) - m, m)
        differ = (turns[self.off[pair] + x] != turns[self.off[np.maximum(pair - 1, 0)] + x]).any(1)
        at, first = np.unique(pair[differ], return_index=True)
        out = np.where(same, m, -1)
        out[at] = x[differ][first]
        out[0] = _shared(self.info["before"], self._row(0))
        return out

    @staticmethod
    def _powers(values: np.ndarray) -> list[np.ndarray]:
        """Minima of all runs of 1, 2, 4.. values."""
        tables = [values]
        while 2 << len(tables) - 1 <= len(values):
            half = 1 << len(tables) - 1
            tables.append(np.minimum(tables[-1][:-half], tables[-1][half:]))
        return tables

    def _bytes(self, rows: np.ndarray, turns: np.ndarray) -> np.ndarray:
        return self.cum[self.off[rows] + turns] - self.cum[self.off[rows]]

    def last(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last row that shares ``depth`` turns with each of ``rows``."""
        at = rows.copy()
        for s in reversed(range(len(self.low))):
            table = self.low[s]
            fits = (at + (1 << s) < self.n) & (table[np.minimum(at + 1, len(table) - 1)] >= depth)
            at += fits.astype(np.int64) << s
        return at

    def first(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First row that shares ``depth`` turns with each of ``rows``."""
        at = rows.copy()
        for s in reversed(range(len(self.low))):
            table = self.low[s]
            start = at - (1 << s)
            fits = (start >= 0) & (table[np.clip(start + 1, 0, len(table) - 1)] >= depth)
            at -= fits.astype(np.int64) << s
        return at

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least conversation of each range of rows."""
        size = high - low + 1
        level = np.frexp(size)[1] - 1
        out = np.empty(len(low), np.int64)
        for s in np.unique(level):
            on = level == s
            table = self.least[s]
            out[on] = np.minimum(table[low[on]], table[high[on] - (1 << s) + 1])
        return out

    def sums(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        """What the rows ``low`` to ``high`` add to their common node; ``begins``: whether the node begins with the first of them."""
        code = (depth + 1) * (self.n + 1)
        children = np.searchsorted(self.born, code + high, "right") - np.searchsorted(self.born, code + low, "left")
        # A first row that begins the node begins a child too if it goes on, whatever its LCP.
        deeper = begins & (self.len[low] > depth) & (self.lcp[low] < depth)
        others = high - low + ~begins
        skipped = np.where(begins, low + 1, low)
        common = self.common[high + 1] - self.common[skipped] - others * self._bytes(low, np.maximum(depth - 1, 0))
        return {
            "n_convs": high - low + 1,
            "conv_id": self.smallest(low, high),
            "n_children": children + deeper,
            "n_leaves": self.leaves[high + 1] - self.leaves[low],
            "saved_tokens": common + self.extra[high + 1] - self.extra[low],
        }

    def crossing(self) -> list[dict]:
        """Prefixes that the first row shares with the slice before, or the last one with the slice after, and what is known of them here."""
        found = []
        for side, row, top in (("left", 0, self.lcp[0]), ("right", self.n - 1, self.after)):
            depth = np.arange(top + 1)
            rows = np.full(len(depth), row)
            low, high = self.first(rows, depth), self.last(rows, depth)
            # A prefix that fills the slice from both sides is counted on the left.
            open_left, open_right = (low == 0) & (depth <= self.lcp[0]), (high == self.n - 1) & (depth <= self.after)
            known = self.sums(low, high, depth, ~open_left)
            for j in range(len(depth)):
                one = {name: int(v[j]) for name, v in known.items()}
                if side == "right" and open_left[j]:
                    one = {name: one[name] if name == "conv_id" else 0 for name in one}
                found.append({"side": side, "e": j, "node": self.name(row, j), **one})
        return found

    def name(self, row: int, depth: int) -> bytes:
        return hashlib.md5(f"{self.k[row]} {self.grp[row]} {depth} ".encode() + self.key[row][: depth * WIDTH], usedforsecurity=False).digest()


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


VALUES = ("n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens")
_EDGE = pa.schema([("slice", pa.int64()), ("side", pa.string()), ("e", pa.int64()), ("node", pa.binary()), *((v, pa.int64()) for v in VALUES)])
_EDGE_DDL = "slice long, side string, e long, node binary, " + ", ".join(f"{v} long" for v in VALUES)


def _edges(block: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _EDGE.empty_table()
        rows = Slice(left, right, block).crossing()
        return pa.Table.from_pylist([{"slice": left["slice"][0].as_py(), **r} for r in rows], _EDGE)

    return run


_GROUP = pa.schema([("k", pa.int64()), ("grp", pa.string()), ("conv_id", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])


def _group_totals(block: int):
    """Leaves and saved bytes of the groups of later blocks, as far as a slice holds them."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _GROUP.empty_table()
        rows = Slice(left, right, block)
        low = np.flatnonzero(np.concatenate([[True], rows.lcp[1:] < 0]))
        high = np.append(low[1:] - 1, rows.n - 1)
        got = rows.sums(low, high, np.zeros(len(low), np.int64), rows.lcp[low] < 0)
        return pa.table([pa.array(rows.k[low]), pa.array([rows.grp[i] for i in low]), *(pa.array(got[c]) for c in ("conv_id", "n_leaves", "saved_tokens"))], schema=_GROUP)

    return run


_NODE = pa.schema([*((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()), ("node", pa.binary()), ("member", pa.int64())])
_NODE_DDL = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node binary, member long"


def _nodes(block: int):
    """The nodes that begin in a slice, and the members of runs of equal conversations that cross its borders."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _NODE.empty_table()
        rows = Slice(left, right, block)
        known = {side: {e["e"]: e for e in rows.info["edges"] or [] if e["side"] == side} for side in ("left", "right")}

        def resolved(side: str, depth: np.ndarray, name: str) -> np.ndarray:
            return np.array([known[side][d][name] for d in depth.tolist()], np.int64)

        count = rows.len - rows.lcp
        at = np.repeat(np.arange(rows.n), count)
        e = rows.lcp[at] + 1 + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        own = np.where(rows.k[at] == 0, e < block, (e >= 1) & (e <= block))
        at, e = at[own], e[own]
        high = rows.last(at, e)
        out = rows.sums(at, high, e, np.ones(len(at), bool))
        crosses = (high == rows.n - 1) & (e <= rows.after)
        for name in VALUES:
            out[name][crosses] = resolved("right", e[crosses], name)

        # The parent's interval, whichever row begins it.
        up = np.maximum(e - 1, 0)
        first, last = rows.first(at, up), rows.last(at, up)
        parent = rows.smallest(first, last)
        to_left = (first == 0) & (up <= rows.lcp[0])
        to_right = (last == rows.n - 1) & (up <= rows.after) & ~to_left
        parent[to_left], parent[to_right] = resolved("left", up[to_left], "conv_id"), resolved("right", up[to_right], "conv_id")
        depth = np.where(rows.k[at] == 0, e, rows.k[at] * block - 1 + e)

        # Conversations that end in a node are the first rows of its interval.
        ended = np.flatnonzero(np.append((rows.len[1:] != rows.len[:-1]) | (rows.lcp[1:] != rows.len[1:]), True))
        stop = ended[np.searchsorted(ended, at)] + 1
        stop = np.where(rows.len[at] == e, stop, at)
        follower = rows.info["after"]
        over = (stop == rows.n) & (rows.len[at] == e) & (rows.after == e) & bool(follower and len(follower["key"]) == rows.len[-1] * WIDTH)
        sha = [None if o else hashlib.sha256(",".join(map(str, rows.conv[a:b].tolist())).encode()).hexdigest() for a, b, o in zip(at.tolist(), stop.tolist(), over.tolist(), strict=True)]
        node = [rows.name(a, int(d)) if o else None for a, d, o in zip(at.tolist(), e.tolist(), over.tolist(), strict=True)]

        members = [(rows.name(a, int(d)), rows.conv[a:].tolist()) for a, d, o in zip(at.tolist(), e.tolist(), over.tolist(), strict=True) if o]
        leader = rows.info["before"]
        if leader and rows.lcp[0] == rows.len[0] and len(leader["key"]) == rows.len[0] * WIDTH:
            members.append((rows.name(0, int(rows.len[0])), rows.conv[: int(ended[0]) + 1].tolist()))
        more = [(name, c) for name, convs in members for c in convs]
        pad = len(more)
        columns = {"conv_id": out["conv_id"], "depth": depth, "n_convs": out["n_convs"], "n_children": out["n_children"], "n_leaves": out["n_leaves"], "saved_tokens": out["saved_tokens"]}
        arrays = {name: pa.array([*v.tolist(), *[None] * pad], pa.int64()) for name, v in columns.items()}
        arrays["parent_conv_id"] = pa.array([*(None if d == 0 else p for d, p in zip(depth.tolist(), parent.tolist(), strict=True)), *[None] * pad], pa.int64())
        arrays["ends_sha256"] = pa.array([*sha, *[None] * pad], pa.string())
        arrays["node"] = pa.array([*node, *(m[0] for m in more)], pa.binary())
        arrays["member"] = pa.array([*[None] * len(at), *(m[1] for m in more)], pa.int64())
        return pa.table([arrays[f.name] for f in _NODE], schema=_NODE)

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the members of each node, from rows sorted by node and member."""
    node, digest = None, None
    for batch in batches:
        done = []
        names = batch["node"].to_pylist()
        members = batch["member"].to_pylist()
        low = 0
        for high in range(1, len(names) + 1):
            if high == len(names) or names[high] != names[low]:
                text = ",".join(map(str, members[low:high]))
                if names[low] != node:
                    done += [(node, digest.hexdigest())] if digest else []
                    node, digest = names[low], hashlib.sha256()
                else:
                    text = "," + text
                digest.update(text.encode())
                low = high
        yield _two(done)
    if digest:
        yield _two([(node, digest.hexdigest())])


def _two(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "sha"])


def prefix_trie(turns: DataFrame, lengths: DataFrame, *, block: int = BLOCK, slices: int | None = None) -> DataFrame:
    """One row per distinct prefix of ``turns`` (conv_id, t, digest, bytes), from the root of no turns; ``lengths`` (conv_id, length) names all conversations.

    conv_id: smallest member; depth: turns; parent_conv_id: that of the prefix without its last turn; n_convs: members;
    n_children, n_leaves: prefixes one turn longer, and those in its subtree that no conversation continues; saved_tokens: bytes
    saved in its subtree by storing each prefix's last turn once; ends_sha256: digest of the members that end here.
    """
    rows = materialize(_blocks(turns, lengths, block), "block-rows")
    if slices is None:
        total = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
        slices = max(total // SLICE_TURNS + 1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["k", "grp", "key", "conv_id"]
    placed = rows.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    stored = materialize(placed.withColumn("slice", F.shiftright("at", 33)), "sorted-blocks")
    around = materialize(_neighbours(stored), "neighbours")

    later = stored.filter("k > 0")
    if not later.isEmpty():
        stored = _with_lower_blocks(stored, later, around, block)
    by_slice = around.groupBy("slice")
    edges = materialize(stored.groupBy("slice").cogroup(by_slice).applyInArrow(_edges(block), _EDGE_DDL), "edges")
    merged = edges.groupBy("node").agg(*[(F.min if v == "conv_id" else F.sum)(v).alias(v) for v in VALUES])
    back = edges.select("slice", "side", "e", "node").join(merged, "node")
    listed = back.groupBy("slice").agg(F.collect_list(F.struct("side", "e", *VALUES)).alias("edges"))
    told = materialize(around.join(listed, "slice", "left"), "told")
    out = materialize(stored.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(_nodes(block), _NODE_DDL), "nodes")

    members = out.filter("member IS NOT NULL").select("node", "member")
    hashed = members.repartition("node").sortWithinPartitions("node", "member").mapInArrow(_digested, "node binary, sha string")
    nodes = out.filter("member IS NULL")
    waiting = nodes.filter("node IS NOT NULL").join(hashed, "node").withColumn("ends_sha256", F.col("sha"))
    columns = _NODE.names[:8]
    return nodes.filter("node IS NULL").select(columns).union(waiting.select(columns))


def _with_lower_blocks(stored: DataFrame, later: DataFrame, around: DataFrame, block: int) -> DataFrame:
    """Add ``extra_leaves`` and ``extra_saved``: what lies in later blocks, at the row of their smallest conversation in each block above."""
    parts = later.groupBy("slice").cogroup(around.groupBy("slice")).applyInArrow(_group_totals(block), "k long, grp string, conv_id long, n_leaves long, saved_tokens long")
    totals = parts.groupBy("k", "grp").agg(F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    stood = materialize(totals.groupBy("conv_id", "k").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "lower-blocks")
    above = stored.select("conv_id", "k").join(stood.select("conv_id").distinct(), "conv_id", "left_semi").join(stood, ["conv_id", "k"], "left")
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    added = above.select("conv_id", "k", F.sum("leaves").over(deeper).alias("extra_leaves"), F.sum("saved").over(deeper).alias("extra_saved"))
    extra = broadcast_up_to(materialize(added.filter("extra_leaves <> 0 OR extra_saved <> 0"), "extra"), BROADCAST_ROWS)
    return materialize(stored.join(extra, ["conv_id", "k"], "left").fillna(0, ["extra_leaves", "extra_saved"]), "block-rows")
