"""Prefix trie of conversations: what they share from their first turn on, by double arrays over sorted shards."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts_for, settle

#: Bytes that identify a turn; turns that decide the order of shards; bytes of turn keys in a shard; ids in a text to digest.
KEY, ORDER_TURNS, SHARD_BYTES, ID_PIECE = 16, 32, 8 << 20, 1 << 14

NOTHING = hashlib.sha256(b"").hexdigest()
ROOT = bytes(KEY)

_SEQ = "array<struct<key:binary,chars:int>>"


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, seq): the turns of every conversation in order, each as a key of its content and the code points of its text.

    Turns are ordered by number, missing numbers first; rows of equal number follow by their keys, repeated rows stay. Null role
    or text is empty. Rows without conversation are left out. Keys are the first 16 bytes of SHA-256 over role and text. Only keys
    travel; those of one conversation are one row.
    """
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.unhex(F.substring(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256), 1, 2 * KEY))
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).cast("long").alias("turn"), key.alias("key"), F.length(what).alias("chars")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.where("conv_id is not null").groupBy("conv_id").agg(ordered.alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["key"].alias("key"), t["chars"].alias("chars"))).alias("seq"))


def branched(seqs: DataFrame, base: Column, taken: Column, most: int) -> DataFrame:
    """(conv_id, seq): the first ``taken`` (``most`` at most) turns of conversation ``base``, then the own turns after as many.

    A base that is absent gives none. Only the heads of conversations that are a base travel.
    """
    own = settle(seqs.select("conv_id", "seq", base.alias("base"), taken.cast("int").alias("h")))
    wanted = own.select(F.col("base").alias("conv_id")).distinct()
    heads = own.select("conv_id", F.slice("seq", 1, most).alias("head")).join(wanted, "conv_id", "left_semi").withColumnRenamed("conv_id", "base")
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", F.array().cast(_SEQ)), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(F.array().cast(_SEQ))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("seq"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(path, ends_sha256): SHA-256 over the ids of every path, ascending, comma-joined.

    Sorted ranges join their ids to texts of ID_PIECE ids; a path's texts, not its ids, then meet in order and are digested as a
    stream. So a path with any share of the conversations is joined by many tasks.
    """
    def join(batches):
        part, number, path, ids = TaskContext.get().partitionId(), 0, None, []

        def out():
            nonlocal number
            number += 1
            return {"path": path, "part": part, "number": number, "ids": ",".join(map(str, ids))}
        for batch in batches:
            rows = []
            for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (p != path or len(ids) == ID_PIECE):
                    rows.append(out())
                    ids = []
                path = p
                ids.append(c)
            yield pa.RecordBatch.from_pylist(rows, pieces)
        if ids:
            yield pa.RecordBatch.from_pylist([out()], pieces)

    def digest(batches):
        path, state = None, None
        for batch in batches:
            done = []
            for p, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
                if p != path:
                    if state:
                        done.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["path", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["path", "ends_sha256"])

    pieces = pa.schema([("path", pa.binary()), ("part", pa.int32()), ("number", pa.int64()), ("ids", pa.string())])
    texts = ends.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").mapInArrow(join, "path binary, part int, number long, ids string")
    return texts.repartition("path").sortWithinPartitions("path", "part", "number").select("path", "ids").mapInArrow(digest, "path binary, ends_sha256 string")


class DoubleArray:
    """A trie packed into BASE and CHECK: state ``s`` goes by code ``c`` to BASE[s] + c if CHECK there is ``s``.

    The root is state 0. Codes count from 0; BASE may be negative.
    """

    def __init__(self, room: int):
        self.base, self.check = np.zeros(room + 1, np.int64), np.full(room + 1, -1, np.int64)
        self.check[0] = 0
        self.used = 1  # every state from here on is free
        self.lowest = 1  # every state before is taken

    def _need(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _place(self, state: int, codes: np.ndarray) -> None:
        """The children of one state: the first free places that fit all of them, else behind all taken ones."""
        shape = codes - codes[0]
        free = self.lowest + np.flatnonzero(self.check[self.lowest:min(self.used, self.lowest + 4096)] < 0)[:32]
        for first in free.tolist():
            self._need(first + int(shape[-1]) + 1)
            if (self.check[first + shape] < 0).all():
                break
        else:
            first = self.used
        self._need(first + int(shape[-1]) + 1)
        self.base[state] = first - codes[0]
        self.check[first + shape] = state
        self.used = max(self.used, first + int(shape[-1]) + 1)
        while self.lowest < self.used and self.check[self.lowest] >= 0:
            self.lowest += 1

    def _place_single(self, states: np.ndarray, codes: np.ndarray) -> None:
        """States with one child each take the next free places."""
        gaps = self.lowest + np.flatnonzero(self.check[self.lowest:self.used] < 0)[: len(states)]
        more = len(states) - len(gaps)
        self._need(self.used + more)
        places = np.concatenate([gaps, np.arange(self.used, self.used + more)])
        self.base[states] = places - codes
        self.check[places] = states
        self.used += more
        self.lowest = int(places[-1]) + 1 if more else int(gaps[-1]) + 1

    def add(self, states: np.ndarray, codes: np.ndarray) -> None:
        """All children of some states: distinct (state, code), sorted; a state's children come in one call."""
        first = np.concatenate([[True], states[1:] != states[:-1]])
        starts = np.flatnonzero(first)
        sizes = np.diff(np.concatenate([starts, [len(states)]]))
        for s, n in zip(starts[sizes > 1], sizes[sizes > 1]):
            self._place(int(states[s]), codes[s:s + n])
        if (sizes == 1).any():
            self._place_single(states[starts[sizes == 1]], codes[starts[sizes == 1]])

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states reached by a code each; -1 where there is none."""
        to = self.base[states] + codes
        inside = (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states) & (to > 0), to, -1)


class Shard:
    """The trie of some distinct sequences, with what it counts below every node."""

    def __init__(self, paths: list[bytes], chars: np.ndarray, weight: np.ndarray, smallest: np.ndarray):
        sizes = np.array([len(p) // KEY for p in paths], np.int64)
        turns, first, codes = np.unique(np.frombuffer(b"".join(paths), f"S{KEY}"), return_index=True, return_inverse=True)
        # Dense turn ids by first appearance, so turns of one place lie together.
        rank = np.empty(len(turns), np.int64)
        rank[np.argsort(first)] = np.arange(len(turns))
        codes = rank[codes.reshape(-1)]
        self.starts, self.sizes, self.codes = np.cumsum(sizes) - sizes, sizes, codes
        self.trie = DoubleArray(len(codes) + len(turns))
        self.levels = []  # (nodes of a depth)
        state, active = np.zeros(len(paths), np.int64), np.arange(len(paths))
        depth = 0
        while True:
            active = active[sizes[active] > depth]
            if not len(active):
                break
            code = codes[self.starts[active] + depth]
            pairs = np.unique(np.stack([state[active], code], 1), axis=0)
            self.trie.add(pairs[:, 0], pairs[:, 1])
            state[active] = self.trie.step(state[active], code)
            depth += 1
        self.deepest = depth
        room = len(self.trie.check)
        self.weight, self.smallest = np.zeros(room, np.int64), np.full(room, np.iinfo(np.int64).max)
        self.chars, self.end = np.zeros(room, np.int64), np.full(room, -1, np.int64)
        for at, active, states in self.walk():
            np.add.at(self.weight, states, weight[active])
            np.minimum.at(self.smallest, states, smallest[active])
            if at:
                self.chars[states] = chars[self.starts[active] + at - 1]
            last = sizes[active] == at
            self.end[states[last]] = active[last]
            self.levels.append(np.unique(states))
        self.children = np.zeros(room, np.int64)
        for nodes in self.levels[1:]:
            np.add.at(self.children, self.trie.check[nodes], 1)

    def walk(self):
        """(depth, sequences of at least that depth, their states), from the root down."""
        active, states = np.arange(len(self.sizes)), np.zeros(len(self.sizes), np.int64)
        for depth in range(self.deepest + 1):
            yield depth, active, states
            on = self.sizes[active] > depth
            active = active[on]
            states = self.trie.step(states[on], self.codes[self.starts[active] + depth])

    def below(self, shared: np.ndarray):
        """(leaves, saved) of every subtree; nodes that are ``shared`` with other shards count for nothing and pass nothing on."""
        leaves = np.where((self.children == 0) & ~shared, 1, 0)
        saved = np.where(shared, 0, (self.weight - 1) * self.chars)
        for nodes in self.levels[:0:-1]:
            nodes = nodes[~shared[nodes]]
            np.add.at(leaves, self.trie.check[nodes], leaves[nodes])
            np.add.at(saved, self.trie.check[nodes], saved[nodes])
        return leaves, saved


def _chain(path: bytes) -> list[bytes]:
    """Names of all prefixes of a path, the root's first."""
    names = [ROOT]
    for i in range(0, len(path), KEY):
        names.append(hashlib.sha256(names[-1] + path[i:i + KEY]).digest()[:KEY])
    return names


_NODE = pa.schema([("name", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                   ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("chars", pa.int64()), ("ends_sha256", pa.string())])
_NODE_DDL = ("name binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
             "saved_tokens long, chars long, ends_sha256 string")
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _shard_nodes(batches):
    """One sorted shard to its nodes. Those on its first and last path (``name`` set) may go on in the shards beside."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    paths = rows.column("keys").to_pylist()
    chars = rows.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.asarray(rows.column("ends_sha256").to_pylist(), object)
    shard = Shard(paths, chars, rows.column("n").to_numpy(), rows.column("conv_id").to_numpy())
    edge = {paths.index(min(paths)), paths.index(max(paths))}
    names: dict[int, tuple[bytes, bytes | None]] = {}
    for at in edge:
        chain, state = _chain(paths[at]), 0
        names[0] = (ROOT, None)
        for d in range(1, len(chain)):
            state = int(shard.trie.step(np.array([state]), shard.codes[shard.starts[at] + d - 1: shard.starts[at] + d])[0])
            names[state] = (chain[d], chain[d - 1])
    shared = np.zeros(len(shard.trie.check), bool)
    shared[list(names)] = True
    handed_on = np.bincount([shard.trie.check[s] for s in names if s], minlength=len(shared))
    leaves, saved = shard.below(shared)
    for depth, nodes in enumerate(shard.levels):
        for a in range(0, len(nodes), 1 << 14):
            some = nodes[a:a + (1 << 14)]
            up = shard.trie.check[some]
            mine = shared[some]
            # A shared parent's smallest member is known only after the merge; it is then looked up by its name.
            through = shared[up] & ~mine
            own_children = shard.children[some].copy()
            own_children[mine] -= handed_on[some[mine]]
            end = shard.end[some]
            yield pa.RecordBatch.from_arrays([
                pa.array([names[s][0] if m else None for s, m in zip(some.tolist(), mine)], pa.binary()),
                pa.array([names[s][1] if m else names[u][0] if t else None for s, u, m, t in zip(some.tolist(), up.tolist(), mine, through)], pa.binary()),
                pa.array(shard.smallest[some]), pa.array(np.full(len(some), depth)), pa.array(shard.smallest[up], mask=mine | through),
                pa.array(shard.weight[some]), pa.array(own_children), pa.array(leaves[some]), pa.array(saved[some]), pa.array(shard.chars[some]),
                pa.array([ends[e] if e >= 0 else None for e in end.tolist()], pa.string())], schema=_NODE)


def _merge(batches):
    """The nodes of all shard edges, deepest first: what lies below each is added to its parent."""
    below: dict[bytes, list[int]] = {}
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            children, leaves, saved = below.pop(row["name"], (0, 0, 0))
            row["n_children"] += children
            row["n_leaves"] += leaves + (row["n_children"] == 0)
            row["saved_tokens"] += saved + (row["n_convs"] - 1) * row["chars"]
            if row["parent"] is not None:
                up = below.setdefault(row["parent"], [0, 0, 0])
                up[0] += 1
                up[1] += row["n_leaves"]
                up[2] += row["saved_tokens"]
            out.append(row)
        yield pa.RecordBatch.from_pylist(out, _NODE)


def prefix_nodes(seqs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points that members need not repeat, over the subtree), ends_sha256 (digest of the ids that end there).

    ``seqs`` holds (conv_id, seq) as ``sequences`` gives it, a conversation once. No sequences, no nodes; empty ones end at the root.

    Equal sequences are one path with a weight. Paths in order are cut into shards, so a prefix with any share of the
    conversations spreads over many. A shard packs its dense turn ids into BASE and CHECK, and traverses them for its nodes. Only
    nodes on the first and the last path of a shard can go on beside it: those, two paths a shard, are merged in one small table,
    from the deepest up. Shards keep together what shares its first 32 turns.
    """
    spark = seqs.sparkSession
    keys = F.expr("array_join(transform(seq, t -> hex(t.key)), '')")
    members = settle(seqs.select("conv_id", F.unhex(keys).alias("keys"), F.expr("transform(seq, t -> t.chars)").alias("chars"),
                                 F.unhex(F.substring(F.sha2(F.unhex(keys), 256), 1, 2 * KEY)).alias("path")))
    paths = members.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.first("keys").alias("keys"), F.first("chars").alias("chars"))
    known = settle(paths.join(_end_digests(members.select("path", "conv_id")), "path").select("keys", "n", "conv_id", "chars", "ends_sha256"))
    shards = parts_for(known.agg(F.sum(F.octet_length("keys"))).first()[0], SHARD_BYTES, spark)
    ranges = known.repartitionByRange(shards, F.substring("keys", 1, KEY * ORDER_TURNS))
    found = settle(ranges.mapInArrow(_shard_nodes, _NODE_DDL))
    edges = found.where("name is not null").groupBy("name", "parent", "depth", "chars").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends_sha256").alias("ends_sha256"))
    edges = edges.withColumn("parent_conv_id", F.lit(None).cast("long")).select(_NODE.names)
    merged = settle(edges.coalesce(1).sortWithinPartitions(F.desc("depth")).mapInArrow(_merge, _NODE_DDL))
    up = merged.select(F.col("name").alias("parent"), F.col("conv_id").alias("up"))
    every = merged.unionByName(found.where("name is null"))
    looked_up = every.where("parent is not null").join(up, "parent").withColumn("parent_conv_id", F.col("up"))
    return every.where("parent is null").select(RESULT).unionByName(looked_up.select(RESULT)).fillna(NOTHING, "ends_sha256")


def prefix_trie(turns: DataFrame, **columns) -> DataFrame:
    """``prefix_nodes`` of the conversations as they are."""
    return prefix_nodes(sequences(turns, **columns))
