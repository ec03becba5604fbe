"""Conversation prefix trie: which conversations begin alike, and what sharing those turns would save.

Conversations become sequences of turn codes (128-bit digests of role and text),
in chunks of at most ``chunk`` turns whose root is a digest of all turns before.
Sequences are range-partitioned and sorted; a task cuts its sorted stream into
shards of bounded size and builds of each a ternary search tree over
dictionary-encoded codes, the distinct sequences inserted median first, so the
tree is balanced.  A traversal by a stack accumulates members, children, leaves
and savings.  Nodes that no other shard can hold are final.  Those on the path of
a shard's first or last sequence, or of a sequence that goes on in a next chunk,
are boundary nodes: their parts are summed by key, and the sums of their subtrees
are formed by doubling the distance over which values are added up, so that even
a conversation that holds a third of all rows takes log(length) joins and no task
ever holds it.  The digest of the members that end at a boundary node is made by
streaming their ids in order.

Defined cases: turns are ordered by turn (null first), role and digest of the
text; null roles and texts are empty; repeated rows are turns of their own; rows
without conv_id belong to no conversation and are no part of the trie; an empty
table has no node, not even a root.  Columns beside the four are not read.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidalrec.llm.common import Scratch, load

CODE = 16  # bytes of a turn's code
_FINAL, _OPEN, _ENDS = 0, 1, 2


@dataclass(frozen=True)
class TrieLimits:
    """What a task holds at once: turns of a chunk, rows and turns of a shard."""
    chunk: int = 256
    shard_rows: int = 20_000
    shard_turns: int = 400_000


# ---- turns and their places --------------------------------------------------


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, code, words; a code is the hex digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("code"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))


_PLACED = "part int, conv_id long, pos long, code string, words int, bound boolean"


def _count_places(batches):
    """Places of sorted turns within their conversation, as far as the partition knows.

    ``part`` is set on the rows of the partition's first conversation, which may
    have begun earlier.  Bound rows tell how many turns its first and its last one have here.
    """
    part, conv, seen, opening = TaskContext.get().partitionId(), None, 0, True
    schema = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("pos", pa.int64()), ("code", pa.string()),
                        ("words", pa.int32()), ("bound", pa.bool_())])

    def bound():
        return pa.RecordBatch.from_pylist([{"part": part, "conv_id": int(conv), "pos": seen, "bound": True}], schema)

    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column("conv_id").to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        pos, first = np.empty(len(ids), np.int64), np.zeros(len(ids), bool)
        for at, to in zip(cuts, [*cuts[1:], len(ids)]):
            if conv is not None and ids[at] != conv:
                if opening:
                    yield bound()
                opening, seen = False, 0
            conv = ids[at]
            pos[at:to] = np.arange(seen, seen + to - at)
            first[at:to] = opening
            seen += int(to - at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), part, np.int32), mask=~first), pa.array(ids), pa.array(pos), b.column("code"),
             b.column("words"), pa.array(np.zeros(len(ids), bool))], schema=schema)
    if conv is not None:
        yield bound()


def place_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, pos, code, words: turns numbered from 0, a long conversation over as many tasks as it takes."""
    order = ["conv_id", "turn", "role", "code"]
    placed = scratch.put(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_count_places, _PLACED))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # at most two rows for each partition
    offsets = placed.where("bound").select("part", "conv_id", F.coalesce(F.sum("pos").over(before), F.lit(0)).alias("offset"))
    rows = placed.where("not bound")
    moved = rows.where("part is not null").join(F.broadcast(offsets), ["part", "conv_id"]).withColumn(
        "pos", F.col("pos") + F.col("offset"))
    columns = ["conv_id", "pos", "code", "words"]
    return rows.where("part is null").select(columns).unionByName(moved.select(columns))


def rebuild(placed: DataFrame, block: int = 20, lent: int = 4) -> DataFrame:
    """conv_id, idx, code, words: the first h turns of the block's first conversation, then the own ones after h.

    h is crc32 of the id modulo ``lent``.  A conversation without turns has one row of idx -1, and so has every other.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % lent
    base = F.col("conv_id") - F.col("conv_id") % block
    heads = placed.where((F.col("pos") < lent - 1) & (F.col("conv_id") == base)).select(
        F.col("conv_id").alias("base"), "pos", "code", "words")
    convs = placed.where("pos = 0").select("conv_id", base.alias("base"), h.alias("h"))
    borrowed = convs.where("h > 0").join(heads, "base").where("pos < h").select(
        "conv_id", F.col("pos").alias("idx"), "code", "words")
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    short = convs.where("h > 0").join(lengths, "base", "left").where(F.coalesce("n", F.lit(0)) < F.col("h")).select(
        "conv_id", (F.col("h") - F.coalesce("n", F.lit(0))).alias("less"))
    # a base that is too short lends less, and the own turns move up
    own = placed.where(F.col("pos") >= h).join(short, "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("idx"), "code", "words")
    mark = convs.select("conv_id", F.lit(-1).cast("long").alias("idx"), F.lit("").alias("code"), F.lit(0).alias("words"))
    return borrowed.unionByName(own).unionByName(mark)


# ---- sequences -----------------------------------------------------------------


def sequences(turns: DataFrame, chunk: int) -> DataFrame:
    """conv_id, level, r1, r2, s1, s2, more, codes, words: a row for each chunk of a conversation.

    ``turns`` has conv_id, idx, code, words and a mark of idx -1 for each conversation.  (r1, r2) tells
    what came before the chunk, (s1, s2) that and the chunk; ``more`` whether another follows.
    """
    level = F.when(F.col("idx") < 0, F.lit(0)).otherwise(F.floor(F.col("idx") / chunk)).cast("long")
    rows = turns.groupBy("conv_id", level.alias("level")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "code", "words"))).alias("t"))
    t = F.filter("t", lambda x: x["idx"] >= 0)
    rows = rows.select("conv_id", "level", t.alias("t")).select(
        "conv_id", "level", F.unhex(F.array_join("t.code", "")).alias("codes"), F.col("t.words").alias("words"))
    zero = F.lit(0).cast("long")
    long = (F.col("level") > 0) | (F.size("words") >= chunk)
    by = W.partitionBy("conv_id").orderBy("level")
    before, upto = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(W.unboundedPreceding, 0)
    hashed = rows.where(long).withColumn("x1", F.xxhash64("level", "codes")).withColumn(
        "x2", F.xxhash64(F.lit("second"), "level", "codes"))
    columns = ["conv_id", "level", "r1", "r2", "s1", "s2", "more", "codes", "words"]
    chained = hashed.select(
        "conv_id", "level", F.coalesce(F.bit_xor("x1").over(before), zero).alias("r1"),
        F.coalesce(F.bit_xor("x2").over(before), zero).alias("r2"), F.bit_xor("x1").over(upto).alias("s1"),
        F.bit_xor("x2").over(upto).alias("s2"), F.lead("level").over(by).isNotNull().alias("more"), "codes", "words")
    single = rows.where(~long).select("conv_id", "level", *(zero.alias(c) for c in ("r1", "r2", "s1", "s2")),
                                      F.lit(False).alias("more"), "codes", "words")
    return single.unionByName(chained.select(columns))


# ---- shards ----------------------------------------------------------------------


def sha(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def root_key(level: int, r1: int, r2: int) -> bytes:
    return hashlib.md5(struct.pack(">qqq", level, r1, r2)).digest()


def median_first(n: int):
    """0..n-1, the middle of each range before its halves."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


class SearchTree:
    """A ternary search tree: of node i the symbol, the nodes of lesser, next and greater symbols, and its trie parent."""

    def __init__(self):
        self.symbol, self.less, self.next, self.more, self.parent, self.depth = [-1], [-1], [-1], [-1], [-1], [0]

    def _new(self, symbol: int, parent: int) -> int:
        for column, value in ((self.symbol, symbol), (self.less, -1), (self.next, -1), (self.more, -1),
                              (self.parent, parent), (self.depth, self.depth[parent] + 1)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, symbols) -> int:
        """The node of a sequence, made where it is missing."""
        symbol, less, more = self.symbol, self.less, self.more
        node = 0
        for s in symbols:
            links, at = self.next, node
            while (to := links[at]) >= 0:
                if s == symbol[to]:
                    break
                links, at = (less if s < symbol[to] else more), to
            else:
                to = links[at] = self._new(s, node)
            node = to
        return node

    def preorder(self) -> list[int]:
        """All nodes, parents before their children, by a stack of tree links."""
        out, todo = [0], [self.next[0]]
        while todo:
            at = todo.pop()
            if at >= 0:
                out.append(at)
                todo += [self.more[at], self.next[at], self.less[at]]
        return out


def _shard_nodes(root: tuple[int, int, int], rows: list[tuple], chunk: int) -> list[tuple]:
    """Rows of _NODES of a sorted shard whose rows are (codes, conv_id, words, more, s1, s2)."""
    level = root[0]
    distinct: list[list] = []  # codes, words, ids, ids that end here, key of the next chunk's root
    for codes, conv, words, more, s1, s2 in rows:
        if not distinct or distinct[-1][0] != codes:
            distinct.append([codes, words, [], [], root_key(level + 1, s1, s2)])
        distinct[-1][2].append(conv)
        if not more:
            distinct[-1][3].append(conv)
    split = [[d[0][k:k + CODE] for k in range(0, len(d[0]), CODE)] for d in distinct]
    number = {c: i for i, c in enumerate(sorted({c for s in split for c in s}))}
    tree = SearchTree()
    end_of = [0] * len(distinct)
    for i in median_first(len(distinct)):
        end_of[i] = tree.insert([number[c] for c in split[i]])
    n = len(tree.symbol)
    members, low, ends, words_at, kids = [0] * n, [None] * n, [()] * n, [0] * n, [0] * n
    leaves, saved, opened = [0] * n, [0] * n, [False] * n
    sequence = [-1] * n  # a distinct sequence through an open node

    def open_path(i: int) -> None:
        at = end_of[i]
        while at >= 0 and not opened[at]:
            opened[at], sequence[at] = True, i
            at = tree.parent[at]

    for i, (_, words, ids, over, _) in enumerate(distinct):
        at = end_of[i]
        members[at], low[at], ends[at] = len(ids), ids[0], over
        for w in reversed(words):
            words_at[at] = w
            at = tree.parent[at]
        if i in (0, len(distinct) - 1) or len(words) >= chunk:
            open_path(i)
    opened[0], sequence[0] = True, max(sequence[0], 0)
    order = tree.preorder()
    for at in reversed(order):
        up = tree.parent[at]
        if not opened[at]:
            leaves[at] += kids[at] == 0
            saved[at] += (members[at] - 1) * words_at[at]
            kids[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
        if at:
            members[up] += members[at]
            low[up] = low[at] if low[up] is None else min(low[up], low[at])

    def key(at: int) -> bytes:
        d, i = tree.depth[at], sequence[at]
        if not d:
            return root_key(*root)
        return distinct[i][4] if d == chunk else hashlib.md5(root_key(*root) + distinct[i][0][:d * CODE]).digest()

    keys = {at: key(at) for at in order if opened[at]}
    out = []
    for at in order:
        up, depth = tree.parent[at], level * chunk + tree.depth[at]
        if not opened[at]:
            parent = keys.get(up)
            out.append((_FINAL, None, parent, None if parent else low[up], low[at], depth, None, members[at], kids[at],
                        leaves[at], saved[at], sha(ends[at])))
            continue
        below = level > 0 and at == 0  # the chunk above counts its members
        out.append((_OPEN, keys[at], keys.get(up), None, None if below else low[at], depth, words_at[at],
                    0 if below else members[at], kids[at], leaves[at], saved[at], None))
        if ends[at]:
            out.append((_ENDS, keys[at], None, None, ends[at][0], None, None, None, None, None, None,
                        ",".join(map(str, ends[at]))))
    return out


_NODES = ("kind byte, key binary, parent binary, parent_conv_id long, conv_id long, depth long, words long, n long, "
          "kids long, leaves long, saved long, ends string")
_NODE_TYPES = [pa.int8(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]


def _shards(limits: TrieLimits):
    names = [x.split()[0] for x in _NODES.split(", ")]

    def batch(nodes):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), _NODE_TYPES)], names=names)

    def run(batches):
        root, rows, turns = None, [], 0
        for b in batches:
            columns = (b.column(c).to_pylist() for c in
                       ("level", "r1", "r2", "codes", "conv_id", "words", "more", "s1", "s2"))
            for level, r1, r2, codes, *rest in zip(*columns):
                if rows and ((level, r1, r2) != root or len(rows) >= limits.shard_rows or turns >= limits.shard_turns):
                    yield batch(_shard_nodes(root, rows, limits.chunk))
                    rows, turns = [], 0
                root = (level, r1, r2)
                rows.append((codes, *rest))
                turns += len(rest[1])
        if rows:
            yield batch(_shard_nodes(root, rows, limits.chunk))
    return run


# ---- boundary nodes -------------------------------------------------------------


def _stream_digests(batches):
    """key, ends_sha256 of parts sorted by (key, first id); only the digest of one key is held."""
    key, state, out = None, None, []
    for b in batches:
        for k, ids in zip(b.column("key").to_pylist(), b.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield _digests(out)
            out = []
    if key is not None:
        yield _digests([(key, state.hexdigest())])


def _digests(pairs):
    keys, digests = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests)], names=["key", "ends_sha256"])


def subtree_sums(nodes: DataFrame, values: list[str], scratch: Scratch) -> DataFrame:
    """key and ``values`` summed over each node's subtree; ``nodes`` has key, parent and the nodes' own values.

    After round k a node has the sum of what lies less than 2^k below it and points 2^k up,
    so a chain of any length takes the logarithm of its length in joins.
    """
    state = scratch.put(nodes.select("key", F.col("parent").alias("up"), *values))
    while not state.where("up is not null").isEmpty():
        gained = state.where("up is not null").groupBy(F.col("up").alias("key")).agg(
            *(F.sum(v).alias(f"more_{v}") for v in values))
        above = state.select(F.col("key").alias("up"), F.col("up").alias("up2"))
        state = scratch.put(state.join(above, "up", "left").join(gained, "key", "left").select(
            "key", F.col("up2").alias("up"),
            *((F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values)))
    return state.select("key", *values)


def trie(turns: DataFrame, limits: TrieLimits = TrieLimits(), scratch: Scratch | None = None) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, idx, code, words, and a row of idx -1 for each conversation).

    conv_id is a node's smallest member, n_convs their number, saved_tokens the words that its subtree
    would not need to repeat, ends_sha256 a digest of the members that end there.
    """
    scratch = scratch or Scratch(turns.sparkSession, "prefix-trie")
    rows = scratch.put(sequences(turns, limits.chunk))
    order = ["level", "r1", "r2", "codes", "conv_id"]
    nodes = scratch.put(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_shards(limits), _NODES))
    merged = nodes.where(F.col("kind") == _OPEN).groupBy("key").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("kids", "leaves", "saved")))
    merged = scratch.put(merged)
    open_kids = merged.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("open_kids"))
    counted = merged.join(open_kids, "key", "left").withColumn(
        "n_children", F.col("kids") + F.coalesce("open_kids", F.lit(0)))
    counted = scratch.put(counted.withColumn("leaves", F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
                          .withColumn("saved", F.col("saved") + (F.col("n") - 1) * F.col("words")))
    sums = subtree_sums(counted, ["leaves", "saved"], scratch).select(
        "key", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    digests = nodes.where(F.col("kind") == _ENDS).select("key", "conv_id", "ends").repartition("key").sortWithinPartitions(
        "key", "conv_id").mapInArrow(_stream_digests, "key binary, ends_sha256 string")
    names = counted.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    boundary = counted.select("key", "parent", "conv_id", "depth", F.col("n").alias("n_convs"), "n_children").join(
        sums, "key").join(digests, "key", "left").join(names, "parent", "left")
    final = nodes.where(F.col("kind") == _FINAL).select(
        "parent", "parent_conv_id", "conv_id", "depth", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    inner = final.where("parent is null")
    first = final.where("parent is not null and depth = 1").drop("parent_conv_id").join(  # the one root
        F.broadcast(counted.where("depth = 0").select(F.col("conv_id").alias("parent_conv_id"))), F.lit(True))
    other = final.where("parent is not null and depth > 1").drop("parent_conv_id").join(names, "parent")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    out = inner.select(columns)
    for part in (first, other, boundary):
        out = out.unionByName(part.select(columns))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(sha([]))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of all rebuilt conversations' prefix trie."""
    scratch = Scratch(spark, "prefix-trie")
    placed = scratch.put(place_turns(turn_rows(load(spark, sf_dir, "conversations")), scratch))
    return trie(rebuild(placed), scratch=scratch)
