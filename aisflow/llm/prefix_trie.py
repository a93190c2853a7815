"""Conversation prefix trie: ternary search trees per range shard, merged at their borders.

A turn is coded by the digest of its role and text. Conversations are cut into
blocks of turns, each below the node that its conversation has reached, so one
of any length is spread. Blocks are ordered by node, turns and conversation and
dealt into shards by ranges. A shard encodes its turns by a dictionary and
inserts its sequences into ternary search trees, the median first; an iterative
traversal accumulates members, leaves and savings. Nodes that a neighbouring
shard or a deeper block may have as well stay open: their parts are merged by
node, and what they add to the nodes above is summed at the end.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisflow.llm import batches
from aisflow.llm.columns import WORD
from aisflow.llm.numbering import SLICE_ROWS, gapless
from aisflow.storage import scratch_path, written

#: Conversations of a family, and turns that the first of them may lend to the others.
FAMILY, LENT = 20, 4
#: Turns of a block; blocks of a shard, about; blocks whose sums are added up in one step.
BLOCK = 16
SHARD_ROWS = 20_000
SEGMENT = 1000
#: Turns of a conversation that are joined under one key.
SPAN = 100_000
#: Ids in one piece of a list of ends.
ENDS = 1000
#: Open nodes that may be broadcast (24 bytes each), and copies of them where more are joined.
BROADCAST_NODES, SALT = 1_000_000, 16

_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NONE = hashlib.sha256(b"").hexdigest()
_MORE = np.uint64(0x9E3779B97F4A7C15)

_FIELDS = [
    ("kind", pa.string()),
    ("depth", pa.int64()),
    ("k1", pa.int64()),
    ("k2", pa.int64()),
    ("p1", pa.int64()),
    ("p2", pa.int64()),
    ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
    ("words", pa.int64()),
    ("first_below", pa.int64()),
    ("ends_sha256", pa.string()),
    ("above", pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64())]))),
    ("shard", pa.int64()),
    ("part", pa.int64()),
    ("ends", pa.string()),
]
_PARTS = (
    "kind string, depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, first_below long, ends_sha256 string, above array<struct<k1:long,k2:long>>, shard long, part long, ends string"
)


def coded_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, key, words: the digest of a turn's role and text, and the words of the text."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL")
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(named).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def rebuilt(placed: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, key, words, total) of all turns after rebuilding, from 1, and (conv_id, total) of
    all conversations. ``placed`` has the original turns with ``slot``, from 0 in each conversation."""
    sizes = placed.groupBy("conv_id").agg((F.max("slot") + 1).alias("n"))
    lent = F.crc32(F.col("conv_id").cast("string")) % LENT
    sizes = written(sizes.select("conv_id", "n", lent.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")), "sizes")
    bases = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_base"), F.col("n").alias("_held"))
    taken = F.least("h", F.coalesce("_held", F.lit(0)))
    convs = sizes.join(bases, F.col("base") == F.col("_base"), "left").withColumn("taken", taken)
    convs = written(convs.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).drop("_base", "_held"), "convs")
    # a long conversation has a row, hence a key, for every ``span`` of its turns
    spans = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / span))
    spanned = convs.where("n > h").select("conv_id", "h", "taken", "total", F.explode(spans).alias("_span"))
    own = placed.withColumn("_span", F.floor(F.col("slot") / span)).join(spanned, ["conv_id", "_span"]).where("slot >= h")
    own = own.select("conv_id", (F.col("slot") - F.col("h") + F.col("taken") + 1).alias("depth"), "key", "words", "total")
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("slot") < LENT)).select(F.col("conv_id").alias("base"), "slot", "key", "words")
    given = convs.where("taken > 0").join(heads, "base").where("slot < taken")
    given = given.select("conv_id", (F.col("slot") + 1).alias("depth"), "key", "words", "total")
    return own.unionByName(given), convs.select("conv_id", "total")


def _codes(path: bytes, first: int) -> np.ndarray:
    """Two numbers for each turn of a path, from its digest and depth. A node's key is the exclusive
    or of those on the way to it, so parts of a way can be taken together in any order."""
    digests = np.frombuffer(path, np.uint64).reshape(-1, 2)
    depths = batches.mixed(np.arange(first, first + len(digests), dtype=np.uint64) * _MORE)
    return np.stack([batches.mixed(digests[:, 0] ^ depths), batches.mixed(digests[:, 1] + depths)], axis=1)


def _sums(block: int):
    """(conv_id, block, path) to the exclusive or of each block's codes."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, blocks, paths = (batch.column(n) for n in ("conv_id", "block", "path"))
            found = [np.bitwise_xor.reduce(_codes(p.as_py(), b.as_py() * block + 1), axis=0) for p, b in zip(paths, blocks)]
            both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, blocks, pa.array(both[:, 0]), pa.array(both[:, 1])], ["conv_id", "block", "x1", "x2"])

    return run


def _before(frame: DataFrame, names: list[str], total, add, last_first: bool = False, segment: int = SEGMENT) -> DataFrame:
    """The sums of ``names`` over a conversation's blocks before each one (or after it), by segments of blocks."""
    held = written(frame.withColumn("_segment", F.floor(F.col("block") / segment)), "blocks")

    def order(name: str) -> Column:
        return F.col(name).desc() if last_first else F.col(name)

    inner = Window.partitionBy("conv_id", "_segment").orderBy(order("block")).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv_id").orderBy(order("_segment")).rowsBetween(Window.unboundedPreceding, -1)
    sums = held.groupBy("conv_id", "_segment").agg(*[total(n).alias(f"_{n}") for n in names])
    sums = sums.select("conv_id", "_segment", *[F.coalesce(total(f"_{n}").over(outer), F.lit(0)).alias(f"_{n}") for n in names])
    within = held.withColumns({n: F.coalesce(total(n).over(inner), F.lit(0)) for n in names})
    return within.join(sums, ["conv_id", "_segment"]).select("conv_id", "block", *[add(F.col(n), F.col(f"_{n}")).alias(n) for n in names])


def blocks(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, bool]:
    """(conv_id, block, total, path, words, k1, k2): the turns of each block as joined digests, below
    the node (k1, k2); and whether any conversation has several blocks."""
    at = F.floor((F.col("depth") - 1) / block)
    grouped = turns.groupBy("conv_id", at.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "key", "words"))).alias("_t"), F.max("total").alias("total")
    )
    filled = grouped.select("conv_id", "block", "total", F.unhex(F.array_join("_t.key", "")).alias("path"), F.col("_t.words").alias("words"))
    without = convs.where("total = 0").select(
        "conv_id", F.lit(0).cast("long").alias("block"), "total", F.unhex(F.lit("")).alias("path"), F.array().cast("array<long>").alias("words")
    )
    all_ = written(filled.unionByName(without), "blocks")
    zero = F.lit(0).cast("long")
    short = all_.where(F.col("total") <= block).withColumns({"k1": zero, "k2": zero})
    long = all_.where(F.col("total") > block)
    if not long.limit(1).count():
        return short, False
    sums = long.select("conv_id", "block", "path").mapInArrow(_sums(block), "conv_id long, block long, x1 long, x2 long")
    before = _before(sums, ["x1", "x2"], F.bit_xor, lambda a, b: a.bitwiseXOR(b)).withColumnsRenamed({"x1": "k1", "x2": "k2"})
    return short.unionByName(written(long.join(before, ["conv_id", "block"]), "long")), True


class Tree:
    """A ternary search tree over sequences of turn ids; entry 0 is the node below which they begin.

    Every other entry is a node of the trie: ``equal`` leads to its children, which
    among themselves are a binary tree by ``low`` and ``high``.
    """

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.equal, self.parent = [-1], [-1], [-1], [-1], [-1]
        self.members, self.least, self.words, self.key, self.open = [0], [None], [0], [(0, 0)], [True]
        self.ends: dict[int, list[int]] = {}

    def _new(self, turn: int, parent: int, words: int, code: tuple[int, int]) -> int:
        for column in (self.low, self.high, self.equal):
            column.append(-1)
        self.turn.append(turn)
        self.parent.append(parent)
        self.members.append(0)
        self.least.append(None)
        self.words.append(words)
        self.key.append((self.key[parent][0] ^ code[0], self.key[parent][1] ^ code[1]))
        self.open.append(False)
        return len(self.turn) - 1

    def insert(self, ids: list[int], words: list[int], codes: list[tuple[int, int]]) -> int:
        """The entry at the end of a sequence, which is made where it is not there."""
        at = 0
        for turn, count, code in zip(ids, words, codes):
            parent, side, here = at, self.equal, at
            while (at := side[here]) >= 0 and self.turn[at] != turn:
                here, side = at, self.low if turn < self.turn[at] else self.high
            if at < 0:
                at = side[here] = self._new(turn, parent, count, code)
        return at

    def preorder(self) -> list[int]:
        """All entries, parents before children."""
        order, stack = [], [0]
        while stack:
            at = stack.pop()
            order.append(at)
            child = [self.equal[at]]
            while child:
                if (c := child.pop()) >= 0:
                    stack.append(c)
                    child += [self.low[c], self.high[c]]
        return order


def median_order(size: int) -> Iterator[int]:
    """0 to size - 1, the middle first, then the middles of both halves, ..."""
    parts = [(0, size)]
    while parts:
        a, b = parts.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            parts += [(a, middle), (middle + 1, b)]


def _grown(rows: list[tuple], block: int, at: int, first: bool, last: bool) -> Tree:
    """The tree of one node's sequences. ``rows`` are (path, conv_id, total, words) in order."""
    paths: list[tuple[bytes, list[int], int]] = []
    for path, conv_id, total, words in rows:
        if not paths or paths[-1][0] != path:
            paths.append((path, words, total, [], []))
        paths[-1][3].append(conv_id)
        if total == at * block + len(path) // 16:
            paths[-1][4].append(conv_id)
    split = [[p[k : k + 16] for k in range(0, len(p), 16)] for p, *_ in paths]
    ids = {digest: k for k, digest in enumerate(sorted({d for digests in split for d in digests}))}
    tree = Tree()
    for k in median_order(len(paths)):
        path, words, _, convs, ends = paths[k]
        codes = list(map(tuple, _codes(path, at * block + 1).tolist()))
        here = tree.insert([ids[d] for d in split[k]], words, codes)
        # the members of a deeper block's first node are counted in the block that ends with it
        if here or not at:
            tree.members[here], tree.least[here] = len(convs), min(convs)
        if ends and (here or not at):
            tree.ends[here] = sorted(ends)
        if len(ends) < len(convs) or (first and k == 0) or (last and k == len(paths) - 1):
            tree.open[here] = True
    return tree


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _unsigned(x: int) -> int:
    return x & ((1 << 64) - 1)


def _joined_ids(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def _nodes(rows: list[tuple], block: int, at: int, root: tuple[int, int], shard: int, first: bool, last: bool) -> Iterator[dict]:
    """Closed nodes with all their figures, open ones with the part that is known here."""
    tree = _grown(rows, block, at, first, last)
    order = tree.preorder()
    size = len(order)
    children, leaves, saved, depth = [0] * size, [0] * size, [0] * size, [0] * size
    for x in order[1:]:
        depth[x] = depth[tree.parent[x]] + 1
    for x in reversed(order[1:]):
        up = tree.parent[x]
        tree.members[up] += tree.members[x] if up or not at else 0
        if tree.least[x] is not None and (up or not at):
            tree.least[up] = tree.least[x] if tree.least[up] is None else min(tree.least[up], tree.least[x])
        if tree.open[x]:
            tree.open[up] = True
        else:
            leaves[x] = leaves[x] if children[x] else 1
            saved[x] += (tree.members[x] - 1) * tree.words[x]
            children[up] += 1
            leaves[up] += leaves[x]
            saved[up] += saved[x]

    def key(x: int) -> tuple[int, int]:
        return _signed(tree.key[x][0] ^ _unsigned(root[0])), _signed(tree.key[x][1] ^ _unsigned(root[1]))

    for x in order:
        up = tree.parent[x]
        row = {"depth": at * block + depth[x], "conv_id": tree.least[x], "n_convs": tree.members[x], "n_children": children[x]}
        row |= {"n_leaves": leaves[x], "saved_tokens": saved[x], "words": tree.words[x]}
        ends = tree.ends.get(x, [])
        if not tree.open[x]:
            row["ends_sha256"] = hashlib.sha256(_joined_ids(ends).encode()).hexdigest()
            if tree.open[up]:
                row |= {"kind": "below"} | dict(zip(("p1", "p2"), key(up)))
            else:
                row |= {"kind": "closed", "parent_conv_id": tree.least[up]}
            yield row
            continue
        row |= {"kind": "open"} | dict(zip(("k1", "k2"), key(x)))
        if x:
            row |= dict(zip(("p1", "p2"), key(up)))
            row["above"] = []
            while up >= 0:
                row["above"].append(dict(zip(("k1", "k2"), key(up))))
                up = tree.parent[up]
        elif at:
            row["first_below"] = min(conv_id for _, conv_id, *_ in rows)
        yield row
        for part in range(0, len(ends), ENDS):
            piece = _joined_ids(ends[part : part + ENDS])
            yield {"kind": "ends", "k1": row["k1"], "k2": row["k2"], "shard": shard, "part": part, "ends": piece}


def _tries(block: int):
    """Sorted rows of a shard to _PARTS, one node's sequences after the other."""

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in _FIELDS], [n for n, _ in _FIELDS])

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, shard, first, out = None, [], 0, True, []
        for batch in batches_:
            names = ("shard", "block", "k1", "k2", "path", "conv_id", "total", "words")
            for shard, at, k1, k2, *row in zip(*(batch.column(n).to_pylist() for n in names)):
                if held and group != (at, k1, k2):
                    out += _nodes(held, block, group[0], group[1:], shard, first, False)
                    held, first = [], False
                group = (at, k1, k2)
                held.append(row)
                if len(out) > 10_000:
                    yield batch_of(out)
                    out = []
        if held:
            out += _nodes(held, block, group[0], group[1:], shard, first, True)
        for k in range(0, len(out), 10_000):
            yield batch_of(out[k : k + 10_000])

    return run


def _hashed_ends(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, ends) in order to the hash of each node's joined ids, which are never held together."""
    current, state, done = None, None, []
    for batch in rows:
        for k1, k2, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if (k1, k2) == current:
                state.update(b",")
            else:
                if current:
                    done.append((*current, state.hexdigest()))
                current, state = (k1, k2), hashlib.sha256()
            state.update(ends.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["k1", "k2", "ends_sha256"])
            done = []
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*current, state.hexdigest())], ["k1", "k2", "ends_sha256"])


def _way(block: int):
    """(block, path, k1, k2, leaves, saved) to the nodes of each path but its last in a whole block, with those figures."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys, counts = [], []
            for at, path, k1, k2 in zip(*(batch.column(n).to_pylist() for n in ("block", "path", "k1", "k2"))):
                codes = np.concatenate([np.array([[k1, k2]], np.int64).view(np.uint64), _codes(path, at * block + 1)])
                keys.append(np.bitwise_xor.accumulate(codes, axis=0)[:block])
                counts.append(len(keys[-1]))
            if keys:
                both = np.concatenate(keys).view(np.int64)
                more = [pa.array(np.repeat(batch.column(n).to_numpy(), counts)) for n in ("leaves", "saved")]
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), *more], ["k1", "k2", "leaves", "saved"])

    return run


def _carried(long: DataFrame, sums: DataFrame, block: int) -> DataFrame:
    """(k1, k2, leaves, saved) that deeper blocks add to the nodes above them.

    What lies below the first node of a block goes up along the smallest
    conversation that has the block, through the blocks before; so it is counted once.
    """
    lower = sums.where((F.col("depth") > 0) & (F.col("depth") % block == 0)).select(
        "k1", "k2", F.col("first_below").alias("conv_id"), (F.col("leaves") - F.col("own_leaves")).alias("leaves"), (F.col("saved") - F.col("own_saved")).alias("saved")
    )
    figures = {n: F.coalesce(n, F.lit(0)) for n in ("leaves", "saved")}
    per_block = long.select("conv_id", "block", "k1", "k2").join(lower, ["conv_id", "k1", "k2"], "left").withColumns(figures)
    after = _before(per_block.select("conv_id", "block", "leaves", "saved"), ["leaves", "saved"], F.sum, lambda a, b: a + b, last_first=True)
    due = long.select("conv_id", "block", "path", "k1", "k2").join(after.where("leaves != 0 OR saved != 0"), ["conv_id", "block"])
    each = due.mapInArrow(_way(block), "k1 long, k2 long, leaves long, saved long")
    return each.groupBy("k1", "k2").agg(F.sum("leaves").alias("c_leaves"), F.sum("saved").alias("c_saved"))


def _with_parents(nodes: DataFrame, names: DataFrame, few: int) -> DataFrame:
    """Adds parent_conv_id by the parent's key; a busy parent is one of a broadcast table or has several copies."""
    named = names.select(F.col("k1").alias("_p1"), F.col("k2").alias("_p2"), F.col("conv_id").alias("_parent"))
    same = (F.col("p1") == F.col("_p1")) & (F.col("p2") == F.col("_p2"))
    if names.limit(few + 1).count() <= few:
        joined = nodes.join(F.broadcast(named), same, "left")
    else:
        copies = named.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        salted = nodes.withColumn("_salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALT)).cast("int"))
        joined = salted.join(copies, same & (F.col("_salt") == F.col("_copy")), "left")
    return joined.withColumn("parent_conv_id", F.col("_parent"))


def prefix_trie(
    conversations: DataFrame,
    block: int = BLOCK,
    shard_rows: int = SHARD_ROWS,
    slice_rows: int = SLICE_ROWS,
    span: int = SPAN,
    broadcast_nodes: int = BROADCAST_NODES,
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    Turns are in order of ``turn``, nulls first; of equal ones the turn with the
    smaller digest comes first, and repeated rows are turns of their own. A null
    role or text is empty. Rows without conv_id belong to no conversation and are
    left out. Conversations are rebuilt by ``rebuilt``; nodes are the distinct
    sequences of first turns. n_convs are the rebuilt conversations that begin
    with the node's, conv_id the smallest of them; n_leaves and saved_tokens are
    sums over the subtree; ends_sha256 covers the ids of those that end here.
    An empty table has no nodes, not even the root. Other columns are ignored.
    """
    placed = written(gapless(coded_turns(conversations), ["conv_id"], ["turn"], slice_rows), "turns")
    turns, convs = rebuilt(placed, span)
    rows, several = blocks(turns, convs, block)
    shards = max(1, -(-rows.count() // shard_rows))
    keys = ["block", "k1", "k2", "path", "conv_id"]
    dealt = rows.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).withColumn("shard", F.spark_partition_id().cast("long"))
    path = scratch_path(conversations.sparkSession, "nodes")
    dealt.mapInArrow(_tries(block), _PARTS).write.partitionBy("kind").parquet(path)
    parts = conversations.sparkSession.read.schema(_PARTS).parquet(path)

    merged = parts.where("kind = 'open'").groupBy("k1", "k2").agg(
        F.max("depth").alias("depth"),
        *[F.min(n).alias(n) for n in ("conv_id", "first_below")],
        *[F.max(n).alias(n) for n in ("p1", "p2", "words")],
        *[F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max(F.col("above")).alias("above"),
    )
    merged = written(merged, "open")
    kids = merged.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("_c1"), F.col("p2").alias("_c2")).agg(F.count(F.lit(1)).alias("_kids"))
    nodes = merged.join(kids, (F.col("k1") == F.col("_c1")) & (F.col("k2") == F.col("_c2")), "left")
    nodes = nodes.withColumn("n_children", F.col("n_children") + F.coalesce("_kids", F.lit(0))).drop("_c1", "_c2", "_kids")
    leaf = (F.col("n_children") == 0).cast("long")
    nodes = nodes.withColumns({"own_leaves": F.col("n_leaves") + leaf, "own_saved": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")})
    nodes = written(nodes, "open")
    here = F.array(F.struct("k1", "k2"))
    every = F.explode(F.concat(here, F.coalesce("above", F.array().cast("array<struct<k1:long,k2:long>>")))).alias("_x")
    spread = nodes.select(every, "own_leaves", "own_saved").groupBy(F.col("_x.k1").alias("k1"), F.col("_x.k2").alias("k2"))
    sums = spread.agg(F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved"))
    sums = nodes.join(sums, ["k1", "k2"])
    if several:
        sums = written(sums, "sums")
        sums = sums.join(_carried(rows.where(F.col("total") > block), sums, block), ["k1", "k2"], "left")
        sums = sums.withColumns({n: F.col(n) + F.coalesce(f"c_{n}", F.lit(0)) for n in ("leaves", "saved")})
    ends = parts.where("kind = 'ends'").select("k1", "k2", "shard", "part", "ends").repartition("k1", "k2")
    ends = ends.sortWithinPartitions("k1", "k2", "shard", "part").select("k1", "k2", "ends")
    ends = ends.mapInArrow(_hashed_ends, "k1 long, k2 long, ends_sha256 string")
    sums = sums.join(ends, ["k1", "k2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))
    opened = sums.select(
        "p1", "p2", "conv_id", "depth", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256"
    )
    below = parts.where("kind = 'below'").select(*opened.columns)
    named = _with_parents(opened.unionByName(below), merged.select("k1", "k2", "conv_id"), broadcast_nodes)
    return parts.where("kind = 'closed'").select(*_RESULT).unionByName(named.select(*_RESULT))
