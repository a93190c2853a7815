"""MinHash near-duplicates by the Chosen Path set similarity join.

Documents branch down trees: a node picks coordinates of the MinHash signature,
about 1 / similarity of them, and a document goes to one child per coordinate,
named by its value there. Similar documents meet in a node with a chance that
does not fall with depth, others part. Nodes that are small enough are compared
exhaustively, by signature sketches; independent trees raise the recall. What
meets, forms candidate groups; links inside a group are decided on full sets.
(Christiani, Pagh and Sivertsen: Scalable and robust set similarity join, 2018.)
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisflow.llm import batches
from aisflow.llm.components import components
from aisflow.storage import job, scratch_path, written

#: Production parameters. Two sets of exactly the least similarity that part only from large nodes are missed with
#: a chance of 1.0e-4 by depth 3, 5.2e-4 by 4, 1.6e-3 by 5 and 3.6e-3 by 6 (computed; the trees share a signature).
SHINGLE_WORDS = 5
PERCENT = 80
TREES = 10
DEPTH = 6
SMALL_NODE = 64
COORDINATES = 128
#: Sketches (a byte a coordinate) that agree in a smaller share belong to sets below the least
#: similarity: 4.5 standard deviations under 0.8.
SKETCH_SHARE = 0.64
#: Sets compared in one task at a time, and of these the ones that all tasks of a group have.
BLOCK, PIVOTS = 256, 8
#: Ids of candidates that may be broadcast (16 bytes each).
BROADCAST_IDS = 500_000

_SEEDS = batches.mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64))
_FACTORS, _SHIFTS = _SEEDS[:COORDINATES] | np.uint64(1), _SEEDS[COORDINATES:]

FEATURES = "doc_id long, n_shingles long, set_key binary, signature binary, sketch binary"


def _signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the least hash at each coordinate; long sets in parts."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(shingles), 4096):
        part = shingles[first : first + 4096, None] * _FACTORS + _SHIFTS
        np.minimum(least, part.min(axis=0) >> np.uint64(20), out=least)
    return least.astype(np.uint16)


def _features(size: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in batches.steps(texts):
                sets = batches.shingle_sets(texts.slice(a, b - a), size)
                signatures = np.stack([_signature(s) for s in sets])
                columns = [
                    ids.slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    batches.binary_rows(signatures),
                    batches.binary_rows(signatures.astype(np.uint8)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "signature", "sketch"])

    return run


def _roots() -> np.ndarray:
    return batches.mixed(np.arange(TREES, dtype=np.uint64) + np.uint64(0x5EED))


def _children(nodes: np.ndarray, signature: np.ndarray) -> list[np.ndarray]:
    """Children of ``nodes`` for one signature: one coordinate of each node, and a second with
    the chance that makes it 1 / similarity on average. A node decides for all its documents."""
    first = (nodes % np.uint64(COORDINATES)).astype(np.int64)
    more = (nodes >> np.uint64(20)) % np.uint64(10_000) < np.uint64(10_000 * (100 - PERCENT) // PERCENT)
    second = (first[more] + 1 + ((nodes[more] >> np.uint64(40)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    parents, places = np.concatenate([nodes, nodes[more]]), np.concatenate([first, second])
    named = (places.astype(np.uint64) << np.uint64(16)) | signature[places]
    return batches.mixed(batches.mixed(parents) + named)


def _branch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, signature, nodes or null for the roots) to (node, rep)."""
    for batch in rows:
        signatures = batches.matrix_of(batch.column(1), np.uint16, COORDINATES)
        found, reps = [], []
        for rep, signature, nodes in zip(batch.column(0).to_pylist(), signatures, batch.column(2)):
            at = _roots() if not nodes.is_valid else nodes.values.to_numpy(zero_copy_only=False).view(np.uint64)
            found.append(_children(at, signature).view(np.int64))
            reps.append(np.full(len(found[-1]), rep, np.int64))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(reps))], ["node", "rep"])


def _joined(links: np.ndarray, size: int) -> list[int]:
    """Smallest index in each one's component."""
    root = list(range(size))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(size)]


def _edges(reps: np.ndarray, roots: list[int]) -> list[tuple[int, int]]:
    return [(int(reps[r]), int(reps[k])) for k, r in enumerate(roots) if r != k]


def _edge_batch(edges: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if edges:
        ends = np.array(edges, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def _meet(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Candidate edges inside small nodes: sketches agree often enough and sizes allow it."""
    reps, sizes = table.column("rep").to_numpy(), table.column("n_shingles").to_numpy()
    edges = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        sketch = batches.matrix_of(table.column("sketch").slice(a, b - a), np.uint8, COORDINATES)
        agree = (sketch[:, None, :] == sketch[None, :, :]).sum(axis=2)
        fits = np.minimum.outer(sizes[a:b], sizes[a:b]) * 100 >= PERCENT * np.maximum.outer(sizes[a:b], sizes[a:b])
        links = np.argwhere(np.triu((agree >= SKETCH_SHARE * COORDINATES) & fits, 1))
        if len(links):
            edges += _edges(reps[a:b], _joined(links.tolist(), b - a))
    yield from _edge_batch(edges)


def intersections(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, as products of 0/1
    matrices over so many shingles at a time."""
    every = np.concatenate([*left, *right])
    names, ids, times = np.unique(every, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    shared = times[ids] > 1
    order = np.argsort(ids[shared], kind="stable")
    owner, dense = owner[shared][order], ids[shared][order]
    dense = np.cumsum(np.concatenate([[0], dense[1:] != dense[:-1]])) if len(dense) else dense
    total = np.zeros((len(left), len(right)), np.float64)
    width = int(dense[-1]) + 1 if len(dense) else 0
    for first in range(0, width, columns):
        a, b = np.searchsorted(dense, [first, first + columns])
        held = np.zeros((len(left) + len(right), min(columns, width - first)), np.float32)
        held[owner[a:b], dense[a:b] - first] = 1
        total += held[: len(left)] @ held[len(left) :].T
    return np.rint(total).astype(np.int64)


def _linked(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    common = intersections(left, right)
    union = np.add.outer([len(s) for s in left], [len(s) for s in right]) - common
    return 100 * common >= PERCENT * union


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint64) for v in column.to_pylist()]


def _confirm(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links within each block."""
    reps, edges = table.column("rep").to_numpy(), []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        sets = _sets(table.column("shingles").slice(a, b - a))
        links = np.argwhere(np.triu(_linked(sets, sets), 1))
        edges += _edges(reps[a:b], _joined(links.tolist(), b - a))
    yield from _edge_batch(edges)


def _confirm_across(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links between the rest (side 0) and others (side 1) of a pair of blocks, one per rest row and other root."""
    reps, roots, side = (table.column(n).to_numpy() for n in ("rep", "root", "side"))
    edges = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        sets, own = _sets(table.column("shingles").slice(a, b - a)), np.arange(a, b)
        left, right = own[side[a:b] == 0], own[side[a:b] == 1]
        if not len(left) or not len(right):
            continue
        links = _linked([sets[k - a] for k in left], [sets[k - a] for k in right])
        links &= np.not_equal.outer(roots[left], roots[right])
        seen = {(int(reps[left[i]]), int(roots[right[j]])): int(reps[right[j]]) for i, j in np.argwhere(links)}
        edges += [(mine, other) for (mine, _), other in seen.items()]
    yield from _edge_batch(edges)


def _with_sets(size: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b in batches.steps(batch.column("text")):
                part = batch.slice(a, b - a)
                sets = batches.shingle_sets(part.column("text"), size)
                columns = [part.column("rep"), part.column("comp"), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "comp", "shingles"])

    return run


def _leaves(classes: DataFrame) -> tuple[DataFrame | None, list[DataFrame]]:
    """(node, rep) of all nodes of 2 to SMALL_NODE sets, and edges from the first to every set
    of a node that is still larger at the last depth: those are compared as one group."""
    spark, small, stars = classes.sparkSession, [], []
    rooted = classes.select("rep", "signature", F.lit(None).cast("array<long>").alias("nodes"))
    for depth in range(1, DEPTH + 1):
        rows = written(rooted.mapInArrow(_branch, "node long, rep long"), "nodes")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("_n"), F.min("rep").alias("_first")).where("_n > 1")
        # stored, as a large node's rows can be split in a join of two tables, but not in one with an aggregate
        sizes = written(sizes, "sizes")
        sized = rows.join(sizes, "node").withColumn("large", F.col("_n") > SMALL_NODE)
        path = scratch_path(spark, "sized")
        sized.select("node", "rep", "_first", "large").write.partitionBy("large").parquet(path)
        sized = spark.read.schema("node long, rep long, _first long, large boolean").parquet(path)
        small.append(sized.where("NOT large").select("node", "rep"))
        large = sized.where("large")
        if not large.limit(1).count():
            break
        if depth == DEPTH:
            stars.append(large.select(F.col("_first").alias("a"), F.col("rep").alias("b")))
            break
        grouped = large.groupBy("rep").agg(F.collect_list("node").alias("nodes"))
        rooted = grouped.join(classes.select("rep", "signature"), "rep").select("rep", "signature", "nodes")
    leaves = small[0]
    for more in small[1:]:
        leaves = leaves.unionByName(more)
    return leaves, stars


def _broadcast_if_few(ids: DataFrame) -> DataFrame:
    """Few ids are broadcast, after counting them; more are joined by shuffle."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return F.broadcast(ids) if few else ids


def _members_with_sets(docs: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    """(rep, comp, shingles): the sets of all candidates."""
    ids = groups.select(F.col("node").alias("rep"), F.col("root").alias("comp"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    joined = texts.join(_broadcast_if_few(ids), "rep").select("rep", "comp", "text")
    return written(joined.mapInArrow(_with_sets(size), "rep long, comp long, shingles binary"), "sets")


def _sorted_by(frame: DataFrame, *names: str) -> DataFrame:
    return frame.repartition(*names).sortWithinPartitions(*names)


def _links(members: DataFrame) -> DataFrame:
    """Verified edges that connect whatever is connected by links inside a candidate group.

    Groups are cut into blocks of BLOCK sets, compared within; PIVOTS sets are in
    all blocks of their group and tie these together. Then every set outside its
    group's largest component is compared, block by block, with the sets of all
    other components: a link between two of them has such a set at one end.
    """
    sizes = written(members.groupBy("comp").agg(F.count(F.lit(1)).alias("_n")), "sizes")
    spread = F.xxhash64("rep")
    blocks = F.ceil(F.col("_n") / (BLOCK - PIVOTS)).cast("int")
    sized = members.join(sizes, "comp").withColumn("_blocks", F.when(F.col("_n") <= BLOCK, 1).otherwise(blocks))
    # the pivots: members whose hash is among the smallest of their group, by a bound on the hash
    chance = F.lit(float(PIVOTS)) / F.col("_n")
    pivot = (F.col("_blocks") > 1) & (F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(1 << 30)) < chance * (1 << 30))
    own = F.array(F.pmod(spread, F.col("_blocks")).cast("int"))
    places = F.when(pivot, F.sequence(F.lit(0), F.col("_blocks") - 1)).otherwise(own)
    placed = sized.withColumn("block", F.explode(places)).select("comp", "block", "rep", "shingles")
    within = _sorted_by(placed, "comp", "block").mapInArrow(batches.in_groups(["comp", "block"], _confirm), "a long, b long")
    within = written(within, "links")
    large = sizes.where(F.col("_n") > BLOCK)
    if not large.limit(1).count():
        return within
    roots = components(within)
    tagged = members.join(large, "comp").join(roots, F.col("rep") == F.col("node"), "left")
    tagged = tagged.select("comp", "rep", "_n", F.coalesce("root", "rep").alias("root"))
    tagged = written(tagged, "tagged")
    counts = tagged.groupBy("comp", "root").agg(F.count(F.lit(1)).alias("_c"))
    largest = F.max(F.struct("_c", "root"))
    main = counts.groupBy("comp").agg(largest["root"].alias("_main"), (F.sum("_c") - largest["_c"]).alias("_rests"))
    known = tagged.join(written(main.where("_rests > 0"), "main"), "comp").withColumns(
        {
            "rest": F.col("root") != F.col("_main"),
            "_left": F.ceil(F.col("_rests") / BLOCK).cast("int"),
            "_right": F.ceil(F.col("_n") / BLOCK).cast("int"),
        }
    )
    lefts = known.where("rest").select(
        "comp", "rep", "root", F.lit(0).alias("side"),
        F.pmod(F.xxhash64("rep", F.lit(2)), F.col("_left")).cast("int").alias("left"),
        F.explode(F.sequence(F.lit(0), F.col("_right") - 1)).alias("right"),
    )
    rights = known.select(
        "comp", "rep", "root", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0), F.col("_left") - 1)).alias("left"),
        F.pmod(F.xxhash64("rep", F.lit(3)), F.col("_right")).cast("int").alias("right"),
    )
    pairs = lefts.unionByName(rights).join(members.select("rep", "shingles"), "rep")
    pairs = pairs.select("comp", "left", "right", "rep", "root", "side", "shingles")
    keys = ["comp", "left", "right"]
    across = _sorted_by(pairs, *keys).mapInArrow(batches.in_groups(keys, _confirm_across), "a long, b long")
    return within.unionByName(written(across, "links"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Words are runs of other than space and the controls 9 to 13, A-Z lower-cased.
    Two documents are linked if their sets of word shingles have a Jaccard
    similarity of PERCENT or more; component_id is the smallest doc_id reachable
    over links, and the row with that doc_id is kept. Documents without words
    (null, empty) are linked with nothing. Rows that share a doc_id count as one
    document with several texts. A row without doc_id has no component and is
    kept. An empty table gives an empty result; other columns are ignored.

    Equal sets are one set from the start, whatever their number, and shingles
    are 64-bit hashes.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = written(narrow.mapInArrow(_features(shingle_words), FEATURES), "features")
    usable = features.where("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = [F.any_value(c).alias(c) for c in ("n_shingles", "signature", "sketch")]
    classes = written(usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), *firsts), "classes")
    leaves, stars = _leaves(classes)
    described = leaves.join(classes.select("rep", "n_shingles", "sketch"), "rep").select("node", "rep", "n_shingles", "sketch")
    edges = _sorted_by(described, "node").mapInArrow(batches.in_groups(["node"], _meet), "a long, b long")
    for star in stars:
        edges = edges.unionByName(star)
    groups = components(edges)
    members = _members_with_sets(narrow, groups, shingle_words)
    roots = components(_links(members)).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    named = classes.select(F.col("set_key").alias("_key"), "rep").join(roots, F.col("rep") == F.col("_node"), "left")
    named = named.select("_key", F.coalesce("_root", "rep").alias("_component"))
    joined = features.join(named, features["set_key"] == named["_key"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("_component"))).otherwise(F.col("doc_id"))
    out = joined.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The documents that are kept, with all their columns (repeated rows of a kept id stay).

    Only the ids that go are needed in the end; all other tables are removed once these are written.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "gone")
    with job(spark):
        near_duplicates(docs, shingle_words).where("NOT kept").select("doc_id").distinct().write.parquet(path)
    gone = spark.read.schema("doc_id long").parquet(path)
    return docs.join(_broadcast_if_few(gone), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
