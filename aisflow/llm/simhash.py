"""SimHash near-duplicates by an inverted index over byte positions with count filtering.

A fingerprint has eight positional bytes. Two that differ in at most three bits
share five of these at least, and of five positions three lie in one half. The
index therefore has a list for every three bytes within a half: two linked
fingerprints stand in a common list. In a list the positional bytes that each
pair shares are tallied, pairs with five or more stay, and their bits are
compared. A list that is long is indexed anew by five bytes, which both of a
pair share as well; whatever the corpus, such a list has at most 2 ** 24 entries.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.llm import batches
from aisflow.llm.components import components
from aisflow.storage import written

#: Production parameters.
SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Bytes that fingerprints with MAX_BITS differing bits share at least.
LEAST_SHARED = 8 - MAX_BITS
#: Longest list of three bytes that is compared as it is, and of five bytes that is compared pair by pair.
LIST, DENSE = 2048, 4096
#: Bytes of words that are hashed at a time.
PART_BYTES = 1 << 20
#: Fingerprints that may be broadcast (16 bytes each).
BROADCAST_PRINTS = 500_000

_TRIPLES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
_FIVES = list(combinations(range(8), 5))
_WITHIN = [[k for k, five in enumerate(_FIVES) if set(triple) <= set(five)] for triple in _TRIPLES]


def _mask(positions: tuple[int, ...]) -> int:
    """The bytes at ``positions`` as a signed long."""
    bits = sum(0xFF << (8 * p) for p in positions)
    return bits - (1 << 64) if bits >> 63 else bits


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of whole words, of about PART_BYTES; a longer word is one part."""
    first = 0
    while first < len(text):
        last = first + PART_BYTES
        while last < len(text) and text[last] not in b" \t\n\v\f\r":
            last += 1
        yield text[first:last]
        first = last


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """64 bits; bit k is set if it is in over half of the shingles' hashes. Zero for a text without words."""
    counts, total, before = np.zeros((8, 256), np.int64), 0, []
    for part in _parts((text or "").encode().lower()):
        words = before + part.split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in zip(*(words[k:] for k in range(size)))]
        if hashes:
            places = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
            counts += [np.bincount(places[:, k], minlength=256) for k in range(8)]
            total += len(hashes)
        before = words[max(0, len(words) - size + 1) :]
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(before), SEED) if before else 0
    bits = (counts @ np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")).reshape(64)
    return int(np.packbits(2 * bits > total, bitorder="little").view(np.uint64)[0])


def _prints(size: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = np.array([fingerprint(t.as_py(), size) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return run


def postings(prints: DataFrame) -> DataFrame:
    """Adds place and held: the list of a triple of positions, and the bytes there; eight rows per fingerprint."""
    each = [F.struct(F.lit(k).alias("place"), F.col("print").bitwiseAND(F.lit(_mask(t))).alias("held")) for k, t in enumerate(_TRIPLES)]
    return prints.select("*", F.explode(F.array(*each)).alias("_p")).select(*prints.columns, "_p.*")


def _deeper(prints: DataFrame) -> DataFrame:
    """The same for five positions, of which ``places`` holds a triple that has a long list."""
    fives = F.array(*[F.array(*[F.lit(k) for k in within]) for within in _WITHIN])
    masks = F.array(*[F.lit(_mask(five)) for five in _FIVES])
    place = F.explode(F.array_distinct(F.flatten(F.transform("places", lambda t: F.get(fives, t)))))
    placed = prints.select("rep", "print", place.alias("place"))
    return placed.withColumn("held", F.col("print").bitwiseAND(F.get(masks, F.col("place"))))


class Forest:
    """Components of the entries of one batch; it takes links and keeps those that join two."""

    def __init__(self, size: int) -> None:
        self.root, self.links = np.arange(size), []

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        apart = self.root[left] != self.root[right]
        if not apart.any():
            return
        for a, b in zip(left[apart].tolist(), right[apart].tolist()):
            x, y = self._find(a), self._find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((a, b))
        while (flat := self.root[self.root]).tobytes() != self.root.tobytes():
            self.root = flat


def shared_bytes(differing: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes two fingerprints share, from their exclusive or."""
    return (np.ascontiguousarray(differing).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def _pairs(prints: np.ndarray, starts: np.ndarray, forest: Forest) -> None:
    """Tallies all pairs within the lists that begin at ``starts``: neighbours at distance 1, then 2, ..."""
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(prints)) - 1
    step = 1
    while len(at := np.flatnonzero(left >= step)):
        differing = prints[at] ^ prints[at + step]
        likely = shared_bytes(differing) >= LEAST_SHARED
        at, differing = at[likely], differing[likely]
        at = at[np.bitwise_count(differing) <= MAX_BITS]
        forest.add(at, at + step)
        step += 1


def _probe(prints: np.ndarray, first: int, forest: Forest) -> None:
    """The links of a dense list of five shared bytes: every way to differ in up to MAX_BITS of the
    24 other bits is looked up in a table of what is there."""
    bytes_ = prints.view(np.uint8).reshape(-1, 8)
    other = [p for p in range(8) if (bytes_[:, p] != bytes_[0, p]).any()]
    values = np.zeros(len(prints), np.int64)
    for k, p in enumerate(other):
        values |= bytes_[:, p].astype(np.int64) << (8 * k)
    table = np.full(1 << (8 * max(1, len(other))), -1, np.int32)
    table[values] = np.arange(len(prints), dtype=np.int32)
    for count in range(1, MAX_BITS + 1):
        for bits in combinations(range(8 * len(other)), count):
            there = table[values ^ sum(1 << b for b in bits)]
            mine = np.flatnonzero(there > np.arange(len(prints)))
            forest.add(first + mine, first + there[mine])


def _links(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links that connect what is linked within each list, at most one less than its entries."""
    reps, prints = table.column("rep").to_numpy(), np.ascontiguousarray(table.column("print").to_numpy()).view(np.uint64)
    forest = Forest(len(prints))
    sizes = np.diff(starts)
    for k in np.flatnonzero(sizes > DENSE).tolist():
        _probe(prints[starts[k] : starts[k + 1]], int(starts[k]), forest)
    few = sizes <= DENSE
    if few.all():
        _pairs(prints, starts, forest)
    else:
        for a, b in zip(starts[:-1][few].tolist(), starts[1:][few].tolist()):
            part = Forest(b - a)
            _pairs(prints[a:b], np.array([0, b - a]), part)
            forest.links += [(a + x, a + y) for x, y in part.links]
    if forest.links:
        ends = np.array(forest.links, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(reps[ends[:, 0]]), pa.array(reps[ends[:, 1]])], ["a", "b"])


def _compared(lists: DataFrame) -> DataFrame:
    lists = lists.select("place", "held", "rep", "print").repartition("place", "held").sortWithinPartitions("place", "held", "print")
    return lists.mapInArrow(batches.in_groups(["place", "held"], _links), "a long, b long")


def _few(frame: DataFrame, bound: int = BROADCAST_PRINTS) -> DataFrame:
    """Few rows are broadcast, after counting them; more are joined by shuffle."""
    return F.broadcast(frame) if frame.limit(bound + 1).count() <= bound else frame


def links(classes: DataFrame, list_size: int = LIST) -> DataFrame:
    """(a, b): links between fingerprints of (rep, print), enough to connect all that are linked.

    Lists are counted first. Those of more than ``list_size`` fingerprints are
    never brought together: their entries go to the lists of five bytes.
    """
    entries = postings(classes.select("rep", "print"))
    long = entries.groupBy("place", "held").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > list_size).select("place", "held")
    long = written(long, "lists")
    if not long.limit(1).count():
        return _compared(entries)
    long = _few(long)
    short = _compared(entries.join(long, ["place", "held"], "left_anti"))
    crowded = entries.join(long, ["place", "held"], "left_semi").groupBy("rep", "print").agg(F.collect_set("place").alias("places"))
    return short.unionByName(_compared(_deeper(crowded)))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, list_size: int = LIST) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of ``docs``.

    Words are runs of other than space and the controls 9 to 13, A-Z lower-cased;
    a shingle is ``shingle_words`` of them joined by spaces, fewer words are one
    shingle. A text without words (null, empty) has fingerprint zero and is linked
    like any other. Fingerprints are linked at MAX_BITS or fewer differing bits;
    component_id is the smallest doc_id reachable. Rows that share a doc_id count
    as one document with several texts. A row without doc_id has its fingerprint,
    but no links and no component. Repeated rows stay, other columns are ignored,
    an empty table gives an empty result.

    Equal fingerprints are one entry of the index, whatever their number.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = written(narrow.mapInArrow(_prints(shingle_words), "doc_id long, print long"), "prints")
    known = prints.where("doc_id IS NOT NULL").groupBy("print")
    classes = written(known.agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("_last")), "classes")
    roots = components(links(classes, list_size))
    named = classes.join(roots, F.col("rep") == F.col("node"), "left")
    # a fingerprint of one document without links needs no look-up
    named = named.where("node IS NOT NULL OR rep != _last").select(F.col("print").alias("_print"), F.coalesce("root", "rep").alias("_root"))
    joined = prints.join(_few(written(named, "named")), F.col("print") == F.col("_print"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return joined.select("doc_id", hex_of(F.col("print")).alias("fingerprint"), component.alias("component_id"))


def hex_of(print_: Column) -> Column:
    """16 lower-case digits."""
    return F.lower(F.lpad(F.hex(print_), 16, "0"))
