"""Arrow batches in Python tasks: words as hashes, and rows that belong together."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one numpy step handles at a time, about (a longer text is one step).
STEP_BYTES = 1 << 20


def steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about STEP_BYTES of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        done = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, done + STEP_BYTES, side="right")))
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and where each text's words begin (one more entry at the end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, bounds = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    real = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    coded = words.filter(real).dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return hashes[codes] if len(codes) else np.empty(0, np.uint64), kept[bounds]


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes: runs of ``size`` words, or
    all words where there are fewer; none for a text without words."""
    hashes, bounds = word_hashes(texts)
    runs = np.full(len(hashes), size, np.uint64)
    for shift in range(size):
        runs = mixed(runs)
        runs[: len(hashes) - shift] += hashes[shift:]
    runs = mixed(runs)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                whole = mixed(whole) + h
            sets.append(mixed(whole))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(matrix)], pa.binary())


def matrix_of(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """The inverse of ``binary_rows``."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def in_groups(names: list[str], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow`` over rows sorted by ``names``: calls ``work`` with whole
    groups, as a table and the rows at which its groups begin (one more entry at the end).
    Only the last group of a batch waits for the next one, in a copy of its own: a slice would
    hold the whole batch in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            del batch
            if held is not None:
                # rows that go on with the group held; what follows them is read where it is
                more = _first_other(held, table, names)
                held = pa.concat_tables([held, table.slice(0, more)]).combine_chunks()
                table = table.slice(more)
                if not len(table):
                    continue
                yield from work(held, np.array([0, len(held)]))
            starts = _starts(table, names)
            if len(starts) > 1:
                yield from work(table.slice(0, starts[-1]), starts)
            held = table.take(np.arange(starts[-1], len(table)))
            del table
        if held is not None:
            yield from work(held, np.array([0, len(held)]))

    return run


def _first_other(held: pa.Table, table: pa.Table, names: list[str]) -> int:
    """The first row of ``table`` that is not of the group of ``held``, or its length."""
    other = np.zeros(len(table), bool)
    for name in names:
        other |= table.column(name).to_numpy() != held.column(name)[0].as_py()
    return int(np.argmax(other)) if other.any() else len(table)


def _starts(table: pa.Table, names: list[str]) -> np.ndarray:
    new = np.zeros(len(table), bool)
    new[0] = True
    for name in names:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
