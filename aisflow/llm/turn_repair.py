"""Conversation structure repair by Knuth's lightest-derivation agenda.

What a repair may do to a row, or between rows, is a weighted deduction: from
the item "the rows before i are repaired and the last role is q" and the row i
follows the item behind it. Weights are (cost, audit), and every deduction adds
its cost and its letter at the end, so no conclusion is lighter than a premise:
items popped from an agenda in order of weight are final, and the first goal is
the lightest repair.

Conversations are dealt by ranges of their rows. One that lies within a slice is
repaired there. Of the others, which are at most two a slice besides those that
fill slices, each slice gives the lightest way from every state to every other;
these ways are deductions of the same agenda, over slices instead of rows.
"""

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.storage import scratch_path, written

#: Rows of a slice, about; rows whose repair is one derivation; bytes of text that a task hands over at a time.
SLICE_ROWS = 10_000
CHUNK = 128
BATCH_BYTES = 4 << 20

# Costs of the edits, of a truncated row that stays, and the roles that edits give.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
USER, ASSISTANT = "user", "assistant"
LEGAL = {"su", "ua", "au"}

#: Last role: none yet, system, user, assistant. A repair ends at the first or the last.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES, ENDS = range(4), (START, AFTER_A)
#: What a role's initial leads to, by state, and the state behind a row of the role that must come next.
_KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
_NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
_ROLE = {AFTER_U: USER, AFTER_A: ASSISTANT}

Weight = tuple[int, str]
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_FIRST = RESULT + ", kind string, slice long, turn long, role string, text string, copies int, digest string"
_WAYS = "array<struct<p:int,q:int,cost:long,audit:string>>"
_SEGMENT = (
    "conv_id long, slice long, blank long, duplicate long, truncated long, illegal long, least long, most long, n_turns long, "
    f"head string, tail string, ways {_WAYS}"
)
_MERGED = "kind string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, slice long, state int"


class Deduction(NamedTuple):
    """From all premises follows the conclusion, at the sum of their weights, ``cost`` and ``letters``."""

    premises: tuple
    conclusion: tuple
    cost: int
    letters: str


def lightest(axioms: dict[tuple, Weight], deductions: list[Deduction], goal: tuple | None = None) -> dict[tuple, Weight]:
    """The lightest weight of every item that can be derived, or of those up to ``goal``.

    An item is final once it is popped; a deduction is drawn when its last premise is.
    """
    uses: dict[tuple, list[int]] = {}
    missing = [len(set(d.premises)) for d in deductions]
    for k, d in enumerate(deductions):
        for premise in set(d.premises):
            uses.setdefault(premise, []).append(k)
    agenda = [(weight, item) for item, weight in axioms.items()]
    heapq.heapify(agenda)
    final: dict[tuple, Weight] = {}
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for k in uses.get(item, ()):
            missing[k] -= 1
            d = deductions[k]
            if not missing[k] and d.conclusion not in final:
                parts = [final[p] for p in d.premises]
                total = (sum(p[0] for p in parts) + d.cost, "".join([p[1] for p in parts]) + d.letters)
                heapq.heappush(agenda, (total, d.conclusion))
    return final


class Row(NamedTuple):
    role: str
    text: str
    gone: bool
    truncated: bool


GOAL = ("goal",)


def _edits(rows: list[Row]) -> list[Deduction]:
    """Deductions over items ("at", rows done, state) and, as a second premise, the row. Insertions stand before a row."""
    found = []
    for i, row in enumerate(rows):
        extra, fact = TRUNCATED * row.truncated, ("row", i)
        for q in STATES:
            here = ("at", i, q)
            found.append(Deduction((here,), ("at", i, _NEXT[q]), INSERT, "I"))
            found.append(Deduction((here, fact), ("at", i + 1, q), DELETE, "D"))
            if not row.gone:
                found.append(Deduction((here, fact), ("at", i + 1, _NEXT[q]), REROLE + extra, "R"))
                if (kept := _KEPT.get((q, row.role[:1]))) is not None:
                    found.append(Deduction((here, fact), ("at", i + 1, kept), extra, "K"))
    return found


def _facts(rows: list[Row]) -> dict[tuple, Weight]:
    return {("row", i): (0, "") for i in range(len(rows))}


def _last(i: int) -> list[Deduction]:
    """Insertions behind the last row, and the goal."""
    more = [Deduction((("at", i, q),), ("at", i, _NEXT[q]), INSERT, "I") for q in STATES]
    return more + [Deduction((("at", i, q),), GOAL, 0, "") for q in ENDS]


def ways(rows: list[Row], states=STATES) -> dict[tuple[int, int], Weight]:
    """The lightest repair of rows from each of ``states`` to each state, by chunks; insertions behind them are left out."""
    held = {p: {p: (0, "")} for p in states}
    for first in range(0, len(rows), CHUNK):
        chunk = rows[first : first + CHUNK]
        deductions, facts = _edits(chunk), _facts(chunk)
        through = {}
        for q in {q for reached in held.values() for q in reached}:
            final = lightest(facts | {("at", 0, q): (0, "")}, deductions)
            through |= {(q, r): final["at", len(chunk), r] for r in STATES if ("at", len(chunk), r) in final}
        held = {p: _through(reached, through) for p, reached in held.items()}
    return {(p, q): weight for p, reached in held.items() for q, weight in reached.items()}


def _through(reached: dict[int, Weight], through: dict[tuple[int, int], Weight]) -> dict[int, Weight]:
    """The lightest weights behind a stretch, from those before it."""
    steps = [Deduction((("before", q),), ("behind", r), cost, audit) for (q, r), (cost, audit) in through.items()]
    final = lightest({("before", q): w for q, w in reached.items()}, steps)
    return {item[1]: w for item, w in final.items() if item[0] == "behind"}


def repair(rows: list[Row]) -> Weight:
    """Cost and audit of the lightest repair of a whole conversation."""
    if len(rows) <= CHUNK:
        return lightest(_facts(rows) | {("at", 0, START): (0, "")}, _edits(rows) + _last(len(rows)), GOAL)[GOAL]
    return finish({q: w for (_, q), w in ways(rows, [START]).items()})


def finish(reached: dict[int, Weight]) -> Weight:
    return lightest({("at", 0, q): w for q, w in reached.items()}, _last(0), GOAL)[GOAL]


def repaired(rows: list[Row], audit: str, state: int = START) -> Iterator[str]:
    """The lines ``role:text`` that an audit leaves of rows, from a state on."""
    left = iter(rows)
    for letter in audit:
        row = next(left) if letter != "I" else None
        if letter == "D":
            continue
        state = _KEPT[state, row.role[:1]] if letter == "K" else _NEXT[state]
        yield f"{row.role if letter == 'K' else _ROLE[state]}:{row.text if row else ''}"


class Seen:
    """Rows of one conversation in order, with their faults counted."""

    def __init__(self, earlier: list[str] = ()) -> None:
        self.rows: list[Row] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.least = self.most = None
        self.n_turns, self.digests = 0, set(earlier)

    def add(self, turn: int | None, role: str, text: str, digest: str) -> None:
        stripped = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not stripped else "duplicate" if digest in self.digests else "truncated" if stripped[-1] not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        self.digests.add(digest)
        self.counts["illegal"] += bool(self.rows) and self.rows[-1].role[:1] + role[:1] not in LEGAL
        self.rows.append(Row(role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        if turn is not None:
            self.n_turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def result(self) -> dict:
        cost, audit = repair(self.rows)
        state = hashlib.sha256("\n".join(repaired(self.rows, audit)).encode())
        gaps = _gaps(self.least, self.most, self.n_turns)
        return self.counts | {"gaps": gaps, "cost": cost, "audit": audit, "repaired_sha256": state.hexdigest()}


def _gaps(least: int | None, most: int | None, n_turns: int) -> int:
    return most - least + 1 - n_turns if n_turns else 0


def _fate() -> Column:
    """What happens to a row, 0 to 19."""
    names = [F.coalesce(F.col(n).cast("long").cast("string"), F.lit(" ")) for n in ("conv_id", "turn")]
    return F.crc32(F.concat(names[0], F.lit(":"), names[1])) % 20


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, digest: what crc32 of conv_id:turn does to each row; nulls count as one space."""
    space, conv_id, turn = F.lit(" "), F.col("conv_id").cast("long"), F.col("turn").cast("long")
    fate = _fate()
    role = F.when(fate == 4, F.lit(USER)).otherwise(F.coalesce("role", space))
    text = F.coalesce("text", space)
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.select(conv_id.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), fate.alias("_fate"))
    digest = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))
    copies = F.when(F.col("_fate") == 3, 2).otherwise(1)
    return rows.where("_fate != 0").select("conv_id", "turn", "role", "text", copies.alias("copies"), digest.alias("digest"))


def _arrow_fields(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    ways_ = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    return pa.schema([(n, kinds.get(t, ways_)) for n, t in (part.split(" ", 1) for part in ddl.replace(_WAYS, "ways").split(", "))])


class Out:
    """Rows on their way out, in batches of bounded bytes."""

    def __init__(self, ddl: str) -> None:
        self.schema, self.rows, self.bytes = _arrow_fields(ddl), [], 0

    def add(self, row: dict, size: int = 200) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if self.bytes > BATCH_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
            self.rows, self.bytes = [], 0


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for first in range(0, len(batch), 1000):
            yield from batch.slice(first, 1000).to_pylist()


_NOTHING = object()


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations that neither begin nor end the slice; the rows of those two as they are."""
    out, current, opening, held = Out(_FIRST), _NOTHING, True, []
    for row in _rows_of(batches):
        if row["conv_id"] != current or current is _NOTHING:
            if held:
                yield from out.add(_repaired_row(current, held), 500)
            opening, held, current = current is _NOTHING, [], row["conv_id"]
        if opening:
            yield from out.add(row | {"kind": "part"}, len(row["text"]) + 200)
        else:
            held.append(row)
    for row in held:
        yield from out.add(row | {"kind": "part"}, len(row["text"]) + 200)
    yield from out.rest()


def _seen(rows: list[dict], earlier: list[str] = ()) -> Seen:
    seen = Seen(earlier)
    for row in rows:
        for _ in range(row["copies"]):
            seen.add(row["turn"], row["role"], row["text"], row["digest"])
    return seen


def _repaired_row(conv_id: int | None, rows: list[dict]) -> dict:
    return {"kind": "whole", "conv_id": conv_id} | _seen(rows).result()


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict | None, list[dict]]]:
    """((conv_id, slice), the row with tag 0 if there is one, the others) from sorted rows."""
    key, head, held = _NOTHING, None, []
    for row in _rows_of(batches):
        at = (row["conv_id"], row["slice"])
        if key is _NOTHING or at != key:
            if held:
                yield key, head, held
            key, head, held = at, None, []
        if row["tag"] == 0:
            head = row
        else:
            held.append(row)
    if held:
        yield key, head, held


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(_SEGMENT)
    for (conv_id, slice_), head, rows in _stretches(batches):
        seen = _seen(rows, head["earlier"] if head else ())
        found = [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in ways(seen.rows).items()]
        row = {"conv_id": conv_id, "slice": slice_, "least": seen.least, "most": seen.most, "n_turns": seen.n_turns, "ways": found}
        row |= seen.counts | {"head": seen.rows[0].role[:1], "tail": seen.rows[-1].role[:1]}
        yield from out.add(row, 16 * len(seen.rows) + 500)
    yield from out.rest()


class Whole:
    """A conversation put together from its segments in order; for each state the lightest way to it and its parts."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.counts = conv_id, dict.fromkeys(_COUNTS, 0)
        self.least = self.most = self.tail = None
        self.n_turns, self.slices = 0, []
        self.reached: dict[int, Weight] = {START: (0, "")}
        #: Behind each segment: how long the audit of each state is there, and the state before the segment.
        self.lengths: list[dict[int, tuple[int, int]]] = []

    def add(self, segment: dict) -> None:
        for name in _COUNTS:
            self.counts[name] += segment[name]
        if self.tail is not None:
            self.counts["illegal"] += self.tail + segment["head"] not in LEGAL
        self.tail = segment["tail"]
        if segment["n_turns"]:
            self.n_turns += segment["n_turns"] - (self.most == segment["least"])
            self.least = segment["least"] if self.least is None else self.least
            self.most = segment["most"]
        self.slices.append(segment["slice"])
        through = {(w["p"], w["q"]): (w["cost"], w["audit"]) for w in segment["ways"]}
        before, self.reached = self.reached, _through(self.reached, through)
        came = {}
        for q, (cost, audit) in self.reached.items():
            came[q] = (len(audit), next(p for p, w in before.items() if (p, q) in through and _joined(w, through[p, q]) == (cost, audit)))
        self.lengths.append(came)

    def rows(self) -> Iterator[dict]:
        """The result, without its hash, and the part of the audit that each slice applies, with the state it begins in."""
        cost, audit = finish(self.reached)
        gaps = _gaps(self.least, self.most, self.n_turns)
        yield {"kind": "result", "conv_id": self.conv_id, "gaps": gaps, "cost": cost, "audit": audit} | self.counts
        state = next(q for q, w in self.reached.items() if audit.startswith(w[1]) and finish({q: w}) == (cost, audit))
        end = len(audit)
        for k in reversed(range(len(self.slices))):
            before = self.lengths[k][state][1]
            first = self.lengths[k - 1][before][0] if k else 0
            yield {"kind": "apply", "conv_id": self.conv_id, "slice": self.slices[k], "state": before, "audit": audit[first:end]}
            state, end = before, first


def _joined(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments to results and parts of audits."""
    out, whole = Out(_MERGED), None
    for segment in _rows_of(batches):
        if whole is None or whole.conv_id != segment["conv_id"]:
            for row in whole.rows() if whole else ():
                yield from out.add(row, len(row["audit"]) + 200)
            whole = Whole(segment["conv_id"])
        whole.add(segment)
    for row in whole.rows() if whole else ():
        yield from out.add(row, len(row["audit"]) + 200)
    yield from out.rest()


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired lines of each slice, in pieces."""
    out = Out("conv_id long, slice long, part long, piece string")
    for (conv_id, slice_), head, rows in _stretches(batches):
        lines, size, part = [], 0, 0
        for line in repaired(_seen(rows).rows, head["audit"], head["state"]):
            lines.append(line)
            size += len(line)
            if size > BATCH_BYTES // 4:
                yield from out.add({"conv_id": conv_id, "slice": slice_, "part": part, "piece": "\n".join(lines)}, size)
                lines, size, part = [], 0, part + 1
        if lines:
            yield from out.add({"conv_id": conv_id, "slice": slice_, "part": part, "piece": "\n".join(lines)}, size)
    yield from out.rest()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's pieces joined by newlines; only one piece is held at a time."""
    out, current, state = Out("conv_id long, hash string"), _NOTHING, None
    for batch in batches:
        for conv_id, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
            if current is not _NOTHING and conv_id == current:
                state.update(b"\n")
            else:
                if current is not _NOTHING:
                    yield from out.add({"conv_id": current, "hash": state.hexdigest()})
                current, state = conv_id, hashlib.sha256()
            state.update(piece.as_buffer())
    if current is not _NOTHING:
        yield from out.add({"conv_id": current, "hash": state.hexdigest()})
    yield from out.rest()


def _across(parts: DataFrame) -> DataFrame:
    """RESULT of the conversations whose rows lie at borders of slices."""
    empty = F.lit(None).cast("array<string>")
    rows = parts.select("conv_id", "slice", F.lit(1).alias("tag"), "turn", "role", "text", "copies", "digest")
    # what a slice's conversation has said in slices before; a slice has each digest once, however often it occurs
    distinct = parts.groupBy("conv_id", "slice", "digest").agg(F.lit(1).alias("_one")).drop("_one")
    distinct = written(distinct, "digests")
    firsts = distinct.groupBy("conv_id", "digest").agg(F.min("slice").alias("_first"), F.max("slice").alias("_last")).where("_first < _last")
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest"), "_first")
    again = distinct.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))).where("slice > _first")
    earlier = again.groupBy("conv_id", "slice").agg(F.collect_list("digest").alias("earlier"))
    blank = {"tag": F.lit(0), "turn": F.lit(None).cast("long"), "role": F.lit(""), "text": F.lit(""), "copies": F.lit(0), "digest": F.lit("")}
    heads = earlier.withColumns(blank).select(*rows.columns, "earlier")

    def in_order(frame: DataFrame) -> DataFrame:
        return frame.repartition("conv_id", "slice").sortWithinPartitions("conv_id", "slice", "tag", "turn", "digest")

    segments = written(in_order(rows.withColumn("earlier", empty).unionByName(heads)).mapInArrow(_segments, _SEGMENT), "segments")
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "slice")
    merged = written(ordered.mapInArrow(_merge, _MERGED), "merged")
    applied = merged.where("kind = 'apply'").select("conv_id", "slice", "audit", "state").withColumns(blank)
    told = rows.withColumns({"audit": F.lit(None).cast("string"), "state": F.lit(None).cast("int")})
    lines = in_order(told.unionByName(applied.select(*told.columns))).mapInArrow(_apply, "conv_id long, slice long, part long, piece string")
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "part").select("conv_id", "piece")
    hashes = lines.mapInArrow(_hashes, "conv_id long, hash string").select(F.col("conv_id").alias("_conv"), "hash")
    results = merged.where("kind = 'result'").drop("kind", "slice", "state")
    joined = results.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return joined.withColumn("repaired_sha256", F.coalesce("hash", F.sha2(F.lit(""), 256))).drop("hash")


def repair_conversations(conversations: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conv_id.

    Rows are damaged first (``damaged``), then taken in order of turn, nulls
    first; rows of one turn are in order of the digest of role and text, so
    equal ones stand together. A row's faults are, in this order: blank (nothing
    but white space), duplicate (role and text as in an earlier row), truncated
    (the last character is not a final mark). A null conv_id is a conversation of
    its own. One of which no row is left has zeros, no audit and the hash of
    nothing. Repeated rows are duplicates, other columns are ignored, an empty
    table gives an empty result.

    The audit and the hash of a conversation are one value each; nothing else of
    it is brought into one task.
    """
    spark = conversations.sparkSession
    slices = max(1, -(-conversations.count() // slice_rows))
    rows = damaged(conversations).withColumn("_place", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(slices, "conv_id", "turn", "digest", "_place").sortWithinPartitions("conv_id", "turn", "digest")
    sliced = dealt.drop("_place").withColumn("slice", F.spark_partition_id().cast("long"))
    path = scratch_path(spark, "repairs")
    sliced.mapInArrow(_first_pass, _FIRST).write.partitionBy("kind").parquet(path)
    found = spark.read.schema(_FIRST).parquet(path)
    names = _arrow_fields(RESULT).names
    whole = found.where("kind = 'whole'").select(*names)
    across = _across(found.where("kind = 'part'"))
    kept = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.max(_fate() != 0).alias("_kept")).where("NOT _kept")
    zeros = {n: F.lit(0).cast("long") for n in ("gaps", *_COUNTS, "cost")}
    none = kept.withColumns(zeros | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)})
    return whole.unionByName(across.select(*names)).unionByName(none.select(*names))
