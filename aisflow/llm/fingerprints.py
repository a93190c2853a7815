"""Document fingerprints: Merkle trees over sections and paragraphs.

Leaves are sentences (runs of at most LEAF_WORDS words), a paragraph's node
hashes its leaves, a section's its paragraphs, the root its sections. Paragraphs
are lines; a section ends after a paragraph whose own hash says so, hence an
edit moves no border but those next to it. Equal roots mean equal texts; where
roots differ, a comparison goes down into the differing branches only.

The fingerprint is text: the root, a bar, then sections separated by ``;``,
paragraphs by ``,``, leaves by ``.``. Every inner hash can be computed from it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisflow.llm.columns import let, position_in
from aisflow.storage import written

#: Words of a leaf at most; hex digits of a leaf's hash.
LEAF_WORDS = 16
LEAF_DIGITS = 12
#: Documents in a slice of the ordered corpus, about, and slices at most: beyond both, slices grow.
SLICE_ROWS = 10_000
MOST_SLICES = 20_000
#: Copies of a busy text that one row stands for while they are laid out.
COPIES_AT_ONCE = 1_000

_WORD, _END = r"[^\x20\x09-\x0D]", r"[^\x20\x09-\x0D.!?]"
#: A word run that stops after a word with a final mark.
LEAF = rf"(?:{_WORD}*{_END}[\x20\x09-\x0D]+){{0,{LEAF_WORDS - 1}}}{_WORD}+"
#: First digits of a paragraph's hash that end a section: one paragraph in four.
SECTION_ENDS = "^[0-3]"


def _digest(text: Column) -> Column:
    return F.substring(F.md5(text), 1, LEAF_DIGITS)


def branches(text: Column) -> Column:
    """Leaf hashes as text, without the root."""

    def paragraph(line: Column) -> Column:
        return F.array_join(F.transform(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), _digest), ".")

    def closed(leaves: Column) -> Column:
        return F.concat(leaves, F.when(F.regexp_like(F.md5(leaves), F.lit(SECTION_ENDS)), F.lit(";")).otherwise(F.lit(",")))

    joined = F.array_join(F.transform(F.transform(F.split(text, "\n"), paragraph), closed), "")
    return F.regexp_replace(joined, "[,;]$", "")


def section_hashes(fingerprint: Column) -> Column:
    """The hashes of a fingerprint's sections, each over its paragraphs' hashes."""
    sections = F.split(F.substring_index(fingerprint, "|", -1), ";")
    hashed = F.transform(sections, lambda s: F.md5(F.array_join(F.transform(F.split(s, ","), lambda p: F.md5(p)), ",")))
    return hashed


def fingerprint_of(text: Column) -> Column:
    """Fingerprint of a text; a null text counts as empty.

    The root covers the section hashes and, as leaves leave out white space, the
    text's own hash: equal roots mean texts equal to the last character.
    """
    body = F.coalesce(text, F.lit(""))

    def rooted(leaves: Column) -> Column:
        top = F.sha2(F.concat_ws(",", section_hashes(F.concat(F.lit("|"), leaves)), F.sha2(body, 256)), 256)
        return F.concat(top, F.lit("|"), leaves)

    return let(branches(body), rooted)


def root_of(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, "|", 1)


def _leaves(sections: Column) -> Column:
    """The distinct leaves of some sections, each as text."""
    return F.array_remove(F.array_distinct(F.split(F.array_join(sections, ";"), "[.,;]")), "")


def leaves_of(fingerprint: Column) -> Column:
    """The distinct leaves of a fingerprint."""
    return _leaves(_sections(fingerprint))


def _sections(fingerprint: Column) -> Column:
    return F.split(F.substring_index(fingerprint, "|", -1), ";")


def _descent(left: Column, right: Column) -> tuple[Column, Column, Column]:
    """Sections of both, of ``left`` alone and of ``right`` alone. A section of both needs no look
    inside: its leaves are leaves of both."""
    return F.array_intersect(left, right), F.array_except(left, right), F.array_except(right, left)


def likeness(left: Column, right: Column) -> Column:
    """Share of the leaves of either that both have, from 0 to 1; 1 where roots are
    equal. Differing texts without any leaf (white space only) have likeness 0.

    The comparison starts at the roots and goes down: equal roots end it, equal
    sections are taken whole, and leaves are compared within the differing ones.
    """

    def of_leaves(both: Column, mine: Column, other: Column) -> Column:
        common = F.size(F.array_union(both, F.array_intersect(mine, other)))
        every = F.size(F.array_union(F.array_union(both, mine), other))
        return F.when(every > 0, common / every).otherwise(F.lit(0.0))

    def of_sections(a: Column) -> Column:
        def with_right(b: Column) -> Column:
            both, mine, other = (_leaves(part) for part in _descent(a, b))
            return let(both, lambda x: let(mine, lambda y: let(other, lambda z: of_leaves(x, y, z))))

        return let(_sections(right), with_right)

    return F.when(root_of(left) == root_of(right), F.lit(1.0)).otherwise(let(_sections(left), of_sections))


def changed_sections(left: Column, right: Column) -> Column:
    """Places (from 0) of the sections of ``right`` that ``left`` does not have; empty
    where roots are equal, as then nothing below is compared."""

    def new_places(old: Column) -> Column:
        places = F.transform(section_hashes(right), lambda h, i: F.when(~F.array_contains(old, h), i))
        return F.filter(places, lambda place: place.isNotNull())

    none = F.filter(F.array(F.lit(0)), lambda _: F.lit(False))
    return F.when(root_of(left) == root_of(right), none).otherwise(let(section_hashes(left), new_places))


def _cut(keys: DataFrame, slice_rows: int) -> tuple[list[int], list, list]:
    """Cut points of doc_id, busy ids with the parts each is divided into, and busy (id, hash) pairs.

    All three are bounded by MOST_SLICES, whatever the number of documents:
    points are quantiles, and what is busy holds more than two slices of rows.
    """
    rows = keys.count()
    parts = min(MOST_SLICES, max(1, -(-rows // slice_rows)))
    if parts == 1:
        return [], [], []
    size = max(slice_rows, -(-rows // parts))
    shares = [k / parts for k in range(1, parts)]
    points = {int(p) for p in keys.approxQuantile("doc_id", shares, 0.1 / parts)}
    busy = keys.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * size).collect()
    pairs = keys.groupBy("doc_id", "_m").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * size).collect() if busy else []
    for row in busy:
        if row["doc_id"] is not None:
            # a busy id has slices of its own
            points |= {row["doc_id"], min(row["doc_id"] + 1, (1 << 63) - 1)}
    return sorted(points), [(row["doc_id"], -(-row["n"] // size)) for row in busy], [(row["doc_id"], row["_m"]) for row in pairs]


def with_next(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, text, next_text: every document with the one after it in descending doc_id.

    After the last comes the first; a single document is followed by itself.
    Null ids come last, and ties are put in order of the texts' hashes (equal
    texts are interchangeable). The corpus is cut into slices of neighbouring
    ids, and a repeated or null id into slices of neighbouring hashes, so no task
    holds more than a slice; equal rows that fill slices are one row of it, whose
    copies follow each other. The first document of each slice (one row a slice)
    is handed to the slice before it. Texts are shuffled once.
    """
    spark = docs.sparkSession
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    body = body.withColumn("_m", F.md5("text"))
    points, busy, pairs = _cut(written(body.select("doc_id", "_m"), "keys"), slice_rows)
    copies = None
    if pairs:
        named = F.broadcast(spark.createDataFrame(pairs, "_id long, _hash string"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_m") == F.col("_hash"))
        once = body.join(named, same, "left_semi").groupBy("doc_id", "_m").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("_n"))
        once = written(once, "busy-texts")
        body = body.join(named, same, "left_anti").unionByName(once.drop("_n"))
        chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 2) / COPIES_AT_ONCE))
        laid = once.withColumn("_chunk", F.explode(chunks)).repartition("doc_id", "_m", "_chunk")
        left = F.least(F.lit(COPIES_AT_ONCE).cast("long"), F.col("_n") - 1 - F.col("_chunk") * COPIES_AT_ONCE)
        copies = laid.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left))).select("doc_id", "text", F.col("text").alias("next_text"))
    slice_ = F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(-position_in(F.col("doc_id"), points))
    sliced = body.withColumn("_slice", slice_).withColumn("_sub", F.lit(0).cast("long"))
    if busy:
        known = F.broadcast(spark.createDataFrame(busy, "_id long, _parts long"))
        place = F.conv(F.substring("_m", 1, 8), 16, 10).cast("long")
        sub = F.coalesce(F.floor(place * F.col("_parts") / F.lit(1 << 32)), F.lit(0).cast("long"))
        sliced = sliced.join(known, F.col("doc_id").eqNullSafe(F.col("_id")), "left").withColumn("_sub", sub).drop("_id", "_parts")
    by = ["_slice", "_sub"]
    order = [F.col("doc_id").desc_nulls_last(), F.col("_m")]
    within = sliced.withColumn("_next", F.lead("text").over(Window.partitionBy(*by).orderBy(*order)))
    key = F.struct(F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit("10000000000000000000").cast("decimal(20,0)")), F.col("_m"))
    firsts = sliced.groupBy(*by).agg(F.min_by("text", key).alias("_first"))
    # one row a slice, which are bounded in number
    numbers = firsts.select(F.struct(*by).alias("_at"))
    before = F.lag("_at").over(Window.orderBy("_at"))
    last = F.max("_at").over(Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    to = numbers.select(F.col("_at._slice").alias("_slice"), F.col("_at._sub").alias("_sub"), F.coalesce(before, last).alias("_to"))
    heads = firsts.join(to, by).select(F.col("_to._slice").alias("_slice"), F.col("_to._sub").alias("_sub"), "_first")
    joined = within.join(heads, by, "left").select("doc_id", "text", F.coalesce("_next", "_first").alias("next_text"))
    return joined.unionByName(copies) if copies is not None else joined


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down) replaced by as many first code points of another."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def compare_with_edits(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Each document against an edited text of its own and against the next
    document (``with_next``). Null texts count as empty; an empty table gives an
    empty result; further columns are ignored; repeated rows stay.
    """
    pairs = with_next(docs, slice_rows).withColumn("_edited", edited(F.col("text"), F.col("next_text")))
    marked = pairs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint_of(F.col("text")).alias("fingerprint"),
        fingerprint_of(F.col("_edited")).alias("edited_fingerprint"),
        fingerprint_of(F.col("next_text")).alias("_next"),
    )
    return marked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
