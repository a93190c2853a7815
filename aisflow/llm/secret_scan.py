"""Secret scans with an incremental blob ledger.

A text is a blob, addressed by the SHA-256 of its bytes; any number of paths
(documents, versions) may point to it. The ledger keeps, per blob and rule
version, the spans found. A scan reads only the pairs it has not seen: a new
version of one rule runs that rule alone, a new document with known content
runs nothing. Findings are joined back to all paths.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aisflow.llm.columns import let
from aisflow.storage import job, scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern; ``least`` is the length that its group 1 must have, ``needs`` are strings of
    which every match holds one. ``unless`` is a string and a pattern that finds the same in texts
    without that string. The order of rules gives the rank of spans with equal starts."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    needs: tuple[str, ...] = ()
    unless: tuple[str, str] | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


_ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)

#: A key block: its first line; fields such as DEK-Info; then base64 (with indents or escaped line ends) up to the
#: last line. Without a last line the block ends with the last line that is all base64. Where neither is found, as with
#: quote signs, list marks, string concatenation, line numbers, markup or very many fields, it goes to the nearest last
#: line, whatever stands between. Loops over lines of any number are loops over characters, as a loop over groups would
#: take stack in Java; of fields there are a few.
_KEY = r"[A-Z\x20]{0,40}PRIVATE KEY(?:\x20BLOCK)?-----"
_FIELDS = r"(?:[A-Za-z][A-Za-z0-9-]*:\x20[^\r\n]*[\r\n]+[\x20\t]*){0,20}"
_OPEN_KEY = rf"[\x20\t]*[\r\n]+{_FIELDS}[\r\n]*[A-Za-z0-9+/=][A-Za-z0-9+/=\r\n]*(?:[\r\n]|\z)"
_PRIVATE_KEY = (
    rf"-----BEGIN {_KEY}(?:[\x20\t\r\n]*{_FIELDS}[A-Za-z0-9+/=\x20\t\r\n\\]*-----END {_KEY}|{_OPEN_KEY}|(?s:.*?)-----END {_KEY})?"
)
#: The same for texts without any last line, where the search for one from every first line would be in vain.
_PRIVATE_KEY_OPEN = rf"-----BEGIN {_KEY}(?:{_OPEN_KEY})?"

#: A run of at least so many characters is all of a longest run that passes the same test, so access
#: and hex take the bound into the pattern; a short assignment uses up its characters, so it is tested after.
RULES = [
    Rule("assign", 1, _ASSIGN, 8, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", needs=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("private_key", 3, _PRIVATE_KEY, needs=("-----BEGIN ",), unless=("-----END ", _PRIVATE_KEY_OPEN)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", needs=("eyJ",)),
]
BASE_KINDS = ["assign", "access", "hex"]
MASK = "[SECRET]"
#: Code points of a block of text that is masked; stretches (16 bytes each) that may be broadcast.
BLOCK_CHARS = 1000
BROADCAST_STRETCHES = 1_000_000

_STEPS = "array<struct<gap:int,len:int,ok:boolean>>"
LEDGER_SCHEMA = "blob binary, rule string, spans array<struct<start:bigint,end:bigint>>"


def blob_of(text: Column) -> Column:
    """Address of a text's content; a null text is the empty blob."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _steps(text: Column, rule: Rule) -> Column:
    """For each match, in order: code points since the one before, its own, and whether it passes."""

    def step(gap: Column, match: Column) -> Column:
        passes = F.char_length(F.regexp_extract(match, rule.pattern, 1)) >= rule.least if rule.least else F.lit(True)
        return F.struct(F.char_length(gap).alias("gap"), F.char_length(match).alias("len"), passes.alias("ok"))

    def matches(pattern: str) -> Column:
        gaps = F.split(text, pattern, -1)
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.filter(F.zip_with(gaps, found, step), lambda s: s["len"].isNotNull())

    some = matches(rule.pattern)
    if rule.unless:
        some = F.when(F.contains(text, F.lit(rule.unless[0])), some).otherwise(matches(rule.unless[1]))
    likely = F.lit(not rule.needs)
    for literal in rule.needs:
        likely |= F.contains(text, F.lit(literal))
    return F.when(likely & F.regexp_like(text, F.lit(rule.pattern)), some).otherwise(F.array().cast(_STEPS))


def scan(blobs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """LEDGER_SCHEMA for every row of (blob, text, due) and every rule whose key is in ``due``.

    Spans are code points, end exclusive, leftmost and non-overlapping per rule.
    Splitting by a pattern gives what lies between its matches; running sums of
    both lengths, over the matches of one blob and rule, are the places.
    """
    each = F.array(
        *[
            F.when(F.array_contains("due", r.key), F.struct(F.lit(r.key).alias("rule"), _steps(F.col("text"), r).alias("steps")))
            for r in rules
        ]
    )
    stepped = blobs.select("blob", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("r")).select("blob", "r.*")
    placed = stepped.select("blob", "rule", F.posexplode_outer("steps").alias("at", "s"))
    upto = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = placed.withColumn("end", F.sum(F.col("s.gap").cast("long") + F.col("s.len")).over(upto))
    span = F.when(F.col("s.ok"), F.struct((F.col("end") - F.col("s.len")).alias("start"), F.col("end").alias("end")))
    return ends.groupBy("blob", "rule").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # without rows from Python, which would start workers in every executor
        kinds = StructType.fromDDL(LEDGER_SCHEMA)
        return spark.range(0).select(*[F.lit(None).cast(field.dataType).alias(field.name) for field in kinds])


def update(docs: DataFrame, ledger_path: str, rules: list[Rule] = RULES, text: str = "text") -> None:
    """Scans the pairs of blob and rule version that the ledger lacks and appends them; none for
    an empty table. A null text is the empty blob, other columns are ignored.

    One text per blob is shuffled, whatever its number of copies. The append is
    one job, whose files appear when it commits: a run that fails leaves the
    ledger as it was and may be repeated. Runs on one ledger must not overlap.
    """
    seen = read_ledger(docs.sparkSession, ledger_path).groupBy("blob").agg(F.collect_set("rule").alias("_seen"))
    blobs = docs.select(blob_of(F.col(text)).alias("blob"), F.coalesce(text, F.lit("")).alias("text")).dropDuplicates(["blob"])
    keys = F.array(*[F.lit(rule.key) for rule in rules])
    due = F.when(F.col("_seen").isNull(), keys).otherwise(F.array_except(keys, "_seen"))
    pending = blobs.join(seen, "blob", "left").select("blob", "text", due.alias("due")).where(F.size("due") > 0)
    scan(pending, rules).write.mode("append").parquet(ledger_path)


def findings(spark: SparkSession, ledger_path: str, rules: list[Rule] = RULES) -> DataFrame:
    """blob, spans: all spans of the given rule versions, ordered by start and rule; blobs with none are left out.

    Should a pair be in the ledger twice, its spans count once.
    """
    rank = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.key), F.struct(F.lit(k).alias("rank"), F.lit(r.kind).alias("kind")))])
    rows = read_ledger(spark, ledger_path).where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
    ranked = rows.select("blob", F.element_at(rank, F.col("rule")).alias("r"), F.explode("spans").alias("s"))
    one = F.struct("s.start", "r.rank", "r.kind", "s.end")
    return ranked.groupBy("blob").agg(F.array_sort(F.collect_set(one)).alias("spans"))


def with_findings(docs: DataFrame, ledger_path: str, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents with ``spans``, an array of (start, rank, kind, end), empty where nothing was found.

    A document column named ``spans`` is replaced. Copies are joined by address
    only, each of them with the one row of its blob.
    """
    found = findings(docs.sparkSession, ledger_path, rules).withColumnsRenamed({"blob": "_blob", "spans": "_spans"})
    joined = docs.withColumn("_address", blob_of(F.col(text))).join(found, F.col("_address") == F.col("_blob"), "left")
    none = F.filter(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).alias("rank"), F.lit("").alias("kind"), F.lit(0).cast("long").alias("end"))), lambda _: F.lit(False))
    return joined.withColumn("spans", F.coalesce("_spans", none)).drop("_address", "_blob", "_spans")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def stretches(spark: SparkSession, ledger_path: str, rules: list[Rule] = RULES) -> DataFrame:
    """blob, stretches: what the spans of each blob cover, as an array of (start, end) in order.
    Spans that overlap or touch are one stretch; blobs without spans are left out."""
    rows = read_ledger(spark, ledger_path).where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
    each = rows.select("blob", F.explode("spans").alias("s")).select("blob", "s.*")
    before = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    upto = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = each.withColumn("_fresh", fresh.cast("int")).withColumn("_n", F.sum("_fresh").over(upto))
    joined = numbered.groupBy("blob", "_n").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("stretches"))


def masked(text: Column, covered: Column) -> Column:
    """The text with every stretch of ``covered``, which are in order and apart, replaced by MASK.

    The text is cut into blocks once; what lies between two stretches is taken
    from the blocks that hold it, so the work grows with the text and not with
    the number of stretches times the text.
    """

    def body(blocks: Column) -> Column:
        def piece(a: Column, b: Column) -> Column:
            first, last = F.floor(a / BLOCK_CHARS).cast("int"), F.floor((b - 1) / BLOCK_CHARS).cast("int")
            within, until = (a % BLOCK_CHARS + 1).cast("int"), (b - last * BLOCK_CHARS).cast("int")
            alone = F.substring(F.get(blocks, first), within, (b - a).cast("int"))
            inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
            several = F.concat(F.substring(F.get(blocks, first), within, F.lit(BLOCK_CHARS)), inner, F.substring(F.get(blocks, last), F.lit(1), until))
            return F.when(a >= b, F.lit("")).when(first == last, alone).otherwise(several)

        begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(covered, lambda s: s["end"]))
        ends = F.concat(F.transform(covered, lambda s: s["start"]), F.array(F.char_length(text).cast("long")))
        return F.array_join(F.zip_with(begins, ends, piece), MASK)

    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    return F.when(F.size(covered) > 0, let(blocks, body)).otherwise(text)


def redact(docs: DataFrame, ledger_path: str | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """The documents with their secrets masked and ``n_chars``, where there is one, counted anew
    for changed texts; rows, columns and clean texts stay as they are. A null text stays null,
    an empty table gives an empty one. Without a ledger a new one is used for this call.

    What is found is counted: little is broadcast, so that texts stay where they are; more is joined by address.
    """
    spark, place = docs.sparkSession, scratch_path(docs.sparkSession, "stretches")
    with job(spark):
        path = ledger_path or scratch_path(spark, "secret-ledger")
        update(docs, path, rules)
        covered = stretches(spark, path, rules).withColumnsRenamed({"blob": "_blob", "stretches": "_covered"})
        covered.write.parquet(place)
    covered = spark.read.schema(covered.schema).parquet(place)
    many = covered.agg(F.sum(F.size("_covered") + 4)).first()[0] or 0
    names = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select("text", F.struct(*names).alias("_row"), blob_of(F.col("text")).alias("_address"))
    found = packed.join(F.broadcast(covered) if many <= BROADCAST_STRETCHES else covered, F.col("_address") == F.col("_blob"), "left")
    changed = F.col("_covered").isNotNull()
    found = found.withColumn("_masked", F.when(changed, masked(F.col("text"), F.col("_covered"))).otherwise(F.col("text")))
    values = {"text": F.col("_masked")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(changed, F.char_length("_masked").cast("long")).otherwise(F.col("_row.n_chars"))
    return found.select(*[values.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
