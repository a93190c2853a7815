"""Quality rules as a ledger of failure bits.

Every rule is evaluated once; a document gets its measurements and one integer
whose bits say which rules it fails. A policy is a named, versioned set of
rules, hence a mask: applying it, or asking what it would do without one of its
rules, is arithmetic on the stored bits and reads no text again.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisflow.llm.columns import let, text_or_empty, words_of
from aisflow.storage import written

#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"

MEASUREMENTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


def _window_hashes(words: Column) -> Column:
    """Hashes of the three-word windows."""
    length = F.greatest(F.size(words) - 2, F.lit(0))
    windows = F.arrays_zip(*[F.slice(words, first, length) for first in (1, 2, 3)])
    return F.transform(windows, lambda w: F.xxhash64(w))


def _with_repeats(frame: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words within a window that occurs twice or more, from the column _hashes.

    Equal 64-bit hashes count as equal windows. Only texts with a repetition are
    sorted. Each step is a column of its own that the next mentions twice, so it
    is computed once.
    """
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    frame = frame.withColumn("_placed", F.when(repeats, placed))
    length = F.size("_placed") - 1
    pairs = F.zip_with(
        F.slice("_placed", 1, length), F.slice("_placed", 2, length), lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"]))
    )
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    frame = frame.withColumn("_places", F.when(F.col("_placed").isNotNull(), places))
    # a window covers three words, or those up to the next repeated window
    gaps = F.zip_with(F.slice("_places", 2, F.size("_places")), "_places", lambda b, a: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    total = F.aggregate(gaps, F.lit(0), lambda sum_, gap: sum_ + gap)
    return frame.withColumn("n_repeat_words", F.when(F.col("_places").isNotNull(), total).otherwise(F.lit(0)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and MEASUREMENTS (all long) of every whole text.

    Words are runs of other than space and the controls 9 to 13. n_dup_lines
    counts lines with a word that equal an earlier line; n_lines all lines with
    a word; n_upper the letters that lower-casing changes. A null text measures
    as an empty one: all zero. Rows are independent, so repeated doc_ids stay. An
    empty table gives an empty result, other columns are ignored.
    """
    body = text_or_empty(text)
    split = docs.select("doc_id", body.alias("_text"), words_of(body).alias("_words"))

    def lines(of: Column) -> Column:
        return F.filter(F.split(of, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))

    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit("[#*$%&|<>]")),
        "_lines": let(lines(F.col("_text")), lambda found: F.struct(F.size(found), F.size(F.array_distinct(found)))),
        "n_upper": F.regexp_count("_text", F.lit(r"\p{Lu}")),
    }
    found = split.select("doc_id", _window_hashes(F.col("_words")).alias("_hashes"), *[v.alias(name) for name, v in measures.items()])
    found = _with_repeats(found)
    found = found.withColumns({"n_lines": F.col("_lines.col1"), "n_dup_lines": F.col("_lines.col1") - F.col("_lines.col2")})
    # out of an explode, so that Spark does not copy all of the above into each filter on a measurement
    values = F.struct(*[F.col(name).cast("long").alias(name) for name in MEASUREMENTS])
    return found.select("doc_id", F.explode(F.array(values)).alias("_values")).select("doc_id", "_values.*")


@dataclass(frozen=True)
class Rule:
    """A named test over the measurements; its bit is set where the test holds (the document fails)."""

    name: str
    bit: int
    fails: str


#: Bits are never reused: a changed rule gets a new name and bit.
RULES = [
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("long_or_short_words", 4, "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("capitals", 5, "2 * n_upper > word_chars"),
]


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: list[Rule] = RULES) -> int:
        bits = {rule.name: rule.bit for rule in rules}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
PRODUCTION = Policy("production", 1, tuple(rule.name for rule in RULES))


def ledger(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``measure`` and ``failed``: a long with a bit for every rule the text fails. A null or empty
    text fails what few words fail; an empty table gives an empty ledger."""
    if len({rule.bit for rule in rules}) < len(rules) or any(not 0 <= rule.bit < 63 for rule in rules):
        raise ValueError("rules need bits of their own, from 0 to 62")
    failed = F.lit(0).cast("long")
    for rule in rules:
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, text).withColumn("failed", failed)


def stored(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The ledger as a table in the shared folder: texts are read once, whatever is asked of the bits afterwards."""
    return written(ledger(docs, text, rules), "rule-ledger")


def verdicts(marks: DataFrame, base: Policy = BASE, policy: Policy = PRODUCTION, rules: list[Rule] = RULES) -> DataFrame:
    """Ledger rows with base_failed, kept, and what an ablation says of them: only_rule, the one rule
    of the policy that a row fails, null where it fails none or several, and only_rule_docs, how many
    rows would be kept without that rule. Read from the bits; the ablation is one row a rule."""
    failed = F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long"))
    only = F.lit(None).cast("string")
    for rule in rules:
        if rule.name in policy.rules:
            only = F.when(failed == 1 << rule.bit, F.lit(rule.name)).otherwise(only)
    told = marks.withColumns({"base_failed": fails(base, rules), "kept": ~fails(base, rules) & ~fails(policy, rules), "only_rule": only})
    without = ablations(marks, policy, rules).select(F.col("rule").alias("_rule"), F.col("n_only").alias("only_rule_docs"))
    return told.join(F.broadcast(without), F.col("only_rule") == F.col("_rule"), "left").drop("_rule")


def fails(policy: Policy, rules: list[Rule] = RULES) -> Column:
    """Whether a ledger row fails a policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) != 0


def ablations(marks: DataFrame, policy: Policy, rules: list[Rule] = RULES) -> DataFrame:
    """rule, n_failed, n_only: how many documents fail each rule of the policy, and how many
    of them would be kept without it. Documents are first counted by their bits, of which
    there are at most 2 ** rules combinations, so the ledger is aggregated once."""
    counts = marks.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long")).alias("_bits")).count()
    of_policy = [rule for rule in rules if rule.name in policy.rules]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in of_policy]))
    pairs = counts.select("_bits", "count", each.alias("r"))
    set_here = F.col("_bits").bitwiseAND(F.col("r.bit")) != 0
    return pairs.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(set_here, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("_bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_only"),
    )


def keep(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The documents that pass the policy, with all their columns. Rules look at one row
    at a time, so nothing is joined or shuffled. Columns named like a measurement stay."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col("text"))
    return ledger(packed).where(~fails(policy)).select("doc_id.*")
