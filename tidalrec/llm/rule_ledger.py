"""Rule bitmask ledger: each rule once, then policies and ablations on bits.

``ledger`` measures every document in one pass of built-in expressions and
stores the measurements plus one failure bit per rule.  Policies are masks
over those bits, so changing a policy never reads a text again, and ablations
are aggregates of the bits alone.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: a null or empty text has no
words and fails ``too_few_words``; rows are independent, so repeated rows and
repeated ids give repeated results; an empty table gives an empty ledger;
other columns are never read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidalrec.llm.common import let

SPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
WINDOW = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_upper", "n_shouts")


@dataclass(frozen=True)
class Rule:
    """``fails`` maps a struct of measurements to a boolean column."""
    name: str
    fails: object


#: Bit i of ``fail_bits`` belongs to RULES[i]; append only, so stored bits keep their meaning.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 4 * m["n_symbols"] > m["n_words"]),
    Rule("duplicate_lines", lambda m: (m["n_dup_lines"] >= 3) & (10 * m["n_dup_lines"] > 3 * m["n_lines"])),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 25 * m["n_words"])),
    Rule("upper_case", lambda m: 2 * m["n_upper"] > m["word_chars"]),
    Rule("shouting", lambda m: 4 * m["n_shouts"] > m["n_words"]),
)
BIT = {r.name: 1 << i for i, r in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of the filter: a document goes if it fails any rule named."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in set(self.rules))


BASE = Policy("base", ("too_few_words", "repeated_windows"))
V1 = Policy("v1", tuple(r.name for r in RULES))


def _replaced_length(text: Column, pattern: str) -> Column:
    """Number of characters that the pattern covers."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _neighbours(items: Column, same) -> Column:
    """The items of a sorted array that are the same as the one before or after (null beyond the ends)."""
    return F.filter(items, lambda x, i: same(x, F.get(items, i + 1)) | same(x, F.get(items, i - 1)))


def _repeat_words(words: Column, n: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the text.

    Windows are sorted as (32-bit hash, position) packed into one long, so the
    sort is a primitive one; windows that share a hash are then compared as
    strings, so the count is exact.
    """
    gram = lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(WINDOW)))
    packed = F.transform(
        F.slice(words, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.shiftleft(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), 32)
        .bitwiseOR(i.cast("long")))
    position = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")
    maybe = let(F.sort_array(packed), lambda s: _neighbours(
        s, lambda x, y: F.shiftrightunsigned(x.bitwiseXOR(y), 32) == 0))
    grams = F.transform(maybe, lambda x: F.struct(gram(position(x)).alias("g"), position(x).alias("p")))
    sure = let(F.sort_array(grams), lambda s: _neighbours(s, lambda x, y: x["g"] == y["g"]))
    starts = F.sort_array(F.transform(sure, lambda x: x["p"]))
    return let(starts, lambda s: _sum(F.transform(s, lambda p, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - p, F.lit(WINDOW))).cast("long"))))


def measure(text: Column) -> Column:
    """Struct of MEASURES for one text (long each)."""
    def of(t: Column) -> Column:
        trimmed = F.trim(t, F.lit(SPACE))
        words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))
        lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
        by_word = let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.char_length(F.array_join(w, "")).cast("long").alias("c"),
            _repeat_words(w, F.size(w)).alias("r")))
        by_line = let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
        return F.transform(F.array(F.struct(by_word.alias("w"), by_line.alias("l"))), lambda m: F.struct(
            m["w"]["n"].alias("n_words"), m["w"]["c"].alias("word_chars"),
            _replaced_length(t, r"[#*$%&|<>]+").alias("n_symbols"),
            m["l"]["n"].alias("n_lines"), m["l"]["d"].alias("n_dup_lines"),
            m["w"]["r"].alias("n_repeat_words"),
            _replaced_length(t, r"\p{Lu}+").alias("n_upper"),
            _replaced_length(t, "!+").alias("n_shouts")))
    return F.get(F.get(F.transform(F.array(F.coalesce(text, F.lit(""))), of), F.lit(0)), F.lit(0))


def fail_bits(m: Column) -> Column:
    """Failure bits of a measurement struct, every rule evaluated once."""
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(r.fails(m), F.lit(BIT[r.name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the MEASURES, ``fail_bits``."""
    m = docs.select(F.col(id_col), measure(F.col(text_col)).alias("m"))
    bits = let(F.col("m"), fail_bits)
    return m.select(id_col, *(F.col("m")[x].alias(x) for x in MEASURES), bits.alias("fail_bits"))


def apply_policy(led: DataFrame, policy: Policy, column: str = "kept") -> DataFrame:
    """The ledger with the policy's verdict; no text is read."""
    return led.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def bit_counts(led: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Documents per failure pattern: at most 2^len(RULES) rows per group, combined map-side."""
    return led.groupBy(*(by or []), "fail_bits").agg(F.count(F.lit(1)).alias("n_docs"))


def ablations(led: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects.

    Rows: rule, n_failed, n_only (would be kept without the rule), n_rejected
    (by the whole policy), seen_with (OR of the other bits that occur with it),
    always_with (AND of them).
    """
    mask = F.lit(policy.mask).cast("long")
    counts = bit_counts(led).withColumn("bits", F.col("fail_bits").bitwiseAND(mask))
    total = counts.agg(F.coalesce(F.sum(F.when(F.col("bits") != 0, F.col("n_docs"))), F.lit(0)).alias("n_rejected"))
    bits = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                     for r in sorted(set(policy.rules), key=BIT.get)))
    hit = counts.select("bits", "n_docs", F.explode(bits).alias("r")).select("bits", "n_docs", "r.*")
    others = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    per_rule = hit.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(fails, F.col("n_docs"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n_docs"))), F.lit(0)).alias("n_only"),
        F.coalesce(F.bit_or(F.when(fails, others)), F.lit(0)).alias("seen_with"),
        F.coalesce(F.bit_and(F.when(fails, others)), F.lit(0)).alias("always_with"))
    return per_rule.join(F.broadcast(total))


def keep(docs: DataFrame, policy: Policy = V1, text_col: str = "text") -> DataFrame:
    """The rows that the policy keeps, with their columns as they are."""
    bits = let(measure(F.col(text_col)), fail_bits)
    return docs.where(bits.bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def op4_rule_ledger(spark, sf_dir: str) -> DataFrame:
    """Verdict of policy v1 for every document."""
    from tidalrec.llm.common import load
    led = apply_policy(apply_policy(ledger(load(spark, sf_dir, "documents")), V1), BASE, "base_kept")
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~F.col("base_kept")).alias("base_failed"),
                      (F.col("base_kept") & F.col("kept")).alias("kept"), "fail_bits")
