"""Quality rules as a ledger: every rule is evaluated once, policies are masks over its failure bits.

``ledger`` reads each text once, and gives the measurements and one bit per failed rule; ``store`` writes them to the
shared folder. ``apply_policy`` and ``verdicts`` decide from the bits alone, so a new policy version never reads a text
again. ``ablation`` counts, for every policy and rule, what the policy rejects, what the rule alone is to blame for,
and what is left without it.

All of it is Spark expressions on one row: no shuffle but for the counts of an ablation, which are combined before
it, and no Python. Repeated three-word windows come from sorting one 64-bit number per window (a hash above, the
position below) and comparing neighbours, first by hash, then word by word.

Defined cases: a null or blank text has no word, all measurements 0, and fails ``few_words``. Repeated rows are
judged one by one. An empty table gives an empty ledger and ablation. Columns of the input other than the id and the text are
not read; ``keep`` returns them as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import BLANKS, land, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A rule with its place in the ledger; ``fails`` is an SQL condition over the measurements."""

    name: str
    bit: int
    fails: str


@dataclass(frozen=True)
class Policy:
    """A version of the policy: a document goes if it fails any of these rules."""

    version: str
    rules: tuple[str, ...]


#: A rule keeps its bit for good; a changed threshold is a new rule with a new bit.
RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("short_words", 4, "n_words > 0 AND word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 40 * n_words"),
    Rule("any_symbols", 6, "10 * n_symbols > n_words"),
)
BASE = ("few_words", "repeated_windows")
POLICIES = (
    Policy("base", BASE),
    Policy("v1", (*BASE, "many_symbols", "repeated_lines", "short_words", "long_words")),
    Policy("v2_strict", (*BASE, "any_symbols", "repeated_lines", "short_words", "long_words")),
)
PRODUCTION = "v1"


def mask(rules: tuple[str, ...]) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in set(rules))


def _measured(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the measurements, and with working columns (``w``, ``width``, ``ones``, ``lines``, ``marks``, ``found``)."""
    # ``width``: bits for a position in this text; the rest of the 64 hold the hash of its window. The last two
    # windows are short: a null never equals, so they are never found.
    marks = "sort_array(transform(w, (x, i) -> shiftleft(xxhash64(x, get(w, i + 1), get(w, i + 2)), width) | CAST(i AS BIGINT)))"
    place = lambda i: f"CAST(get(marks, {i}) & ones AS INT)"
    same = " AND ".join(f"get(w, {place('i')} + {k}) = get(w, {place('i + 1')} + {k})" for k in (0, 1, 2))
    alike = f"shiftrightunsigned(x ^ get(marks, i + 1), width) = 0 AND {same}"
    pairs = f"filter(transform(marks, (x, i) -> IF({alike}, i, -1)), i -> i >= 0)"
    step = lambda k: F.transform("found", lambda x: x + F.lit(k))
    texts = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("w", words(F.col(text)))
    df = df.withColumn("width", F.length(F.bin(F.size("w"))))
    df = df.withColumn("ones", F.expr("shiftleft(1L, width) - 1"))
    df = df.withColumn("lines", F.filter(F.split(texts, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0))
    df = df.withColumn("marks", F.expr(marks))
    df = df.withColumn("found", F.expr(f"flatten(transform({pairs}, i -> array({place('i')}, {place('i + 1')})))"))
    return df.withColumns(
        {
            "n_words": F.size("w").cast("long"),
            "word_chars": F.length(F.concat_ws("", "w")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(texts, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": F.size(F.array_union(F.array_union("found", step(1)), step(2))).cast("long"),
            "n_lines": F.size("lines").cast("long"),
        }
    )


def _bits() -> Column:
    out = F.lit(0).cast("long")
    for r in RULES:
        out = out.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return out


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the measurements, and ``fail_bits`` with the bit of every failed rule."""
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return _measured(slim, "text").select("doc_id", *MEASURES).withColumn("fail_bits", _bits())


def store(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger as a written table: policies and ablations after it read bits and measurements, never texts."""
    return land(spark, ledger(docs, doc_id, text), "quality-ledger")


def policy(version: str) -> Policy:
    return next(p for p in POLICIES if p.version == version)


def passes(bits: Column, version: str) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy(version).rules)).cast("long")) == 0


def apply_policy(entries: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """Ledger rows with ``base_failed`` and ``kept``, from their bits."""
    return entries.withColumns({"base_failed": ~passes(F.col("fail_bits"), "base"), "kept": passes(F.col("fail_bits"), version)})


def verdicts(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Ledger rows with ``kept_`` and the version, for every policy."""
    return entries.withColumns({f"kept_{p.version}": passes(F.col("fail_bits"), p.version) for p in policies})


def ablation(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy version and each of its rules: ``n_docs``, ``n_rejected``, ``n_failed`` (documents that fail
    the rule), ``n_alone`` (those that only this rule rejects: they come back without it), ``kept_without``.

    First the documents of every pattern of bits are counted (at most one row per pattern and task is shuffled), then
    policies look at patterns only.
    """
    patterns = entries.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cases = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(p.version).alias("version"),
                    F.lit(r.name).alias("rule"),
                    F.lit(mask(p.rules)).cast("long").alias("all_bits"),
                    F.lit(1 << r.bit).cast("long").alias("bit"),
                )
                for p in policies
                for r in RULES
                if r.name in p.rules
            ]
        )
    )
    hit = F.col("fail_bits").bitwiseAND(F.col("c.all_bits"))
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0)).cast("long")
    rows = patterns.select("fail_bits", "n", cases.alias("c")).groupBy("c.version", "c.rule").agg(
        F.sum("n").cast("long").alias("n_docs"),
        count(hit != 0).alias("n_rejected"),
        count(F.col("fail_bits").bitwiseAND(F.col("c.bit")) != 0).alias("n_failed"),
        count(hit == F.col("c.bit")).alias("n_alone"),
    )
    return rows.withColumn("kept_without", F.col("n_docs") - F.col("n_rejected") + F.col("n_alone"))


def keep(docs: DataFrame, version: str = PRODUCTION, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with the columns they came with."""
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    measured = _measured(docs.toDF(*own), own[names.index(text)])
    # The partition number, always there, keeps the filter above the measurements: pushed below them it would
    # repeat each of them for every rule.
    judged = measured.withColumn("bits", F.when(F.spark_partition_id() >= 0, _bits()))
    return judged.where(passes(F.col("bits"), version)).select(*own).toDF(*names)
