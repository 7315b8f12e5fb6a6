"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations only combine bits.

DataFrame functions only. ``toxic_words`` learns from labelled documents which words toxic texts have and others
hardly ever do; ``ledger`` measures each text and stores one failure bit a rule; ``apply_policy`` keeps the rows that
fail none of a policy's rules; ``ablations`` counts, from the bits alone, what each policy rejects and what each of its
rules rejects that no other would.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WS = r"[\x20\x09-\x0D]+"
WS_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: A learned word is in so many toxic labelled documents at least, and in so many times as many as in others.
TOXIC_DOCS, TOXIC_TIMES = 4, 20


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements, at a fixed bit."""

    name: str
    bit: int
    fails: Callable[[], Column]


RULES = (
    Rule("few_words", 0, lambda: F.col("n_words") < 20),
    Rule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    Rule("symbols", 2, lambda: 100 * F.col("n_symbols") > 10 * F.col("n_words")),
    Rule("duplicate_lines", 3, lambda: 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    Rule("word_length", 4, lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words"))),
    Rule("repeated_words", 5, lambda: 100 * F.col("n_same_words") > 20 * F.col("n_words")),
    Rule("capitals", 6, lambda: 100 * F.col("n_capitals") > 40 * F.col("word_chars")),
    Rule("toxic_words", 7, lambda: (F.col("n_toxic") >= 2) & (1000 * F.col("n_toxic") >= F.col("n_words"))),
)
BASE = ("few_words", "repeated_windows")
#: Versioned policies: the rules that each version applies.
POLICIES = {"base": BASE, "v1": tuple(r.name for r in RULES if r.name != "toxic_words"), "v2": tuple(r.name for r in RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_words", "n_capitals", "n_toxic")


def mask_of(names: tuple[str, ...]) -> int:
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[n] for n in set(names))


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def with_repeat_words(t: DataFrame, window: int = 8) -> DataFrame:
    """Adds n_repeat_words: words of ``w`` inside windows of ``window`` words found twice or more.

    Each step is a column of its own: an expression inside a lambda would be evaluated for every element.
    """
    t = t.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    hashes = F.transform(F.sequence(F.lit(0), F.size("w") - window), lambda i: F.xxhash64(*[F.get(F.col("wh"), i + k) for k in range(window)]))
    t = t.withColumn("h", F.when(F.size("w") >= window, hashes).otherwise(F.array().cast("array<bigint>")))
    ordered = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    none = F.array().cast("array<struct<x:bigint,i:int>>")
    t = t.withColumn("at", F.when(F.size(F.array_distinct("h")) == F.size("h"), none).otherwise(ordered))
    like = lambda s, j: s["x"].eqNullSafe(F.get(F.col("at"), j)["x"])
    twin = F.filter(F.transform("at", lambda s, j: F.when(like(s, j - 1) | like(s, j + 1), s["i"])), lambda i: i.isNotNull())
    t = t.withColumn("twin", F.sort_array(twin))
    start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(window), i - a["last"])).alias("n"), i.alias("last"))
    return t.withColumn("n_repeat_words", F.aggregate("twin", start, step)["n"].cast("long"))


def letter_runs(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def toxic_words(docs: DataFrame, labels: DataFrame, max_docs: int = 50_000) -> tuple[str, ...]:
    """Words, of any language, by which the labelled documents that are toxic differ from the others.

    A word counts once a document. At most about ``max_docs`` labelled documents are used, chosen by a hash of the id;
    every learned word is in TOXIC_DOCS toxic ones of them, which bounds the list. Null labels, ids and texts teach
    nothing; a document labelled twice counts twice; without labels nothing is learned.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    share = min(1.0, max_docs / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    words = texts.join(F.broadcast(drawn), "doc_id").select("toxic", F.explode(F.array_distinct(letter_runs(F.col("text")))).alias("w"))
    counts = words.groupBy("w").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))
    rows = counts.where((F.col("bad") >= TOXIC_DOCS) & (F.col("bad") >= TOXIC_TIMES * F.col("good"))).select("w").collect()
    return tuple(sorted(r.w for r in rows))


def measure(docs: DataFrame, toxic: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and the measurements of each whole text (null: no words), all long; n_toxic: distinct words of ``toxic``."""
    t = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    t = t.withColumn("w", F.array_remove(F.split("t", WS), ""))
    t = t.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: without(x, WS_CHARS) != ""))
    t = with_repeat_words(t)
    bad = F.array_distinct(F.filter(letter_runs(F.col("t")), lambda x: x.isin(*toxic))) if toxic else F.array().cast("array<string>")
    t = t.withColumn("bad", bad)
    w = F.col("w")
    same = F.when(F.size(w) > 1, F.size(F.filter(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.get(w, i) == F.get(w, i - 1)))).otherwise(0)
    return t.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(without(F.col("t"), WS_CHARS)).cast("long").alias("word_chars"),
        (F.length("t") - F.length(without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        same.cast("long").alias("n_same_words"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.size("bad").cast("long").alias("n_toxic"),
    )


def ledger(docs: DataFrame, toxic: tuple[str, ...] = (), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row a document: doc_id, the measurements and ``fail_bits`` (long), one bit for each failed rule.

    Null and empty texts have no words and fail only the rules that say so (few_words). Rows that share a doc_id
    are measured each on its own; other columns are ignored; an empty table gives an empty ledger.
    """
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, toxic).withColumn("fail_bits", bits)


def apply_policy(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """``rows`` of a ledger with ``base_failed``, ``kept`` and ``lone_bit``.

    ``lone_bit`` is the bit of the one rule without which the policy would keep the row, else 0. Null bits (of no ledger
    here) give nulls; repeated rows are judged alike; an empty ledger stays empty; other columns stay.
    """
    mask = mask_of(POLICIES[policy]) | mask_of(BASE)
    hit = lambda m: F.col("fail_bits").bitwiseAND(F.lit(m))
    lone = F.when(F.bit_count(hit(mask)) == 1, hit(mask)).otherwise(F.lit(0)).cast("long")
    return rows.withColumns({"base_failed": hit(mask_of(BASE)) != 0, "kept": hit(mask) == 0, "lone_bit": lone})


def ablations(rows: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Rows (policy, rule, rejected, only_rule): what a policy rejects, and what this rule of it alone rejects.

    The ledger is counted once by its bits; every policy and ablation is a bitwise test of those counts. Repeated rows
    count each; an empty ledger gives zeros.
    """
    spark = rows.sparkSession
    bits = {r.name: 1 << r.bit for r in RULES}
    tests = [(p, n, mask_of(names), bits[n]) for p, names in policies.items() for n in names]
    tests = F.broadcast(spark.createDataFrame(tests, "policy string, rule string, mask long, bit long"))
    counts = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    joined = counts.join(tests, F.col("fail_bits").bitwiseAND(F.col("mask")) != 0, "right")
    return joined.groupBy("policy", "rule").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rejected"), F.coalesce(F.sum(F.when(hit == F.col("bit"), F.col("n"))), F.lit(0)).alias("only_rule")
    )
