"""Quality rules as a bitmask ledger, in DataFrame functions only.

ledger() evaluates every rule once and keeps the measurements and one failure bit a rule. Policies are versioned
masks over those bits, so that a policy can change, or be ablated, without reading a text again.

Defined results: a null text is an empty text, which has no words and fails `few_words`; an empty table gives no rows;
ties, repeated rows and null ids are rows like any other, and a very long text is one row. recorded() passes the whole
row on as a struct, so columns may have any names; ledger() spreads it, and a measurement replaces a column of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm.common import SEPARATORS, table, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: Rule -> bit. Bits are never reused, so ledgers of all versions stay readable.
RULES = ("few_words", "repeated_words", "symbols", "capitals", "stutter", "repeated_lines", "exclamations")
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: Policy version -> mask of the rules that reject.
POLICIES = {"base": BASE, "v1": sum(BIT.values())}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_stutters", "n_exclamations")


def _lost(text: Column, without: Column) -> Column:
    return (F.char_length(text) - F.char_length(without)).cast("long")


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at these ascending positions."""
    gaps = F.transform(positions, lambda p, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p - F.get(positions, k - 1))))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def recorded(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row` (all columns as they came), the measurements and `failure_bits`, and nothing else."""
    kept = ["row"]
    t = F.col("_t")
    step = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    filled = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    step = step.select(*kept, "_t", words(t).alias("_w"), filled.alias("_lines"))
    starts = F.sequence(F.lit(1), F.size("_w") - (WINDOW - 1))
    step = step.select(
        *kept,
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.translate(t, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _lost(t, F.translate(t, SYMBOLS, "")).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _lost(t, F.regexp_replace(t, "\\p{Lu}", "")).alias("n_capitals"),
        _lost(t, F.translate(t, "!", "")).alias("n_exclamations"),
        F.size(F.filter("_w", lambda w, i: (i > 0) & (w == F.get("_w", i - 1)))).cast("long").alias("n_stutters"),
        F.when(F.size("_w") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("_w", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )
    # only texts with a repeated window pay for the sort that finds its places
    pairs = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), pairs))
    again = F.filter("_s", lambda e, k: (F.get("_s", k - 1)["h"] == e["h"]) | (F.get("_s", k + 1)["h"] == e["h"]))
    step = step.withColumn("_p", F.when(F.col("_s").isNotNull(), F.sort_array(F.transform(again, lambda e: e["i"]))))
    step = step.withColumn("n_repeat_words", F.when(F.col("_p").isNotNull(), _covered(F.col("_p"))).otherwise(F.lit(0).cast("long")))
    n, chars = F.col("n_words"), F.col("word_chars")
    fails = {
        "few_words": n < 20,
        "repeated_words": 100 * F.col("n_repeat_words") > 30 * n,
        "symbols": 100 * F.col("n_symbols") > 10 * n,
        "capitals": 100 * F.col("n_capitals") > 45 * chars,
        "stutter": 100 * F.col("n_stutters") > 30 * n,
        "repeated_lines": 100 * F.col("n_dup_lines") > 40 * F.col("n_lines"),
        "exclamations": 100 * F.col("n_exclamations") > 50 * n,
    }
    bits = sum((F.when(fails[name], F.lit(BIT[name])).otherwise(F.lit(0)) for name in RULES), F.lit(0))
    # through a generator, so that no filter on the bits is pushed into the rules, which would copy them many times over
    return step.select(*kept, *MEASURES, F.explode(F.array(bits.cast("long"))).alias("failure_bits"))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements and `failure_bits` to the columns; they replace columns of their names."""
    made = {*MEASURES, "failure_bits"}
    rows = recorded(docs, text)
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in made], *MEASURES, "failure_bits")


def passes(version: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failure_bits").bitwiseAND(F.lit(POLICIES[version])) == 0


def ablation(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: the rows that fail it, and those that only it rejects, by bitwise aggregation of the ledger.

    Rows are first added up by their failure bits under the policy's mask, which leaves a row for each combination that
    occurs; the combinations are then taken apart by bit."""
    mask = POLICIES[version]
    patterns = rows.groupBy(F.col("failure_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("bigint").alias("bit")) for name in RULES if BIT[name] & mask]))
    each = rows.sparkSession.range(1).select(rules.alias("r")).select("r.*")
    met = each.join(patterns, F.col("bits").bitwiseAND(F.col("bit")) != 0, "left")
    return met.groupBy("rule").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"), F.coalesce(F.sum(F.when(F.bit_count("bits") == 1, F.col("n"))), F.lit(0)).alias("only_this"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base_failed = F.col("failure_bits").bitwiseAND(F.lit(BASE)) != 0
    return ledger(docs).select("doc_id", *MEASURES[:5], base_failed.alias("base_failed"), (~base_failed & passes("v1")).alias("kept"), "failure_bits")


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_capitals,
             length(t) - length(replace(t, '!', '')) AS n_excl,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters,
             ws FROM w),
x AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS s FROM g, unnest(range(1, len(ws) - 6)) AS u(i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM x) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM r, unnest(range(0, 8)) AS u(k) GROUP BY rid),
f AS (SELECT g.*, coalesce(n_repeat_words, 0) AS n_repeat_words FROM g LEFT JOIN c USING (rid)),
b AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_capitals > 45 * word_chars THEN 8 ELSE 0 END)
             + (CASE WHEN 100 * n_stutters > 30 * n_words THEN 16 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 32 ELSE 0 END)
             + (CASE WHEN 100 * n_excl > 50 * n_words THEN 64 ELSE 0 END) AS bits FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, bits = 0 AS kept,
       CAST(bits AS BIGINT) AS failure_bits FROM b
"""
