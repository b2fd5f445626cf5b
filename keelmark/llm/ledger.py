"""Quality rules as a bitmask ledger: every rule is evaluated once, failures are bits beside the measurements, and
policies are masks applied to the stored bits afterwards. All of it is DataFrame functions.
"""

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import identified

# ---------------------------------------------------------------- fixed values
SYMBOLS = "#*$%&|<>"
WINDOW = 5
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "many_capitals": "2 * n_capitals > word_chars",
}
#: The bits that a version of the policy enforces, by name.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "many_symbols", "duplicate_lines", "short_words", "long_words", "many_capitals"),
}
# ------------------------------------------------------------ end fixed values


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more, without a shuffle and in n log n.

    Window hashes are sorted with their places, places of hashes that equal a neighbour are kept and sorted, and each
    covers the words up to the next one.
    """
    def hashes(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.struct(
            F.xxhash64(*(F.get(h, i + k) for k in range(window))).alias("h"), i.cast("int").alias("i")))

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    counted = let(let(let(let(hashed, hashes), lambda x: F.sort_array(x)), places), covered)
    return F.when(F.size(words) > window, counted).otherwise(F.lit(0).cast("bigint"))


def measured(docs: DataFrame) -> DataFrame:
    """One row of measurements per document; null texts measure zero throughout."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spaced = F.translate(text, "\t\n\u000b\u000c\r", "     ")
    bare = F.translate(text, " \t\n\u000b\u000c\r", "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\u000b\u000c\r", "")) > 0)
    words = F.filter(F.split(spaced, " +"), lambda w: w != "")
    arrays = identified(docs).select(
        "doc_id",
        F.length(bare).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("bigint").alias("n_capitals"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
        let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("rep"))).alias("words"))
    return arrays.select(
        "doc_id", F.col("words.n").cast("bigint").alias("n_words"), "word_chars", "n_symbols", F.col("lines.dup").cast("bigint").alias("n_dup_lines"),
        F.col("words.rep").cast("bigint").alias("n_repeat_words"), F.col("lines.n").cast("bigint").alias("n_lines"), "n_capitals")


def ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Measurements and ``failures``: bit ``i`` is set where the rule at place ``i`` is true.

    Null and empty texts fail ``few_words`` alone. Null ids and repeated rows are kept as they are; an empty table
    gives an empty result; other columns are ignored.
    """
    bits = [F.when(F.expr(rule), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, rule in enumerate(rules.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured(docs).withColumn("failures", total)


def mask(names: Iterable[str], rules: Mapping[str, str] = RULES) -> int:
    places = list(rules)
    return sum(1 << places.index(n) for n in names)


def judged(ledger_rows: DataFrame, version: int = 2, base: int = 1) -> DataFrame:
    """``base_failed`` and ``kept`` under two versions of the policy, from the bits alone."""
    failed = F.col("failures").bitwiseAND(F.lit(mask(POLICIES[base])).cast("bigint")) != 0
    verdict = F.col("failures").bitwiseAND(F.lit(mask(POLICIES[version])).cast("bigint")) == 0
    return ledger_rows.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict)


def ablations(ledger_rows: DataFrame, version: int = 2, rules: Mapping[str, str] = RULES) -> DataFrame:
    """For each rule of a policy: documents that only it rejects, and those that it rejects at all.

    Rows are first counted per pattern of bits, at most two to the number of rules, so nothing is evaluated again.
    """
    enforced = F.lit(mask(POLICIES[version], rules)).cast("bigint")
    patterns = ledger_rows.groupBy(F.col("failures").bitwiseAND(enforced).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    named = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(mask([n], rules)).cast("bigint").alias("bit")) for n in POLICIES[version])))
    each = patterns.select("bits", "n", named.alias("r"))
    return each.groupBy("r.rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("rejected"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_by_it"))
