"""Quality rules whose cutoffs carry a guarantee on clean documents.

Base rules are fixed: fewer than 20 words, or more than 30 % of words inside repeated 8-word windows. On top, each
learned rule rejects documents whose metric lies above a cutoff. For every stratum (language, null is one of its own), rule and
cutoff of a fixed grid, all labelled documents of good quality are a holdout: with ``k`` of ``n`` above the cutoff, the
cutoff is admissible if ``P(Bin(n, rate) <= k)`` is at most ``ALPHA`` divided by the number of all tests (strata x rules x cutoffs), where
``rate`` is ``FALSE_REJECTION`` divided by the number of rules. So with probability ``1 - ALPHA`` the learned rules together reject
no more than ``FALSE_REJECTION`` of the good documents in any stratum. The lowest admissible cutoff is used; a rule without one
does not fire, so with few labels only the base rules decide: with four strata and no good document above the cutoff it takes about 1,508 of them.

A null text has no words and fails. A stratum without labels uses the base rules only; labels of one ``doc_id`` count once, at
their lowest quality, and null labels are left out. In the holdout texts of the same words count once in each stratum. Empty tables give an empty result. Everything is made
of column expressions; the per-document features are stored once, since both the calibration and the verdict read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.rows import SPACES, WORDS, free_names, small_or_whole
from touchline.operators.lineage import checkpointed

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
ALPHA = 0.05
FALSE_REJECTION = 0.02
#: Metric of each learned rule and its grid of cutoffs.
GRID = {
    "symbols_per_word": (0.02, 0.05, 0.1, 0.2, 0.5, 1.0),
    "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "repeat_share": (0.02, 0.05, 0.1, 0.15, 0.2, 0.25),
    "mean_word_chars": (8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
}
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is named inside."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: str, hashes: str) -> Column:
    """Words inside windows that are found twice or more.

    Equal windows have equal hashes, so a text whose hashes differ has none. Only the others are looked at word by
    word: windows are sorted with their starts, those equal to a neighbour are kept, and the union of their spans is measured.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    window = F.transform(
        starts, lambda i: F.struct(F.array_join(F.slice(F.col(words), i + 1, WINDOW), " ").alias("w"), i.alias("i"))
    )

    def twice(found: Column) -> Column:
        return F.filter(
            found, lambda x, k: (x["w"] == F.get(found, k - 1)["w"]) | (x["w"] == F.get(found, k + 1)["w"])
        )

    def covered(held: Column, start: Column) -> Column:
        return F.struct(
            (held["n"] + start + WINDOW - F.greatest(held["end"], start)).alias("n"), (start + WINDOW).alias("end")
        )

    repeated = F.array_sort(F.transform(let(F.array_sort(window), twice), lambda x: x["i"]))
    total = F.aggregate(repeated, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), covered, lambda held: held["n"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(0)


def marked() -> Column:
    """Tells rows of one ``doc_id`` apart by what their verdict depends on."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("lang"))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, stratum, mark``, the features of the contract, the number of lines that hold a word, and ``copy``, equal for texts of the same words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.col("lang").alias("stratum"), text.alias("text"), marked().alias("mark")).select(
        "doc_id", "stratum", "mark", "text", F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.regexp_replace(line, SPACES, "") != "").alias("lines"),
    )
    starts = F.sequence(F.lit(1), F.size("words") - WINDOW + 1)
    hashed = F.when(F.size("words") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("words"), i, WINDOW))))
    windows = split.withColumn("hashes", F.coalesce(hashed, F.array().cast("array<bigint>")))
    return windows.select(
        "doc_id", "stratum", "mark", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words("words", "hashes").cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), F.xxhash64(F.array_join("words", " ")).alias("copy"),
    )


def metrics() -> dict[str, Column]:
    """Metrics of the learned rules; 0 where a text has no word."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part).cast("double") / F.col(whole)).otherwise(F.lit(0.0))

    return {
        "symbols_per_word": share("n_symbols", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "mean_word_chars": share("word_chars", "n_words"),
    }


def lower_tail(k: Column, n: Column, rate: float) -> Column:
    """``P(Bin(n, rate) <= k)`` by its terms' ratios; 1 where ``k`` is not below the mean, which no test accepts."""

    def step(held: Column, i: Column) -> Column:
        log = held["log"] + F.log((n - i + 1) / i) + F.log(F.lit(rate / (1 - rate)))
        return F.struct(log.alias("log"), (held["sum"] + F.exp(log)).alias("sum"))

    first = n * F.log(F.lit(1 - rate))
    start = F.struct(first.alias("log"), F.exp(first).alias("sum"))
    terms = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.when(k < n * rate, F.aggregate(terms, start, step, lambda held: held["sum"])).otherwise(1.0)


def cutoffs(features: DataFrame, labels: DataFrame, alpha: float = ALPHA, false_rejection: float = FALSE_REJECTION) -> DataFrame:
    """``stratum`` and one cutoff per learned rule (null: the rule does not fire there)."""
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = good.where("quality > 0").select(F.col("doc_id").alias("labelled"))
    holdout = features.join(good, features["doc_id"] == good["labelled"]).select("stratum", "copy", "doc_id", *[m.alias(r) for r, m in metrics().items()])
    # Copies are no trials of their own: of texts that differ in white space at most, the one with the smallest id counts.
    one = F.min_by(F.struct(*metrics()), "doc_id").alias("one")
    holdout = holdout.groupBy("stratum", "copy").agg(one).select("stratum", "one.*")
    above = [
        F.array(*[F.sum((F.col(rule) > cut).cast("long")) for cut in grid]).alias(rule) for rule, grid in GRID.items()
    ]
    counted = checkpointed(holdout.groupBy("stratum").agg(F.count("*").alias("n"), *above))
    tests = counted.count() * sum(len(grid) for grid in GRID.values())
    rate, level = false_rejection / len(GRID), alpha / max(tests, 1)

    def lowest(rule: str) -> Column:
        pairs = F.arrays_zip(F.array(*map(F.lit, GRID[rule])).alias("cut"), F.col(rule).alias("k"))
        fine = F.filter(pairs, lambda pair: lower_tail(pair["k"], F.col("n"), rate) <= level)
        return F.array_min(F.transform(fine, lambda pair: pair["cut"])).alias(f"{rule}_cut")

    return counted.select("stratum", *[lowest(rule) for rule in GRID])


def verdicts(docs: DataFrame, labels: DataFrame, alpha: float, false_rejection: float) -> DataFrame:
    features = checkpointed(measured(docs))
    found = checkpointed(cutoffs(features, labels, alpha, false_rejection))
    limits = small_or_whole(found.withColumnRenamed("stratum", "limit_stratum"))
    joined = features.join(limits, features["stratum"].eqNullSafe(limits["limit_stratum"]), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    fires = F.lit(False)
    for rule, metric in metrics().items():
        fires = fires | F.coalesce(metric > F.col(f"{rule}_cut"), F.lit(False))
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~fires})


def judged(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, false_rejection: float = FALSE_REJECTION) -> DataFrame:
    """One row per document: ``doc_id``, the features, ``base_failed`` and ``kept``."""
    return verdicts(docs, labels, alpha, false_rejection).select("doc_id", *FEATURES, "base_failed", "kept")


def filtered(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, false_rejection: float = FALSE_REJECTION) -> DataFrame:
    """The documents that pass, with all their columns; the list of those to drop is broadcast while it is small."""
    mark, bad_id, bad_mark = free_names(docs, "mark", "bad_id", "bad_mark")
    bad = verdicts(docs, labels, alpha, false_rejection).where("not kept").select("doc_id", "mark").distinct()
    other = small_or_whole(checkpointed(bad.toDF(bad_id, bad_mark)))
    rows = docs.withColumn(mark, marked())
    same = rows["doc_id"].eqNullSafe(other[bad_id]) & (rows[mark] == other[bad_mark])
    return rows.join(other, same, "left_anti").select(*docs.columns)
