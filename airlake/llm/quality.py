"""Quality rules whose cut-offs carry a guarantee on how many good documents they reject.

Every rule is a share in [0, 1] computed from the whole text; a document is rejected when a share exceeds the
rule's cut-off for its stratum. Cut-offs come from labelled documents: within a stratum, a cut-off is admissible when
the exact binomial test rejects "this rule drops more than ``alpha / rules`` of the good documents" at level
``delta / (rules x strata)``. Tests over falling cut-offs of one rule are nested and end at the first failure, so they
need no further correction; rules and strata are corrected by Bonferroni. Of the admissible cut-offs, the one that
separates bad from good labels best is taken, and none when there are too few labels to certify any.

Everything is DataFrame functions. Statistics are stored once and read by both the fit and the verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlake.llm.common import GAPS, packed_row, spaced, stored, words_of

RULES = ("symbol_share", "upper_share", "dup_line_share", "repeat_share")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines")


@dataclass(frozen=True)
class Risk:
    alpha: float = 0.02  # share of a stratum's good documents that all rules together may reject
    delta: float = 0.05  # chance that the guarantee fails for any rule or stratum
    steps: int = 1000  # cut-offs tried between 0 and 1
    caution: float = 4.0  # weight of a lost good document against a caught bad one, among admissible cut-offs


def repeated_words(words: Column, windows: Column) -> Column:
    """Words covered by a 3-word window that the text holds twice or more.

    ``windows`` are the window hashes in text order. Sorting (hash, position) puts equal windows side by side; the
    positions found, back in order, each cover up to three words not covered by the next.
    """
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

    def repeated(pairs: Column) -> Column:
        same = lambda x, j: F.coalesce(x["h"] == F.get(pairs, j)["h"], F.lit(False))
        return F.filter(pairs, lambda x, i: same(x, i - 1) | same(x, i + 1))

    # a fold keeps the neighbour at hand, so nothing is looked up in an array that is built per element
    folded = F.aggregate(
        F.sort_array(F.transform(_let(by_hash, repeated), lambda x: x["at"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(3), at - acc["last"])).cast("long").alias("n"), at.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), folded).otherwise(F.lit(0).cast("long"))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (lambda arguments are bound, not re-evaluated)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_statistics(docs: DataFrame) -> DataFrame:
    """``row`` (the input), the counts in STATS and the RULES, from whole texts; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*packed_row(docs, "text"), spaced(F.col("text")).alias("spaced"))
    base = base.withColumn("words", words_of(F.col("spaced")))
    n = F.size("words")
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(
        F.array().cast("array<bigint>")
    )
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, GAPS, "") != "")
    base = base.withColumns({"windows": windows, "lines": lines})
    kept_chars = lambda pattern: F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))
    counts = {
        "n_words": n,
        "word_chars": F.when(n > 0, F.char_length("spaced") - n + 1).otherwise(F.lit(0)),
        "n_symbols": kept_chars(r"[#*$%&|<>]"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeated_words(F.col("words"), F.col("windows")),
        "n_upper": kept_chars(r"\p{Lu}"),
        "n_lines": F.size("lines"),
    }
    counted = base.select("row", *[c.cast("long").alias(k) for k, c in counts.items()])
    share = lambda a, b: F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)))
    return counted.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "upper_share": share("n_upper", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )


def _ln_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series at n + 9, then down by the recurrence; error below 1e-12."""
    x = n + F.lit(9.0)
    series = (
        (x - 0.5) * F.log(x) - x + F.lit(0.9189385332046727)
        + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))
    )
    product = F.lit(1.0)
    for k in range(1, 9):
        product = product * (n + F.lit(float(k)))
    return series - F.log(product)


def allowed_rejections(counts: DataFrame, alpha: float, level: Column) -> DataFrame:
    """Per row with ``good`` documents: the largest k with P(Binomial(good, alpha) <= k) <= level, or -1.

    Only the terms within 12 standard deviations below the mean matter (the rest is below 1e-30).
    """
    n = F.col("good").cast("double")
    mean, spread = n * alpha, F.sqrt(n * alpha * (1 - alpha)) * 12 + 40
    keys = [c for c in counts.columns]
    terms = counts.withColumn("level", level).withColumn(
        "k",
        F.explode(
            F.sequence(F.greatest(F.lit(0.0), F.floor(mean - spread)).cast("long"), F.ceil(mean).cast("long"))
        ),
    )
    k = F.col("k").cast("double")
    ln_term = (
        _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)
        + k * F.log(F.lit(alpha)) + (n - k) * F.log(F.lit(1 - alpha))
    )
    tail = Window.partitionBy(*keys).orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = F.sum(F.when(k <= n, F.exp(ln_term)).otherwise(F.lit(1.0))).over(tail) <= F.col("level")
    return (
        terms.withColumn("within", within)
        .groupBy(*keys)
        .agg(F.coalesce(F.max(F.when(F.col("within"), F.col("k"))), F.lit(-1)).alias("allowed"))
    )


def fit_cutoffs(stats: DataFrame, labels: DataFrame, stratum: Column, risk: Risk = Risk()) -> DataFrame:
    """One row per stratum and rule with its certified cut-off: stratum, rule, cutoff, good, bad, lost, caught.

    Labels (doc_id, quality 1 or 0) repeat or contradict: a document with any 1 is good. Labels without a document,
    null labels and documents that fail the fixed base rules are left out. All labels are used.
    """
    said = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg((F.max("quality") > 0).alias("is_good"))
    )
    passed = stats.where(~F.col("base_failed")).select(
        F.col("row")["doc_id"].alias("label_id"), stratum.alias("stratum"), *RULES
    )
    judged = passed.join(said, "label_id")
    values = F.array(*[F.struct(F.lit(r).alias("rule"), F.ceil(F.col(r) * risk.steps).alias("bin")) for r in RULES])
    bins = (
        judged.select("stratum", "is_good", F.inline(values))
        .groupBy("stratum", "rule", "bin")
        .agg(F.count_if("is_good").alias("good"), F.count_if(~F.col("is_good")).alias("bad"))
    )
    # A cut-off t / steps rejects the values in bins above t; at most steps + 1 bins meet in one window.
    w = Window.partitionBy("stratum", "rule")
    above = w.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    tried = bins.select(
        "stratum", "rule", "bin",
        F.sum("good").over(w).alias("good"), F.sum("bad").over(w).alias("bad"),
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("caught"),
        # documents exist only in listed bins, so any cut-off up to the next listed bin acts alike: stay half-way
        F.lead("bin").over(w.orderBy("bin")).alias("next_bin"),
    )
    sizes = tried.select("stratum", "good").distinct()
    share = risk.alpha / len(RULES)
    # the number of strata, known to every row: strata are a handful of rows, so one window partition holds them
    sizes = sizes.withColumn("strata", F.count("*").over(Window.partitionBy(F.lit(1))))
    level = F.lit(risk.delta) / (F.col("strata") * len(RULES))
    allowed = allowed_rejections(sizes, share, level).select(
        F.col("stratum").alias("of"), "allowed"
    )
    gain = F.coalesce(F.try_divide("caught", "bad"), F.lit(0.0)) - risk.caution * F.coalesce(
        F.try_divide("lost", "good"), F.lit(0.0)
    )
    fits = tried.join(allowed, F.col("stratum").eqNullSafe(F.col("of"))).where(
        (F.col("lost") <= F.col("allowed")) & (F.col("caught") > 0) & (gain > 0)
    )
    best = F.max_by(F.struct("bin", "next_bin", "good", "bad", "lost", "caught"), F.struct(gain, F.col("bin")))
    return (
        fits.groupBy("stratum", "rule")
        .agg(best.alias("b"))
        .select(
            "stratum", "rule",
            (F.floor((F.col("b.bin") + F.col("b.next_bin") - 1) / 2) / risk.steps).alias("cutoff"),
            "b.good", "b.bad", "b.lost", "b.caught",
        )
    )


def judge(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: Risk = Risk()
) -> DataFrame:
    """``row`` (every input column, untouched), the counts, the rule shares, ``base_failed`` and ``kept``.

    Null or empty texts have no words and fail the base rules. A null stratum is a stratum of its own. Repeated rows are judged
    alike, each on its own. Without labels (or with too few to certify a cut-off) only the base rules reject. An empty
    table gives an empty result. Input columns named like a count stay inside ``row``.
    """
    stats = stored(with_statistics(docs), "quality-stats")
    of = F.col("row")[stratum]
    cutoffs = fit_cutoffs(stats, labels, of, risk)
    # one row per stratum; strata are few (languages), and the join is planned by size
    wide = cutoffs.groupBy(F.col("stratum").alias("of")).agg(
        F.lit(True).alias("fitted"), *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES]
    )
    fires = [F.coalesce(F.col(r) > F.col(f"max_{r}"), F.lit(False)) for r in RULES]
    rejected = fires[0]
    for one in fires[1:]:
        rejected = rejected | one
    judged = stats.join(wide, of.eqNullSafe(F.col("of")), "left")
    return judged.select(
        "row", *STATS, *RULES, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: Risk = Risk()) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, labels, stratum, risk).where("kept").select("row.*")
