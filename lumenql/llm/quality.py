"""Quality rules with risk-controlled thresholds, with DataFrame expressions only.

Metrics of every text feed fixed base rules and four graded rules. The graded rules have
cutoffs at several levels, and the level is chosen for each stratum from labelled rows:
the strictest whose false-rejection rate among good rows, over all rules together, is by
the exact binomial (Clopper-Pearson) bound below the allowed rate. Levels are tested from
the most lenient on and stop at the first failure (fixed-sequence testing), and the error
probability is divided by the number of strata (Bonferroni). A stratum with too few
labels gets no cutoff.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bind, materialize, words

WINDOW = 5
BASE_WORDS, BASE_REPEAT_PERCENT = 10, 20


def _repeats(tokens: Column) -> Column:
    """Words in 5-word windows that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash of their words. Only a text with a repeated
    window sorts its windows; then each repeated one adds the words it newly covers.
    """
    last = F.size(tokens) - WINDOW
    item = lambda k, d: F.element_at(tokens, k + 1 + d)
    hashes = F.transform(F.sequence(F.lit(0), last), lambda k: F.xxhash64(*(item(k, d) for d in range(WINDOW))))

    def covered(h: Column) -> Column:
        ranked = F.array_sort(F.transform(h, lambda x, k: F.struct(x.alias("x"), k.alias("k"))))
        return bind(ranked, lambda r: _cover(_twice(r)))

    def _twice(r: Column) -> Column:
        near = lambda k, d: F.get(r, k + d)["x"]
        hit = F.filter(r, lambda e, k: F.coalesce(near(k, -1) == e["x"], F.lit(False)) | F.coalesce(near(k, 1) == e["x"], F.lit(False)))
        return F.array_sort(F.transform(hit, lambda e: e["k"]))

    def _cover(at: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("p"))
        return F.aggregate(at, zero, lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["p"])).alias("n"), p.alias("p")), lambda a: a["n"])

    one = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(last >= 0, one).otherwise(F.lit(0).cast("long"))


def metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the counts and the graded rules' measures of each text; null texts have no word.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_marks`` and
    ``m_symbols, m_lines, m_repeat, m_marks`` (thousandths), ``base_failed``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    without = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
    out = docs.withColumns({"__words": words(text), "__lines": lines})
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": without("#*$%&|<>"),
        "n_marks": without("!"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _repeats(F.col("__words")),
    }).drop("__words", "__lines")
    per = lambda part, whole: F.expr(f"(1000L * {part}) div greatest({whole}, 1L)")
    out = out.withColumns({
        "m_symbols": per("n_symbols", "word_chars"),
        "m_lines": per("n_dup_lines", "n_lines"),
        "m_repeat": per("n_repeat_words", "n_words"),
        "m_marks": per("n_marks", "word_chars"),
    })
    failed = (F.col("n_words") < BASE_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(BASE_REPEAT_PERCENT) * F.col("n_words"))
    return out.withColumn("base_failed", failed)


@dataclass(frozen=True)
class Risk:
    """Allowed share of good rows of a stratum that all graded rules together may reject, and the chance that any stratum exceeds it."""

    rejected: float = 0.03
    error: float = 0.05
    #: Cutoffs in thousandths, a column for each level, most lenient first; a row is rejected above its cutoff.
    grids: dict[str, tuple[int, ...]] = field(default_factory=lambda: {
        "m_symbols": (400, 300, 200, 150, 100, 70),
        "m_lines": (800, 600, 400, 300, 200, 150),
        "m_repeat": (190, 170, 150, 120, 100, 70),
        "m_marks": (400, 300, 200, 150, 100, 70),
    })

    def levels(self) -> list[dict[str, int]]:
        return [dict(zip(self.grids, cuts)) for cuts in zip(*self.grids.values(), strict=True)]


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, rate), summed in logarithms so that large n do not underflow."""
    first = n * F.lit(log(1 - rate))
    odds = log(rate / (1 - rate))

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log(n - j + 1) - F.log(j.cast("double")) + F.lit(odds)
        return F.struct(term.alias("term"), (acc["total"] + F.exp(term)).alias("total"))

    zero = F.struct(first.alias("term"), F.exp(first).alias("total"))
    upto = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.aggregate(upto, zero, step, lambda acc: acc["total"])


def thresholds(measured: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", stratum: str = "lang", good: str = "quality", risk: Risk = Risk()) -> DataFrame:
    """The cutoffs of each stratum's strictest certified level: columns ``stratum`` and one for each rule.

    ``measured`` holds the metrics, and rows that fail the base rules do not count. A
    document labelled more than once counts once, as good only if all its labels are.
    The result has one row for each stratum with good labels; a null cutoff rejects
    nothing. Null strata form one of their own, named by the empty string.
    """
    label = labels.groupBy(F.col(id_col).alias("__id")).agg(F.min(good).alias("__good")).where("__good = 1")
    rows = measured.where("not base_failed").join(label, F.col(id_col) == F.col("__id"))
    key = F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum")
    above = lambda cuts: reduce(lambda x, y: x | y, (F.col(rule) > cut for rule, cut in cuts.items()))
    levels = risk.levels()
    counted = rows.groupBy(key).agg(F.count("*").alias("n"), *(F.count_if(above(cuts)).alias(f"k{i}") for i, cuts in enumerate(levels)))
    strata = counted.agg(F.greatest(F.count("*"), F.lit(1)).alias("strata"))
    # Stricter levels reject a superset, so their bounds only grow: all levels that pass precede the first that fails.
    passing = [F.when(binomial_tail(F.col(f"k{i}"), F.col("n"), risk.rejected) <= F.lit(risk.error) / F.col("strata"), F.lit(i)) for i in range(len(levels))]
    # Bound to a column of its own by a generator, so that the sums are not expanded for each rule.
    told = counted.join(F.broadcast(strata)).select("stratum", F.explode(F.array(F.greatest(*passing))).alias("level"))
    cut = lambda rule: F.element_at(F.array(*map(F.lit, risk.grids[rule])), F.col("level") + 1)
    return told.select("stratum", *(F.when(F.col("level").isNotNull(), cut(rule)).cast("long").alias(f"cut_{rule[2:]}") for rule in risk.grids))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang", risk: Risk = Risk()) -> DataFrame:
    """Adds ``kept``: false if the base rules failed or a measure is above its stratum's cutoff."""
    above = F.lit(False)
    for rule in risk.grids:
        above = above | F.coalesce(F.col(rule) > F.col(f"cut_{rule[2:]}"), F.lit(False))
    named = cutoffs.withColumnRenamed("stratum", "__cut_stratum")
    joined = measured.join(named, F.coalesce(F.col(stratum).cast("string"), F.lit("")) == F.col("__cut_stratum"), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~above).drop(*named.columns)


def quality_report(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang", risk: Risk = Risk()) -> DataFrame:
    """Counts, base verdict and final verdict of every document.

    Returns id, ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept`` and the stratum. The metrics are computed once and kept as a narrow table in
    the shared folder, from which cutoffs and verdicts are read. Null texts have no word
    and fail; repeated rows are judged each; extra columns are ignored.
    """
    narrow = docs.select(F.col(id_col), F.col(stratum), F.col(text_col))
    measured, _ = materialize(metrics(narrow, text_col).drop(text_col), "quality-metrics")
    cutoffs = thresholds(measured, labels, id_col=id_col, stratum=stratum, risk=risk)
    out = judge(measured, cutoffs, stratum, risk)
    return out.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", stratum)


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang", risk: Risk = Risk()) -> DataFrame:
    """The documents that all rules keep, columns unchanged and texts never shuffled.

    Null and empty texts have no word and go; repeated rows are judged each, very long texts
    whole; an empty table stays empty.
    Rows that pass the base rules are written with their measures, so that these are computed
    once; cutoffs and verdicts then read them back.
    """
    # The row stays in one struct, so that no column of it can clash; a generator keeps the
    # optimizer from copying the measures' expressions into the filter.
    rows = docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__text"))
    seen = metrics(rows, "__text").select("__row", F.explode(F.array(F.struct("base_failed", *risk.grids))).alias("__seen")).where("not __seen.base_failed")
    seen = seen.select("__row", F.col("__row")[id_col].alias(id_col), F.col("__row")[stratum].alias(stratum), "__seen.*")
    measured, _ = materialize(seen, "quality-measured")
    # Written, so that their small size is known and they are broadcast: rows never move by stratum.
    cutoffs, _ = materialize(thresholds(measured, labels, id_col=id_col, stratum=stratum, risk=risk), "cutoffs")
    return judge(measured, cutoffs, stratum, risk).where("kept").select("__row.*")
