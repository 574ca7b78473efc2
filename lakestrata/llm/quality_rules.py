"""Quality rules: adaptive thresholds from mergeable quantile sketches, then a joined filter."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lakestrata.llm.common import WORD, stored, text_or_empty, window_hashes, words

BLANK = r"[\x20\x09-\x0D]+"
SYMBOL = r"[^#*$%&|<>]"
# Metric: the least spread that counts, so that a uniform group is not cut at noise, and the spreads to the fence.
METRICS = {"symbol_rate": (0.01, 4.0), "dup_line_rate": (0.01, 4.0), "repeat_rate": (0.01, 4.0), "word_length": (0.05, 8.0)}
PRIOR = 50  # rows that all groups together count for in each group
SKEW = 3  # a spread is at most so many times the one on the other side of the median
DOUBT = 3.0  # standard errors that a document's own value is given
WORD_SPREAD = 2.5  # characters by which words of one text differ, for the error of their mean
RUN = 8  # words that repeat together count as one for the error of the repeat rate
ACCURACY = 0.01


@F.pandas_udf(LongType())
def repeated_words(hashes: pd.Series) -> pd.Series:
    """Words that lie in an 8-word window found twice or more in the text."""

    def one(found) -> int:
        h = window_hashes(np.asarray(found, dtype=np.int64).view(np.uint64), 8)
        if len(h) < 2:
            return 0
        _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        edges = np.zeros(len(h) + 9, np.int64)
        at = np.flatnonzero(counts[inverse] > 1)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + 8, -1)
        return int((edges.cumsum() > 0).sum())

    return hashes.map(one)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``__m``, a struct: n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_chars, n_repeat_words.

    A null text has zeros.
    """
    body = text_or_empty(F.col(text))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    found = words(F.col(text))
    return docs.withColumn(
        "__m",
        F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.char_length(F.regexp_replace(body, BLANK, "")).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(body, SYMBOL, "")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            F.char_length(body).cast("long").alias("n_chars"),
            repeated_words(F.transform(found, lambda w: F.xxhash64(w))).alias("n_repeat_words"),
        ),
    )


def rated(measured: DataFrame, lang: str, source: str, min_words: int, max_repeat_pct: int) -> DataFrame:
    """Adds ``__r``, the metrics and the base verdict, and the group ``__g`` of each row."""
    m = {name: F.col(f"__m.{name}") for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_chars", "n_repeat_words")}
    per = lambda part, whole: m[part] / F.greatest(m[whole], F.lit(1))
    failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat_pct * m["n_words"])
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return measured.withColumns(
        {
            "__r": F.struct(
                per("n_symbols", "n_chars").alias("symbol_rate"),
                per("n_dup_lines", "n_lines").alias("dup_line_rate"),
                per("n_repeat_words", "n_words").alias("repeat_rate"),
                per("word_chars", "n_words").alias("word_length"),
                failed.alias("base_failed"),
            ),
            "__g": F.struct(text(lang).alias("lang"), text(source).alias("source")),
        }
    )


def sketches(rows: DataFrame) -> DataFrame:
    """Counts per group, metric and logarithmic bin: a quantile sketch that merges by adding counts.

    Values of one bin differ by at most ``2 * ACCURACY``; all rows count, and the bins of a metric are bounded.
    """
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(f"__r.{m}").alias("value")) for m in METRICS)))
    wide = rows.select("__g", values.alias("v")).select("__g", "v.metric", "v.value")
    gamma = float(np.log((1 + ACCURACY) / (1 - ACCURACY)))
    # Bin null holds the zeros.
    bin_ = F.when(F.col("value") > 0, F.ceil(F.log("value") / gamma))
    return wide.groupBy("__g", "metric", bin_.alias("bin")).agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, median and the spreads below and above it, per key and metric."""
    by = Window.partitionBy(*keys, "metric")
    seen = sketch.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))
    seen = seen.withColumns(
        {"upto": F.sum("n").over(by.orderBy(F.col("bin").asc_nulls_first())), "total": F.sum("n").over(by)}
    )
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    value = F.coalesce(2 * F.pow(F.lit(gamma), F.col("bin")) / (gamma + 1), F.lit(0.0))
    q = {p: F.min(F.when(F.col("upto") >= p * F.col("total"), value)) for p in (0.25, 0.5, 0.75)}
    found = seen.groupBy(*keys, "metric").agg(
        F.max("total").alias("rows"), q[0.25].alias("q1"), q[0.5].alias("median"), q[0.75].alias("q3")
    )
    below, above = F.col("median") - F.col("q1"), F.col("q3") - F.col("median")
    # A side full of junk has a wide spread; the other side bounds it.
    return found.select(
        *keys, "metric", "rows", "median",
        F.least(below, SKEW * above).alias("below"), F.least(above, SKEW * below).alias("above"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """``__g``, rows, and ``t``: for each metric the lowest and highest usual value of the group.

    Median and spreads of a group are shrunk towards those of all groups, the more the fewer rows it has.
    """
    own = quartiles(sketch, ["__g"])
    everywhere = quartiles(sketch.withColumn("__all", F.lit(1)), ["__all"]).select(
        "metric", *(F.col(c).alias(f"all_{c}") for c in ("median", "below", "above"))
    )
    both = own.join(F.broadcast(everywhere), "metric")  # one row per metric
    shrunk = lambda c: (F.col("rows") * F.col(c) + PRIOR * F.col(f"all_{c}")) / (F.col("rows") + PRIOR)
    pick = lambda i: F.element_at(F.create_map(*(F.lit(x) for m, v in METRICS.items() for x in (m, v[i]))), F.col("metric"))
    reach = lambda c: pick(1) * F.greatest(shrunk(c), pick(0))
    fences = both.select(
        "__g", "metric", "rows", (shrunk("median") - reach("below")).alias("low"), (shrunk("median") + reach("above")).alias("high")
    )
    return fences.groupBy("__g").agg(
        F.max("rows").alias("rows"),
        F.struct(
            *(F.max(F.when(F.col("metric") == m, F.col(e))).alias(f"{e}_{m}") for m in METRICS for e in ("low", "high"))
        ).alias("t"),
    )


def surely_above(rate: Column, n: Column, limit: Column) -> Column:
    """Whether a rate over ``n`` trials lies above a limit even at the lower end of its Wilson interval."""
    n, z2 = F.greatest(n, F.lit(1)), DOUBT * DOUBT
    low = (rate + z2 / (2 * n) - DOUBT * F.sqrt(rate * (1 - rate) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return low > limit


def verdict() -> Column:
    """Whether the joined thresholds keep a row; a row of a group without thresholds fails its base rule."""
    m, r, t = (lambda c, p=p: F.col(f"{p}.{c}") for p in ("__m", "__r", "t"))
    error = DOUBT * WORD_SPREAD / F.sqrt(F.greatest(m("n_words"), F.lit(1)))
    odd = (
        surely_above(r("symbol_rate"), m("n_chars"), t("high_symbol_rate"))
        | surely_above(r("dup_line_rate"), m("n_lines"), t("high_dup_line_rate"))
        | surely_above(r("repeat_rate"), m("n_words") / RUN, t("high_repeat_rate"))
        | (r("word_length") > t("high_word_length") + error)
        | (r("word_length") < t("low_word_length") - error)
    )
    return ~r("base_failed") & ~F.coalesce(odd, F.lit(False))


def judge(docs: DataFrame, keep: list[str] | None = None, text: str = "text", lang: str = "lang", source: str = "source",
          min_words: int = 20, max_repeat_pct: int = 30) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all but the text where null), the measures, metrics, thresholds and ``kept``.

    Thresholds are learnt from all rows of a language and source that pass the base rule: the group's median and
    spreads, taken from its sketch and shrunk towards those of all groups by its rows, with fences on the high side
    of three rates and on both sides of the mean word length.  A document is rejected where its value is past a
    fence by more than its own size leaves in doubt.  Texts are measured once; the measures are written.

    Null languages or sources form one group each; a null or empty text fails the base rule; texts of any length are
    read whole.  Equal rows get equal verdicts; an empty table gives no rows.  Columns of ``docs`` whose names clash
    with added ones are replaced.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    rows = rated(measures(docs, text), lang, source, min_words, max_repeat_pct)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *METRICS, "base_failed", "kept"]
    fences = [f"{e}_{m}" for m in METRICS for e in ("low", "high")]
    own = [F.col(c).alias(f"__own_{i}") for i, c in enumerate(keep)]
    rows = stored(rows.select(*own, "__m", "__r", "__g"), "measures")
    limits = thresholds(sketches(rows.where("not __r.base_failed")))
    joined = rows.join(limits, "__g", "left").withColumn("__kept", verdict())
    return joined.select(
        *(F.col(f"__own_{i}").alias(c) for i, c in enumerate(keep) if c not in {*added, *fences, "group_rows"}),
        *(F.col(f"__m.{c}").alias(c) for c in added[:5]),
        *(F.col(f"__r.{c}").alias(c) for c in (*METRICS, "base_failed")),
        *(F.col(f"t.{c}").alias(c) for c in fences),
        F.col("rows").alias("group_rows"),
        F.col("__kept").alias("kept"),
    )


def filtered(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
             min_words: int = 20, max_repeat_pct: int = 30) -> DataFrame:
    """The documents that ``judge`` keeps, with their own columns and values, whatever their names.

    Measures are made once for the thresholds and once beside the texts, which are not shuffled.  Rows that are equal
    stay or go together; an empty table stays empty.
    """
    rows = rated(measures(docs, text), lang, source, min_words, max_repeat_pct)
    narrow = stored(rows.where("not __r.base_failed").select("__r", "__g"), "measures")
    limits = thresholds(sketches(narrow)).withColumnRenamed("rows", "__rows")
    names = [F.col(f"`{c}`").alias(f"__own_{i}") for i, c in enumerate(docs.columns)]
    kept = rows.select(*names, "__m", "__r", "__g").join(limits, "__g", "left").where(verdict())
    return kept.select(*(F.col(f"__own_{i}").alias(c) for i, c in enumerate(docs.columns)))
