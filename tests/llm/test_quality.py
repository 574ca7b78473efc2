"""Quality rules: base measures against plain Python, thresholds that adapt, and clashing names."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


LETTERS = np.array(list("abcdefghijklmnopqrstuvwxyz"))
LEXICON = ["".join(LETTERS[np.random.default_rng(0).permutation(26)[: 2 + k % 7] - k % 26]) + LETTERS[k // 26 % 26] for k in range(600)]


def prose(seed, n, vocabulary=600):
    return " ".join(LEXICON[k] for k in np.random.default_rng(seed).integers(0, vocabulary, n))


def base(text):
    found = WORD.findall(text or "")
    windows = {}
    for i in range(len(found) - 7):
        windows.setdefault(tuple(found[i : i + 8]), []).append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    n, repeats = len(found), len(covered)
    failed = n < 20 or 100 * repeats > 30 * n
    return n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeats, failed


TEXTS = [
    None, "", " \t\n\x0b", "one two", "a  b\nc\n\nc\nc\n " * 12, "x" * 5000, prose(1, 30), prose(2, 400) + "\n" + prose(2, 400),
    prose(3, 100) + " " + prose(4, 40) + " " + prose(4, 40), "é中 文 ###|<> $%&*", prose(5, 60_000), "\n\n", "same line here\n" * 30,
]


def test_base_measures_equal_plain_python(spark):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", 7) for i, t in enumerate(TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    found = quality_rules.judge(docs, ["doc_id"])
    for r in found.collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base(TEXTS[r.doc_id % len(TEXTS)])
        assert not (r.base_failed and r.kept)
    assert found.count() == len(rows)


@pytest.fixture(scope="module")
def corpus(spark):
    """A clean source, one with 40 percent junk, and a small one; code-like text is usual in its own source only."""
    rows = [(k, prose(10 + k, 150), "en", "clean") for k in range(300)]
    for k in range(300):
        text = prose(1000 + k, 150)
        junk = k % 5 < 2
        rows.append((1000 + k, re.sub(r"(\w) ", r"\1### ", text) if junk else text, "en", "dirty"))
    for k in range(200):
        rows.append((2000 + k, re.sub(r"(\w) ", r"\1 | ", prose(2000 + k, 150)), "en", "tables"))
    rows += [(3000 + k, prose(3000 + k, 150) + (" *" * 60 if k == 0 else ""), "en", "small") for k in range(8)]
    rows += [(4000 + k, re.sub(r"(\w+) (\w+) (\w+)", r"\1\2\3", prose(4000 + k, 600)) if k == 1 else prose(4000 + k, 150), "de", None) for k in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_sketches_decide(corpus):
    found = {r.doc_id: r for r in quality_rules.judge(corpus).collect()}
    assert all(found[k].kept for k in range(300))
    junk = [k for k in range(1000, 1300) if k % 5 < 2]
    assert not any(found[k].kept for k in junk)
    assert all(found[k].kept for k in range(1000, 1300) if k not in junk)
    assert all(found[k].kept for k in range(2000, 2200))  # usual there, and far past the fence of other sources
    assert found[2000].symbol_rate > found[0].high_symbol_rate and found[2000].high_symbol_rate > 2 * found[0].high_symbol_rate
    assert not found[3000].kept and all(found[k].kept for k in range(3001, 3008))  # a small group leans on all
    assert not found[4001].kept and found[4001].word_length > found[4001].high_word_length
    # Groups have fences of their own, for instance for the bars between the words of the tables.
    assert len({found[k].high_word_length for k in (0, 2000, 4000)}) >= 2


def test_quantiles_of_the_sketch_are_accurate(spark):
    values = spark.range(1, 2001).select(
        F.struct(*(F.col("id").cast("double").alias(m) for m in quality_rules.METRICS)).alias("__r"), F.lit("g").alias("__g"))
    row = quality_rules.quartiles(quality_rules.sketches(values), ["__g"]).first()
    assert abs(row["median"] / 1000 - 1) < 0.03 and abs(row["above"] / 500 - 1) < 0.1 and row["rows"] == 2000


def test_clashing_names_and_stages(spark):
    names = ["n_words", "kept", "base_failed", "max_symbol_rate", "HIGH_word_length", "rows", "t", "metric", "bin", "__rows", "group_rows"]
    rows = [(k, prose(k, 100) if k else "short", "en", "s", *range(len(names))) for k in range(30)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame(rows, schema)
    kept = quality_rules.filtered(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == rows[1:]
    judged = quality_rules.judge(docs)
    assert judged.where("kept").count() == 29 and "max_symbol_rate" in judged.columns
    assert quality_rules.filtered(docs.limit(0)).count() == quality_rules.judge(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    assert quality_rules.filtered(nulls).count() == 0 and quality_rules.judge(nulls).count() == 3
