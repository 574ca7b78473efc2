"""URL filters: per-host trees of path templates, merged branches, smoothed labelled purity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import lower_ascii, stored

SUPPORT = 3  # labelled urls that a segment's rate needs to be tested, and a template to be rejected
SPLIT = 20  # labelled urls from which a branch with mixed labels stays apart, since it may part further down
Z = 2.576  # score of the test of two proportions at the level of one percent
PRIOR = 5.0  # urls that the parent's rate counts for
REJECT = 0.8


def parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both are empty for a null url or one without ``://``."""
    body = F.coalesce(F.col(url).cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.withColumns(
        {"host": lower_ascii(F.regexp_extract(body, pattern, 1)), "path": F.regexp_extract(body, pattern, 2)}
    )


def matched_rule(rules: list[tuple[str, str]]):
    """Struct (length, rule, verdict) of the longest rule that fits, null if none does."""
    found = []
    for verdict, rule in rules:
        site, slash, rest = rule.partition("/")
        fits = ((F.col("host") == site) | F.endswith("host", F.lit("." + site))) & F.startswith(
            "path", F.lit(slash + rest)
        )
        one = F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found.append(F.when(fits, one))
    return F.array_max(F.array(*found)) if found else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def smoothed(bad, labelled, parent):
    return (bad + PRIOR * parent) / (labelled + PRIOR)


def differs(bad, labelled, other_bad, other_labelled):
    """Score of the test that two label rates are equal, positive if the first is higher; 0 where one has no labels."""
    both = (bad + other_bad) / (labelled + other_labelled)
    spread = F.sqrt(both * (1 - both) * (1 / labelled + 1 / other_labelled))
    score = (bad / labelled - other_bad / other_labelled) / F.nullif(spread, F.lit(0.0))
    return F.when((labelled > 0) & (other_labelled > 0), F.coalesce(score, F.lit(0.0))).otherwise(0.0)


def branches(open_rows: DataFrame) -> DataFrame:
    """host, template, seg and ``branch``: the children of each open node after generalising and merging.

    A segment whose label rate is that of its siblings is variable and becomes ``{*}``, unless it has ``SPLIT`` mixed
    labels of its own.  Segments above their siblings merge into ``{+}``, those below into ``{-}``, as far as the rate
    of each is like that of the others merged; the rest, and a segment alone on its side, stay literal.
    """
    node, sums = ["host", "template"], [F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")]
    segments = open_rows.groupBy(*node, "seg").agg(*sums)
    total = segments.groupBy(*node).agg(F.sum("bad").alias("tb"), F.sum("labelled").alias("tl"))
    score = differs(F.col("bad"), F.col("labelled"), F.col("tb") - F.col("bad"), F.col("tl") - F.col("labelled"))
    side = F.when((F.col("labelled") >= SUPPORT) & (F.abs("score") >= Z), F.signum("score")).otherwise(0.0)
    sided = segments.join(total, node).withColumn("score", score).withColumn("side", side)
    pools = sided.groupBy(*node, "side").agg(
        F.sum("bad").alias("pb"), F.sum("labelled").alias("pl"), F.count("*").alias("members")
    )
    apart = differs(F.col("bad"), F.col("labelled"), F.col("pb") - F.col("bad"), F.col("pl") - F.col("labelled"))
    mixed = (F.col("labelled") >= SPLIT) & (F.col("bad") > 0) & (F.col("bad") < F.col("labelled"))
    merged = F.when(F.col("side") == 0, "{*}").when(F.col("side") > 0, "{+}").otherwise("{-}")
    literal = mixed | ((F.col("side") != 0) & ((F.col("members") == 1) | (F.abs(apart) >= Z)))
    return sided.join(pools, [*node, "side"]).select(
        *node, "seg", F.when(literal, F.col("seg")).otherwise(merged).alias("branch")
    )


def templates(shapes: DataFrame) -> DataFrame:
    """host, segments and ``reject``: the template of each path shape and whether its labels condemn it.

    ``shapes`` has host, segments (numbers already generalised), bad and labelled.  The trees grow level by level
    to the full depth of the paths; a node whose labels agree, or are too few to part, needs no children.  A template
    is rejected if its smoothed purity reaches ``REJECT`` and it holds ``SUPPORT`` labels.
    """
    whole = shapes.agg(F.sum("bad").alias("b"), F.sum("labelled").alias("l"))
    overall = whole.select(F.coalesce(F.col("b") / F.nullif(F.col("l"), F.lit(0)), F.lit(0.0)).alias("rate"))
    hosts = shapes.groupBy("host").agg(F.sum("bad").alias("hb"), F.sum("labelled").alias("hl"))
    hosts = hosts.join(F.broadcast(overall), F.lit(True)).select(  # one row
        "host", smoothed(F.col("hb"), F.col("hl"), F.col("rate")).alias("host_rate")
    )
    growing, done, level = shapes.withColumn("template", F.lit("")), [], 0
    while True:
        rates = growing.groupBy("host", "template").agg(F.sum("bad").alias("nb"), F.sum("labelled").alias("nl"))
        divided = (F.col("nl") >= 2 * SUPPORT) & (F.col("nb") > 0) & (F.col("nb") < F.col("nl"))
        marked = growing.join(rates, ["host", "template"]).withColumn("seg", F.get("segments", F.lit(level)))
        marked = stored(marked.withColumn("open", divided & F.col("seg").isNotNull()).drop("nb", "nl"), "templates")
        done.append(marked.where("not open").drop("open", "seg"))
        open_rows = marked.where("open").drop("open")
        if open_rows.isEmpty():
            break
        grown = open_rows.join(branches(open_rows), ["host", "template", "seg"])
        growing = grown.withColumn("template", F.concat_ws("/", "template", "branch")).drop("branch", "seg")
        level += 1
    tree = reduce(DataFrame.unionByName, done)
    rates = tree.groupBy("host", "template").agg(F.sum("bad").alias("nb"), F.sum("labelled").alias("nl")).join(hosts, "host")
    purity = smoothed(F.col("nb"), F.col("nl"), F.col("host_rate"))
    rates = rates.select("host", "template", purity.alias("purity"), (F.col("nl") >= SUPPORT).alias("known"))
    return tree.join(rates, ["host", "template"]).select(
        "host", "segments", "template", "purity", ((F.col("purity") >= REJECT) & F.col("known")).alias("reject")
    )


def judge(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", bad=None) -> DataFrame:
    """All columns of ``pages`` with host, path, rule, template, purity and verdict.

    Labels are the verdicts of the rules, or ``bad``, a nullable boolean column.  Urls that no rule fits get the verdict of
    their template; a url without a host is allowed and has no template.  Repeated urls count each; long paths are read to
    their last segment; an empty table gives no rows.  Columns of ``pages`` with the names of added ones are replaced,
    all others are kept.
    """
    numbered = F.transform(
        F.filter(F.split("path", "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, "[0-9]+", "{n}")
    )
    label = F.col("__rule.verdict") == "block" if bad is None else bad
    named = pages.withColumn("__bad", bad) if bad is not None else pages
    split = parts(named, url).withColumn("__rule", matched_rule(rules)).withColumn("__segments", numbered)
    split = split.withColumn("__bad", label) if bad is None else split
    shapes = split.where("host <> ''").groupBy("host", F.col("__segments").alias("segments")).agg(
        F.sum(F.when(F.col("__bad"), 1).otherwise(0)).alias("bad"), F.count("__bad").alias("labelled")
    )
    found = templates(stored(shapes, "shapes")).withColumnsRenamed({"host": "__host", "segments": "__shape"})
    kept = split.drop("template", "purity")
    same = (kept["host"] == F.col("__host")) & (kept["__segments"] == F.col("__shape"))
    joined = kept.join(found.withColumnRenamed("reject", "__reject"), same, "left")
    own = F.when(F.coalesce("__reject", F.lit(False)), "block").otherwise("allow")
    return joined.withColumns(
        {"rule": F.col("__rule.rule"), "verdict": F.coalesce(F.col("__rule.verdict"), own)}
    ).drop("__rule", "__bad", "__segments", "__host", "__shape", "__reject")
