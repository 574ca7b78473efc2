"""Merkle dataset manifest: a tree per source, a tree over the sources, and a path-copied version per changed row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import stored

RUN = 16  # children of a node
LEVELS = 3  # levels of the tree that one aligned block holds
BLOCK = RUN**LEVELS  # nodes of a block


def node_hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_hash(*values: Column) -> Column:
    """Digest of the values in order, each with its length in bytes, or ``-`` where it is null."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def placed(leaves: DataFrame) -> DataFrame:
    """Adds ``idx``, the place of each row of (tree, rank, hash) in its tree, and ``size``, the rows of that tree.

    Rows are sorted into ranges and written; a tree of any size spans as many ranges as it needs.  What each range
    holds of each tree is a table with about one row per range and tree.
    """
    order = ["tree", F.col("rank").asc_nulls_first(), "hash"]
    parts = max(1, int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = leaves.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number holds the range and the place in it; writing it keeps it the same for all later passes.
    rows = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    held = rows.groupBy("part", "tree").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    of_tree = Window.partitionBy("tree")
    earlier = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "part", "tree", "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"), F.sum("n").over(of_tree).alias("size")
    )
    found = rows.join(starts, ["part", "tree"])
    return found.withColumn("idx", F.col("at") - F.col("low") + F.col("start")).drop("part", "at", "low", "start")


def in_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each (tree, block), whole; the rows come sorted, and a block is bounded."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        tree, block = batch["tree"].to_numpy(), batch["block"].to_numpy()
        new = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *new], [*new, len(batch)]):
            if held and last != (tree[lo], block[lo]):
                yield pd.concat(held, ignore_index=True)
                held = []
            last = (tree[lo], block[lo])
            held.append(batch.iloc[lo:hi])
    if held:
        yield pd.concat(held, ignore_index=True)


def block_levels(hashes: list[str], size: int) -> list[list[str]]:
    """The nodes of a block level by level, as far up as the block and the tree of ``size`` nodes go."""
    levels = [hashes]
    while size > 1 and len(levels) <= LEVELS:
        last = levels[-1]
        levels.append([node_hash("".join(last[i : i + RUN])) for i in range(0, len(last), RUN)])
        size = -(-size // RUN)
    return levels


def climb(nodes: DataFrame) -> DataFrame:
    """The top node of each aligned block: tree, idx (of the block), size (blocks of the tree), hash."""

    def up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_blocks(batches):
            size = int(b["size"].iloc[0])
            top = block_levels(b["hash"].tolist(), size)[-1][0]
            yield pd.DataFrame({"tree": b["tree"].iloc[:1], "idx": b["block"].iloc[:1], "size": -(-size // BLOCK), "hash": top})

    keyed = nodes.select("tree", "idx", "size", "hash", F.expr(f"idx div {BLOCK}").alias("block"))
    dealt = keyed.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
    return dealt.mapInPandas(up, "tree string, idx long, size long, hash string")


def descend(nodes: DataFrame, above: DataFrame, emit: Callable, schema: str) -> DataFrame:
    """Blocks of nodes next to what lies above each block: before, after (siblings per level), subroot, root.

    ``emit(rows, levels, upper)`` makes the output of a block; ``upper`` is its row of ``above``.
    """

    def down(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in in_blocks(batches):
            upper, rows = b.iloc[0], b.iloc[1:]
            yield emit(rows, block_levels(rows["hash"].tolist(), int(rows["size"].iloc[0])), upper)

    low = nodes.withColumns({"block": F.expr(f"idx div {BLOCK}"), "mine": F.lit(1)})
    high = above.withColumns({"block": F.col("idx"), "idx": F.lit(0).cast("long"), "size": F.lit(0).cast("long"), "mine": F.lit(0)})
    both = low.unionByName(high, allowMissingColumns=True)
    return both.repartition("tree", "block").sortWithinPartitions("tree", "block", "mine", "idx").mapInPandas(down, schema)


def siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """For each level of a block the texts of the run's nodes before and after the path from node ``i``."""
    before, after = [], []
    for level in levels[:-1]:
        lo = i // RUN * RUN
        before.append("".join(level[lo:i]))
        after.append("".join(level[i + 1 : lo + RUN]))
        i //= RUN
    return before, after


def passed_down(rows: pd.DataFrame, levels: list[list[str]], upper: pd.Series) -> pd.DataFrame:
    """The siblings of every node of a block, up to the root, for the blocks below it."""
    local = [siblings(levels, i) for i in range(len(rows))]
    return pd.DataFrame(
        {
            "tree": rows["tree"],
            "idx": rows["idx"],
            "before": [[*b, *upper["before"]] for b, _ in local],
            "after": [[*a, *upper["after"]] for _, a in local],
            "subroot": upper["subroot"],
            "root": upper["root"],
            "node": rows["hash"],
            "label": rows["label"],
        }
    )


ABOVE = (
    "tree string, idx long, before array<string>, after array<string>, subroot string, root string, node string, "
    "label string"
)


def rounds(size: int) -> int:
    """Blocks that lie above one another in a tree of ``size`` leaves."""
    n = 1
    while size > BLOCK:
        size, n = -(-size // BLOCK), n + 1
    return n


def paths(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """What lies above each block of ``levels[0]``: from the top table down, one join a round."""
    above = top
    for nodes in reversed(levels[1:]):
        above = descend(nodes.withColumn("label", F.lit(None).cast("string")), above, passed_down, ABOVE).drop("node", "label")
    return above


def towers(leaves: DataFrame) -> list[DataFrame]:
    """The placed leaves and the written top nodes of their blocks, round by round, up to one node a tree."""
    largest = leaves.agg(F.max("size").alias("m")).first()["m"] or 1
    levels = [leaves]
    for _ in range(rounds(largest)):
        levels.append(stored(climb(levels[-1]), "merkle-nodes"))
    return levels


def manifest(docs: DataFrame, columns: list[str], changed: dict[str, Column], tampered: Column,
             tree: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copies: one row per row of ``docs``.

    Leaves are digests of ``columns``; those of one ``tree`` value ascend by id (null first, equal ids by digest).
    Where ``tampered`` holds, ``changed`` replaces columns and the changed leaf makes a version of its own, which
    shares every other node: ``copies`` lists the nodes it copies, from the leaf's parent to its root.  A block
    hashes only its own ancestors of the path; the version goes on with the siblings above the block, which were
    computed once per block and come to it by one join.  ``proof_sha256`` is the digest of all siblings on the way.
    ``folded_root`` is recomputed for every row, tampered or not.

    Null ``tampered`` counts as false.  Repeated rows are leaves each; an empty table gives no rows; texts of any
    length are hashed where they are read and never shuffled; other columns of ``docs`` are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    original = [F.col(c) for c in columns]
    replaced = [changed.get(c, F.col(c)) for c in columns]
    name = F.coalesce(F.concat(F.lit("s"), F.col(tree).cast("string")), F.lit("n"))  # null first, then bytewise
    leaves = docs.select(
        name.alias("tree"),
        F.col(doc_id).alias("rank"),
        leaf_hash(*original).alias("hash"),
        F.when(tampered, leaf_hash(*replaced)).alias("other"),
    )
    # Texts are read and hashed once; the range cut samples the written digests.
    bottom = towers(placed(stored(leaves, "merkle-digests")))
    sources = bottom[-1].select(F.lit("").alias("tree"), F.col("tree").alias("rank"), "hash")
    upper = towers(placed(sources))
    crown = upper[-1].select(
        "tree",
        "idx",
        F.array().cast("array<string>").alias("before"),
        F.array().cast("array<string>").alias("after"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("hash").alias("root"),
    )
    of_source = descend(upper[0].withColumnRenamed("rank", "label"), paths(upper, crown), passed_down, ABOVE)
    only = F.lit(0).cast("long").alias("idx")
    top = of_source.select(F.col("label").alias("tree"), only, "before", "after", F.col("node").alias("subroot"), "root")

    def proofs(rows: pd.DataFrame, levels: list[list[str]], upper: pd.Series) -> pd.DataFrame:
        before, after = list(upper["before"]), list(upper["after"])
        rest = "".join(b + a for b, a in zip(before, after))
        out = []
        for i, (leaf, other) in enumerate(zip(rows["hash"], rows["other"])):
            b, a = siblings(levels, i)
            proof = node_hash("".join(x + y for x, y in zip(b, a)) + rest)
            folded, copies = leaf if other is None else other, []
            for x, y in zip([*b, *before], [*a, *after]):
                folded = node_hash(x + folded + y)
                copies.append(folded)
            out.append((proof, folded, folded == upper["root"], None if other is None else copies))
        found = pd.DataFrame(out, columns=["proof_sha256", "folded_root", "verified", "copies"])
        ids = rows[["rank", "hash"]].reset_index(drop=True).set_axis(["doc_id", "leaf"], axis=1)
        return pd.concat([ids.assign(subroot=upper["subroot"], root=upper["root"]), found], axis=1)

    # An id is not a label of the tree: it crosses the stream as text, so that nulls keep its type.
    below = bottom[0].withColumn("rank", F.col("rank").cast("string"))
    rows = descend(
        below,
        paths(bottom, top),
        proofs,
        "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean, copies array<string>",
    )
    return rows.withColumn("doc_id", F.col("doc_id").cast(kind))


def _chain(prefix: str, leaves: str, levels: int, carried: str) -> list[str]:
    """SQL of a tree of at most ``levels`` levels: runs per level, top nodes, and siblings and fold per leaf."""
    out = [f"{prefix}0 AS ({leaves})"]
    for k in range(levels):
        out.append(
            f"{prefix}r{k} AS (SELECT tree, i // {RUN} AS i, max(m) AS m, list(h ORDER BY i) AS l FROM {prefix}{k}"
            f" GROUP BY tree, i // {RUN})"
        )
        out.append(
            f"{prefix}{k + 1} AS (SELECT tree, i, (m + {RUN - 1}) // {RUN} AS m,"
            f" CASE WHEN m > 1 THEN sha256(array_to_string(l, '')) ELSE l[1] END AS h FROM {prefix}r{k})"
        )
    out.append(f"{prefix}f0 AS (SELECT tree, i, m, i AS spot, m AS w, {carried} FROM {prefix}0)")
    for k in range(levels):
        left, right = f"array_to_string(l[1:spot % {RUN}], '')", f"array_to_string(l[spot % {RUN} + 2:], '')"
        out.append(
            f"{prefix}f{k + 1} AS (SELECT f.* REPLACE (spot // {RUN} AS spot, (w + {RUN - 1}) // {RUN} AS w,"
            f" CASE WHEN w > 1 THEN list_append(b, {left}) ELSE b END AS b,"
            f" CASE WHEN w > 1 THEN list_append(a, {right}) ELSE a END AS a)"
            f" FROM {prefix}f{k} f JOIN {prefix}r{k} r ON f.tree = r.tree AND f.spot // {RUN} = r.i)"
        )
    return out


def oracle(levels: int = 6) -> str:
    """The contract of the query as SQL, for trees of up to ``16 ** levels`` leaves."""
    def value(c: str) -> str:
        return f"coalesce(strlen({c}) || ':' || {c}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = (
        "flatten(list_transform(range(1, length(s) + 1), lambda k: [CAST(ascii(s[k]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    )
    # A CRC-32 bit by bit: each byte enters with eight shifts.
    crc = (
        f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}),"
        " lambda c, x: xor(xor(c, x) >> 1, CAST(3988292384 AS BIGINT) * (xor(c, x) & 1))), CAST(4294967295 AS BIGINT))"
    )
    leaves = (
        f"SELECT coalesce('s' || source, 'n') AS tree, doc_id, {leaf('text')} AS h,"
        f" CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} END AS other,"
        " row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i,"
        " count(*) OVER (PARTITION BY source) AS m FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents)"
    )
    carried = "doc_id, h AS leaf, other, CAST([] AS VARCHAR[]) AS b, CAST([] AS VARCHAR[]) AS a"
    parts = _chain("n", leaves, levels, carried)
    tops = (
        "SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS m"
        f" FROM n{levels}"
    )
    parts += _chain("t", tops, levels, "name, h AS subroot, CAST([] AS VARCHAR[]) AS b, CAST([] AS VARCHAR[]) AS a")
    parts.append(
        "whole AS (SELECT doc_id, leaf, coalesce(other, leaf) AS start, subroot, (SELECT h FROM t" + str(levels) + ") AS root,"
        " list_concat(d.b, u.b) AS b, list_concat(d.a, u.a) AS a"
        f" FROM nf{levels} d JOIN tf{levels} u ON d.tree = u.name)"
    )
    folded = "start"
    for k in range(1, 2 * levels + 1):
        parts.append(
            f"fold{k} AS (SELECT * REPLACE (CASE WHEN len(b) >= {k} THEN sha256(b[{k}] || {folded} || a[{k}]) ELSE start END"
            f" AS start) FROM {'whole' if k == 1 else f'fold{k - 1}'})"
        )
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, root,"
        " sha256(array_to_string(list_transform(range(1, len(b) + 1), lambda k: b[k] || a[k]), '')) AS proof_sha256,"
        f" start AS folded_root, start = root AS verified FROM fold{2 * levels}"
    )
