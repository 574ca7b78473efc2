"""The Merkle manifest against a tree built whole in plain Python, and against its SQL."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, differences
from lakestrata.llm import merkle_manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, tree string, idx long"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, lower):
    doc_id, text, lang, source, n_chars = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16 :][:16]
        out.append((run[: i % 16], run[i % 16 + 1 :]))
        i //= 16
    return out


def brute_force(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted((r[0] is not None, r[0] or 0, leaf(r, False), r) for r in sources[name])
        trees[name] = [o[3] for o in ordered], tree([o[2] for o in ordered])
    top = tree([trees[n][1][-1][0] for n in names])
    out = []
    for k, name in enumerate(names):
        members, levels = trees[name]
        for i, row in enumerate(members):
            steps = way(levels, i) + way(top, k)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, tampered)
            for before, after in steps:
                folded = digest("".join(before) + folded + "".join(after))
            proof = digest("".join("".join(b) + "".join(a) for b, a in steps))
            out.append((row[0], levels[0][i], levels[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle_manifest.manifest(docs, COLUMNS, {"text": lower}, tampered)


def padded(rows):
    return [(*r, "clash", "clash", -1) for r in rows]


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = padded(
        [(i, f"Text {i}", "en", f"s{i % 3}", i) for i in range(60)]
        + [
            (None, None, None, None, None),
            (None, "no id", "en", None, 1),
            (7, "another text of one id", "en", "s1", 3),
            (8, "Twice", "de", "s2", 5),
            (8, "Twice", "de", "s2", 5),
            (100, "", "", "", 0),
            (101, "LONG WÖRDS " * 100_000, "en", "lone source", 1_100_000),
            (102, "Ünïcode A", None, "né", None),
        ]
    )
    found = run(spark, rows).drop("copies")
    assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows)


def test_blocks_above_blocks(spark):
    """A hot source of several aligned blocks, and more sources than a run holds."""
    rows = padded([(i, f"Doc {i}", "en", "hot" if i % 3 else f"s{i % 20}", i) for i in range(14_000)])
    expected = brute_force(rows)
    found = run(spark, rows)
    assert sorted(map(tuple, found.drop("copies").collect()), key=str) == expected


def test_a_version_copies_only_ancestors(spark):
    rows = padded([(i, f"Doc {i}", "en", "one", i) for i in range(300)])
    found = {r["doc_id"]: r for r in run(spark, rows).collect()}
    for doc_id, r in found.items():
        if zlib.crc32(str(doc_id).encode()) % 5:
            assert r["copies"] is None and r["verified"]
        else:  # 300 leaves: three levels above a leaf, one source
            assert len(r["copies"]) == 3 and r["copies"][-1] == r["folded_root"] != r["root"] and not r["verified"]


def test_empty_table_and_lone_leaf(spark):
    assert run(spark, []).collect() == []
    row = run(spark, padded([(5, "Only", "en", "s", 4)])).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == digest("")


def test_query_equals_its_sql(spark, sf_dir):
    name = "op11_merkle_manifest"
    assert differences(spark, connect(sf_dir), queries.QUERIES[name], queries.ORACLES[name], sf_dir) == []


@pytest.mark.parametrize("size, n", [(1, 1), (4096, 1), (4097, 2), (16**6, 2), (16**6 + 1, 3)])
def test_rounds(size, n):
    assert merkle_manifest.rounds(size) == n
