"""Each operator on a small table with nulls, empty texts, ties and repeated rows, against plain Python."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import decontamination, jaccard_join, packing, quality_rules, substring_dedup, token_ids, url_filter
from lakestrata.llm.common import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words long"


def run_of(seed, n):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 5000, n))


@pytest.fixture(scope="module")
def rows():
    shared, base = run_of(1, 70), run_of(2, 200)
    near = base.split(" ")
    near[100] = "changed"
    return [
        (1, base, "en", "a", 0),
        (2, " ".join(near), "en", None, 0),
        (3, base, None, "a", 0),
        (4, run_of(3, 40) + "\n" + shared, "en", "a", 0),
        (5, shared + " " + run_of(4, 40), "en", "a", 0),
        (6, None, None, None, None),
        (7, "", "en", "a", 0),
        (8, "one two", "en", "a", 0),
        (9, run_of(5, 70_000), "en", "a", 0),
        (9, run_of(5, 70_000), "en", "a", 0),
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_token_files_return_every_id(docs, rows):
    from tokenizers import Tokenizer

    tok, start, expected = Tokenizer.from_file(tokenizer_file()), 0, []
    for doc_id, text, *_ in rows:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_ids.round_trip(docs, tokenizer_file()).collect())) == sorted(expected)


def test_packing_is_gapless_and_whole(docs):
    pieces = packing.packed(docs, tokenizer_file()).drop("ids").collect()
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0)
        ends[p.sequence_id] = p.offset + p.length
    assert all(ends[s] == 2048 for s in range(max(ends)))
    assert {p.doc_id for p in pieces} == set(range(1, 10))


def test_substring_dedup_removes_what_smaller_ids_hold(docs):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.deduplicated(docs).collect()}
    assert got[1] == (200, 0) and got[3] == (200, 200)
    assert got[2] == (200, 199)
    assert got[5] == (110, 70) and got[4] == (110, 0)
    assert got[6] == (0, 0) and got[9] == (70_000, 0)


def test_jaccard_components(docs):
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.linked_components(docs).collect()}
    assert [got[k][1] for k in (1, 2, 3, 4, 5, 8)] == [1, 1, 1, 4, 5, 8]
    assert got[6] == (0, 6) and got[7] == (0, 7) and got[8][0] == 1


def test_near_duplicate_stage_equals_brute_force(spark):
    """Null ids stay, and two texts under one id are placed each by its own words."""
    from corpus_pipeline import near_duplicates

    a, b, c = run_of(300, 120), run_of(301, 120), run_of(302, 120)
    edited = lambda text: text.replace(text.split(" ")[60], "changed", 1)
    rows = [(1, a), (1, b), (2, a), (3, b), (4, edited(a)), (5, edited(b)), (6, c), (6, edited(c)), (7, c + " "),
            (None, run_of(303, 60)), (None, None), (None, a), (8, ""), (8, None), (9, run_of(304, 80))]

    def shingles(text):
        words = (text or "").split()
        n = min(5, len(words)) or 1
        return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else frozenset()

    known = [r for r in rows if r[0] is not None and shingles(r[1])]
    group = list(range(len(known)))
    for _ in known:
        for i, (_, x) in enumerate(known):
            for j, (_, y) in enumerate(known):
                sx, sy = shingles(x), shingles(y)
                if len(sx & sy) * 100 >= 80 * len(sx | sy):
                    group[i] = group[j] = min(group[i], group[j])
    got = [tuple(r) for r in near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    alone = [r for r in rows if r not in known]
    assert sorted(map(str, (r for r in got if r not in known))) == sorted(map(str, alone))
    kept = [r for r in got if r in known]
    assert len(kept) == len(set(group)) == len({group[known.index(r)] for r in kept})
    for r in kept:
        assert r[0] == min(k[0] for k, g in zip(known, group) if g == group[known.index(r)])


def test_decontamination_finds_copies_and_edits(spark, docs):
    item = run_of(4, 40).split(" ")
    item[20] = "other"
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "not here at all"), (4, "")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.matches(docs, benchmark).collect()] == [(5, 1)]
    assert decontamination.decontaminated(docs, benchmark).count() == docs.count() - 1


def test_decontamination_equals_brute_force_alignment(spark):
    """One word in six or seven replaced, with the last one and without it, in one document and in several."""
    benchmark, docs = [], []
    for item in range(4):
        words = run_of(100 + item, 42 + item).split(" ")
        benchmark.append((item, " ".join(words)))
        for step in (6, 7):
            for first in range(step):
                edited = [f"x{item}" if k % step == first else w for k, w in enumerate(words)]
                docs.append((len(docs), run_of(200 + len(docs), 30) + " " + " ".join(edited) + " " + run_of(7, 30)))
        docs.append((len(docs), " ".join(words)))
        docs.append((len(docs), " ".join(words[:8])))
    lone = run_of(110, 42).split(" ")  # held by one document only, its last word replaced too
    benchmark.append((4, " ".join(lone)))
    docs.append((len(docs), run_of(111, 30) + " " + " ".join("x4" if k % 7 == 6 else w for k, w in enumerate(lone))))
    expected = set()
    for d, text in docs:
        for i, item in benchmark:
            a, b = (np.array([zlib.crc32(w.encode()) for w in t.split(" ")]) for t in (text, item))
            if decontamination.alignment_score(a, b) >= decontamination.LIMIT * 2 * len(b):
                expected.add((d, i))
    assert len(expected) == 4 * 14 + 1
    found = decontamination.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(benchmark, "item_id long, text string"),
    )
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected


def test_language_model_equals_plain_kneser_ney(spark):
    """The registered order scores every token with its full context, as a plain interpolated model does."""
    from collections import Counter

    from lakestrata.llm import lm_scoring

    order = lm_scoring.ORDER
    assert order >= 3
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 6, 30)) for _ in range(30)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score(docs, F.col("doc_id") < 20).collect()}
    marked = [["<s>"] * (order - 1) + t.split() + ["</s>"] for t in texts]
    counts = {order: Counter(tuple(t[i : i + order]) for t in marked[:20] for i in range(len(t) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])  # distinct left neighbours
    cut = {}
    for k, c in counts.items():
        n1, n2, n3, n4 = (sum(v == x for v in c.values()) for x in (1, 2, 3, 4))
        d = [0.5] * 3
        if n1 and n2:
            y = n1 / (n1 + 2 * n2)
            raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
            d = [min(max(v, 0.05), x - 0.05) for v, x in zip(raw, (1, 2, 3))]
        cut[k] = {g: d[min(v, 3) - 1] for g, v in c.items()}
    vocabulary = len({w for t in marked[:20] for w in t[order - 1 :]})
    total, left = {}, {}
    for k in counts:
        for g, v in counts[k].items():
            total[g[:-1]] = total.get(g[:-1], 0) + v
            left[g[:-1]] = left.get(g[:-1], 0) + cut[k][g]

    def rate(gram):
        lower = rate(gram[1:]) if len(gram) > 1 else 1 / (vocabulary + 1)
        if gram[:-1] not in total:
            return lower
        mass = counts[len(gram)].get(gram, 0) - cut[len(gram)].get(gram, 0)
        return (mass + left[gram[:-1]] * lower) / total[gram[:-1]]

    for k, t in enumerate(marked):
        plain = sum(np.log10(rate(tuple(t[i - order + 1 : i + 1]))) for i in range(order - 1, len(t)))
        assert abs(got[k] - plain) < 1e-6


def test_quality_keeps_clean_documents(docs):
    got = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in quality_rules.judge(docs).collect()}
    assert got[1] == (200, False, True) and got[6] == (0, True, False) and got[8] == (2, True, False)


def test_urls(spark):
    urls = ["http://A.example.org/es/1", "http://x.com/fr/2?q", None, "nothing", "http://x.com/de", "ftp://q.net"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("allow", "com/fr/"), ("block", "com/de/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("x.com", "/fr/2", "com/fr/", "allow")
    assert got[2] == got[3] == ("", "", None, "allow")
    assert got[4][:3] == ("x.com", "/de", None) and got[5] == ("q.net", "", None, "allow")


def test_codes_are_limited_and_decode():
    counts = 2 ** np.minimum(np.arange(60), 50)
    lengths = token_ids.code_lengths(counts)
    assert lengths.max() <= token_ids.MAX_BITS and (2.0 ** -lengths).sum() <= 1
    ids = np.random.default_rng(0).integers(0, 60, 3000)
    payload, marks = token_ids.encode(ids, lengths, token_ids.canonical_codes(lengths))
    assert (token_ids.decode(payload, marks, len(ids), token_ids.decoding_table(lengths)) == ids).all()


def test_empty_tables(docs):
    none = docs.where(F.lit(False))
    assert substring_dedup.deduplicated(none).count() == 0
    assert quality_rules.judge(none).count() == 0
    assert packing.packed(none, tokenizer_file()).count() == 0
    assert token_ids.round_trip(none, tokenizer_file()).count() == 0
    assert jaccard_join.linked_components(none).count() == 0


def test_jaccard_equals_brute_force_at_the_limit(spark):
    """Sizes on both sides of band borders, pairs just over and just under 80 percent, copies and shared passages."""
    rng, rows = np.random.default_rng(9), []
    shared = run_of(400, 40)
    for k, n in enumerate([6, 9, 20, 37, 40, 47, 73, 90, 143, 160, 220, 300]):
        base = run_of(500 + k, n)
        rows += [base, base, base + " " + run_of(600 + k, n // 5 + 1), base + " " + run_of(700 + k, n // 4 - 1),
                 base + " " + run_of(800 + k, n // 4 + 2), shared + " " + base]
        words = base.split(" ")
        words[int(rng.integers(n))] = "other"
        rows.append(" ".join(words))
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in map(str.split, rows)]
    comp = list(range(len(rows)))
    for _ in rows:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if 100 * len(x & y) >= 80 * len(x | y):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard_join.linked_components(docs).collect()}
    assert got == {k: (len(s), c) for k, (s, c) in enumerate(zip(sets, comp))}


def test_jaccard_keeps_long_ids_beside_null(spark):
    big = 2**53 + 1
    docs = spark.createDataFrame([(big, run_of(900, 30)), (None, run_of(901, 30)), (big + 2, run_of(900, 30))], "doc_id long, text string")
    got = {(r.id, r.component_id) for r in jaccard_join.linked_components(docs.coalesce(1)).collect()}
    assert got == {(big, big), (None, None), (big + 2, big)}


def test_wide_bitmaps_drop_large_sets_and_keep_all_links(spark):
    import random

    rng = random.Random(8)
    draw = lambda n: [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
    rows, shared = [], {}
    # Sizes around a power of two; 890 of 1000 each are links at 80 %, a half is not.
    for i, (size, other, common) in enumerate([(3000, 3000, 1500), (2000, 2100, 1000), (2000, 2100, 1850), (500, 520, 460), (4, 5, 4)]):
        both = draw(common)
        x, y = both + draw(size - common), both + draw(other - common)
        rows += [(2 * i, sorted(x)), (2 * i + 1, sorted(y))]
        shared[2 * i] = 180 * common >= 80 * (size + other)
    sets = spark.createDataFrame(rows, "row long, s array<long>")
    pairs = spark.createDataFrame([(a, a + 1) for a in shared], "a long, b long")
    wide = sets.select(F.col("row").alias("id"), F.size("s").alias("n"), jaccard_join.wide_bitmaps("s").alias("g"))
    left = {r["a"] for r in jaccard_join.bounded(pairs, wide, 80).collect()}
    assert left == {a for a, linked in shared.items() if linked}


def plain_scores(texts, train, order):
    """Scores, known words and tokens of an interpolated modified Kneser-Ney model, gram by gram."""
    from collections import Counter

    marked = [["<s>"] * (order - 1) + re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"] for t in texts]
    held = [t for t, known in zip(marked, train) if known]
    counts = {order: Counter(tuple(t[i : i + order]) for t in held for i in range(len(t) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut = {}
    for k, c in counts.items():
        n1, n2, n3, n4 = (sum(v == x for v in c.values()) for x in (1, 2, 3, 4))
        d = [0.5] * 3
        if n1 and n2:
            y = n1 / (n1 + 2 * n2)
            raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
            d = [min(max(v, 0.05), x - 0.05) for v, x in zip(raw, (1, 2, 3))]
        cut[k] = {g: d[min(v, 3) - 1] for g, v in c.items()}
    known = Counter(w for t in held for w in t[order - 1 :])
    total, left = {}, {}
    for k in counts:
        for g, v in counts[k].items():
            total[g[:-1]] = total.get(g[:-1], 0) + v
            left[g[:-1]] = left.get(g[:-1], 0) + cut[k][g]

    def rate(gram):
        lower = rate(gram[1:]) if len(gram) > 1 else 1 / (len(known) + 1)
        if gram[:-1] not in total:
            return lower
        return (counts[len(gram)].get(gram, 0) - cut[len(gram)].get(gram, 0) + left[gram[:-1]] * lower) / total[gram[:-1]]

    out = []
    for t in marked:
        own = t[order - 1 :]
        base = sum(np.log10((known[w] + 0.1) / (known.total() + 0.1 * (len(known) + 1))) for w in own)
        score = sum(np.log10(rate(tuple(t[i - order + 1 : i + 1]))) for i in range(order - 1, len(t)))
        out.append((len(own), sum(w in known for w in own), known.total(), base, score))
    return out


@pytest.mark.parametrize("order, part", [(1, 10**9), (2, 40), (3, 10**9), (3, 40), (4, 40)])
def test_language_model_in_parts_and_orders(spark, monkeypatch, order, part):
    """Tables in one part and in many, odd white space, capitals, null and empty texts, unknown words, repeated rows."""
    from lakestrata.llm import lm_scoring

    monkeypatch.setattr(lm_scoring, "PART", part)
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, 25) % 40) for _ in range(40)]
    texts += [None, "", " \t ", "W1 w2\x0bw3\x0c\x1cw4\x85w5 w6\r\nÄ ä", "new words W1 w2 only", texts[0], texts[0], " w1  w2 "]
    train = [k % 4 != 0 for k in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lm_scoring.score(docs, F.when(F.col("doc_id") != 4, F.col("doc_id") % 4 != 0), order=order).collect()}
    assert sorted(got) == list(range(len(texts)))
    for k, (n, known, total, base, score) in enumerate(plain_scores(texts, train, order)):
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not train[k], n, known, total)
        assert abs(r.base_score - base) < 1e-6 and abs(r.score - score) < 1e-6


def test_language_model_without_training_rows(spark):
    from lakestrata.llm import lm_scoring

    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(map(tuple, lm_scoring.score(docs, F.lit(None).cast("boolean")).collect()))
    assert got == [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)]


def test_gram_keys_beyond_64_bits():
    """Where 64 bits don't hold the words, keys are hashes and the words go along in the blocks."""
    from lakestrata.llm.lm_scoring import Grams
    from lakestrata.llm.mapped import unpacked

    words = [np.arange(50, dtype=np.uint64) * np.uint64(k + 3) + np.uint64(1 << 29) for k in range(3)]
    for bits in (30, 16):
        grams = Grams(3, bits, 2)
        use = [w & np.uint64((1 << bits) - 1) for w in words]
        key = grams.key(use, 50)
        order = np.argsort(key)
        sent = grams.blocks(key[order], [w[order] for w in use], np.arange(50, dtype=np.uint64))
        back = []
        for part, data in sent:
            *columns, numbers = unpacked(data, grams.columns + 1)
            own = grams.regained(part, columns)
            assert (grams.part(own) == part).all()
            back += zip(own.tolist(), *(w.tolist() for w in grams.words(own, columns)), numbers.tolist())
        assert grams.exact == (bits == 16)
        assert back == [(k, *w, n) for n, (k, *w) in enumerate(zip(key[order].tolist(), *(w[order].tolist() for w in use)))]


def test_mapped_tables_find_each_key(tmp_path):
    from lakestrata.llm.mapped import INDEX, coded, decoded, find, indexed, mixed, opened, saved, unmixed

    rng = np.random.default_rng(3)
    for bits, n in ((0, 1), (5, 20), (17, 1000), (42, 5000), (64, 300), (9, 0)):
        plain = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        keys = np.sort(mixed(plain, bits))
        assert len(np.unique(keys)) == len(plain) and (np.sort(unmixed(keys, bits)) == plain).all()
        counts, more = rng.integers(1, 9, len(keys)), rng.integers(0, 70000, len(keys))
        saved(f"{tmp_path}/t{bits}", [*indexed(keys, bits), *coded(counts, more)])
        table = opened(f"{tmp_path}/t{bits}")
        others = mixed(rng.integers(0, 1 << min(bits, 63), 500, dtype=np.uint64) & np.uint64((1 << bits) - 1), bits)
        asked = np.concatenate([keys, others])
        rows = find(table, asked)
        assert (rows == np.where(np.isin(asked, keys), np.searchsorted(keys, asked), -1)).all()
        got = decoded(table[INDEX:], rows)
        for values, want in zip(got, (counts, more)):
            assert (values == np.where(rows >= 0, np.append(want, 0)[rows], 0)).all()


def test_word_hashes_differ_and_repeat():
    import pyarrow as pa

    from lakestrata.llm.lm_scoring import LONG, word_hashes

    words = sorted({"x" * n + tail for n in (*range(1, 40), LONG - 1, LONG, LONG + 1, 3000) for tail in ("", "a", "b", "\x00", "é")} | {f"w{k}" for k in range(5000)})
    hashes = word_hashes(pa.array(words))
    assert len(set(hashes.tolist())) == len(words)
    assert (word_hashes(pa.array(words[7:])) == hashes[7:]).all() and (word_hashes(pa.array(words).slice(7)) == hashes[7:]).all()
    assert len(word_hashes(pa.array([], pa.string()))) == 0


def test_language_model_takes_few_bytes_a_token(spark):
    """What the model leaves in the shared folder; the code before, with rows of hashes, left 95 bytes a token here."""
    from pathlib import Path

    from lakestrata.llm import lm_scoring

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in shared.rglob("*") if f.is_file())
    rng, before = np.random.default_rng(4), size()
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 20000, 500)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert lm_scoring.score(docs, F.lit(True)).count() == 200
    assert size() - before < 25 * 200 * 500  # nearly all triples differ
