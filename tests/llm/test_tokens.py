"""Tokenised texts, their files, packing and edits against whole-text encoding."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from lakestrata.llm import encoding, packing, token_counts, token_ids
from lakestrata.llm.common import tokenizer_file

PARTS = ["a", "b'", " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "'s", "don't", "<|endoftext|>", "é", "1", "12.", "!",
         "…", "👍🏽", "​", "ß", "﷐", "\r\n", "\x00", " word", "\n\n"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


@pytest.mark.parametrize("known", [encoding.KNOWN, 20])
def test_segments_give_the_ids_of_the_whole_text(tokenizer, monkeypatch, known):
    monkeypatch.setattr(encoding, "KNOWN", known)
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(6000)]
    coder = encoding.Encoder(tokenizer_file())
    for lo, hi in encoding.slices(texts, 3000):
        for text, ids in zip(texts[lo:hi], coder.ids(texts[lo:hi]), strict=True):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_special_strings_can_be_text(tokenizer):
    coder = encoding.Encoder(tokenizer_file(), special_as_text=True)
    tokenizer.encode_special_tokens = True
    for text in ("a<|endoftext|> b", " <|endoftext|>\n<|endoftext|>"):
        assert coder.ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    tokenizer.encode_special_tokens = False


def test_segment_lengths_cover_the_text():
    coder = encoding.Encoder(tokenizer_file())
    texts = ["one two\nthree", "", " lead", "two  spaces and\n\nlines ", "\n"]
    ids, sizes, counts, lengths = coder.segments(texts, measured=True)
    ends = np.cumsum(counts)
    for text, lo, hi in zip(texts, ends - counts, ends):
        assert lengths[lo:hi].sum() == len(text)
    assert sizes.sum() == len(ids)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [(i, "".join(rng.choices(PARTS, k=rng.randint(0, 60)))) for i in range(500, 0, -1)]
    return out + [(501, None), (None, "no id"), (502, "w " * 70_000), (7, "a second seven"), (503, "twice"), (503, "twice")]


def whole(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_files_hold_all_ids_in_ascending_order(spark, tokenizer, rows, tmp_path):
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in rows], "doc_id long, text string, ids string, part int")
    path = str(tmp_path / "ids")
    token_ids.write_ids(docs.repartition(5), tokenizer_file(), path)
    seen = []
    for file in sorted((tmp_path / "ids/blocks").glob("*.parquet")):
        for block in pq.read_table(file)["slices"].to_pylist():
            seen += [s["doc_id"] for s in block if s["piece"] == 0]
    keys = [(i is not None, i or 0) for i in seen]
    assert keys == sorted(keys) and len(seen) == len(rows)
    found = token_ids.digests(token_ids.read_slices(spark, path)).collect()
    expected = sorted((str(i), len(w := whole(tokenizer, t, 2)), zlib.crc32(w.tobytes())) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == expected
    start = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    assert sorted(map(tuple, token_ids.round_trip(docs, tokenizer_file()).collect()), key=str) == sorted(
        ((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=str)


def test_pieces_hold_every_id_once(spark, tokenizer, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.packed(docs, tokenizer_file()).collect()
    held = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        held.setdefault(str(p.doc_id), []).append((p.sequence_id, p.offset, p.start, p.doc_tokens, bytes(p.ids)))
    expected = {}
    for i, t in rows:
        expected.setdefault(str(i), []).append(whole(tokenizer, t, 1).tobytes())
    got = {}
    for i, parts in held.items():
        for _, _, start, _, ids in sorted(parts):
            texts = got.setdefault(i, [])
            if start == 0:
                texts.append(b"")
            texts[-1] += ids
    assert {i: sorted(t) for i, t in got.items()} == {i: sorted(t) for i, t in expected.items()}
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0)
        ends[p.sequence_id] = p.offset + p.length
    assert all(ends[s] == packing.SEQUENCE for s in range(max(ends)))
    narrow = packing.packed(docs, tokenizer_file(), with_ids=False)
    assert "ids" not in narrow.columns and narrow.count() == len(pieces)


def test_counts_after_random_edits_equal_encoding_again(spark, tokenizer):
    """Edits at any place, also in white space, at both ends, past the end and of whole texts."""
    rng = random.Random(6)
    schema = "doc_id long, text string, edits int, counts string"
    docs, edits, expected = [], [], {}
    for i in range(150):
        text = "".join(rng.choices(PARTS, k=rng.choice([0, 3, 40, 900])))
        docs.append((i, text or None if i % 2 else text, 0, "clash"))
        body, before = text, text
        for seq in range(i % 5):
            at, length = rng.randint(0, len(body) + 2), rng.choice([0, 1, 5, 200, 5000])
            insert = rng.choice([None, "", " ", "x", "".join(rng.choices(PARTS, k=rng.randint(1, 50)))])
            edits.append((i, seq, at, length, insert))
            start = min(at, len(body))
            body = body[:start] + (insert or "") + body[start + length :]
        expected[i] = (before, body)
    tokenizer.encode_special_tokens = True
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    expected = [(i, count(a), count(b)) for i, (a, b) in expected.items()]
    tokenizer.encode_special_tokens = False
    table = spark.createDataFrame([*docs, docs[44], (None, "no id", 0, ""), (1, "another one", 0, "")], schema)
    changes = spark.createDataFrame(
        [*edits, (None, 0, 0, 1, "x"), (2, 9, None, None, None)], "doc_id long, seq int, at int, length int, insert string")
    found = token_counts.recount(table, changes, tokenizer_file()).collect()
    got = sorted((r.doc_id, r.n_before, r.n_tokens) for r in found if r.doc_id is not None and r.n_before != 2)
    assert got == sorted(e for e in [*expected, expected[44]] if e[1] != 2)
    assert len(found) == 153
    assert all(r.n_encoded == 0 for r in found if r.doc_id is not None and r.doc_id % 5 == 0)
    assert token_counts.recount(table.limit(0), changes, tokenizer_file()).count() == 0


def test_an_edit_encodes_only_leaves_around_it(spark):
    words = " ".join(f"word{i}" for i in range(5000))
    docs = spark.createDataFrame([(1, words)], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 0, 20_000, 3, "abc")], "doc_id long, seq int, at int, length int, insert string")
    trees = token_counts.count_trees(docs, tokenizer_file())
    row = token_counts.recount(docs, edits, tokenizer_file(), trees=trees).first()
    assert 0 < row.n_encoded <= 2 * token_counts.LEAF + 1 and row.n_leaves >= 5000 // token_counts.LEAF


def test_a_word_before_a_stop_is_encoded_once(tokenizer):
    coder = encoding.Encoder(tokenizer_file())
    text = "a foo foo, foo. bar\nfoo, 12, \x1b. end"
    assert coder.ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert "foo" in coder.spaced.known and not {"foo,", "foo."} & set(coder.spaced.known)
    rng = random.Random(5)
    parts = ["a", "Z9", ",", ".", ", ", ". ", "\x02", "\x02, ", "%, ", "é, ", "'s, ", "s.\n", " ", "\n", "<|endoftext|>. "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    for text, ids in zip(texts, coder.ids(texts), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_repeated_segments_outlive_the_others(tokenizer, monkeypatch):
    monkeypatch.setattr(encoding, "KNOWN", 7)
    coder = encoding.Encoder(tokenizer_file())
    coder.ids(["x both both one two three four five six seven"])
    text = "y seven both eight"
    assert coder.ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert list(coder.spaced.known)[0] == "both" and "one" not in coder.spaced.known
    assert coder.ids([]) == []


def test_slices_are_bounded_in_bytes():
    """Texts are read in place, and wide characters count by their bytes; a longer text is alone."""
    texts = pa.array(["é" * 40, "a" * 30, "", "a" * 300, "b"])
    assert list(encoding.slices(texts, 100)) == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert list(encoding.slices(texts.slice(1, 2), 100)) == [(0, 2)] and not list(encoding.slices(texts.slice(5), 100))
    coder = encoding.Encoder(tokenizer_file())
    assert [x.tolist() for x in coder.ids(texts.slice(1, 3))] == [x.tolist() for x in coder.ids(["a" * 30, "", "a" * 300])]


def test_workers_keep_the_encoder_that_reads_special_strings_as_text():
    coder = encoding.kept_encoder(tokenizer_file(), special_as_text=True)
    assert coder is encoding.kept_encoder(tokenizer_file(), special_as_text=True)
    assert coder.tokenizer.encode_special_tokens
    assert not encoding.kept_encoder(tokenizer_file()).tokenizer.encode_special_tokens


def test_a_short_text_does_not_search_all_known_segments(tokenizer):
    coder = encoding.Encoder(tokenizer_file())
    coder.ids([" ".join(f"w{k}" for k in range(1000))])
    before = len(coder.spaced.known)
    text = "w0 new w1\nw2, end."
    assert coder.ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(coder.spaced.known) == before
    assert coder.ids([""])[0].tolist() == [] and coder.ids([" "])[0].tolist() == tokenizer.encode(" ").ids
