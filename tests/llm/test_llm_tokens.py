"""Byte-level BPE and token counts equal the libraries they stand for."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
import tokenizers
from pyspark.sql import functions as F

from crawlweave.llm import bpe_codec, pieces, token_count

RANKS, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


def texts():
    draw = random.Random(5)
    out = []
    for _ in range(400):
        kinds = [(32, 127), (0, 0x300), (0x300, 0xD7FF), (0xE000, 0x11FFF), (0x1D000, 0x110000)]
        out.append("".join(chr(draw.randrange(*draw.choice(kinds))) for _ in range(draw.randrange(1, 120))))
    out += ["\u0558 \u1c89\u16d40 x", "a\x1cb\x85c", "x<|endoftext|> y<|endoftext|><|endoftext|>", "it's  we'll\n\n \n z ", "", " ", "\n"]
    out += ["aaaa" * 3000, "ab" * 8000, " " * 2000, "1234567" * 500, "word " * 3000]
    return out


@pytest.fixture(scope="module")
def reference():
    ranks = bpe_codec.parse_ranks(bpe_codec.read_file(RANKS))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_equals_the_library(reference):
    codec = bpe_codec.Codec(bpe_codec.read_file(RANKS), P.PATTERN)
    for text in texts():
        ids = np.frombuffer(codec.encode(text), np.int32).tolist()
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_encoder_and_decoder_keep_what_they_hold():
    """Batches that alternate between both, each with its own copy of the file, parse it once and keep one memory."""
    one, two = bpe_codec.read_file(RANKS), bytes(bytearray(bpe_codec.read_file(RANKS)))
    codecs, files = set(), set()
    for _ in range(3):
        codecs.add(id(bpe_codec._codec(one, P.PATTERN)))
        files.add(id(bpe_codec._ranks(two)))
    assert len(codecs) == len(files) == 1
    assert bpe_codec._codec(one, P.PATTERN).ranks is bpe_codec._ranks(two).ranks
    bpe_codec._codec(one, r"\S+")
    assert id(bpe_codec._codec(two, P.PATTERN)) in codecs


def test_counts_equal_the_library():
    library, own = tokenizers.Tokenizer.from_file(MODEL), token_count.Counting(token_count.read_file(MODEL), P.PATTERN)
    for text in texts():
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_runs_join_to_the_text():
    split = pieces.splitter(P.PATTERN)
    for text in texts():
        assert "".join(split.runs(text)) == text
        assert [p for run in split.runs(text) for p in split.find(run)] == split.find(text)


def test_columns_with_nulls_repeats_and_odd_names(spark, reference):
    rows = [(1, "the cat"), (1, "the cat"), (None, None), (3, ""), (4, "naïve 😀 " * 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"ids": F.lit("x"), "n_tokens": F.lit(1), "bytes": F.lit(2)})
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_codec.digests(spark, docs, RANKS, P.PATTERN).collect())
    want = []
    for key, text in rows:
        ids = reference.encode_ordinary(text or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((key or 0, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert got == sorted(want)
    count = token_count.token_counter(spark, MODEL, P.PATTERN)
    assert [r[0] for r in docs.orderBy("doc_id").select(count("text")).collect()][0] == 0
    assert docs.limit(0).select(count("text")).collect() == []


def test_short_pieces_merge_together_as_one_by_one():
    file = bpe_codec._ranks(bpe_codec.read_file(RANKS))
    draw = random.Random(3)
    made = ["".join(draw.choice("aeinrst thABC01.,-\u00e9\u4e2d\U0001f600") for _ in range(draw.randrange(1, 9))).encode() for _ in range(3000)]
    made += [bytes(draw.randrange(256) for _ in range(draw.randrange(2, 18))) for _ in range(500)] + [b"a" * k for k in range(2, 18)]
    made = [p for p in made if 2 <= len(p) <= bpe_codec.FAN + 1 and p not in file.ranks]
    want = [np.array(bpe_codec.merge_piece(p, file.ranks), np.int32).tobytes() for p in made]
    assert file.merges.merge(made) == want


def test_texts_are_encoded_together_whatever_the_group(monkeypatch):
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab \n\t\0\u00e9'sZ9. \u1c8a") for _ in range(draw.randrange(40))) for _ in range(400)] + [None, "", "one two\nthree " + "x" * 200]
    data = bpe_codec.read_file(RANKS)
    ranks = bpe_codec._ranks(data).ranks
    find = pieces.splitter(P.PATTERN).find
    want = [b"".join(np.array(bpe_codec.merge_piece(p.encode(), ranks), np.int32).tobytes() for p in find(t)) if t else b"" for t in texts]
    for together, memory in ((1, 300_000), (50, 20), (1 << 18, 300_000)):
        monkeypatch.setattr(bpe_codec, "TOGETHER", together)
        monkeypatch.setattr(bpe_codec, "MEMORY_PIECES", memory)
        codec = bpe_codec.Codec(data, P.PATTERN)
        assert codec.encode_all(texts) == want and codec.encode_all(texts[::-1]) == want[::-1]


def test_the_pattern_splits_distinct_runs_only(monkeypatch):
    """What is done in Python grows with the distinct runs, also in texts with tabs, doubled and odd blanks."""
    seen = []
    find = pieces.Splitter.find
    monkeypatch.setattr(pieces.Splitter, "find", lambda self, text: seen.append(len(text)) or find(self, text))
    codec = bpe_codec.Codec(bpe_codec.read_file(RANKS), P.PATTERN)
    text = "one  two\tthree, naïve\u2003four \n\n five\u00a0 six\n" * 2000
    got, seen_chars = codec.encode_all([text, text + "x"]), sum(seen)
    assert seen_chars < 200
    for ids, whole in zip(got, (text, text + "x")):
        want = b"".join(np.array(bpe_codec.merge_piece(p.encode(), codec.ranks), np.int32).tobytes() for p in pieces.splitter(P.PATTERN).find(whole))
        assert ids == want


def test_a_run_begins_where_a_piece_does():
    draw = random.Random(11)
    blanks = " \n\t\r\x0b\x1c\x1f\x85\xa0\u1680\u2000\u200a\u2028\u202f\u205f\u3000"
    split = pieces.splitter(P.PATTERN)
    for _ in range(3000):
        text = "".join(draw.choice(blanks + "    \nab.é\u00b0\u2019\u200b\u4e2d\U0001f600'7") for _ in range(draw.randrange(30)))
        data = text.encode()
        starts = bpe_codec.run_starts(np.frombuffer(data, np.uint8), np.array([0, len(data)])).tolist()
        runs = [data[i:j].decode() for i, j in zip(starts, [*starts[1:], len(data)])]
        assert [p for run in runs for p in split.find(run)] == split.find(text)
        assert all(run[0] in " \n" and not before[-1].isspace() for before, run in zip(runs, runs[1:]))


def test_lists_of_any_arrow_layout(monkeypatch):
    rows = [None, "ab c", "", "naïve  x", None, "the cat\n", "z" * 30, " "] * 3
    codec = bpe_codec.Codec(bpe_codec.read_file(RANKS), P.PATTERN)
    want = [np.frombuffer(codec.encode(row or ""), np.int32).tolist() for row in rows]
    for together in (1, 20, 1 << 24):
        monkeypatch.setattr(bpe_codec, "TOGETHER", together)
        for kind in (pa.string(), pa.large_string()):
            whole = pa.array(rows, kind)
            assert codec.lists(whole).to_pylist() == want
            assert codec.lists(whole.slice(3, 7)).to_pylist() == want[3:10]
            assert codec.lists(whole.slice(0, 0)).to_pylist() == []
            assert codec.lists(pa.array([None, ""], kind)).to_pylist() == [[], []]
        lists = pa.array([None, *want], pa.list_(pa.int32()))
        assert codec._file.decode_lists(lists).to_pylist() == [b"", *((row or "").encode() for row in rows)]
        assert codec._file.decode_lists(lists.slice(2, 5)).to_pylist() == [(row or "").encode() for row in rows[1:6]]
        assert codec._file.decode_lists(lists.slice(0, 1)).to_pylist() == [b""]


def test_ids_with_gaps_decode_and_unknown_ids_are_an_error():
    gaps = bpe_codec.Ranks(b"YQ== 3\nYg== 7\nYWI= 20\n")
    whole = bpe_codec._ranks(bpe_codec.read_file(RANKS))
    assert gaps.decode_lists(pa.array([[3, 7, 20], []], pa.list_(pa.int32()))).to_pylist() == [b"abab", b""]
    for file, bad in ((gaps, 4), (gaps, 21), (gaps, -1), (whole, -1), (whole, len(whole.ranks))):
        with pytest.raises(KeyError):
            file.decode_lists(pa.array([[3], [bad]], pa.list_(pa.int32())))


def test_known_keeps_to_its_bound(monkeypatch):
    monkeypatch.setattr(bpe_codec, "MEMORY_PIECES", 5)
    known, solved = bpe_codec.Known(), []

    def solve(strings):
        solved.extend(strings.to_pylist())
        return pa.array([[len(s)] * len(s) for s in strings.to_pylist()], pa.list_(pa.int32()))

    for batch in (["a", "bb"], ["bb", "x" * 99], [f"{i:03}" for i in range(9)], [f"{i:03}" for i in range(30)], ["a", "001"]):
        assert known.of(pa.array(batch), solve).to_pylist() == [[len(s)] * len(s) for s in batch]
        assert len(known._strings) == len(known._ids) <= 10
    assert solved[:3] == ["a", "bb", "x" * 99] and solved.count("bb") == 1
