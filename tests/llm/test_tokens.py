import functools
import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lexipress.llm import packing, token_output, tokens
from lexipress.llm.tokens import PieceEncoder, encoder, vocabulary
from tests.llm.fixtures import DOCS, documents, extra_columns
from tokenizers import Tokenizer

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")


@functools.cache
def plain(name):
    """A tokenizer of the test's own, as the library loads it."""
    return Tokenizer.from_file(vocabulary(name))


def reference_ids(name, text):
    return plain(name).encode(text or "", add_special_tokens=False).ids + [0]


ODD = ["a <|endoftext|> b", "<|startoftext|>x<|endoftext|>", "it's 'tis don't we'll'd ''s 's\n's x'S I'RE", "  a   b\n\nc \t d  ", "\u1c89\ua7cbx", "e\u0301 \u00e9", "\U0001f600 ok \U00020001", "\u0130stanbul \u03a3\u03a3", "12 345,67 \u0663\u0664 \u00bd", "\x1c\x1f a", "w" * 900_000, "ab cd " * 200_000, "\n" * 700_000, ""]


@given(st.lists(st.lists(st.sampled_from([*"aB1İßΣσK»… \n\t.,'s\xa0é\x1c日<|>́", "'re", "'ll", "'s", "  ", "<|endoftext|>", "<|startoftext|>", "😀"]), max_size=40).map("".join), max_size=5))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_library_s_ids(texts):
    for name in NAMES:
        assert [x.tolist() for x in encoder(vocabulary(name)).encode(texts)] == [reference_ids(name, t) for t in texts]


@pytest.mark.parametrize("name", NAMES)
def test_odd_and_long_texts(name, sf_dir, spark):
    texts = ODD + [r[0] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert encoder(vocabulary(name)).kind
    assert [x.tolist() for x in encoder(vocabulary(name)).encode(texts)] == [reference_ids(name, t) for t in texts]


def test_classes_are_the_library_s():
    """Every tabled character has the class, and the lower case, that the library gives it."""
    pre, norm = plain(NAMES[0]).pre_tokenizer, plain(NAMES[1]).normalizer
    (of, _), (of_low, low) = tokens.classes(False), tokens.classes(True)
    one = lambda s: len(pre.pre_tokenize_str(s)) == 1
    for c in range(tokens.TABLED):
        if of[c] == tokens.UNSURE or c == ord("'"):
            continue
        x = chr(c)
        assert of[c] == (tokens.LETTER if one("a" + x) else tokens.NUMBER if one("1" + x) else tokens.OTHER if one("." + x) else tokens.SPACE), hex(c)
        if of_low[c] not in (tokens.UNSURE, tokens.SPACE) and unicodedata.is_normalized("NFC", x):
            assert norm.normalize_str(x) == chr(low[c]), hex(c)


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "SLICE", 16)
    enc = PieceEncoder(vocabulary())
    texts = ["one two three four five", "six seven one " + "y" * 99, "eight, nine; ten", "two two"]
    for _ in range(3):
        assert [x.tolist() for x in enc.encode(texts)] == [reference_ids(NAMES[0], t) for t in texts]


def test_pieces_of_one_key_are_left_to_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "mix", lambda h: h & np.uint64(7) | np.uint64(1) | h & np.uint64(0xFFFFFFFF00000000))
    texts = ["one two three four five six seven eight nine ten " * 3, "alpha beta gamma delta"]
    enc = PieceEncoder(vocabulary())
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(texts)] == [reference_ids(NAMES[0], t) for t in texts]


def test_other_layouts_are_encoded_whole(tmp_path):
    import json

    layout = json.load(open(vocabulary()))
    layout["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(layout))
    enc = PieceEncoder(str(path))
    want = Tokenizer.from_file(str(path))
    assert enc.kind is None and [x.tolist() for x in enc.encode(["a b", ""])] == [[*want.encode(t).ids, 0] for t in ("a b", "")]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
@settings(max_examples=200, deadline=None)
def test_values_round_trip(values):
    values = np.array(values, dtype="<u4")
    control, data = token_output.pack_values(values)
    assert len(control) == -(-len(values) // 4)
    assert (token_output.unpack_values(control, data, len(values)) == values).all()


def expected_output(rows):
    ids = [(d, reference_ids("byte_bpe_50k.json", t)) for d, t in rows]
    ids.sort(key=lambda r: (r[0] is not None, r[0] or 0, len(r[1])))
    out, start = [], 0
    for d, x in ids:
        out.append((d, start, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())))
        start += len(x)
    return out


def test_shards_round_trip(spark):
    docs = documents(spark)
    got = token_output.read_token_shards(token_output.write_token_shards(extra_columns(docs), shards=3)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected_output([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert token_output.read_token_shards(token_output.write_token_shards(empty)).count() == 0
    assert packing.pack(empty).count() == 0


def check_packing(rows, docs, capacity):
    pieces = {}
    for r in rows:
        assert 1 <= r["length"] <= capacity
        pieces.setdefault(r["sequence_id"], []).append(r)
    for group in pieces.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    want = []
    for d, t in docs:
        ids = reference_ids("word_bpe_49k.json", t)
        want += [(d, n, s, len(ids[s : s + capacity]), zlib.crc32(np.array(ids[s : s + capacity], dtype="<u4").tobytes())) for n, s in enumerate(range(0, len(ids), capacity))]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=key) == sorted(want, key=key)
    return len(pieces), -(-sum(r["length"] for r in rows) // capacity)


def test_packing(spark, sf_dir):
    docs = documents(spark)
    check_packing(packing.pack(extra_columns(docs)).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(12)
    got, least = check_packing(packing.pack(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert got <= least * 1.04 + 1


def test_items_that_do_not_go_together(spark):
    docs = spark.createDataFrame([(i, "word " * 1400) for i in range(300)], "doc_id long, text string").repartition(16)
    assert packing.pack(docs).select("sequence_id").distinct().count() == 300


def test_best_fit():
    bins = packing.best_fit([5, 4, 3, 2, 2, 7, 1], 8)
    assert sorted(i for b in bins for i in b) == list(range(7)) and len(bins) == 3
