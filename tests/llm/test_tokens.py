"""Token ids and counts against whole-text encoding, grammar round trips, random access, edge cases."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowmill.llm.repair import compress, decode_document, decode_range, expand, read_token_files, rule_lengths, write_token_files
from rowmill.llm.tokens import IdEncoder, load_tokenizer, token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "a", "  two  spaces ", "line\nbreak \n and\ttab\r\n", "x <|endoftext|> y<|endoftext|>", "é́ naïve ﬁ Straße İ", "1 22 333 don't we'll",
    "nbsp here  wide", "́mark first", "a\x1cb \x85 c", "日本語 テキスト", "word " * 5000, "x" * 3000, "!!! ... $$$ %%%", "Ünï cödé's",
]


@pytest.fixture(scope="module")
def encoder():
    return IdEncoder(BYTES), load_tokenizer(BYTES)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1 \n\t.'é <|>endoftx"), max_size=40), max_size=4))
def test_pieces_change_nothing(encoder, texts):
    own, whole = encoder
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text(st.sampled_from("abZ19.,!-'<|>\n\tñßÉĠĉЖωǅ\u0301日²½"), max_size=9).map(lambda w: w + " "), max_size=9).map("".join), max_size=4))
def test_runs_change_nothing(encoder, texts):
    own, whole = encoder
    assert own.runs is not None
    ids, ends = own.encode_column(pa.array(texts, pa.string()))
    assert [part.tolist() for part in np.split(ids, ends)[: len(texts)]] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_only_odd_words_pass_the_whole_tokenizer(monkeypatch):
    seen = []
    by_whole = IdEncoder._by_whole
    monkeypatch.setattr(IdEncoder, "_by_whole", lambda self, pieces, before: seen.extend(pieces) or by_whole(self, pieces, before))
    encoder = IdEncoder(BYTES)
    encoder.encode(["Plain words, 12 más.\nÉtat don't stop", "plain <|endoftext|> 日本"])
    assert sorted(seen) == ["<|endoftext|>", "don't", "日本"]


def test_long_expansion_equals_expansion_by_rounds():
    draw = random.Random(6)
    ids = np.array([draw.choice([1, 1, 2, 3]) for _ in range(4000)], np.uint32)
    symbols, _, left, right, rounds = compress(ids, np.array([4000]), 10)
    assert len(symbols) > 10 + len(left) and rounds
    assert expand(symbols, left, right, 10, rounds).tolist() == ids.tolist()
    few = [expand(symbols[i : i + 1], left, right, 10, rounds) for i in range(len(symbols))]
    assert np.concatenate(few).tolist() == ids.tolist()


def test_counts(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, "x y", 2), (3, "a", 3)], "doc_id long, text string, n_tokens int")
    whole = load_tokenizer(WORDS)
    want = sorted((i, len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t in [*enumerate(ODD), (-1, "x y"), (3, "a")])
    got = token_counts(docs, WORDS).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts(docs.limit(0), WORDS).count() == 0


def test_files(spark, tmp_path):
    rows = [(i * 3 % 41, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "x"), (7, "twice", "x"), (7, "twice", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    write_token_files(docs, str(tmp_path / "files"), BYTES, shard_ids=2000)
    whole = load_tokenizer(BYTES)
    got = sorted(read_token_files(spark, str(tmp_path / "files")).collect(), key=lambda r: r.start)
    keys = [(-1 if r.doc_id is None else r.doc_id) for r in got]
    assert keys == sorted(keys) and len(got) == len(rows)
    at, sums = 0, []
    for r in got:
        assert r.start == at
        at += r.n_tokens
        sums.append((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32))
    want = []
    for d, t, _ in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((-1 if d is None else d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(sums) == sorted(want)
    for row in spark.read.parquet(str(tmp_path / "files")).collect():
        row = row.asDict()
        whole_shard = np.concatenate([decode_document(row, k) for k in range(len(row["doc_ids"]))])
        for begin, end in ((0, 1), (len(whole_shard) // 3, len(whole_shard) // 2 + 1), (len(whole_shard) - 1, len(whole_shard))):
            assert decode_range(row, begin, end).tolist() == whole_shard[begin:end].tolist()


def test_empty_files(spark, tmp_path):
    write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "none"), BYTES)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("base", [10, 70_000])
def test_grammar_round_trip(base):
    draw = random.Random(5)
    for n in (0, 1, 2, 3000):
        ids = np.array([draw.choice([1, 1, 1, 2, 3]) for _ in range(n)], np.uint32)
        ends = np.array(sorted({*[draw.randrange(1, n + 1) for _ in range(20)], n}) if n else [], np.int64)
        symbols, new_ends, left, right, rounds = compress(ids, ends, base)
        assert expand(symbols, left, right, base, rounds).tolist() == ids.tolist()
        lengths = np.concatenate([np.ones(base, np.uint32), rule_lengths(left, right, base, rounds)])
        assert [int(lengths[symbols[:e]].sum()) for e in new_ends] == ends.tolist()
        assert n < 100 or len(symbols) < n / 2
