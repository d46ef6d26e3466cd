import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from jobgrain.llm import pretokens, bpe, token_counts, wavelet
from jobgrain.session import shared_path

PIECES = [
    *"abAB'sStTreREvlm09 ²½é İΣσß\n\t\x1c\x1d\x85\xa0e中文한각ॐकᆨ😀Ⅷ٣ǅ!?*<|>", "́", "ͅ", "़", "　", "​", "﻿",
    "<|endoftext|>", "<|startoftext|>", "theatres", "internationalization",
]


def random_texts(count, length, seed):
    rng = random.Random(seed)
    for i in range(count):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, length)))
        yield text.replace(" ", "").replace("\n", "") if i % 3 == 0 else text


def test_stream_encoder_is_the_library(word_path, word_tokenizer):
    wide, narrow = bpe.StreamEncoder(word_path), bpe.StreamEncoder(word_path, window=24, cache=50)
    for text in random_texts(800, 60, 1):
        ids = word_tokenizer.encode(text, add_special_tokens=False).ids
        for encoder in (wide, narrow):
            assert np.frombuffer(b"".join(encoder.encode(text)), encoder.kind).tolist() == ids, text


@pytest.mark.parametrize("text", ["e" + "\u0301" * 60 + "nd", "x" * 20 + "e" + "\u0316" * 30 + "\u0301" * 30, "ab\u0301" * 9 + "a" + "\u0301" * 24 + "<|endoftext|>b", "\u0301" * 70])
def test_marks_longer_than_a_window(word_path, word_tokenizer, text):
    encoder = bpe.StreamEncoder(word_path, window=24, cache=50)
    assert np.frombuffer(b"".join(encoder.encode(text)), encoder.kind).tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids


def test_a_word_is_merged_once_whatever_stands_beside_it(word_path, word_tokenizer, monkeypatch):
    merged, calls = bpe.Merges.merged, []
    monkeypatch.setattr(bpe.Merges, "merged", lambda self, symbols: calls.append(1) or merged(self, symbols))
    encoder, text = bpe.StreamEncoder(word_path), " ".join(f"tokeniser{x} ({x}tokeniser" for x in ",.;:!?")
    ids = np.frombuffer(b"".join(encoder.encode(text)), encoder.kind).tolist()
    assert ids == word_tokenizer.encode(text, add_special_tokens=False).ids
    assert len(calls) <= 1 + 6 + 1 + 6
    long = "x" * (3 * bpe.BLOCK) + "é" * bpe.BLOCK
    assert np.frombuffer(b"".join(encoder.encode(long)), encoder.kind).tolist() == word_tokenizer.encode(long, add_special_tokens=False).ids


def test_transducer_emits_only_stable_ids(word_path, word_tokenizer):
    merges, rng = bpe.Merges(word_path), random.Random(2)
    assert 32 <= merges.lookahead < 2000
    for letters in ("ab", "thein", "aeiounsté", "a"):
        word = "".join(rng.choice(letters) for _ in range(3000))
        transducer, ids, most = bpe.WordTransducer(merges, block=16), [], 0
        for at in range(0, len(word), 37):
            ids += transducer.feed(word[at : at + 37])
            most = max(most, len(transducer._buffer))
        ids += transducer.finish()
        assert ids == word_tokenizer.encode(word, add_special_tokens=False).ids
        assert most <= merges.lookahead + 16 * 6


def test_an_improper_list_is_refused(tmp_path, word_path):
    import json

    parts = json.loads(open(word_path, encoding="utf-8").read())
    parts["model"]["merges"] = parts["model"]["merges"][::-1]
    (tmp_path / "t.json").write_text(json.dumps(parts))
    with pytest.raises(ValueError, match="proper"):
        bpe.Merges(str(tmp_path / "t.json"))


@pytest.mark.parametrize("name", ["word_path", "byte_path"])
def test_decoder_is_the_library(name, request):
    path = request.getfixturevalue(name)
    tokenizer, decoder = Tokenizer.from_file(path), bpe.StreamDecoder(path)
    for text in random_texts(300, 30, 3):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        parts = [ids[:1], ids[1:4], [], ids[4:]]
        decoder.reset()
        assert "".join(map(decoder.feed, parts)) + decoder.finish() == tokenizer.decode(ids, skip_special_tokens=False)
        if name == "byte_path":
            assert tokenizer.decode(ids, skip_special_tokens=False) == text


def test_round_trip_rows(odd_docs, odd_rows, no_docs, word_path, word_tokenizer):
    def expected(i, t):
        ids = word_tokenizer.encode(t or "", add_special_tokens=False).ids
        text = word_tokenizer.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    got = Counter(tuple(r) for r in bpe.round_trip(odd_docs, word_path).collect())
    assert got == Counter(expected(i, t) for i, t in odd_rows)
    assert bpe.round_trip(no_docs, word_path).count() == 0
    ids = {r.doc_id: np.frombuffer(r.ids, "<u2").tolist() for r in bpe.encode_documents(odd_docs, word_path).filter("doc_id = 3").collect()}
    assert ids == {3: word_tokenizer.encode("one", add_special_tokens=False).ids}


def test_token_counts(odd_docs, odd_rows, no_docs, byte_path):
    tokenizer = Tokenizer.from_file(byte_path)

    def expected(i, t):
        n = len(tokenizer.encode(t or "", add_special_tokens=False))
        return i, len((t or "").encode()), n, n > 1024

    assert Counter(tuple(r) for r in token_counts.count_tokens(odd_docs, byte_path).collect()) == Counter(expected(i, t) for i, t in odd_rows)
    assert token_counts.count_tokens(no_docs, byte_path).count() == 0
    lengths = token_counts.Lengths(byte_path)
    for text in random_texts(500, 40, 5):
        assert lengths.count(text) == len(tokenizer.encode(text, add_special_tokens=False)), text


def test_packed_table_and_summary(odd_docs, byte_path):
    table = {" é": 3, "x": 1, "": 0}
    assert dict(token_counts.unpack(token_counts.pack(table))) == table
    assert token_counts.shrink(Counter({"a": 9, "b": 4, "c": 2, "d": 1}), 2) == {"a": 7, "b": 2}
    few = token_counts.frequent_lengths(odd_docs, byte_path, size=5)
    assert len(dict(token_counts.unpack(few))) == 5


def test_wavelet_matrix_operations():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 512, 513, 3000):
        ids = rng.choice(np.array([0, 1, 2, 7, 300, 49407, 65535], np.uint16), n)
        matrix = wavelet.WaveletMatrix.build(ids)
        assert matrix.decode().tolist() == ids.tolist()
        assert [matrix.access(i) for i in range(0, n, 41)] == ids[::41].tolist()
        for symbol in (0, 2, 5, 49407):
            places = np.flatnonzero(ids == symbol).tolist()
            assert matrix.count(symbol) == len(places)
            assert matrix.rank(symbol, n // 2) == sum(p < n // 2 for p in places)
            assert [matrix.select(symbol, k) for k in range(0, len(places), 17)] == places[::17]
            assert matrix.select(symbol, len(places)) == -1


def test_shards_round_trip(spark, odd_docs, odd_rows, no_docs, word_path, word_tokenizer, monkeypatch):
    folder = shared_path(spark, "wavelet")
    wavelet.write_shards(odd_docs, folder, word_path, 2)
    got = sorted(wavelet.document_spans(spark, folder).collect(), key=lambda r: r.start)
    expected = Counter()
    for i, t in odd_rows:
        ids = word_tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        expected[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    names = [r.doc_id for r in got]
    assert names == sorted(names, key=lambda x: (x is not None, x))
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    empty = shared_path(spark, "wavelet")
    wavelet.write_shards(no_docs, empty, word_path, 2)
    assert wavelet.document_spans(spark, empty).count() == 0


def test_many_occurrences_by_select():
    rng = np.random.default_rng(3)
    for ids in (rng.integers(0, 5, 3000), np.full(1500, 7), rng.integers(0, 40_000, 2000), np.array([], int)):
        matrix = wavelet.WaveletMatrix.build(ids.astype("<u2"))
        for symbol in {0, 7, *ids[:5].tolist()}:
            got = [int(x) for part in matrix.locate(symbol) for x in part]
            assert got == np.flatnonzero(ids == symbol).tolist()


def test_ids_are_counted_and_located(spark, odd_docs, odd_rows, word_path, word_tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD", 500)
    monkeypatch.setattr(wavelet, "RANGE", 10_000)
    monkeypatch.setattr(wavelet, "MANY", 7)
    folder = str(tmp_path / "shards")
    wavelet.write_shards(odd_docs, folder, word_path, 2)
    encoded = [(i, [*word_tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in odd_rows]
    ids = [2, encoded[5][1][0], encoded[5][1][7], 12345, 12345, -1, 70_000]
    counts = {r.id: r.n for r in wavelet.count_ids(spark, folder, ids).collect()}
    assert counts == {i: sum(x.count(i) for _, x in encoded) for i in ids}
    found = sorted((r.id, str(r.doc_id), r.position) for r in wavelet.locate_ids(spark, folder, ids).collect())
    assert found == sorted((i, str(d), k) for i in {*ids} for d, x in encoded for k, y in enumerate(x) if y == i)


def test_special_strings_of_any_shape():
    special = {"[CLS]": 1, "a special string of many letters": 2}
    text = "x[CLS]y a special string of many letters!"
    assert [*pretokens.split_special(text, special)] == ["x", "[CLS]", "y ", "a special string of many letters", "!"]
