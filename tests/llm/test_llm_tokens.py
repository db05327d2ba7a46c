import random
import zlib

import numpy as np
import pytest

from llm_frames import make_docs, prose
from tipscope.llm import packing, pieces, token_counts, token_files

BYTES, WORD = pieces.vocabulary_path("byte_bpe_50k.json"), pieces.vocabulary_path("word_bpe_49k.json")
ODD = [None, "", " ", "a", "  a  b ", "x<|endoftext|> y", "<|endoftext|>", "a  b  c", "it's don't  \n\n x\t", "\x1c a \x1f b\x85 c",
       "é́ é ́x", "日本語 テキスト　です", "<|startoftext|> hi", "a <|endof text|>", "🙂 🙂🙂", "x ​ y", "tail   ", "İstanbul Œuvre ÿ Ÿ",
       "a b c\n d", "1234 5,6 a1b2", 'what?! "quoted" (x) [y] ^~`', "\r\n\r\n", "ß ẞ ǅ ŉ", "The\nEnd.\nÉté!!\n"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = {p: Tokenizer.from_file(p) for p in (BYTES, WORD)}
    return lambda path, text: made[path].encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(11)
    alphabet = "ab é\n ß.,'3  \t<|>🙂ｶ ́"
    return ODD + [prose(rng, rng.randrange(1, 80)) for _ in range(40)] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]


@pytest.mark.parametrize("path", [BYTES, WORD])
def test_pieces_equal_whole_texts(library, path):
    encoder = pieces.PieceEncoder(path)
    assert encoder._way, "the short way must agree with the library on the probes"
    for text in texts():
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(path, text), repr(text)
        assert encoder.count(text) == len(library(path, text))


def test_piece_table_starts_anew(monkeypatch, library):
    monkeypatch.setattr(pieces, "TABLE_BYTES", 2000)
    encoder = pieces.PieceEncoder(BYTES)
    for text in texts():
        assert encoder.count(text) == len(library(BYTES, text))
        assert len(encoder._spaced) + len(encoder._leading) < 400


def test_piece_table_starts_anew_between_chunks(monkeypatch, library):
    monkeypatch.setattr(pieces, "TABLE_BYTES", 20_000)
    encoder, rng = pieces.PieceEncoder(BYTES), random.Random(14)
    for _ in range(60):
        chunk = " ".join("".join(rng.choice("abcdefghij0123") for _ in range(9)) for _ in range(50))
        at, before, n = token_counts.boundaries(encoder, chunk, True)
        assert n == len(library(BYTES, chunk)) and before[at.index(chunk.index(" "))] == len(library(BYTES, chunk.split()[0]))
        assert len(encoder._spaced) + len(encoder._leading) < 400


def test_counts_with_overlapping_chunks(spark, library, monkeypatch):
    rng = random.Random(12)
    long = [prose(rng, 3000), "".join(rng.choice("ab \n") for _ in range(9000)), "x" * 7000, " " * 5000 + "y" * 3000,
            "word " * 900 + "z" * 4000 + " word" * 900, "<|endoftext|>" * 500, "日" * 5000]
    monkeypatch.setattr(token_counts, "CHUNK", 600)
    all_texts = texts() + long
    got = {r.doc_id: r for r in token_counts.token_counts(make_docs(spark, all_texts), huge=1500, overlap=16).collect()}
    for i, text in enumerate(all_texts):
        want = len(library(BYTES, text))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), want, want > 512), i


def test_splice_refuses_without_common_boundary():
    chunk = {"n_tokens": 5, "left_at": [], "left_before": [], "right_at": [9], "right_before": [3]}
    assert token_counts.splice([chunk, {**chunk, "left_at": [8], "left_before": [1]}]) is None
    assert token_counts.splice([chunk, {**chunk, "left_at": [9], "left_before": [1]}]) == 3 + 4


def test_count_edges(spark):
    docs = make_docs(spark, [None, "a b", "a b"], ids=[None, 1, 1])
    rows = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs).collect())
    assert rows == [("1", 3, 2), ("1", 3, 2), ("None", 0, 0)]
    assert token_counts.token_counts(make_docs(spark, [])).count() == 0


def test_token_files_round_trip(spark, library):
    all_texts = texts()
    ids = random.Random(1).sample(range(10 ** 6), len(all_texts))
    docs = make_docs(spark, all_texts, ids=ids).repartition(5)
    manifest = token_files.write_token_files(docs)
    got = {r.doc_id: r for r in token_files.read_documents(manifest).collect()}
    start = 0
    for doc_id, text in sorted(zip(ids, all_texts)):
        want = [*library(BYTES, text), 0]
        crc = zlib.crc32(np.array(want, "<u4").tobytes())
        assert tuple(got[doc_id]) == (doc_id, start, len(want), crc)
        start += len(want)
    assert manifest.agg({"n_tokens": "sum"}).first()[0] == start
    assert {r.dtype for r in manifest.collect()} == {"<u2"}


def test_token_file_edges(spark):
    docs = make_docs(spark, ["b", None, "a", "a"], ids=[2, None, 2, 1])
    rows = token_files.read_documents(token_files.write_token_files(docs)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 2] and [r.start for r in rows] == [0, 1, 3, 5]
    assert token_files.read_documents(token_files.write_token_files(make_docs(spark, []))).count() == 0


def check_packing(rows, source, library, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(source)
    for doc_id, text in source.items():
        want, at = [*library(WORD, text), 1], 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want))
            assert r.ids_crc32 == zlib.crc32(np.array(want[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == own[0].sequence_length <= length and (at == length or at & (at - 1) == 0)


def test_packing(spark, library):
    rng = random.Random(13)
    all_texts = texts() + [prose(rng, 900) for _ in range(30)] + ["the same text again"] * 100
    docs = make_docs(spark, all_texts).repartition(4)
    check_packing(packing.pieces(docs).collect(), dict(enumerate(all_texts)), library, 2048)
    check_packing(packing.pieces(docs, length=16).collect(), dict(enumerate(all_texts)), library, 16)


def test_packing_edges(spark):
    docs = make_docs(spark, [None, "a", "a"], ids=[None, 1, 1])
    assert sorted((str(r.doc_id), r.length) for r in packing.pieces(docs).collect()) == [("1", 2), ("1", 2), ("None", 1)]
    assert packing.pieces(make_docs(spark, [])).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert_key(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_are_alike():
    encoder, axes, rng = pieces.PieceEncoder(WORD), packing.directions(), random.Random(3)
    kinds = [["river stone lamp"], ["der garten ist hier"], ["una casa grande azul"]]
    docs = [(k, " ".join(rng.choice(" ".join(kinds[k]).split()) for _ in range(80))) for k in range(3) for _ in range(40)]
    keys = packing.curve_keys(np.array([packing.project(np.frombuffer(encoder.encode(t), "<u4"), axes) for _, t in docs]))
    order = [docs[i][0] for i in np.argsort(keys)]
    assert sum(a != b for a, b in zip(order, order[1:])) < 40
