import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import edge_docs, edge_rows

from lapwise.llm import piece_lattice

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return piece_lattice.Pieces(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def plain(text):
    """Texts that the library encodes without loss and without very long runs."""
    return "▁" not in text and len(text) != 3000


def test_merges_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = edge_rows() + [(500, "a      b", "s"), (501, "    y  z   ", "s"), (502, " ", "s"), (503, "=" * 600, "s"), (504, "\x01abc x \x01", "s"), (505, "?\u2581 \u2581\u2581x  y ?", "s")]
    got = piece_lattice.round_trip(edge_docs(spark, rows), PATH).collect()
    assert len(got) == len(rows) and all(r.restored for r in got)
    assert sorted((repr(r.doc_id), r.decoded_crc32) for r in got) == sorted(
        (repr(d), zlib.crc32((t or "").encode())) for d, t, _ in rows
    )
    found = {(repr(r.doc_id), r.n_pieces, r.ids_crc32) for r in got}
    for d, t, _ in rows:
        if plain(t or ""):
            ids = model.encode(t or "")
            assert (repr(d), len(ids), crc(ids)) in found


def viterbi(word, table, pieces):
    if word == piece_lattice.LITERAL_MARK:
        return [pieces.bytes_first + b for b in piece_lattice.MARK.encode()]
    best = [(0.0, -1, [])]
    for e in range(1, len(word) + 1):
        found = None
        for b in range(max(0, e - pieces.longest), e):
            part = word[b:e]
            if part in table:
                step = (best[b][0] + table[part][1], b, [table[part][0]])
            elif e - b == 1:
                step = (best[b][0] + pieces.fallback, b, [pieces.bytes_first + x for x in part.encode()])
            else:
                continue
            if found is None or step[0] > found[0]:
                found = step
        best.append(found)
    out, e = [], len(word)
    while e > 0:
        out, e = best[e][2] + out, best[e][1]
    return out


def test_greatest_score_equals_brute_force(spark, pieces):
    table = {p: (i, s) for p, i, s in pieces.rows}
    rows = [r for r in edge_rows() if r[0] not in (13, 15)]
    got = piece_lattice.round_trip(edge_docs(spark, rows), PATH, kind="unigram").collect()
    assert all(r.restored for r in got)
    expected = []
    for d, t, _ in rows:
        ids = [i for w in piece_lattice.marked_words(t or "") for i in viterbi(w, table, pieces)]
        expected.append((repr(d), len(ids), crc(ids)))
    assert sorted((repr(r.doc_id), r.n_pieces, r.ids_crc32) for r in got) == sorted(expected)


def long_runs():
    rng = random.Random(8)
    return [
        "x" * 3000, "a" + " " * 2501 + "b", "=" * 1999, "-" * 1000, "-" * 1001, "ab" * 1100, "é" * 1500,
        "".join(rng.choices("acgt", k=2300)), "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4000)),
        "the" * 900 + " and " + "stone" * 500,
    ]


def test_long_runs_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t, "s") for i, t in enumerate(long_runs())]
    got = {r.doc_id: r for r in piece_lattice.round_trip(edge_docs(spark, rows), PATH).collect()}
    for i, t, _ in rows:
        ids = model.encode(t)
        assert got[i].restored and (got[i].n_pieces, got[i].ids_crc32) == (len(ids), crc(ids)), t[:20]


def test_greatest_score_of_long_runs(spark, pieces):
    table = {p: (i, s) for p, i, s in pieces.rows}
    rows = [(i, t, "s") for i, t in enumerate(long_runs())]
    got = {r.doc_id: r for r in piece_lattice.round_trip(edge_docs(spark, rows), PATH, kind="unigram").collect()}
    for i, t, _ in rows:
        ids = [x for w in piece_lattice.marked_words(t) for x in viterbi(w, table, pieces)]
        assert got[i].restored and (got[i].n_pieces, got[i].ids_crc32) == (len(ids), crc(ids)), t[:20]


def test_decoding_equals_the_library(pieces):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("plain words", "  two  spaces\nand lines ", "日本語 😀"):
        assert piece_lattice.decode(model.encode(text), pieces) == text


def test_atoms_join_to_the_word(pieces):
    for word in ("▁hello,world", "▁", "x" * 2500, "日本語😀"):
        atoms = piece_lattice.atoms_of(word, pieces.pairs)
        assert "".join(atoms) == word and max(map(len, atoms)) <= piece_lattice.ATOM_CHARS


def test_empty(spark):
    assert piece_lattice.round_trip(edge_docs(spark).limit(0), PATH).count() == 0
