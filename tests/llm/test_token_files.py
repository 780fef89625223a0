import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from cases import edge_docs, edge_rows, order_key
from tokenizers import Tokenizer

from lapwise.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, out = 0, []
    for d, t, *_ in sorted(rows, key=lambda r: order_key(r[0])):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_texts_come_back(spark):
    rows = [r for r in edge_rows() if r[0] not in (7, 8, None)]
    got = token_files.round_trip(edge_docs(spark, rows), PATH).collect()
    assert sorted(map(tuple, got)) == expected(rows)


def test_repeated_and_null_ids_keep_every_row(spark):
    rows = edge_rows()
    got = token_files.round_trip(edge_docs(spark), PATH).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (repr(d), n, c) for d, _, n, c in expected(rows)
    )
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(np.cumsum([0] + [r.n_tokens for r in ordered[:-1]]))
    assert [order_key(r.doc_id) for r in ordered] == sorted(order_key(r.doc_id) for r in ordered)


def test_words_encode_like_whole_texts():
    encoder = token_files.WordEncoder(PATH, 2)
    tokenizer = Tokenizer.from_file(PATH)
    texts = [
        "", " ", "ÀÉ é́ ́x Σας\tΣ\n", "it's 'TIS a1b2  x", "<|endoftext|> a<|endoftext|>", "é" * 5000,
        "a\x1cb c\x1f.\x85d\xa0e\u2003f\u2028g\u3000h\u200bi\ufeff", "<|ENDOFTEXT|>, <|endoftext|>.",
        "The, THE. the!? İx, ẞ. ÀÉÎ×ß.", "'s, don't. x's. 12, 1.5, a..., .b ,c a.b", "\x1c \x1d\n\n",
        "K Å ﬁ, ½. ²! x². _. a_, é́. ª.", "A\xa0B.\x85C", "word.\nNext,\tline;",
    ]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_every_code_point_beside_marks_and_spaces():
    """Whole texts by the library against words: each character before a mark, in a word, alone."""
    encoder = token_files.WordEncoder(PATH, 2)
    tokenizer = Tokenizer.from_file(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for mark in token_files.CLOSING_MARKS:
        # Every mark behind Latin and the blocks around it; the full stop behind all.
        wanted = points if mark == "." else points[:0x3100]
        texts = [
            "\n".join(f"x{c}{mark} {c}{mark}y{c} A{c}" for c in wanted[i : i + 2000])
            for i in range(0, len(wanted), 2000)
        ]
        for at in range(0, len(texts), 50):
            some = texts[at : at + 50]
            whole = tokenizer.encode_batch_fast(some, add_special_tokens=False)
            for text, mine, theirs in zip(some, encoder.encode(some), whole):
                assert mine.tolist() == [*theirs.ids, 2], repr(text[:80])
        encoder.forget()


def test_letters_that_normalise_to_a_letter_and_a_mark():
    encoder = token_files.WordEncoder(PATH, 2)
    tokenizer = Tokenizer.from_file(PATH)
    for text in ("GELDİ.", "क़.", "x\u0958, y", "e\u0301. \u0130! ŉ. ǆ?"):
        assert encoder.encode([text])[0].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_another_tokenizer_encodes_whole_texts(tmp_path):
    other = Tokenizer.from_file(PATH)
    other.normalizer = None
    path = str(tmp_path / "other.json")
    other.save(path)
    encoder = token_files.WordEncoder(path, 2)
    assert not encoder.cuttable
    for text in ("The THE. the", "", "a  b"):
        assert encoder.encode([text])[0].tolist() == [*other.encode(text, add_special_tokens=False).ids, 2]


def test_file_layout():
    docs = [(5, np.arange(10, dtype=np.uint16)), (None, np.arange(3, dtype=np.uint16)), (7, np.arange(40, dtype=np.uint16))]
    data = token_files.sequence_file(docs, length=8, per_batch=2)
    file = token_files.SequenceFile(data)
    stream = np.concatenate([d for _, d in docs])
    assert len(file) == 7
    whole = np.concatenate([file.sequence(i)[0] for i in range(7)])
    mask = np.concatenate([file.sequence(i)[1] for i in range(7)])
    assert whole[: len(stream)].tolist() == stream.tolist() and whole[len(stream) :].sum() == 0
    assert mask.tolist() == [True] * len(stream) + [False] * (56 - len(stream))
    for row in file.documents.to_pylist():
        ids = dict(docs)[row["doc_id"]]
        assert file.tokens(row["first"], row["n_tokens"]).tolist() == ids.tolist()
    # Sequences are views of the buffer, and the plain reader of the library reads the file.
    assert not file.sequence(0)[0].flags.owndata
    assert pa.ipc.open_stream(data).read_all().num_rows == 7


def test_empty(spark):
    assert token_files.round_trip(edge_docs(spark).limit(0), PATH).count() == 0
