"""Token ids in Arrow stream files of equal-length sequences with masks."""

from __future__ import annotations

import io
import itertools
import json
import os
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import pick
from lapwise.session import scratch_path, stored

# Tokens of one sequence, sequences of one record batch, tokens after which a file is closed.
SEQUENCE = 2048
BATCH_SEQUENCES = 64
FILE_TOKENS = 4_000_000

# Texts encoded at once.
BATCH_TEXTS = 200

# Different words whose ids a Python worker remembers.
REMEMBERED = 1_000_000

WRITTEN = "part int, file string, ahead long, n_tokens long"
READ = "part int, ahead long, doc_id long, first long, n_tokens long, ids_crc32 long, n_sequences long"


# The steps before the merges of a tokenizer whose texts may be cut into words.
CUTTABLE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}

# Characters behind which a closing mark may be cut off are looked for below this code point.
LATIN = 0x250
CLOSING_MARKS = ".,;:!?"


def safe_letters(tokenizer) -> str:
    """The Latin characters that the tokenizer itself parts from a closing mark behind them."""
    def parted(c: str) -> bool:
        return all(
            [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(c + mark))][-1]
            == mark
            for mark in CLOSING_MARKS
        )

    return "".join(c for c in map(chr, range(33, LATIN)) if c.isalnum() and parted(c))


class WordEncoder:
    """Ids of whole texts from the ids of their words.

    A tokenizer of the `CUTTABLE` kind never joins characters across white space, nor a
    letter and the mark that closes a word; a text's ids are then those of its words one after
    the other, and each different word is encoded once.  Any other tokenizer encodes its
    texts in one piece.
    """

    def __init__(self, path: str, end_id: int):
        # Tasks share the cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.cuttable = all(spec[step] == rule for step, rule in CUTTABLE.items())
        if self.cuttable:
            self.closing = re.compile(rf"(?<=[{re.escape(safe_letters(self.tokenizer))}])[{CLOSING_MARKS}](?=\s|$)")
        self.end_id = end_id
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.empty(0, self.kind)
        self.starts = np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self.places.update(zip(words, itertools.count(len(self.places))))
        flat = np.fromiter(itertools.chain.from_iterable(lists), self.kind)
        ends = self.starts[-1] + np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, ends])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the end id."""
        if len(self.places) > REMEMBERED:
            self.forget()
        split = [split_words(t, self.closing) for t in texts] if self.cuttable else [[t] for t in texts]
        new = set(itertools.chain.from_iterable(split)).difference(self.places)
        if new:
            self.learn(list(new))
        # All words of all texts, and behind each text a place for the end id.
        which = np.fromiter(
            map(self.places.__getitem__, itertools.chain.from_iterable(split)),
            np.int64, sum(map(len, split)),
        )
        begin, count = self.starts[which], self.starts[which + 1] - self.starts[which]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        ids = self.ids[np.repeat(begin, count) + inside]
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum(list(map(len, split)))]
        whole = np.insert(ids, ends, self.end_id)
        return np.split(whole, (ends + np.arange(1, len(ends) + 1))[:-1])


def worker_encoder(path: str, end_id: int) -> WordEncoder:
    """The encoder of this Python worker, which serves many tasks, with what it has learned."""
    held = sys.modules.setdefault("lapwise_llm_worker", types.ModuleType("lapwise_llm_worker"))
    encoders = held.__dict__.setdefault("encoders", {})
    if (path, end_id) not in encoders:
        encoders[path, end_id] = WordEncoder(path, end_id)
    return encoders[path, end_id]


# White space to Python but not to the tokenizer.
CONTROL_SEPARATORS = "\x1c\x1d\x1e\x1f"


def split_words(text: str, closing: re.Pattern) -> list[str]:
    """Strings whose ids together are those of the text, few of them different.

    In Latin-1 the tokenizer's change of case is Python's; its special tokens, which it
    looks for before, are kept as they are.  ``closing`` finds the marks that end a word and are
    tokens of their own.
    """
    if any(c in text for c in CONTROL_SEPARATORS):
        return re.split("[ \t\n\x0b\x0c\r]+", text)
    if "<|" not in text:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            text = text.lower()
    return closing.sub(r" \g<0>", text).split()


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def sequence_file(
    documents: list[tuple[int | None, np.ndarray]], length: int, per_batch: int
) -> bytes:
    """One file: the ids of ``documents`` back to back, cut into sequences of ``length``.

    Every record batch but the last holds ``per_batch`` sequences, as fixed-size lists of
    ids and of mask bits, so a batch's place follows from its number.  The last sequence is
    filled with zeros whose mask is false.  The schema's metadata holds the table of
    documents: id, first token in the file, number of tokens.
    """
    ids = np.concatenate([d for _, d in documents])
    counts = np.fromiter((len(d) for _, d in documents), np.int64, len(documents))
    index = pa.table({
        "doc_id": pa.array([i for i, _ in documents], pa.int64()),
        "first": np.cumsum(counts) - counts,
        "n_tokens": counts,
    })
    listed = io.BytesIO()
    with pa.ipc.new_stream(listed, index.schema) as out:
        out.write_table(index)
    rows = -(-len(ids) // length)
    mask = np.zeros(rows * length, bool)
    mask[: len(ids)] = True
    ids = np.concatenate([ids, np.zeros(rows * length - len(ids), ids.dtype)])
    schema = pa.schema(
        [
            ("input_ids", pa.list_(pa.from_numpy_dtype(ids.dtype), length)),
            ("attention_mask", pa.list_(pa.bool_(), length)),
        ],
        metadata={b"documents": listed.getvalue()},
    )
    table = pa.table(
        [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), length),
        ],
        schema=schema,
    )
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(table, max_chunksize=per_batch)
    return sink.getvalue()


class SequenceFile:
    """Reads a file of `sequence_file` from a buffer without copying its ids."""

    def __init__(self, buffer):
        reader = pa.ipc.open_stream(pa.py_buffer(buffer))
        self.batches = list(reader)
        self.length = reader.schema.field("input_ids").type.list_size
        self.per_batch = self.batches[0].num_rows if self.batches else 0
        self.documents = pa.ipc.open_stream(reader.schema.metadata[b"documents"]).read_all()

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the buffer) and mask of sequence ``i``."""
        ids, mask = self.batches[i // self.per_batch].columns
        at = i % self.per_batch
        return (
            ids.values.to_numpy()[at * self.length : (at + 1) * self.length],
            mask.values.slice(at * self.length, self.length).to_numpy(zero_copy_only=False),
        )

    def tokens(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from place ``first``; a view where they lie in one batch."""
        size = self.per_batch * self.length
        pieces = []
        for b in range(first // size, (first + count - 1) // size + 1):
            lo, hi = max(first - b * size, 0), min(first + count - b * size, size)
            pieces.append(self.batches[b].column(0).values.to_numpy()[lo:hi])
        return pieces[0] if len(pieces) == 1 else np.concatenate(pieces)


def writer(folder: str, path: str, end_id: int, length: int):
    """For `mapInArrow`: writes the files of one partition and names them."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), worker_encoder(path, end_id)
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        written, ahead, pending, waiting = 0, 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal written, ahead, pending, waiting
            name = f"{part:06d}-{written:06d}-{ahead:015d}.arrow"
            # A task that is run again writes the same file; it appears as a whole.
            draft = f"{root}/_{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as out:
                out.write(sequence_file(pending, length, BATCH_SEQUENCES))
            fs.move(draft, f"{root}/{name}")
            row = pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [name],
                 "ahead": pa.array([ahead], pa.int64()), "n_tokens": pa.array([waiting], pa.int64())}
            )
            written, ahead, pending, waiting = written + 1, ahead + waiting, [], 0
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                some = batch.slice(at, BATCH_TEXTS)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(texts)):
                    pending.append((doc_id, ids))
                    waiting += len(ids)
                    if waiting >= FILE_TOKENS:
                        yield close()
        if pending:
            yield close()

    return write


def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over ``path, content``: the documents of each file."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            part, _, ahead = path.as_py().rsplit("/", 1)[-1].removesuffix(".arrow").split("-")
            file = SequenceFile(content.as_buffer())
            index = file.documents
            first, count = index["first"].to_numpy(), index["n_tokens"].to_numpy()
            crc = [
                zlib.crc32(file.tokens(f, n).astype("<u4").tobytes())
                for f, n in zip(first.tolist(), count.tolist())
            ]
            n = len(index)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, int(part), np.int32)),
                    pa.array(np.full(n, int(ahead), np.int64)),
                    index["doc_id"].combine_chunks(),
                    pa.array(first),
                    pa.array(count),
                    pa.array(crc, pa.int64()),
                    pa.array(np.full(n, len(file), np.int64)),
                ],
                names=[c.split()[0] for c in READ.split(", ")],
            )


def write_sequences(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    length: int = SEQUENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text and write the files; the table of files comes back.

    Files hold the documents in ascending order of id over all files (their names sort in
    that order).  Null texts are empty and consist of the end id alone; null ids come
    first; repeated rows stay.  A random second key spreads rows of one id over
    partitions.  ``folder`` must be seen by all executors.
    """
    rows = pick(docs, id_col, text_col).withColumn("tie", F.rand(2))
    ranged = rows.repartitionByRange(id_col, "tie").sortWithinPartitions(id_col, "tie")
    return stored(
        ranged.select(id_col, text_col).mapInArrow(writer(folder, tokenizer, end_id, length), WRITTEN),
        "token-files",
    )


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ...`` of every document, read from the files."""
    spark = files.sparkSession
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition that wrote files.
    bases = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")
    )
    content = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.arrow").load(folder)
        .select("path", "content")
    )
    return content.mapInArrow(read_files, READ).join(F.broadcast(bases), "part").select(
        "doc_id",
        (F.col("base") + F.col("ahead") + F.col("first")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = SEQUENCE) -> DataFrame:
    """Write all documents to a fresh shared folder and read them back.

    An empty table gives no rows.
    """
    folder = scratch_path(docs.sparkSession, "token-sequences")
    files = write_sequences(docs, folder, tokenizer, end_id, length)
    if files.isEmpty():
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, start long, n_tokens long, ids_crc32 long"
        )
    return read_documents(files, folder)
