"""SentencePiece encoding by a relational lattice, and decoding.

Pieces never cross certain places of a text: they hold the space mark only in front, and
many pairs of characters in no piece at all.  Texts are cut there into atoms, and each
different atom of the corpus is encoded once: its substrings of bounded length are exploded
and joined to the piece table, the edges found are grouped by atom, and a fold over them
finds the path: that of the greatest total score for a unigram model (Viterbi), and that of
the merges in the order of their scores for a BPE model.  Very long atoms take the same path
by a heap of merges, or a Viterbi pass, where their documents are put together.  Between the first and the last step a chunk of documents waits in a
file of atom numbers, so texts are never shuffled.
"""

from __future__ import annotations

import heapq
import io
import itertools
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm.common import pick
from lapwise.llm.token_files import filesystem
from lapwise.session import scratch_path

# The mark that stands for a space.
MARK = "▁"

# Bytes of text that are numbered, and later put together, by one task.
CHUNK_BYTES = 24 << 20

# Documents that join a chunk at once, and words that are cut at once.
BATCH_TEXTS = 64
WORDS_CUT = 65_536

# Longest atom of the lattice; only unbroken runs of like characters come near it.  Longer
# ones are encoded whole, outside it.
ATOM_CHARS = 1000

# What a character that is no piece costs beyond the worst piece.
FALLBACK_COST = 10.0

ASKED = "chunk long, code int, atom string"
RESULT = "doc_id long, n_pieces long, ids_crc32 long, decoded_crc32 long, restored boolean"

# A literal mark is kept apart from a space as an atom no text is cut into.
LITERAL_MARK = "?" + MARK

# Stands between the strings of a path.  No piece holds it, so as a character of a text it
# is an atom of its own.
CUT = "\x01"


class Pieces:
    """The piece table of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes_first = model.piece_to_id("<0x00>")
        self.rows = [
            (model.id_to_piece(i), i, model.get_score(i))
            for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.scores = {p: score for p, _, score in self.rows}
        self.fallback = min(s for _, _, s in self.rows if s > -1e8) - FALLBACK_COST
        self.pairs = frozenset(p[i : i + 2] for p, _, _ in self.rows for i in range(len(p) - 1))
        # The bytes that each id stands for, the mark as a space.
        self.spelled = [b""] * len(ids)
        for piece, i, _ in self.rows:
            self.spelled[i] = piece.replace(MARK, " ").encode()
        for b in range(256):
            self.spelled[self.bytes_first + b] = bytes([b])

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "piece string, id int, score double")


def atoms_of(word: str, pairs: frozenset[str], longest: int | None = ATOM_CHARS) -> list[str]:
    """A word with its space mark, cut between characters that no piece has side by side.

    What is then still longer than ``longest`` is cut there, if that is given.
    """
    if word == LITERAL_MARK:
        return [word]
    cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in pairs]
    return [
        word[at : min(at + (longest or b - a), b)]
        for a, b in zip([0, *cuts], [*cuts, len(word)])
        for at in range(a, b, longest or b - a)
    ]


def merged_path(atom: str, scores: dict[str, float]) -> list[str]:
    """The strings that the merges of a BPE model leave, by a heap of them."""
    # The symbols as a linked list of their begins; 0 long once merged into the one before.
    size = len(atom)
    length = [1] * size
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    heap: list[tuple[float, int, int]] = []

    def offer(b: int) -> None:
        if b >= 0 and after[b] < size:
            e = after[after[b]]
            score = scores.get(atom[b:e])
            if score is not None:
                heapq.heappush(heap, (-score, b, e))

    for b in range(size):
        offer(b)
    while heap:
        _, b, e = heapq.heappop(heap)
        # Left over if one of the two has merged meanwhile.
        if not length[b] or after[b] >= size or after[after[b]] != e:
            continue
        right = after[b]
        length[b], length[right] = e - b, 0
        after[b] = e
        if e < size:
            before[e] = b
        offer(before[b])
        offer(b)
    return [atom[b : b + n] for b, n in enumerate(length) if n]


def greatest_path(atom: str, scores: dict[str, float], longest: int, fallback: float) -> list[str]:
    """The strings of the path of the greatest score; the longer last one among equals."""
    best, back = [0.0], [-1]
    for e in range(1, len(atom) + 1):
        found, origin = float("-inf"), -1
        for b in range(max(0, e - longest), e):
            score = scores.get(atom[b:e], fallback if e - b == 1 else None)
            if score is not None and best[b] + score > found:
                found, origin = best[b] + score, b
        best.append(found)
        back.append(origin)
    out, e = [], len(atom)
    while e > 0:
        out.append(atom[back[e] : e])
        e = back[e]
    return out[::-1]


def marked_words(text: str) -> list[str]:
    """The text's words with the spaces in front of each as marks, one added in front."""
    first, *rest = text.split(MARK)
    out = WORDS.findall(MARK + first.replace(" ", MARK)) if text else []
    for part in rest:
        out.append(LITERAL_MARK)
        out += WORDS.findall(part.replace(" ", MARK))
    return out


WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


LITERAL_PATH = CUT.join(LITERAL_MARK)


def gathered(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Runs of ``flat`` of the given begins and lengths, one after the other."""
    size = int(count.sum())
    kind = np.int32 if max(size, len(flat)) < 1 << 31 else np.int64
    place = np.repeat((begin - (np.cumsum(count) - count)).astype(kind), count)
    place += np.arange(size, dtype=kind)
    return flat[place]


class Cutter:
    """Cuts many words into atoms at once.

    Every character of a piece has a small number, all others share 0; ``together`` says
    which two numbers stand side by side in a piece.
    """

    def __init__(self, pairs: frozenset[str]):
        letters = sorted({c for p in pairs for c in p})
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.together = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        first, second = (self.number[[ord(p[i]) for p in pairs]] for i in (0, 1))
        self.together[first, second] = True

    def cut(self, words: str) -> tuple[list[str], np.ndarray]:
        """The atoms of all ``words`` in turn, and how many each word has.

        Words come with a space between them and hold none, so spaces keep atoms apart, too.
        """
        points = np.frombuffer(words.encode("utf-32-le"), "<u4")
        number, space = self.number[points], points == 32
        apart = np.zeros(len(points), bool)
        apart[1:] = ~(self.together[number[:-1], number[1:]] | space[:-1] | space[1:])
        at = np.flatnonzero(apart)
        atoms = np.insert(points, at, 32).tobytes().decode("utf-32-le").split(" ")
        ends = np.flatnonzero(np.append(space, True))
        cuts = np.searchsorted(at, ends)
        return atoms, np.diff(cuts, prepend=0).astype(np.int32) + 1


def is_plain(texts: pa.Array) -> pa.Array:
    """Whether a text's words are what its single spaces keep apart: no mark, no other spaces."""
    odd = pc.equal(texts, "")
    for found in (
        pc.match_substring(texts, MARK), pc.match_substring(texts, "  "),
        pc.starts_with(texts, " "), pc.ends_with(texts, " "),
    ):
        odd = pc.or_(odd, found)
    return pc.invert(odd)


def numbered_words(texts: pa.Array, plain: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of the words of all texts, how many each text has, and the different words.

    The words of plain texts come without the mark that stands in front of each.
    """
    if plain:
        listed = pc.split_pattern(texts, " ")
    else:
        listed = pa.array(list(map(marked_words, texts.to_pylist())), pa.list_(pa.string()))
    encoded = listed.flatten().dictionary_encode()
    return encoded.indices.to_numpy(), pc.list_value_length(listed).to_numpy(), encoded.dictionary


def checksums(texts: pa.Array) -> list[int]:
    """CRC of each text's bytes, out of the array's buffer."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].tolist()
    data = memoryview(texts.buffers()[2] or b"")
    return [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])]


def cut_words(cutter: Cutter, words: pa.Array, plain: bool) -> tuple[pa.Array, np.ndarray]:
    """The atoms of some words in turn, and how many each has."""
    # The literal mark is an atom as it stands; a stand-in keeps its place.
    literal = -1 if plain else pc.index(words, LITERAL_MARK).as_py()
    if literal >= 0:
        words = pc.replace_with_mask(words, pc.equal(words, LITERAL_MARK), pa.scalar(MARK))
    listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    joined = pc.binary_join(listed, " " + MARK if plain else " ")[0].as_py()
    found, pieces = cutter.cut(MARK + joined if plain else joined)
    if literal >= 0:
        found[int(pieces[:literal].sum())] = LITERAL_MARK
    return pa.array(found, pa.string()), pieces


def chunk_file(cutter: Cutter, ids: pa.Array, texts: pa.Array) -> tuple[bytes, pa.Array]:
    """Documents as numbers of their atoms, the frequent ones small, and the atoms in that order."""
    plain = is_plain(texts)
    codes, lengths, cut, counts, order = [], [], [], [], []
    known = 0
    for kind in (True, False):
        mine = plain if kind else pc.invert(plain)
        own, count, words = numbered_words(texts.filter(mine), kind)
        codes.append(own + np.int32(known))
        lengths.append(count)
        order.append(np.flatnonzero(mine.to_numpy(zero_copy_only=False)))
        if not len(words):
            continue
        known += len(words)
        for begin in range(0, len(words), WORDS_CUT):
            found, pieces = cut_words(cutter, words.slice(begin, WORDS_CUT), kind)
            cut.append(found)
            counts.append(pieces)
    del plain, own, count, words
    at, size, order = np.concatenate(codes), np.concatenate(lengths), pa.array(np.concatenate(order))
    del codes
    counts = np.concatenate([np.empty(0, np.int32), *counts])

    atoms = pa.concat_arrays([pa.array([], pa.string()), *cut]).dictionary_encode()
    del cut
    flat, begin = atoms.indices.to_numpy(), np.cumsum(counts, dtype=np.int64) - counts
    per_word = counts[at]
    numbers = gathered(flat, begin[at], per_word)
    ends = np.concatenate([[0], np.cumsum(per_word, dtype=np.int64)])[np.cumsum(size)]
    del at, per_word
    by_use = np.argsort(-np.bincount(numbers, minlength=len(atoms.dictionary)), kind="stable")
    rank = np.empty(len(by_use), np.int32)
    rank[by_use] = np.arange(len(by_use), dtype=np.int32)
    numbers = rank[numbers]
    table = pa.table({
        "doc_id": pa.array([ids.take(order).to_pylist()], pa.list_(pa.int64())),
        "crc": pa.array([checksums(texts.take(order))], pa.list_(pa.int64())),
        "length": pa.array([np.diff(ends, prepend=0).tolist()], pa.list_(pa.int64())),
        **{
            f"plane{k}": pa.array([((numbers >> 8 * k) & 255).astype(np.uint8).tobytes()], pa.binary())
            for k in range(4)
        },
    })
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue(), atoms.dictionary.take(pa.array(by_use))


def number_atoms(folder: str, pairs: frozenset[str]):
    """For `mapInArrow`: writes the partition's chunk files and asks for their atoms."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        part, written, cutter = TaskContext.get().partitionId(), 0, Cutter(pairs)

        def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal written
            name = (part << 24) + written
            written += 1
            whole = pa.Table.from_batches(held)
            held.clear()
            ids, texts = (whole.column(i).combine_chunks() for i in (0, 1))
            del whole
            data, atoms = chunk_file(cutter, ids, pc.fill_null(texts.cast(pa.string()), ""))
            del ids, texts
            # Arrow keeps what a chunk has used; the executor's memory is not its own.
            pa.default_memory_pool().release_unused()
            # A task that is run again writes the same file; it appears as a whole.
            draft = f"{root}/_{uuid.uuid4().hex}"
            with fs.open_output_stream(draft) as out:
                out.write(data)
            fs.move(draft, f"{root}/{name:020d}")
            # A chunk without atoms asks for one all the same, so that it is read.
            atoms = atoms if len(atoms) else pa.array([MARK])
            for at in range(0, len(atoms), 50_000):
                listed = atoms.slice(at, 50_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(listed), name)),
                        pa.array(np.arange(at, at + len(listed), dtype=np.int32)),
                        listed,
                    ],
                    names=["chunk", "code", "atom"],
                )

        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                some = batch.slice(at, BATCH_TEXTS)
                held.append(some)
                size += pc.sum(pc.binary_length(some.column(1))).as_py() or 0
                if size >= CHUNK_BYTES:
                    yield from close(held)
                    held, size = [], 0
        if held:
            yield from close(held)

    return number


def encoded_atoms(atoms: DataFrame, pieces: DataFrame, longest: int, fallback: float, kind: str) -> DataFrame:
    """``atom, path`` of distinct ``atom`` rows: the atom with its cuts marked.

    ``pieces`` is the model's bounded table and broadcast.  A string of one character need
    not be a piece; in a unigram model it then costs ``fallback``, and among equal paths
    the one whose last piece is longer wins, place by place.  Atoms without an edge are
    left out: they are cut into characters.  So are those longer than ``ATOM_CHARS``, which
    are not for the lattice.  All rows of an atom stay in the partition that
    the atom came in.
    """
    least = 1 if kind == "unigram" else 2
    spans = (
        # Not a filter, which would move below the exchange that the atoms share.
        atoms.select("atom", F.explode(F.expr(
            f"if(length(atom) between {least} and {ATOM_CHARS}, sequence(0, length(atom) - {least}), cast(array() as array<int>))"
        )).alias("b"))
        .select("atom", "b", F.explode(F.expr(f"sequence(b + {least}, least(b + {longest}, length(atom)))")).alias("e"))
        .select("atom", "b", "e", F.expr("substring(atom, b + 1, e - b)").alias("piece"))
    )
    found = spans.join(
        F.broadcast(pieces.select("piece", "score")), "piece", "left" if kind == "unigram" else "inner"
    )
    if kind == "unigram":
        found = found.where("score is not null or e - b = 1").fillna(fallback, ["score"])
    edges = found.groupBy("atom").agg(
        F.sort_array(F.collect_list(F.struct("e", "b", "score"))).alias("edges")
    )
    path = F.expr(VITERBI if kind == "unigram" else MERGES)
    return edges.select("atom", F.array_join(path, CUT).alias("path"))


_REACHED = "named_struct('score', best[x.b].score + x.score, 'b', x.b)"

# The best path to every place, from the edges in the order of their ends, and back again.
VITERBI = f"""
transform(array(
  aggregate(edges, array(named_struct('score', 0D, 'b', -1)),
    (best, x) -> case
      when size(best) = x.e then concat(best, array({_REACHED}))
      when best[x.b].score + x.score > best[x.e].score then concat(slice(best, 1, x.e), array({_REACHED}))
      else best end)),
  best -> aggregate(sequence(1, length(atom)),
    named_struct('at', length(atom), 'path', cast(array() as array<string>)),
    (s, i) -> if(s.at > 0, named_struct('at', best[s.at].b, 'path',
      concat(array(substring(atom, best[s.at].b + 1, s.at - best[s.at].b)), s.path)), s),
    s -> s.path))[0]
"""

# ``ends`` holds where the symbol that starts at a place ends, 0 where none starts.  An edge
# over two neighbouring symbols can merge; the one with the greatest score, then the
# leftmost, does, until there is none.
MERGES = """
transform(array(array_sort(edges,
    (x, y) -> case when x.score > y.score then -1 when x.score < y.score then 1 else x.b - y.b end)),
  merges -> transform(array(
    aggregate(sequence(1, length(atom)),
      named_struct('ends', concat(sequence(1, length(atom)), array(0)), 'open', true),
      (s, i) -> if(s.open,
        transform(array(filter(merges, x -> s.ends[x.b] > 0 and s.ends[s.ends[x.b]] = x.e)),
          m -> case when size(m) = 0 then named_struct('ends', s.ends, 'open', false)
            else named_struct('ends', transform(s.ends, (e, at) -> case
              when at = m[0].b then m[0].e when at = s.ends[m[0].b] then 0 else e end), 'open', true)
            end)[0],
        s),
      s -> s.ends)),
    ends -> transform(filter(transform(ends, (e, b) -> named_struct('b', b, 'e', e)), x -> x.e > 0),
      x -> substring(atom, x.b + 1, x.e - x.b)))[0])[0]
"""


def assembled(folder: str, pieces: Pieces, kind: str):
    """For `applyInArrow` on one chunk's ``chunk, code, path``: its documents."""
    spelled = pieces.spelled
    known = {p: [i] for p, i, _ in pieces.rows}

    def long_path(atom: str) -> list[str]:
        if kind == "unigram":
            return greatest_path(atom, pieces.scores, pieces.longest, pieces.fallback)
        return merged_path(atom, pieces.scores)

    def in_bytes(text: str) -> list[int]:
        return [pieces.bytes_first + b for b in text.encode()]

    def assemble(table: pa.Table) -> pa.Table:
        fs, root = filesystem(folder)
        with fs.open_input_stream(f"{root}/{table['chunk'][0].as_py():020d}") as source:
            chunk = pa.ipc.open_stream(source.read()).read_all()
        planes = [np.frombuffer(chunk[f"plane{k}"][0].as_py(), np.uint8) for k in range(4)]
        numbers = np.stack(planes, axis=1).view("<u4").ravel()
        lists: list[list[int]] = [[]] * table.num_rows
        for code, path in zip(table["code"].to_pylist(), table["path"].to_pylist()):
            if path == LITERAL_PATH:
                lists[code] = in_bytes(MARK)
            elif path in known:
                lists[code] = known[path]
            else:
                # A long atom comes without cuts.
                parts = long_path(path) if len(path) > ATOM_CHARS and CUT not in path else path.split(CUT)
                found = [known.get(p) or in_bytes(p) for p in parts] if path != CUT else [in_bytes(CUT)]
                lists[code] = list(itertools.chain.from_iterable(found))
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(itertools.chain.from_iterable(lists), np.int64, count.sum())
        begin = np.cumsum(count) - count
        size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        spelling = np.frombuffer(b"".join(spelled), np.uint8)
        spelled_at = np.cumsum(size) - size
        lengths = np.asarray(chunk["length"][0].as_py(), np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        rows = []
        for doc_id, crc, a, b in zip(chunk["doc_id"][0].as_py(), chunk["crc"][0].as_py(), ends[:-1], ends[1:]):
            own = gathered(flat, begin[numbers[a:b]], count[numbers[a:b]])
            # The first byte is the space put in front of every text.
            text = gathered(spelling, spelled_at[own], size[own])[1:].tobytes()
            decoded = zlib.crc32(text)
            rows.append(
                (doc_id, len(own), zlib.crc32(own.astype("<u4").tobytes()), decoded, decoded == crc)
            )
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.bool_()]
        return pa.table(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=[c.split()[0] for c in RESULT.split(", ")],
        )

    return assemble


def decode(ids: list[int], pieces: Pieces) -> str:
    """The text of one document's ids."""
    return b"".join(pieces.spelled[i] for i in ids)[1:].decode()


def round_trip(
    docs: DataFrame, model: str, kind: str = "bpe", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, decoded_crc32, restored`` for every row.

    Texts are encoded with the pieces of ``model``, by merges if its ``kind`` is ``bpe`` and
    by the greatest score if it is ``unigram``, and decoded again; the checksums are over
    the ids as little-endian 32-bit numbers and the UTF-8 bytes of the decoded text, and
    ``restored`` says whether that is the input.  A null or empty text has no pieces.  A
    literal space mark is encoded as bytes, so it comes back.  Null ids and repeated rows
    are encoded like others; an empty table gives no rows.
    """
    spark = docs.sparkSession
    table = Pieces(model)
    folder = scratch_path(spark, "atom-chunks")
    named = pick(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), text_col)
    asked = (
        named.mapInArrow(number_atoms(folder, table.pairs), ASKED)
        .where("atom is not null").repartition("atom")
    )
    # Both uses of ``asked`` need all its columns, so they read one and the same exchange.
    atoms = asked.groupBy("atom").agg(
        F.count("chunk").alias("chunks"), F.max("code").alias("code")
    ).where("chunks > 0 and code >= 0").select("atom")
    encoded = encoded_atoms(atoms, table.frame(spark), table.longest, table.fallback, kind)
    alone = F.when(F.length("atom") > ATOM_CHARS, F.col("atom")).otherwise(F.array_join(F.split("atom", ""), CUT))
    answered = asked.join(encoded, "atom", "left").select(
        "chunk", "code", F.coalesce("path", alone).alias("path")
    )
    return answered.groupBy("chunk").applyInArrow(assembled(folder, table, kind), RESULT)
