"""SentencePiece encoding and decoding of texts of any length, with a parallel scan over the chunks of giant documents.

In a vocabulary of merges a sequence of pieces is the encoding of a text if and only if each two neighbours are the
encoding of what they spell. So the encoding is the best path of a lattice of pieces whose steps weigh 0 or minus infinity.
A chunk's transfer matrix tells, for each piece that may cross its left boundary, which pieces may cross the right
one; matrices combine by max-plus products, which for these weights are unions of bit sets. Once the pieces at the
boundaries are known, each chunk is traced back by itself.

No piece goes on after the end of a word, so a matrix needs the lattice of a chunk's first and last word only, unless the chunk
is one word. The words between are encoded as in short texts.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardstream.llm.common import ROWS_AT_ONCE, Kept, arrow_schema, map_rows, pin

CHUNK = 1 << 15
KEPT_WORDS, KEPT_PAIRS = 120_000, 60_000
SPACE = "▁"
WORDS = re.compile(" *[^ ]+| +")

State = tuple[int, int]  # characters of a piece before and after a boundary


class Pieces:
    """The vocabulary of a model: encoding of words, which pieces may follow each other, and what they spell."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        shown = [self.model.id_to_piece(k) for k in range(size)]
        own = [not (self.model.is_byte(k) or self.model.is_control(k) or self.model.is_unknown(k)) for k in range(size)]
        self.ids = {p: k for k, (p, o) in enumerate(zip(shown, own, strict=True)) if o}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("the model has pieces that go on after the end of a word")
        self.longest = max(map(len, self.ids))
        self.spelled = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(k) else p.replace(SPACE, " ").encode() if o else b""
            for k, (p, o) in enumerate(zip(shown, own, strict=True))
        ]
        self.spelled[self.model.unk_id()] = " ⁇ ".encode()
        self.words = Kept(lambda word: np.array(self.alone(word), "<i4").tobytes(), KEPT_WORDS)
        self.follows = Kept(self._follows, KEPT_PAIRS)
        self.stable = Kept(lambda piece: self.alone(piece) == self.of(piece), KEPT_WORDS)

    def alone(self, text: str) -> list[int]:
        """Ids of a text that starts no document: no piece holds the line end put first, so that nothing joins it."""
        return self.model.encode("\n" + text)[2:]

    def of(self, piece: str) -> list[int]:
        """The id of a piece, or those of a character that the vocabulary lacks."""
        return [self.ids[piece]] if piece in self.ids else self.alone(piece)

    def _follows(self, pair: tuple[str, str]) -> bool:
        return self.alone(pair[0] + pair[1]) == self.of(pair[0]) + self.of(pair[1])

    def encode(self, text: str) -> bytes:
        """Ids of a text without the space that starts a document, as little-endian 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, WORDS.findall(text)))

    def decode(self, ids: np.ndarray, first: bool = True) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if first and text[:1] == " " else text

    def starting(self, text: str, at: int, until: int) -> Iterator[str]:
        """The pieces that may begin at a place: those of the vocabulary that merging can make, else the character."""
        known = False
        for end in range(at + 1, min(at + self.longest, until) + 1):
            piece = text[at:end]
            if piece in self.ids:
                known = known or end == at + 1
                if self.stable[piece]:
                    yield piece
        if not known:
            yield text[at : at + 1]


class Chunk:
    """A part of a document's text between ``low`` and ``high``, with some characters before and after."""

    def __init__(self, pieces: Pieces, left: str, body: str, right: str):
        self.pieces = pieces
        self.text = (left + body + right).replace(" ", SPACE)
        self.low, self.high = len(left), len(left) + len(body)
        starts = [m.start() + 1 for m in re.finditer(f"[^{SPACE}](?={SPACE})", self.text)]
        inside = [s for s in starts if self.low <= s < self.high]
        self.syncs = (inside[0], inside[-1]) if inside else None

    def entries(self) -> list[State]:
        """Every piece that may end at the left boundary or cross it. The first chunk has one entry, no piece at all."""
        if not self.low:
            return [(0, 0)]
        found = []
        for start in range(max(0, self.low - self.pieces.longest), self.low):
            for piece in self.pieces.starting(self.text, start, len(self.text)):
                if start + len(piece) >= self.low:
                    found.append((self.low - start, start + len(piece) - self.low))
        return found

    def reach(self, entries: dict[str, int] | dict, start: int, stop: int) -> dict[int, dict[str, int]]:
        """For each place, the pieces that may end there, with the set of entries (bits) that lead to them.

        ``entries`` has (place, piece) and bits; a piece of "" stands for the beginning of a word.
        """
        ending: dict[int, dict[str, int]] = {}
        for (place, piece), bits in entries.items():
            ending.setdefault(place, {})[piece] = bits
        for at in range(start, stop):
            if at in ending:
                before = ending[at]
                for piece in self.pieces.starting(self.text, at, len(self.text)):
                    bits = 0
                    for last, from_ in before.items():
                        if not last or self.pieces.follows[last, piece]:
                            bits |= from_
                    if bits:
                        there = ending.setdefault(at + len(piece), {})
                        there[piece] = there.get(piece, 0) | bits
        return ending

    def entering(self, states: list[State]) -> dict[tuple[int, str], int]:
        low = self.low
        return {(low + q, self.text[low - p : low + q]): 1 << k for k, (p, q) in enumerate(states)}

    def exits(self, ending: dict[int, dict[str, int]]) -> dict[State, int]:
        found = {}
        for end, pieces in ending.items():
            for piece, bits in pieces.items():
                if end >= self.high and end - len(piece) < self.high:
                    found[self.high - (end - len(piece)), end - self.high] = bits
        return found

    def transfer(self) -> tuple[list[State], dict[State, int]]:
        """The chunk's matrix: its entries, and for each exit the set of entries (bits) that lead there."""
        entries = self.entries()
        if not self.syncs:
            return entries, self.exits(self.reach(self.entering(entries), self.low, self.high))
        first, last = self.syncs
        alive = 0
        for bits in self.reach(self.entering(entries), self.low, first).get(first, {}).values():
            alive |= bits
        return entries, {k: alive for k in self.exits(self.reach({(last, ""): 1}, last, self.high))}

    def trace(self, ending: dict[int, dict[str, int]], end: int, piece: str, start: int) -> list[str]:
        """The pieces from ``start`` on that lead to a piece that ends at a place."""
        path = []
        while piece and end - len(piece) >= start:
            path.append(piece)
            end -= len(piece)
            piece = next((p for p in ending.get(end, ()) if not p or self.pieces.follows[p, piece]), "")
        return path[::-1]

    def encode(self, entry: State, exit_: State) -> bytes:
        """Ids of the pieces that start in the chunk, once the pieces at its boundaries are known."""
        end = self.high + exit_[1]
        leaving = end, self.text[self.high - exit_[0] : end]
        entering = self.entering([entry])
        if not self.syncs:
            return self._bytes(self.trace(self.reach(entering, self.low, self.high), *leaving, self.low))
        first, last = self.syncs
        head = self.reach(entering, self.low, first)
        begun = self.trace(head, first, next(iter(head[first])), self.low)
        tail = self.trace(self.reach({(last, ""): 1}, last, self.high), *leaving, last)
        return self._bytes(begun) + self.pieces.encode(self.text[first:last].replace(SPACE, " ")) + self._bytes(tail)

    def _bytes(self, path: list[str]) -> bytes:
        return np.array([k for piece in path for k in self.pieces.of(piece)], "<i4").tobytes()


def combined(first: tuple[list[State], dict[State, int]], second: tuple[list[State], dict[State, int]]):
    """The matrix of two chunks in a row; the product is associative."""
    through = {}
    for out, bits in second[1].items():
        reached = 0
        for k, state in enumerate(second[0]):
            if bits >> k & 1:
                reached |= first[1].get(state, 0)
        if reached:
            through[out] = reached
    return first[0], through


def boundary_states(matrices: list[tuple[list[State], dict[State, int]]]) -> list[State]:
    """The pieces at all boundaries of a document, its two ends included."""
    prefixes = [matrices[0]]
    for matrix in matrices[1:]:
        prefixes.append(combined(prefixes[-1], matrix))
    states = [min(prefixes[-1][1])]
    for k in range(len(matrices) - 1, 0, -1):
        entries, exits = matrices[k]
        reached = prefixes[k - 1][1]
        states.append(min(s for n, s in enumerate(entries) if exits[states[-1]] >> n & 1 and s in reached))
    return [(0, 0), *states[::-1]]


def load_model(spark, model_file: str) -> Broadcast:
    """The bytes of a model's file, read on the driver."""
    with open(model_file, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def ids_column(parts: list[bytes]) -> pa.Array:
    lengths = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode_texts(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """Encode every whole text: id, ``text_sha256``, ``n_chunks`` and ``ids``.

    The ids are those that the model's own library gives. Texts of more than ``chunk`` characters are cut into chunks,
    spread over tasks, and put together again. A document is one value, so its list of chunks is bounded too.

    A null or empty text has no ids. Null ids are kept, and rows that repeat get the same pieces. An empty table gives an empty
    table; other columns are not read. Only chunks of giant documents are shuffled.
    """
    spark = docs.sparkSession
    model = load_model(spark, model_file)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    schema = f"id {kind}, text_sha256 string, n_chunks int, ids array<int>"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = part.column("text").to_pylist()
                digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                found = ids_column([pieces.encode(" " + t) if t else b"" for t in texts])
                n_chunks = pa.array([1] * len(texts), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(digests), n_chunks, found], schema=out)

    giant = F.length("text") > chunk
    short = rows.filter(~giant).mapInArrow(run, schema)
    long = rows.filter(giant).select("id", "text", F.sha2("text", 256).alias("text_sha256"))
    encoded = encode_chunks(pin(cut_texts(long, model, chunk), "chunks"), model)
    counted = long.select("id", "text_sha256").join(encoded, "text_sha256")
    return short.unionByName(counted.select("id", "text_sha256", "n_chunks", "ids")).withColumnRenamed("id", id_col)


def cut_texts(long: DataFrame, model: Broadcast, chunk: int) -> DataFrame:
    """Chunks of different texts, each with the characters beside it that a piece could reach: (text_sha256, chunk, left, body,
    right). The space that starts a document is put first."""

    def start():
        beside = Pieces(model.value).longest

        def cut(digest, text):
            text = " " + text
            for k, at in enumerate(range(0, len(text), chunk)):
                yield digest, k, text[max(0, at - beside) : at], text[at : at + chunk], text[at + chunk : at + chunk + beside]

        return cut

    texts = long.dropDuplicates(["text_sha256"])
    schema = "text_sha256 string, chunk int, left string, body string, right string"
    return map_rows(texts, ["text_sha256", "text"], schema, start, many=True).repartition("text_sha256", "chunk")


def encode_chunks(chunks: DataFrame, model: Broadcast) -> DataFrame:
    """(text_sha256, n_chunks, ids) of texts that are cut into chunks, by the parallel scan."""

    def matrix_of():
        pieces = Pieces(model.value)

        def matrix(digest, k, left, body, right):
            entries, exits = Chunk(pieces, left, body, right).transfer()
            return digest, k, json.dumps([entries, [[*state, f"{bits:x}"] for state, bits in exits.items()]])

        return matrix

    columns = ["text_sha256", "chunk", "left", "body", "right"]
    matrices = map_rows(chunks, columns, "text_sha256 string, chunk int, matrix string", matrix_of)
    by_text = matrices.groupBy("text_sha256").agg(F.sort_array(F.collect_list(F.struct("chunk", "matrix"))).alias("all"))

    def states_of():
        def states(digest, parts):
            read = [json.loads(p["matrix"]) for p in parts]
            found = [([tuple(e) for e in entries], {(p, q): int(b, 16) for p, q, b in exits}) for entries, exits in read]
            at = boundary_states(found)
            return [(digest, k, [*at[k], *at[k + 1]]) for k in range(len(found))]

        return states

    schema = "text_sha256 string, chunk int, states array<int>"
    states = map_rows(by_text, ["text_sha256", "all"], schema, states_of, many=True)

    def encoded_by():
        pieces = Pieces(model.value)

        def encode(digest, k, left, body, right, at):
            return digest, k, Chunk(pieces, left, body, right).encode((at[0], at[1]), (at[2], at[3]))

        return encode

    known = chunks.join(pin(states, "states"), ["text_sha256", "chunk"])
    parts = map_rows(known, [*columns, "states"], "text_sha256 string, chunk int, part binary", encoded_by)
    whole = parts.groupBy("text_sha256").agg(F.sort_array(F.collect_list(F.struct("chunk", "part"))).alias("all"))

    def joined():
        def join(digest, parts):
            ids = b"".join(p["part"] for p in parts)
            return digest, len(parts), np.frombuffer(ids, "<i4")

        return join

    return map_rows(whole, ["text_sha256", "all"], "text_sha256 string, n_chunks int, ids array<int>", joined)


def decode_ids(encoded: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Decode every list of ids: the table with ``text_col`` in place of ``ids_col``, and the number of ids and their CRC-32.

    A null list counts as an empty one and gives an empty text. Bytes that are no character are replaced as in the library.
    """
    model = load_model(encoded.sparkSession, model_file)
    kept = [f for f in encoded.schema if f.name not in (ids_col, text_col, "n_ids", "ids_crc32")]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    schema = f"{names}, n_ids bigint, ids_crc32 bigint, {text_col} string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                lists = [np.asarray(x.values, np.int32) if x.is_valid else np.zeros(0, np.int32) for x in part.column(ids_col)]
                made = [
                    pa.array([len(x) for x in lists], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<i4").tobytes()) for x in lists], pa.int64()),
                    pa.array([pieces.decode(x) for x in lists], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *made], schema=out)

    return encoded.mapInArrow(run, schema)
