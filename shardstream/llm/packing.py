"""Best-fit packing planned from a histogram of lengths.

Documents become pieces of at most ``size`` tokens. Only the count of each length goes to the driver, at most ``size``
numbers; best fit over these counts gives slots for the 1st, 2nd, ... piece of every length, and each piece
finds its slot by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardstream.llm.common import arrow_schema, map_rows, partitions, pin, small_batches

SIZE, END_ID = 4096, 1
KEPT_WORDS = 160_000
RANK_BITS = 46

# Texts of these characters are their own NFC form, and the words below are those of a file with these rules.
PLAIN = re.compile("[\t\n\x0b\x0c\r -~À-ÖØ-öø-ÿ]*")
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PRETOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


class Recent(dict):
    """A table that makes what it lacks. When full it becomes the former one, from which what is used again is taken
    over, so that it holds at most twice ``most`` and what is frequent stays."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.former = make, most, {}

    def __missing__(self, key):
        made = self.former.get(key)
        if made is None:
            made = self.make(key)
        if len(self) >= self.most:
            self.former = dict(self)
            self.clear()
        self[key] = made
        return made


class WordIds:
    """Ids of texts as little-endian 32-bit numbers. What is between white space is looked up while it is kept, else
    put together from its words, which one table holds too; a word is run through the vocabulary's merges.

    That is done for vocabularies of the rules above only; with any other, every text goes to the tokenizer as it is.
    """

    def __init__(self, tokenizer, by_words: bool):
        self.tokenizer, self.by_words = tokenizer, by_words
        self.known = Recent(self._chunk, KEPT_WORDS)

    def _chunk(self, chunk: str) -> bytes:
        words = WORDS.findall(chunk)  # a word by itself is found as it is
        return self._word(chunk) if len(words) == 1 else b"".join(map(self.known.__getitem__, words))

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(SHOWN)
        ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        """Ids of a whole text. Any text that is not plain goes to the tokenizer as it is."""
        if not self.by_words or "<|" in text or not PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, text.lower().split()))


def shown_bytes() -> dict[int, int]:
    """How a byte-level vocabulary shows a byte: as its own character if that is visible, else as the next one from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + k for k, b in enumerate(hidden)}


SHOWN = shown_bytes()


def cuts_words(vocabulary: str) -> bool:
    """Whether a vocabulary's file has the rules by which ``WordIds`` cuts plain texts into words."""
    file = json.loads(vocabulary)
    return (
        file["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS}
        and file["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": PRETOKENIZERS}
        and file["model"]["type"] == "BPE"
        and not file["model"].get("dropout")
        and all("<|" in token["content"] and not token["normalized"] for token in file["added_tokens"])
    )


def encoder(vocabulary: str) -> WordIds:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return WordIds(tokenizer, cuts_words(vocabulary))


def cut_documents(
    docs: DataFrame,
    tokenizer_file: str,
    size: int = SIZE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Tokens of every whole text and ``end_id``, cut into pieces of ``size``; the last piece may be shorter.

    Rows: the id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``. A null or empty text is
    one piece that holds ``end_id`` alone. Any file of the library ``tokenizers`` will do. The vocabulary is read on the
    driver and goes to every worker once; a worker keeps its tables of words, which are bounded, for its next task.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": file.read()})
    end = np.array([end_id], "<u4").tobytes()

    def start():
        own = shared.value  # this worker's copy
        if "words" not in own:
            own["words"] = encoder(own["vocabulary"])
        words = own["words"]

        def cut(key, text) -> Iterator[tuple]:
            tokens = words.ids(text or "") + end
            for piece, at in enumerate(range(0, len(tokens), 4 * size)):
                part = tokens[at : at + 4 * size]
                row = key, piece, at // 4, len(part) // 4, zlib.crc32(part)
                yield (*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row

        return cut

    schema = (
        f"{id_col} {docs.schema[id_col].dataType.simpleString()}, piece int, start bigint, length bigint,"
        " ids_crc32 bigint"
    ) + ", ids array<int>" * with_ids
    return map_rows(docs, [id_col, text_col], schema, start, many=True)


def plan_slots(counts: Iterable[tuple[int, int]], size: int = SIZE) -> tuple[np.ndarray, int]:
    """Best fit over counts, longest first: rows of (length, first rank, pieces in each sequence, first sequence, offset),
    and the number of sequences.

    The pieces of a row fill sequence after sequence from ``offset``. Sequences with the same content so far are
    handled together; a length splits at most one such group and leaves at most one more, and a group that is
    used keeps less than half its room, so there are at most about ``3 * size * log2(size)`` rows.
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}
    rows, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((first, n))

    for length, left in sorted(counts, reverse=True):
        rank = 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first, n = size, sequences, -(-left // (size // length))
                sequences += n
            each = min(room // length, left)
            used = min(n, left // each)
            rows.append((length, rank, each, first, size - room))
            put(room - each * length, first, used)
            put(room, first + used, n - used)
            rank, left = rank + used * each, left - used * each
    return np.array(rows, np.int64).reshape(-1, 5), sequences


def place_pieces(pieces: DataFrame, size: int = SIZE, keys: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Give every piece a ``sequence_id`` and an ``offset`` there. ``pieces`` is read more than once and must not change.

    Ranks are counted in buckets: a length with a third of all pieces is spread over as many tasks as any other
    rows, and only the counts by length and bucket are summed up across them.
    """
    spark = pieces.sparkSession
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(4 * partitions(spark))))
    counts = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n"))
    planned, _ = plan_slots(((r.length, r.n) for r in histogram.collect()), size)
    starts = (planned[:, 0] << RANK_BITS) | planned[:, 1]
    order = np.argsort(starts)
    plan = spark.sparkContext.broadcast((starts[order], planned[order]))

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy(*keys)
    ranked = (
        bucketed.withColumn("nth", F.row_number().over(within) - 1)
        .join(totals, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("nth"))
        .select(*pieces.columns, "rank")
    )
    names = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema]
    schema = ", ".join([*names, "sequence_id bigint", "offset bigint"])
    out = arrow_schema(schema)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, rows = plan.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            found = rows[np.searchsorted(starts, (length << RANK_BITS) | rank, "right") - 1]
            nth = rank - found[:, 1]
            sequence = found[:, 3] + nth // found[:, 2]
            offset = found[:, 4] + nth % found[:, 2] * length
            columns = [batch.column(f.name) for f in out if f.name not in ("sequence_id", "offset")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema=out)

    return ranked.mapInArrow(slots, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    size: int = SIZE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents into few sequences of at most ``size`` tokens; one row per piece, see ``cut_documents``.

    Sequences are gapless from offset 0. Rows that repeat, ids included, are packed as often as they come; null ids
    stay null; an empty table gives no pieces; other columns are not read. The texts are read once: only the
    narrow rows of the pieces are written, shuffled and joined.
    """
    with small_batches(docs.sparkSession):
        pieces = pin(cut_documents(docs, tokenizer_file, size, end_id, id_col, text_col), "pieces")
    return place_pieces(pieces, size, (id_col, "piece", "ids_crc32"))
