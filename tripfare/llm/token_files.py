"""Token ids of documents in bit-packed block files, read back at random."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tripfare.llm import arrays
from tripfare.llm.tables import bound_batches
from tripfare.operators.durable import shared_folder

# A block ends with the first document that takes it to this many ids.
BLOCK_IDS = 1 << 16
# Pieces of text whose ids a worker remembers, twice over: none is longer than
# PIECE_BYTES, and an id is a byte at least, so this bounds the bytes too. A piece
# takes some 200 bytes of a worker beside its text, and so do its ids.
REMEMBERED = 50_000
PIECE_BYTES = 64
# Texts that are cut and encoded at a time.
ENCODED_BYTES = 4 << 20
# Pieces of them whose ids are laid out at a time; a longer text is laid out alone.
LAID_PIECES = 1 << 16

BLOCKS = (
    "part int, block int, first long, n_ids long, width int, low_doc long, high_doc long, doc_ids array<long>, lengths array<long>, packed binary"
)
_NAMES = [part.split()[0] for part in BLOCKS.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

# Unknown pieces that are encoded as one text, and texts that the tokenizer gets at a time:
# what it returns takes some hundred bytes an id.
TOGETHER = 64
TEXTS = 128

def _bytes(of: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(of)] = True
    return table


# Bytes that are white space to a regular expression of some library.
_BLANK = _bytes(bytes([*range(0x09, 0x0E), *range(0x1C, 0x21)]))
_BREAK = _bytes(b" \n")
_MARK = _bytes(b".,;:!?|*#$%&")
_PLAIN = _bytes(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits per id, least bits first, without gaps."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, start: int, count: int) -> np.ndarray:
    """Ids ``start`` to ``start + count`` of a packed block, without touching the others."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(packed, f"<u{size}", count, start * size).astype(np.uint32)
    at = (np.arange(start, start + count, dtype=np.int64)) * width
    low = at[0] >> 3 if count else 0
    data = np.frombuffer(packed[low : ((start + count) * width + 7 >> 3)] + bytes(8), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)[(at >> 3) - low].copy().view("<u8").reshape(-1)
    return ((words >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def even_breaks(data: np.ndarray) -> np.ndarray:
    """Places of spaces and line ends that follow a character that is surely no white space."""
    at = np.flatnonzero(_BREAK[data])
    at = at[at > 0]
    at = at[~_BLANK[data[at - 1]]]
    # White space beyond ASCII begins with these two bytes, or is C2 and one more.
    high = np.flatnonzero((data[at - 1] >= 0x80) & (at > 1))
    lead, second = data[np.maximum(at[high] - 3, 0)], data[at[high] - 2]
    blank = (second == 0xC2) | (np.isin(lead, (0xE1, 0xE2, 0xE3)) & np.isin(second, (0x80, 0x81, 0x9A)))
    return np.delete(at, high[blank])


def cut_pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Edges of the pieces of texts: no pre-token lies across one."""
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[even_breaks(data)] = True
    begins[offsets] = True
    # A mark after a letter or digit, at the end of its word.
    mark = np.flatnonzero(_MARK[data])
    mark = mark[(mark > 0) & begins[mark + 1]]
    begins[mark[_PLAIN[data[mark - 1]]]] = True
    return np.flatnonzero(begins)


def distinct_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Edges of the pieces of texts, and the pieces as numbers of distinct ones."""
    edges = cut_pieces(data, offsets)
    buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return edges, pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, buffers).dictionary_encode()


class Encoder:
    """A tokenizer with pre-tokens of a byte-level BPE, and the ids of pieces met before.

    A space or line end after a character that is no white space always begins
    a new pre-token, and so does a mark after a letter or digit. So a text may be
    cut there, and its ids are those of its pieces. Arrow tells the distinct
    pieces of many texts; each is looked up, or encoded, once, and numpy lays
    their ids out.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # In a byte-level vocabulary a token has one character per byte.
        size = self.tokenizer.get_vocab_size()
        self.token_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.width = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        ids = []
        for at in range(0, len(texts), TEXTS):
            found = self.tokenizer.encode_batch_fast([t.decode() for t in texts[at : at + TEXTS]], add_special_tokens=False)
            ids += [np.array(e.ids, "<u4") for e in found]
        return ids

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct pieces not met before."""
        found: dict[bytes, bytes] = {}
        # Many pieces that begin with white space are encoded as one text and told apart by their bytes.
        alone, joined = [], []
        for piece in pieces:
            (joined if piece[:1] in (b" ", b"\n") and not piece[-1:].isspace() else alone).append(piece)
        groups = [joined[i : i + TOGETHER] for i in range(0, len(joined), TOGETHER)]
        for group, ids in zip(groups, self._ids([b"".join(g) for g in groups])):
            reach = np.cumsum(self.token_bytes[ids])
            ends = np.fromiter(map(len, group), np.int64, len(group)).cumsum()
            at = np.searchsorted(reach, ends)
            if at[-1] == len(reach) - 1 and (reach[at] == ends).all():
                raw, low = ids.tobytes(), 0
                for piece, high in zip(group, ((at + 1) * 4).tolist()):
                    found[piece] = raw[low:high]
                    low = high
            else:
                alone += group
        found.update((p, ids.tobytes()) for p, ids in zip(alone, self._ids(alone)))
        return found

    def _known(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, as bytes."""
        if len(self.known) > REMEMBERED:
            # What is still in use comes back from the older half.
            self.older, self.known = self.known, {}
        ids = list(map(self.known.get, pieces))
        lacking = [i for i, x in enumerate(ids) if x is None]
        if not lacking:
            return ids
        names = [pieces[i] for i in lacking]
        again = list(map(self.older.get, names))
        found = self._learn([p for p, x in zip(names, again) if x is None])
        for i, piece, x in zip(lacking, names, again):
            ids[i] = found[piece] if x is None else x
        room = 2 * REMEMBERED - len(self.known)
        self.known.update([(p, ids[i]) for i, p in zip(lacking, names) if len(p) <= PIECE_BYTES][:room])
        return ids

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        return [ids for _, _, data, offsets in arrays.slices(column, ENCODED_BYTES) for ids in self._encoded(data, offsets)]

    def _encoded(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        if not len(data):
            return [b""] * (len(offsets) - 1)
        edges, pieces = distinct_pieces(data, offsets)
        ids = self._known(pieces.dictionary.to_pylist())
        kind = pieces.indices.to_numpy()
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        first = np.cumsum(size) - size
        distinct = np.frombuffer(b"".join(ids), "<u4")
        cut = np.searchsorted(edges, offsets)
        del edges, pieces, ids
        found = []
        low = 0
        # Ids are laid out for some texts at a time.
        while low < len(cut) - 1:
            high = max(low + 1, int(np.searchsorted(cut, cut[low] + LAID_PIECES, side="right")) - 1)
            own = kind[cut[low] : cut[high]]
            count = size[own]
            ends = np.cumsum(count)
            place = np.repeat(first[own] - (ends - count), count) + np.arange(count.sum())
            laid = distinct[place].tobytes()
            at = (np.r_[0, ends][cut[low : high + 1] - cut[low]] * 4).tolist()
            found += [laid[a:b] for a, b in zip(at[:-1], at[1:])]
            low = high
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def resolved(tokenizer: str) -> str:
    """A path as it is, or the name of a public tokenizer that is installed on the worker."""
    if "/" in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


def _blocks(tokenizer: str, end_id: int, block_ids: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(resolved(tokenizer))
        width = max(tool.width, end_id.bit_length())
        part, block, first = TaskContext.get().partitionId(), 0, 0
        ids, lengths, parts = [], [], []
        held = 0

        def ready() -> pa.RecordBatch:
            # Ids ascend, NULLs first.
            known = [x for x in ids if x is not None]
            low, high = (known[0], known[-1]) if known else (None, None)
            row = [part, block, first, held, width, low, high, ids, lengths, pack(np.frombuffer(b"".join(parts), "<u4"), width)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES)], _NAMES)

        for batch in batches:
            for doc, found in zip(batch.column(0).to_pylist(), tool.encode(batch.column(1))):
                ids.append(doc)
                parts.append(found + end)
                lengths.append(len(found) // 4 + 1)
                held += lengths[-1]
                if held >= block_ids:
                    yield ready()
                    block, first = block + 1, first + held
                    ids, lengths, parts, held = [], [], [], 0
            # What Arrow keeps for the next batch adds to what the next task or stage takes.
            pa.default_memory_pool().release_unused()
        if ids:
            yield ready()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the ids, in ascending order of doc_id, to ``path``.

    Format: a Parquet table of blocks. A block holds whole documents: their ids
    and lengths, and the token ids packed to the fewest bits that hold the
    vocabulary. (part, block) is the order of blocks, and ``first`` the ids of
    the part before it: an index that is read without the packed column.
    ``low_doc`` and ``high_doc`` bound the documents of a block, so that a search
    for one skips the others by their statistics. Parts
    are ranges of doc_id, so documents are sorted before they are encoded.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bound_batches(docs.sparkSession)
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_blocks(tokenizer, end_id, block_ids), BLOCKS).write.option("compression", "zstd").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["packed"], row["width"], 0, row["n_ids"]).astype("<u4")
            lengths = np.array(row["lengths"], np.int64)
            before = np.cumsum(lengths) - lengths
            sums = [zlib.crc32(ids[a : a + n]) for a, n in zip(before, lengths)]
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(before + row["start"]), pa.array(lengths), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])


def located(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start``: the ids of all blocks before them."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row per part: a task of the write. No packed bytes are read for it.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return blocks.join(starts, "part").withColumn("start", F.col("before") + F.col("first"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written table: (doc_id, start, n_tokens, ids_crc32)."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return located(spark, path).select("width", "n_ids", "doc_ids", "lengths", "packed", "start").mapInArrow(_read, schema)


def token_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Token ids of one document: only its block is read, only its bits are unpacked."""
    wanted = F.lit(doc_id).cast("long")
    blocks = spark.read.schema(BLOCKS).parquet(path).filter((F.col("low_doc") <= wanted) & (F.col("high_doc") >= wanted))
    found = []
    for row in blocks.toLocalIterator():
        at = 0
        for doc, n in zip(row["doc_ids"], row["lengths"]):
            if doc == doc_id:
                found.append(unpack(bytes(row["packed"]), row["width"], at, n))
            at += n
    return found


def token_table(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Write the tokens of ``docs`` under the shared folder and describe them from the files.

    A NULL text is empty and yields just the end id. Rows that share an id are
    all written, in order of their texts; rows without id come first. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(spark, path)
