"""Token counts of whole texts: ids stay in the worker, only their number comes back."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripfare.llm import arrays
from tripfare.llm.tables import bound_batches
from tripfare.llm.token_files import resolved, distinct_pieces

# Characters that one call of a tokenizer is given, and from which on a text is cut.
BATCH_CHARS = 1 << 18
PIECE_CHARS = 1 << 14
# Bytes of texts whose equal pieces are counted once.
SLICE_BYTES = 8 << 20

# White space that follows none begins a new word of all tokenizers that are cut.
AT_SPACE = re.compile(r"(?<=\S)[ \n]")
# A byte-level splitter also parts full-width marks from the ideograph after them.
AT_SPACE_OR_MARK = re.compile(r"(?<=\S)[ \n]|(?<=[、。！，：；？])(?=[一-鿿])")
# Between plain words only: other characters may be changed into spaces or marks first.
BETWEEN_WORDS = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")

# Fixed value: the word pattern of a public vocabulary; no alternative holds white space.
WORDS_ONLY = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
HARMLESS_NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "Replace", "Sequence"}


def cut_texts(text: str, boundary: re.Pattern | None, limit: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces that end at the first boundary from ``limit`` characters on."""
    at = 0
    while boundary is not None and len(text) - at > limit:
        found = boundary.search(text, at + limit)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def _parts(step: dict | None, key: str) -> list[dict]:
    """A step of a tokenizer file and the steps inside it."""
    return [] if step is None else [step, *(p for inner in step.get(key, []) for p in _parts(inner, key))]


class _Words:
    """A vocabulary of the tokenizers library.

    ``splits`` tells whether every word of a text may be counted by itself.
    """

    skip = 0

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.no_truncation()
        self.tool.no_padding()
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        self.boundary = self._boundary(plan)
        marked = any(re.search(r"[0-9A-Za-z]\W$", t["content"]) for t in plan["added_tokens"])
        self.splits = self.boundary is AT_SPACE_OR_MARK and not marked

    @staticmethod
    def _boundary(plan: dict) -> re.Pattern | None:
        """Where texts may be cut, or None if the file says nothing that proves it."""
        if {p["type"] for p in _parts(plan["normalizer"], "normalizers")} - HARMLESS_NORMALIZERS:
            return None
        if any(t["single_word"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in plan["added_tokens"]):
            return None
        first = next((p for p in _parts(plan["pre_tokenizer"], "pretokenizers") if p["type"] != "Sequence"), {"type": None})
        if first["type"] == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]:
            return AT_SPACE if plan["normalizer"] else AT_SPACE_OR_MARK
        if first["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
            return AT_SPACE
        if first["type"] == "Split" and first["pattern"].get("Regex") == WORDS_ONLY and first["invert"]:
            return AT_SPACE
        return None

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]


class _Pieces:
    """A model of the sentencepiece library."""

    splits = False

    def __init__(self, path: str):
        import sentencepiece

        self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.tool.id_to_piece(i) for i in range(self.tool.get_piece_size())]
        # No piece goes on after a space, and each text is begun with one: so a text
        # may be cut between two words, and the space left out.
        crossed = any(re.search("[^▁]▁", n) for n in names)
        probe = [self.tool.encode(t) for t in ("ab 12 cd", "ab", "12", "cd")]
        self.boundary = None if crossed or probe[0] != probe[1] + probe[2] + probe[3] else BETWEEN_WORDS
        self.skip = 1

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.tool.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def counter(path: str) -> _Words | _Pieces:
    return _Pieces(path) if path.endswith(".model") else _Words(path)


def token_lengths(texts: list[str | None], tool: _Words | _Pieces, batch: int = BATCH_CHARS, piece: int = PIECE_CHARS) -> np.ndarray:
    """Tokens of every text. Calls are balanced: pieces of many texts, or some of one long text."""
    total = np.zeros(len(texts), np.int64)
    owners, pending, held = [], [], 0

    def count() -> None:
        np.add.at(total, owners, tool.lengths(pending))

    for i, text in enumerate(texts):
        for n, part in enumerate(cut_texts(text or "", tool.boundary, piece)):
            owners.append(i)
            pending.append(part[tool.skip :] if n else part)
            held += len(part)
            if held >= batch:
                count()
                owners, pending, held = [], [], 0
    if pending:
        count()
    return total


def counted_once(column: pa.Array, tool: _Words | _Pieces) -> np.ndarray:
    """Tokens of every text, each distinct word of a slice of them being encoded once."""
    total = np.zeros(len(column), np.int64)
    for row, end, data, offsets in arrays.slices(column, SLICE_BYTES):
        if len(data):
            edges, pieces = distinct_pieces(data, offsets)
            size = token_lengths([p.decode() for p in pieces.dictionary.to_pylist()], tool)
            sums = np.r_[0, np.cumsum(size[pieces.indices.to_numpy()])]
            total[row:end] = np.diff(sums[np.searchsorted(edges, offsets)])
    return total


def _counted(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(resolved(tokenizer))
        for batch in batches:
            texts = batch.column(2)
            n_tokens = counted_once(texts, tool) if tool.splits else token_lengths(texts.to_pylist(), tool)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_tokens)], ["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every whole text: (doc_id, n_bytes, n_tokens, over_limit).

    ``tokenizer`` names a public vocabulary or a path that workers can read:
    ``.json`` is read by the tokenizers library, ``.model`` by sentencepiece. No
    begin, end or other special tokens are added, texts are neither cut off nor
    padded, and special strings inside them count as the library counts them.

    Texts reach the worker in batches bounded by rows and bytes, and the library
    in calls of about ``BATCH_CHARS`` characters. A text of more than
    ``PIECE_CHARS`` is cut where the vocabulary proves that no token lies across:
    before white space that follows a word. Where nothing proves it, or no such
    place comes, the text is counted in one piece. With a byte-level vocabulary
    all texts of a batch are cut at such places, and equal pieces counted once.

    NULL is an empty text with 0 bytes and 0 tokens. Each row gives a row: those
    without id and those that repeat another too. Other columns are ignored; an
    empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(_counted(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
