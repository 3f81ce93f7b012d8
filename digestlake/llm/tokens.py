"""Token ids of whole texts, and a binary file format for them.

Encoding. The tokenizer drops white space and never lets a token span it, so a text's ids are the ids of its
words in turn. Each distinct word goes through the tokenizers library once per worker; the rest is array
indexing. A text with separators that only Python takes for white space goes through the library whole, and so does
every text where the tokenizer's file does not say that it normalises and splits in this way.

File format, little-endian: 8 bytes of magic; blocks; footer; 8 bytes of footer length. Ids are cut into
blocks of BLOCK. A block holds its minimum (u4), the packed width (u1), its number of exceptions (u2), its number
of ids (u2), the packed low values, then the exceptions' places (u2) and values (u4). The width is the least that holds the
chosen percentile of the block's values less their minimum; larger values are exceptions. The footer has the
number of blocks and of documents, each block's start (u8), and each document's id (i8) and number of ids (u8).

Files are as many as the bytes of the texts ask for. Rows of one id are ordered by a hash of their text, and equal rows are dealt over several files where they are many.

Defined results: a null text is empty and holds the end id alone; null ids come first; repeated rows are documents of their own; texts of any length are
encoded whole; an empty table gives no files and no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import KEPT, shared_dir, stored, text_or_empty

BLOCK = 1024
MAGIC = b"PFORTOK1"
HEAD = struct.Struct("<IBHH")
#: Bytes that str.split() drops and the tokenizer keeps.
ODD = re.compile("[\x1c-\x1f]")
#: Marks that end a word and are a pre-token of their own after letters.
MARKS = "!%&$*#.,;:?"
#: Words that are encoded as one text.
TOGETHER = 500
#: Bytes of texts of a file.
FILE_BYTES = 128 << 20
# How a tokenizer normalises and splits whose ids of a text are those of its words in turn.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class _Numbering(dict):
    """Numbers words in the order of their first appearance and remembers those not yet encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        n = self[word] = len(self)
        return n


def _words(text: str) -> list[str]:
    """What the tokenizer treats apart. Latin-1 text without marks of special tokens may be lower-cased first, as the tokenizer does, so that fewer words are distinct."""
    if ODD.search(text):
        return [text]
    return text.lower().split() if "<|" not in text and _latin(text) else text.split()


def _latin(text: str) -> bool:
    """Of Latin-1 alone, where lower case and composition are the same in all libraries."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Growing:
    """An array that is extended in place, with room to spare."""

    def __init__(self, kind: type):
        self.room, self.n = np.empty(1 << 12, kind), 0

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            room = np.empty(max(2 * len(self.room), self.n + len(more)), self.room.dtype)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : self.n + len(more)] = more
        self.n += len(more)


class _Ids:
    """The ids of numbered strings, back to back."""

    def __init__(self, first: int | None = None):
        self.numbers = _Numbering()
        self.ids, self.starts, self.lengths = _Growing(np.uint32), _Growing(np.int64), _Growing(np.int64)
        if first is not None:
            self.numbers[" "]  # no word has a space
            self.numbers.new.clear()
            self.add(np.array([first], np.uint32), np.ones(1, np.int64))

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.starts.extend(self.ids.n + np.cumsum(lengths) - lengths)
        self.lengths.extend(lengths)
        self.ids.extend(flat)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, length of each) of the strings with these numbers."""
        lengths = self.lengths.room[numbers]
        after = np.cumsum(lengths)
        at = np.repeat(self.starts.room[numbers] - (after - lengths), lengths)
        at += np.arange(len(at))
        return self.ids.room[at], lengths


class Encoder:
    """Ids of texts, each followed by end_id.

    A word of Latin letters and closing marks is two pre-tokens for the tokenizer: its ids are those of
    the letters and of the marks. So words share pieces, and a piece is encoded once while it is kept.
    """

    _kept: dict[tuple, "Encoder"] = {}

    def __init__(self, path: str, end_id: int, max_words: int = 600_000, max_pieces: int = 900_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id, self.max_words, self.max_pieces = Tokenizer.from_file(path), end_id, max_words, max_pieces
        self.words, self.pieces = _Ids(end_id), _Ids()
        said = json.loads(self.tokenizer.to_str())
        self.by_words = said["normalizer"] == NORMALIZER and said["pre_tokenizer"] == SPLITTER and said["model"].get("end_of_word_suffix") == "</w>"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @classmethod
    def of(cls, path: str, end_id: int) -> "Encoder":
        """One encoder for each Python worker."""
        if (path, end_id) not in cls._kept:
            cls._kept[path, end_id] = cls(path, end_id)
        return cls._kept[path, end_id]

    def _learn(self) -> None:
        new = self.words.numbers.new
        if not new:
            return
        if len(self.pieces.numbers) > self.max_pieces:
            self.pieces = _Ids()
        parts: list[str] = []
        counts = np.ones(len(new), np.int64)
        for k, word in enumerate(new):
            letters = word.rstrip(MARKS)
            if letters.isalpha() and len(letters) < len(word) and _latin(letters):
                parts.append(letters)
                parts.append(word[len(letters) :])
                counts[k] = 2
            else:
                parts.append(word)
        numbers = np.fromiter(map(self.pieces.numbers.__getitem__, parts), np.int64, len(parts))
        if unseen := self.pieces.numbers.new:
            self.pieces.add(*self._encoded(unseen))
            unseen.clear()
        flat, lengths = self.pieces.of(numbers)
        self.words.add(flat, np.add.reduceat(lengths, np.cumsum(counts) - counts))
        new.clear()

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, number of ids of each). Words of Latin letters go together: each is one pre-token, whose last id and no other ends a word."""
        plain = np.fromiter((p.isalpha() and _latin(p) for p in pieces), bool, len(pieces))
        words = [p for p, ok in zip(pieces, plain.tolist()) if ok]
        together = [" ".join(words[k : k + TOGETHER]) for k in range(0, len(words), TOGETHER)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(together, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, sum(map(len, ids)))
        ends = np.flatnonzero(self.ends_word[flat]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(flat)):
            plain[:], flat, ends = False, flat[:0], ends[:0]
        other = [e.ids for e in self.tokenizer.encode_batch_fast([p for p, ok in zip(pieces, plain.tolist()) if not ok], add_special_tokens=False)]
        lengths = np.empty(len(pieces), np.int64)
        lengths[plain], lengths[~plain] = np.diff(ends, prepend=0), np.fromiter(map(len, other), np.int64, len(other))
        out = np.empty(int(lengths.sum()), np.uint32)
        of_plain = np.repeat(plain, lengths)
        out[of_plain], out[~of_plain] = flat, np.fromiter(chain.from_iterable(other), np.uint32, len(out) - len(flat))
        return out, lengths

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [[*e.ids, self.end_id] for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), np.uint32, int(lengths.sum())), lengths

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not self.by_words:
            return self._whole(texts)
        if len(self.words.numbers) > self.max_words:
            self.words = _Ids(self.end_id)
        words: list[str] = []
        ends = np.empty(len(texts), np.int64)
        for k, text in enumerate(texts):
            words += _words(text)
            words.append(" ")
            ends[k] = len(words)
        numbers = np.fromiter(map(self.words.numbers.__getitem__, words), np.int64, len(words))
        self._learn()
        ids, lengths = self.words.of(numbers)
        return ids, np.diff(np.cumsum(lengths)[ends - 1], prepend=0)


KEPT.append(Encoder._kept)


def batches_of_texts(texts, chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about so many characters."""
    lo = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield lo, k + 1
            lo, size = k + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def pack_blocks(ids: np.ndarray, percentile: float = 95.0) -> list[bytes]:
    """The blocks of ids."""
    out: list[bytes] = []
    for lo in range(0, len(ids), BLOCK * 256):
        part = ids[lo : lo + BLOCK * 256]
        n = -(-len(part) // BLOCK)
        padded = np.full(n * BLOCK, part[-1], np.int64)
        padded[: len(part)] = part
        padded = padded.reshape(n, BLOCK)
        least = padded.min(axis=1)
        high = padded - least[:, None]
        k = min(BLOCK - 1, int(BLOCK * percentile / 100))
        widths = np.ceil(np.log2(np.partition(high, k, axis=1)[:, k] + 1)).astype(np.int64)
        blocks: list[bytes] = [b""] * n
        for w in np.unique(widths):
            rows = np.flatnonzero(widths == w)
            odd = high[rows] >= (1 << w)
            size = 2 if w <= 16 else 4
            low = np.where(odd, 0, high[rows]).astype(f"<u{size}").view(np.uint8)
            bits = np.unpackbits(low, axis=1, bitorder="little").reshape(len(rows), BLOCK, 8 * size)[:, :, :w]
            packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            for r, mask, body in zip(rows, odd, packed):
                at = np.flatnonzero(mask)
                size = min(BLOCK, len(part) - r * BLOCK)
                at = at[at < size]
                blocks[r] = HEAD.pack(least[r], w, len(at), size) + body.tobytes() + at.astype("<u2").tobytes() + padded[r, at].astype("<u4").tobytes()
        out += blocks
    return out


def unpack_blocks(data: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks that begin at starts; blocks of one width are unpacked together."""
    heads = [HEAD.unpack_from(data, s) for s in starts]
    least, widths, n_odd, sizes = (np.array(x, np.int64) for x in zip(*heads))
    raw, at = np.frombuffer(data, np.uint8), np.array(starts, np.int64) + HEAD.size
    out = np.empty((len(starts), BLOCK), np.uint32)
    for w in np.unique(widths):
        rows = np.flatnonzero(widths == w)
        body = raw[at[rows][:, None] + np.arange(BLOCK * w // 8)]
        size = 2 if w <= 16 else 4
        bits = np.zeros((len(rows), BLOCK, 8 * size), np.uint8)
        bits[:, :, :w] = np.unpackbits(body, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        out[rows] = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little").view(f"<u{size}")
    out += least[:, None].astype(np.uint32)
    for k in np.flatnonzero(n_odd):
        a, n = int(at[k] + BLOCK * widths[k] // 8), int(n_odd[k])
        out[k, np.frombuffer(data, "<u2", n, a)] = np.frombuffer(data, "<u4", n, a + 2 * n)
    return out.reshape(-1)[: (len(starts) - 1) * BLOCK + sizes[-1]] if (sizes[:-1] == BLOCK).all() else np.concatenate([row[:n] for row, n in zip(out, sizes)])


def unpack_block(data: bytes) -> np.ndarray:
    return unpack_blocks(data, [0])


class Writer:
    """One file, written block by block under another name and then given its own."""

    def __init__(self, uri: str):
        from pyarrow.fs import FileSystem

        folder, self.name = uri.rsplit("/", 1)
        self.fs, self.folder = FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.part = f"{self.folder}/.{self.name}-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part)
        self.out.write(MAGIC)
        self.at, self.rest = len(MAGIC), np.zeros(0, np.uint32)
        self.starts: list[int] = []
        self.doc_ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def _blocks(self, ids: np.ndarray) -> None:
        for block in pack_blocks(ids):
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.doc_ids.append(np.asarray(doc_ids, "<i8"))
        self.lengths.append(lengths.astype("<u8"))
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        if whole:
            self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def close(self) -> tuple[int, int]:
        if len(self.rest):
            self._blocks(self.rest)
        doc_ids, lengths = np.concatenate([np.zeros(0, "<i8"), *self.doc_ids]), np.concatenate([np.zeros(0, "<u8"), *self.lengths])
        footer = struct.pack("<QQ", len(self.starts), len(doc_ids)) + np.array(self.starts, "<u8").tobytes() + doc_ids.tobytes() + lengths.tobytes()
        self.out.write(footer + struct.pack("<Q", len(footer)))
        self.out.close()
        self.fs.move(self.part, f"{self.folder}/{self.name}")
        return len(doc_ids), int(lengths.sum())


class Reader:
    """Random access to one file: any block by its start, any document by its place."""

    def __init__(self, uri: str):
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        (length,) = struct.unpack("<Q", self.file.read_at(8, size - 8))
        self.end = size - 8 - length
        footer = self.file.read_at(length, self.end)
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        n_blocks, n_docs = struct.unpack_from("<QQ", footer)
        self.starts = np.frombuffer(footer, "<u8", n_blocks, 16)
        self.doc_ids = np.frombuffer(footer, "<i8", n_docs, 16 + 8 * n_blocks)
        self.lengths = np.frombuffer(footer, "<u8", n_docs, 16 + 8 * n_blocks + 8 * n_docs).astype(np.int64)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last, last excluded."""
        if first >= last:
            return np.zeros(0, np.uint32)
        begin, end = int(self.starts[first]), int(self.starts[last]) if last < len(self.starts) else self.end
        return unpack_blocks(self.file.read_at(end - begin, begin), [int(s) - begin for s in self.starts[first:last]])

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of the documents in turn."""
        held, block = np.zeros(0, np.uint32), 0
        for k, n in enumerate(self.lengths):
            while len(held) < n:
                held = np.concatenate([held, self.blocks(block, min(block + 256, len(self.starts)))])
                block += 256
            yield k, held[:n]
            held = held[n:]


WRITTEN = "file string, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
NULL_ID = -(1 << 63)


def write_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Writes the ids of all texts in ascending doc_id order, one file for each range; (file, n_docs, n_tokens) of the files.

    Null texts are empty; null ids come first and are read back as null; rows of equal id are ordered by a hash of their text.
    A task that runs again writes the same file anew.
    """
    folder = folder or shared_dir(docs.sparkSession, "tokens")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, writer = Encoder.of(tokenizer_path, end_id), None
        uri = f"{folder}/part-{TaskContext.get().partitionId():06d}.pfor"
        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"].to_numpy(np.int64)
            for lo, hi in batches_of_texts(texts):
                writer = writer or Writer(uri)
                writer.add(doc_ids[lo:hi], *encoder.encode(texts[lo:hi]))
        if writer:
            yield pd.DataFrame([(uri, *writer.close())], columns=["file", "n_docs", "n_tokens"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // FILE_BYTES + 1)
    # the last one tells equal rows apart, so that no range has to hold all of them
    order = ["doc_id", "digest", "row"]
    ordered = rows.withColumns({"digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()}).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(ordered.select("doc_id", "text").mapInPandas(write, WRITTEN), "token-files")


def read_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in files; start counts over all files by name."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, at in zip(batch["file"], batch["before"]):
                reader = Reader(uri)
                crc = np.fromiter((zlib.crc32(np.ascontiguousarray(ids, "<u4")) for _, ids in reader.documents()), np.int64, len(reader.lengths))
                ids = pd.array(reader.doc_ids, "Int64")
                ids[reader.doc_ids == NULL_ID] = pd.NA
                yield pd.DataFrame({"doc_id": ids, "start": at + np.cumsum(reader.lengths) - reader.lengths, "n_tokens": reader.lengths, "ids_crc32": crc})

    return files.select("file", before.alias("before")).repartition(max(1, files.count())).mapInPandas(read, READ)
