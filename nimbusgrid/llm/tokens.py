"""Token-ID / binary output: one wavelet matrix per shard.

A shard holds the token ids of consecutive documents.  Its file is

    magic | header length | header (JSON) | document table | one block per bit-plane

where the document table has (doc_id, tokens) per document and plane ``k`` has the bits of weight
``2 ** (planes - 1 - k)`` after the stable partitions by the planes above it.  Each block is
compressed by itself and carries a rank directory: ones before every 512 bits.  ``WaveletMatrix``
answers access, rank, count and select from one file; ``ids`` gives the whole sequence back by
undoing the partitions from the lowest plane upwards.

Files travel as rows (shard, file) of a table in the shared folder, so Spark's commit protocol
makes a shard of a lost executor appear once, and readers need no local path.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nimbusgrid.llm.common import WORKER_STATES, keep, map_arrow, table
from nimbusgrid.llm.registry import query

MAGIC = b"WVM1"
END_ID = 1
SHARD_TOKENS = 1 << 20
_STEP = 64  # bytes between two entries of a rank directory
_CACHE_WORDS = 400_000
_GATHER = 1 << 18  # words whose ids are gathered at once
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint16)
_STATE: dict = WORKER_STATES.setdefault("tokens", {})


#: Words the short way covers: lower-case letters up to U+00FF, digits and ASCII marks.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> dict[int, str]:
    """The vocabulary writes a byte as the character of that code, or, where that is a blank or a
    control, as the next free one from 256 upwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by the tokenizers library, word by word with a bounded cache.

    The vocabulary's patterns never span a blank, so the ids of a text are those of its
    blank-separated words put together, and a word is encoded once per cache.  A word of plain
    characters goes straight to the library's model, piece by piece; any other, and any that may
    hold a special token, through the library's whole pipeline.
    """

    # Fixed pattern of the vocabulary, for plain lower-case words.
    _PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[!-/:-@\\[-`{-~]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self._tokenizer.to_str())
        self._short = "</w>" == settings["model"].get("end_of_word_suffix") and [
            n["type"] for n in (settings.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self._tokenize = self._tokenizer.model.tokenize
        self._letters = {b: c for b, c in _byte_letters().items()}
        top = max(self._tokenizer.get_vocab().values())
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self._code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self._cache: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece, which are those of the word that is written like it."""
        found = self._cache.get(piece)
        if found is None:
            shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._letters)
            found = self._cache[piece] = array(self._code, [t.id for t in self._tokenize(shown)]).tobytes()
        return found

    def _word(self, word: str) -> bytes:
        lower = word.lower()
        if lower.isalpha():
            return self._piece(lower)
        if lower[-1] in ".," and lower[:-1].isalpha():
            return self._piece(lower[:-1]) + self._piece(lower[-1])
        return b"".join(map(self._piece, self._PIECES.findall(lower)))

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        cache, plain, other, out = self._cache, _PLAIN.fullmatch, [], []
        if len(cache) > _CACHE_WORDS:
            cache.clear()
        for i, word in enumerate(words):
            known = cache.get(word)
            if known is None:
                if self._short and plain(word) and "<|" not in word:
                    known = self._word(word)
                else:
                    other.append(i)
            out.append(known)
        for i, encoded in zip(other, self._tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False)):
            out[i] = cache[words[i]] = np.array(encoded.ids, dtype=self.dtype).tobytes()
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts put together, how many are each text's); null texts are empty.

        The words of all texts are told apart once; a text's ids are gathered from those of its words.
        """
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        which, encoded = coded.indices.to_numpy(), self._words(coded.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(encoded), dtype=self.dtype)
        size = np.fromiter(map(len, encoded), np.int64, len(encoded)) // self.dtype.itemsize
        first, many = np.cumsum(size) - size, size[which]
        parts = [np.zeros(0, self.dtype)]
        for at in range(0, len(which), _GATHER):
            n, start = many[at:at + _GATHER], first[which[at:at + _GATHER]]
            parts.append(ids[np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)])
        offsets = words.offsets.to_numpy()[:-1]
        return np.concatenate(parts), np.add.reduceat(many, offsets) if len(offsets) else many

    def __call__(self, text: str) -> np.ndarray:
        return self.batch(pa.array([text], pa.string()))[0]


def _encoder(path: str) -> Encoder:
    if path not in _STATE:
        _STATE[path] = Encoder(path)
    return _STATE[path]


def _ones(packed: np.ndarray) -> np.ndarray:
    """Set bits in every ``_STEP`` bytes, counted eight bytes at a time."""
    blocks = -(-len(packed) // _STEP)
    padded = np.zeros(blocks * _STEP, np.uint8)
    padded[:len(packed)] = packed
    return np.bitwise_count(padded.view(np.uint64)).reshape(blocks, _STEP // 8).sum(axis=1, dtype=np.uint32)


def pack(ids: np.ndarray, documents: np.ndarray) -> bytes:
    """The file of a shard.  ``documents``: int64 rows (doc_id, 1 if the id is null, tokens)."""
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    current, blocks, zeros = ids, [], []
    for k in range(planes):
        ones = (current & ids.dtype.type(1 << (planes - 1 - k))) != 0
        packed = np.packbits(ones)
        counts = _ones(packed)
        directory = np.concatenate([[0], np.cumsum(counts)]).astype("<u4")
        blocks.append(zstandard.compress(directory.tobytes() + packed.tobytes(), 1))
        low = len(ones) - int(counts.sum())
        zeros.append(low)
        if k < planes - 1:
            following = np.empty_like(current)
            np.compress(~ones, current, out=following[:low])
            np.compress(ones, current, out=following[low:])
            current = following
    head = zstandard.compress(documents.astype("<i8").tobytes(), 1)
    header = json.dumps({"n": len(ids), "documents": len(documents), "zeros": zeros,
                         "blocks": [len(b) for b in blocks], "table": len(head)}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, head, *blocks])


class WaveletMatrix:
    """Token access, counting and occurrence lookup from one shard's file."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard file")
        size = struct.unpack_from("<I", data, 4)[0]
        header = json.loads(data[8:8 + size])
        self.n, self.zeros, at = header["n"], header["zeros"], 8 + size
        self.documents = np.frombuffer(zstandard.decompress(data[at:at + header["table"]]), "<i8").reshape(-1, 3)
        at += header["table"]
        self._planes, entries = [], 4 * (-(-(-(-self.n // 8)) // _STEP) + 1)
        for length in header["blocks"]:
            raw = zstandard.decompress(data[at:at + length])
            at += length
            self._planes.append((np.frombuffer(raw, "<u4", entries // 4), np.frombuffer(raw, np.uint8, offset=entries)))

    def _rank1(self, plane: int, i: int) -> int:
        directory, bits = self._planes[plane]
        block, byte = i // (8 * _STEP), i // 8
        ones = int(directory[block]) + int(_POPCOUNT[bits[block * _STEP:byte]].sum())
        return ones + (int(_POPCOUNT[bits[byte] >> (8 - i % 8)]) if i % 8 else 0)

    def _bit(self, plane: int, i: int) -> int:
        return int(self._planes[plane][1][i // 8]) >> (7 - i % 8) & 1

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, zeros in enumerate(self.zeros):
            bit, ones = self._bit(k, i), self._rank1(k, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` stands before position ``i``."""
        low, high = self._range(token, i)
        return high - low

    def _range(self, token: int, i: int) -> tuple[int, int]:
        planes = len(self.zeros)
        if token < 0 or token >> planes:
            return 0, 0
        low, high = 0, min(i, self.n)
        for k, zeros in enumerate(self.zeros):
            a, b = self._rank1(k, low), self._rank1(k, high)
            low, high = (zeros + a, zeros + b) if token >> (planes - 1 - k) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """The position of the ``j``-th ``token``, from 0; -1 if there are not as many."""
        low, high = self._range(token, self.n)
        if not 0 <= j < high - low:
            return -1
        i = low + j
        for k in range(len(self.zeros) - 1, -1, -1):
            bit = i >= self.zeros[k]
            i = self._select_bit(k, i - self.zeros[k] if bit else i, int(bit))
        return i

    def _select_bit(self, plane: int, j: int, bit: int) -> int:
        directory, bits = self._planes[plane]
        ones = directory.astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * 8 * _STEP - ones
        block = int(np.searchsorted(before[:-1], j, side="right")) - 1
        inside = np.unpackbits(bits[block * _STEP:(block + 1) * _STEP]) == bit
        return block * 8 * _STEP + int(np.flatnonzero(inside)[j - int(before[block])])

    def ids(self) -> np.ndarray:
        """The whole sequence."""
        planes = len(self.zeros)
        kind = np.uint16 if planes <= 16 else np.uint32
        values = np.zeros(self.n, dtype=kind)
        for k in range(planes - 1, -1, -1):
            ones = np.unpackbits(self._planes[k][1], count=self.n).view(bool)
            merged = np.empty_like(values)
            merged[~ones] = values[:self.zeros[k]]
            merged[ones] = values[self.zeros[k]:] | kind(1 << (planes - 1 - k))
            values = merged
        return values


_FILES = "part int, seq int, tokens long, file binary"


def _shards(batches: Iterator[pa.RecordBatch], path: str, end_id: int, shard_tokens: int):
    from pyspark import TaskContext
    encode, part, seq = _encoder(path), TaskContext.get().partitionId(), 0
    pieces, documents, held = [], [], 0
    end = np.array([end_id], dtype=encode.dtype)

    def flush():
        ids = np.concatenate(pieces)
        file = pack(ids, np.array(documents, dtype=np.int64).reshape(-1, 3))
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
             pa.array([file], pa.binary())], ["part", "seq", "tokens", "file"])

    for batch in batches:
        flat, counts = encode.batch(batch.column(1))
        ends = np.cumsum(counts)
        for doc, start, stop in zip(batch.column(0).to_pylist(), ends - counts, ends):
            ids = flat[start:stop]
            pieces += [ids, end]
            documents.append((doc or 0, doc is None, len(ids) + 1))
            held += len(ids) + 1
            if held >= shard_tokens:
                yield flush()
                seq, pieces, documents, held = seq + 1, [], [], 0
    if documents:
        yield flush()


def write_shards(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(part, seq, tokens, file): the shard files of all documents, ascending by id.

    One range shuffle of the texts; a document is never split, and a shard is closed by the
    document that fills it, so a task holds one shard.  A null text is empty (its end id only).
    Null ids come first; rows that repeat an id are each encoded, next to one another.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
               .repartitionByRange(parts, F.col("id").asc_nulls_first())
               .sortWithinPartitions(F.col("id").asc_nulls_first()))
    return map_arrow(ordered, lambda b: _shards(b, tokenizer, end_id, shard_tokens), _FILES, state="tokens")


def _documents(batches: Iterator[pa.RecordBatch]):
    _STATE.clear()  # a worker that wrote shards before needs no words for reading them
    for batch in batches:
        for part, seq, file in zip(batch.column("part").to_pylist(), batch.column("seq").to_pylist(), batch.column("file")):
            matrix = WaveletMatrix(file.as_py())
            ids = matrix.ids().astype("<u4")
            doc, null, n = matrix.documents.T
            ends = np.cumsum(n)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * int(e - k):4 * int(e)]) for e, k in zip(ends, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, np.int32)), pa.array(np.full(len(n), seq, np.int32)),
                 pa.array(np.asarray(doc), mask=np.asarray(null, bool)), pa.array(ends - n), pa.array(np.asarray(n)),
                 pa.array(crc, pa.int64())], ["part", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"])


def read_documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard) of every document, from the files alone.

    The running start of a shard needs the token counts of the shards before it: one number per
    shard, over a window of as many rows as there are files.
    """
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "seq", "tokens").select(
        "part", "seq", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("shard_start"))
    documents = map_arrow(files.select("part", "seq", "file"), _documents,
                          "part int, seq int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return documents.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
        F.concat_ws("-", "part", "seq").alias("shard"))


def token_output(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the shards of ``docs`` to the shared folder and describe each document from them."""
    files, _ = keep(write_shards(docs, tokenizer, **options), "shards")
    return read_documents(files)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op6_token_output(spark: SparkSession, sf: str) -> DataFrame:
    return token_output(table(spark, sf, "documents", "doc_id", "text"), default_tokenizer())
