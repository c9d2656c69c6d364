"""Best-fit packing of tokenized documents by sums of squares.

A document becomes its token ids and an end id.  Only longer ones are cut, into pieces of ``size`` tokens.  Pieces
are dealt to groups of about ``GROUP`` pieces; a group places its pieces, longest first, into the open bin after
which the sum over all residual gaps of (number of open bins with that gap) squared is smallest; a new bin is opened
if no open bin has room.  The pieces of bins that stay open by more than ``LOOSE`` tokens are dealt and placed once
more.  A group keeps ``size`` counters and its pieces' lengths, whatever the number of documents.

Defined cases: a null or empty text is the end id alone; every row is packed, repeated ones too; a null id stays
null; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.words import remember

TOKENIZER = "word_bpe_49k.json"
SIZE, GROUP, LOOSE = 2048, 16_000, 16
CACHE_WORDS = 300_000  #: words whose ids a worker remembers, and as many that it has not met since
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
# The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the others from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class WordIds(dict):
    """The ids of a word as little-endian unsigned 32-bit bytes, found when first asked for.

    The tokenizer drops blanks and its patterns never reach across them, so a text's ids are its words' ids.
    """

    def __init__(self, file: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        if word in self.older:
            self[word] = self.older[word]
            return self[word]
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if not plain:
            ids = _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        elif plain[2]:  # letters and marks are separate pieces
            ids = self[plain[1].encode()] + self[plain[2].encode()]
        elif text != (lower := text.lower()):
            ids = self[lower.encode()]
        else:  # lower-case letters of Latin-1 are one piece that normalising leaves as it is
            ids = _bytes([t.id for t in self.tokenizer.model.tokenize(text if word.isascii() else word.decode("latin-1").translate(_BYTE_LETTERS))])
        self[word] = ids
        return ids


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


_word_ids: dict[str, WordIds] = {}


def word_ids(file: str) -> WordIds:
    if file not in _word_ids:
        _word_ids[file] = WordIds(file)
    return _word_ids[file]


def cut_pieces(tokenizer: str, size: int, end_id: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        remember("packing", _word_ids.clear)
        ids_of = word_ids(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
        end = _bytes([end_id])
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("_text").cast(pa.binary()).to_pylist(), strict=True):
                ids = b"".join(map(ids_of.__getitem__, (text or b"").split())) + end
                for i, at in enumerate(range(0, len(ids), 4 * size)):
                    piece = ids[at : at + 4 * size]
                    for column, x in zip(out, (doc, i, at // 4, len(piece) // 4, zlib.crc32(piece), piece), strict=True):
                        column.append(x)
            columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:5])]
            if with_ids:
                columns.append(pa.array(out[5], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return run


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the gap that each bin is left with."""
    n = np.zeros(size + 1, np.int64)  # open bins by gap
    bins: list[list[int]] = [[] for _ in range(size + 1)]
    at, offset, gaps = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        # of a bin with gap g: one bin less there, and one more at g - s unless it is full then
        more = 2 * n[: size - s] + 1
        more[:1] = 0
        change = np.where(n[s:size] > 0, more - 2 * n[s:size] + 1, np.iinfo(np.int64).max)
        k = int(change.argmin()) if len(change) else 0
        if len(change) and n[s + k]:
            g = s + k
            b = bins[g].pop()
            n[g] -= 1
        else:
            g, b = size, len(gaps)
            gaps.append(size)
        at[i], offset[i] = b, size - g
        gaps[b] = g - s
        if g > s:
            n[g - s] += 1
            bins[g - s].append(b)
    return at, offset, np.array(gaps, np.int64)


def _placing(size: int, base: int) -> Callable:
    def run(t: pa.Table) -> pa.Table:
        bin_of, offset, gaps = place(t.column("length").to_numpy(), size)
        first = base + t.column("_group")[0].as_py() * 2**31
        t = t.append_column("sequence_id", pa.array(bin_of + first)).append_column("offset", pa.array(offset))
        return t.append_column("_open", pa.array(gaps[bin_of] > LOOSE))

    return run


def _placed(pieces: DataFrame, size: int, base: int, n: int) -> DataFrame:
    groups = max(1, -(-n // GROUP))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", sequence_id long, offset long, _open boolean"
    return dealt.groupBy("_group").applyInArrow(_placing(size, base), schema).drop("_group")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, size: int = SIZE, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, with ``ids`` if asked for.

    ``tokenizer`` is a file of the public tokenizers or a path.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    pieces = cut(texts.mapInArrow(cut_pieces(tokenizer, size, end_id, with_ids), PIECE + ", ids binary" * with_ids))
    once = cut(_placed(pieces, size, 0, pieces.count()))
    loose = once.where("_open").drop("sequence_id", "offset", "_open")
    again = _placed(loose, size, 2**62, loose.count())
    return once.where("not _open").unionByName(again).drop("_open")
