"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

A text's blanks become marks, one more is put in front, and it is cut before every run of marks: no piece goes
across.  The distinct marked words that a worker has not met are sorted, which is the depth-first order of their
trie, and walked with one stack: the forward pass of a word begins where its common prefix with the word before
ends, so every trie node is computed once.

* Unigram models: a node keeps the best score of its prefix and the piece that reaches it.
* Merge-trained models (the public file): a path is allowed if each pair of neighbouring pieces is what the merges
  make of their joined text; exactly one path to each node is, so the best path is the merge result itself, the ids
  that the model's own library gives.  Adding up such a model's scores (merge ranks) would give other ids.

Characters without a piece become byte pieces, or the unknown id if the model has none.  Decoding joins the pieces'
bytes.  It gives the text back, but for a literal mark (U+2581), which the model cannot tell from a blank, and for
characters that became unknown ids.

Defined cases: a null or empty text has no ids; every row is returned; extra columns are ignored; models whose
pieces go across marks, that have user-defined pieces or that normalise the text are refused.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CACHE_WORDS, CACHE_PAIRS = 450_000, 400_000
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Model:
    def __init__(self, proto: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(proto)
        kinds = pb.ModelProto.SentencePiece
        plain = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (kinds.NORMAL, kinds.UNUSED)}
        if any(p.type == kinds.USER_DEFINED for p in m.pieces) or any(MARK in p.lstrip(MARK) for p in plain) or m.normalizer_spec.precompiled_charsmap or m.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("this model normalises texts or has pieces that go across marks")
        self.ids, self.pieces, self.scores = plain, [p.piece for p in m.pieces], [p.score for p in m.pieces]
        self.size = [len(p.piece) for p in m.pieces] + [1]  # the last one is for a character without a piece, -1
        self.tails: dict = {}  # a trie of the pieces from their ends; "" leads to the piece
        for p, i in plain.items():
            node = self.tails
            for character in reversed(p):
                node = node.setdefault(character, {})
            node[""] = i
        self.unigram = m.trainer_spec.model_type == m.trainer_spec.UNIGRAM
        self.prefix = MARK if m.normalizer_spec.add_dummy_prefix else ""
        self.byte_ids = [i for i, p in enumerate(m.pieces) if p.type == kinds.BYTE]
        self.unknown = next((i for i, p in enumerate(m.pieces) if p.type == kinds.UNKNOWN), 0)
        self.lost = min((m.pieces[i].score for i in plain.values()), default=0.0) - 10  # the score of a character without a piece
        self.bytes_of = [p.piece.replace(MARK, " ").encode() if p.type in (kinds.NORMAL, kinds.UNUSED) else b"" for p in m.pieces]
        for value, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([value])
        m.normalizer_spec.add_dummy_prefix = False
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
        self.pairs: dict[int, bool] = {}  # by left << 32 | right
        self.packed = {p: np.array([i], "<u4").tobytes() for p, i in plain.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what the worker knew before, until it is met again

    def _stable(self, left: int, right: int) -> bool:
        """Whether the merges of both pieces' joined characters end in just these two; left is negative where none
        is or the character before has no piece, which no merge reaches across."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        want = [self.pieces[left], self.pieces[right]] if left >= 0 else [self.pieces[right]]
        got = self.merges.encode("".join(want), out_type=str) == want
        self.pairs[left << 32 | right] = got
        return got

    def _ending(self, word: str, end: int) -> list[int]:
        """The pieces that end at a place of a word, shortest first."""
        node, found = self.tails, []
        for i in range(end - 1, -1, -1):
            node = node.get(word[i])
            if node is None:
                break
            if "" in node:
                found.append(node[""])
        return found

    def _merged(self, word: str, start: int, last: list[int]) -> None:
        """Appends the last piece of the merge result of each prefix of ``word`` longer than ``start``."""
        tails, size, pairs = self.tails, self.size, self.pairs
        for end in range(start + 1, len(word) + 1):
            node, found = tails, []
            for i in range(end - 1, -1, -1):  # as in _ending
                node = node.get(word[i])
                if node is None:
                    break
                if "" in node:
                    found.append(node[""])
            while found:
                piece = found.pop()
                before = last[end - size[piece]]
                stable = pairs.get(before << 32 | piece)
                if stable or stable is None and self._stable(before, piece):
                    last.append(piece)
                    break
            else:
                last.append(-1)

    def _best(self, word: str, start: int, last: list[int], best: list[float]) -> None:
        """Appends the best score and last piece of each prefix of ``word`` longer than ``start``."""
        for end in range(start + 1, len(word) + 1):
            pieces = self._ending(word, end)
            options = [(best[end - self.size[p]] + self.scores[p], p) for p in pieces]
            if not pieces or self.size[pieces[0]] > 1:
                options.append((best[end - 1] + self.lost, -1))
            top = max(options)
            best.append(top[0])
            last.append(top[1])

    def walk(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Each word of a sorted list with its pieces; a prefix shared with the word before is not computed again."""
        last, best, before = [-1], [0.0], ""
        for word in words:
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], best[shared + 1 :]
            if self.unigram:
                self._best(word, shared, last, best)
            else:
                self._merged(word, shared, last)
            pieces, end = [], len(word)
            while end:
                pieces.append(word[end - self.size[last[end]] : end])
                end -= len(pieces[-1])
            yield word, pieces[::-1]
            before = word

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        marked = [_WORD.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        met = set().union(*marked)
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        new = met.difference(self.known)
        self.known.update((w, self.older[w]) for w in new if w in self.older)
        for word, pieces in self.walk(sorted(new.difference(self.known))):
            self.known[word] = b"".join([self.packed.get(p) or self._spelled(p) for p in pieces])
        return [b"".join(map(self.known.__getitem__, ws)) for ws in marked]

    def _spelled(self, character: str) -> bytes:
        """The ids of a character without a piece."""
        ids = [self.byte_ids[x] for x in character.encode()] if len(self.byte_ids) == 256 else [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return (text[1:] if self.prefix and text[:1] == b" " else text).decode("utf-8", "replace")


_models: dict[str, Model] = {}


def model(file: str) -> Model:
    if file not in _models:
        if "/" not in file:
            import public_tokenizers

            path = public_tokenizers.path(file)
        else:
            path = file
        with open(path, "rb") as f:
            _models[file] = Model(f.read())
    return _models[file]


def _encode(file: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.remember("pieces", _models.clear)
        m = model(file)
        for b in (c for big in batches for c in W.chunks(big, max_bytes=4_000_000)):
            ids = m.encode(b.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_text"), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(zlib.crc32, ids), pa.int64())], names=["doc_id", "text", "ids", "n_ids", "ids_crc32"])

    return run


def _decode(file: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(file)
        for b in batches:
            texts = pa.array([m.decode(x or b"") for x in b.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "text", "n_ids", "ids_crc32")), texts], names=["doc_id", "text", "n_ids", "ids_crc32", "decoded"])

    return run


def _both(file: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W.remember("pieces", _models.clear)
        m = model(file)
        for b in (c for big in batches for c in W.chunks(big, max_bytes=4_000_000)):
            ids = m.encode(b.column("_text").to_pylist())
            columns = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(zlib.crc32, ids), pa.int64()), pa.array(map(m.decode, ids), pa.string())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=["doc_id", "n_ids", "ids_crc32", "decoded"])

    return run


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", file: str = MODEL) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, decoded`` of every row: ``encode`` and ``decode`` in one pass, ids not sent."""
    return _rows(docs, id_col, text_col).mapInArrow(_both(file), "doc_id long, n_ids long, ids_crc32 long, decoded string")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", file: str = MODEL) -> DataFrame:
    """``doc_id, text, ids, n_ids, ids_crc32`` of every row; ``ids`` are little-endian unsigned 32-bit bytes.

    ``file`` is one of the public tokenizers' models or a path that executors can open.
    """
    return _rows(docs, id_col, text_col).mapInArrow(_encode(file), "doc_id long, text string, ids binary, n_ids long, ids_crc32 long")


def decode(encoded: DataFrame, file: str = MODEL) -> DataFrame:
    """The rows of ``encode`` with ``decoded`` in place of ``ids``."""
    return encoded.mapInArrow(_decode(file), "doc_id long, text string, n_ids long, ids_crc32 long, decoded string")
