"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.llm.common import small_batches, table, text_or_empty

MARK = "▁"  # stands for a space
UNKNOWN_PENALTY = 10.0
CACHE = 200_000  # segments a worker remembers
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_CELLS = 1_000_000  # of one Viterbi table
_WINDOW = 2048  # cells looked at together when a state is placed


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: number, and integer or bytes."""
    at = 0

    def integer() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = integer()
        kind = key & 7
        if kind == 0:
            yield key >> 3, integer()
            continue
        size = {1: 8, 5: 4}.get(kind) or integer()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Pieces:
    """A model file: pieces with their log scores and kinds, and how text is prepared."""

    texts: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    dummy_prefix: bool = True

    @classmethod
    def read(cls, path: str) -> Pieces:
        own = cls()
        with open(path, "rb") as file:
            model = file.read()
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                own.texts.append(piece[1].decode())
                own.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                own.kinds.append(piece.get(3, _NORMAL))
            elif number == 3:
                rules = dict(_fields(value))
                own.dummy_prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("only models without text normalisation are supported")
        if any(MARK in t.lstrip(MARK) for t, k in zip(own.texts, own.kinds) if k == _NORMAL):
            raise ValueError("only models whose pieces hold no space inside are supported")
        return own


class Trie:
    """Double array over the pieces' bytes.

    The child of state ``s`` by byte ``c`` is ``base[s] + c + 1``, if that cell's
    ``check`` is ``s``; ``piece`` has the id of the piece that ends in a state.
    """

    def __init__(self, pieces: Pieces) -> None:
        root: dict = {}
        for number, (text, kind) in enumerate(zip(pieces.texts, pieces.kinds, strict=True)):
            if kind in (_NORMAL, _USER):
                node = root
                for byte in text.encode():
                    node = node.setdefault(byte + 1, {})
                node[0] = number
        base, check = np.zeros(1, np.int32), np.full(1, -1, np.int32)
        piece = np.full(1, -1, np.int32)
        check[0], lowest = 0, 1
        todo = [(0, root)]
        for state, node in todo:
            if 0 in node:
                piece[state] = node[0]
            codes = np.array(sorted(c for c in node if c), np.int64)
            if not len(codes):
                continue
            at, fits = lowest, ()
            while not len(fits):
                if at + _WINDOW + 512 > len(check):
                    more = np.full(len(check) + 2 * _WINDOW, -1, np.int32)
                    base = np.r_[base, np.zeros(len(more), np.int32)]
                    check, piece = np.r_[check, more], np.r_[piece, more]
                starts = np.flatnonzero(check[at : at + _WINDOW] < 0) + at - codes[0]
                starts = starts[starts >= 0]
                fits = starts[(check[starts[:, None] + codes] < 0).all(axis=1)]
                at += _WINDOW
            base[state] = fits[0]
            check[fits[0] + codes] = state
            todo.extend((int(fits[0] + c), node[int(c)]) for c in codes)
            while check[lowest] >= 0:
                lowest += 1
        # A step never leaves the arrays.
        pad = np.full(512, -1, np.int32)
        self.base, self.check, self.piece = (np.r_[a, pad] for a in (base, check, piece))
        self.base[len(base):] = 0


@dataclass
class Codec:
    """What the workers need, of a size bounded by the vocabulary."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    scores: np.ndarray
    unknown_score: float
    unknown: int
    byte_ids: np.ndarray  # id of each byte, -1 without fallback
    letters: str  # all characters of pieces
    out: np.ndarray  # bytes of all pieces, decoded
    out_at: np.ndarray
    dummy_prefix: bool

    @classmethod
    def of(cls, pieces: Pieces) -> Codec:
        trie = Trie(pieces)
        own = [k in (_NORMAL, _USER) for k in pieces.kinds]
        normal = [s for s, k in zip(pieces.scores, pieces.kinds, strict=True) if k == _NORMAL]
        byte_ids, decoded = np.full(256, -1, np.int32), []
        for number, (text, kind) in enumerate(zip(pieces.texts, pieces.kinds, strict=True)):
            if kind == _BYTE:
                byte_ids[int(text[3:5], 16)] = number
                decoded.append(bytes([int(text[3:5], 16)]))
            elif kind == _UNKNOWN:
                decoded.append(" ⁇ ".encode())
            else:
                decoded.append(b"" if kind == _CONTROL else text.replace(MARK, " ").encode())
        return cls(
            trie.base, trie.check, trie.piece, np.array(pieces.scores, np.float64),
            min(normal) - UNKNOWN_PENALTY, pieces.kinds.index(_UNKNOWN), byte_ids,
            "".join(sorted({c for t, o in zip(pieces.texts, own, strict=True) if o for c in t})),
            np.frombuffer(b"".join(decoded), np.uint8),
            np.cumsum([0, *map(len, decoded)]), pieces.dummy_prefix,
        )

    def segments(self, text: str) -> list[str]:
        """Cuts where no piece can reach across.

        That is before each run of spaces and around each character that no
        piece holds, so the best paths of the cuts join to the best path.
        """
        if not hasattr(self, "_cut"):
            inner = "".join(re.escape(c) for c in self.letters if c != MARK)
            self._cut = re.compile(f"{MARK}*[{inner}]+|{MARK}+|.", re.DOTALL)
        text = text.replace(" ", MARK)
        return self._cut.findall(MARK + text if self.dummy_prefix and text else text)

    def viterbi(self, segments: list[bytes]) -> list[np.ndarray]:
        """Best path of each segment, all walked through the trie together.

        Of equal scores the longest last piece wins. A character without a
        piece of its own scores below all pieces and becomes its bytes.
        """
        sizes = np.array([len(s) for s in segments])
        rows, width = len(segments), int(sizes.max())
        grid = np.zeros((rows, width + 4), np.int64)
        grid[np.arange(width + 4) < sizes[:, None]] = np.frombuffer(b"".join(segments), np.uint8) + 1
        best = np.full((rows, width + 4), -np.inf)
        best[:, 0] = 0
        used = np.full((rows, width + 4), -1, np.int32)
        back = np.zeros((rows, width + 4), np.int32)
        for start in range(width):
            at = np.flatnonzero((best[:, start] > -np.inf) & (sizes > start))
            if not len(at):
                continue
            lead = grid[at, start] - 1
            chars = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
            score, whole = best[at, start], np.zeros(len(at), bool)
            live, state, depth = np.arange(len(at)), np.zeros(len(at), np.int64), 0
            while len(live):
                code = grid[at[live], start + depth] if start + depth < width else 0 * live
                step = self.base[state] + code
                on = (code > 0) & (self.check[step] == state) & (step > 0)
                live, state, depth = live[on], step[on], depth + 1
                ends = self.piece[state]
                hit = live[ends >= 0]
                if len(hit):
                    ids = ends[ends >= 0]
                    whole[hit] |= chars[hit] == depth
                    self._better(best, used, back, at[hit], start, depth, score[hit] + self.scores[ids], ids)
            lone = np.flatnonzero(~whole)
            for size in (1, 2, 3, 4):
                own = lone[chars[lone] == size]
                self._better(
                    best, used, back, at[own], start, size, score[own] + self.unknown_score,
                    np.full(len(own), self.unknown, np.int32),
                )
        return [self._path(used[i], back[i], int(sizes[i]), s) for i, s in enumerate(segments)]

    @staticmethod
    def _better(best, used, back, rows, start, size, score, ids) -> None:
        better = score > best[rows, start + size]
        rows = rows[better]
        best[rows, start + size] = score[better]
        used[rows, start + size] = ids[better]
        back[rows, start + size] = start

    def _path(self, used: np.ndarray, back: np.ndarray, end: int, segment: bytes) -> np.ndarray:
        ids: list[int] = []
        while end:
            start = int(back[end])
            if used[end] == self.unknown and self.byte_ids.min() >= 0:
                ids.extend(int(self.byte_ids[b]) for b in reversed(segment[start:end]))
            else:
                ids.append(int(used[end]))
            end = start
        return np.array(ids[::-1], np.int32)

    def encode(self, texts: list[str], seen: dict[str, bytes]) -> list[np.ndarray]:
        cut = [self.segments(t) for t in texts]
        new = sorted({s for own in cut for s in own if s not in seen}, key=len)
        at = 0
        while at < len(new):
            count = max(1, min(20_000, _CELLS // (len(new[at].encode()) + 4)))
            block = [s.encode() for s in new[at : at + count]]
            while len(block) > 1 and len(block) * len(max(block, key=len)) > 2 * _CELLS:
                block = block[: len(block) // 2]
            for name, ids in zip(new[at : at + len(block)], self.viterbi(block), strict=True):
                seen[name] = ids.tobytes()
            at += len(block)
        found = [np.frombuffer(b"".join([seen[s] for s in own]), np.int32) for own in cut]
        if len(seen) > CACHE:
            seen.clear()
        return found

    def decode(self, ids: np.ndarray) -> str:
        starts, sizes = self.out_at[ids], self.out_at[ids + 1] - self.out_at[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        text = self.out[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]
        text = text.tobytes().decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _tables(model: str) -> dict[str, object]:
    return vars(Codec.of(Pieces.read(model)))


def _shared(spark: SparkSession, model: str) -> Broadcast:
    return spark.sparkContext.broadcast(_tables(model))


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, n_tokens, n_byte_tokens, text_sha256``, a row per row of ``docs``.

    The path of pieces with the greatest sum of log scores. Spaces become
    marks, one more is put before a text; a character without a piece becomes
    its UTF-8 bytes. A null or empty text has no ids. Repeated rows are encoded
    alike; an empty table gives an empty result. Reads ``doc_id`` and ``text``.

    No shuffle: each row by itself, in batches of bounded size. What is
    broadcast is as large as the vocabulary; a worker remembers at most
    200,000 segments, which changes nothing but time.
    """
    small_batches(docs.sparkSession)
    shared = _shared(docs.sparkSession, model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, seen = Codec(**shared.value), {}
        byte_token = np.zeros(len(codec.out_at) - 1, bool)
        byte_token[codec.byte_ids[codec.byte_ids >= 0]] = True
        for batch in batches:
            found = codec.encode(batch.column(1).to_pylist(), seen)
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([*found, np.zeros(0, np.int32)])
            by_byte = [int(byte_token[ids].sum()) for ids in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array(by_byte, pa.int64()), batch.column(2),
                ],
                ["doc_id", "ids", "n_tokens", "n_byte_tokens", "text_sha256"],
            )

    text = text_or_empty()
    schema = T.StructType([docs.schema["doc_id"]]).add("ids", T.ArrayType(T.IntegerType()))
    schema = schema.add("n_tokens", "long").add("n_byte_tokens", "long").add("text_sha256", "string")
    return docs.select(
        "doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("sha")
    ).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` with the text of its ``ids`` as ``decoded``.

    Bytes that are no UTF-8 become U+FFFD, marks become spaces, the one before
    the text goes. Null ids are an empty text.
    """
    small_batches(encoded.sparkSession)
    shared = _shared(encoded.sparkSession, model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(**shared.value)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            texts = [
                codec.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else ""
                for x in lists
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields]).add("decoded", "string"))


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Ids of each text, and whether decoding them gives the very text.

    It does unless the text holds the mark itself, which decodes to a space.
    """
    back = F.sha2(F.col("decoded").cast("binary"), 256)
    return decode(encode(docs, model), model).select(
        "doc_id", "n_tokens", "n_byte_tokens", "ids", back.alias("decoded_sha256"),
        (back == F.col("text_sha256")).alias("round_trip"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
