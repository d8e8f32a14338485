"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces and
a single-pass Viterbi.

The vocabulary file is given, never trained.  A space before the text and every space
stand for the file's space mark.  The automaton reports, at each character, all
pieces that end there (its output links, longest first); each relaxes the best score
of that position, the score of its start plus its own.  A character that is no piece
costs 10 less than the lowest piece score and becomes its UTF-8 bytes.

No piece has a space mark after another character, so the best path always breaks
there: a text is encoded part by part (a run of spaces and the word after it), and
parts met lately are remembered.  Decoding joins the pieces' bytes and drops the
space put in front, so it gives back every text exactly; a literal space mark
character in a text is encoded as its bytes, apart from a space.

Defined cases: a null text has null ids and decodes to null; an empty text has no
ids; lone surrogates cannot occur in Spark strings; repeated rows are encoded alike;
an empty table gives an empty result; other columns are kept by ``encode``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytally.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # the file's space mark
REMEMBERED = 500_000  # parts remembered by a worker
SHORT = 48  # longer parts hardly come again
ROWS = 500  # rows that a worker encodes before it hands them on
_PARTS = re.compile(" *[^ ]+| +")


class Remembered(dict):
    """Part -> its ids as bytes, encoded when first met; the older half goes when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = np.array(self.encode(part), np.int32).tobytes()
        if len(part) <= SHORT:
            if len(self) >= REMEMBERED:
                for old in list(self)[:REMEMBERED // 2]:
                    del self[old]
            self[part] = ids
        return ids


class Codec:
    """Pieces (text, score, id) and the ids of the 256 bytes.  The automaton is built
    where it is used; only the pieces travel (their number is the vocabulary's)."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: list[int]):
        self.pieces = [(t.replace(MARK, " "), s, i) for t, s, i in pieces]
        if any(" " in t.lstrip(" ") for t, _, _ in self.pieces):
            raise ValueError("a piece has a space mark after another character")
        self.byte_ids = byte_ids
        self._ready = False

    @classmethod
    def from_file(cls, path: str = MODEL) -> Codec:
        """Read a SentencePiece model file (on the driver only)."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = proto.ModelProto.SentencePiece
        normal = [(p.piece, p.score, i) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL]
        as_byte = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        return cls(normal, [as_byte[b] for b in range(256)])

    def __getstate__(self):
        return {"pieces": self.pieces, "byte_ids": self.byte_ids, "_ready": False}

    def _build(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for text, score, i in self.pieces:
            self.automaton.add_word(text, (len(text), score, i))
        self.automaton.make_automaton()
        self.single = {t for t, _, _ in self.pieces if len(t) == 1}
        self.unknown = min(s for _, s, _ in self.pieces) - 10
        raw = {i: t.encode() for t, _, i in self.pieces} | {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        # all pieces' bytes in one table, with their place and length by id
        self.lengths = np.zeros(max(raw) + 1, np.int64)
        self.places = np.zeros(max(raw) + 1, np.int64)
        ids = sorted(raw)
        self.lengths[ids] = [len(raw[i]) for i in ids]
        self.places[ids] = np.cumsum(self.lengths[ids]) - self.lengths[ids]
        self.bytes = np.frombuffer(b"".join(raw[i] for i in ids), np.uint8)
        self.seen = Remembered(self.best_path)
        self._ready = True

    def best_path(self, part: str) -> list[int]:
        """Ids of the pieces of highest total score that make up ``part``."""
        n = len(part)
        best, start, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        missing = iter([k for k, c in enumerate(part) if c not in self.single] + [n])
        gap = next(missing)  # the next character that is no piece
        for end, (length, score, i) in self.automaton.iter(part):
            while gap < end:
                if best[gap] + self.unknown > best[gap + 1]:
                    best[gap + 1], start[gap + 1], piece[gap + 1] = best[gap] + self.unknown, gap, -1
                gap = next(missing)
            score += best[end + 1 - length]
            if score > best[end + 1]:
                best[end + 1], start[end + 1], piece[end + 1] = score, end + 1 - length, i
        while gap < n:
            if best[gap] + self.unknown > best[gap + 1]:
                best[gap + 1], start[gap + 1], piece[gap + 1] = best[gap] + self.unknown, gap, -1
            gap = next(missing)
        out, at = [], n
        while at:
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out.extend(self.byte_ids[b] for b in reversed(part[start[at]:at].encode()))
            at = start[at]
        return out[::-1]

    def encode_bytes(self, text: str) -> bytes:
        """The ids of ``text`` as int32 bytes."""
        if not self._ready:
            self._build()
        return b"".join(map(self.seen.__getitem__, _PARTS.findall(" " + text))) if text else b""

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), np.int32)

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int32)
        return self.texts(ids, np.array([0, len(ids)]))[0][0].as_py()

    def encode_all(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text; null for a null."""
        packed = [None if t is None else self.encode_bytes(t) for t in texts]
        ends = np.cumsum([0, *(len(p) // 4 if p else 0 for p in packed)], dtype=np.int32)
        values = np.frombuffer(b"".join(p for p in packed if p), np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()),
                                        mask=pa.array([p is None for p in packed], pa.bool_()))

    def decode_all(self, ids: pa.ListArray) -> pa.StringArray:
        """The text of each list of ids; null for a null."""
        ends = np.asarray(ids.offsets, np.int64)  # a slice's offsets start where it does
        values = np.asarray(ids.values.slice(ends[0], ends[-1] - ends[0]))
        texts, _ = self.texts(values, ends - ends[0])
        return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), texts) if ids.null_count else texts

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
        """The texts of the rows ``ids[ends[k]:ends[k + 1]]``, and the ends of their bytes.
        Pieces' bytes are gathered from the table in one step; the space that encoding put
        in front of a text is left out.  Bytes that are no UTF-8 become U+FFFD."""
        if not self._ready:
            self._build()
        lengths = self.lengths[ids]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.bytes[np.repeat(self.places[ids] - upto[:-1], lengths) + np.arange(upto[-1])]
        byte_ends = upto[ends]
        keep = np.ones(len(flat), bool)
        filled = byte_ends[:-1] < byte_ends[1:]
        keep[byte_ends[:-1][filled]] = False
        flat = flat[keep]
        byte_ends = byte_ends - np.concatenate([[0], np.cumsum(filled)])
        raw, starts = flat.tobytes(), byte_ends[:-1][byte_ends[:-1] < byte_ends[1:]]
        try:
            raw.decode()
            sound = not ((flat[starts] & 0xC0) == 0x80).any()  # no row begins inside a character
        except UnicodeDecodeError:
            sound = False
        if sound:
            return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(byte_ends.astype(np.int32)), pa.py_buffer(raw)), byte_ends
        return pa.array([raw[s:e].decode("utf-8", "replace") for s, e in zip(byte_ends, byte_ends[1:])], pa.string()), byte_ends


_HERE: dict[int, Codec] = {}  # a worker's codec, and what it remembers, outlives its tasks


def _kept(codec: Codec) -> Codec:
    return _HERE.setdefault(hash((len(codec.pieces), tuple(codec.pieces[-50:]), tuple(codec.byte_ids))), codec)


def _with_columns(df: DataFrame, source: str, outs: dict[str, T.DataType], make) -> DataFrame:
    """``df`` with columns ``outs`` made from ``source`` by ``make`` (Arrow array -> Arrow
    arrays), ``ROWS`` rows at a time; the other columns pass through as they are."""
    names, taken = df.columns, {c.lower() for c in outs}
    kept = [k for k, c in enumerate(names) if c.lower() not in taken]
    at = [c.lower() for c in names].index(source.lower())
    schema = T.StructType([df.schema.fields[k] for k in kept] + [T.StructField(c, t) for c, t in outs.items()])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(0, batch.num_rows, ROWS):
                part = batch.slice(r, ROWS)
                yield pa.RecordBatch.from_arrays([part.column(k) for k in kept] + make(part.column(at)),
                                                 names=[names[k] for k in kept] + list(outs))

    return df.mapInArrow(apply, schema)


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", codec: Codec | None = None) -> DataFrame:
    """``docs`` with the piece ids of ``text_col`` as a further, last column (replacing
    one of that name)."""
    codec = codec or Codec.from_file()
    return _with_columns(docs, text_col, {out: T.ArrayType(T.IntegerType())},
                         lambda texts: [_kept(codec).encode_all(texts.to_pylist())])


def decode(tokens: DataFrame, ids_col: str = "ids", out: str = "decoded", codec: Codec | None = None) -> DataFrame:
    """``tokens`` with the text of ``ids_col`` as a further, last column."""
    codec = codec or Codec.from_file()
    return _with_columns(tokens, ids_col, {out: T.StringType()}, lambda ids: [_kept(codec).decode_all(ids)])


def round_trip(docs: DataFrame, text_col: str = "text", out: str = "ids", decoded: str = "decoded",
               codec: Codec | None = None) -> DataFrame:
    """``docs`` encoded and decoded again, in one pass over the rows."""
    codec = codec or Codec.from_file()

    def make(texts: pa.Array) -> list[pa.Array]:
        ids = _kept(codec).encode_all(texts.to_pylist())
        return [ids, _kept(codec).decode_all(ids)]

    return _with_columns(docs, text_col, {out: T.ArrayType(T.IntegerType()), decoded: T.StringType()}, make)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: the number of ids, a hash of them,
    how many stand for single bytes, and whether the text came back."""
    codec = Codec.from_file()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    low, high = min(codec.byte_ids), max(codec.byte_ids)
    return round_trip(docs, codec=codec).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.size(F.filter("ids", lambda i: i.between(low, high))).cast("long").alias("n_byte_tokens"),
        F.lower(F.lpad(F.hex(F.xxhash64("ids")), 16, "0")).alias("ids_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))
