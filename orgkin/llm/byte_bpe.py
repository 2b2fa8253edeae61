"""Byte-level BPE encoding and decoding with a sentencepiece model made from the vocabulary.

The rank file of a byte-level vocabulary is written out as a sentencepiece BPE model: every
token's bytes become characters one to one, the score of a piece is its negative rank, and
normalisation is the identity. Merging the best scored pair first is then merging by rank.
Texts are cut by the vocabulary's pattern, and every match is encoded separately; a match
that is a token as a whole is that token. Decoding joins the bytes of the ids.

The model is about 1 MB whatever the corpus is, so it travels as a broadcast variable.
"""

from __future__ import annotations

import base64
import ctypes
import gc
import hashlib
import struct
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgkin.llm.common import documents

VOCABULARY = "byte_bpe_50k.tiktoken"
FIRST_CHAR = 0x100  # byte b is the character FIRST_CHAR + b: no byte is white space
CACHED = 300_000  # distinct matches whose ids a worker remembers
AT_ONCE = 150_000  # matches that are looked up together
LONG = 1_000_000  # characters from which a text is cut into parts of so many matches


def vocabulary(name: str = VOCABULARY) -> str:
    """The path of a public vocabulary, where that package is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def characters(token: bytes) -> str:
    return "".join(chr(FIRST_CHAR + b) for b in token)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a serialised sentencepiece BPE model; piece 0 is unknown and the
    token of rank r is piece r + 1."""
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)]
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    pieces += [
        _field(1, characters(t).encode()) + _field(2, float(-r)) + _field(3, 1) for t, r in by_rank
    ]
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, 0)
    trainer += _field(41, 2**64 - 1) + _field(42, 2**64 - 1) + _field(43, 2**64 - 1)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """The model of one worker with the ids of the matches it has seen."""

    def __init__(self, model: bytes, tokens: list[bytes], cut: str):
        self.model, self.tokens, self.cut = model, tokens, cut
        self.chars = {b: FIRST_CHAR + b for b in range(256)}
        self.seen: dict[str, bytes] = {}  # ids as 32-bit integers, which takes little memory

    @cached_property
    def processor(self):
        """Loaded by the first text; a worker that only decodes does without."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def pattern(self):
        import regex

        return regex.compile(self.cut)

    @cached_property
    def whole(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(self.tokens)}

    @cached_property
    def table(self) -> pa.Array:
        return pa.array(self.tokens, pa.large_binary())

    def _learn(self, matches: set[str]) -> None:
        """Ids of all these matches: those not yet known are encoded in one call."""
        new = matches - self.seen.keys()
        if len(self.seen) + len(new) > CACHED:
            self.seen.clear()
            new = matches
        pack = struct.Struct("<i").pack
        whole = {m: self.whole.get(m.encode()) for m in new}
        self.seen.update((m, pack(at)) for m, at in whole.items() if at is not None)
        rest = [m for m, at in whole.items() if at is None]
        chars = [m.encode().decode("latin-1").translate(self.chars) for m in rest]
        for m, ids in zip(rest, self.processor.encode(chars, num_threads=1), strict=True):
            self.seen[m] = array("i", [i - 1 for i in ids]).tobytes()

    def _parts(self, texts: Iterable[str]) -> Iterator[tuple[int, list[str]]]:
        """The matches of the texts, those of a long text in parts."""
        for at, text in enumerate(texts):
            if len(text) <= LONG:
                yield at, self.pattern.findall(text)
                continue
            matches = (m[0] for m in self.pattern.finditer(text))
            while part := list(islice(matches, AT_ONCE)):
                yield at, part

    def encode_all(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text. Matches are looked up for many texts together."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for at, part in self._parts(texts):
            held.append((at, part))
            size += len(part)
            if size >= AT_ONCE:
                self._flush(held, out)
                held, size = [], 0
        self._flush(held, out)
        return [np.frombuffer(b"".join(parts), np.int32) for parts in out]

    def _flush(self, held: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        self._learn({m for _, part in held for m in part})
        seen = self.seen
        for at, part in held:
            out[at].append(b"".join([seen[m] for m in part]))

    def decode(self, ids) -> bytes:
        """``ids`` is an Arrow array without nulls; long ones are taken in parts."""
        if ids.null_count:
            raise TypeError("ids must not be null")
        out = []
        for k in range(0, len(ids), AT_ONCE):
            _, ends, joined = self.table.take(ids.slice(k, AT_ONCE)).buffers()
            out.append(joined[: int(np.frombuffer(ends, np.int64)[len(ids[k: k + AT_ONCE])])])
        return b"".join(out)


_codecs: dict[str, Codec] = {}


def _codec(shared) -> Codec:
    """One codec for each Python worker and vocabulary."""
    name, model, tokens, cut = shared.value
    if name not in _codecs:
        _codecs[name] = Codec(model, tokens, cut)
    return _codecs[name]


def _give_back() -> None:
    """Return freed memory to the system: workers outlive their task, beside the next one's JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


class ByteBpe:
    """Column functions of one vocabulary.

    ``encode(text)``: array of ids; a null text counts as empty. ``decode(ids)``: the bytes;
    ``digest(ids)``: SHA-256 of the ids as little-endian unsigned 32-bit integers.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, cut: str | None = None):
        ranks = read_ranks(path or vocabulary())
        tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        model = sentencepiece_model(ranks)
        shared = spark.sparkContext.broadcast(
            (hashlib.sha256(model + (cut or pattern()).encode()).hexdigest(), model, tokens,
             cut or pattern())
        )

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def encode(texts: pa.Array) -> pa.Array:
            codec = _codec(shared)
            gc.disable()  # nothing here is cyclic, and the cache is long to walk
            try:
                ids = codec.encode_all([t or "" for t in texts.to_pylist()])
            finally:
                gc.enable()
            _give_back()
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))

        @F.arrow_udf(T.BinaryType())
        def decode(lists: pa.Array) -> pa.Array:
            codec = _codec(shared)
            out = pa.array(
                [codec.decode(x.values) if x.is_valid else None for x in lists], pa.binary()
            )
            _give_back()
            return out

        @F.arrow_udf(T.StringType())
        def digest(lists: pa.Array) -> pa.Array:
            ids = (x.values.to_numpy().astype("<u4") if x.is_valid else None for x in lists)
            return pa.array(
                [None if x is None else hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()
            )

        # Not repeatable as far as the optimizer knows: it would encode once for each use.
        self.encode, self.decode, self.digest = encode.asNondeterministic(), decode, digest


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, token_ids, decoded`` for every row, in any order: the ids of the whole text
    and the bytes that they stand for.

    A null or empty text has no ids. Ids of rows may be null or repeat; each row is encoded.
    Other columns are ignored, whatever their names.
    """
    bpe = ByteBpe(docs.sparkSession, path)
    rows = docs.select("doc_id", bpe.encode(F.col("text")).alias("token_ids"))
    return rows.select(
        "doc_id", "token_ids", bpe.decode("token_ids").alias("decoded"),
        bpe.digest("token_ids").alias("ids_sha256"),
    )


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``encoded``."""
    return encoded(docs, path).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir):
    return digests(documents(spark, sf_dir))
