"""Byte-level BPE through a sentencepiece model that is written from the ranks.

The model file is serialised field by field from the vocabulary: every byte
string becomes a piece of printable characters (one per byte), scored by its
negative rank, under identity normalisation.  Merging the best-scored pair
first is then merging the lowest rank first.  Pre-tokens are encoded one by one
and looked up again in a bounded cache; decoding maps ids back to bytes.

Defined cases: a null text reads as empty (no ids).  Any length of text and any
length of pre-token is encoded whole.  Texts are cut by the public pattern.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE, CACHED_CHARS = 1 << 18, 48
_FIRST = 0x100  # byte b is the character chr(_FIRST + b): no white space, no sentencepiece marker among them


def mapped(piece: bytes) -> str:
    return piece.decode("latin-1").translate(_TO)


_TO = {b: _FIRST + b for b in range(256)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto: pieces in rank order, then the unknown piece."""
    import struct

    order = sorted(ranks, key=ranks.get)
    if [ranks[x] for x in order] != list(range(len(order))):
        raise ValueError("ranks must be 0..n-1")
    out = [_field(1, _field(1, mapped(x).encode()) + b"\x15" + struct.pack("<f", -float(i)) + _field(3, 1)) for i, x in enumerate(order)]
    out.append(_field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", -float(len(order))) + _field(3, 2)))
    minus_one = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(order) + 1) + _field(40, len(order)) + b"".join(_field(x, minus_one) for x in (41, 42, 43))
    normaliser = _field(1, b"identity") + b"".join(_field(x, 0) for x in (3, 4, 5))
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class ByteBpe:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        import sentencepiece

        self.split = regex.compile(pattern).findall
        self.ranks, self.bytes_of = ranks, sorted(ranks, key=ranks.get)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.names = [str(i) for i in range(len(ranks))]
        self.known: dict[str, tuple[int, ...]] = {}

    def _pieces(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode() for p in pieces]
        ids = self.model.encode([mapped(x) for x in raw], num_threads=1)
        # a piece that is itself in the vocabulary is that token, whether or not merges lead to it
        return [[self.ranks[x]] if x in self.ranks else y for x, y in zip(raw, ids, strict=True)]

    def encode(self, text: str) -> list[int]:
        pieces = self.split(text)
        try:
            return list(chain.from_iterable(map(self.known.__getitem__, pieces)))
        except KeyError:
            return self._learn(pieces)

    def _learn(self, pieces: list[str]) -> list[int]:
        known = self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(dict.fromkeys(pieces))
        known.update(zip(new, map(tuple, self._pieces(new)), strict=True))
        ids = list(chain.from_iterable(map(known.__getitem__, pieces)))
        for p in new:
            if len(p) > CACHED_CHARS:
                del known[p]
        return ids

    def digest(self, ids: list[int]) -> str:
        """SHA-256 of the decimal ids joined by one blank."""
        return hashlib.sha256(" ".join(map(self.names.__getitem__, ids)).encode()).hexdigest()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(2)
def codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None, ids: bool = True) -> DataFrame:
    """doc_id of every row of docs(doc_id, text), with n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids.

    The vocabulary file is read on every executor: it belongs to an installed
    package or to a folder that all executors see.
    """
    import public_tokenizers

    path, pattern = path or default_vocabulary(), pattern or public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            step = 256
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                out: list[tuple] = []
                for text in part["text"]:
                    found = bpe.encode(text.as_py() or "")
                    back = hashlib.sha256(bpe.decode(found)).hexdigest()
                    out.append((len(found), bpe.digest(found), back, found if ids else None))
                n, digests, backs, lists = map(list, zip(*out, strict=True))
                columns = [part["row"], pa.array(n, pa.int64()), pa.array(digests), pa.array(backs)]
                names = ["row", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns, names = [*columns, pa.array(lists, pa.list_(pa.int32()))], [*names, "token_ids"]
                yield pa.record_batch(columns, names)

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    rows = docs.select(F.struct("doc_id").alias("row"), F.col("text").cast("string"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"row struct<doc_id:{kind}>, {schema}").select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * ids)
