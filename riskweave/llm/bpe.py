"""Byte-level BPE with the tokenizers library, over Arrow batches.

A byte-level vocabulary names every byte by one printable character, so a token is a
string over 256 such characters. Encoding maps the bytes of each piece of a text to these
characters and lets the library's BPE model merge them; decoding reverses the byte table.
A token may hold a part of a character's bytes only; its character offsets then cover that
whole character, and decoded bytes are put together before they are read as UTF-8.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from riskweave.llm.common import lists, slices

#: Distinct pieces whose ids a Python worker remembers; a full table is emptied.
REMEMBERED_PIECES = 300_000
#: Longer pieces are merged anew each time, so what is remembered stays within some 100 MB.
REMEMBERED_CHARACTERS = 64
ENCODED = "struct<ids:array<int>,starts:array<int>,ends:array<int>>"
DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def byte_characters() -> list[str]:
    """The character that stands for each byte value.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class _Known(dict):
    """Piece to ids; what is missing is made and remembered."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self.make(piece)
        if len(piece) <= REMEMBERED_CHARACTERS:
            if len(self) >= REMEMBERED_PIECES:
                self.clear()
            self[piece] = found
        return found


class ByteBpe:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str, pattern: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        self.model = tokenizer.model
        self.pieces = regex.compile(pattern).findall
        self.table = {b: c for b, c in enumerate(byte_characters())}
        back = {c: b for b, c in self.table.items()}
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        named = [special.get(i) or tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes_of = [
            t.encode() if i in special else bytes(back[c] for c in t) for i, t in enumerate(named)
        ]
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.decimal = [str(i) for i in range(size)]
        self.known = _Known(self.merge)

    def merge(self, piece: str) -> tuple[int, ...]:
        """The ids of one piece: its bytes as characters, merged by the model."""
        characters = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        return tuple(t.id for t in self.model.tokenize(characters.translate(self.table)))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, self.pieces(text))))

    def decode(self, ids) -> bytes:
        """The bytes of ``ids``; ids outside the vocabulary and nulls stand for nothing."""
        table = self.bytes_of
        try:
            return b"".join(map(table.__getitem__, ids))
        except (IndexError, TypeError):
            return b"".join(table[i] for i in ids if i is not None and 0 <= i < len(table))

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-end code point of each token in ``text``."""
        ends = np.cumsum(self.lengths[np.asarray(ids, np.int64)])
        begins = ends - self.lengths[np.asarray(ids, np.int64)]
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        starting = np.cumsum((data & 0xC0) != 0x80)
        return starting[begins] - 1, starting[ends - 1]


@lru_cache(maxsize=2)
def _codec(vocabulary: str, pattern: str) -> ByteBpe:
    return ByteBpe(vocabulary, pattern)


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _texts(batch: pa.Array):
    for part in slices(batch):
        for text in part.to_pylist():
            yield text or ""


def encode(
    docs: DataFrame,
    text: str = "text",
    *,
    vocabulary: str | None = None,
    pattern: str | None = None,
    into: str = "encoded",
) -> DataFrame:
    """``docs`` with ``into``: ids and code point offsets of every token of the whole text.

    A null or empty text has no tokens. Text that looks like a special token is ordinary
    text. A column that is already called ``into`` is replaced; others stay as they are.
    """
    vocabulary, pattern = vocabulary or vocabulary_file(), pattern or split_pattern()

    @arrow_udf(ENCODED)
    def encoded(batch: pa.Array) -> pa.Array:
        codec = _codec(vocabulary, pattern)
        ids, starts, ends, counts = [], [], [], []
        for one in _texts(batch):
            own = codec.encode(one)
            first, last = codec.offsets(one, own)
            counts.append(len(own))
            ids.append(np.array(own, np.int32))
            starts.append(first.astype(np.int32))
            ends.append(last.astype(np.int32))
        parts = (np.concatenate(x) if x else np.empty(0, np.int32) for x in (ids, starts, ends))
        return pa.StructArray.from_arrays(
            [lists(x, counts, pa.int32()) for x in parts], names=["ids", "starts", "ends"]
        )

    return docs.withColumn(into, encoded(F.col(text)))


def decode(
    tokens: DataFrame,
    ids: str = "ids",
    *,
    vocabulary: str | None = None,
    pattern: str | None = None,
    into: str = "decoded",
) -> DataFrame:
    """``tokens`` with ``into``: the bytes that the ids in column ``ids`` stand for.

    Null or empty ids give no bytes. Bytes are returned, not text: a cut of a token
    sequence may split a character, and only the caller knows what comes next.
    """
    vocabulary, pattern = vocabulary or vocabulary_file(), pattern or split_pattern()

    @arrow_udf("binary")
    def decoded(batch: pa.Array) -> pa.Array:
        codec = _codec(vocabulary, pattern)
        return pa.array([codec.decode(x.as_py() or ()) for x in batch], pa.binary())

    return tokens.withColumn(into, decoded(F.col(ids)))


def readable(pieces: list[bytes]) -> list[str]:
    """Decoded pieces as text; a character split between pieces goes to the one that ends it."""
    import codecs

    reader = codecs.getincrementaldecoder("utf-8")("replace")
    out = [reader.decode(piece) for piece in pieces]
    if out:
        out[-1] += reader.decode(b"", True)
    return out


def round_trip(
    docs: DataFrame,
    text: str = "text",
    *,
    vocabulary: str | None = None,
    pattern: str | None = None,
    into: str = "tokens",
) -> DataFrame:
    """``docs`` with ``into``: token count and digests of the ids and of their decoded bytes.

    One pass over the text, without the offsets. A null text counts as empty.
    """
    vocabulary, pattern = vocabulary or vocabulary_file(), pattern or split_pattern()

    @arrow_udf(DIGESTS)
    def digests(batch: pa.Array) -> pa.Array:
        codec = _codec(vocabulary, pattern)
        rows = []
        for one in _texts(batch):
            ids = codec.encode(one)
            named = " ".join(map(codec.decimal.__getitem__, ids)).encode()
            back = codec.decode(ids)
            rows.append(
                (len(ids), hashlib.sha256(named).hexdigest(), hashlib.sha256(back).hexdigest())
            )
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        kinds = (pa.int64(), pa.string(), pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return docs.withColumn(into, digests(F.col(text)))


def op9(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    made = round_trip(docs.select("doc_id", "text"), into="_tokens")
    return made.select("doc_id", "_tokens.*")
