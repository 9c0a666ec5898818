"""Token counts of whole texts with a shortcut for strings that are one token alone.

The vocabulary is studied once, before any text is read. A merge can only join two adjacent
characters that stand side by side in some piece. So a text can be cut, and its parts encoded
apart, before a word mark that follows anything else and between characters of classes that
no piece mixes. Every string of the vocabulary that the library encodes, alone, as itself is a
whole token: a part of a text that is such a string counts one. Only the other parts are
merged, by the library.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from riskweave.llm.common import slices

#: What the library writes for a space.
MARK = "▁"
#: Parts whose counts a Python worker remembers; a full table is emptied. Longer parts are
#: merged each time, so that the table stays small.
REMEMBERED_PARTS, LONGEST_REMEMBERED = 300_000, 64
#: Characters that may stand before a part, so that the library adds nothing to the part.
GUARDS = "\n\x01\x02\x03\x04"


def cuts(pieces: list[str]) -> str | None:
    """A pattern of the parts that can be encoded apart; None if word marks do not cut.

    ``pieces`` are all strings that merges can make or that are matched as a whole.
    Characters that stand side by side in one of them, marks at its start aside, fall into
    one class; two of different classes never do, so a change of class is a cut.
    """
    bare = [p.lstrip(MARK) for p in pieces]
    if any(MARK in p for p in bare):
        return None
    of: dict[str, set[str]] = {}
    for piece in (p for p in bare if len(p) > 1):
        merged = set(piece).union(*(of.get(c, ()) for c in piece))
        of.update(dict.fromkeys(merged, merged))
    classes = {id(c): c for c in of.values()}.values()
    runs = "|".join(f"[{re.escape(''.join(sorted(c)))}]+" for c in sorted(classes, key=len, reverse=True))
    return rf"{MARK}*(?:{runs or '(?!)'})|{MARK}+[^{MARK}]?|[\s\S]"


class _Counts(dict):
    """Part to count: one for whole tokens, known from the start; others are merged once."""

    def __init__(self, counter: TokenCounter):
        super().__init__(counter.whole)
        self.counter = counter

    def __missing__(self, part: str) -> int:
        count = self.counter.merged(part)
        if len(part) <= LONGEST_REMEMBERED:
            if len(self) >= len(self.counter.whole) + REMEMBERED_PARTS:
                self.clear()
                self.update(self.counter.whole)
            self[part] = count
        return count


class TokenCounter:
    """Counts the tokens of one sentencepiece model, without begin and end."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.library = library = SentencePieceProcessor(model_file=model)
        named = [
            library.id_to_piece(i)
            for i in range(library.get_piece_size())
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))
        ]
        inner = {c for p in named if len(p) > 1 for c in p}
        self.guard = next(
            (g for g in GUARDS if g not in inner and library.normalize(f"{g}a").endswith(f"{g}a")), None
        )
        pattern = cuts(named)
        self.parts = re.compile(pattern).findall if pattern and self.guard else None
        self.offset = len(library.encode(self.guard)) if self.guard else 0
        self.whole = self._prove(named) if self.parts else {}
        self.counts = _Counts(self)

    def _prove(self, pieces: list[str]) -> dict[str, int]:
        """The strings that the library, given them alone, returns as one token."""
        alone = self.library.encode([self.guard + p for p in pieces], num_threads=1)
        return {
            p: 1
            for p, ids in zip(pieces, alone, strict=True)
            if len(ids) == self.offset + 1 and self.library.id_to_piece(ids[-1]) == p
        }

    def merged(self, part: str) -> int:
        """Tokens of a part that is no whole token."""
        return len(self.library.encode(self.guard + part)) - self.offset

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.parts is None:
            return len(self.library.encode(text))
        return sum(map(self.counts.__getitem__, self.parts(self.library.normalize(text))))


@lru_cache(maxsize=2)
def _counter(model: str) -> TokenCounter:
    return TokenCounter(model)


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(
    docs: DataFrame, text: str = "text", *, model: str | None = None, into: str = "n_tokens"
) -> DataFrame:
    """``docs`` with ``into``: the number of tokens of the whole text.

    A null or empty text has none. Strings that look like special tokens are ordinary text.
    Begin and end tokens are not counted; nothing is cut or padded. A vocabulary in which a
    word mark may follow other characters inside a piece has no proven cuts, and its texts
    go to the library whole. A column that is already called ``into`` is replaced.
    """
    model = model or model_file()

    @arrow_udf("bigint")
    def counted(batch: pa.Array) -> pa.Array:
        counter = _counter(model)
        return pa.array(
            [counter.count(one.as_py() or "") for run in slices(batch) for one in run], pa.int64()
        )

    return docs.withColumn(into, counted(F.col(text)))


def op12(docs: DataFrame, limit: int = 4096) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint")
    return count_tokens(docs.select("doc_id", "text", size.alias("n_bytes"))).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
