"""Small tables and brute-force versions for the tests of the text operators."""

from __future__ import annotations

import random
import re

from riskweave.llm.common import ship

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = {c: c + 32 for c in range(65, 91)}
SPACE = " \t\n\x0b\x0c\r"


def docs(spark, texts, schema=SCHEMA, start=0):
    """A table of documents with these texts, or with these (id, text) pairs."""
    ship(spark)
    rows = [
        (*t, "en", f"src{k % 3}", len(t[1] or "")) if isinstance(t, tuple)
        else (k + start, t, "en", f"src{k % 3}", len(t or ""))
        for k, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, schema)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


#: Texts that every operator must take.
ODD = [None, "", " \t\n\x0b ", "\n\n\n", "a", "ÀÉ straße x", "\x00\x01 \U0001f600 z", "word " * 5000, "same", "same"]


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]
