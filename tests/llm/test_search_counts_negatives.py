"""Ranked search, token counts and hard negatives against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD, docs, prose

from riskweave.llm import hard_negatives, ranked_search, token_counts
from riskweave.llm.common import ship
from riskweave.llm.ranked_search import SearchSettings

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(ranked_search.TERM, (text or "").translate(LOWER))


def ranked(rows, items, best=20):
    """(item, rank, document, score) by the formula, over (id, text) pairs."""
    bags = [(k, Counter(terms(t))) for k, t in rows if terms(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for k, bag in bags:
            n = sum(bag.values())
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
                for t in terms(text)
                if bag[t]
            )
            scored.append((-score, k is None, k or 0, k))
        chosen = [(k, -s) for s, _, _, k in sorted(scored) if s < 0][:best]
        out += [(item, r, k, s) for r, (k, s) in enumerate(chosen, 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ITEMS = "item_id bigint, text string, _row string"


@pytest.mark.parametrize(
    "settings",
    [
        SearchSettings(best=3, owners=3, docs_a_shard=40, items_a_bundle=4),
        SearchSettings(best=5, owners=1, docs_a_shard=7, items_a_bundle=100, most_item_bytes=300),
    ],
)
def test_search_equals_the_formula(spark, settings):
    rng = random.Random(settings.owners)
    texts = [prose(rng, rng.randrange(1, 60), 150) for _ in range(150)] + ODD + ["w1 W1 w1, w2"] * 30
    rows = list(enumerate(texts)) + [(None, "w3 w4 w5"), (7, "w3 w4 straße"), (None, None)]
    items = [(k, prose(rng, rng.randrange(1, 25), 200)) for k in range(13)]
    items += [(50, None), (51, ""), (52, "..."), (53, "w1 w1 W1"), (54, "straße ÀÉ x"), (55, "unknownword"), (56, "w3 w4")]
    table = spark.createDataFrame([(*r, "clash") for r in items], ITEMS)
    made = ranked_search.ranked_search(docs(spark, rows), table, settings=settings)
    assert found(made) == ranked(rows, items, settings.best)


def test_search_of_tables_without_terms(spark):
    ship(spark)
    some = docs(spark, ["w1 w2", None])
    items = spark.createDataFrame([(1, "w1", "")], ITEMS)
    none = "item_id int, rank int, doc_id bigint, score bigint"
    for texts, asked in ((docs(spark, []), items), (docs(spark, [None, "", "--"]), items), (some, items.limit(0))):
        made = ranked_search.op11(texts, asked)
        assert made.collect() == [] and made.columns == [c.split()[0] for c in none.split(", ")]
    # One document holds the only term: its weight, 1000 ln(4/3), is 287.
    assert [tuple(r)[:3] for r in ranked_search.op11(some, items).collect()] == [(1, 1, 0)]


def test_search_keeps_rows_that_repeat_an_item(spark):
    rows = [(1, "a b"), (2, "b c"), (3, "d")]
    items = spark.createDataFrame([(1, "a", ""), (1, "c", ""), (None, "b", "")], ITEMS)
    got = found(ranked_search.op11(docs(spark, rows), items))
    assert [(i, r, d) for i, r, d, _ in got] == [(1, 1, 1), (1, 1, 2), (None, 1, 1), (None, 2, 2)]


def test_dictionary_compares_bytes_not_hashes():
    known = ranked_search.Dictionary(["ab", "b", "straße"])
    known.hashed[:] = 5  # every hash collides
    data = np.frombuffer(b"b ab xy", np.uint8)
    at = known.find(data, np.full(3, 5, np.uint64), np.array([0, 2, 5]), np.array([1, 4, 7]))
    assert set(at) <= {-1, *range(3)} and at[2] == -1


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(token_counts.model_file())


def library(counter, text):
    return len(counter.library.encode(text or ""))


def test_every_shortcut_is_one_token(counter):
    assert counter.parts is not None and len(counter.whole) > 20_000
    for part in random.Random(2).sample(sorted(counter.whole), 500):
        assert len(counter.library.encode(counter.guard + part)) == counter.offset + 1


def test_counts_equal_the_library(counter):
    rng = random.Random(3)
    letters = "ab ▁\n1(<.é中😀'\t\x00sтк据数"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    odd = [" ", "   x", "▁▁a", "<s>a</s><unk>", "<0x0A>", "ﬁ①Å", "a" * 5000, "ab " * 3000, "１２３", "1234.56", "\r\n x"]
    for text in [*ODD, *odd, *made, *(prose(rng, 50) for _ in range(20))]:
        assert counter.count(text or "") == library(counter, text), repr(text)[:80]


def test_counts_without_proven_cuts(counter):
    """A vocabulary whose pieces hold marks inside goes to the library whole."""
    assert token_counts.cuts(["a", "a▁b"]) is None
    assert re.findall(token_counts.cuts(["ab", "bc", "12", "▁a", "▁▁"]), "▁▁cab12x▁▁▁1▁") == [
        "▁▁cab", "12", "x", "▁▁▁1", "▁",
    ]
    alone = token_counts.TokenCounter(token_counts.model_file())
    alone.parts = None
    assert [alone.count(t) for t in ("", "Hello there", "a\nb")] == [counter.count(t) for t in ("", "Hello there", "a\nb")]


def test_remembered_counts_stay_bounded(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED_PARTS", 10)
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("qxzjk") for _ in range(9)) for _ in range(200)) + " " + "qz" * 200
    assert counter.count(text) == library(counter, text)
    assert len(counter.counts) <= len(counter.whole) + 10 and all(len(p) <= 64 for p in counter.counts if p not in counter.whole)


def test_token_count_query(spark, counter):
    texts = [*ODD, "x " * 5000]
    table = docs(spark, texts)
    got = {r.doc_id: r for r in token_counts.op12(table.withColumn("n_tokens", table.doc_id)).collect()}
    for k, text in enumerate(texts):
        want = library(counter, text)
        assert got[k] == (k, len((text or "").encode()), want, want > 4096)
    assert token_counts.op12(docs(spark, [])).collect() == []
    kept = token_counts.count_tokens(table, into="n_chars")
    assert kept.columns == table.columns


def mined(rows, positives=5, negatives=10):
    """Rows as (id, label, vector): negatives by looking at all pairs."""
    fine = [
        (k, label, [math.floor(256 * x) for x in v])
        for k, label, v in rows
        if k is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    fine = [(k, (label + 1) % 10 if k % 7 == 0 else label, v) for k, label, v in fine]
    out = []
    for k, label, v in fine:
        if k % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in fine]
        near = sorted(x for x in scored if x[2] == label and x[1] != k)[:positives]
        for p, j, _ in near:
            hard = sorted(x for x in scored if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p)[:negatives]
            out += [(k, j, r, h, -p, -s) for r, (s, h, _) in enumerate(hard, 1)]
    return sorted(out)


VECTORS = "vec_id bigint, label int, embedding array<float>, _row string"


def vectors(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "clash") for r in rows], VECTORS)


def random_rows(rng, n, size=12, scale=0.4):
    return [
        (k, int(rng.integers(0, 3)), [float(np.float32(x)) for x in rng.normal(0, scale, size)]) for k in range(n)
    ]


ANCHOR_CELLS = [(8192, 32768), (3, 50)]


@pytest.mark.parametrize(("anchors", "candidates"), ANCHOR_CELLS)
def test_negatives_equal_all_pairs(spark, monkeypatch, anchors, candidates):
    rng = np.random.default_rng(5)
    rows = random_rows(rng, 600)
    same = rows[100][2]
    rows += [(1000 + k, k % 3, same) for k in range(60)]  # ties
    rows += [(2000, None, same), (2100, 1, None), (None, 1, same), (2200, 1, [*same[:-1], math.nan])]
    rows += [(2300, 1, [math.inf, *same[1:]]), (2400, 2, [None, *same[1:]]), (2500, 2, same[:5]), (2600, 1, [])]
    got = hard_negatives.mine(
        vectors(spark, rows).withColumnRenamed("label", "own"),
        hard_negatives.F.col("vec_id") % 100 == 0,
        label=hard_negatives.F.expr("if(vec_id % 7 = 0, (own + 1) % 10, own)"),
        anchors_a_cell=anchors,
        candidates_a_cell=candidates,
    )
    assert sorted(tuple(r) for r in got.collect()) == mined(rows)
    assert sorted(tuple(r) for r in hard_negatives.op13(vectors(spark, rows)).collect()) == mined(rows)


def test_negatives_of_tables_without_anchors(spark):
    for rows in ([], [(1, 1, [0.5])], [(100, 1, [0.5])], [(100, None, [0.5]), (200, 1, None)]):
        assert hard_negatives.op13(vectors(spark, rows)).collect() == []


def test_products_are_exact_at_every_width():
    rng = np.random.default_rng(6)
    for most in (1, 3, 100, 5000, 1 << 20, 1 << 23, 1 << 30, 1 << 40):
        for n, width in ((1, 1), (7, 5), (40, 64)):
            a, c = (rng.integers(-most, most + 1, (k, width)) for k in (9, n))
            got = hard_negatives.scorer(a, c)(slice(2, 9))
            want = a[2:].astype(object) @ c.astype(object).T
            assert (np.asarray(got, object) == want).all(), (most, n, width)
    assert hard_negatives.fields(np.full((1, 64), 40), np.full((9, 64), 40))[0] > 1
    extreme = np.array([[-(1 << 20)] * 3])
    assert hard_negatives.scorer(extreme, np.array([[1 << 20] * 3, [-(1 << 20)] * 3]))(slice(None)).tolist() == [
        [-3 << 40, 3 << 40]
    ]


def test_a_huge_component_leaves_other_rows_right(spark):
    rows = [(100, 1, [1.0, 0.0]), (1, 1, [1.0, 0.5]), (6, 2, [0.5, 0.0]), (8, 2, [0.3, 9.0])]
    huge = [(9, 3, [1e30, 0.0]), (2, 1, [1e30, 1.0])]
    made = hard_negatives.op13(vectors(spark, rows + huge)).collect()
    got = {}
    for r in sorted(made, key=lambda r: r.rank):
        got.setdefault(r.positive_id, []).append((r.negative_id, r.positive_score, r.negative_score))
    # Beyond 64 bits a score is the limit of a long, and 90 % of that is out of reach here.
    assert got == {1: [(6, 65536, 32768)]}
