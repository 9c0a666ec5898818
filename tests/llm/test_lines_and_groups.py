from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from llm_cases import LOWER, ODD, SPACE, components, docs, prose, words

from riskweave.llm import jaccard, line_dedup
from riskweave.llm.graph import components as graph_components


def kept_lines(rows):
    first = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.translate(LOWER).strip(SPACE)
            if len(key) >= 10:
                first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if first.get(x.translate(LOWER).strip(SPACE), doc) >= doc]
        out[doc] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot_share", [0.0005, 0.2])
def test_lines_equal_brute_force(spark, hot_share):
    rng = random.Random(3)
    pool = [prose(rng, rng.randrange(1, 6), 30) for _ in range(40)] + ["The common line here", "ÉTOILE commune à tous"]
    texts = list(ODD)
    for _ in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randrange(0, 200))]
        lines += ["  the COMMON line here\t"] * rng.randrange(3)
        texts.append("\n".join(lines))
    rng.shuffle(texts)
    made = line_dedup.dedup_lines(docs(spark, texts), hot_share=hot_share).collect()
    got = {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in made}
    assert got == kept_lines(list(enumerate(texts)))


def test_lines_of_repeated_and_missing_ids(spark):
    same = "a line that is long enough"
    rows = [(5, same), (5, f"x\n{same}"), (7, same), (None, same), (None, f"{same}\n{same}")]
    made = line_dedup.dedup_lines(docs(spark, rows).withColumnRenamed("source", "n_lines"))
    got = sorted((r.doc_id or -1, r.text, r.n_dropped) for r in made.collect())
    assert got == [(-1, "", 1), (-1, "", 2), (5, same, 0), (5, f"x\n{same}", 0), (7, "", 1)]
    assert made.columns.count("n_lines") == 1


def test_bitmaps_leave_whole_words_out(spark):
    line = "a repeated line of text"
    far = "\n".join(["own"] * 130 + [line])
    rows = line_dedup.keep_bitmaps(docs(spark, [line, far])).collect()
    assert [(r["_doc"], [(w.word, w.bits) for w in r.keep_bitmap]) for r in rows] == [(1, [(2, ~(1 << 2))])]


def test_empty_tables(spark):
    none = docs(spark, ["x"]).where("false")
    assert line_dedup.dedup_lines(none).count() == 0
    assert jaccard.op5(none).count() == 0
    assert jaccard.keep_smallest(none).count() == 0


def shingles(text):
    own = words((text or "").translate(LOWER))
    if 0 < len(own) < 4:
        return {tuple(own)}
    return {tuple(own[k : k + 4]) for k in range(len(own) - 3)}


def similar(a, b, percent=85):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    texts = list(ODD)
    shared = prose(rng, 60)
    for _ in range(12):
        base = prose(rng, rng.randrange(5, 160)).split()
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"W{rng.randrange(400)}"
            texts.append(" ".join(copy))
    texts += [f"{prose(rng, 70)} {shared} {prose(rng, 5)}" for _ in range(15)]
    # A chain whose ends are not similar themselves.
    chain = [f"c{k}" for k in range(130)]
    texts += [" ".join(chain[s : s + 100]) for s in range(0, 31, 6)]
    rng.shuffle(texts)
    sets = [shingles(t) for t in texts]
    n = len(texts)
    links = [(a, b) for a in range(n) for b in range(a) if similar(sets[a], sets[b])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op5(docs(spark, texts)).collect()}
    want = components(n, links)
    assert got == {k: (len(sets[k]), want[k]) for k in range(n)}
    left = {r.doc_id for r in jaccard.keep_smallest(docs(spark, texts)).collect()}
    assert left == {k for k in range(n) if want[k] == k}


def test_index_lists_alone_find_all_links(spark, monkeypatch):
    """Without leaders every link must come out of the index lists."""
    monkeypatch.setattr(
        jaccard, "_leader_pairs", lambda classes, percent: classes.selectExpr("node a", "node b").limit(0)
    )
    rng = random.Random(8)
    texts = []
    for _ in range(10):
        base = prose(rng, rng.randrange(30, 90)).split()
        texts += [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in (2, 9, 17, 29)]
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if similar(sets[a], sets[b])]
    got = {r.doc_id: r.component_id for r in jaccard.op5(docs(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == components(len(texts), links)


def test_a_large_group_of_near_copies_is_not_compared_in_pairs(spark, monkeypatch):
    """Copies that link with a part of each other only: rounds find all links' components."""
    rng, met = random.Random(3), []
    base = prose(rng, 70).split()
    texts = []
    for _ in range(160):
        words = list(base)
        words[rng.randrange(70)] = f"w{rng.randrange(10**6)}"
        words[-1 - rng.randrange(4)] = f"w{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    real = jaccard._list_pairs

    def counted(*args):
        pairs = real(*args).localCheckpoint()
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "_list_pairs", counted)
    monkeypatch.setattr(jaccard, "LEAST_CLASSES", 1)
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(160) for b in range(a) if similar(sets[a], sets[b])]
    got = {r.doc_id: r.component_id for r in jaccard.op5(docs(spark, texts)).collect()}
    assert [got[k] for k in range(160)] == components(160, links)
    assert sum(met) < 160 * 159 / 2 / 4, met


def test_texts_with_a_common_part_do_not_meet(spark, monkeypatch):
    """The part is in too few of many texts to be hot, and too little for a link."""
    rng, met = random.Random(6), []
    common = prose(rng, 70)
    texts = [f"{common} {' '.join(f'o{k}n{j}' for j in range(15))}" for k in range(9)]
    texts += [" ".join(f"x{k}y{j}" for j in range(24)) for k in range(20_000)]
    real = jaccard._list_pairs

    def counted(*args):
        pairs = real(*args).localCheckpoint()
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "_list_pairs", counted)
    rows = jaccard.op5(docs(spark, texts)).collect()
    assert all(r.component_id == r.doc_id for r in rows) and len(rows) == len(texts)
    assert sum(met) == 0


def test_frequent_grams_come_last(spark):
    texts = ["p q r s one two", "p q r s three", "p q r s", "p q r s"]
    ranks = jaccard.gram_ranks(docs(spark, texts), "text", 4)
    often = jaccard.shingle_sets(pa.array(["p q r s"]), 4)[0][0]
    grams, rows = jaccard.shingle_sets(pa.array(texts), 4, ranks)
    assert len(ranks) == 1 << jaccard.LEAST_BITS and ranks[often % len(ranks)] == ranks.max()
    assert [grams[rows == k][-1] for k in range(4)] == [often] * 4


def test_rows_without_an_id(spark):
    text = prose(random.Random(1), 30)
    rows = [(None, text), (4, text), (9, text), (None, "else where is no one"), (None, "")]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in jaccard.op5(docs(spark, rows)).collect())
    assert got == [(-1, -1), (-1, -1), (-1, 4), (4, 4), (9, 4)]
    assert jaccard.keep_smallest(docs(spark, rows)).count() == 4


def test_line_dedup_leaves_clashing_names_alone(spark):
    shared = "a line that two rows hold"
    names = ("_bits", "_tag", "_doc", "_kept", "__bits")
    table = docs(spark, [(1, shared), (2, f"{shared}\nown"), (None, shared), (None, shared)])
    for name in names:
        table = table.selectExpr("*", f"source {name}")
    rows = line_dedup.dedup_lines(table).collect()
    assert sorted((r.doc_id or 9, r.text, r.n_dropped) for r in rows) == [(1, shared, 0), (2, "own", 1), (9, "", 1), (9, "", 1)]
    assert all(r[n] == r.source for r in rows for n in names)


def test_line_dedup_sql_counts_a_null_id_as_the_largest(spark):
    duckdb = pytest.importorskip("duckdb")
    line = "a line that is long enough"
    rows = [(3, f"{line}\nx"), (None, line), (None, "only without an id"), (4, None)]
    got = sorted(map(str, (tuple(r) for r in line_dedup.op1(docs(spark, rows)).collect())))
    with duckdb.connect() as base:
        base.execute("create table documents (doc_id bigint, text varchar)")
        base.executemany("insert into documents values (?, ?)", rows)
        assert sorted(map(str, base.execute(line_dedup.OP1_SQL).fetchall())) == got


def test_a_text_without_an_id_links_the_texts_beside_it(spark):
    chain = [f"c{k}" for k in range(112)]
    cut = [" ".join(chain[s : s + 100]) for s in (0, 6, 12)]
    assert not similar(shingles(cut[0]), shingles(cut[2]))
    for names, want in (((1, None, 3), [1, 1, 1]), ((1, 2, 3), [1, 1, 1]), ((1, None, None), [1, 1, 1])):
        rows = jaccard.op5(docs(spark, list(zip(names, cut, strict=True)))).collect()
        assert [r.component_id for r in rows] == want


def test_passes_give_the_same_links(spark, monkeypatch):
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = prose(rng, 60).split()
        texts += [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in (1, 20, 58)]
    want = sorted(jaccard.op5(docs(spark, texts)).collect())
    monkeypatch.setattr(jaccard, "PASS_BYTES", 2000)
    monkeypatch.setattr(jaccard, "RUN_GRAMS", 100)
    assert sorted(jaccard.op5(docs(spark, texts)).collect()) == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    n = 60
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(45)] + [(59 - k, 58 - k) for k in range(12)]
    edges = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in graph_components(edges).collect()}
    want = components(n, links)
    assert got == {k: want[k] for k in range(n) if any(k in e and e[0] != e[1] for e in links)}
