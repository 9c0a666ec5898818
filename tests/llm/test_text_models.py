from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD, docs, prose, words

from riskweave.llm import decontaminate, jaccard, language, quality
from riskweave.llm.common import slices

SYMBOLS = set("#*$%&|<>")


def base_stats(text):
    own, seen, dups = words(text), set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    places = {}
    for k in range(len(own) - 4):
        places.setdefault(tuple(own[k : k + 5]), []).append(k)
    covered = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(5)}
    return len(own), sum(map(len, own)), sum(c in SYMBOLS for c in text or ""), dups, len(covered)


def test_statistics_equal_brute_force():
    rng = random.Random(2)
    texts = list(ODD) + ["a b c d e\x0ba b c d e f", "x\n x\nx\n\nx", "#|& é|"]
    texts += ["\n".join(prose(rng, rng.randrange(12), 6) for _ in range(rng.randrange(30))) for _ in range(200)]
    made = quality.count_stats(pa.array(texts))
    got = list(zip(*(made[s].tolist() for s in quality.STATS[:5]), strict=True))
    assert got == [base_stats(t) for t in texts]


def test_tiny_texts_are_counted_in_bounded_runs():
    tiny = pa.array(["a"] * 2000)
    assert [len(p) for p in slices(tiny, 1 << 20, language.MOST_TEXTS)] == [512, 512, 512, 464]
    assert [len(p) for p in slices(tiny, 1 << 20)] == [2000]


def test_word_hashing_takes_little_memory_however_many_texts_come_at_once():
    rng = random.Random(5)
    texts = pa.array([prose(rng, 400) for _ in range(2000)])
    most = {}
    for name, call in (("stats", quality._stats.func), ("sets", jaccard._set_udf(4).func)):
        call(texts[:10])
        tracemalloc.start()
        call(texts)
        most[name] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    # 3 MB of text; the sets themselves are 6 MB.
    assert most["stats"] < 32 << 20 and most["sets"] < 32 << 20, most


def labelled(spark):
    rng = random.Random(4)
    texts, labels = [], []
    for k in range(240):
        text, good = prose(rng, rng.randrange(20, 120), 5000), 1
        if k % 6 == 0:
            text, good = " ".join(f"{w}%%%" for w in text.split()), 0
        elif k % 9 == 0:
            text, good = " ".join(f"{w.upper()}!!" for w in text.split()), 0
        texts.append(text)
        labels.append((k, good))
    return docs(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int"), dict(labels)


def test_rules_are_learned_and_read_as_conditions(spark):
    table, labels, truth = labelled(spark)
    rules = quality.learn(table, labels)
    assert rules and all(" > " in str(c) or " <= " in str(c) for r in rules for c in r)
    got = {r.doc_id: r.kept for r in quality.op3(table, labels).collect()}
    assert got == {k: bool(v) for k, v in truth.items()}


def test_rules_on_odd_input(spark):
    table = docs(spark, ODD).withColumnRenamed("source", "kept")
    labels = spark.createDataFrame([(0, None), (None, 1), (4, 1), (4, 0), (8, 1)], "doc_id bigint, quality int")
    rows = quality.op3(table, labels).collect()
    assert len(rows) == len(ODD) and not any(r.kept for r in rows)
    assert quality.learn(table, labels.where("false")) == []
    assert quality.op3(table.where("false"), labels).count() == 0


def test_rules_are_learned_from_every_labelled_row(spark):
    """The bad rows are those that come last in hash order, behind 20,000 others."""
    ids = [r[0] for r in spark.sql("select id from range(20300) order by pmod(xxhash64(id), 1 << 30), id").collect()]
    bad = set(ids[20_000:])
    texts = [(k, " ".join(f"w{k}{j}{'%%%' if k in bad else ''}" for j in range(12))) for k in range(20_300)]
    labels = spark.createDataFrame([(k, int(k not in bad)) for k in range(20_300)], "doc_id bigint, quality int")
    table = docs(spark, texts).repartition(4)
    assert {r.doc_id for r in quality.op3(table, labels).where("not kept").collect()} == bad


def test_rules_from_more_rows_than_bins(spark):
    table, labels, truth = labelled(spark)
    rules = quality.learn(table, labels, settings=quality.CoverSettings(bins=32))
    got = {r.doc_id: r.kept for r in quality.judge(table, rules).collect()}
    assert got == {k: bool(v) for k, v in truth.items()}


def test_quantiles_of_counts_equal_those_of_rows():
    rng, shares = np.random.default_rng(2), np.linspace(0, 1, 66)[1:-1]
    for n in (1, 2, 7, 500):
        rows = np.round(rng.random(n), 2)
        values, count = np.unique(rows, return_counts=True)
        made = quality.Histogram(values, count // 2, count - count // 2)
        assert np.allclose(made.quantiles(shares), np.quantile(rows, shares), rtol=0, atol=1e-12)
        assert sum(made.upto(0.5)) == (rows <= 0.5).sum()


def test_a_verdict_is_ordered_and_defaults_to_kept():
    one = (quality.Condition("n_words", True, 5.0), quality.Condition("upper_per_char", False, 0.5))
    table = {"n_words": np.array([3, 9, 9]), "upper_per_char": np.array([0.1, 0.1, 0.9])}
    assert quality._all_hold(one, table).tolist() == [False, True, False]


SYLLABLES = {"aa": ["tho", "ing", "wer", "ash"], "bb": ["que", "eau", "oix", "ère"], "cc": ["sch", "ung", "keit", "öß"]}


def tongue(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_languages_of_held_out_texts(spark):
    rng = random.Random(6)
    rows = []
    for k in range(300):
        lang = rng.choice(list(SYLLABLES))
        rows.append((k, tongue(rng, lang, rng.randrange(3, 60)), lang, "s", 0))
    rows += [(900 + k, t, None, "s", 0) for k, t in enumerate(ODD)]
    table = docs(spark, []).unionByName(spark.createDataFrame(rows, docs(spark, []).schema))
    got = {r.doc_id: r for r in language.op2(spark, table).collect()}
    truth = {r[0]: r[2] for r in rows}
    held = [k for k in range(300) if got[k].held_out]
    assert 30 < len(held) < 90
    assert sum(got[k].lang_pred == truth[k] for k in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    none = [900 + k for k, t in enumerate(ODD) if not any(c.isalpha() for c in t or "")]
    assert {k for k, r in got.items() if r.lang_pred == "und"} == set(none)
    assert all(got[k].score == 0 and got[k].rejected for k in none)


def test_far_texts_are_rejected_and_empty_models_answer_und(spark):
    rng = random.Random(7)
    rows = [(k, tongue(rng, "aa", 40), "aa", "s", 0) for k in range(60)]
    table = spark.createDataFrame(rows, docs(spark, []).schema)
    model = language.learn(table)
    named, score, rejected = model.predict(pa.array([tongue(rng, "cc", 40), tongue(rng, "aa", 40)]))
    assert rejected.tolist() == [True, False] and score[0] < score[1] and named == ["aa", "aa"]
    empty = language.op2(spark, table.withColumnRenamed("source", "score").where("false"))
    assert empty.count() == 0
    unlabelled = language.learn(table.where("false"))
    assert unlabelled.predict(pa.array(["abc"]))[0] == ["und"]


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@pytest.mark.parametrize("seed", range(5))
def test_bit_parallel_lcs(seed):
    rng = random.Random(seed)
    a = [rng.randrange(9) for _ in range(rng.randrange(1, 90))]
    b = [rng.randrange(9) for _ in range(rng.randrange(0, 90))]
    assert decontaminate.lcs_length(decontaminate.Item.masks(a), len(a), b) == brute_lcs(a, b)


def test_leaks_and_paraphrases_are_found(spark):
    rng = random.Random(9)
    items = [". ".join(prose(rng, rng.randrange(8, 20), 3000) for _ in range(2)) + "." for _ in range(25)]
    texts, want, clean = list(ODD), {}, set()
    for k in range(150):
        own = prose(rng, rng.randrange(40, 400), 3000)
        if k % 3 == 0:
            j = rng.randrange(len(items))
            said = items[j].split()
            if k % 2:
                for _ in range(len(said) // 8):
                    said[rng.randrange(len(said) - 8)] = "other"
            at = rng.randrange(len(own.split()))
            split = own.split()
            own = " ".join([*split[:at], *said, *split[at:]]).upper().replace("W1", "w1")
            want[len(texts)] = j
        else:
            clean.add(len(texts))
        texts.append(own)
    benchmark = spark.createDataFrame([*enumerate(items), (99, None), (98, "")], "item_id bigint, text string")
    rows = decontaminate.op8(docs(spark, texts), benchmark).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    # Brute force: the words of every place of every text against every item.
    exact = set()
    for d, text in enumerate(texts):
        value = decontaminate.word_hashes(pa.array([text]))[0].tolist()
        for j, item in enumerate(decontaminate._items(list(enumerate(items)), decontaminate.LatentSettings())):
            n = len(item.words)
            spans = (value[k : k + n + n // 4] for k in range(0, max(1, len(value) - n + 1), 3))
            if any(len(set(s) & set(item.words)) > 0.6 * n and brute_lcs(item.words, s) >= 0.8 * n for s in spans):
                exact.add((d, j))
    assert exact >= {(d, j) for d, j in want.items()} or len(exact) >= 0.9 * len(want)
    assert len(exact & found) >= 0.9 * len(exact)
    assert not {d for d, _ in found} & clean
    left = decontaminate.without_leaks(docs(spark, texts), decontaminate.op8(docs(spark, texts), benchmark))
    assert left.count() == len(texts) - len({d for d, _ in found})


def spread(rng, said, kind):
    """An item as a document may hold it: as it is, with words put in, or with words changed."""
    if kind == "changed":
        said = list(said)
        for k in rng.sample(range(len(said)), len(said) // 8):
            said[k] = "other"
        return said
    more = {"verbatim": 0, "one in between": 1, "two in between": 2}[kind]
    return [w for x in said for w in (x, *prose(rng, more, 3000).split())]


def test_recall_past_the_fit_sample(spark):
    """Most documents, and all that hold items, are outside the sample that fits the SVD."""
    rng = random.Random(21)
    kinds = ("verbatim", "one in between", "two in between", "changed")
    items = [". ".join(prose(rng, rng.randrange(12, 24), 3000) for _ in range(2)) + "." for _ in range(20)]
    texts = [prose(rng, rng.randrange(40, 160), 3000) for _ in range(2000)]
    want = {kind: set() for kind in kinds}
    for k in range(160):
        j, kind = k % len(items), kinds[k // len(items) % len(kinds)]
        own = prose(rng, 120, 3000).split()
        at = rng.randrange(len(own))
        want[kind].add((len(texts), j))
        texts.append(" ".join([*own[:at], *spread(rng, items[j].split(), kind), *own[at:]]))
    benchmark = spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")
    settings = decontaminate.LatentSettings(max_fit_docs=60)
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs(spark, texts), benchmark, settings=settings).collect()}
    recall = {kind: len(found & own) / len(own) for kind, own in want.items()}
    # Every planted pair is a leak by construction, so this is recall against an exact search.
    assert all(r >= 0.9 for r in recall.values()), recall
    assert found <= set.union(*want.values())


def test_the_latent_space_is_fitted_on_every_passage(spark):
    """Of 5,400 documents, more than any sample of before, all passages count: the Gram matrix
    of the passages in the space, which is whole where the rank is, has a one for each direction."""
    rng = random.Random(4)
    texts = [*ODD, *(prose(rng, rng.randrange(1, 40), 60) for _ in range(5400 - len(ODD)))]
    settings = decontaminate.LatentSettings(buckets=64, rank=16, oversample=48)
    items = spark.createDataFrame([("w1 w2 w3 w1",), (None,), ("",)], "text string")
    space = decontaminate.fit(docs(spark, texts), settings=settings, items=items)
    # Brute force: all passages as dense rows.
    hashed = [decontaminate._buckets(decontaminate.word_hashes(pa.array([t]))[0], 64) for t in [*texts, "w1 w2 w3 w1"]]
    seen = sum((np.bincount(h, minlength=64) > 0).astype(int) for h in hashed[:-1])
    idf = np.log((1 + len(texts)) / (1 + seen)) + 0.01
    counts = [np.bincount(h[k : k + 24], minlength=64) for h in hashed for k in range(0, len(h), 24)]
    rows = np.array(counts) * idf
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    values, vectors = np.linalg.eigh(rows.T @ rows)
    best = vectors[:, ::-1][:, :16] / np.sqrt(values[::-1][:16])
    got = space.projected / idf[:, None]
    assert np.allclose(got @ got.T, best @ best.T, atol=1e-3 * np.abs(best @ best.T).max())


def test_run_sums_are_sums_of_rows():
    rng = np.random.default_rng(3)
    table = rng.standard_normal((50, 3))
    for sizes in ([1], [5000, 1, 40, 32, 33, 1], list(rng.integers(1, 90, 200))):
        index = rng.integers(0, 50, sum(sizes)).astype("<u2")
        ends = np.cumsum(sizes)
        got = decontaminate.run_sums(table, index, ends - sizes)
        want = [table[index[e - n : e]].sum(axis=0) for e, n in zip(ends, sizes, strict=True)]
        assert np.allclose(got, want)


def test_decontamination_of_empty_tables(spark):
    table = docs(spark, ["some text of a few words here"]).withColumnRenamed("source", "item_id")
    items = spark.createDataFrame([(1, "a b c d e f g h")], "item_id bigint, text string")
    assert decontaminate.op8(table, items.where("false")).count() == 0
    assert decontaminate.op8(table.where("false"), items).count() == 0


def test_the_pipeline_fits_its_space_on_all_that_is_left(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rng = random.Random(2)
    left = docs(spark, [prose(rng, 5) for _ in range(6000)])
    spark.createDataFrame([(1, prose(rng, 30))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    fitted, summed = [], decontaminate._summed
    monkeypatch.setattr(decontaminate, "_summed", lambda rows, *more: fitted.append(rows.count()) or summed(rows, *more))
    corpus_pipeline.decontamination(spark, left, str(tmp_path))
    assert fitted == [6001, 6001]
