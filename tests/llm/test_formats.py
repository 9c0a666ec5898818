from __future__ import annotations

import base64
import hashlib
import html
import itertools
import json
import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import ODD, docs, prose
from pyspark.sql import functions as F

from riskweave.llm import bpe, chat, licenses, sharding, wrappers
from riskweave.llm.common import ship

TOKENIZERS = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tiktoken_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    with open(TOKENIZERS.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=TOKENIZERS.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


MORE = ["<|endoftext|> it's 'RE  x\t\t\ny  ", "é\U0001f468‍\U0001f469 ½²Ⅷ", "\x1c\x85 　x", "q" * 3000]


def test_ids_and_bytes_equal_tiktoken(spark, tiktoken_encoding):
    texts = [*ODD, *MORE]
    got = {r.doc_id: r for r in bpe.op9(docs(spark, texts)).collect()}
    for k, text in enumerate(texts):
        ids = tiktoken_encoding.encode_ordinary(text or "")
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_letters_split_as_tiktoken_does(tiktoken_encoding):
    codec = bpe._codec(bpe.vocabulary_file(), bpe.split_pattern())
    for code in range(0, 0x30000, 5):
        if not 0xD800 <= code < 0xE000:
            text = f"a {chr(code)}{chr(code)}1 {chr(code)}"
            assert codec.encode(text) == tiktoken_encoding.encode_ordinary(text), hex(code)


def test_offsets_and_round_trip(spark):
    texts = ["déjà vu", "\U0001f468‍\U0001f469!", "", None, "plain words"]
    table = docs(spark, texts).withColumnRenamed("source", "encoded")
    made = bpe.encode(table)
    back = bpe.decode(made.select("doc_id", "text", "encoded.*"))
    for r in back.collect():
        text = r.text or ""
        assert bytes(r.decoded).decode() == text
        assert all(0 <= a < b <= len(text) for a, b in zip(r.starts, r.ends, strict=True))
        assert sorted(set(itertools.chain(*map(range, r.starts, r.ends)))) == list(range(len(text)))


def test_split_characters_go_to_the_piece_that_ends_them():
    codec = bpe._codec(bpe.vocabulary_file(), bpe.split_pattern())
    text = "x\U0001f9ffy"
    ids = codec.encode(text)
    pieces = [codec.decode([i]) for i in ids]
    assert any(p.decode("utf-8", "ignore").encode() != p for p in pieces)
    assert "".join(bpe.readable(pieces)) == text
    assert codec.decode([None, -1, 10**9]) == b"" and bpe.readable([]) == []


def test_long_pieces_are_not_remembered():
    known = bpe._Known(lambda piece: (len(piece),))
    assert [known[p] for p in ("a" * 5000, "ab", "ab")] == [(5000,), (2,), (2,)]
    assert list(known) == ["ab"]


def test_bpe_of_an_empty_table(spark):
    assert bpe.op9(docs(spark, ["x"]).where("false")).count() == 0


# --- sharding ---------------------------------------------------------------------------


@pytest.mark.parametrize("bits, width", [(1, 2), (3, 2), (2, 3), (4, 3), (2, 4)])
def test_hilbert_curve_visits_neighbours(bits, width):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=width)))
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("n", [0, 1, 7, 40, 123])
def test_shards_are_even_and_gapless(spark, n):
    texts = (ODD * 13)[:n]
    rows = sharding.op4(docs(spark, texts).withColumnRenamed("n_chars", "shard")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(n))
    slots = {k: sorted(r.slot for r in rows if r.shard == k) for k in range(40)}
    assert all(own == list(range(len(own))) for own in slots.values())
    assert sum(map(len, slots.values())) == n
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.law, r.grown_shard) == (len(data) + 16, "rows", None)
        assert r.text_crc32 == zlib.crc32(data)
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in order] == sorted(r.hilbert for r in rows)


def test_equal_rows_all_get_a_slot(spark):
    table = docs(spark, [(1, "same")] * 50 + [(None, None)] * 5)
    rows = sharding.op4(table).collect()
    assert len(rows) == 55 and len({(r.shard, r.slot) for r in rows}) == 55


def test_files_are_pruned_by_several_dimensions(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k, "t", rng.choice("abcd"), f"s{rng.randrange(8)}", rng.randrange(1000)) for k in range(800)]
    table = spark.createDataFrame(rows, docs(spark, []).schema)
    manifest = sharding.write_shards(table, str(tmp_path / "out"), ("lang", "source", "n_chars")).cache()
    assert manifest.agg({"n_rows": "sum"}).first()[0] == 800
    for ranges in ({"lang": ("b", "b")}, {"source": ("s1", "s2")}, {"n_chars": (100, 200)}):
        assert sharding.shards_for(manifest, **ranges).count() < 36
    both = sharding.shards_for(manifest, lang=("b", "b"), source=("s1", "s1"))
    kept = {r.shard for r in both.collect()}
    where = spark.read.parquet(str(tmp_path / "out")).where("lang = 'b' and source = 's1'")
    assert {r.shard for r in where.select("shard").distinct().collect()} <= kept


def test_texts_with_a_long_common_start_spread_over_the_curve(spark):
    rows = [(k, "t", "en", f"https://host{k % 50}.example/x", 1) for k in range(800)]
    made = sharding.shard(spark.createDataFrame(rows, docs(spark, []).schema), ["source"], ("source", "lang"))
    held = made.groupBy("source").agg({"shard": "max", "*": "count"}).collect()
    assert made.select("hilbert").distinct().count() >= 25 and {r["count(1)"] for r in held} == {16}


def test_dimensions_of_any_type_and_nulls(spark):
    rows = [
        (k, None if k % 7 == 0 else [float("nan"), float("inf"), -1.5, k / 3][k % 4], k % 5 == 0, f"2024-01-{1 + k % 28:02d}")
        for k in range(90)
    ]
    table = spark.createDataFrame(rows, "k bigint, x double, flag boolean, day string")
    table = table.selectExpr("k", "x", "flag", "cast(day as date) day", "cast(x as decimal(20, 3)) is null odd",
                             "cast(day as timestamp) at", "cast(k as decimal(9, 2)) amount")
    for names in (("x", "flag", "day"), ("at", "amount", "odd")):
        got = sharding.shard(table, ["k"], names, shards=8).collect()
        assert sorted(r.k for r in got) == list(range(90))
        assert len({(r.shard, r.slot) for r in got}) == 90 and len({r.hilbert for r in got}) > 10


# --- licences ---------------------------------------------------------------------------


def test_whole_texts_blocks_and_lines(spark):
    mit = licenses.TEXTS[0][1]
    texts = [
        mit.replace("<year> <holder>", "1999 Someone Else").upper(),
        mit.replace("\n", " \n  ").replace("sublicense", "sub-license"),
        f"Words before\n\n{licenses.TEXTS[1][1]}\n\nwords after",
        "GNU GENERAL PUBLIC LICENCE v3.0",
        "text\nReleased under the MIT licence.\nReleased under the MIT License\nmore",
        "Released under the MIT License, or so they say",
        *ODD,
    ]
    rows = {r.doc_id: r for r in licenses.op10(docs(spark, texts).withColumnRenamed("lang", "licenses")).collect()}
    assert [rows[k].text_license for k in range(6)] == ["MIT", "MIT", None, "GPL-3.0", None, None]
    assert [rows[k].licenses for k in range(6)] == ["MIT", "MIT", "ISC", "GPL-3.0", "MIT", ""]
    assert rows[4].n_license_lines == 2
    assert all(rows[k].licenses == "" and rows[k].text_license is None for k in range(6, len(texts)))


def test_notices_with_ids_short_names_and_whole_texts(spark):
    said = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under Apache-2.0": "Apache-2.0",
        "License: GPL-3.0": "GPL-3.0",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
        "Released under the GPLv3 or later.": "GPL-3.0",
        "All rights reserved.": "All-Rights-Reserved",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Released under the MIT License.": "MIT",
        "This project is licensed under the MIT License - see the [LICENSE](LICENSE) file for details.": "",
        "This project is licensed under the MIT License - see the LICENSE file for details.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Available under CC0": "CC0-1.0",
        "MIT": "",
    }
    texts = {f"Some text.\n{line}\nMore of it.": name for line, name in said.items()}
    header = next(t for i, t in licenses.HEADERS if i == "Apache-2.0" and "file" in t)
    texts |= {f"# code\n\n// {header}\n\nimport x": "Apache-2.0"}
    files = sorted(licenses.TEXT_FOLDER.glob("*.txt"))
    texts |= {f"Copyright 2001 Someone\n\n{f.read_text()}": f.stem for f in files}
    rows = {r.doc_id: r for r in licenses.op10(docs(spark, list(texts))).collect()}
    got = [rows[k].licenses for k in range(len(texts))]
    assert got[: -len(files)] == list(texts.values())[: -len(files)]
    assert [rows[k].text_license for k in range(len(texts) - len(files), len(texts))] == [f.stem for f in files]
    assert licenses.anchors([r.form for r in licenses.digests(licenses.known_licenses(spark)).collect()])


def test_license_rows_that_repeat(spark):
    rows = [(3, "Released under the MIT License.")] * 3 + [(3, "else"), (None, "ISC License")]
    got = licenses.op10(docs(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.licenses, r.n_license_lines) for r in got) == [
        (-1, "ISC", 1), (3, "", 0), (3, "MIT", 1), (3, "MIT", 1), (3, "MIT", 1),
    ]
    assert licenses.op10(docs(spark, rows).where("false")).count() == 0


def test_a_long_known_list_is_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_KNOWN", 0)
    got = licenses.op10(docs(spark, ["ISC License", "no"])).collect()
    assert sorted((r.doc_id, r.licenses) for r in got) == [(0, "ISC"), (1, "")]


# --- pages ------------------------------------------------------------------------------


def page(title, paragraphs, around=True):
    body = "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)
    extra = (
        "<header>Site</header><nav><ul><li><a href='/x'>Menu</a></li></ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><aside>Side</aside>"
        if around else ""
    )
    after = (
        "<section id=comments><p>First!</p></section><form><p>Write</p><input></form>"
        "<div class=\"ad box\">Buy</div><footer>End</footer>" if around else ""
    )
    return f"<html><head><title>{title}</title><script>var a='<p>no</p>'</script></head><body>{extra}<article><h1>{title}</h1>{body}{after if around else ''}</article>{after}</body></html>"


def test_articles_without_what_stands_around(spark):
    ship(spark)
    rows = [
        (k, f"https://h{k % 2}.example/{k}", page(f"T{k}", [f"one & {k}", "two  \n three"]), "x") for k in range(6)
    ]
    rows += [(90, None, None, "x"), (91, "nonsense", "", "x"), (92, "http://z/", "bare &lt;text&gt", "x")]
    rows += [(93, "https://h0.example/cut", "<article><p>cut &amp; o<p>pen<b", "x")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = {r.page_id: r for r in wrappers.op6(spark, table).collect()}
    for k in range(6):
        assert got[k].text == f"T{k}\none & {k}\ntwo three"
    assert [got[k].text for k in (90, 91, 92, 93)] == ["", "", "bare <text>", "cut & o\npen"]
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert wrappers.op6(spark, table.where("false")).count() == 0


def test_without_an_article_constant_texts_are_template(spark):
    ship(spark)
    rows = [
        (k, f"https://plain.example/{k}", f"<body><div>Always here</div><p>Own {k}</p><p>More {k}</p></body>")
        for k in range(5)
    ]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrappers.op6(spark, table).collect()}
    assert got == {k: f"Own {k}\nMore {k}" for k in range(5)}


def test_a_host_with_and_without_articles(spark):
    ship(spark)
    rows = [(k, f"https://both.example/{k}", page(f"T{k}", [f"one {k}"])) for k in range(4)]
    rows += [
        (k, f"https://both.example/{k}", f"<body><section>Always here</section><div><p>Own {k}</p></div></body>")
        for k in range(10, 14)
    ]
    # Only pages with an article hold this text between others; it says nothing of the second kind.
    rows += [(20, "https://both.example/20", "<body><div><p>Ad</p></div><article><p>in</p></article></body>")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrappers.op6(spark, table).collect()}
    assert got == {k: f"T{k}\none {k}" for k in range(4)} | {k: f"Own {k}" for k in range(10, 14)} | {20: "in"}


def test_places_of_rare_streams_are_judged_by_all_pages(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "STREAMS_PER_HOST", 1)
    ship(spark)
    shapes = ["", "<h2>A {k}</h2>", "<pre>B {k}</pre>", "<p>" + "</p><p>".join(["x{k}"] * 3) + "</p>"]
    rows = [
        (k, f"https://rare.example/{k}", f"<body><div>{k}</div>{shapes[k % 4].format(k=k)}<ul><li>Always</li></ul></body>")
        for k in range(12)
    ]
    # One page is longer than the streams that make the wrapper, and its end is template.
    rows += [(90, "https://rare.example/90", "<body>" + "<div>own</div><h3>text</h3>" * 1500 + "<ul><li>Always</li></ul></body>")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrappers.op6(spark, table).collect()}
    assert got[0] == "0" and got[1] == "1\nA 1" and got[2] == "2\nB 2"
    assert not any("Always" in text for text in got.values())


def test_article_text_with_names_like_parts_stays(spark):
    ship(spark)
    kept = ("share-price", "ad-hoc", "post-header", "social-history", "search-results-explained", "reply-all-email")
    gone = ("ad", "ad box", "related-posts", "comment-list", "share buttons", "cookie-notice", "newsletter-signup", "ad-3")
    body = "".join(f"<p class='{c}'>{c}</p>" for c in kept) + "".join(f"<div class='{c}'>{c}</div>" for c in gone)
    rows = [(0, "https://a.example/0", f"<article><h2 class=post-header>Head</h2>{body}<div class='post-header'>By</div></article>")]
    rows += [(1, "https://b.example/1", "<body><p class='share-price'>plain</p><div class='left menu-x'>no</div></body>")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrappers.op6(spark, table).collect()}
    assert got == {0: "\n".join(["Head", *kept, "By"]), 1: "plain"}


def test_deep_pages_take_bounded_space():
    deep = 30_000
    found, _ = wrappers.blocks("<div>a" * deep + "<article><p>in<aside>no</aside></p></article>" + "</div>" * deep)
    assert len(found) == deep + 2 and max(len(b.path) for b in found) < 600
    (inside,) = [b for b in found if b.text == "in"]
    (aside,) = [b for b in found if b.text == "no"]
    assert wrappers.in_article(inside.path) and not wrappers.is_boilerplate(inside.path)
    assert wrappers.is_boilerplate(aside.path)
    assert len({b.path for b in found if b.text == "a"}) == deep
    assert wrappers.main_text("<div>" * deep + "<article><p>in<nav>no</nav></article>", {}) == "in"


def parsed(pattern):
    """The nodes of a wrapper's expression."""
    tokens, levels = re.findall(r"<[^>]*>|#|\(|\)[?+]", pattern), [[]]
    assert "".join(tokens) == pattern
    for token in tokens:
        if token == "(":
            levels.append([])
        elif token[0] == ")":
            body = levels.pop()
            levels[-1].append((token[1], body))
        else:
            levels[-1].append(token)
    return levels[0]


def ends(nodes, stream, starts):
    """Where a match of the nodes that begins at one of the places may end."""
    for node in nodes:
        if isinstance(node, str):
            starts = {k + 1 for k in starts if k < len(stream) and stream[k] == node}
            continue
        kind, body = node
        reached = starts if kind == "?" else set()
        new = ends(body, stream, starts)
        while kind == "+" and not new <= reached:
            reached, new = reached | new, ends(body, stream, new - reached)
        starts = reached | new
    return starts


def varied_page(rng):
    pieces = ("<p>t</p>", "<ul><li>a</li><li>b</li></ul>", "<div><h2>h</h2></div>", "<section><p>s</p></section>", "<pre>c</pre>")
    around = rng.choice(("", "<nav><p>n</p></nav>", "<aside>x</aside>"))
    body = "".join(rng.choice(pieces) for _ in range(rng.randrange(9)))
    return f"<body>{around}<{rng.choice(('article', 'div'))}>{body}</body>"


def test_the_wrapper_matches_every_page_of_its_host(spark, monkeypatch):
    """However many distinct streams a host has and however long they are, in parts and rounds."""
    monkeypatch.setattr(wrappers, "ALIGNED", 4)
    ship(spark)
    rng = random.Random(8)
    pages = [varied_page(rng) for _ in range(90)]
    # Nothing in its end repeats at once, so it stays long, and no other page has it.
    pages.append("<body><article>" + "".join(f"<{t}>x</{t}>" for t in rng.choices(("p", "div", "pre", "dl"), k=3000)) + "<table>end</table>")
    rows = [(k, "https://many.example/", p) for k, p in enumerate(pages)] + [(900, "https://one.example/", "<p>a</p>")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.host: r for r in wrappers.wrappers(table).collect()}
    assert got["one.example"].wrapper == "<p>#</p>"
    nodes, known = parsed(got["many.example"].wrapper), json.loads(got["many.example"].labels)
    streams = [wrappers.blocks(p) for p in pages]
    assert len({json.dumps(wrappers.fold(s)) for _, s in streams}) > 64
    assert all(len(s) in ends(nodes, s, {0}) for _, s in streams)
    paths = {b.path for found, _ in streams for b in found}
    assert paths == wrappers.slot_paths(nodes) == set(known)


def brute_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = list(itertools.accumulate(range(len(b)), lambda last, k: max(last, row[k + 1], row[k] + (x == b[k])), initial=0))
    return row[-1]


def test_common_is_a_longest_common_subsequence(monkeypatch):
    rng = random.Random(5)
    for kept in (1 << 28, 20):
        monkeypatch.setattr(wrappers, "KEPT_CELLS", kept)
        for _ in range(150):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(30))] for _ in range(2))
            pairs = wrappers.common(a, b)
            assert all(a[i] == b[j] for i, j in pairs)
            assert all(i < x and j < y for (i, j), (x, y) in zip(pairs, pairs[1:]))
            assert len(pairs) == brute_common(a, b)


def test_wrappers_are_union_free_expressions():
    _, a = wrappers.blocks("<nav><li>x</li><li>y</li></nav><article><p>a</p><p>b</p></article>")
    _, b = wrappers.blocks("<nav><li>x</li></nav><div>ad</div><article><p>c</p></article>")
    made = wrappers.infer([a, b])
    assert wrappers.pattern(made) == "<nav>(<li>#</li>)+</nav>(<div>#</div>)?<article>(<p>#</p>)+</article>"
    assert wrappers.labels(made, set()) == {"nav/li": False, "div": False, "article/p": True}
    assert wrappers.infer([["<p>", "#", "</p>"]] * 3) == ["<p>", "#", "</p>"]


# --- chats ------------------------------------------------------------------------------


def brute_paths(model, codes):
    """Best score over all paths of a short sequence."""
    best = (-np.inf, None)
    for path in itertools.product(range(chat.STATES), repeat=len(codes)):
        score = model.start[path[0]] + model.emit[path[0], codes[0]]
        score += sum(model.step[a, b] + model.emit[b, c] for a, b, c in zip(path, path[1:], codes[1:], strict=False))
        best = max(best, (score, path))
    return best


def random_model(seed):
    rng = np.random.default_rng(seed)
    return chat.RoleModel(
        *(np.log(rng.dirichlet(np.ones(n), size)) for size, n in ((None, 6), (6, 6), (6, chat.CODES)))
    )


@pytest.mark.parametrize("seed", range(3))
def test_viterbi_equals_all_paths(seed):
    model = random_model(seed)
    codes = np.random.default_rng(seed).integers(0, 40, 6)
    ends = model.opening(codes)[0]
    path = model.decode(codes, -1, int(ends.argmax()))
    assert tuple(path) == brute_paths(model, codes)[1]


def test_blocks_join_to_the_same_path():
    model = random_model(7)
    codes = np.random.default_rng(7).integers(0, 300, 60)
    whole = model.decode(codes, -1, int(model.opening(codes)[0].argmax()))
    score, back = model.opening(codes[:20])[0], []
    for part in (codes[20:45], codes[45:]):
        ways = score[:, None] + model.matrix(part)
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    ends = [int(score.argmax())]
    for choice in reversed(back):
        ends.append(int(choice[ends[-1]]))
    ends.reverse()
    parts = [codes[:20], codes[20:45], codes[45:]]
    cut = [model.decode(p, b, e) for p, b, e in zip(parts, [-1, *ends], ends, strict=False)]
    assert np.concatenate(cut).tolist() == whole.tolist()


def conversations(spark, n=120, hot=0):
    ship(spark)
    rng = random.Random(3)
    rows = []
    for c in range(n):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rng.randrange(1, 4)
        rows += [(c, t, r, "\n".join(prose(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 4)))) for t, r in enumerate(roles)]
    rows += [(7000, t, ("user", "assistant")[t % 2], prose(rng, 5)) for t in range(hot)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_roles_are_recovered(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_BITS", 5)
    table = conversations(spark, hot=400)
    truth = {(r.conv_id, r.turn): r.role for r in table.collect()}
    rows = chat.op7(spark, table).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and held
    assert sum(r.role_pred == truth[r.conv_id, r.turn] for r in held) >= 0.95 * len(held)
    # Bounds are found, not given: one turn begins in every row, with its first line.
    assert sum(r.opens and r.n_turns == 1 for r in held) >= 0.95 * len(held)
    one = next(r for r in rows if r.opens and r.n_turns == 1)
    assert one.rendered.startswith(f"<|{one.role_pred}|>\n") and one.rendered.endswith("\n<|end|>")


def test_turns_inside_one_text_are_recovered(spark):
    rows = chat.transcripts(conversations(spark)).select("conv_id", "turn", "role", "raw")
    rng = random.Random(5)
    whole, truth = [], {}
    for c in range(9000, 9030):
        turns = [(("user", "assistant")[t % 2], rng.randrange(1, 4)) for t in range(rng.randrange(2, 7))]
        marks = {"user": "User: ", "assistant": "Assistant: "}
        lines = [marks[r] * (k == 0) + prose(rng, 8) for r, n in turns for k in range(n)]
        whole.append((c, 0, None, "\n".join(lines)))
        truth[c] = turns
    table = rows.unionByName(spark.createDataFrame(whole, rows.schema))
    made = chat.format_chats(spark, table, train=F.col("conv_id") < 9000)
    got = {r.conv_id: r for r in made.where("conv_id >= 9000").collect()}
    for c, turns in truth.items():
        said = [piece.split("|>\n", 1) for piece in got[c].rendered.split("<|end|>") if piece.strip()]
        assert [(role.strip().removeprefix("<|"), len(text.strip().split("\n"))) for role, text in said] == turns
        assert got[c].n_turns == len(turns)


def test_pieces_may_be_cut_anywhere(spark):
    """The same transcripts in pieces of other lengths give the same turns."""
    turns = chat.transcripts(conversations(spark, 60)).select("conv_id", "turn", "role", "raw")
    lines = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        lines.setdefault(r.conv_id, []).extend(r.raw.split("\n"))

    def rendered(step):
        cut = [(9000 + c, k, None, "\n".join(own[k : k + step])) for c, own in lines.items() for k in range(0, len(own), step)]
        table = turns.unionByName(spark.createDataFrame(cut, turns.schema))
        out = {}
        made = chat.format_chats(spark, table, train=F.col("conv_id") < 9000).where("conv_id >= 9000")
        for r in sorted(made.collect(), key=lambda r: (r.conv_id, r.turn)):
            out[r.conv_id] = [*out.get(r.conv_id, []), *r.rendered.replace("<|end|>", "").split("\n")]
        return {c: [x for x in own if x] for c, own in out.items()}

    assert rendered(2) == rendered(1000)


def test_marks_stay_inside_a_turn(spark):
    states = F.array(F.lit(2), F.lit(3), F.lit(3), F.lit(4))
    raw = F.lit("User: list\n- first\nAnswer: 4\n- done")
    row = spark.range(1).select(chat.render(raw, states)).first()
    assert row.rendered == "<|user|>\nlist\n- first\nAnswer: 4<|end|>\n<|assistant|>\ndone\n<|end|>"


def test_chats_with_odd_rows(spark):
    table = conversations(spark, 40)
    odd = spark.createDataFrame(
        [(None, None, None, None), (None, 1, "user", ""), (500, 1, "tool", "x"), (500, 1, "tool", "x"), (501, 0, "user", "y\n" * 3000)],
        table.schema,
    )
    rows = chat.op7(spark, table.unionByName(odd).withColumn("rendered", F.lit("z"))).collect()
    assert len(rows) == table.count() + 5
    assert all(r.role_pred in chat.ROLES and r.rendered is not None for r in rows)
    assert chat.op7(spark, table.where("false")).count() == 0
