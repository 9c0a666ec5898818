"""Page order by cursors, against following them one by one."""

from __future__ import annotations

import json
import random

import pytest

from riskweave.sources.feeds import FEEDS
from riskweave.sources.page_chain import numbered_pages, page_chain

FEED = FEEDS["bank-a"]
SCHEMA = "delivery string, cursor string, body string"


def page(cursor, following, delivery="d", ids=()):
    body = {"transactions": [{"tx_id": i} for i in ids]}
    if following is not None:
        body["next_cursor"] = following
    return (delivery, cursor, json.dumps(body))


def found(spark, pages):
    made = page_chain(spark.createDataFrame(pages, SCHEMA), FEED).collect()
    assert len(made) == len({(r.delivery, r.cursor, r.problem) for r in made})
    return {(r.delivery, r.cursor): (r.position, r.problem) for r in made}


def followed(links, delivery):
    """What a client that asks page after page finds."""
    places, cursor = {}, ""
    while cursor in links and cursor not in places:
        places[cursor] = len(places)
        cursor = links[cursor] or None
    out = {}
    for c, following in links.items():
        at, problem = places.get(c), None
        if at is None:
            problem = "not on the chain"
        elif following and following not in links:
            problem = "next page missing"
        elif following and places[following] <= at:
            problem = "loops back"
        out[delivery, c] = (at, problem)
    if "" not in links:
        out[delivery, ""] = (None, "first page missing")
    return out


def test_random_graphs_equal_following_the_cursors(spark):
    rng = random.Random(3)
    pages, want = [], {}
    for d in range(25):
        n = rng.choice([1, 2, 3, 9, 33])
        names = ["", *rng.sample([f"c{k}" for k in range(200)], n - 1)]
        links = dict(zip(names, [*names[1:], ""], strict=True))
        for _ in range(rng.choice([0, 0, 1, 3])):
            links[rng.choice(names)] = rng.choice([*names[1:], "lost", "x"])
        if rng.random() < 0.3:
            links.pop(rng.choice(names))
        if not links:
            continue
        pages += [page(c, f, f"d{d}") for c, f in links.items() for _ in range(rng.choice([1, 1, 2]))]
        want |= followed(links, f"d{d}")
    rng.shuffle(pages)
    assert found(spark, pages) == want


def test_long_chain_and_unreadable_and_forked_pages(spark):
    names = ["", *[f"{k * 7919 % 1000:03}" for k in range(1, 700)]]
    whole = [page(c, f, "whole") for c, f in zip(names, [*names[1:], None], strict=True)]
    broken = [page(None, "a", "cut"), ("cut", "a", "{bad"), page("b", "", "cut")]
    forked = [page("", "b", "fork"), page("", "a", "fork"), page("a", "", "fork"), page("b", "", "fork")]
    healed = [("again", "", "{bad"), page("", "a", "again"), page("a", "", "again")]
    got = found(spark, whole + broken + forked + healed)
    assert [got["whole", c] for c in names] == [(k, None) for k in range(700)]
    assert [got["cut", c] for c in ("", "a", "b")] == [(0, None), (1, "unreadable page"), (None, "not on the chain")]
    assert [got["fork", c] for c in ("", "a", "b")] == [(0, "two next pages"), (1, None), (None, "not on the chain")]
    assert [got["again", c] for c in ("", "a")] == [(0, None), (1, None)]


@pytest.mark.parametrize("pages", [[], [page("x", "y")], [page("", "")], [page("", "x")], [page(None, None)]])
def test_smallest_deliveries(spark, pages):
    got = found(spark, pages)
    want = {
        0: {},
        1: {("d", "x"): (None, "not on the chain"), ("d", ""): (None, "first page missing")},
    }
    if not pages:
        assert got == want[0]
    elif pages[0][1] == "x":
        assert got == want[1]
    else:
        assert got == {("d", ""): (0, "next page missing" if '"x"' in pages[0][2] else None)}


def test_pages_are_numbered_by_the_chain(spark):
    pages = [page("q", "m"), page(None, "z"), page("m", None), page("z", "q"), page("lost", "x")]
    made = numbered_pages(spark.createDataFrame(pages, SCHEMA), FEED).orderBy("page_no").collect()
    assert [(r.page_no, json.loads(r.body).get("next_cursor")) for r in made] == [(0, "z"), (1, "q"), (2, "m"), (3, None)]
