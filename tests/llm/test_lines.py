import hashlib
import math
import random

import pytest
from odd_texts import ODD_TEXTS

from millrace.llm import lines


def boiler(votes, ratio, small):
    """Lines of each host on more votes than the ratio allows; ``votes``: host -> vote -> lines."""
    out = {}
    for host, each in votes.items():
        count = {}
        for some in each.values():
            for x in some:
                count[x] = count.get(x, 0) + 1
        out[host] = {x for x, c in count.items() if c > max(ratio * len(each), small * math.sqrt(len(each)))}
    return out


def brute(rows, ratio=lines.RATIO, small=lines.SMALL, most_share=0.5):
    pages = {}
    for h, t in rows:
        if t is not None:
            pages.setdefault(h, {})[t] = {y.strip(" ") for y in t.split("\n")} - {""}
    first = boiler(pages, ratio, small)
    votes = {}
    for h, each in pages.items():
        votes[h] = {}
        for t, some in each.items():
            mine = some & first[h]
            vote = t
            if sum(map(len, mine)) > most_share * sum(map(len, some)):
                vote = (max(mine, key=lambda x: (len(x), hashlib.md5(x.encode()).hexdigest()[:16])),)
            votes[h].setdefault(vote, set()).update(mine)
    bad = boiler(votes, ratio, small)
    out = []
    for h, t in rows:
        every = (t or "").split("\n")
        stays = [x for x in every if x.strip(" ") not in bad.get(h, ()) or not x.strip(" ")]
        lost = len(every) - len(stays)
        out.append((h, t if t is None or not lost else "\n".join(stays), 0 if t is None else len(every), lost))
    return sorted(out, key=repr)


def found(spark, rows, **limits):
    df = spark.createDataFrame(rows, "source string, text string").selectExpr("*", "'x' host", "1 n_lines", "2 page", "3 boiler", "4 vote")
    got = lines.drop_lines(df, **limits)
    assert got.columns == ["source", "text", "host", "page", "boiler", "vote", "n_lines", "n_dropped"]
    return sorted(((r["source"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"ratio": 0.2, "small": 0.5, "most_share": 0.8}])
def test_random_sites(spark, limits):
    rng = random.Random(4)
    rows = []
    for host, n in (("big", 200), ("small", 25), ("tiny", 5), ("pair", 2), (None, 40)):
        for _ in range(n):
            body = [f"line {rng.randrange(2000)} of the page with text" for _ in range(rng.randrange(1, 6))]
            for extra in ("Menu", "  Terms of use ", "", "Cookies  ", "A rather long notice that is longer than the lines of the page"):
                if rng.random() < 0.4:
                    body.insert(rng.randrange(len(body) + 1), extra)
            rows.append((host, "\n".join(body)))
    rows += [("big", None), ("big", ""), ("big", "Menu"), ("big", "Menu\nTerms of use")] + [("big", "same page\nas ever")] * 60
    got = found(spark, rows, **limits)
    assert got == brute(rows, **limits)
    assert any(r[3] for r in got)


def copies(rng, n, edited=0.2):
    """Near copies of one long page: each has some lines of its own."""
    page = [f"sentence {k} of the one page that was copied so often, {'word ' * (k % 7)}" for k in range(20)]
    return ["\n".join(f"{x} edit {rng.random()}" if rng.random() < edited else x for x in page) for _ in range(n)]


def test_near_copies_keep_their_lines(spark):
    rng = random.Random(6)
    rows = [("h", t + "\nHome | About | Contact") for t in copies(rng, 150)]
    rows += [("h", f"an article of its own {rng.random()}\nwith more words {rng.random()}\nHome | About | Contact") for _ in range(250)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert all(r[3] == 1 for r in got)  # the menu goes from every page, and nothing else from any


def test_short_pages_and_small_hosts_lose_their_boilerplate(spark):
    notice = "All rights reserved, read the terms before you go on with this page"
    rows = [("s", f"{notice}\nshort {k}") for k in range(2)] + [("s", f"a page of its own, number {k}, that says rather more than {'word ' * 12}\n{notice}") for k in range(8)]
    rows += [("two", f"{notice}\n{k}") for k in range(2)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert [r[3] for r in got if r[0] == "s"] == [1] * 10 and [r[3] for r in got if r[0] == "two"] == [0, 0]


def test_odd_rows(spark, odd_docs, no_docs):
    got = lines.drop_lines(odd_docs, small=0.0, ratio=0.0)
    assert got.count() == len(ODD_TEXTS)
    assert got.where("text is null").count() == 1
    assert lines.drop_lines(no_docs).count() == 0
