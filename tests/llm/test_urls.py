"""URL rules against a plain loop over all rules, by the trie and by the join."""

import pytest

from tripmetrics.llm.urls import ALLOW, BLOCK, RULES, Trie, allowed, host_and_path, judge

LISTED = [
    ("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK), ("WWW.b.org", "", BLOCK), ("b.org", "/x", ALLOW),
    ("org", "/x/long", BLOCK), ("org", "/x/long", ALLOW), (None, "/everywhere", BLOCK), ("c.d", None, BLOCK),
    ("a.b", "/1", BLOCK), ("b", "/1/2", ALLOW), ("skip.me", "/", "maybe"), ("e.e", "/p?q", BLOCK),
]
URLS = [
    None, "", "no scheme", "://", "http://", "http://example.com", "http://EXAMPLE.com/", "x://www.example.com/en/1?a#b",
    "http://example.com/en", "http://example.com/en/", "http://m.example.com/en/a/b", "http://notexample.com/en/a",
    "http://x.net/es/", "http://x.net/ES/", "http://net/fr/1", "http://www.b.org?x", "http://b.org/xyz", "http://b.org/x/long/er",
    "http://q.org/x/longer", "http://q.org/x/lon", "ftp://a/everywhere/1", "http://c.d", "http://z.c.d:80/", "http://c.d/a",
    "http://a.b/1/2", "http://a.b/1", "http://a.b/1/3", "http://skip.me/", "http://e.e/p?q", "http://..com//", "http://com.",
    "http://u/a?b://c/d", "http://\n.com/\n/x", "http://x.com/" + "/".join("abc" * 2000),
]


def plain(url, rules=LISTED, default=ALLOW):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end], rest[end:].split("?")[0].split("#")[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, verdict in rules:
        h, p = (h or "").lower(), p or ""
        fits = not h or host == h or host.endswith("." + h)
        if verdict in (ALLOW, BLOCK) and fits and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), h + p, verdict))
    return host, path, *(best[2:] if best else (None, default))


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(LISTED, RULES)


@pytest.mark.parametrize("trie_bytes", [1 << 20, 0])
def test_against_all_rules(spark, rules, trie_bytes):
    rows = [(i if i % 7 else None, url, "?", "?") for i, url in enumerate([*URLS, *URLS])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, host string").repartition(3)
    found = judge(pages, rules, trie_bytes=trie_bytes)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    expected = [(page_id, url, *plain(url)) for page_id, url, *_ in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_random_rules(spark, dice):
    def host():
        return ".".join(dice.choice("abc") for _ in range(dice.randint(1, 4)))

    def path(most):
        return "".join(dice.choice("/xy") for _ in range(dice.randint(0, most)))

    listed = [(host(), ("/" + path(4)) if dice.random() < 0.8 else "", dice.choice([ALLOW, BLOCK])) for _ in range(60)]
    listed = [(h, p, max(v for a, b, v in listed if (a, b) == (h, p))) for h, p, _ in listed]
    trie = Trie.of(listed)
    urls = [(host(), "/" + path(8)) for _ in range(400)]
    for h, p in urls:
        rule, verdict = trie.longest(h, p)
        assert (rule, verdict or "none") == plain(f"s://{h}{p}", listed, "none")[2:]
    pages = spark.createDataFrame([(f"s://{h}{p}",) for h, p in urls], "url string")
    known = spark.createDataFrame(listed, RULES)
    by_join = judge(pages, known, trie_bytes=0)
    assert by_join.exceptAll(judge(pages, known)).count() == 0 and by_join.count() == 400


def test_kept_rows_have_their_columns(spark, rules):
    pages = spark.createDataFrame([(1, "http://x.net/es/1", "k"), (2, "http://x.net/1", "k")], "page_id int, url string, verdict string")
    assert [tuple(r) for r in allowed(pages, rules).collect()] == [(2, "http://x.net/1", "k")]
    assert allowed(pages, rules, BLOCK).count() == 0


@pytest.mark.parametrize("trie_bytes", [1 << 20, 0])
def test_nothing_to_judge_or_to_judge_by(spark, rules, trie_bytes):
    pages = spark.createDataFrame([(1, "http://x.net/es/1")], "page_id int, url string")
    assert judge(pages.limit(0), rules, trie_bytes=trie_bytes).count() == 0
    row = judge(pages, rules.limit(0), BLOCK, trie_bytes=trie_bytes).first()
    assert (row.rule, row.verdict, row.host, row.path) == (None, BLOCK, "x.net", "/es/1")
