"""The automaton against regular expressions, and the URL contract on small cases."""

import random
import re

from sporelight.llm import urlfilter as U


def _regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + ".", i + 1
        else:
            out, i = out + re.escape(glob[i]), i + 1
    return re.compile(out, re.S)


def test_automaton_equals_regular_expressions():
    rng = random.Random(5)
    globs = ["".join(rng.choice(["a", "b", "/", ".", "*", "**", "?", "ab"]) for _ in range(rng.randint(1, 12))) for _ in range(120)]
    texts = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 14))) for _ in range(300)] + [""]
    automaton = U.Automaton(globs)
    assert automaton.words > 2
    got = automaton.match([t.encode() for t in texts])
    for g, glob in enumerate(globs):
        r = _regex(glob)
        assert [bool(r.fullmatch(t)) for t in texts] == got[:, g].tolist(), glob


def test_contract_cases(spark):
    urls = {1: "http://A.Example.ORG/es/x?q#z", 2: "https://example.org/en/17", 3: "https://example.org/en/2", 4: "http://notexample.org", 5: "http://x.com/fr/a", 6: "http://com/de/", 7: None, 8: "no scheme", 9: "://", 10: "http://www.net/x.com/fr/", 11: "http://h.net/login?x", 12: "http://h.net?x/login", 13: "http://ÉA.net/" + "a" * 20000, 14: "http://badorg/x"}
    df = spark.createDataFrame([(k, v, "h", "p") for k, v in urls.items()] + [(1, urls[1], "h", "p")], "page_id long, url string, host string, rule string")
    rows = U.filter_urls(df).collect()
    assert len(rows) == len(urls) + 1
    got = {r.page_id: (r.host, r.path[:9], r.rule, r.verdict) for r in rows}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/17", "example.org/en/1", "block")
    assert got[3] == ("example.org", "/en/2", "org/", "allow")
    assert got[4] == ("notexample.org", "", None, "allow")
    assert got[5][2:] == ("com/fr/", "allow") and got[6][2:] == ("com/de/", "block")
    assert got[7] == got[8] == got[9] == ("", "", None, "allow")
    assert got[10] == ("www.net", "/x.com/fr", None, "allow")
    assert got[11][2:] == (None, "block") and got[12] == ("h.net", "", None, "allow")
    assert got[13][0] == "Éa.net" and got[14][2:] == (None, "allow")
    assert U.filter_urls(df.limit(0)).count() == 0
