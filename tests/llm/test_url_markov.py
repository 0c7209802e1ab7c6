import random

from seqloom.llm import url_markov as U

CASES = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://A.EXAMPLE.net/en/1?q#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/en/", "example.net", "/en/", "example.net/en/", "allow"),
    ("http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
    ("https://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", "block"),
    ("https://x.example.com/DE/1", "x.example.com", "/DE/1", None, None),
    ("http://deep.b.org/fr/", "deep.b.org", "/fr/", "org/fr/", "allow"),
    ("http://org/fr/x", "org", "/fr/x", "org/fr/", "allow"),
    ("http://x.net", "x.net", "", None, None),
    ("http://x.net?a=/b", "x.net", "", None, None),
    ("http://x.org#://y.net/", "x.org", "", None, None),
    ("x.net/a", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://é.net/ü", "é.net", "/ü", "net/", "block"),
]


def test_rules(spark):
    df = spark.createDataFrame([(i, c[0], 1, "x") for i, c in enumerate(CASES)], "page_id long, url string, score int, host string")
    for r in U.judge(df).collect():
        _, host, path, rule, verdict = CASES[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert U.judge(df.limit(0)).count() == 0


def test_models_tell_unruled_urls_apart(spark):
    r = random.Random(4)

    def url(good, host):
        parts = ["article", "story", "essay"] if good else ["casino", "win-now", "xxx"]
        return f"https://{host}{'/fr/' if host.endswith('org') else '/en/' if good else '/'}{r.choice(parts)}-{r.randrange(1000)}"

    ruled = [url(True, "w.example.net") for _ in range(300)] + [url(True, "v.org") for _ in range(300)] + [url(False, "z.net") for _ in range(600)]
    unruled = [(good, f"http://other.biz/{r.choice(['article', 'story'] if good else ['casino', 'xxx'])}-{r.randrange(1000)}") for good in (True, False) * 50]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(ruled + [u for _, u in unruled])], "page_id long, url string")
    got = {x["page_id"]: x["verdict"] for x in U.judge(df).collect()}
    right = sum(got[len(ruled) + i] == ("allow" if good else "block") for i, (good, _) in enumerate(unruled))
    assert right >= 95


def test_witten_bell_by_hand():
    import numpy as np
    import pandas as pd

    rows = pd.concat(x.assign(kind=k) for k, t in ((1, ["ab", "ab"]), (0, ["b"])) for x in U._count(iter([pd.DataFrame({"kind": k, "url": t})])))
    models = U.Models(rows.groupby(["kind", "key"], as_index=False)["n"].sum())

    def p(kind, text):
        counts = {1: ["ab", "ab"], 0: ["b"]}[kind]
        out = 0.0
        for i, c in enumerate(text):
            q = 1 / U.SYMBOLS
            for order in range(U.ORDER + 1):
                context = ("\0" * U.ORDER + text[:i])[-order:] if order else ""
                follow = [t[j] for t in counts for j in range(len(t)) if (("\0" * U.ORDER + t[:j])[-order:] if order else "") == context]
                if follow:
                    q = (follow.count(c) + len(set(follow)) * q) / (len(follow) + len(set(follow)))
            out += np.log(q)
        return out

    for text in ("a", "ab", "ba", "bb"):
        assert abs(models.scores([text])[0] - (p(1, text) - p(0, text)) / len(text)) < 1e-5
    assert models.scores([""])[0] == 0


def test_whole_urls_of_all_bytes_are_scored(spark):
    ruled = [f"http://w.org/fr/?q=story-é{i}" for i in range(40)] + [f"http://z.net/?q=casino-ü{i}" for i in range(40)]
    asked = ["http://o.biz/?q=story", "http://o.biz/?q=casino", "story-1", "casino-1", "http://o.biz/é", "http://o.biz/ü"]
    df = spark.createDataFrame(list(enumerate(ruled + asked)), "page_id long, url string")
    score = {r["page_id"]: r["score"] for r in U.judge(df).collect()}
    for k in range(len(ruled), len(ruled) + len(asked), 2):
        assert score[k] > score[k + 1]


def test_contexts_are_not_shared():
    import numpy as np

    r = np.random.default_rng(1)
    symbols = r.integers(0, 256, 200_004)
    at = np.arange(4, len(symbols))
    for order, found in enumerate(U._contexts(symbols, at)):
        assert len(np.unique(found)) == len({tuple(symbols[k - order : k].tolist()) for k in at.tolist()})
