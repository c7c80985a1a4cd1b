import itertools
import random

from cohortkit.llm import urlrules

PAGES = "page_id long, url string, html string, host string, verdict int, tokens string"


def pages(n=600, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        host = rnd.choice(["www", "m", "blog"]) + "." + rnd.choice(["spam", "good", "news", "x"]) + rnd.choice([".example.net", ".example.com", ".example.org"])
        lang = rnd.choice(["en", "fr", "de", "es"])
        out.append((i, f"https://{host.upper() if i % 9 == 0 else host}/{lang}/{i}" + rnd.choice(["", ".html", "/", "?ref=x&page=2", "#top"])))
    return out


def label(url, i):
    return 1 if ".spam." in url.lower() and "/en/" in url and i % 10 else int(i % 25 == 0)


def test_policy_and_parts(spark):
    urls = {0: "http://a.Example.ORG/es/1", 1: "http://example.org/en/12?x", 2: "http://example.org", 3: "http://norg/x", 4: None,
            5: "no scheme/de/", 6: "http://shop.com/de/#a", 7: "http://com/fr/", 8: "x://y://z/w", 9: "http://example.org/en/2",
            10: "http://example.org?/es/", 11: "ftp://İ.com/fr", 12: ""}
    df = spark.createDataFrame([(i, u, None, "h", 1, "t") for i, u in urls.items()], PAGES)
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.op10(df, lab).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("example.org", "", None, "allow")
    assert got[3] == ("norg", "/x", None, "allow")
    assert got[4] == got[5] == got[12] == ("", "", None, "allow")
    assert got[6] == ("shop.com", "/de/", "com/de/", "block")
    assert got[7] == ("com", "/fr/", "com/fr/", "allow")
    assert got[8] == ("y:", "//z/w", None, "allow")
    assert got[9] == ("example.org", "/en/2", "org/", "allow")
    assert got[10] == ("example.org", "", None, "allow")
    assert got[11][0] == "İ.com" and got[11][2] is None


def test_mined_rules_equal_brute_force(spark):
    rows = pages()
    df = spark.createDataFrame([(i, u, None, "h", 1, "t") for i, u in rows] * 2, PAGES)
    lab = spark.createDataFrame([(i, 0 if label(u, i) and i % 2 else 1, label(u, i) if i % 2 == 0 else 0) for i, u in rows if i % 4]
                                + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    base = [(set(r.tokens), r.bad) for r in urlrules.labelled(df, lab).collect()]
    n, bad = len(base), sum(b for _, b in base)
    least = max(urlrules.MIN_SUPPORT * n, urlrules.MIN_COUNT)
    items = sorted({t for s, _ in base for t in s if sum(t in x and b for x, b in base) >= least})
    want = {}
    for k in (1, 2, 3):
        for c in itertools.combinations(items, k):
            both = sum(b for s, b in base if s.issuperset(c))
            if both >= least:
                conf = both / sum(s.issuperset(c) for s, _ in base)
                if conf >= urlrules.MIN_CONFIDENCE and conf / (bad / n) >= urlrules.MIN_LIFT:
                    want[c] = conf
    got = {tuple(r.needs): r.confidence for r in urlrules.mine(df, lab).collect()}
    assert want and {c: round(v, 9) for c, v in got.items() if len(c) <= 3} == {c: round(v, 9) for c, v in want.items()}
    blocked = {r.page_id for r in urlrules.verdicts(df, lab, policy=()).where("verdict = 'block'").collect()}
    toks = {r.page_id: set(r.t) for r in df.select("page_id", urlrules.tokens(df.url).alias("t")).collect()}
    assert blocked == {i for i, s in toks.items() if any(s.issuperset(c) for c in got)}
    assert urlrules.op10(df, lab).count() == len(rows) * 2
    assert urlrules.op10(df.limit(0), lab).count() == 0
