import random
import re

from ticksmith.llm.queries import BLOCKED, RULES, op3_url_filter
from ticksmith.llm.urlrules import Automaton, Rule, judge


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def _regex(glob):
    return re.compile("".join({"**": "[\\s\\S]*", "*": "[^/]*"}.get(p, re.escape(p)) for p in re.findall(r"\*\*|\*|[^*]+", glob)).encode())


def brute(url, rules, blocked):
    host, path = _split(url)
    best = None
    for r in rules:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.name) > len(best.name)):
            best = r
    if best:
        return host, path, best.name, best.verdict
    bad = any(_regex(g).fullmatch(("." + host + path).encode()) for g in blocked)
    return host, path, None, "block" if bad else "allow"


def test_automaton_equals_regular_expressions():
    rng = random.Random(5)
    for _ in range(150):
        globs = ["".join(rng.choice(["a", "b", ".", "/", "*", "**", "é"]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 9))]
        texts = ["".join(rng.choice("aab./é") for _ in range(rng.randint(0, 14))).encode() for _ in range(25)]
        got = Automaton(globs).run(texts)
        for i, t in enumerate(texts):
            assert got[i].tolist() == [bool(_regex(g).fullmatch(t)) for g in globs]


URLS = [None, "", "nothing", "http://", "http://COM/", "http://com", "a://x.Example.com/en/?q=://b", "http://example.com/en",
        "http://www.example.com/en/x#y", "http://wwwexample.com/en/", "http://a.net/es/1", "http://a.net?x/es/", "x://net/fr/",
        "http://b.org/x.net/es/", "http://www.cheap-pills.example.org/a", "http://É.com/é", "http://a.com/\n://b/", "http://h.net/es/" + "z" * 200000,
        "http://" + "h" * 50000 + ".net/fr/"]


def test_judged_like_brute_force(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS + URLS[4:6])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    for r in judge(pages, RULES, blocked=BLOCKED).collect():
        assert tuple(r.judged) == brute(r.url, RULES, BLOCKED)
    assert {r.judged.verdict for r in judge(pages, []).collect()} == {"allow"}
    assert judge(pages.limit(0), RULES).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in op3_url_filter(spark, sf).collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], RULES, BLOCKED)


def test_ties():
    assert Rule("a.com", "/", "allow").glob == "*.a.com/**"
