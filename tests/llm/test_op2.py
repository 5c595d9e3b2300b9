"""Rules, the word split and naive Bayes against brute force."""

import itertools
import math
import random
import re
from collections import Counter

from tessera.llm.op2_urls import RULES, best_split, judge


def brute_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fits = [(len(r), r, v) for r, v in RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fits)[1:] if fits else (None, None)


LONG = "donaudampfschifffahrtsgesellschaftskapitaen"  # 43 letters: words up to a label's length count
PAGES = [
    (1, "http://a.Example.NET/en/1?x=/de/", "<p>cheap pills the cat</p>"), (2, "https://cheappills.example.net/fr/2#t", "cat <b>hat</b> cat"),
    (3, "https://example.com/de/3", None), (4, "https://cat.org/fr/9.html", "hat the"), (5, "https://cheappills.org/en/9", ""),
    (6, "https://thecat.example.com/en/9", "x"), (7, None, "pills"), (8, "no scheme", None), (9, "http://", None), (10, "ftp://HOSTÉ.com", "é"),
    (11, "http://example.net", None), (12, "http://notexample.net/en/", None), (13, "http://x.com/" + "a" * 30000, None),
    (14, "http://" + "b" * 5000 + ".com/", None), (16, "http://" + LONG + "cat.example.com/de/", LONG + " " + LONG), (17, "http://the" + LONG + ".com/x", "the"), (15, "x://y://net/", None), (1, "http://a.Example.NET/en/1?x=/de/", "<p>cheap pills the cat</p>"),
]


def brute_verdicts(pages):
    text = [w for _, _, h in pages for w in re.split(r"[\W\d_]+", re.sub("<[^<>]*>", " ", (h or "").lower())) if 0 < len(w) <= 63]
    n, total = Counter(text), len(text)

    def tokens(host, path):
        out = []
        for label in re.split(r"[\W\d_]+", host):
            known = {(i, j - i): n[label[i:j]] for i in range(len(label)) for j in range(i + 1, len(label) + 1) if n[label[i:j]]} if len(label) <= 63 else {}
            out += ["h:" + w for w in best_split(label, known, total)] if label else []
        return out + ["p:" + re.sub("[0-9]+", "#", t) for t in re.split(r"[\W_]+", path.lower()) if t]

    judged = [(tokens(h, p), v) for h, p, (_, v) in (brute_rule(u) for _, u, _ in pages) if v]
    counts = {s: Counter(t for ts, v in judged if v == s for t in ts) for s in ("block", "allow")}
    vocabulary = set(counts["block"]) | set(counts["allow"])
    size = {s: sum(c.values()) + len(vocabulary) + 1 for s, c in counts.items()}
    classes = Counter(v for _, v in judged)
    out = {}
    for i, u, _ in pages:
        host, path, (rule, verdict) = brute_rule(u)
        odds = math.log((classes["block"] + 1) / (classes["allow"] + 1))
        odds += sum(math.log((counts["block"][t] + 1) / size["block"]) - math.log((counts["allow"][t] + 1) / size["allow"]) for t in tokens(host, path))
        out[i] = (host, path, rule, verdict or ("block" if odds > 1e-9 else "allow"))
    return out


def test_against_brute_force(spark):
    schema = "page_id long, url string, html string, host string, rule string, token string, n long"
    df = judge(spark.createDataFrame([(*p, "clash", "clash", "clash", 1) for p in PAGES], schema))
    rows = df.collect()
    assert len(rows) == len(PAGES)
    want = brute_verdicts(PAGES)
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == want
    assert want[2][2:] == ("net/", "block") and want[1][2:] == ("example.net/en/", "allow") and want[11][2] is None


def test_nothing_to_learn_from(spark):
    schema = "page_id long, url string, html string"
    assert judge(spark.createDataFrame([], schema)).count() == 0
    assert [r["verdict"] for r in judge(spark.createDataFrame([(1, None, None)], schema)).collect()] == ["allow"]


def test_split_is_the_most_probable():
    rng = random.Random(4)
    words = {"a": 50, "ab": 9, "ba": 7, "abc": 30, "cab": 2, "c": 20, "bc": 5}
    total = sum(words.values())

    def score(parts):
        return sum(math.log(words[p] / total) if p in words else math.log(10 / (total * 10 ** len(p))) for p in parts)

    for _ in range(60):
        label = "".join(rng.choice("abc") for _ in range(rng.randint(1, 8)))
        known = {(i, j - i): words[label[i:j]] for i in range(len(label)) for j in range(i + 1, len(label) + 1) if label[i:j] in words}
        cuts = (c for k in range(len(label)) for c in itertools.combinations(range(1, len(label)), k))
        best = max(score([label[a:b] for a, b in zip((0, *c), (*c, len(label)))]) for c in cuts)
        assert math.isclose(score(best_split(label, known, total)), best)
    assert best_split("z" * 64, {}, 5) == ["z" * 64]
