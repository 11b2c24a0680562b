import math
import random
import re

from pyspark.sql import functions as F

from levyframe.llm.urlfilter import RULES, Markov, Ratio, best_threshold, filter_urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.rule), default=None)


EDGES = [
    None, "", "no scheme", "http://", "http:///x", "HTTP://A.Example.NET/en/1", "http://example.net/en", "http://example.net/en/", "http://notexample.net/en/", "http://net", "http://Net/x?y#z",
    "http://x.example.com/de/?a", "http://example.com/DE/", "http://a.org/fr/", "http://org/fr/1", "http://myorg/fr/1", "http://a.org?x=/fr/", "http://ÀÉ.org/fr/", "x://y://z.net/", "http://" + "a" * 50000 + ".com/", "://net#/",
]


def test_rules_parts_and_verdicts(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    pages = pages.unionByName(spark.createDataFrame([(1000 + i, u) for i, u in enumerate(EDGES)] + [(None, "http://q.com/"), (1000, None)], "page_id long, url string")).withColumn("HOST", F.lit(1)).withColumn("text", F.lit("t"))
    got = filter_urls(pages)
    assert got.columns == ["page_id", "text", "host", "path", "rule", "verdict", "score"]
    want = []
    for r in pages.collect():
        host, path = parts(r.url)
        rule = rule_of(host, path)
        want.append(repr((r.page_id, host, path, rule and rule.rule)))
    rows = got.collect()
    assert sorted(repr((r.page_id, r.host, r.path, r.rule)) for r in rows) == sorted(want)
    verdicts = {r.rule: r.verdict for r in RULES}
    for r in rows:
        assert r.verdict == (verdicts[r.rule] if r.rule else "allow" if r.score >= 0 else "block")
        if not r.host and not r.path:
            assert (r.score, r.verdict) == (0.0, "allow")


def test_probabilities_are_those_of_the_formula():
    texts = ["abab", "abba", "b"]
    m = Markov(order=2).fit(texts)
    strings = ["\n\n" + t + "\n" for t in texts]

    def plain(context, c):
        if context is None:
            return 1 / 65536
        after = [s[i] for s in strings for i in range(2, len(s)) if s[i - len(context) : i] == context]
        lower = plain(context[1:] if context else None, c)
        return (after.count(c) + len(set(after)) * lower) / (len(after) + len(set(after))) if after else lower

    for context in ("\n\n", "\na", "ab", "ba", "bb", "zz", "za"):
        for c in "ab\nz":
            assert math.isclose(m.probability(context, c), plain(context, c))


def test_held_out_accuracy_and_threshold():
    rng = random.Random(4)
    make = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(5, 40)))
    good, bad = [make("abcde") for _ in range(300)], [make("defgh") for _ in range(300)]
    ratio = Ratio(Markov().fit(good[:100]), Markov().fit(bad[:100]))
    ratio.threshold = best_threshold([ratio.raw(t) for t in good[100:200]], [ratio.raw(t) for t in bad[100:200]])
    right = sum(ratio.score(t) >= 0 for t in good[200:]) + sum(ratio.score(t) < 0 for t in bad[200:])
    assert right >= 195
    assert best_threshold([3.0, 4.0], [1.0, 2.0]) == 2.5
    assert best_threshold([], [1.0]) == 0.0


def test_empty_table(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
