import math
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from simtrail.llm import urlfilter
from simtrail.llm.queries import op12_urlfilter

SCHEMA = "page_id long, url string, host int, score string"


def parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]


def rule_of(host, path):
    best = (None, None)
    for verdict, name, start in urlfilter.RULES:
        labels = host.split(".")
        inside = any(".".join(labels[i:]) == name for i in range(len(labels)))
        if inside and path.startswith(start) and len(name + start) > len(best[0] or ""):
            best = (name + start, verdict)
    return best


def slow_score(model, host, path):
    """The n-gram sum one window at a time."""
    z = model.bias
    for salt, text in enumerate((host, path)):
        raw = b"\x02" + re.sub(rb"[0-9]", b"0", text.encode()) + b"\x03"
        weights = []
        for order in urlfilter.ORDERS:
            for at in range(len(raw) - order + 1):
                code = (0x811C9DC5 + 31 * order + salt) % 2**32
                for byte in raw[at : at + order]:
                    code = (code ^ byte) * 0x01000193 % 2**32
                weights.append(model.weights[code * 0x9E3779B1 % 2**32 >> (32 - urlfilter.BITS)])
        z += sum(weights) / max(len(weights), 1) ** 0.5
    return 1 / (1 + math.exp(-z))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(*parts(u), y) for u, y in urlfilter.labelled_urls(spark).collect()]
    return urlfilter.fit(sorted((h.encode(), p.encode(), y) for h, p, y in rows))


def check(rows, urls, model):
    got = {r.page_id: r for r in rows}
    assert len(got) == len(rows) == len(urls)
    for page, url in urls.items():
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        r = got[page]
        score = slow_score(model, host, path) if len(path) < 5000 else r.score
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.verdict == (verdict or ("block" if score >= 0.5 else "allow"))


def test_query_against_brute_force(spark, sf, model):
    t = pq.read_table(f"{sf}/pages.parquet")
    urls = dict(zip(t["page_id"].to_pylist(), t["url"].to_pylist(), strict=True))
    rows = op12_urlfilter(spark, sf).collect()
    check(rows, urls, model)
    assert {r.rule for r in rows} > {None, "net/"} and {r.verdict for r in rows if r.rule is None} == {"allow", "block"}


def test_edges(spark, model):
    urls = {
        1: None, 2: "", 3: "no scheme/net/", 4: "://", 5: "http://a.NET", 6: "http://a.NET/", 7: "http://net/x",
        8: "http://planet/x", 9: "http://Sub.Example.net/en/x?y#z", 10: "http://example.net/en", 11: "http://xexample.com/de/1",
        12: "http://example.com/de/", 13: "http://example.com?/de/", 14: "http://w.org/fr/#/x", 15: "a://b://c.net/d",
        16: "http://ÄB.org/FR/", 17: "http://a.net:80/", 18: "http://u@b.net/\nx?", 19: "http://x.org/" + "long/" * 300_000,
        20: "http://example.org/fr/q", 21: "http:// .net/\t", 22: "http://net./x",
    }
    df = spark.createDataFrame([(i, u, 7, "other") for i, u in urls.items()], SCHEMA).repartition(3)
    out = urlfilter.judge(df, urlfilter.labelled_urls(spark), urlfilter.RULES)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "score"]
    rows = out.collect()
    check(rows, urls, model)
    rule = {r.page_id: r.rule for r in rows}
    assert rule[6] == rule[7] == rule[18] == "net/" and rule[15] is None and rule[5] is None and rule[8] is None and rule[17] is None
    assert rule[9] == "example.net/en/" and rule[10] == "net/" and rule[11] is None and rule[20] == "org/fr/"
    twice = urlfilter.judge(df.union(df), urlfilter.labelled_urls(spark), urlfilter.RULES).collect()
    assert sorted(map(str, twice)) == sorted(map(str, rows + rows))
    assert urlfilter.judge(df.limit(0), urlfilter.labelled_urls(spark), urlfilter.RULES).collect() == []


def test_unusable_labels(spark):
    df = spark.createDataFrame([(1, "http://casino-bets.com/", 7, "x")], SCHEMA)
    none = spark.createDataFrame([(None, 1), ("http://a.com", None), ("http://b.com", 4)], "url string, unwanted int")
    r = urlfilter.judge(df, none, []).first()
    assert (r.score, r.rule, r.verdict) == (0.5, None, "block")


def test_regression_is_at_its_optimum(spark, model):
    """The gradient of the penalised loss vanishes."""
    rows = [(*parts(u), y) for u, y in urlfilter.labelled_urls(spark).collect()]
    gradient = 0.01 * model.weights.copy()
    bias = 0.01 * model.bias
    for host, path, y in rows:
        off = model.score(host.encode(), path.encode()) - y
        for salt, raw in enumerate((host.encode(), path.encode())):
            found = np.concatenate([*urlfilter.part_grams(raw, salt), np.empty(0, np.int64)])
            np.add.at(gradient, found, off / max(found.size, 1) ** 0.5)
        bias += off
    assert np.abs(gradient).max() < 1e-6 and abs(bias) < 1e-6


def test_held_out_names(spark):
    """Names whose words the table knows only from other names are told apart."""
    rows = [(*parts(u), y) for u, y in urlfilter.labelled_urls(spark).collect()]
    sent = [(h.encode(), p.encode(), y) for h, p, y in rows]
    right = 0
    for fold in range(5):
        model = urlfilter.fit([r for i, r in enumerate(sent) if i % 5 != fold])
        right += sum((model.score(h, p) >= 0.5) == y for i, (h, p, y) in enumerate(sent) if i % 5 == fold)
    assert right / len(sent) > 0.9
