"""The template tree against a plain-Python tree, and the cases that a depth limit or a size switch would lose."""

import random
import re
from collections import defaultdict

from surveyprep.llm import dartminhash, registry
from surveyprep.llm.url_tree import judge_urls


def plain_tree(urls, rules, z=1.96, strength=10.0, reject=0.8):
    """[(rule's or learned verdict)] per url, by recursion over dictionaries."""
    def parts(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    rows = []
    for url in urls:
        host, path = parts(url)
        fits = sorted((len(h + p), what) for what, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p))
        segs = ["*" if re.search(r"^[0-9]+(\.[A-Za-z]{1,5})?$|^[0-9a-fA-F-]{8,}$", s) else s for s in path.split("/") if s]
        rows.append([host, segs, fits[-1][1] if fits else None])

    def merge(group, level):
        branches = defaultdict(list)
        for r in group:
            if len(r[1]) > level:
                branches[r[1][level]].append(r)
        lab = {k: sum(r[2] is not None for r in b) for k, b in branches.items()}
        blk = {k: sum(r[2] == "block" for r in b) for k, b in branches.items()}
        ul, ub = sum(lab.values()), sum(blk.values())
        for k, b in branches.items():
            if k == "*" or len(branches) < 2:
                continue
            rest = ul - lab[k]
            if lab[k] == 0:
                same = True
            elif rest == 0:
                same = False
            else:
                pooled = ub / ul
                same = abs(blk[k] / lab[k] - (ub - blk[k]) / rest) <= z * (pooled * (1 - pooled) * (1 / lab[k] + 1 / rest)) ** 0.5
            if same:
                for r in b:
                    r[1][level] = "*"
        again = defaultdict(list)
        for r in group:
            if len(r[1]) > level:
                again[r[1][level]].append(r)
        for b in again.values():
            merge(b, level + 1)

    hosts = defaultdict(list)
    for r in rows:
        hosts[r[0]].append(r)
    for group in hosts.values():
        merge(group, 0)
    whole = [r for r in rows if r[2] is not None]
    rate = sum(r[2] == "block" for r in whole) / len(whole) if whole else 0.0
    out = []
    for host, segs, given in rows:
        purity = rate
        for level in range(len(segs) + 1):
            mine = [r for r in hosts[host] if len(r[1]) >= level and r[1][:level] == segs[:level] and r[2] is not None]
            purity = (sum(r[2] == "block" for r in mine) + strength * purity) / (len(mine) + strength)
        out.append(given or ("block" if purity >= reject else "allow"))
    return out


def verdicts(spark, urls, rules):
    got = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    return [r["verdict"] for r in sorted(got, key=lambda r: r["page_id"])]


def test_deep_branches_and_many_branches(spark):
    deep = [("block", "h.org", "/a/b/c/d/bad/1"), ("allow", "h.org", "/a/b/c/d/good/1")]
    urls = [f"http://h.org/a/b/c/d/bad/1{i}x" for i in range(60)] + [f"http://h.org/a/b/c/d/good/1{i}x" for i in range(60)] + [f"http://h.org/a/b/c/d/bad/y{i}" for i in range(100)]
    assert verdicts(spark, urls, deep) == ["block"] * 60 + ["allow"] * 60 + ["block"] * 100
    wide = [("block", "w.org", "/k3/x")] + [("allow", "w.org", f"/k{i}/x") for i in range(26) if i != 3]
    urls = [f"http://w.org/k{i % 26}/x{i}" for i in range(26 * 60)] + [f"http://w.org/k3/other{i}" for i in range(30)]
    assert verdicts(spark, urls, wide) == ["block" if i % 26 == 3 else "allow" for i in range(26 * 60)] + ["block"] * 30


def test_random_hosts_against_the_plain_tree(spark):
    rng = random.Random(12)
    names = ["a", "b", "c", "item", "7", "deadbeef01", "z" * 50]
    urls = []
    for _ in range(700):
        host = rng.choice(["one.com", "two.com", "sub.two.com", "three.net"])
        path = "/".join(rng.choice(names[: 2 + d]) for d in range(rng.randrange(0, 7)))
        urls.append(f"http://{host}/{path}")
    urls += [None, "no scheme", "x://HOST.com", "http://one.com/a//b/?q#f"]
    rules = [("block", "one.com", "/a/b"), ("allow", "one.com", "/b"), ("block", "two.com", "/b/a"), ("allow", "two.com", "/a"), ("block", "three.net", "/")]
    assert verdicts(spark, urls, rules) == plain_tree(urls, rules)


def test_registered_rules_against_the_plain_tree(spark):
    sf = "/root/testdata/sf0.001"
    pages = sorted((r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect())
    got = {r["page_id"]: r["verdict"] for r in registry.QUERIES["op8_url_filter"](spark, sf).collect()}
    assert [got[i] for i, _ in pages] == plain_tree([u for _, u in pages], registry.URL_RULES)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://a.com/de/x", "h", "p", 1, 2, [3])], "page_id long, url string, host string, path string, rule int, label int, segs array<int>")
    got = judge_urls(df, registry.URL_RULES).collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [("a.com", "/de/x", "com/de/", "block")]


def test_unlike_texts_of_one_id_both_stay(spark):
    rows = [(1, "the first text speaks of quite another thing than all that follow here", "a"), (1, "nothing in this second one is like what was said before at all", "b"),
            (2, "the first text speaks of quite another thing than all that follow here", "c"), (1, "nothing in this second one is like what was said before at all", "d")]
    kept = dartminhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r["doc_id"], r["text"][:7]) for r in kept) == [(1, "nothing"), (1, "the fir")]
