"""Top-k search, licences, mixing, quality rules, url filter and archives against brute force on small tables."""

import base64
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyprep.llm import decision_list, license_scan, mixing, url_tree, vafile, warc
from surveyprep.llm.registry import URL_RULES

SF = "/root/testdata/sf0.01"


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(230)]
    rows += [(300 + i, rows[7][1], 1) for i in range(4)]  # ties
    rows += [(400, None, 1), (450, [1.0, None], 1), (500, [float("nan")] * 8, 1), (501, [float("inf")] * 8, 1), (None, rows[0][1], 1),
             (550, [1e300] * 8, 1), (600, [1.0, 2.0], 1), (601, [3.0, 1.0], 1), (50, rows[50][1], 1), (650, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    top = lambda v: min(max(math.floor(256 * v), -(1 << 62)), 1 << 62)
    ok = [(i, [top(x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, v in {i: v for i, v in ok if i % 50 == 0}.items():
        best = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1), i) for i, w in ok if i != q and len(w) == len(v))[:5]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    for blocks in ({}, {"query_block": 3, "vector_block": 40}, {"cell_bits": 6}):
        got = vafile.top_k(df, **blocks).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert vafile.top_k(df.limit(0)).count() == 0


def test_licences(spark):
    rows = [("a", "r/LICENSE", license_scan.TEMPLATES[0][1]), ("b", "r/src/x/one.txt", "some words of no licence at all\nmore"),
            ("c", "r/src/two.txt", "plain words here\n  " + license_scan.TEMPLATES[1][1].lower() + "\nand then a lot more of other words follows here"),
            ("d", "q/other.txt", "nothing"), ("e", None, None), ("f", "r/src/x/COPYING", license_scan.TEMPLATES[3][1]),
            ("g", "top.txt", ""), ("h", "r/deep/er/file.txt", "the of and")] + [(f"z{i}", f"q/{i}", f"filler words number {i} the of and to version") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id string, path string, text string").withColumn("licence", F.lit("x")).withColumn("score", F.lit(1))
    got = {r.doc_id: r for r in license_scan.licences(df, "doc_id", "path", "text").collect()}
    assert (got["a"].own_licence, got["a"].is_licence_file) == ("Apache-2.0", True)
    assert (got["c"].own_licence, got["c"].is_licence_file) == ("MIT", False)
    assert (got["b"].licence, got["b"].inherited_from) == ("GPL-3.0", "r/src/x") and got["b"].own_licence is None
    assert (got["h"].licence, got["h"].inherited_from) == ("Apache-2.0", "r")
    assert all(got[k].licence is None for k in ("d", "e", "g", "z1"))
    # cosines against a plain computation
    m = license_scan.Matcher(license_scan.TEMPLATES, {"license": 3, "the": 90}, 100, 0.1)
    line = license_scan.tokens("released under the mit license today")
    idf = lambda w: m.idf.get(w, m.other)
    t = license_scan.tokens(license_scan.TEMPLATES[1][1].lower())
    dot = sum(idf(w) ** 2 for w in t)
    assert m.best(line)[0] == pytest.approx(dot / math.sqrt(dot) / math.sqrt(sum(idf(w) ** 2 for w in line)))
    assert license_scan.licences(df.limit(0), "doc_id", "path", "text").count() == 0


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, None if i == 3 else " ".join(["w"] * rng.randint(0, 60)), [None, "b", "a", "", "é"][min(4, rng.randint(0, 9))], 1, "x") for i in range(300)]
    rows += [rows[0], (None, "one two", "a", 1, "x"), (999, "w " * 4000, "solo", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string")
    got = mixing.mix(df).toPandas()
    size = {}
    for _, t, s, *_ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(size.values()), set(order), {}
    while open_:  # share again until no target is above its limit
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        open_ -= over
    for r in got.itertuples():
        s = r.source if isinstance(r.source, str) else None
        assert r.source_size == size[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size
    for s in order:
        own = got[got.source.isna()] if s is None else got[got.source == s]
        assert abs(own.taken.sum() - target[s]) <= 1
    assert sorted(map(str, got.values.tolist())) == sorted(map(str, mixing.mix(df.repartition(7)).toPandas().values.tolist()))
    whole = mixing.mixed_documents(df)
    assert whole.columns == df.columns and abs(sum(len(r.text.split()) for r in whole.collect()) - sum(target.values())) < 4000
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0


def counts_by_hand(text):
    import re
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    repeat = {i + j for i, x in enumerate(tri) if tri.count(x) > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat)


def test_quality_counts_and_rules(spark):
    texts = [None, "", " \n\x0b\x1c\u2028 ", "a b c a b c", "x\n\nx\n x\nx\n", "é日 #*$ <|> \x85", "w " * 60, " ".join(map(str, range(80))), "a b c d\x1fe f"]
    for t in texts:
        assert decision_list.text_counts(t)[:5] == counts_by_hand(t)
    rng = random.Random(6)
    clean = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(80))
    rows = [(i, clean() if i % 3 else " ".join(x + "###" for x in clean().split()), "k", 1) for i in range(400)] + [(400 + i, t, "k", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(None, 1), (5, None), (7777, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in decision_list.judge(df, labels).collect()}
    assert all(got[i].kept == (i % 3 > 0) for i in range(200, 400))  # held out
    assert all(got[400 + i].base_failed and not got[400 + i].kept for i in (0, 1, 2, 3, 4, 6))
    plain = decision_list.judge(df, labels.limit(0))
    assert plain.where("kept <> (not base_failed)").count() == 0
    assert decision_list.judge(df.limit(0), labels).count() == 0


def test_quality_rules_keep_clean_documents(spark):
    """Accuracy on labels that the rules aren't learned from."""
    d, lab = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train, test = lab.where("doc_id % 2 = 0"), lab.where("doc_id % 2 = 1")
    j = decision_list.judge(d, train).join(test, "doc_id").where("not base_failed").toPandas()
    good, bad = j[j.quality == 1], j[j.quality == 0]
    assert good.kept.mean() > 0.98 and len(bad) and (~bad.kept).mean() > 0.4


def test_url_filter(spark):
    def rule(host, path):
        fits = [(w, h, p) for w, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    urls = ["http://Example.org/es/1", "https://a.example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/x", "http://x.com/de/1?u=http://y/", "com/fr/", None, "",
            "http://X.COM/fr/#a", "http://com", "http://é.com/de/ü", "a://b://c/d", "http://org/", "http://u\n.org/\nq?x", "http://q.net//de///77.html", "x" * 5000]
    urls += [f"http://bad.com/de/{i}" for i in range(60)] + [f"http://bad.com/fr/{i}" for i in range(60)] + ["http://bad.com/de"] + [f"http://w.net/a/b/c/d/e/{i}" for i in range(5)]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h")], "page_id long, url string, host string")
    got = url_tree.judge_urls(df, URL_RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        u = urls[r.page_id] or ""
        rest = u.partition("://")[2] if "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        want = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, want and want[1] + want[2]), u
        assert r.verdict == (want[0] if want else r.verdict) and r.verdict in ("allow", "block")
    assert url_tree.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_url_templates_learn_from_labels(spark):
    """A host's blocked branch is blocked beyond the rule's own paths; its allowed one and other hosts aren't."""
    rules = [("block", "h.com", "/bad/1"), ("allow", "h.com", "/good/1")]
    urls = [f"http://h.com/{b}/{i}" for b in ("bad", "good") for i in range(100, 300)] + [f"http://k.com/bad/{i}" for i in range(5)]
    got = url_tree.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    assert all(r.verdict == ("block" if r.host == "h.com" and r.path.startswith("/bad") else "allow") for r in got)


def test_archives_round_trip(spark):
    rows = [(1, "http://a/\r\n%41", "<p>one</p>"), (2, None, "<p>one</p>"), (9, "u", "<p>one</p>"), (3, "http://é", ""), (4, "v", None), (5, "w", "日本" * 9000), (None, "n", "<p>one</p>"),
            (7, "r", "same"), (7, "r", "same"), (6, "t", "same")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"body": F.lit(1), "head": F.lit(2), "record_type": F.lit("x")})
    got = warc.archive_and_read(df).collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    want = []
    for i, u, t in rows:
        top = max(j for j, _, x in rows if (x or "") == (t or "") and j is not None)
        again = i is not None and i != top
        want.append((i, u, len((t or "").encode()), digest(t), "revisit" if again else "response", f"<urn:page:{top}>" if again else None))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.page_id, r.target_uri, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    big = {r.page_id: r.record_type for r in warc.archive_and_read(df, min_bytes=5).collect()}
    assert (big[3], big[6], big[1], big[9]) == ("response", "response", "revisit", "response")
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_archive_pushdown(spark, tmp_path):
    spark.dataSource.register(warc.WarcSource)
    df = spark.createDataFrame([(i, f"u{i}", "z" * 3000 * (i % 2)) for i in range(40)], "page_id long, url string, html string")
    warc.records(df, warc.Scratch(spark, "t")).write.format("warc").option("rollBytes", "400").mode("append").save(str(tmp_path / "w"))
    files = list((tmp_path / "w").glob("*.warc.gz"))
    assert len(files) > 4 and not (tmp_path / "w" / "_temporary").exists()
    import gzip
    assert b"WARC/1.1\r\nWARC-Type: " in gzip.open(files[0]).read()  # any reader of gzip members can read it
    reader = warc.WarcReader(str(tmp_path / "w"), True)
    from pyspark.sql.datasource import EqualTo, GreaterThan, In
    left = list(reader.pushFilters([EqualTo(("page_id",), 39), In(("record_type",), ("response",)), GreaterThan(("payload_bytes",), 5)]))
    assert [type(f).__name__ for f in left] == ["GreaterThan"]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[0], r[6], len(r[7])) for r in rows] == [("response", 39, 3000)]
    with warc.pushdown(spark):
        back = spark.read.format("warc").load(str(tmp_path / "w")).where("record_type = 'response' and page_id in (1, 39)")
        assert sorted(r.page_id for r in back.collect()) == [39] and back.count() == 1
