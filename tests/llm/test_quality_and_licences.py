"""The operators in plain Columns: quality rules, licence scan, URL templates."""

import collections
import math

import brute
import pytest
import xxhash
from cases import DOCS, TESTDATA, odd_docs, odd_frame, pairs, with_clashes
from compare import connect, difference
from pyspark.sql import functions as F

from culvert.llm import licences, quality, queries, urls

LABELS = "doc_id long, quality int, toxic int"


def labels_of(spark):
    return spark.createDataFrame([(18, 1, 0), (18, 0, 0), (30, 1, 0), (48, 0, 1), (None, 1, 0), (999, 1, 0)], LABELS)


def buckets_of(text, size):
    found = brute.BLANK_WORD.findall(text or "")
    hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in found]
    signed = [h - (1 << 64) if h >> 63 else h for h in hashes]
    chained = [xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed=42) for h in hashes]
    pairs_ = [
        xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=a) for a, b in zip(chained, hashes[1:], strict=False)
    ]
    signed += [h - (1 << 64) if h >> 63 else h for h in pairs_]
    return [h % size for h in signed]


def expected(rows, trusted):
    """Base counts, score and verdicts of every row, one after the other."""
    raw, target = collections.Counter(), collections.Counter()
    for doc_id, text in pairs(rows):
        found = buckets_of(text, quality.BUCKETS)
        raw.update(found)
        if doc_id in trusted:
            target.update(found)
    n_raw, n_target = sum(raw.values()), sum(target.values())

    def weight(b):
        if not n_raw or not n_target:
            return 0
        added = n_target * quality.SMOOTHING / quality.BUCKETS
        ratio = (target[b] + added) / (n_target * raw[b] / n_raw + added)
        return round(math.log(ratio) * quality.SCALE)

    out = []
    for _, text in pairs(rows):
        counts = brute.base_counts(text)
        found = buckets_of(text, quality.BUCKETS)
        score = sum(map(weight, found)) / quality.SCALE / len(found) if found else 0.0
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        out.append((*counts, score, failed, not failed and score >= quality.THRESHOLD))
    return out


def test_a_table_in_which_every_row_stands_twice_gets_the_same_verdicts(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.001/labels.parquet")
    of = lambda df: {r.doc_id: (r.score, r.kept) for r in quality.judge(df, labels).select("doc_id", "quality.score", "quality.kept").collect()}
    assert of(docs) == of(docs.union(docs)) == of(docs.union(docs).union(docs).union(docs))


@pytest.mark.parametrize("clashing", [False, True])
def test_quality_equals_brute_force(spark, clashing):
    rows = odd_docs()
    docs = odd_frame(spark)
    got = quality.judge(with_clashes(docs) if clashing else docs, labels_of(spark), "q").select("q.*").collect()
    want = expected(rows, {18, 30})
    assert len(got) == len(rows)
    by_key = lambda x: (x[0], x[1], x[4], round(x[5], 4))
    found = sorted(
        ((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.score, r.base_failed, r.kept) for r in got),
        key=by_key,
    )
    for a, b in zip(found, sorted(want, key=by_key), strict=True):
        assert a[:5] == b[:5] and a[6:] == b[6:]
        assert a[5] == pytest.approx(b[5], abs=1e-5)


def test_quality_of_nothing_and_without_target(spark):
    docs, labels = odd_frame(spark), labels_of(spark)
    assert quality.judge(docs.limit(0), labels).count() == 0
    judged = quality.judge(docs, labels.limit(0)).select("quality.*")
    assert judged.filter("score <> 0").count() == 0
    assert judged.filter("kept <> (NOT base_failed)").count() == 0


def test_quality_runs_without_python(spark):
    plan = queries.op1_quality_rules(spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "Arrow" not in plan


def test_quality_separates_the_labels(spark):
    rows = queries.op1_quality_rules(spark, f"{TESTDATA}/sf0.01")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet").select("doc_id", "quality")
    shares = {
        r.quality: r.share
        for r in rows.filter("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(
            F.avg(F.col("kept").cast("int")).alias("share")
        ).collect()
    }
    assert shares[1] >= 0.97 and shares[0] <= 0.1


@pytest.fixture(scope="module")
def con():
    return connect(f"{TESTDATA}/sf0.01")


def test_licences_equal_sql(spark, con):
    df = queries.op9_licence_scan(spark, f"{TESTDATA}/sf0.01")
    assert difference(df, con, licences.oracle()) is None


TEXTS = [
    (1, "Some prose\nLicensed under the Apache License, Version 2.0.", "Apache-2.0", "permissive"),
    (2, "Prose. Released under the MIT License. More prose.", "MIT", "permissive"),
    (3, "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.",
     "GPL-3.0-only,CC-BY-NC-4.0", "restricted"),
    (4, "The MIT License (MIT)\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this\n"
        "software and associated documentation files (the \"Software\"), to deal in the Software without restriction,\n"
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or\n"
        "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the\n"
        "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\n"
        "copies or substantial portions of the Software.", "MIT", "permissive"),
    (5, "licensed under the apache licence", "", None),
    (6, None, "", None),
    (7, "", "", None),
]


def test_licence_texts_and_odd_cases(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in TEXTS], "doc_id long, text string")
    got = {r.doc_id: (",".join(r.licences), r.licence_kind) for r in licences.scan(docs).collect()}
    assert got == {i: (names, kind) for i, _, names, kind in TEXTS}
    odd = with_clashes(odd_frame(spark))
    assert licences.scan(odd).filter("size(licences) > 0").count() == 0
    assert licences.scan(odd).count() == len(odd_docs())
    assert licences.scan(odd.limit(0)).count() == 0


def test_an_earlier_rule_takes_its_identifiers(spark):
    text = "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License."
    row = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.licence_ids == ["apache2_notice", "apache2_comply"] and row.licence_rules == [4]


URLS = [
    (1, "http://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/en/12?x#y", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "https://example.org/en/22", "example.org", "/en/22", "org/", "allow"),
    (4, "ftp://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
    (5, "https://x.com/de/a#b", "x.com", "/de/a", "com/de/", "block"),
    (6, "https://notexample.org", "notexample.org", "", None, None),
    (7, None, "", "", None, None),
    (8, "no scheme/en/1", "", "", None, None),
    (9, "a://b://c/d", "b:", "//c/d", None, None),
    (10, "https://ÄÉ.com?de", "ÄÉ.com", "", None, None),
    (11, "https://xorg/fr/", "xorg", "/fr/", None, None),
    (11, "https://xorg/fr/", "xorg", "/fr/", None, None),
]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u, *_ in URLS], "page_id long, url string")
    got = urls.judge(with_clashes(pages), queries.URL_RULES).collect()
    found = collections.Counter((r.page_id, r.host, r.path, r.rule) for r in got)
    assert found == collections.Counter((i, host, path, rule) for i, _, host, path, rule, _ in URLS)
    verdicts = {r.page_id: r.verdict for r in got}
    assert all(v is None or verdicts[i] == v for i, _, _, _, _, v in URLS)
    assert set(verdicts.values()) <= {"allow", "block"}
    assert urls.judge(pages.limit(0), queries.URL_RULES).count() == 0


def test_templates_generalise_and_reject(spark):
    rows = [(f"/post/{i}", "bad.net") for i in range(40)] + [(f"/about/{i}", "bad.net") for i in range(40)]
    rows += [(f"/user/n{i}x/home", "bad.net") for i in range(30)]
    pages = spark.createDataFrame(rows, "path string, host string").withColumn(
        "bad", F.when(F.col("path").startswith("/post"), True).when(F.col("path").startswith("/about"), False)
    )
    tree = {(r.host, r.key): r for r in urls.templates(pages).collect()}
    assert tree["bad.net", "post/#"].purity > 0.8 > 0.4 > tree["bad.net", "about/#"].purity
    assert tree["bad.net", "user/n#x/home"].template == "/user/n#x/home"
    assert 0.2 < tree["bad.net", "user/n#x/home"].purity < 0.8  # no labels of its own: its host's


def test_similar_branches_merge(spark):
    rows = [(f"/{name}/{i}", i % 2 == 0) for name in ("a", "b") for i in range(30)]
    rows += [(f"/c/{i}", True) for i in range(30)]
    pages = spark.createDataFrame(rows, "path string, bad boolean").withColumn("host", F.lit("h.net"))
    got = {r.key: r.template for r in urls.templates(pages).collect()}
    assert got == {"a/#": "/a|b/#", "b/#": "/a|b/#", "c/#": "/c/#"}


def test_url_hosts_equal_sql(spark, con):
    got = queries.op5_url_templates(spark, f"{TESTDATA}/sf0.01").select("page_id", "host", "path", "rule")
    sql = """
SELECT page_id, host, path, CASE
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN ends_with(host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN ends_with(host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN ends_with(host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
FROM (SELECT page_id, lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)) AS host,
  regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages)"""
    assert difference(got, con, sql) is None


