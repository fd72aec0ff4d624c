"""Url rules and host reputation against plain Python; the SQL agrees in test_catalogue."""

import math
import random
from collections import defaultdict

import duckdb
import pytest

from affinity.llm import reputation as r


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def levels(host):
    bare = host.rsplit(":", 1)[0] if host.rsplit(":", 1)[-1].isdigit() or host.endswith(":") else host
    labels = bare.split(".")
    if bare and all(c in "0123456789." for c in bare):
        return bare, ""
    two = ".".join(labels[-2:])
    return (".".join(labels[-3:]), two) if two in r.LONG_SUFFIXES else (two, labels[-1])


def blocked(outcomes):
    hosts = defaultdict(lambda: [0, 0])
    for host, bad in outcomes:
        hosts[host][0] += bool(bad)
        hosts[host][1] += bad is not None

    def total(rows, key):
        out = defaultdict(lambda: [0, 0])
        for name, (k, n) in rows.items():
            out[key(name)][0] += k
            out[key(name)][1] += n
        return out

    domains = total(hosts, levels)
    suffixes = total(domains, lambda d: d[1])
    every = total(suffixes, lambda s: "")[""]

    def strength(children, parent):
        spread = free = weight = 0.0
        for name, (k, n) in children.items():
            if n:
                pk, pn = parent(name)
                m = (pk + 0.5) / (pn + 1)
                spread += n * (k / n - m) ** 2 / (m * (1 - m))
                free += 1 - n / pn
                weight += n - n * n / pn
        excess, room = spread - free, weight - free
        if room <= 0:
            return r.STRENGTH
        return r.MOST if excess <= 0 else max(r.LEAST, min(r.MOST, (1 - excess / room) / (excess / room)))

    s1 = strength(suffixes, lambda s: every)
    s2 = strength(domains, lambda d: suffixes[d[1]])
    s3 = strength(hosts, lambda h: domains[levels(h)])
    out = set()
    for host, (k, n) in hosts.items():
        domain = levels(host)
        mean = (every[0] + 0.5) / (every[1] + 1)
        for (pk, pn), s in ((suffixes[domain[1]], s1), (domains[domain], s2)):
            mean = (pk + s * mean) / (pn + s)
        a, b = k + s3 * mean, n - k + s3 * (1 - mean)
        mean = a / (a + b)
        if mean - r.Z * math.sqrt(mean * (1 - mean) / (a + b + 1)) > r.BAD_RATE:
            out.add(host)
    return out


def rule(host, path):
    fits = [(h + p, v) for h, p, v in r.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_python(spark, seed):
    rng = random.Random(seed)
    names = ["a.org", "b.org", "www.b.org", "x.b.org", "c.co.uk", "www.c.co.uk", "co.uk", "1.2.3.4", "1.2.3.4:80",
             "d.de", "e.de:8080", "example.com", "www.example.com", "m.www.Example.com", "f.net", "net", "com"]
    rate = {n: rng.random() ** 2 if seed < 3 else 0.9 for n in names}
    pages, outcomes = [], []
    for k in range(600):
        n = rng.choice(names)
        pages.append((k, f"{rng.choice(['http', 'https'])}://{n}{rng.choice(['', '/', '/en/x', '/es/y', '/fr/', '/en'])}"
                         f"{rng.choice(['', '?q=/en/', '#t'])}"))
        bad = None if rng.random() < 0.5 else rng.random() < rate[n]
        outcomes.append((parts(pages[-1][1])[0], bad))
    pages += [(1000, None), (1001, ""), (1002, "no scheme/en/"), (1003, "://"), (1004, "a://B.ÖRG/é\nx?y")]
    outcomes += [(parts(u)[0], None) for _, u in pages[-5:]]
    out = r.judge(spark.createDataFrame(pages, "page_id long, url string"),
                  spark.createDataFrame(outcomes, "host string, bad boolean")).orderBy("page_id").collect()
    bad = blocked(outcomes)
    assert seed == 2 or bad
    for (page, url), row in zip(pages, out, strict=True):
        host, path = parts(url)
        name, verdict = rule(host, path)
        assert tuple(row) == (page, host, path, name, verdict or ("block" if host in bad else "allow"))


def test_outcomes_come_from_the_documents_number(spark):
    pages = spark.createDataFrame([(1, "http://a.b/en/7"), (2, "http://a.b/en/7.html?x=8"), (3, "http://a.b/7/en"),
                                   (4, "http://a.b/en/8/"), (5, None), (6, "http://a.b/9"), (7, f"http://a.b/{'9' * 30}")],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 0), (9, 1, None), (9, 1, 1), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = r.page_outcomes(pages, labels).collect()
    assert sorted((x.host, x.bad) for x in got if x.bad is not None) == [
        ("a.b", False), ("a.b", True), ("a.b", True), ("a.b", True)]
    assert len(got) == 7


def test_empty_tables_repeats_and_clashing_names(spark):
    none = spark.createDataFrame([], "host string, bad boolean")
    pages = spark.createDataFrame([(1, "http://x.y/", "h", "p"), (1, "http://x.y/", "h", "p"), (None, None, None, None)],
                                  "page_id long, url string, host string, path string")
    out = r.judge(pages, none)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert [x.verdict for x in out.collect()] == ["allow"] * 3
    assert r.judge(pages.limit(0), none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert r.judge(pages, r.page_outcomes(pages, labels)).count() == 3


def test_hosts_that_end_in_digits_come_once(spark, tmp_path):
    """``3.4`` has no suffix and ``a.3.4`` has one; both have a domain of that name."""
    rng = random.Random(4)
    names = ["3.4", "a.3.4", "b.3.4", "1.2.3.4", "4", "x.4"]
    pages = [(k, f"http://{rng.choice(names)}/p/{k}") for k in range(300)]
    labels = [(k, int(rng.random() < 0.3 + 0.1 * (k % 5)), 0) for k in range(0, 300, 2)]
    tables = {"pages": spark.createDataFrame(pages, "page_id long, url string"),
              "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int")}
    out = r.judge(tables["pages"], r.page_outcomes(*tables.values()))
    bad = dict((d, q == 0) for d, q, _ in labels)
    wanted = blocked([(parts(u)[0], bad.get(k)) for k, u in pages])
    assert wanted and len(wanted) < len(names)
    got = sorted(map(tuple, out.collect()))
    assert [(row[0], row[4]) for row in got] == [
        (k, "block" if parts(u)[0] in wanted else "allow") for k, u in pages]
    with duckdb.connect() as db:
        for name, table in tables.items():
            table.write.parquet(f"{tmp_path}/{name}")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
        assert sorted(db.execute(r.oracle_sql()).fetchall()) == got
