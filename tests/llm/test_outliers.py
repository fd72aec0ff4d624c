"""Text statistics against plain Python, and the estimates against numpy."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from affinity.llm import outliers as o

COLUMNS = "doc_id long, text string, lang string, source string"


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"{'ab' * rng.randint(1, 5)}{k}" for k in range(150)] + ["é" * 5, "x#", "|", "😀", "a\u00a0b"]
    out = [None, "", " \n\t\x0b\x0c\r ", "a", "a b", "a a a", "a a a a", "one\n\none\none \none", "a b c " * 40]
    for _ in range(n):
        w = rng.choices(vocabulary, k=rng.randint(30, 300))
        if rng.random() < 0.3:
            at = rng.randrange(len(w))
            w[at:at] = w[:rng.randint(1, len(w))]
        if rng.random() < 0.15:
            w = [x + "###" for x in w]
        line = rng.randint(4, 30)
        rows = [" ".join(w[i:i + line]) for i in range(0, len(w), line)]
        if rng.random() < 0.2:
            rows += rows[:3]
        out.append("\n".join(rows))
    return out


def verdicts(rows):
    """The method with numpy: rows of (statistics, base_failed, lang, source) give kept or not."""
    x = np.array([[np.log(max(n, 1)), np.log(max(c, 1) / max(n, 1)), *np.sqrt(np.array([s, d, r]) / max(n, 1))]
                  for (n, c, s, d, r, _), _, _ in rows])
    failed = np.array([s[5] for s, _, _ in rows])
    of = defaultdict(list)
    for i, (_, lang, source) in enumerate(rows):
        of[lang, source].append(i)
    n = {k: int((~failed[v]).sum()) for k, v in of.items()}
    small = Counter()
    for (lang, _), v in n.items():
        small[lang] += v if v < o.LEAST_GROUP else 0
    groups = defaultdict(list)
    for k, v in of.items():
        groups[k if n[k] >= o.LEAST_GROUP else k[0] if small[k[0]] >= o.LEAST_GROUP else ""] += v
    kept = ~failed
    for v in groups.values():
        v = np.array(v)
        y = x[v[~failed[v]]]

        def quantile(a, share):
            bins = np.sort(np.floor(a * o.FINE))
            return bins[int(np.ceil(share * len(bins) - 1e-9)) - 1] if len(bins) else 0

        middle = np.array([(quantile(c, 0.5) + 0.5) / o.FINE for c in y.T])
        spread = np.array([(quantile(abs(c - m), 0.5) + 0.5) / o.FINE for c, m in zip(y.T, middle, strict=True)])
        inverse = np.diag(1 / ((1.4826 * spread) ** 2 + o.FLOOR ** 2))
        for _ in range(o.STEPS):
            d = np.einsum("ij,jk,ik->i", y - middle, inverse, y - middle)
            near = np.log(d + 1e-9)
            sub = y[np.floor(near * o.FINE) <= quantile(near, o.SUBSET)]
            if len(sub) < o.LEAST_GROUP * o.SUBSET:
                break
            middle = sub.mean(0)
            inverse = np.linalg.inv(o.CONSISTENCY * np.cov(sub.T, bias=True) + o.FLOOR ** 2 * np.eye(o.SIZE))
        else:
            d = np.einsum("ij,jk,ik->i", x[v] - middle, inverse, x[v] - middle)
            kept[v] &= d <= o.CUTOFF
    return kept.tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python_and_numpy(spark, seed):
    rng = random.Random(seed)
    rows = [(k, t, rng.choice(["en", "en", "en", "de", None]), rng.choice(["hot", "hot", "hot", "a", "b", None]))
            for k, t in enumerate(texts(seed, 500))]
    got = o.quality_rules(spark.createDataFrame(rows, COLUMNS)).orderBy("doc_id").collect()
    wanted = [plain(t) for _, t, _, _ in rows]
    assert [tuple(r)[1:7] for r in got] == wanted
    kept = verdicts([(w, lang, source) for w, (_, _, lang, source) in zip(wanted, rows, strict=True)])
    assert [r.kept for r in got] == kept
    rejected = sum(not k and not w[5] for k, w in zip(kept, wanted, strict=True))
    assert rejected > 20 and sum(kept) > 250


def test_long_text_repeated_rows_clashing_names_and_empty_table(spark):
    long = " ".join(f"w{i % 9973}" for i in range(60_000))
    docs = spark.createDataFrame([(1, long, "en", "s", 7), (1, long, "en", "s", 7), (None, None, None, None, 8)],
                                 COLUMNS + ", n_words int")
    out = o.quality_rules(docs)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept"]
    a, b, c = sorted(out.collect(), key=lambda r: r.doc_id is None)
    assert a == b and tuple(a)[1:7] == plain(long) and c.n_words == 0 and not c.kept
    assert o.quality_rules(docs.limit(0)).count() == 0


def test_small_tables_keep_what_passes_the_base_rules(spark):
    rows = [(k, " ".join(f"w{k * 60 + i}" for i in range(60)) + " ###" * (k % 2) * 50, "en", "s") for k in range(10)]
    assert all(r.kept for r in o.quality_rules(spark.createDataFrame(rows, COLUMNS)).collect())


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s")], COLUMNS)
    plan = o.statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
