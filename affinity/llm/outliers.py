"""Quality rules: base rules on text statistics, and robust multivariate outliers.

Words are runs of ``[^\\x20\\x09-\\x0D]``. A text with fewer than ``LEAST_WORDS`` words, or more
than half of whose words lie in repeated three-word windows, fails the base rules. The others'
statistics are transformed (logarithms of counts, square roots of shares) to vectors of five, and
a vector is an outlier if its Mahalanobis distance from its group is above ``CUTOFF``.

Location and scatter are minimum-covariance-determinant estimates per language and source. The
start is the coordinates' medians and median deviations; concentration steps follow: estimate
from the ``SUBSET`` share of vectors nearest by the last estimate, and measure all again; each
step lowers the determinant. The scatter of the last subset is scaled for the normal distribution and
its diagonal raised by ``FLOOR**2``, since shares that are zero nearly everywhere would make
it singular. A group of fewer than ``LEAST_GROUP`` texts joins the small groups of its language,
and those the small groups of all languages; if that is small too, its texts are kept.

All of it is DataFrame functions. A text's statistics come from its own row; estimates are sums,
and order statistics are counts of fixed fine bins, both combined before they are shuffled, so a
source with a third of all texts is no burden; estimates are joined from written tables.

Defined cases: a null text has no words; null language or source is a value of its own; repeated
rows count and are returned each. Only ``doc_id``, ``text``, ``lang`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinity.llm.pseudonyms import bound
from affinity.llm.stage import written

LEAST_WORDS = 50
LEAST_GROUP = 50
SUBSET = 0.75
STEPS = 3
FLOOR = 0.12
#: Squared distance; the 0.99999 quantile of chi-squared with five degrees of freedom.
CUTOFF = 30.86
#: Fixed value: subset share over the chance of chi-squared with seven degrees of freedom to be
#: below the share's quantile of chi-squared with five.
CONSISTENCY = 1.412
#: Bins per unit of a coordinate, and of the logarithm of a distance.
FINE = 256
SIZE = 5

_WHITE = " \t\n\x0b\x0c\r"
_SPLIT = r"[\x20\x09-\x0D]+"
_X = [f"x{i}" for i in range(SIZE)]


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPLIT))


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, the first occurrence included."""
    def windows(w: Column) -> Column:
        return F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))

    def covered(places: Column) -> Column:
        widths = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(widths, F.lit(0), lambda a, x: a + x)

    def twice(rows: Column) -> Column:
        same = F.filter(rows, lambda r, k: (F.get(rows, k + 1)["h"] == r["h"])
                        | (F.when(k > 0, F.get(rows, k - 1)["h"]) == r["h"]))
        return bound(F.sort_array(F.transform(same, lambda r: r["i"])), covered)

    def count(h: Column) -> Column:
        numbered = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            bound(F.sort_array(numbered), twice))

    return bound(bound(words, windows), count)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(_WHITE)) != "")
    return bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def statistics(documents: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the five statistics and ``base_failed`` of every row."""
    text = F.coalesce("text", F.lit(""))
    counted = documents.select("doc_id", "lang", "source", text.alias("text")).select(
        "doc_id", "lang", "source",
        bound(words_of(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"))
    rows = counted.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines",
                          "w.n_repeat_words")
    return rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                           | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def vectors(rows: DataFrame) -> DataFrame:
    """The rows with their transformed statistics ``x0`` to ``x4``."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns({
        "x0": F.log(n), "x1": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x2": F.sqrt(F.col("n_symbols") / n), "x3": F.sqrt(F.col("n_dup_lines") / n),
        "x4": F.sqrt(F.col("n_repeat_words") / n)})


def grouped(rows: DataFrame) -> DataFrame:
    """The rows with ``estimated``, whether they count in estimates, and ``group``."""
    def shown(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))

    rows = rows.withColumns({"_lang": shown("lang"), "_both": F.concat_ws("\0", shown("lang"), shown("source"))})
    sizes = rows.groupBy("_lang", "_both").agg(F.sum((~F.col("base_failed")).cast("long")).alias("n"))
    by_lang = sizes.groupBy("_lang").agg(
        F.sum(F.when(F.col("n") < LEAST_GROUP, F.col("n")).otherwise(0)).alias("of_lang"))
    group = (F.when(F.col("n") >= LEAST_GROUP, F.col("_both")).when(F.col("of_lang") >= LEAST_GROUP, F.col("_lang"))
             .otherwise(""))
    named = written(sizes.join(by_lang, "_lang").select("_both", group.alias("group")))
    return rows.join(named, "_both").withColumn("estimated", ~F.col("base_failed")).drop("_lang", "_both")


def _quantiles(rows: DataFrame, keys: list[str], value: Column, share: float) -> DataFrame:
    """The bin that holds the ``share`` quantile of ``value``, per group: ``bin``."""
    counts = rows.groupBy(*keys, F.floor(value * FINE).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("bin")
    return (counts.withColumns({"below": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy(*keys))})
            .where(F.col("below") >= share * F.col("all")).groupBy(*keys).agg(F.min("bin").alias("bin")))


def _start(rows: DataFrame) -> DataFrame:
    """``group, m0.., w00..`` from the coordinates' medians and median deviations."""
    long = rows.select("group", F.posexplode(F.array(*_X)).alias("i", "x"))
    middle = written(_quantiles(long, ["group", "i"], F.col("x"), 0.5)
                     .select("group", "i", ((F.col("bin") + 0.5) / FINE).alias("m")))
    spread = _quantiles(long.join(middle, ["group", "i"]), ["group", "i"], F.abs(F.col("x") - F.col("m")), 0.5)
    both = middle.join(written(spread), ["group", "i"]).withColumn(
        "w", 1 / F.sqrt(F.pow(1.4826 * (F.col("bin") + 0.5) / FINE, 2) + FLOOR ** 2))
    out = both.groupBy("group").agg(
        *[F.max(F.when(F.col("i") == i, F.col("m"))).alias(f"m{i}") for i in range(SIZE)],
        *[F.max(F.when(F.col("i") == i, F.col("w"))).alias(f"w{i}{i}") for i in range(SIZE)])
    return out.withColumns({f"w{i}{j}": F.lit(0.0) for i in range(SIZE) for j in range(i)})


def _estimate(rows: DataFrame) -> DataFrame:
    """``group, m0.., w00..`` of a subset: mean, and the inverse of the scatter's Cholesky factor."""
    pairs = [(i, j) for i in range(SIZE) for j in range(i + 1)]
    sums = rows.groupBy("group").agg(
        F.count("*").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(SIZE)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in pairs])
    for i, j in pairs:  # the factor, row by row
        scatter = CONSISTENCY * F.col(f"c{i}{j}") + (FLOOR ** 2 if i == j else 0.0)
        left = scatter - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        sums = sums.withColumn(f"l{i}{j}", F.sqrt(left) if i == j else left / F.col(f"l{j}{j}"))
    for j in range(SIZE):  # its inverse, column by column
        for i in range(j, SIZE):
            under = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            sums = sums.withColumn(f"w{i}{j}", (F.lit(1.0) if i == j else -under) / F.col(f"l{i}{i}"))
    return sums.where(F.col("n") >= LEAST_GROUP * SUBSET).select(
        "group", *[f"m{i}" for i in range(SIZE)], *[f"w{i}{j}" for i, j in pairs])


def _measured(rows: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    """The rows with ``distance``, squared, by their group's estimate; null without one."""
    parts = [sum(F.col(f"w{i}{j}") * (F.col(f"x{j}") - F.col(f"m{j}")) for j in range(i + 1)) for i in range(SIZE)]
    return rows.join(estimate, "group", how).withColumn("distance", sum(p * p for p in parts)).select(
        *rows.columns, "distance")


def _nearest(rows: DataFrame) -> DataFrame:
    """Of measured rows, the nearest of each group, ``SUBSET`` of them and those in the same bin."""
    near = F.log(F.col("distance") + 1e-9)
    last = written(_quantiles(rows, ["group"], near, SUBSET).withColumnRenamed("bin", "last"))
    return rows.join(last, "group").where(F.floor(near * FINE) <= F.col("last"))


def quality_rules(documents: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed`` and ``kept`` of every row."""
    rows = written(grouped(written(vectors(statistics(documents)))))
    fitted = rows.where("estimated").select("group", *_X)
    estimate = written(_start(fitted))
    for _ in range(STEPS):
        estimate = written(_estimate(_nearest(_measured(fitted, estimate))))
    outlier = F.coalesce(F.col("distance") > CUTOFF, F.lit(False))
    return _measured(rows, estimate, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~outlier).alias("kept"))


def oracle_sql() -> str:
    """The same as ``quality_rules`` over the table of documents, in SQL."""
    pairs = [(i, j) for i in range(SIZE) for j in range(i + 1)]
    floor2 = FLOOR ** 2

    def quantile(name: str, rows: str, keys: str, value: str, share: float) -> str:
        return f"""
{name}_n AS (SELECT {keys}, CAST(floor({value} * {FINE}) AS BIGINT) AS bin, count(*) AS n FROM {rows} GROUP BY ALL),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY bin) AS below,
    sum(n) OVER (PARTITION BY {keys}) AS total FROM {name}_n),
{name} AS (SELECT {keys}, min(bin) AS bin FROM {name}_c WHERE below >= {share} * total GROUP BY {keys}),"""

    distance = " + ".join("pow(" + " + ".join(f"w{i}{j} * (x{j} - m{j})" for j in range(i + 1)) + ", 2)"
                          for i in range(SIZE))
    out = f"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
word AS (
  SELECT rid, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM doc),
win AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM word WHERE len(w) > 2)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
line AS (
  SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM doc),
stat AS (
  SELECT rid, doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM doc JOIN word USING (rid) JOIN line USING (rid) LEFT JOIN covered c USING (rid)),
vec AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    ln(greatest(n_words, 1)) AS x0, ln(greatest(word_chars, 1) / greatest(n_words, 1)) AS x1,
    sqrt(n_symbols / greatest(n_words, 1)) AS x2, sqrt(n_dup_lines / greatest(n_words, 1)) AS x3,
    sqrt(n_repeat_words / greatest(n_words, 1)) AS x4,
    coalesce('=' || lang, 'null') AS lg, coalesce('=' || lang, 'null') || chr(1) || coalesce('=' || source, 'null') AS ls
  FROM stat),
size AS (SELECT lg, ls, count(*) FILTER (NOT base_failed) AS n FROM vec GROUP BY lg, ls),
named AS (
  SELECT ls, CASE WHEN n >= {LEAST_GROUP} THEN ls
    WHEN sum(CASE WHEN n < {LEAST_GROUP} THEN n ELSE 0 END) OVER (PARTITION BY lg) >= {LEAST_GROUP} THEN lg
    ELSE '' END AS g FROM size),
rows_ AS (SELECT * FROM vec JOIN named USING (ls)),
fit AS (SELECT rid, g, x0, x1, x2, x3, x4 FROM rows_ WHERE NOT base_failed),
long AS (SELECT g, unnest([0, 1, 2, 3, 4]) AS i, unnest([x0, x1, x2, x3, x4]) AS x FROM fit),"""
    out += quantile("mid", "long", "g, i", "x", 0.5)
    out += f"""
off AS (SELECT l.g, l.i, abs(x - (bin + 0.5) / {FINE}) AS x FROM long l JOIN mid ON l.g = mid.g AND l.i = mid.i),"""
    out += quantile("mad", "off", "g, i", "x", 0.5)
    out += f"""
start AS (
  SELECT mid.g, mid.i, (mid.bin + 0.5) / {FINE} AS m,
    1 / sqrt(pow(1.4826 * (mad.bin + 0.5) / {FINE}, 2) + {floor2}) AS w
  FROM mid JOIN mad ON mid.g = mad.g AND mid.i = mad.i),
est0 AS (SELECT g, {", ".join(f"max(m) FILTER (i = {i}) AS m{i}" for i in range(SIZE))},
  {", ".join(f"max(w) FILTER (i = {i}) AS w{i}{i}" if i == j else f"0.0 AS w{i}{j}" for i, j in pairs)}
  FROM start GROUP BY g),"""
    for step in range(STEPS):
        out += f"""
d{step} AS MATERIALIZED (SELECT fit.*, ln({distance} + 1e-9) AS near FROM fit JOIN est{step} USING (g)),"""
        out += quantile(f"q{step}", f"d{step}", "g", "near", SUBSET)
        out += f"""
s{step}_0 AS (SELECT g, count(*) AS n, {", ".join(f"avg(x{i}) AS m{i}" for i in range(SIZE))},
  {", ".join(f"covar_pop(x{i}, x{j}) AS c{i}{j}" for i, j in pairs)}
  FROM d{step} JOIN q{step} USING (g) WHERE floor(near * {FINE}) <= bin GROUP BY g),"""
        last = f"s{step}_0"
        for i, j in pairs:
            left = f"{CONSISTENCY} * c{i}{j}" + (f" + {floor2}" if i == j else "") + "".join(
                f" - l{i}{k} * l{j}{k}" for k in range(j))
            value = f"sqrt({left})" if i == j else f"({left}) / l{j}{j}"
            out += f"\ns{step}_{i}{j}l AS (SELECT *, {value} AS l{i}{j} FROM {last}),"
            last = f"s{step}_{i}{j}l"
        for j in range(SIZE):
            for i in range(j, SIZE):
                under = " + ".join(f"l{i}{k} * w{k}{j}" for k in range(j, i))
                value = "1.0" if i == j else f"-({under})"
                out += f"\ns{step}_{i}{j}w AS (SELECT *, {value} / l{i}{i} AS w{i}{j} FROM {last}),"
                last = f"s{step}_{i}{j}w"
        out += f"\nest{step + 1} AS MATERIALIZED (SELECT * FROM {last} WHERE n >= {LEAST_GROUP * SUBSET}),"
    return out + f"""
judged AS (SELECT rows_.*, {distance} AS distance FROM rows_ LEFT JOIN est{STEPS} e ON e.g = rows_.g)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(distance > {CUTOFF}, false) AS kept
FROM judged"""
