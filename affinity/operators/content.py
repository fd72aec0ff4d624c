"""Tag similarity: TF-IDF weights, cosine above a threshold, lists per product.

Products with the same tags have the same vector, so all pair work is done once
per distinct tag bag (a profile, named by its smallest product id) and brought
back to products only where the answer is bounded by ``k`` per product.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.scalars import tags_to_text
from affinity.operators.pairs import meeting_pairs, owner_pairs, pair_tasks
from affinity.operators.tiles import nearest_rows, tiles_for
from affinity.operators.topk import topk_per_key
from affinity.schemas import HASHED_FEATURES, LIST_SIZE, SIM_THRESHOLD
from affinity.session import cut_lineage

CELL_PROFILES = 256
#: Cells of a table of products that cost as much as a pair looked up by its terms, and what a
#: column adds to a cell, about; only which way the lists are made depends on it.
CELLS_PER_PAIR, COLUMN_SHARE = 400, 0.02
_SLACK = 1e-9
_SCALE = 1_000_000_000


def content_tokens(products: DataFrame) -> DataFrame:
    """Lower-cased words of the tags; blanks at the end give no word."""
    text = F.lower(tags_to_text(F.coalesce("tags", F.lit(""))))
    kept = F.regexp_replace(text, r"\s+$", "")
    words = F.split(kept, r"\s")
    return products.select(
        "product_id",
        F.when((kept == "") & (text != ""), F.array().cast("array<string>"))
        .otherwise(words).alias("tokens"))


def content_hashed_tf(products: DataFrame, features: int = HASHED_FEATURES) -> DataFrame:
    """Term counts in hash buckets, as a sparse vector per product.

    Products come in few files, so they are dealt out before words are cut and hashed.
    """
    text = products.select("product_id",
                           tags_to_text(F.coalesce("tags", F.lit(""))).alias("text"))
    dealt = text.repartition(pair_tasks(products), "product_id")
    words = Tokenizer(inputCol="text", outputCol="words").transform(dealt)
    return (HashingTF(inputCol="words", outputCol="tf", numFeatures=features)
            .transform(words).select("product_id", "tf"))


def hashed_bags(products: DataFrame, features: int = HASHED_FEATURES) -> DataFrame:
    """Like ``content_tokens`` with hash buckets in place of words; only a vector's entries are read."""
    entries = F.arrays_zip(F.col("parts.indices").alias("at"), F.col("parts.values").alias("n"))
    repeated = F.transform(entries, lambda e: F.array_repeat(e["at"].cast("string"), e["n"].cast("int")))
    return (content_hashed_tf(products, features).select("product_id", F.unwrap_udt("tf").alias("parts"))
            .select("product_id", F.flatten(repeated).alias("tokens")))


def _term_counts(tokens: Column) -> Column:
    """Distinct terms of one row with their counts, without a shuffle.

    Equal terms are neighbours in the sorted tokens; a count is the distance between the
    places where terms change, so the work is that of the sort.
    """
    def starts(words: Column) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(
            (i == 0) | (w != F.get(words, i - 1)), i)), lambda i: i.isNotNull())

    def counts(words: Column, places: Column) -> Column:
        return F.transform(places, lambda p, k: F.struct(
            F.get(words, p).alias("term"),
            (F.coalesce(F.get(places, k + 1), F.size(words)) - p).alias("tf")))

    def of(words: Column) -> Column:
        return F.transform(F.array(starts(words)), lambda places: counts(words, places))[0]

    return F.transform(F.array(F.array_sort(tokens)), of)[0]


def _idf(df: Column, total: Column) -> Column:
    return F.log((total + 1.0) / (df + 1.0))


def content_tfidf(bags: DataFrame) -> DataFrame:
    """Weights per product and term: ``tf * ln((m + 1) / (df + 1))``."""
    terms = bags.select("product_id", F.inline(_term_counts(F.col("tokens"))))
    total = bags.agg(F.count("*").alias("m")).scalar()
    idf = cut_lineage(terms.groupBy("term").agg(F.count("*").alias("df")).select(
        "term", "df", _idf(F.col("df"), total).alias("idf")))
    return terms.join(idf, "term").select(
        "product_id", "term", "tf", "df", (F.col("tf") * F.col("idf")).alias("weight"))


def tag_profiles(bags: DataFrame) -> DataFrame:
    """Distinct tag bags: profile id, number of products, sorted tokens.

    Written once: all later steps read this table, not the products.
    """
    return cut_lineage(bags.select("product_id", F.array_sort("tokens").alias("bag"))
                       .groupBy("bag").agg(F.min("product_id").alias("profile"),
                                           F.count("*").alias("members")))


def profile_members(bags: DataFrame, profiles: DataFrame) -> DataFrame:
    return (bags.select("product_id", F.array_sort("tokens").alias("bag"))
            .join(profiles.select("bag", "profile"), "bag").select("product_id", "profile"))


def unit_vectors(profiles: DataFrame) -> DataFrame:
    """Unit TF-IDF vectors as rows ``profile, place, term, w``, rarest term first.

    Profiles whose vector is empty have no rows. Written once, for all steps that read it.
    """
    terms = profiles.select("profile", "members", F.inline(_term_counts(F.col("bag"))))
    total = profiles.agg(F.sum("members").alias("m")).scalar()
    idf = cut_lineage(
        terms.groupBy("term").agg(F.sum("members").alias("df"))
        .select("term", "df", _idf(F.col("df"), total).alias("idf")).where("idf > 0"))
    weighted = cut_lineage(terms.join(idf, "term").select(
        "profile", "term", "df", (F.col("tf") * F.col("idf")).alias("w")))
    norms = weighted.groupBy("profile").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    place = F.row_number().over(Window.partitionBy("profile").orderBy("df", "term"))
    return cut_lineage(weighted.join(norms, "profile").select(
        "profile", place.alias("place"), "term", (F.col("w") / F.col("norm")).alias("w")))


def _with_rests(vectors: DataFrame) -> DataFrame:
    """``tail`` and ``rest``: the lengths of a vector from a term on, and behind it, from one running sum."""
    onward = Window.partitionBy("profile").orderBy(F.desc("place"))
    square = F.col("w") * F.col("w")
    tails = vectors.withColumn("tail", F.sum(square).over(
        onward.rowsBetween(Window.unboundedPreceding, 0)))
    return tails.withColumns({"rest": F.sqrt(F.greatest(F.col("tail") - square, F.lit(0.0))),
                              "tail": F.sqrt("tail")})


def _postings(vectors: DataFrame, threshold: float) -> DataFrame:
    """Index entries ``term, profile, w, rest`` of the leading terms of every vector.

    Two unit vectors whose rarest common term lies where the rest of one of them
    has length at most ``threshold`` cannot reach it, so only terms before that
    point are indexed; very common terms mostly fall behind it.
    """
    return (_with_rests(vectors).where(F.col("tail") > threshold - _SLACK)
            .select("term", "profile", "w", "rest"))


def _cosines(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``a, b, sim`` of the given distinct pairs that have a term in common."""
    one = vectors.select(F.col("profile").alias("a"), "term", F.col("w").alias("w_a"))
    two = vectors.select(F.col("profile").alias("b"), "term", F.col("w").alias("w_b"))
    return (pairs.join(one, "a").join(two, ["b", "term"])
            .groupBy("a", "b").agg(F.sum(F.col("w_a") * F.col("w_b")).alias("sim")))


def _alike() -> Column:
    return F.round(F.col("sim") * _SCALE).cast("long")


def possible_neighbours(seekers: DataFrame, index: DataFrame, tasks: int) -> DataFrame:
    """``a, b``: the profiles that may be nearer to a seeker than its ``least``, by what one term tells.

    Under their rarest common term a pair has nothing in common before, and behind it at best the
    product of the rests. Pairs of profiles that have met already are among them.
    """
    return (meeting_pairs(seekers, index, "term", CELL_PROFILES, tasks)
            .where((F.col("a") != F.col("b")) & (
                F.col("w_a") * F.col("w_b") + F.col("rest_a") * F.col("rest_b") >= F.col("least")))
            .select("a", "b").distinct())


def list_neighbours(vectors: DataFrame, k: int, threshold: float = SIM_THRESHOLD) -> DataFrame:
    """``a, b, sim``: the first ``k`` of every profile above the threshold, itself included.

    Where few terms are shared by many profiles, a table of all products, tile by tile, costs less than
    looking pairs up; both ways give the same.
    """
    of_term = vectors.groupBy("term").agg(F.count("*").alias("n"), F.count_if(F.col("place") == 1).alias("firsts"))
    terms, entries, profiles, pairs = of_term.agg(
        F.count("*"), F.sum("n"), F.sum("firsts"), F.sum(F.col("n").cast("double") * F.col("firsts"))).first()
    if not terms or pairs * CELLS_PER_PAIR < float(profiles) ** 2 * (1 + COLUMN_SHARE * terms):
        return nearest_profiles(vectors, k, threshold)
    rows = vectors.select(F.col("profile").alias("item"), F.xxhash64("term").alias("col"), "w")
    near = nearest_rows(rows, tiles_for(profiles, entries), k, threshold, float(_SCALE))
    return topk_per_key(near.withColumn("alike", _alike()), "a", [F.desc("alike"), F.asc("b")], k).drop("rank", "alike")


def nearest_profiles(vectors: DataFrame, k: int, threshold: float = SIM_THRESHOLD) -> DataFrame:
    """``a, b, sim``: the first ``k`` of every profile above the threshold, itself included.

    Terms are taken in blocks of doubling width, the rarest first. A profile that has ``k`` neighbours looks
    only for others as near as its k-th, so its terms end where the rest of its vector is shorter
    than that: after the first block most profiles have few terms left to look under. The lists so far
    are written after each block and are the bounds of the next.
    """
    rests = cut_lineage(_with_rests(vectors))
    index = cut_lineage(rests.select("term", F.col("profile").alias("b"), F.col("w").alias("w_b"),
                                     F.col("rest").alias("rest_b")))
    lists = cut_lineage(rests.where("place = 1").select(
        F.col("profile").alias("a"), F.col("profile").alias("b"), F.lit(1.0).alias("sim")))
    tasks, start, width = pair_tasks(rests), 1, 1
    while True:
        full = cut_lineage(lists.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("kth"))
                           .where(F.col("n") >= k).select("a", "kth"))
        least = F.coalesce(F.greatest(F.col("kth"), F.lit(float(threshold))), F.lit(float(threshold))) - 2 * _SLACK
        open_ = rests.where(F.col("place") >= start).withColumnRenamed("profile", "a").join(
            full, "a", "left").withColumn("least", least).where(F.col("tail") >= F.col("least"))
        seekers = cut_lineage(open_.where(F.col("place") < start + width).select(
            "term", "a", F.col("w").alias("w_a"), F.col("rest").alias("rest_a"), "least"))
        if seekers.isEmpty():  # tails fall, so no later term is open either
            return lists
        met = lists.select("a", "b")
        possible = cut_lineage(possible_neighbours(seekers, index, tasks).join(met, ["a", "b"], "left_anti"))
        found = _cosines(possible, vectors).where(F.col("sim") > threshold)
        lists = cut_lineage(topk_per_key(lists.unionByName(found).withColumn("alike", _alike()), "a",
                                         [F.desc("alike"), F.asc("b")], k).drop("rank", "alike"))
        start, width = start + width, 2 * width


def profile_pairs(vectors: DataFrame, threshold: float = SIM_THRESHOLD) -> DataFrame:
    """Unordered profile pairs ``a < b`` with cosine above the threshold.

    A pair that reaches it passes the bound under its rarest common term: before
    that term they share nothing, and behind it at best the product of the rests.
    What passes under any term is taken once, and the whole cosine is summed over
    the terms of both.
    """
    postings = cut_lineage(_postings(vectors, threshold))
    found = owner_pairs(postings, "term", "profile", CELL_PROFILES, pair_tasks(vectors))
    possible = (found.where(F.col("w_a") * F.col("w_b") + F.col("rest_a") * F.col("rest_b")
                            > threshold - _SLACK)
                .select(F.least("profile_a", "profile_b").alias("a"),
                        F.greatest("profile_a", "profile_b").alias("b")).distinct())
    return _cosines(cut_lineage(possible), vectors).where(F.col("sim") > threshold)


def content_pairs(bags: DataFrame, threshold: float = SIM_THRESHOLD) -> DataFrame:
    """All ordered similar pairs, one row per pair of profiles.

    Each row stands for ``members1 * members2`` product pairs (for a profile with
    itself, its ordered pairs of different products). ``expand_pairs`` writes
    them out for those who need every product pair as a row.
    """
    profiles = tag_profiles(bags)
    vectors = unit_vectors(profiles)
    sizes = profiles.select("profile", "members")
    own = (vectors.where("place = 1").join(sizes, "profile").where("members > 1")
           .select(F.col("profile").alias("a"), F.col("profile").alias("b"),
                   F.lit(1.0).alias("sim")))
    both = profile_pairs(vectors, threshold).select(
        F.stack(F.lit(2), "a", "b", "sim", "b", "a", "sim").alias("a", "b", "sim"))
    of_a = sizes.select(F.col("profile").alias("a"), F.col("members").alias("members1"))
    of_b = sizes.select(F.col("profile").alias("b"), F.col("members").alias("members2"))
    return (both.unionByName(own).join(of_a, "a").join(of_b, "b")
            .select(F.col("a").alias("profile1"), F.col("b").alias("profile2"),
                    "members1", "members2", "sim"))


def expand_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Product pairs of profile pairs: as many rows as there are similar pairs."""
    one = members.select(F.col("profile").alias("profile1"), "product_id")
    two = members.select(F.col("profile").alias("profile2"), F.col("product_id").alias("rec_id"))
    return (pairs.join(one, "profile1").join(two, "profile2")
            .where("product_id <> rec_id").select("product_id", "rec_id", "sim"))


def content_topk(bags: DataFrame, k: int = LIST_SIZE,
                 threshold: float = SIM_THRESHOLD) -> DataFrame:
    """The ``k`` most similar products of every product, ties by product id.

    Per profile only its ``k + 1`` smallest product ids can enter any list, and
    only the ``k + 1`` first neighbours (by similarity, then smallest id) can
    supply them, so copies are never paired with each other.
    """
    profiles = tag_profiles(bags)
    vectors = unit_vectors(profiles)
    members = profile_members(bags, profiles)
    near = list_neighbours(vectors, k + 1, threshold).withColumn("alike", _alike())
    smallest = cut_lineage(
        topk_per_key(members, "profile", [F.asc("product_id")], k + 1, "place")
        .select(F.col("profile").alias("b"), F.col("product_id").alias("rec_id")))
    lists = cut_lineage(
        topk_per_key(near.join(smallest, "b"), "a", [F.desc("alike"), F.asc("rec_id")], k + 1)
        .groupBy(F.col("a").alias("profile"))
        .agg(F.array_sort(F.collect_list(F.struct("rank", "rec_id", "sim"))).alias("recs")))
    others = F.filter("recs", lambda r: r["rec_id"] != F.col("product_id"))
    return (members.join(lists, "profile")
            .select("product_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "rec"))
            .select("product_id", (F.col("pos") + 1).alias("rank"),
                    F.col("rec.rec_id").alias("rec_id"), F.col("rec.sim").alias("sim")))
