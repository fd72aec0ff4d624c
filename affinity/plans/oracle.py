"""The same results in plain SQL, written apart from the operators.

Each query is one statement over the star-schema tables. Similarities are taken
the long way, over all product pairs, with none of the operators' short cuts.
"""

from __future__ import annotations

import re
from functools import reduce

_VIEWS = {
    "re": r"""SELECT user_id, CAST(regexp_extract(props, '"k": *(\d+)', 1) AS BIGINT) AS product_id,
        CAST(least(5, greatest(1, ceil(value / 20))) AS DOUBLE) AS score,
        epoch_us(ts) // 1000000 AS ts, event_id, event_type FROM events""",
    "ro": """SELECT o_custkey AS user_id, l_partkey AS product_id,
        CAST(ceil(l_quantity / 10) AS DOUBLE) AS score,
        epoch_us(l_shipdate) // 1000000 AS ts, l_orderkey * 10 + l_linenumber AS event_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "pr": """SELECT p_partkey AS product_id, p_name AS name,
        '/img/' || p_partkey || '.jpg' AS image_url, p_type AS categories,
        replace(p_name, ' ', '|') || '|' || p_brand || '|' || p_type AS tags FROM part""",
    "ave": "SELECT product_id, avg(score) AS avg FROM re GROUP BY 1",
    "avo": "SELECT product_id, avg(score) AS avg FROM ro GROUP BY 1",
    "shop": """SELECT pr.*, round(coalesce(avg, 0), 6) AS avg_score
        FROM pr LEFT JOIN ave USING (product_id)""",
    "shopo": """SELECT pr.*, round(coalesce(avg, 0), 6) AS avg_score
        FROM pr LEFT JOIN avo USING (product_id)""",
    # Co-ratings.
    "cnt": "SELECT product_id, count(*) AS c FROM re GROUP BY 1",
    "cf": """SELECT a.product_id, b.product_id AS rec_id, count(*) AS co,
        any_value(x.c) AS n1, any_value(y.c) AS n2
        FROM re a JOIN re b ON a.user_id = b.user_id AND a.product_id <> b.product_id
        JOIN cnt x ON x.product_id = a.product_id JOIN cnt y ON y.product_id = b.product_id
        GROUP BY 1, 2""",
    "cfk": """SELECT * FROM (SELECT product_id, rec_id, co / sqrt(n1::DOUBLE * n2) AS sim,
        row_number() OVER (PARTITION BY product_id
            ORDER BY co::DOUBLE * co / n2 DESC, rec_id) AS rank FROM cf) WHERE rank <= 20""",
    "cnto": "SELECT product_id, count(*) AS c FROM ro GROUP BY 1",
    "cfo": """SELECT a.product_id, b.product_id AS rec_id, count(*) AS co,
        any_value(x.c) AS n1, any_value(y.c) AS n2
        FROM ro a JOIN ro b ON a.user_id = b.user_id AND a.product_id <> b.product_id
        JOIN cnto x ON x.product_id = a.product_id JOIN cnto y ON y.product_id = b.product_id
        GROUP BY 1, 2""",
    # Tag similarity over products.
    "bag": """SELECT product_id, string_split(lower(replace(tags, '|', ' ')), ' ') AS bag FROM pr""",
    "tf": """SELECT product_id, term, count(*) AS tf
        FROM (SELECT product_id, unnest(bag) AS term FROM bag) GROUP BY 1, 2""",
    "df": "SELECT term, count(*) AS df FROM tf GROUP BY 1",
    "tfidf": """SELECT product_id, term, tf, df,
        tf * ln(((SELECT count(*) FROM bag) + 1.0) / (df + 1.0)) AS w FROM tf JOIN df USING (term)""",
    "len": "SELECT product_id, sqrt(sum(w * w)) AS len FROM tfidf GROUP BY 1",
    "cos": """SELECT d.p1, d.p2, d.dot / (x.len * y.len) AS sim FROM (
        SELECT a.product_id AS p1, b.product_id AS p2, sum(a.w * b.w) AS dot
        FROM tfidf a JOIN tfidf b USING (term) GROUP BY 1, 2) d
        JOIN len x ON x.product_id = d.p1 JOIN len y ON y.product_id = d.p2
        WHERE x.len > 0 AND y.len > 0 AND d.dot / (x.len * y.len) > 0.4""",
    "ctk": """SELECT * FROM (SELECT p1 AS product_id, p2 AS rec_id, sim,
        row_number() OVER (PARTITION BY p1 ORDER BY round(sim, 9) DESC, p2) AS rank
        FROM cos WHERE p1 <> p2) WHERE rank <= 20""",
    "prof": """SELECT product_id, min(product_id) OVER (PARTITION BY list_sort(bag)) AS profile,
        count(*) OVER (PARTITION BY list_sort(bag)) AS members FROM bag""",
    "vec": """SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings""",
    "vcos": """SELECT a.vec_id, b.vec_id AS rec_id,
        list_dot_product(a.v, b.v)
            / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS sim
        FROM vec a, vec b WHERE a.vec_id <> b.vec_id""",
    # Re-scoring.
    "rq": """SELECT * FROM (SELECT user_id, product_id, score, ts, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, score DESC, product_id DESC) AS rank
        FROM re) WHERE rank <= 40""",
    "sim": "SELECT product_id, rec_id, co / sqrt(n1::DOUBLE * n2) AS sim FROM cf",
    "cand": """SELECT * FROM (SELECT c.user_id, s.rec_id AS product_id, s.sim,
        row_number() OVER (PARTITION BY c.user_id ORDER BY round(s.sim, 9) DESC, s.rec_id) AS rank
        FROM rq c JOIN sim s ON s.product_id = c.product_id WHERE c.rank = 1
        AND NOT EXISTS (SELECT 1 FROM re WHERE re.user_id = c.user_id
                        AND re.product_id = s.rec_id)) WHERE rank <= 20""",
    "rts": """SELECT cand.user_id, cand.product_id, avg(s.sim * q.score)
            + log10(greatest(count(*) FILTER (q.score > 3), 1))
            + log10(greatest(count(*) FILTER (q.score <= 3), 1)) AS score
        FROM cand JOIN rq q ON q.user_id = cand.user_id AND q.rank <= 21
        JOIN sim s ON s.product_id = cand.product_id AND s.rec_id = q.product_id AND s.sim > 0.4
        GROUP BY 1, 2""",
    "rtl": """SELECT user_id, product_id, score,
        row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, product_id) AS rank
        FROM rts""",
    # Users and requests.
    "usr": """SELECT CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS user_id,
        username, true AS first, ts FROM (
        SELECT c_name AS username, min(c_custkey) AS ts,
            CASE WHEN c_name = '' THEN 0 ELSE list_reduce(
                list_transform(string_split(c_name, ''), lambda x: unicode(x)::BIGINT),
                lambda a, b: (a * 31 + b) % 4294967296) END AS h
        FROM customer GROUP BY c_name)""",
    "req": r"""SELECT c_name AS username,
        CAST(regexp_extract(props, '"k": *(\d+)', 1) AS BIGINT) AS product_id,
        CAST(least(10, greatest(1, ceil(value / 10))) AS DOUBLE) AS score,
        epoch_us(ts) // 1000000 AS ts, event_id
        FROM events JOIN customer ON c_custkey = user_id""",
    "known": """SELECT usr.user_id, product_id, round(score / 2, 2) AS score, req.ts, event_id
        FROM req JOIN usr USING (username)""",
    "log": r"""SELECT event_id, 'PRODUCT_RATING_PREFIX:' AS marker, user_id || '|'
        || CASE event_type WHEN 'purchase' THEN product_id::VARCHAR ELSE 'x' END
        || '|' || score || '|' || ts AS value, user_id,
        CASE event_type WHEN 'purchase' THEN product_id END AS product_id, score, ts, event_type
        FROM re WHERE event_type IN ('purchase', 'error')""",
}

# Three names per customer.
_VIEWS["usr3"] = _VIEWS["usr"].replace("FROM customer GROUP", """FROM (
            SELECT lead || c_name AS c_name, c_custkey FROM customer,
            (VALUES (''), ('Aa'), ('BB')) AS leads(lead)) GROUP""")
# The same re-scoring over the order ratings.
_OF_ORDERS = {r"\bre\b": "ro", r"\brq\b": "rqo", r"\bsim s\b": "simo s", r"\bcf\b": "cfo",
              r"\bcand\b": "cando", r"\brts\b": "rtso", r"s\.sim > 0\.4": "s.sim > 0.05"}
for _name in ("rq", "sim", "cand", "rts", "rtl"):
    _VIEWS[f"{_name}o"] = reduce(lambda sql, swap: re.sub(swap[0], swap[1], sql),
                                 _OF_ORDERS.items(), _VIEWS[_name])

_USES = {
    "ave": ["re"], "avo": ["ro"], "shop": ["pr", "ave"], "shopo": ["pr", "avo"],
    "cnt": ["re"], "cf": ["re", "cnt"], "cfk": ["cf"], "cnto": ["ro"], "cfo": ["ro", "cnto"],
    "bag": ["pr"], "tf": ["bag"], "df": ["tf"], "tfidf": ["bag", "tf", "df"],
    "len": ["tfidf"], "cos": ["tfidf", "len"], "ctk": ["cos"], "prof": ["bag"],
    "vcos": ["vec"], "rq": ["re"], "sim": ["cf"], "cand": ["rq", "sim", "re"],
    "rts": ["cand", "rq", "sim"], "rtl": ["rts"], "rqo": ["ro"], "simo": ["cfo"],
    "cando": ["rqo", "simo", "ro"], "rtso": ["cando", "rqo", "simo"], "rtlo": ["rtso"], "known": ["req", "usr"], "log": ["re"],
}


def _with(select: str, *names: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for other in _USES.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    # The views that several others read are computed once.
    views = ",\n".join(f"{n} AS MATERIALIZED ({_VIEWS[n]})" for n in order)
    return f"WITH {views}\n{select}"


_FEED = "name, image_url, categories, tags, avg_score"
_LIST = f"rank, s.product_id, round(l.score, 6) AS score, {_FEED}"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for suffix, r in (("", "ro"), ("_events", "re")):
        out[f"rate_more_products{suffix}"] = _with(
            f'SELECT product_id, count(*) AS "count" FROM {r} GROUP BY 1', r)
        out[f"rate_more_recently{suffix}"] = _with(
            f"""SELECT product_id, count(*) AS "count",
            CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS BIGINT) AS yearmonth
            FROM {r} GROUP BY 1, 3""", r)
        out[f"average_products{suffix}"] = _with(
            f'SELECT product_id, round(avg(score), 6) AS "avg" FROM {r} GROUP BY 1', r)
    out["product_counts"] = out["rate_more_products"]
    out["distinct_users"] = _with("SELECT DISTINCT user_id FROM ro", "ro")
    out["distinct_products"] = _with("SELECT DISTINCT product_id FROM ro", "ro")
    out["rating_triple"] = _with("SELECT user_id, product_id, score FROM ro", "ro")
    out["attach_product_counts"] = _with(
        'SELECT user_id, product_id, event_id, c AS "count" FROM ro JOIN cnto USING (product_id)',
        "ro", "cnto")

    out["topk_per_key"] = out["ranked_lists"] = _with(
        """SELECT user_id, rank, product_id, score FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY score DESC, product_id, event_id) AS rank FROM ro)
        WHERE rank <= 20""", "ro")
    queue = "SELECT user_id, rank, product_id, score, ts, event_id FROM"
    out["recent_ratings_queue"] = out["stream_recent_queue"] = _with(f"{queue} rq", "rq")
    out["recent_ratings_topn"] = _with(f"{queue} rq WHERE rank <= 21", "rq")
    out["recent_ratings_queue_orders"] = _with(
        f"""{queue} (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY ts DESC, event_id DESC, score DESC, product_id DESC) AS rank FROM ro) WHERE rank <= 40""", "ro")

    out["load_products"] = _with("SELECT * FROM pr", "pr")
    out["load_ratings"] = out["write_table"] = _with(
        "SELECT user_id, product_id, score, ts FROM ro", "ro")
    out["quarantined_ratings"] = _with("SELECT value, 'too few fields' AS reason FROM log", "log")
    out["read_table"] = out["average_products"]
    out["read_similarity"] = _with(
        "SELECT product_id, rec_id, round(sim, 6) AS sim FROM cfk", "cfk")
    out["layout"] = _with("SELECT product_id, user_id, event_id FROM ro", "ro")
    out["lookup_by_key"] = out["products_in_list"] = _with(
        "SELECT * FROM pr WHERE product_id IN (SELECT product_id FROM re)", "pr", "re")
    out["lookup_first_by_key"] = _with(
        """SELECT user_id, product_id, score, ts, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY product_id
            ORDER BY ts, event_id, user_id, score) AS n FROM ro
        WHERE product_id IN (SELECT product_id FROM re)) WHERE n = 1""", "ro", "re")
    upsert = """SELECT user_id, product_id, score, ts, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, product_id
            ORDER BY ts DESC, event_id DESC, score DESC, product_id DESC) AS n FROM {}) WHERE n = 1"""
    out["ratings_upsert"] = _with(upsert.format("re"), "re")
    out["ratings_upsert_orders"] = _with(upsert.format("ro"), "ro")

    out["similarity_threshold"] = _with(
        "SELECT product_id, rec_id, round(sim, 6) AS sim FROM sim WHERE sim > 0.4", "sim")
    out["like_dislike_split"] = _with(
        """SELECT product_id, round(avg(score), 6) AS mean, count(*) FILTER (score > 3) AS likes,
        count(*) FILTER (score <= 3) AS dislikes FROM ro GROUP BY 1""", "ro")
    out["not_yet_rated"] = _with(
        """SELECT user_id, product_id, event_id FROM re v WHERE event_type = 'view'
        AND NOT EXISTS (SELECT 1 FROM re p WHERE p.event_type = 'purchase'
            AND p.user_id = v.user_id AND p.product_id = v.product_id)""", "re")
    out["tracking_log_filter"] = _with("SELECT event_id, value FROM log", "log")
    parsed = "value, user_id, product_id, score, ts"
    out["parse_rating_event"] = _with(
        f"SELECT event_id, {parsed} FROM log WHERE product_id IS NOT NULL", "log")
    out["quarantined_events"] = _with(
        "SELECT event_id, value, 'bad field' AS reason FROM log WHERE product_id IS NULL", "log")
    out["stream_ratings"] = _with(f"SELECT {parsed} FROM log WHERE product_id IS NOT NULL", "log")
    out["stream_log"] = _with(
        """SELECT 'INFO [http] event ' || re.event_id || ' ' || coalesce(marker || value,
        'page ' || re.event_type) AS value FROM re LEFT JOIN log USING (event_id)""", "re", "log")
    out["stream_tracking_filter"] = out["log_sink"] = _with("SELECT 'logProcessor' AS key, value FROM log", "log")
    out["enrich_products"] = _with(
        f"SELECT user_id, rank, product_id, {_FEED} FROM rq JOIN shop USING (product_id) "
        "WHERE rank <= 21", "rq", "shop")
    out["user_resolve"] = _with(
        "SELECT username, product_id, score, req.ts, event_id, user_id "
        "FROM req JOIN usr USING (username)", "req", "usr")

    pairs = """SELECT product_id, rec_id, co AS co_count, n1 AS count1, n2 AS count2,
        round(co / sqrt(n1::DOUBLE * n2), 6) AS sim FROM cf"""
    out["itemcf_pairs"] = _with(pairs, "cf")
    once = _with(pairs, "cf").replace("re AS MATERIALIZED (SELECT", "re AS MATERIALIZED (SELECT *"
                                      " FROM (SELECT", 1)
    out["itemcf_pairs_dedup"] = once.replace(
        "FROM events)", "FROM events) QUALIFY row_number() OVER "
        "(PARTITION BY user_id, product_id ORDER BY event_id) = 1)", 1)
    out["itemcf_topk"] = _with(
        "SELECT product_id, rank, rec_id, round(sim, 6) AS sim FROM cfk", "cfk")
    out["itemcf_topk_orders"] = _with(
        """SELECT product_id, rank, rec_id, round(sim, 6) AS sim FROM (
        SELECT product_id, rec_id, co / sqrt(n1::DOUBLE * n2) AS sim,
        row_number() OVER (PARTITION BY product_id ORDER BY co::DOUBLE * co / n2 DESC, rec_id)
        AS rank FROM cfo) WHERE rank <= 20""", "cfo")

    out["content_tokens"] = _with(
        """SELECT product_id, pos - 1 AS pos, bag[pos] AS token FROM (
        SELECT product_id, bag, unnest(range(1, len(bag) + 1)) AS pos FROM bag)""", "bag")
    out["content_tfidf"] = _with(
        "SELECT product_id, term, tf, df, round(w, 6) AS weight FROM tfidf", "tfidf")
    out["content_pairs"] = _with(
        """SELECT x.profile AS profile1, y.profile AS profile2, x.members AS members1,
        y.members AS members2, round(sim, 6) AS sim FROM cos
        JOIN prof x ON x.product_id = p1 JOIN prof y ON y.product_id = p2
        WHERE p1 = x.profile AND p2 = y.profile AND (p1 <> p2 OR x.members > 1)""",
        "cos", "prof")
    out["content_topk"] = _with(
        "SELECT product_id, rank, rec_id, round(sim, 6) AS sim FROM ctk", "ctk")
    out["dense_cosine_pairs"] = _with(
        "SELECT vec_id, rec_id, round(sim, 6) AS sim FROM vcos WHERE sim > 0.4", "vcos")
    out["dense_cosine_topk"] = _with(
        """SELECT * FROM (SELECT vec_id, rec_id, round(sim, 6) AS sim, row_number() OVER (
        PARTITION BY vec_id ORDER BY round(sim, 9) DESC, rec_id) AS rank FROM vcos
        WHERE sim > 0.4) WHERE rank <= 20""", "vcos")

    split = """CASE WHEN ('0x' || substr(md5(concat_ws('|', user_id, product_id, ts, event_id)),
        1, 8))::BIGINT % 10 < 8 THEN 'train' ELSE 'test' END AS split"""
    out["train_test_split"] = _with(
        f"SELECT user_id, product_id, event_id, {split} FROM ro", "ro")
    out["eval_rmse"] = _with(
        f""", s AS (SELECT *, {split} FROM ro),
        m AS (SELECT product_id, avg(score) AS p FROM s WHERE split = 'train' GROUP BY 1)
        SELECT round(sqrt(avg((score - p) * (score - p))), 6) AS rmse, count(*) AS rows
        FROM s JOIN m USING (product_id) WHERE split = 'test'""", "ro")

    out["realtime_candidates"] = _with(
        "SELECT user_id, rank, product_id, round(sim, 6) AS sim FROM cand", "cand")
    out["realtime_scores"] = _with(
        "SELECT user_id, rank, product_id, round(score, 6) AS score FROM rtl", "rtl")
    out["realtime_candidates_orders"] = _with(
        "SELECT user_id, rank, product_id, round(sim, 6) AS sim FROM cando", "cando")
    out["realtime_scores_orders"] = _with(
        "SELECT user_id, rank, product_id, round(score, 6) AS score FROM rtlo", "rtlo")
    out["stream_recs"] = out["realtime_scores"]
    out["stream_recs_upsert"] = _with(
        """SELECT user_id, count(product_id) AS products
        FROM (SELECT DISTINCT user_id FROM re) LEFT JOIN rtl USING (user_id) GROUP BY 1""",
        "re", "rtl")

    feed = f"SELECT product_id, min(rank) AS rank, 0.0::DOUBLE AS score, {_FEED} FROM " + """(
        SELECT *, row_number() OVER (ORDER BY {}) AS rank FROM ({}) ORDER BY rank LIMIT 20) f
        JOIN shopo USING (product_id) GROUP BY ALL"""
    out["top_rated_feed"] = _with(feed.format(
        "c DESC, product_id", "SELECT product_id, count(*) AS c FROM ro GROUP BY 1"),
        "ro", "shopo")
    out["hot_products_feed"] = _with(feed.format(
        "ym DESC, c DESC, product_id",
        """SELECT product_id, strftime(make_timestamp(ts * 1000000), '%Y%m') AS ym,
        count(*) AS c FROM ro GROUP BY 1, 2"""), "ro", "shopo")
    out["itemcf_for_products"] = _with(
        f"""SELECT l.product_id AS for_product, rank, s.product_id, round(l.sim, 6) AS score, {_FEED}
        FROM cfk l JOIN shop s ON s.product_id = l.rec_id
        WHERE l.product_id IN (SELECT product_id FROM pr)""", "cfk", "shop")
    out["content_for_products"] = _with(
        f"""SELECT l.product_id AS for_product, rank, s.product_id, round(l.sim, 6) AS score, {_FEED}
        FROM ctk l JOIN shop s ON s.product_id = l.rec_id
        WHERE l.product_id IN (SELECT product_id FROM re)""", "ctk", "shop")
    out["stream_for_users"] = _with(
        f"""SELECT c_name AS username, {_LIST} FROM rtl l
        JOIN customer ON c_custkey = l.user_id JOIN shop s ON s.product_id = l.product_id""",
        "rtl", "shop")
    out["product_info"] = _with(
        "SELECT * FROM shopo WHERE product_id IN (SELECT product_id FROM re)", "shopo", "re")
    for name in ("product_search", "product_search_indexed"):
        out[name] = _with("SELECT * FROM shop WHERE regexp_matches(name, 'ring')", "shop")

    out["rating_intake"] = _with(upsert.format("known"), "known")
    out["rating_intake_queue"] = _with(
        f"""{queue} (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY ts DESC, event_id DESC, score DESC, product_id DESC) AS rank FROM known) WHERE rank <= 40""",
        "known")
    out["rating_intake_log"] = _with(
        """SELECT event_id, 'PRODUCT_RATING_PREFIX:' || user_id || '|' || product_id || '|'
        || score || '|' || ts AS value FROM known""", "known")
    out["user_dim"] = _with("SELECT * FROM usr", "usr")
    out["user_id_collisions"] = _with(
        """SELECT user_id, count(*) AS names, min(username) AS first_name,
        max(username) AS last_name FROM usr3 GROUP BY 1 HAVING count(*) > 1""", "usr3")
    out["user_profile_upsert"] = _with(
        """SELECT c_custkey AS user_id, c_name AS username, n.user_id IS NULL AS first,
        coalesce(n.categories, '') AS pref_genres FROM customer LEFT JOIN (
            SELECT re.user_id, categories, row_number() OVER (PARTITION BY re.user_id
                ORDER BY ts DESC, event_id DESC) AS n
            FROM re JOIN pr USING (product_id) WHERE event_type = 'signup') n
        ON n.user_id = c_custkey AND n.n = 1""", "re", "pr")
    return {name: sql.replace(")\n,", "),", 1) for name, sql in out.items()}
