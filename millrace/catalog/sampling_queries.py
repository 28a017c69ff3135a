"""Splits, samples, balancing, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import LABELLED, THREE_WAY, hash_order, labelled_orders, query, stratified_cte, table
from millrace.operators import sampling
from millrace.session import materialise

RANK = f"row_number() OVER (ORDER BY {hash_order(42, 'o_orderkey')})"
SAMPLE_RANK = f"row_number() OVER (ORDER BY {hash_order('sample:42', 'o_orderkey')})"


def _orders(spark, sf_dir):
    return labelled_orders(spark, sf_dir).select("o_orderkey", "target")


@query("split_random", f"SELECT o_orderkey, {RANK} <= (SELECT (count(*) * 3 + 9) // 10 FROM orders) AS is_test FROM orders")
def split_random(spark, sf_dir):
    return sampling.random_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.3)


@query("split_stratified", f"""
    WITH {stratified_cte('s', 'orders', 'o_orderkey', 'o_orderpriority', 3, 10, 42)}
    SELECT o_orderkey, o_orderpriority, is_test FROM s""")
def split_stratified(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_split(orders, "o_orderkey", "o_orderpriority", 0.3)


@query("split_stratified_many", f"""
    WITH {stratified_cte('s', 'orders', 'o_orderkey', 'o_custkey', 3, 10, 42)}
    SELECT o_orderkey, o_custkey, is_test FROM s""")
def split_stratified_many(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return sampling.stratified_split(orders, "o_orderkey", "o_custkey", 0.3)


@query("split_three_way", f"WITH {THREE_WAY} SELECT o_orderkey, target, split FROM parts")
def split_three_way(spark, sf_dir):
    return sampling.three_way_split(_orders(spark, sf_dir), "o_orderkey", "target")


@query("sample_n", f"SELECT o_orderkey, o_totalprice FROM orders QUALIFY {SAMPLE_RANK} <= 1000")
def sample_n(spark, sf_dir):
    return sampling.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)


@query("sample_frac", f"SELECT o_orderkey FROM orders QUALIFY {SAMPLE_RANK} <= (SELECT round_even(count(*) * 0.2, 0) FROM orders)")
def sample_frac(spark, sf_dir):
    return sampling.sample_fraction(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.2)


def _undersample_sql(quota: str) -> str:
    return f"""
    WITH {LABELLED}, counts AS (SELECT target, count(*) AS n FROM labelled GROUP BY target),
        major AS (SELECT target FROM counts ORDER BY n DESC, target LIMIT 1)
    SELECT o_orderkey, target FROM labelled QUALIFY target <> (SELECT target FROM major)
        OR row_number() OVER (PARTITION BY target ORDER BY {hash_order('balance:42', 'o_orderkey')})
            <= (SELECT least({quota}, max(n)) FROM counts)"""


@query("undersample", _undersample_sql("min(n)"))
def undersample(spark, sf_dir):
    return sampling.undersample(_orders(spark, sf_dir), "o_orderkey", "target", "auto")


@query("undersample_ratio", _undersample_sql("CAST(floor(min(n) / 0.75) AS BIGINT)"))
def undersample_ratio(spark, sf_dir):
    return sampling.undersample(_orders(spark, sf_dir), "o_orderkey", "target", 0.75)


@query("split_hash", """
    SELECT event_id, CASE WHEN CAST('0x' || substr(md5(concat_ws(':', '42', event_id)), 1, 8) AS BIGINT) % 3 < 2
        THEN 'train' ELSE 'eval' END AS split FROM events""")
def split_hash(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", sampling.hash_split("event_id", 42).alias("split"))


@query("page_batch", """
    WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
    SELECT o_orderkey, o_totalprice, 1 AS batch_number, 1000 AS start_row,
        CAST((SELECT least(2000, count(*)) FROM orders) AS INTEGER) AS end_row,
        CAST((SELECT least(2000, count(*)) - 1000 FROM orders) AS INTEGER) AS batch_size
    FROM r WHERE i >= 1000 AND i < 2000""")
def page_batch(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rows, info = sampling.page(orders, "o_orderkey", 1, 1000)
    return rows.select("*", *[F.lit(v).alias(k) for k, v in info.items()])


@query("page_batch_limited", """
    WITH r AS (SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events)
    SELECT event_id, user_id FROM r WHERE i >= 700 AND i < 750""")
def page_batch_limited(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return sampling.page(events, "event_id", 7, 100, limit=50)[0]


@query("page_assign", """
    SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // 150 AS INTEGER) AS batch_number FROM events""")
def page_assign(spark, sf_dir):
    return sampling.assign_pages(table(spark, sf_dir, "events").select("event_id"), "event_id", 150)


@query("page_index", """
    WITH r AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 150 AS page FROM events)
    SELECT CAST(page AS INTEGER) AS batch_number, min(event_id) AS first_key, max(event_id) AS last_key, count(*) AS n_rows
    FROM r GROUP BY page""")
def page_index(spark, sf_dir):
    return sampling.page_index(table(spark, sf_dir, "events"), "event_id", 150)


@query("page_indexed", """
    WITH r AS (SELECT event_id, user_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS page FROM events)
    SELECT event_id, user_id FROM r WHERE page = 0 OR page = (SELECT max(page) FROM r)""")
def page_indexed(spark, sf_dir):
    """The first and the last page through a stored index."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    index = materialise(sampling.page_index(events, "event_id", 100), "page-index")
    last = index.agg(F.max("batch_number")).first()[0]
    pages = [sampling.indexed_page(events, "event_id", index, n) for n in (0, last)]
    return pages[0].unionByName(pages[1])


@query("page_count", f"""
    WITH {THREE_WAY} SELECT split, CAST(ceil(count(*) / 1500) AS BIGINT) AS n_pages FROM parts GROUP BY split""")
def page_count(spark, sf_dir):
    parts = sampling.three_way_split(_orders(spark, sf_dir), "o_orderkey", "target")
    counts = parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("split", sampling.page_count(F.col("n"), 1500).alias("n_pages"))


def _slice_sql(slices: int) -> str:
    return f"""
    WITH n AS (SELECT count(*) // {slices} AS size FROM events),
        r AS (SELECT event_id, event_type, (row_number() OVER (ORDER BY event_id) - 1) // size AS slice, size FROM events, n),
        h AS (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY {hash_order('slice:42', 'event_id')}) AS k
            FROM r WHERE slice < {slices})
    SELECT event_id, event_type, CAST(slice AS INTEGER) AS slice FROM h WHERE k <= size // 10"""


@query("slice_sample_many", _slice_sql(100))
def slice_sample_many(spark, sf_dir):
    return sampling.slice_sample(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", 100)


@query("slice_sample", _slice_sql(10))
def slice_sample(spark, sf_dir):
    return sampling.slice_sample(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")


@query("kfold_assign", f"""
    SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus
        ORDER BY {hash_order('fold:42', 'o_orderkey')}) - 1) % 5 AS INTEGER) AS fold FROM orders""")
def kfold_assign(spark, sf_dir):
    return sampling.kfold(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")
