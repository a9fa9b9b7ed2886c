"""Grouped counts, top-n with ties, null profiles, histograms, box plots,
2-D bins, drift, column alignment, joins and the CSV round trip."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep.functions import fixed_values as fv
from sparkprep.operators import agg, cols, drift, join, profile, split
from sparkprep.plans.registry import query
from sparkprep.session import shared_path
from sparkprep.sources.files import read_table, write_predictions
from sparkprep.sources.tables import table


@query("count_two_keys", """
SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def count_two_keys(spark, d):
    return agg.count_by(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


@query("count_by_year", """
SELECT strftime(o_orderdate, '%Y') AS review_year, o_orderstatus, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY review_year, o_orderstatus""")
def count_by_year(spark, d):
    o = table(spark, d, "orders").withColumn("review_year", F.date_format("o_orderdate", "yyyy"))
    return agg.count_by(o, "review_year", "o_orderstatus")


@query("top_types_lumped", """
WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand),
t AS (SELECT p_brand FROM (SELECT p_brand, rank() OVER (ORDER BY n DESC) AS rk FROM c) r WHERE rk <= 10)
SELECT CASE WHEN p_brand IN (SELECT p_brand FROM t) THEN p_brand ELSE 'Other' END AS brand,
       CAST(count(*) AS BIGINT) AS n, round(avg(p_retailprice), 6) AS avg_price
FROM part GROUP BY brand""")
def top_types_lumped(spark, d):
    p = table(spark, d, "part")
    top = agg.top_n_with_ties(agg.count_by(p, "p_brand"), 10, "n")
    lumped = agg.lump(p, "p_brand", top, out="brand")
    return lumped.groupBy("brand").agg(F.count(F.lit(1)).alias("n"),
                                       F.round(F.avg("p_retailprice"), 6).alias("avg_price"))


_NULL_BASE = """SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity,
  CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS discount,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS returnflag,
  l_tax AS tax FROM lineitem"""


@query("null_profile", f"""
WITH b AS ({_NULL_BASE}),
s AS (SELECT count(*) AS rows, count_if(quantity IS NULL) AS q, count_if(discount IS NULL) AS di,
             count_if(returnflag IS NULL) AS r, count_if(tax IS NULL) AS t FROM b),
l AS (SELECT 'quantity' AS column_name, q AS n_null, rows FROM s
      UNION ALL SELECT 'discount', di, rows FROM s
      UNION ALL SELECT 'returnflag', r, rows FROM s
      UNION ALL SELECT 'tax', t, rows FROM s)
SELECT column_name, CAST(n_null AS BIGINT) AS n_null, CAST(rows - n_null AS BIGINT) AS n_not_null
FROM l WHERE n_null > 0""")
def null_profile(spark, d):
    li = table(spark, d, "lineitem")
    base = li.select(
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_orderkey") % 5 == 0, None).otherwise(F.col("l_discount")).alias("discount"),
        F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_returnflag")).alias("returnflag"),
        F.col("l_tax").alias("tax"))
    return profile.nulls(base)


@query("histogram", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
                  min(log10(o_totalprice)) AS llo, max(log10(o_totalprice)) AS lhi FROM orders)
SELECT 'price' AS kind, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin,
       CAST(count(*) AS BIGINT) AS n FROM orders, s GROUP BY kind, bin
UNION ALL
SELECT 'log10_price', CAST(least(floor((log10(o_totalprice) - llo) / ((lhi - llo) / 10)), 9) AS INTEGER),
       CAST(count(*) AS BIGINT) FROM orders, s GROUP BY 1, 2""")
def histogram(spark, d):
    o = table(spark, d, "orders")
    h1 = profile.histogram(o, "o_totalprice", 10).withColumn("kind", F.lit("price"))
    h2 = profile.histogram(o, F.log10("o_totalprice"), 10).withColumn("kind", F.lit("log10_price"))
    return h1.unionByName(h2).select("kind", "bin", "n")


@query("boxplot_stats", """
WITH q AS (SELECT p_type, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.5) AS med,
                  quantile_cont(p_retailprice, 0.75) AS q3, count(*) AS n FROM part GROUP BY p_type),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.p_type, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, CAST(n AS BIGINT) AS n,
  round(min(CASE WHEN p_retailprice BETWEEN lo AND hi THEN p_retailprice END), 6) AS whisker_lo,
  round(max(CASE WHEN p_retailprice BETWEEN lo AND hi THEN p_retailprice END), 6) AS whisker_hi,
  CAST(count_if(NOT (p_retailprice BETWEEN lo AND hi)) AS BIGINT) AS n_outliers
FROM part p JOIN f ON p.p_type = f.p_type GROUP BY f.p_type, q1, med, q3, n""")
def boxplot_stats(spark, d):
    p = table(spark, d, "part")
    bp = profile.boxplot(p, "p_type", "p_retailprice")
    r = {c: F.round(c, 6).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]}
    return bp.select("p_type", r["q1"], r["median"], r["q3"], F.col("n").cast("long").alias("n"),
                     r["whisker_lo"], r["whisker_hi"], F.col("n_outliers").cast("long").alias("n_outliers"))


@query("bin2d", """
WITH s AS (SELECT min(value) AS xl, max(value) AS xh, min(user_id) AS yl, max(user_id) AS yh FROM events)
SELECT CAST(least(floor((value - xl) / ((xh - xl) / 100)), 99) AS INTEGER) AS bx,
       CAST(least(floor((user_id - yl) / ((yh - yl) / 100)), 99) AS INTEGER) AS "by",
       CAST(count(*) AS BIGINT) AS n
FROM events, s GROUP BY bx, "by" """)
def bin2d(spark, d):
    return profile.bin2d(table(spark, d, "events"), "value", "user_id", bins=100)


_BOX = (10.0, 50.0, 20.0, 80.0)


@query("bbox", f"""
SELECT CAST(least(floor((value - {_BOX[0]}) / (({_BOX[1]} - {_BOX[0]}) / 100)), 99) AS INTEGER) AS bx,
       CAST(least(floor((user_id - {_BOX[2]}) / (({_BOX[3]} - {_BOX[2]}) / 100)), 99) AS INTEGER) AS "by",
       CAST(count(*) AS BIGINT) AS n
FROM events WHERE value BETWEEN {_BOX[0]} AND {_BOX[1]} AND user_id BETWEEN {_BOX[2]} AND {_BOX[3]}
GROUP BY bx, "by" """)
def bbox(spark, d):
    return profile.bin2d(table(spark, d, "events"), "value", "user_id", bins=100, bounds=_BOX)


@query("freq_weights", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sqrt(count(*)), 6) AS weight
FROM events GROUP BY event_type""")
def freq_weights(spark, d):
    w = profile.weights(table(spark, d, "events"), "event_type")
    return w.select("event_type", "n", F.round("weight", 6).alias("weight"))


@query("distinct_and_profile", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS n_status,
       CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_customers,
       CAST(count_if(o_totalprice > 200000) AS BIGINT) AS n_high_price,
       CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS n_status_f,
       round(min(o_totalprice), 6) AS min_price, round(max(o_totalprice), 6) AS max_price
FROM orders""")
def distinct_and_profile(spark, d):
    o = table(spark, d, "orders")
    return o.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("o_orderstatus").alias("n_status"),
                 F.count_distinct("o_custkey").alias("n_customers"),
                 F.count_if(F.col("o_totalprice") > 200000).alias("n_high_price"),
                 F.count_if(F.col("o_orderstatus") == "F").alias("n_status_f"),
                 F.round(F.min("o_totalprice"), 6).alias("min_price"),
                 F.round(F.max("o_totalprice"), 6).alias("max_price"))


@query("level_drift", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY md5('{fv.SPLIT_SEED}:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS rn,
                  count(*) OVER () AS cnt FROM customer),
s AS (SELECT *, rn <= floor(cnt * {fv.VALID_FRACTION}::DOUBLE) AS is_test FROM r),
lv AS (SELECT 'segment' AS column_name, c_mktsegment AS level, is_test FROM s
       UNION ALL SELECT 'nation', CAST(c_nationkey AS VARCHAR), is_test FROM s
       UNION ALL SELECT 'balance_band', CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR), is_test FROM s),
tr AS (SELECT DISTINCT column_name, level FROM lv WHERE NOT is_test),
te AS (SELECT DISTINCT column_name, level FROM lv WHERE is_test)
SELECT column_name, level, 'train_only' AS side FROM (SELECT * FROM tr EXCEPT SELECT * FROM te) a
UNION ALL
SELECT column_name, level, 'test_only' AS side FROM (SELECT * FROM te EXCEPT SELECT * FROM tr) b""")
def level_drift(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.floor(F.col("c_acctbal") / 100).cast("string").alias("balance_band"))
    s = split.holdout(c, fv.VALID_FRACTION, fv.SPLIT_SEED, "c_custkey", "is_test")
    return drift.levels(s.where(~F.col("is_test")), s.where("is_test"),
                        ["segment", "nation", "balance_band"])


@query("align_columns", """
SELECT 'orders' AS side, o_orderkey AS order_key, round(o_totalprice, 2) AS total_price,
       lower(o_orderstatus) AS status FROM orders
UNION ALL
SELECT 'lineitem', l_orderkey, round(sum(l_extendedprice), 2), lower(max(l_returnflag))
FROM lineitem GROUP BY l_orderkey""")
def align_columns(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order key"), F.col("o_totalprice").alias("total price"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    li = (table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("order key"))
          .agg(F.sum("l_extendedprice").alias("total price"), F.max("l_returnflag").alias("status"),
               F.count(F.lit(1)).alias("line count")))
    o, li = cols.rename_pattern(o, " ", "_"), cols.rename_pattern(li, " ", "_")
    o = cols.drop(o, "priority", "not_a_column")
    a, b = cols.align(o, li)
    fix = lambda df: cols.map_where(
        cols.map_where(df, cols.is_string, F.lower), cols.with_prefix("total"),
        lambda c: F.round(c, 2))
    a = cols.keep(fix(a), ["order_key", "total_price", "status"]).withColumn("side", F.lit("orders"))
    b = cols.keep(fix(b), ["order_key", "total_price", "status"]).withColumn("side", F.lit("lineitem"))
    return a.unionByName(b)


@query("positional_join", """
WITH a AS (SELECT o_orderkey AS a_key, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS row_idx FROM orders),
b AS (SELECT o_orderkey AS b_key, o_orderstatus, row_number() OVER (ORDER BY o_orderkey DESC) AS row_idx FROM orders)
SELECT a.row_idx, a_key, o_totalprice, b_key, o_orderstatus FROM a JOIN b ON a.row_idx = b.row_idx""")
def positional_join(spark, d):
    o = table(spark, d, "orders")
    a = o.select(F.col("o_orderkey").alias("a_key"), "o_totalprice")
    b = o.select(F.col("o_orderkey").alias("b_key"), "o_orderstatus")
    return join.positional(a, b, ["a_key"], [-F.col("b_key")]).select(
        "row_idx", "a_key", "o_totalprice", "b_key", "o_orderstatus")


@query("positional_join_text", """
WITH a AS (SELECT c_name, c_acctbal, row_number() OVER (ORDER BY c_name) AS row_idx FROM customer),
b AS (SELECT c_custkey, c_mktsegment,
             row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS row_idx FROM customer)
SELECT a.row_idx, c_name, c_acctbal, c_mktsegment, c_custkey FROM a JOIN b ON a.row_idx = b.row_idx""")
def positional_join_text(spark, d):
    """Positions by text keys; the second has five values, a fifth of all rows
    each."""
    c = table(spark, d, "customer")
    a, b = c.select("c_name", "c_acctbal"), c.select("c_mktsegment", "c_custkey")
    return join.positional(a, b, ["c_name"], ["c_mktsegment", "c_custkey"]).select(
        "row_idx", "c_name", "c_acctbal", "c_mktsegment", "c_custkey")


@query("level_verdict", """
WITH t AS (SELECT c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation,
                  CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, c_custkey % 2 = 0 AS is_test FROM customer),
lv AS (SELECT 'segment' AS column_name, segment AS level, is_test FROM t UNION ALL SELECT 'nation', nation, is_test FROM t
       UNION ALL SELECT 'parity', parity, is_test FROM t),
s AS (SELECT column_name, level, bool_or(is_test) AS te, bool_or(NOT is_test) AS tr FROM lv GROUP BY ALL)
SELECT column_name, CAST(count(*) FILTER (NOT te) AS BIGINT) AS n_train_only, CAST(count(*) FILTER (NOT tr) AS BIGINT) AS n_test_only,
       CASE WHEN count(*) FILTER (NOT te OR NOT tr) > 0 THEN 'different' ELSE 'identical' END AS verdict FROM s GROUP BY column_name""")
def level_verdict(spark, d):
    even = F.col("c_custkey") % 2 == 0
    t = table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"),
        F.when(even, "even").otherwise("odd").alias("parity"), even.alias("is_test"))
    return drift.verdict(t.where("NOT is_test").drop("is_test"), t.where("is_test").drop("is_test"))


@query("enrich_join", """
WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
                          FROM orders) t WHERE rn = 1)
SELECT c_custkey, c_name, o_orderkey, o_totalprice, o_orderstatus
FROM customer c JOIN f ON lpad(CAST(c.c_custkey AS VARCHAR), 5, '0') = lpad(CAST(f.o_custkey AS VARCHAR), 5, '0')""")
def enrich_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    first = join.distinct_first(o, "o_custkey", "o_orderkey")
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return join.enrich(c, first, "c_custkey", "o_custkey", pad=5).select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice", "o_orderstatus")


_CSV_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()),
                            T.StructField("prediction", T.StringType())])


@query("csv_round_trip", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 'YES' ELSE 'NO' END AS prediction FROM orders""")
def csv_round_trip(spark, d):
    o = table(spark, d, "orders")
    pred = o.select("o_orderkey", F.when(F.col("o_totalprice") >= 200000, "YES")
                    .otherwise("NO").alias("prediction"))
    path = shared_path(spark, "predictions-csv")
    write_predictions(pred, path, key="o_orderkey")
    back = read_table(spark, path, schema=_CSV_SCHEMA, row_id=None)
    return back


@query("csv_row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 10 < 7 THEN 0 ELSE 1 END, o_orderkey) AS row_id FROM orders""")
def csv_row_index(spark, d):
    """Two folders of CSV files of unequal size, written in key order and read
    back with row ids in file order."""
    path = shared_path(spark, "ordered-csv")
    o = table(spark, d, "orders").select("o_orderkey")
    first = F.col("o_orderkey") % 10 < 7
    for k, part in enumerate((o.where(first), o.where(~first))):
        part.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.option("header", True).csv(f"{path}/part={k}")
    return read_table(spark, f"{path}/part=*", schema="o_orderkey long", multi_line=False)


@query("summary_quartiles", """
WITH p AS (SELECT CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS price, CAST(p_size AS DOUBLE) AS size FROM part),
l AS (SELECT 'price' AS column_name, price AS v FROM p UNION ALL SELECT 'size', size FROM p)
SELECT column_name, CAST(count(v) AS BIGINT) AS n, CAST(count(*) - count(v) AS BIGINT) AS n_null, round(avg(v), 6) AS mean,
       round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
       round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS max FROM l GROUP BY column_name""")
def summary_quartiles(spark, d):
    p = table(spark, d, "part").select(
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_retailprice")).alias("price"), F.col("p_size").cast("double").alias("size"))
    s = profile.full_summary(p)
    return s.select("column_name", "n", "n_null", *[F.round(c, 6).alias(c) for c in ("mean", "min", "q1", "median", "q3", "max")])


_SUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("column_summary", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS sd, round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM lineitem"""
    for c in _SUM_COLS))
def column_summary(spark, d):
    s = profile.numeric_summary(table(spark, d, "lineitem"), _SUM_COLS)
    return s.select("column_name", F.col("n").cast("long").alias("n"),
                    *[F.round(c, 6).alias(c) for c in ("mean", "sd", "min", "max")])


@query("sentinel_split", """
SELECT CASE WHEN coalesce(pri, 'Not Mentioned') = 'Not Mentioned' THEN 'Not Mentioned' ELSE 'Other' END AS category,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS pri FROM orders) t
GROUP BY category""")
def sentinel_split(spark, d):
    o = table(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_orderpriority")).alias("pri"))
    filled = o.fillna({"pri": fv.NOT_MENTIONED})
    return profile.null_split(filled, "pri", sentinel=fv.NOT_MENTIONED)


@query("level_counts", """
WITH l AS (SELECT 'text' AS column_name, text AS level FROM documents UNION ALL SELECT 'lang' AS column_name, lang AS level FROM documents UNION ALL SELECT 'source' AS column_name, source AS level FROM documents),
c AS (SELECT column_name, level, count(*) AS n FROM l WHERE level IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, md5(level)) AS k FROM c)
SELECT column_name, CASE WHEN k <= 6 THEN level ELSE '(Other)' END AS level, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY ALL""")
def level_counts(spark, d):
    """The six most frequent levels of every text column, and all others together."""
    return profile.level_counts(table(spark, d, "documents"))
