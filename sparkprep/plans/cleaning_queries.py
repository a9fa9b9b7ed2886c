"""Cleaning, imputation and rule-based categorisation on listing-shaped views
of the data tables. Nulls are induced by key arithmetic (the tables have
none); every query runs over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.functions import rules as R
from sparkprep.functions import text as X
from sparkprep.operators import cols, impute
from sparkprep.plans.registry import (q, query, sql_first_match, sql_keywords,
                                      sql_list, sql_match)
from sparkprep.sources.tables import table, text_table

WS = "' ' || chr(9) || chr(13) || chr(10)"


def _yes_no(c):
    return F.when(c == 1, F.lit("YES")).otherwise(F.lit("NO"))


def _nullif(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


# --------------------------------------------------------------- flagship
@query("category_by_rating", f"""
SELECT desc_category, perfect_rating_score, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {sql_keywords('d.text', fv.DESCRIPTION_KEYWORDS)} AS desc_category,
             CASE WHEN l.quality = 1 THEN 'YES' ELSE 'NO' END AS perfect_rating_score
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id) t
GROUP BY desc_category, perfect_rating_score""")
def category_by_rating(spark, d):
    docs = text_table(spark, d, "documents").select(
        "doc_id", R.keyword_category("text", fv.DESCRIPTION_KEYWORDS).alias("desc_category"))
    labels = table(spark, d, "labels").select(
        "doc_id", _yes_no(F.col("quality")).alias("perfect_rating_score"))
    return (docs.join(labels, "doc_id")
            .groupBy("desc_category", "perfect_rating_score")
            .agg(F.count(F.lit(1)).alias("n")))


@query("keyword_category", f"""
SELECT doc_id,
  {sql_keywords('text', fv.DESCRIPTION_KEYWORDS)} AS desc_category,
  {sql_keywords("coalesce(text, 'No Neighborhood Overview')", fv.OVERVIEW_KEYWORDS)} AS overview_category,
  {sql_keywords('text', fv.TRANSIT_KEYWORDS)} AS transit_category,
  {sql_keywords('text', fv.INTERACTION_KEYWORDS)} AS interaction_category,
  {sql_first_match('text', fv.HOST_MENTION_RULES, fv.HOST_MENTION_DEFAULT)} AS host_mentions,
  split_part(text, ',', 1) AS first_clause
FROM documents""")
def keyword_category(spark, d):
    docs = text_table(spark, d, "documents")
    # lower-case each text once; every rule chain reads the same column
    low = docs.select("doc_id", "text", F.lower("text").alias("lt"))
    t = F.col("lt")
    return low.select(
        "doc_id",
        R.keyword_category(t, fv.DESCRIPTION_KEYWORDS, lowered=True).alias("desc_category"),
        R.keyword_category(F.coalesce(t, F.lit("no neighborhood overview")),
                           fv.OVERVIEW_KEYWORDS, lowered=True).alias("overview_category"),
        R.keyword_category(t, fv.TRANSIT_KEYWORDS, lowered=True).alias("transit_category"),
        R.keyword_category(t, fv.INTERACTION_KEYWORDS, lowered=True).alias("interaction_category"),
        R.host_mentions(t, lowered=True).alias("host_mentions"),
        X.before("text", ",").alias("first_clause"))


_flag_sql = ",\n  ".join(
    f"coalesce(CAST(CAST({sql_match('lower(a)', p)} AS INTEGER) AS VARCHAR), {q(fv.NOT_MENTIONED)}) AS {name}"
    for name, p in fv.ACCESS_FLAGS)


@query("flag_levels", f"""
SELECT doc_id,
  {_flag_sql}
FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE text END AS a FROM documents) t""")
def flag_levels(spark, d):
    docs = text_table(spark, d, "documents")
    access = _nullif(F.col("doc_id") % 5 == 0, F.lower("text"))
    low = docs.select("doc_id", access.alias("la"))
    flags = low.select("doc_id", R.access_flags("la", lowered=True).alias("access_flags"))
    expanded = cols.expand(flags, "access_flags")
    return impute.flag_levels(expanded, [n for n, _ in fv.ACCESS_FLAGS])


@query("region_rules", f"""
SELECT doc_id, {sql_first_match('loc', fv.REGION_RULES, fv.REGION_DEFAULT)} AS region
FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE text END AS loc FROM documents) t""")
def region_rules(spark, d):
    docs = text_table(spark, d, "documents")
    loc = _nullif(F.col("doc_id") % 4 == 0, F.col("text"))
    return docs.select("doc_id", R.region(loc).alias("region"))


@query("jurisdiction_rules", f"""
SELECT doc_id, {sql_first_match('text', fv.JURISDICTION_RULES, fv.JURISDICTION_DEFAULT)} AS jurisdiction_state
FROM documents""")
def jurisdiction_rules(spark, d):
    docs = text_table(spark, d, "documents")
    return docs.select("doc_id", R.jurisdiction_state("text").alias("jurisdiction_state"))


_LICENSE_SQL = """CASE WHEN o_orderkey % 13 = 0 THEN NULL
       WHEN o_orderstatus = 'P' THEN 'City registration PENDING'
       ELSE 'STR-' || CAST(o_orderkey AS VARCHAR) END"""


@query("license_status", f"""
SELECT license_status, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN lic IS NULL THEN 'No'
              WHEN contains(lower(lic), 'pending') THEN 'Pending' ELSE 'Yes' END AS license_status
  FROM (SELECT {_LICENSE_SQL} AS lic FROM orders) a) b
GROUP BY license_status""")
def license_status(spark, d):
    o = table(spark, d, "orders")
    lic = (F.when(F.col("o_orderkey") % 13 == 0, F.lit(None))
           .when(F.col("o_orderstatus") == "P", F.lit("City registration PENDING"))
           .otherwise(F.concat(F.lit("STR-"), F.col("o_orderkey").cast("string"))))
    return (o.select(R.license_status(lic).alias("license_status"))
            .groupBy("license_status").agg(F.count(F.lit(1)).alias("n")))


_PTYPE = {"STANDARD": "Apartment", "ECONOMY": "House", "PROMO": "Boutique hotel",
          "MEDIUM": "Condominium", "SMALL": "Loft"}
_ptype_sql = ("CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CASE p_type "
              + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in _PTYPE.items())
              + " ELSE 'Tent' END END")
_prop_sql = ("CASE " + " ".join(
    f"WHEN coalesce(property_type IN {sql_list(vals)}, false) THEN {q(lbl)}"
    for vals, lbl in fv.PROPERTY_CATEGORIES) + f" ELSE {q(fv.PROPERTY_DEFAULT)} END")


@query("property_category", f"""
SELECT p_partkey, property_type, {_prop_sql} AS property_category,
       CASE WHEN nb = 'La Jolla Village' THEN 'La Jolla' ELSE nb END AS neighborhood
FROM (SELECT p_partkey, {_ptype_sql} AS property_type,
             CASE WHEN p_size % 3 = 0 THEN 'La Jolla Village'
                  WHEN p_size % 3 = 1 THEN 'La Jolla' ELSE NULL END AS nb
      FROM part) t""")
def property_category(spark, d):
    p = table(spark, d, "part")
    mapped = None
    for k, v in _PTYPE.items():
        cond = F.col("p_type") == k
        mapped = F.when(cond, F.lit(v)) if mapped is None else mapped.when(cond, F.lit(v))
    ptype = _nullif(F.col("p_partkey") % 17 == 0, mapped.otherwise(F.lit("Tent")))
    nb = (F.when(F.col("p_size") % 3 == 0, F.lit("La Jolla Village"))
          .when(F.col("p_size") % 3 == 1, F.lit("La Jolla")))
    base = p.select("p_partkey", ptype.alias("property_type"), nb.alias("nb"))
    return base.select("p_partkey", "property_type",
                       R.property_category("property_type").alias("property_category"),
                       R.merge_neighborhood("nb").alias("neighborhood"))


@query("extra_charge_flag", """
SELECT o_orderkey, extra_people,
       CASE WHEN extra_people > 0 THEN 'YES' WHEN extra_people <= 0 THEN 'NO' END AS charges_for_extra
FROM (SELECT o_orderkey,
             TRY_CAST(regexp_replace(CASE WHEN o_orderkey % 10 = 0 THEN NULL
                      ELSE '$' || CAST(o_custkey % 3 AS VARCHAR) || '.00' END, '[$,%]', '', 'g') AS DOUBLE) AS extra_people
      FROM orders) t""")
def extra_charge_flag(spark, d):
    o = table(spark, d, "orders")
    txt = _nullif(F.col("o_orderkey") % 10 == 0,
                  F.concat(F.lit("$"), (F.col("o_custkey") % 3).cast("string"), F.lit(".00")))
    base = o.select("o_orderkey", X.parse_number(txt).alias("extra_people"))
    return base.withColumn("charges_for_extra", R.yes_no_positive("extra_people"))


@query("parse_numbers", """
SELECT o_orderkey, price, rate,
       CASE WHEN rate = 100 THEN 'ALL' WHEN rate < 100 THEN 'SOME' WHEN rate IS NULL THEN 'MISSING' END AS host_response
FROM (SELECT o_orderkey,
        TRY_CAST(regexp_replace(CASE WHEN o_orderkey % 11 = 0 THEN 'N/A'
                 ELSE '$' || format('{:,.2f}', o_totalprice) END, '[$,%]', '', 'g') AS DOUBLE) AS price,
        TRY_CAST(regexp_replace(CASE WHEN o_orderkey % 7 = 0 THEN NULL
                 ELSE CAST(o_custkey % 120 AS VARCHAR) || '%' END, '[$,%]', '', 'g') AS DOUBLE) AS rate
      FROM orders) t""")
def parse_numbers(spark, d):
    o = table(spark, d, "orders")
    price_txt = (F.when(F.col("o_orderkey") % 11 == 0, F.lit("N/A"))
                 .otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2))))
    rate_txt = _nullif(F.col("o_orderkey") % 7 == 0,
                       F.concat((F.col("o_custkey") % 120).cast("string"), F.lit("%")))
    base = o.select("o_orderkey", X.parse_number(price_txt).alias("price"),
                    X.parse_number(rate_txt).alias("rate"))
    return base.withColumn("host_response", R.rate_level("rate"))


@query("normalize_city", f"""
SELECT p_partkey,
  coalesce(regexp_replace(regexp_replace(trim(lower(city), {WS}), '[[:punct:]]', '', 'g'),
           '\\s+', ' ', 'g'), 'Missing') AS city
FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL
             ELSE '  ' || upper(p_name) || '.,  ' || p_brand || '! ' END AS city FROM part) t""")
def normalize_city(spark, d):
    p = table(spark, d, "part")
    city = _nullif(F.col("p_partkey") % 9 == 0,
                   F.concat(F.lit("  "), F.upper("p_name"), F.lit(".,  "), F.col("p_brand"), F.lit("! ")))
    return p.select("p_partkey", X.normalize_label(city, fv.MISSING_CITY).alias("city"))


_rules_cond = " OR ".join(f"(contains(h, {q(t)}) AND contains(h, {q(w)}))"
                          for t in fv.RULE_TOPICS for w in fv.RULE_WORDS)


@query("rules_presence", f"""
SELECT doc_id, CASE WHEN coalesce({_rules_cond}, false) THEN 'Yes' ELSE 'No' END AS has_rules
FROM (SELECT doc_id, lower(CASE WHEN doc_id % 6 = 0 THEN NULL ELSE text END) AS h FROM documents) t""")
def rules_presence(spark, d):
    docs = text_table(spark, d, "documents")
    rules_txt = _nullif(F.col("doc_id") % 6 == 0, F.col("text"))
    return docs.select("doc_id", R.has_rules(rules_txt).alias("has_rules"))


@query("bed_and_policy", """
SELECT o_orderkey,
  CASE WHEN pol IN ('strict', 'super_strict_30') THEN 'strict' ELSE pol END AS cancellation_policy,
  CASE WHEN bed = 'Real Bed' THEN 'bed' WHEN bed <> 'Real Bed' THEN 'other' END AS bed_category,
  round(o_totalprice / 100.0, 6) AS price,
  round(o_totalprice / 100.0 / (o_custkey % 5 + 1), 6) AS price_per_guest
FROM (SELECT o_orderkey, o_totalprice, o_custkey,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'strict' WHEN '2-HIGH' THEN 'super_strict_30'
             WHEN '3-MEDIUM' THEN 'moderate' WHEN '4-NOT SPECIFIED' THEN 'flexible' END AS pol,
        CASE o_orderstatus WHEN 'F' THEN 'Real Bed' WHEN 'O' THEN 'Futon' END AS bed
      FROM orders) t""")
def bed_and_policy(spark, d):
    o = table(spark, d, "orders")
    pr = F.col("o_orderpriority")
    pol = (F.when(pr == "1-URGENT", "strict").when(pr == "2-HIGH", "super_strict_30")
           .when(pr == "3-MEDIUM", "moderate").when(pr == "4-NOT SPECIFIED", "flexible"))
    st = F.col("o_orderstatus")
    bed = F.when(st == "F", "Real Bed").when(st == "O", "Futon")
    base = o.select("o_orderkey", "o_totalprice", "o_custkey", pol.alias("pol"), bed.alias("bed"))
    # Sequential visibility: each assignment sees the previous one.
    out = (base.withColumn("cancellation_policy", R.merge_policy("pol"))
           .withColumn("bed_category", R.bed_category("bed"))
           .withColumn("price", F.col("o_totalprice") / 100.0)
           .withColumn("price_per_guest", F.col("price") / (F.col("o_custkey") % 5 + 1)))
    return out.select("o_orderkey", "cancellation_policy", "bed_category",
                      F.round("price", 6).alias("price"),
                      F.round("price_per_guest", 6).alias("price_per_guest"))


@query("string_basics", """
SELECT doc_id,
  CAST(len(string_split(text, ',')) AS BIGINT) AS n_parts,
  coalesce(contains(lower(t), 'the'), false) AS has_the,
  CAST(regexp_matches(t, 'the') AS VARCHAR) AS detect_the,
  coalesce(upper(lg), 'Unknown') AS state,
  CAST(n_chars AS VARCHAR) AS zipcode,
  'has_' || lang AS tag,
  CASE WHEN (coalesce(contains(lower(t), 'the'), false) AND n_chars > 1000) OR lang = 'de' THEN 'long_or_de'
       WHEN coalesce(contains(lower(t), 'the'), false) THEN 'the' ELSE 'none' END AS segment
FROM (SELECT *, CASE WHEN doc_id % 8 = 0 THEN NULL ELSE text END AS t,
             CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS lg FROM documents) s""")
def string_basics(spark, d):
    docs = text_table(spark, d, "documents")
    t = _nullif(F.col("doc_id") % 8 == 0, F.col("text"))
    lg = _nullif(F.col("doc_id") % 5 == 0, F.col("lang"))
    has_the = X.has(t, "the")
    return docs.select(
        "doc_id",
        F.size(F.split("text", ",")).cast("long").alias("n_parts"),
        has_the.alias("has_the"),
        X.detect(t, "the").cast("string").alias("detect_the"),   # null stays null
        F.coalesce(F.upper(lg), F.lit("Unknown")).alias("state"),
        F.col("n_chars").cast("string").alias("zipcode"),
        F.concat(F.lit("has_"), F.col("lang")).alias("tag"),
        F.when((has_the & (F.col("n_chars") > 1000)) | (F.col("lang") == "de"), "long_or_de")
        .when(has_the, "the").otherwise("none").alias("segment"))


# ----------------------------------------------------------- imputation
@query("impute_mean", """
WITH b AS (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS q,
             CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS disc FROM lineitem)
SELECT l_orderkey, l_linenumber,
  round(coalesce(q, (SELECT avg(q) FROM b)), 6) AS quantity,
  round(coalesce(disc, (SELECT avg(disc) FROM b)), 6) AS discount
FROM b""")
def impute_mean(spark, d):
    li = table(spark, d, "lineitem")
    base = li.select("l_orderkey", "l_linenumber",
                     _nullif(F.col("l_orderkey") % 7 == 0, F.col("l_quantity")).alias("quantity"),
                     _nullif(F.col("l_orderkey") % 5 == 0, F.col("l_discount")).alias("discount"))
    filled = impute.mean(base, ["quantity", "discount"])
    return filled.select("l_orderkey", "l_linenumber", F.round("quantity", 6).alias("quantity"),
                         F.round("discount", 6).alias("discount"))


@query("impute_median", """
WITH b AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS price FROM part)
SELECT p_partkey, round(coalesce(price, (SELECT median(price) FROM b)), 6) AS price FROM b""")
def impute_median(spark, d):
    p = table(spark, d, "part")
    base = p.select("p_partkey",
                    _nullif(F.col("p_partkey") % 7 == 0, F.col("p_retailprice")).alias("price"))
    filled = impute.median(base, ["price"], exact=True)
    return filled.select("p_partkey", F.round("price", 6).alias("price"))


@query("impute_constants", """
SELECT o_orderkey,
  coalesce(pri, 'Not Mentioned') AS priority,
  coalesce(st, 'missing') AS status,
  CASE WHEN rate = 100 THEN 'ALL' WHEN rate < 100 THEN 'SOME' WHEN rate IS NULL THEN 'MISSING' END AS rate_level,
  coalesce(rate, 0.0) AS rate
FROM (SELECT o_orderkey,
        CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS pri,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS st,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 120 AS DOUBLE) END AS rate
      FROM orders) t""")
def impute_constants(spark, d):
    o = table(spark, d, "orders")
    base = o.select("o_orderkey",
                    _nullif(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).alias("priority"),
                    _nullif(F.col("o_orderkey") % 7 == 0, F.col("o_orderstatus")).alias("status"),
                    _nullif(F.col("o_orderkey") % 3 == 0,
                            (F.col("o_custkey") % 120).cast("double")).alias("rate"))
    # The level must be derived before the rate itself is filled with 0.
    leveled = base.withColumn("rate_level", R.rate_level("rate"))
    return impute.const(leveled, {"priority": fv.NOT_MENTIONED, "status": "missing", "rate": 0.0}) \
        .select("o_orderkey", "priority", "status", "rate_level", "rate")


@query("impute_group_first", """
WITH b AS (SELECT c_custkey,
             CASE WHEN c_custkey % 50 = 1 THEN NULL ELSE c_nationkey END AS nation,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
f AS (SELECT nation, arg_min(seg, c_custkey) AS fill FROM b WHERE seg IS NOT NULL GROUP BY nation)
SELECT b.c_custkey, CAST(b.nation AS DOUBLE) AS nation, coalesce(b.seg, f.fill) AS segment
FROM b LEFT JOIN f ON b.nation IS NOT DISTINCT FROM f.nation""")
def impute_group_first(spark, d):
    c = table(spark, d, "customer")
    base = c.select("c_custkey",
                    _nullif(F.col("c_custkey") % 50 == 1, F.col("c_nationkey")).alias("nation"),
                    _nullif(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("segment"))
    filled = impute.group_first(base, "segment", by="nation", order_col="c_custkey")
    return filled.select("c_custkey", F.col("nation").cast("double").alias("nation"), "segment")


# ------------------------------------------------------- numeric / dates
@query("log_features", """
SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS log_price,
       round(log10(o_totalprice), 6) AS log10_price, round(sqrt(o_totalprice), 6) AS sqrt_price
FROM orders""")
def log_features(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.round(F.log1p("o_totalprice"), 6).alias("log_price"),
                    F.round(F.log10("o_totalprice"), 6).alias("log10_price"),
                    F.round(F.sqrt("o_totalprice"), 6).alias("sqrt_price"))


@query("date_features", f"""
SELECT o_orderkey, strftime(fr, '%Y-%m-%d') AS first_review,
       CAST(date_diff('day', DATE '{fv.REFERENCE_DATE}', fr) AS DOUBLE) AS days_since,
       strftime(fr, '%Y') AS review_year
FROM (SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 13 = 0 THEN NULL
             ELSE CAST(o_orderdate AS DATE) END, DATE '{fv.SENTINEL_DATE}') AS fr FROM orders) t""")
def date_features(spark, d):
    o = table(spark, d, "orders")
    fr = F.coalesce(_nullif(F.col("o_orderkey") % 13 == 0, F.to_date("o_orderdate")),
                    F.to_date(F.lit(fv.SENTINEL_DATE)))
    base = o.select("o_orderkey", fr.alias("fr"))
    return base.select("o_orderkey", F.date_format("fr", "yyyy-MM-dd").alias("first_review"),
                       F.datediff("fr", F.to_date(F.lit(fv.REFERENCE_DATE))).cast("double")
                       .alias("days_since"),
                       F.date_format("fr", "yyyy").alias("review_year"))
