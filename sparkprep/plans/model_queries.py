"""Model queries (Spark ML). The fits are not SQL-expressible: they are
checked rows-only by the driver and by contract tests in tests/test_models.py.
The feature table they all start from is SQL-checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.operators import encode, evaluate
from sparkprep.plans import models, workflows
from sparkprep.plans.registry import query
from sparkprep.plans.workflows import SPEC, TARGET, listing_features, split_listings
from sparkprep.session import materialize


def _training_lasso(spark, d, n_lambdas=100):
    lab = listing_features(spark, d, True)
    train = materialize(split_listings(lab).where(F.col("split") == "train"))
    return models.lasso_cv(SPEC, train, folds=10, n_lambdas=n_lambdas)


@query("lasso_select")
def lasso_select(spark, d):
    return models.nonzero_features(_training_lasso(spark, d), spark)


@query("lasso_path")
def lasso_path(spark, d):
    """Cross-validated loss and number of features along the 100 penalties."""
    return models.path_table(_training_lasso(spark, d), spark)


@query("forest_importance")
def forest_importance(spark, d):
    lab = listing_features(spark, d, True)
    train = materialize(split_listings(lab).where(F.col("split") == "train"))
    model = models.random_forest(SPEC, train)
    return models.importance(model, SPEC.names(model), spark, top=10)


@query("forest_metrics")
def forest_metrics(spark, d):
    return workflows.enriched_forest(spark, d)


@query("forest_report")
def forest_report(spark, d):
    return workflows.forest_at_threshold(spark, d)


def _boosting_parts(spark, d, weight):
    lab = listing_features(spark, d, True).withColumn("weight", encode.class_weight(TARGET, {"YES": weight}))
    parts = materialize(split_listings(lab))
    spec, _ = workflows.lasso_spec(parts.where(F.col("split") == "train"))
    return parts, spec


@query("gbt_scores")
def gbt_scores(spark, d):
    parts, spec = _boosting_parts(spark, d, fv.BOOST_POS_WEIGHT)
    model = models.gbt(spec, parts.where(F.col("split") == "train"), rounds=50, step=0.18,
                       max_depth=models.MAX_DEPTH, min_node=4)
    valid = parts.where(F.col("split") == "valid_use")
    scored = models.score(model, valid).withColumn(
        "pred", evaluate.classify("prob_yes", 0.45, inclusive=True))
    return scored.select("doc_id", TARGET, "prob_yes", "pred")


def _early_stop(spark, d):
    parts, spec = _boosting_parts(spark, d, fv.LEAFWISE_POS_WEIGHT)
    train, valid = (parts.where(F.col("split") == s) for s in ("train", "valid_use"))
    return models.gbt_patience(spec, train, valid, rounds=200, patience=fv.PATIENCE, step=0.28, max_depth=6, min_node=35,
                               subsample=0.8, feature_fraction="0.8"), valid


@query("gbt_early_stop")
def gbt_early_stop(spark, d):
    fit, valid = _early_stop(spark, d)
    valid = models.score(fit.model, valid)
    auc = evaluate.auc(valid.withColumn("y", encode.binary_label(TARGET)), "prob_yes", "y")
    m = evaluate.binary_metrics(valid.withColumn("pred", evaluate.classify("prob_yes", 0.5, False)),
                                "pred", TARGET)
    return m.select(F.lit(auc).alias("auc"), (1 - F.col("accuracy")).alias("error_rate"),
                    F.lit(fit.best).alias("n_trees"))


@query("gbt_curve")
def gbt_curve(spark, d):
    """Validation loss after each boosting round, up to the round that stopped it."""
    fit, _ = _early_stop(spark, d)
    return spark.createDataFrame([(i + 1, loss, i + 1 == fit.best) for i, loss in enumerate(fit.curve)], "round int, loss double, kept boolean")


@query("logit_cv")
def logit_cv(spark, d):
    return workflows.logit_cv(spark, d)


@query("learning_curve")
def learning_curve(spark, d):
    return workflows.learning_curve(spark, d)


@query("fit_score")
def fit_score(spark, d):
    return workflows.fit_score_write(spark, d, kind="forest")


@query("fit_score_lasso")
def fit_score_lasso(spark, d):
    return workflows.fit_score_write(spark, d, kind="lasso")


@query("fit_score_gbt")
def fit_score_gbt(spark, d):
    return workflows.fit_score_write(spark, d, kind="gbt")


@query("fit_score_gbt_early_stop")
def fit_score_gbt_early_stop(spark, d):
    return workflows.fit_score_write(spark, d, kind="gbt_early_stop")


def _feature_sql():
    from sparkprep.plans.registry import sql_first_match, sql_keywords, sql_match
    flags = ",\n  ".join(
        f"CAST(coalesce(CAST({sql_match('lt', p)} AS INTEGER), 0) AS DOUBLE) AS {name}"
        for name, p in fv.ACCESS_FLAGS)
    rules = " OR ".join(f"(contains(lt, '{t}') AND contains(lt, '{w}'))"
                        for t in fv.RULE_TOPICS for w in fv.RULE_WORDS)
    return f"""
SELECT d.doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars_f, round(ln(1 + n_chars), 6) AS log_chars,
  CAST(len(string_split(text, ',')) - 1 AS DOUBLE) AS n_commas,
  {flags},
  {sql_keywords('lt', fv.DESCRIPTION_KEYWORDS)} AS desc_category,
  {sql_keywords('lt', fv.TRANSIT_KEYWORDS)} AS transit_category,
  {sql_first_match('lt', fv.HOST_MENTION_RULES, fv.HOST_MENTION_DEFAULT)} AS host_mentions,
  CASE WHEN coalesce({rules}, false) THEN 'Yes' ELSE 'No' END AS has_rules,
  CASE WHEN l.quality = 1 THEN 'YES' ELSE 'NO' END AS perfect_rating_score,
  CAST(l.quality = 1 AS DOUBLE) AS label,
  CASE WHEN l.quality = 1 THEN {fv.CLASS_WEIGHTS['YES']} ELSE {fv.CLASS_WEIGHTS['NO']} END::DOUBLE AS weight
FROM (SELECT *, lower(text) AS lt FROM documents) d JOIN labels l ON d.doc_id = l.doc_id"""


@query("listing_feature_table", _feature_sql())
def listing_feature_table(spark, d):
    """The model input: every labelled listing with its derived features."""
    t = listing_features(spark, d, True)
    return t.withColumn("log_chars", F.round("log_chars", 6))


def listing_adapter(spark, d):
    """A listing-shaped table derived from ``documents`` (FIXTURES.md §1
    columns): texts from the document text, categories from lang/source,
    numbers and money/percent text from the character count, nulls by key."""
    from sparkprep.sources.tables import text_table
    docs = text_table(spark, d, "documents")
    k, n = F.col("doc_id"), F.col("n_chars")

    def null_every(m, v):
        return F.when(k % m == 0, F.lit(None)).otherwise(v)

    def money(v):
        return F.concat(F.lit("$"), F.format_number(v, 2))
    return docs.select(
        k.alias("row_id"),
        F.col("text").alias("description"), null_every(7, F.col("text")).alias("neighborhood_overview"),
        F.col("text").alias("host_about"), F.col("text").alias("transit"),
        null_every(5, F.col("text")).alias("access"), null_every(6, F.col("text")).alias("house_rules"),
        F.col("lang").alias("space"), F.col("text").alias("street"),
        F.col("source").alias("host_location"), F.col("source").alias("jurisdiction_names"),
        null_every(9, F.col("source")).alias("city"),
        null_every(11, money(n / 10)).alias("price"), null_every(13, money(n / 100)).alias("cleaning_fee"),
        money(n % 3).alias("extra_people"),
        null_every(4, F.concat((n % 120).cast("string"), F.lit("%"))).alias("host_acceptance_rate"),
        null_every(3, F.concat((n % 110).cast("string"), F.lit("%"))).alias("host_response_rate"),
        null_every(8, F.concat_ws(",", "lang", "source")).alias("amenities"),
        null_every(10, F.col("source")).alias("host_verifications"),
        null_every(12, F.col("lang")).alias("features"),
        null_every(4, F.col("source")).alias("market"), F.col("lang").alias("neighborhood"),
        null_every(9, (n % 4).cast("double")).alias("bathrooms"),
        null_every(7, (n % 5).cast("double")).alias("bedrooms"),
        F.when(n % 3 == 0, "Apartment").when(n % 3 == 1, "House").alias("property_type"),
        F.when(n % 2 == 0, "Real Bed").otherwise("Futon").alias("bed_type"),
        F.when(n % 4 == 0, "super_strict_30").when(n % 4 == 1, "flexible").alias("cancellation_policy"),
        F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, "pending").otherwise(k.cast("string")).alias("license"),
        null_every(13, F.date_add(F.lit("2010-01-01").cast("date"), (k % 3000).cast("int"))).alias("first_review"),
        F.upper("lang").alias("state"), (n % 100000).cast("string").alias("zipcode"))


@query("listing_clean_flow")
def listing_clean_flow(spark, d):
    """The whole listing cleaning flow over a listing-shaped view of the
    documents table (rows-checked; each step is oracle-checked separately)."""
    from sparkprep.plans.listing_clean import clean_listings
    # The statistics passes replay this derived input; measured, replaying the
    # projection is cheaper than writing the text-heavy table to a checkpoint.
    langs, sources = ["de", "en", "es", "fr"], [f"src{i}" for i in range(20)]
    return clean_listings(listing_adapter(spark, d), vocabs={
        "amenities": [*langs, *sources, None], "host_verifications": [*sources, None],
        "features": [*langs, fv.MISSING_TOKEN]})
