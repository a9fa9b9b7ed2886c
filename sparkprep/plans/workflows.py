"""End-to-end plans: listing feature table, fit -> score -> threshold ->
write, learning curve, per-fold logistic regression, enriched forest."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.functions import rules as R
from sparkprep.functions.text import before
from sparkprep.operators import encode, evaluate, join, split
from sparkprep.plans import models
from sparkprep.plans.listing_clean import prune_for_model
from sparkprep.session import materialize, shared_path
from sparkprep.sources.files import write_predictions
from sparkprep.sources.tables import table, text_table

NUMERIC = ["n_chars_f", "log_chars", "n_commas",
           *[name for name, _ in fv.ACCESS_FLAGS]]
CATEGORICAL = ["lang", "source", "desc_category", "transit_category", "host_mentions", "has_rules"]
SPEC = models.FeatureSpec(NUMERIC, CATEGORICAL)
TARGET = "perfect_rating_score"


def listing_features(spark, d: str, labelled: bool | None = True) -> DataFrame:
    """Feature table from documents: numeric size features, seven access
    flags and rule-based categories; joined to the YES/NO target
    (``labelled=True``), restricted to unlabelled rows (``False``), or all."""
    docs = text_table(spark, d, "documents").withColumn("lt", F.lower("text"))
    flags = R.access_flags("lt", lowered=True)
    feats = docs.select(
        "doc_id", "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars_f"),
        F.log1p("n_chars").alias("log_chars"),
        (F.size(F.split("text", ",")) - 1).cast("double").alias("n_commas"),
        *[F.coalesce(flags[name], F.lit(0)).cast("double").alias(name) for name, _ in fv.ACCESS_FLAGS],
        R.keyword_category("lt", fv.DESCRIPTION_KEYWORDS, lowered=True).alias("desc_category"),
        R.keyword_category("lt", fv.TRANSIT_KEYWORDS, lowered=True).alias("transit_category"),
        R.host_mentions("lt", lowered=True).alias("host_mentions"),
        R.has_rules("lt", lowered=True).alias("has_rules"))
    labels = table(spark, d, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "YES").otherwise("NO").alias(TARGET))
    if labelled is None:
        return feats
    if not labelled:
        return feats.join(labels, "doc_id", "left_anti")
    out = feats.join(labels, "doc_id")
    return out.withColumns({"label": encode.binary_label(TARGET).cast("double"),
                            "weight": encode.class_weight(TARGET, fv.CLASS_WEIGHTS)})


def split_listings(lab: DataFrame, seed=fv.SPLIT_SEED) -> DataFrame:
    """train / valid_use / valid_final by nested hashed hold-out."""
    return split.nested_holdout(lab, "doc_id", seed)


def metrics_for(model, df: DataFrame, threshold: float, inclusive: bool = True,
                by: Sequence[str] = ()) -> DataFrame:
    scored = models.score(model, df)
    pred = scored.withColumn("pred", evaluate.classify("prob_yes", threshold, inclusive))
    return evaluate.binary_metrics(pred, "pred", TARGET, by)


def lasso_spec(train: DataFrame, folds: int = 10, n_lambdas: int = 100) -> tuple[models.FeatureSpec, models.LassoFit]:
    """The features that the lasso keeps on the training rows: the boosters and the
    logistic formula use no others."""
    fit = models.lasso_cv(SPEC, train, folds=folds, n_lambdas=n_lambdas)
    return SPEC.select(fit.selected), fit


def fit_score_write(spark, d: str, kind: str = "forest", trees: int = fv.FOREST_TREES,
                    path: str | None = None, rounds: int | None = None, n_lambdas: int = 100) -> DataFrame:
    """Refit on every labelled row, score the unlabelled rows, threshold and
    write (doc_id, prediction) as CSV under the shared folder. All kinds but the
    forest use the features that the lasso keeps."""
    lab = materialize(listing_features(spark, d, True))
    test = models.evenly(materialize(listing_features(spark, d, False)))
    if kind != "forest":
        spec, fit = lasso_spec(lab, n_lambdas=n_lambdas)
    if kind == "forest":
        model = models.random_forest(SPEC, lab, trees=trees)
        thr, inc = fv.THRESHOLDS["forest"], True
    elif kind == "gbt":
        lab = lab.withColumn("weight", encode.class_weight(TARGET, {"YES": fv.BOOST_POS_WEIGHT}))
        model = models.gbt(spec, lab, rounds=rounds or 100)
        thr, inc = 0.45, False
    elif kind == "gbt_early_stop":
        # early stopping needs labels: hold out a hashed slice of the
        # labelled rows (the unlabelled table cannot serve as validation)
        lab = split.holdout(lab.withColumn("weight", encode.class_weight(
            TARGET, {"YES": fv.LEAFWISE_POS_WEIGHT})), fv.FINAL_FRACTION, fv.SPLIT_SEED, "doc_id", "is_valid")
        # the untuned preset: step 0.1, 31 leaves (depth 5), 20 rows a leaf, no sampling
        model = models.gbt_patience(spec, lab.where("NOT is_valid"), lab.where("is_valid"), rounds=rounds or 200, step=0.1,
                                    max_depth=5, min_node=20).model
        thr, inc = fv.THRESHOLDS["default"], False
    elif kind == "lasso":
        model = models.lasso_model(SPEC, lab, fit)
        thr, inc = fv.THRESHOLDS["default"], False
    else:
        model = models.logistic(spec, lab)
        thr, inc = fv.THRESHOLDS["default"], False
    scored = models.score(model, test).withColumn(
        "prediction", evaluate.classify("prob_yes", thr, inc))
    out = scored.select("doc_id", "prob_yes", "prediction")
    out = materialize(out)  # scored once, for the file and the caller
    write_predictions(out, path or shared_path(spark, f"predictions-{kind}"), key="doc_id")
    return out


def learning_curve(spark, d: str, fracs: Sequence[float] = fv.TRAIN_SIZES,
                   trees: int = fv.FOREST_TREES, threshold: float = fv.THRESHOLDS["forest"]) -> DataFrame:
    """Validation accuracy / TPR / FPR of a forest trained on growing hashed
    subsets of the training part (each subset drawn independently)."""
    lab = materialize(split_listings(listing_features(spark, d, True)))
    train = lab.where(F.col("split") == "train").drop("split")
    valid = lab.where(F.col("split") == "valid_use").drop("split")
    subsets = materialize(split.fractions(train, fracs, fv.SPLIT_SEED, "doc_id"))

    def fit(f):
        return models.random_forest(SPEC, subsets.where(F.col("fraction") == float(f)).drop("fraction"), trees=trees)
    # Two at a time: between its passes a fit waits for the driver.
    with ThreadPoolExecutor(2) as pool:
        fitted = list(pool.map(inheritable_thread_target(spark)(fit), fracs))
    valid, rows = models.evenly(valid), None
    for f, model in zip(fracs, fitted):
        m = metrics_for(model, valid, threshold).withColumn("train_size", F.lit(float(f)))
        rows = m if rows is None else rows.unionByName(m)
    return rows.select("train_size", "tp", "fp", "tn", "fn", "accuracy", "tpr", "fpr")


def logit_cv(spark, d: str, k: int = fv.CV_FOLDS, n_lambdas: int = 100) -> DataFrame:
    """Per fold: unpenalised logistic regression on the lasso-selected features,
    fitted on the other folds, confusion counts on its own training part and on the
    held-out fold."""
    lab = materialize(split.contiguous_folds(listing_features(spark, d, True), k, "doc_id"))
    spec, _ = lasso_spec(lab, n_lambdas=n_lambdas)
    parts = None
    for i in range(1, k + 1):
        model = models.logistic(spec, lab.where(F.col("fold") != i))
        part = F.when(F.col("fold") == i, "heldout").otherwise("train")
        m = metrics_for(model, lab.withColumn("part", part), 0.5, inclusive=False,
                        by=["part"]).withColumn("fold", F.lit(i))
        parts = m if parts is None else parts.unionByName(m)
    means = parts.groupBy("part").agg(*[F.avg(c).alias(c) for c in ("accuracy", "tpr", "fpr")])
    return parts.select(F.col("fold").cast("string").alias("fold"), "part", "accuracy", "tpr", "fpr") \
        .unionByName(means.select(F.lit("mean").alias("fold"), "part", "accuracy", "tpr", "fpr"))


def forest_at_threshold(spark, d: str, trees: int = fv.FOREST_TREES) -> DataFrame:
    """The main forest's accuracy, TPR and FPR on the training part and on both
    validation parts, at its own threshold."""
    parts = materialize(split_listings(listing_features(spark, d, True)))
    model = models.random_forest(SPEC, parts.where(F.col("split") == "train"), trees=trees)
    return metrics_for(model, models.evenly(parts), fv.THRESHOLDS["forest"], by=["split"])


def enriched_forest(spark, d: str, trees: int = fv.FOREST_TREES) -> DataFrame:
    """Join every listing with one lookup row per source (first page by id,
    de-duplicated before the join), split, fit a forest and report train and
    validation metrics at threshold 0.45."""
    lab = listing_features(spark, d, True)
    pages = table(spark, d, "pages").select(
        F.concat(F.lit("src"), (F.col("page_id") % 20).cast("string")).alias("zip"),
        "page_id", F.length("html").cast("double").alias("page_len"),
        before(F.col("url"), "/").alias("scheme"))
    extra = join.distinct_first(pages, "zip", "page_id").drop("page_id", "scheme")
    enriched = join.enrich(lab, extra, "source", "zip").drop("zip")
    spec = models.FeatureSpec([*NUMERIC, "page_len"], CATEGORICAL)
    parts = materialize(split_listings(enriched))
    train = parts.where(F.col("split") == "train")
    model = models.random_forest(spec, train, trees=trees)
    thr = fv.THRESHOLDS["enriched_forest"]
    return metrics_for(model, models.evenly(parts.where(F.col("split") != "valid_final")), thr,
                       by=["split"])


def auto_spec(df: DataFrame, exclude=(), categorical: Sequence[str] = ()) -> tuple[DataFrame, models.FeatureSpec]:
    """Feature spec: numeric columns pass through, dates become days since the
    reference date (added as ``<col>_days``), and the text columns named in
    ``categorical`` are encoded. The encoders keep one entry per level on the
    driver, so the caller names the columns of few levels; other text columns
    are not features. Returns the table with the date columns."""
    skip = set(exclude)
    types = dict(df.dtypes)
    dates = [c for c, t in types.items() if t in ("date", "timestamp", "timestamp_ntz") and c not in skip]
    out = df.withColumns({f"{c}_days": F.datediff(F.to_date(c), F.to_date(F.lit(fv.REFERENCE_DATE)))
                          .cast("double") for c in dates})
    number_types = ("double", "float", "int", "bigint", "smallint", "tinyint")
    numeric = [c for c, t in out.dtypes
               if c not in skip and c not in dates
               and (t in number_types or t.startswith("decimal"))]
    return out, models.FeatureSpec(numeric, [c for c in categorical if c not in skip])


def forest_report(df: DataFrame, target: str = TARGET, key: str = "row_id",
                  trees: int = fv.FOREST_TREES, threshold: float = fv.THRESHOLDS["forest"],
                  categorical: Sequence[str] = ()) -> DataFrame:
    """Nested hashed split of a cleaned table without the pruned features, class-weighted forest on the
    training part, and accuracy / TPR / FPR on the training and validation
    parts at ``threshold`` (inclusive)."""
    lab = df.withColumns({"label": encode.binary_label(target).cast("double"),
                          "weight": encode.class_weight(target, fv.CLASS_WEIGHTS)})
    lab, spec = auto_spec(prune_for_model(lab), [key, target, "label", "weight"], categorical)
    parts = materialize(split.nested_holdout(lab, key))
    model = models.random_forest(spec, parts.where(F.col("split") == "train"), trees=trees)
    return metrics_for(model, models.evenly(parts.where(F.col("split") != "valid_final")), threshold, by=["split"])
