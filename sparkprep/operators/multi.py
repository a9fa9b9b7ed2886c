"""Multi-value (delimited list) columns: tokens, first-appearance vocabulary,
multi-hot encoding (wide over a bounded vocabulary, or long / sparse)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkprep.functions import fixed_values as fv
from sparkprep.functions.text import list_tokens
from sparkprep.operators.impute import fill_tokens
from sparkprep.operators.ordering import with_row_index
from sparkprep.session import materialize


NA_NAME = "NA"


def tokens(df: DataFrame, col: str, out: str | None = None,
           null_token: str | None = None) -> DataFrame:
    """Split ``col`` on commas and normalise each element. A null list
    becomes ``[null_token]`` when a placeholder is given, otherwise ``[null]``
    (a missing value is its own level, encoded as ``has_NA``)."""
    t = list_tokens(col)
    if null_token is not None:
        t = fill_tokens(t, null_token)
    else:
        t = F.coalesce(t, F.array(F.lit(None).cast("string")))
    return df.withColumn(out or col, t)


def vocabulary(df: DataFrame, list_col: str, order_col: str) -> DataFrame:
    """Distinct tokens in first-appearance order: (token, first_row,
    first_pos, vocab_idx). Null lists contribute nothing."""
    exploded = df.select(order_col, F.posexplode(list_col).alias("pos", "token"))
    firsts = (exploded.groupBy("token")
              .agg(F.min(F.struct(F.col(order_col), F.col("pos"))).alias("f"))
              .select("token", F.col(f"f.{order_col}").alias("first_row"),
                      F.col("f.pos").alias("first_pos")))
    # one row per distinct token: materialise once, so the ranking passes do
    # not re-run the aggregation over the whole input
    return with_row_index(materialize(firsts), ["first_row", "first_pos"], "vocab_idx")


def make_unique(names: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    """Repeated names get suffixes .1, .2, ... (first keeps its name). Names
    that differ in case only count as repeated, as Spark resolves columns
    without regard to case."""
    used = {t.lower() for t in taken}
    wanted = {n.lower() for n in names}
    out = []
    for n in names:
        cand, k = n, 0
        while cand.lower() in used or (k and cand.lower() in wanted):
            k += 1
            cand = f"{n}.{k}"
        used.add(cand.lower())
        out.append(cand)
    return out


def collect_vocabulary(df: DataFrame, list_col: str) -> list[str]:
    """Distinct tokens, sorted, for a wide encoding: the tokens become column
    names, so they all come to the driver. Open vocabularies belong in
    :func:`long_form` or :func:`sparse_one_hot`, which don't need them there."""
    return collect_vocabularies(df, [list_col])[list_col]


def collect_vocabularies(df: DataFrame, list_cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct tokens of several list columns from ONE job (tokens
    tagged with their column, one distinct)."""
    if not list_cols:
        return {}
    def tag(i):
        # a one-argument lambda: transform() treats a second argument as the index
        return lambda x: F.struct(F.lit(i).alias("c"), x.alias("t"))
    tagged = F.concat(*[F.transform(F.col(f"`{c}`"), tag(i)) for i, c in enumerate(list_cols)])
    rows = df.select(F.explode(tagged).alias("e")).select("e.c", "e.t").distinct().collect()
    out = {c: [] for c in list_cols}
    for r in rows:
        out[list_cols[r["c"]]].append(r["t"])
    return {c: sorted(v, key=lambda t: (t is None, t or "")) for c, v in out.items()}


def one_hot(df: DataFrame, list_col: str, vocab: Sequence[str],
            prefix: str = "has_", drop_source: bool = True) -> DataFrame:
    """One 0/1 column per token of the caller's vocabulary, emitted in a
    single projection."""
    vocab = list(vocab)
    names = [f"{prefix}{NA_NAME if t is None else t}" for t in vocab]
    # a name already used by another column (e.g. the same token in an
    # earlier list column) is qualified with this list's column name
    others = {c.lower() for c in df.columns}
    names = [f"{prefix}{list_col}_{n[len(prefix):]}" if n.lower() in others else n for n in names]
    names = make_unique(names, df.columns)
    lst = F.col(list_col)

    def hit(t):
        if t is None:   # the missing-value level
            return F.coalesce(F.exists(lst, lambda x: x.isNull()), F.lit(False))
        return F.coalesce(F.array_contains(lst, F.lit(t)), F.lit(False))
    flags = [hit(t).cast("int").alias(n) for t, n in zip(vocab, names)]
    keep = [F.col(f"`{c}`") for c in df.columns if not (drop_source and c == list_col)]
    return df.select(*keep, *flags)


def long_form(df: DataFrame, key: str, list_col: str, out: str = "token") -> DataFrame:
    """(key, token) pairs of distinct tokens per row: the exact open-vocabulary
    form of the multi-hot matrix."""
    return df.select(key, F.explode(F.array_distinct(list_col)).alias(out))


def sparse_one_hot(df: DataFrame, list_col: str, out: str = "features",
                   min_df: float = 1.0):
    """Binary sparse-vector encoding via CountVectorizer (vocabulary fitted
    with a distributed count; no wide schema)."""
    from pyspark.ml.feature import CountVectorizer
    cv = CountVectorizer(inputCol=list_col, outputCol=out, binary=True, minDF=min_df)
    model = cv.fit(df.withColumn(list_col, fill_tokens(list_col, fv.MISSING_TOKEN)))
    return model, model.transform(df.withColumn(list_col, fill_tokens(list_col, fv.MISSING_TOKEN)))
