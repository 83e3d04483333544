"""Counts, profiles, deduplication, token budgets and projections of whole tables."""

from __future__ import annotations

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.functions import vector as vx
from marlstone.session import stack


def category_counts(df: DataFrame, category: str) -> DataFrame:
    return df.groupBy(category).agg(F.count("*").alias("n"))


def value_range(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def norm_check(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Smallest, largest and mean vector length."""
    return df.select(vx.l2_norm(vector).alias("n")).agg(
        F.min("n").alias("min_norm"), F.max("n").alias("max_norm"), F.avg("n").alias("mean_norm"))


def vector_profile(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Dimension, length, largest, smallest and mean component of each vector."""
    v = F.col(vector)
    return df.select(key, F.size(v).alias("dim"), vx.l2_norm(v).alias("norm"), F.array_max(v).alias("max_value"),
                     F.array_min(v).alias("min_value"), vx.mean_value(v).alias("mean_value"))


def first_of_equal(df: DataFrame, text: str, position: str) -> DataFrame:
    """Distinct texts with the position and number of their copies; sort by ``position`` to keep the order.

    Copies are merged in every task before the shuffle.
    """
    return df.groupBy(text).agg(F.min(position).alias(position), F.count("*").alias("copies"))


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def token_budget(df: DataFrame, text: str, window: int, overhead: int = 200) -> DataFrame:
    """Token totals of a text column, how many average texts fit a context window, and whether all do."""
    sized = df.filter(F.col(text).isNotNull()).select(tx.token_estimate(text).alias("t"), F.length(text).alias("c"))
    return sized.agg(
        F.count("*").alias("texts"),
        F.sum("t").alias("total_tokens"),
        (F.sum("c") / F.sum("t")).alias("chars_per_token"),
        F.floor(F.lit(window - overhead) / (F.sum("t") / F.count("*"))).alias("texts_per_window"),
        (F.sum("t") < window).alias("fits"))


def texts_per_window(df: DataFrame, key: str, text: str, window: int, overhead: int = 200) -> DataFrame:
    """For each text: its tokens and how many texts of that size fit a context window."""
    t = tx.token_estimate(text)
    return df.select(key, t.alias("tokens"), F.when(t > 0, F.floor(F.lit(window - overhead) / t)).alias("fit"))


def pack_context(df: DataFrame, text: str, position: str, per: str, first_n: int = 10,
                 budget: int = 3000) -> DataFrame:
    """Per group: the first ``first_n`` texts as ``Article i: ...`` paragraphs, cut to ``budget`` characters.

    Missing texts keep their number but are left out.
    """
    w = Window.partitionBy(per).orderBy(position)
    first = df.select(per, position, text).withColumn("_no", F.row_number().over(w)).filter(F.col("_no") <= first_n)
    line = F.concat(F.lit("Article "), F.col("_no"), F.lit(": "), F.col(text))
    packed = first.filter(F.col(text).isNotNull()).groupBy(per).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_no", line.alias("line")))),
                                 lambda p: p["line"]), "\n\n").alias("_all"))
    return packed.select(per, F.substring("_all", 1, budget).alias("context"),
                         F.length("_all").alias("full_length"))


def fitting_texts(df: DataFrame, size: Column, position: str, per: str, budget: int) -> DataFrame:
    """The leading rows of each group whose running size stays within ``budget``.

    At most ``budget`` rows of a size can fit, so every task drops the others before
    the shuffle. Rows of size 0 (or null) use up nothing: they are left out of the
    ranking, and then take the running size of the last row before them.
    """
    sized = df.withColumn("_size", F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long"))
    w = Window.partitionBy(per).orderBy(position)
    leading = sized.filter("_size > 0").withColumn("_no", F.row_number().over(w)).filter(F.col("_no") <= budget + 1)
    leading = leading.withColumn("running_size", F.sum("_size").over(w)).drop("_size", "_no")
    steps = leading.groupBy(F.col(per).alias("_per")).agg(  # at most ``budget`` + 1 of a group
        F.sort_array(F.collect_list(F.struct(F.col(position).alias("at"), "running_size"))).alias("_steps"))
    empty = sized.filter("_size = 0").drop("_size").join(steps, F.col(per).eqNullSafe(F.col("_per")), "left")
    before = F.element_at(F.filter("_steps", lambda s: s["at"] < F.col(position)), -1)["running_size"]
    before = F.when(F.exists("_steps", lambda s: s["at"] < F.col(position)), before).otherwise(F.lit(0).cast("long"))
    empty = empty.withColumn("running_size", before).drop("_steps", "_per")
    return stack(leading, empty).filter(F.col("running_size") <= budget)


def pca(df: DataFrame, key: str, vector: str = "embedding", k: int = 2) -> DataFrame:
    """Centred projection to ``k`` principal components: ``key, pc1.., explained1..``.

    The sign of a component is fixed so that its largest loading is positive.
    """
    data = df.select(key, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("_v"))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(data).transform(data)
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    axes = model.pc.toArray()
    signs = [1.0 if col[abs(col).argmax()] >= 0 else -1.0 for col in axes.T]
    shares = model.explainedVariance.toArray()
    p = vector_to_array("_p")
    return model.transform(centred).select(
        key, *[(F.get(p, F.lit(i)) * signs[i]).alias(f"pc{i + 1}") for i in range(k)],
        *[F.lit(float(shares[i])).alias(f"explained{i + 1}") for i in range(k)])
