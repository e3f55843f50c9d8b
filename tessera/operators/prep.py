"""Encoding, scaling, filling and unsupervised transforms (SURVEY 2.9
X1-X11, X17-X22).

Encoders and scalers are fitted with one aggregate over the *training*
rows and applied as Column expressions (scikit-learn semantics, no re-fit
on test); category lists are the distinct values of a categorical column
(bounded by its cardinality).  Model-based transforms use ``pyspark.ml``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import running_sums


# ---------------------------------------------------------------- X1 / X2 one-hot
def category_values(df: DataFrame, col: str) -> list:
    """Sorted distinct values of a categorical column (its cardinality is
    the size of the result)."""
    return [r[0] for r in df.select(col).distinct().orderBy(col).collect()]


def one_hot(df: DataFrame, col: str, values: Sequence | None = None, drop_first: bool = False,
            prefix: str | None = None) -> DataFrame:
    """``get_dummies`` to named 0/1 columns (X1; ``drop_first`` X2)."""
    vals = list(values) if values is not None else category_values(df, col)
    if drop_first:
        vals = vals[1:]
    p = prefix or col
    return df.select("*", *[(F.col(col) == F.lit(v)).cast("int").alias(f"{p}_{v}") for v in vals])


# ---------------------------------------------------------------- X3-X5 label / ordinal encoding
def label_encode(df: DataFrame, col: str, out: str, fit: DataFrame | None = None) -> DataFrame:
    """Alphabetical codes 0..n-1 (X3, ``LabelEncoder``) learned from
    ``fit`` (default ``df``); values unseen at fit time get -1 (X5)."""
    src = (fit if fit is not None else df).select(col).distinct().where(F.col(col).isNotNull())
    codes = running_sums(src.withColumn("_one", F.lit(1)), [col], ["_one"], prefix="_r") \
        .select(col, (F.col("_r_one") - 1).alias(out))
    return df.join(codes, col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(-1)))


def factorize(df: DataFrame, col: str, order: Sequence[str], out: str) -> DataFrame:
    """First-seen factor codes (X4, ``pd.factorize``): values numbered by
    the position of their first row in ``order``."""
    first = df.groupBy(col).agg(F.min(F.struct(*[F.col(o) for o in order])).alias("_first"))
    codes = running_sums(first.withColumn("_one", F.lit(1)), ["_first"], ["_one"], prefix="_r") \
        .select(col, (F.col("_r_one") - 1).alias(out))
    return df.join(codes, col, "left")


# ---------------------------------------------------------------- X6-X8 scaling
def fit_minmax(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = train.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def minmax_scale(df: DataFrame, stats: dict[str, tuple[float, float]], lo: float = 0.0, hi: float = 1.0,
                 suffix: str = "") -> DataFrame:
    """Min-max scaling with statistics fitted on train (X6), to the target
    range [lo, hi] (X7: call once per column group with its own range)."""
    exprs = {}
    for c, (a, b) in stats.items():
        span = (b - a) if b != a else 1.0
        exprs[c + suffix] = (F.col(c) - F.lit(a)) / F.lit(span) * (hi - lo) + F.lit(lo)
    return df.withColumns(exprs)


def fit_standard(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]], with_std: bool = True,
                suffix: str = "") -> DataFrame:
    """Centre (``with_std=False``) or z-score with population std."""
    exprs = {}
    for c, (m, s) in stats.items():
        e = F.col(c) - F.lit(m)
        exprs[c + suffix] = e / F.lit(s if s else 1.0) if with_std else e
    return df.withColumns(exprs)


# ---------------------------------------------------------------- X9-X11 fills
def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """``fillna`` with per-column constants."""
    return df.na.fill(values)


def missing_indicators(df: DataFrame, cols: Sequence[str], interaction: tuple[str, str] | None = None) -> DataFrame:
    """0/1 null indicators (X10) and optionally their product."""
    out = df.withColumns({f"{c}_isna": F.col(c).isNull().cast("int") for c in cols})
    if interaction:
        a, b = interaction
        out = out.withColumn(f"{a}_{b}_isna", F.col(f"{a}_isna") * F.col(f"{b}_isna"))
    return out


def fill_low_with_group_mean(df: DataFrame, col: str, keys: Sequence[str], threshold: float,
                             out: str | None = None) -> DataFrame:
    """Values below ``threshold`` are treated as missing and replaced by the
    mean of the valid values of their group (X11).  Group means come from
    an aggregate joined back, not a window, so a hot group is combined
    map-side."""
    from .prefix import exact_sum
    valid = F.when(F.col(col) >= threshold, F.col(col))
    g = df.groupBy(*keys).agg(F.try_divide(exact_sum(valid), F.count(valid)).alias("_gm"))   # order-independent mean
    o = out or col
    return df.join(g, list(keys), "left").withColumn(
        o, F.when(F.col(col) < threshold, F.col("_gm")).otherwise(F.col(col))).drop("_gm")


# ---------------------------------------------------------------- X17 chained-equation imputation
def iterative_impute(df: DataFrame, cols: Sequence[str], iterations: int = 2) -> DataFrame:
    """Chained-equation imputation (X17, re-aimed from miceforest): start
    from column means, then per column fit a linear model on rows where it
    is present (other columns as features) and predict its nulls; repeat."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    cols = list(cols)
    miss = {c: f"_miss_{c}" for c in cols}
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    cur = df.withColumns({miss[c]: F.col(c).isNull() for c in cols}).na.fill(means)
    for _ in range(iterations):
        for c in cols:
            others = [o for o in cols if o != c]
            va = VectorAssembler(inputCols=others, outputCol="_x")
            train = va.transform(cur.where(~F.col(miss[c])))
            model = LinearRegression(featuresCol="_x", labelCol=c, regParam=0.0).fit(train)
            pred = model.transform(va.transform(cur)).drop("_x")
            cur = pred.withColumn(c, F.when(F.col(miss[c]), F.col("prediction")).otherwise(F.col(c))).drop("prediction")
    return cur.drop(*miss.values())


# ---------------------------------------------------------------- X18-X22 unsupervised
def add_pca(df: DataFrame, cols: Sequence[str], k: int, prefix: str = "pc"):
    """Add k principal-component scores (X18); returns (frame, cumulative
    explained variance list) (X21)."""
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    va = VectorAssembler(inputCols=list(cols), outputCol="_x")
    x = va.transform(df)
    model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(x)
    arr = vector_to_array("_pc")
    out = model.transform(x).select(*df.columns, *[arr[i].alias(f"{prefix}{i + 1}") for i in range(k)])
    ev = list(model.explainedVariance.toArray())
    cum = [float(sum(ev[: i + 1])) for i in range(len(ev))]
    return out, cum


def fold_moments(df: DataFrame, vector: str, fold: str) -> dict:
    """{fold: symmetric matrix of sums of products of (1, x)} of an array
    column, from one pass: each task adds up its rows per fold, the sums are
    combined by an aggregate, and folds * (d + 1)(d + 2) / 2 numbers reach the
    driver.  A fold's complement is the total less its own matrix, so all
    training sets of a cross-validation come from the same pass."""
    import numpy as np
    import pandas as pd

    def add(frames):
        total: dict = {}
        for f in frames:
            x = np.array([np.asarray(v, float) for v in f["v"]])
            if len(x):
                one = np.hstack([np.ones((len(x), 1)), x])
                for k in np.unique(f["f"]):
                    own = one[f["f"].to_numpy() == k]
                    total[k] = total.get(k, 0) + own.T @ own
        for k, m in total.items():
            i, j = np.triu_indices(len(m))
            yield pd.DataFrame({"f": k, "i": i, "j": j, "s": m[i, j]})
    src = df.select(F.col(fold).cast("int").alias("f"), F.transform(vector, lambda x: x.cast("double")).alias("v")).where(
        F.col("f").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull()), F.lit(False)))
    got = src.mapInPandas(add, "f int, i int, j int, s double").groupBy("f", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    out = {}
    for k, part in got.groupby("f"):
        m = np.zeros((int(part["j"].max()) + 1,) * 2)
        m[part["i"], part["j"]] = m[part["j"], part["i"]] = part["s"]
        out[int(k)] = m
    return out


def principal_axes(moments):
    """(rows, mean, variances, axes in columns) from a matrix of sums; an
    axis points to where its largest entry is positive."""
    import numpy as np
    n = moments[0, 0]
    mean = moments[0, 1:] / n
    var, axes = np.linalg.eigh(moments[1:, 1:] / n - np.outer(mean, mean))
    var, axes = np.maximum(var[::-1], 0.0), axes[:, ::-1]
    sign = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(var))])
    return n, mean, var, axes * np.where(sign == 0, 1.0, sign)


def out_of_fold_pca(df: DataFrame, vector: str, fold: str, k: int, out: str = "scores"):
    """Principal-component scores of each row by the axes of the other folds
    (X18 out of fold): ``df`` with ``out`` (k numbers; null for a row with a
    null coordinate or fold), and per fold (fold, rows, mean, variances, axes)
    of its training set, whose variances give the explained shares (X21) for
    every number of components at once."""
    import numpy as np
    sums = fold_moments(df, vector, fold)
    total = sum(sums.values())
    fits = {f: principal_axes(total - m) for f, m in sums.items() if total[0, 0] > m[0, 0]}
    cols, kinds = df.columns, {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def project(frames):
        for f in frames:
            scores = []
            for g, v in zip(f["_f"], f["_v"]):
                x = None if v is None else np.asarray(v, float)
                known = x is not None and g == g and g is not None and int(g) in fits and not np.isnan(x).any()
                scores.append(((x - fits[int(g)][1]) @ fits[int(g)][3][:, :k]).tolist() if known else None)
            yield f[cols].assign(**{out: scores})
    src = df.withColumns({"_f": F.col(fold).cast("int"), "_v": F.transform(vector, lambda x: x.cast("double"))})
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in cols], f"`{out}` array<double>"])
    return src.mapInPandas(project, schema), fits


def kmeans_sweep(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 1) -> list[dict]:
    """Fit k-means for each k (X19) and report inertia, silhouette (X20,
    ``ClusteringEvaluator``), Davies-Bouldin and Calinski-Harabasz computed
    from per-cluster aggregates."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    import numpy as np
    x = VectorAssembler(inputCols=list(cols), outputCol="features").transform(df).select("features")
    x = x.cache()
    n = x.count()
    out = []
    for k in ks:
        model = KMeans(k=k, seed=seed, maxIter=30).fit(x)
        pred = model.transform(x)
        sil = ClusteringEvaluator().evaluate(pred)
        centres = np.array([c for c in model.clusterCenters()])
        arr = vector_to_array("features")
        st = pred.groupBy("prediction").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(arr[i]).alias(f"m{i}") for i in range(len(cols))]).collect()
        # per-cluster mean distance to centre (scatter) in one more pass
        cc = {r["prediction"]: centres[r["prediction"]] for r in st}
        cdf = df.sparkSession.createDataFrame([(int(j), [float(v) for v in c]) for j, c in cc.items()],
                                              "prediction int, c array<double>")
        d = pred.join(F.broadcast(cdf), "prediction").select(
            "prediction", F.sqrt(F.aggregate(F.zip_with(arr, F.col("c"), lambda a, b: (a - b) * (a - b)),
                                              F.lit(0.0), lambda s, v: s + v)).alias("d"))
        scat = {r["prediction"]: (r["s"], r["ss"]) for r in d.groupBy("prediction").agg(
            F.avg("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("ss")).collect()}
        ids = sorted(scat)
        db = np.mean([max((scat[i][0] + scat[j][0]) / np.linalg.norm(cc[i] - cc[j]) for j in ids if j != i)
                      for i in ids]) if len(ids) > 1 else 0.0
        sizes = {r["prediction"]: r["n"] for r in st}
        overall = sum(sizes[i] * cc[i] for i in ids) / n          # data mean from cluster sizes and centres
        between = sum(sizes[i] * float(np.sum((cc[i] - overall) ** 2)) for i in ids)
        within = sum(scat[i][1] for i in ids)
        ch = (between / max(k - 1, 1)) / (within / max(n - k, 1)) if within else float("inf")
        out.append({"k": k, "inertia": float(model.summary.trainingCost), "silhouette": float(sil),
                    "davies_bouldin": float(db), "calinski_harabasz": float(ch)})
    x.unpersist()
    return out


def knn_graph_clusters(edges: DataFrame, src: str, dst: str, weight: str, k: int, seed: int = 1) -> DataFrame:
    """Spectral-style clustering of a kNN graph (X22) with power iteration
    clustering over (src, dst, weight) edges, e.g. from ``neighbors.knn``."""
    from pyspark.ml.clustering import PowerIterationClustering
    e = edges.select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst"),
                     F.col(weight).cast("double").alias("weight"))
    return PowerIterationClustering(k=k, maxIter=20, weightCol="weight", initMode="degree").assignClusters(e)
