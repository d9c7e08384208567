"""Regression path on MLlib: lag feature, split, key index + one-hot, assemble, GBT.

The key index is a distributed table (frequency order, unseen keys kept), not
a string indexer whose label list lives on the driver.

MLlib's trees count every row over every feature.  With many keys they are given
the few one-hot features that win a split somewhere, and sums per node and key
show that no other would have won: the same model, at a cost of rows, not rows x keys.
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import dense_index
from ..schema import METRICS
from ..session import scratch_path
from .windows import lag_by_key

# Numeric inputs of the feature vector, after the one-hot key and the lag: every metric but the label, in field order.
NUMERIC_FEATURES = [m for m in METRICS if m != "unq_dst_ip"]
#: Up to so many one-hot features the trees are given all of them at once.
WHOLE_KEYS = 256
#: Keys that one node may add to the features in a round, and relative difference below which two gains count as equal.
KEYS_PER_NODE = 8
EQUAL_GAINS = 1e-9


def add_lag_feature(logs: DataFrame, metric: str = "unq_dst_ip", key: str = "src_ip",
                    order: list[str] | None = None, out: str | None = None) -> DataFrame:
    """Previous value of ``metric`` per key in time order (first row null)."""
    order = order or ["timestamp", "event_id"]
    return lag_by_key(logs, key, order, metric, out or f"prev_{metric}")


def time_split(df: DataFrame, cutoff: str, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Train before ``cutoff``, test from it: no test row sees a later neighbour."""
    c = F.lit(cutoff).cast("timestamp_ntz")
    return df.where(F.col(ts) < c), df.where(F.col(ts) >= c)


def hash_split(df: DataFrame, key: str, train_pct: int = 75, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split stable under repartitioning and re-runs: by a hash of ``key``."""
    b = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(100))
    return df.where(b < train_pct), df.where(b >= train_pct)


def split_label(ts: str | Column, cutoff: str) -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.when(t < F.lit(cutoff).cast("timestamp_ntz"), F.lit("train")).otherwise(F.lit("test"))


def index_by_frequency(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """Label -> index by descending frequency, ties alphabetical (the order of a
    frequency-ordered string indexer), computed without gathering the labels
    on the driver."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("frequency"))
    return dense_index(counts, [F.col("frequency").desc(), F.col(col).asc()], out)


def regression_pipeline(prev_col: str = "prev_unq_dst_ip", label: str = "unq_dst_ip",
                        seed: int = 42, max_iter: int = 20, key_encoding: str = "onehot") -> Pipeline:
    """Key encoding, assembler that skips incomplete rows, gradient-boosted
    trees with MLlib defaults.

    ``key_encoding="onehot"`` (the reference's model) gives one feature per
    source (unseen sources: all zeros); the trees bin every row over all of
    them, see ``fit_pipeline`` for many sources.  ``"index"`` passes the
    frequency index as one numeric feature.
    """
    assembler_in = [prev_col, *NUMERIC_FEATURES]
    stages = []
    if key_encoding == "onehot":
        stages.append(OneHotEncoder(inputCol="ip_num", outputCol="ip_vec", handleInvalid="keep"))
        assembler_in = ["ip_vec", *assembler_in]
    elif key_encoding == "index":
        assembler_in = ["ip_num", *assembler_in]
    else:
        raise ValueError(f"unknown key_encoding {key_encoding!r}")
    stages.append(VectorAssembler(inputCols=assembler_in, outputCol="features", handleInvalid="skip"))
    stages.append(GBTRegressor(featuresCol="features", labelCol=label, seed=seed, maxIter=max_iter))
    return Pipeline(stages=stages)


def tree_nodes(model: GBTRegressionModel) -> list[list[dict]]:
    """The nodes of each tree in pre-order, with the places of the nodes above (``path``) and below (``children``).

    An inner node has its ``feature``, a leaf its number among the leaves and its ``value``.
    """
    trees = []
    for tree in model.trees:
        nodes, path, n_leaves = [], [], 0
        for line in tree.toDebugString.splitlines()[1:]:
            text = line.strip()
            if not text or text.startswith("Else"):
                continue
            depth = len(line) - len(line.lstrip())
            path = [(d, at) for d, at in path if d < depth]
            node = {"path": [at for _, at in path], "children": []}
            if path:
                nodes[path[-1][1]]["children"].append(len(nodes))
            if text.startswith("If"):
                path.append((depth, len(nodes)))
                node["feature"] = int(re.match(r"If \(feature (\d+) ", text)[1])
            else:
                node |= {"leaf": n_leaves, "value": float(text.removeprefix("Predict:"))}
                n_leaves += 1
            nodes.append(node)
        trees.append(nodes)
    return trees


def _sums_by_leaf(model: GBTRegressionModel, trees: list[list[dict]], rows: DataFrame, label: str) -> DataFrame:
    """``(tree, leaf, key, n, s, q)``: rows, sum and sum of squares of what a tree was fitted to, per leaf and key."""
    at = model.copy().setLeafCol("leaves").transform(rows).select(
        F.col("ip_num").cast("long").alias("key"), F.col(label).cast("double").alias("left0"), vector_to_array("leaves").alias("leaves"))
    fitted = []
    for t, nodes in enumerate(trees):
        leaf = F.col("leaves")[t].cast("int")
        # the first tree fits the label, a later one the negative gradient of the squared loss
        fitted.append(F.struct(F.lit(t).alias("tree"), leaf.alias("leaf"), ((2 if t else 1) * F.col(f"left{t}")).alias("y")))
        values = F.array(*[F.lit(model.treeWeights[t] * n["value"]) for n in nodes if "leaf" in n])
        at = at.withColumn(f"left{t + 1}", F.col(f"left{t}") - values[leaf])
    return at.select("key", F.inline(F.array(*fitted))).groupBy("tree", "leaf", "key") \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))


def missed_keys(model: GBTRegressionModel, rows: DataFrame, label: str, given: list[int]) -> set[int]:
    """Keys whose one-hot feature would win a node of ``model``, which was fitted without it.

    ``given`` are the places of the model's features in the whole vector, where a key's
    place is its index.  Sums per tree, leaf and key come from one pass over the rows;
    those of a node are the sums of its leaves.  A key wins against a smaller gain and
    against an equal one of a later place, as in a fit on the whole vector; gains within
    rounding count as none.  If there are any, those next to winning come
    along, as many as ``given``: so the rounds double what they try.
    """
    spark, trees = rows.sparkSession, tree_nodes(model)
    by_leaf = _sums_by_leaf(model, trees, rows, label).persist()
    try:
        of_leaf = {(r.tree, r.leaf): (r.n, r.s, r.q) for r in by_leaf.groupBy("tree", "leaf").agg(
            F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect()}
        paths, nodes_now = [], []
        for t, nodes in enumerate(trees):
            n, s = [0] * len(nodes), [0.0] * len(nodes)
            for at, node in enumerate(nodes):
                if "leaf" in node:
                    leaf_n, leaf_s, _ = of_leaf.get((t, node["leaf"]), (0, 0.0, 0.0))
                    for up in [*node["path"], at]:
                        n[up] += leaf_n
                        s[up] += leaf_s
                        if len(nodes[up]["path"]) < model.getOrDefault("maxDepth"):
                            paths.append((t, node["leaf"], up))
            for at, node in enumerate(nodes):
                if n[at] > 1:
                    below = [s[c] * s[c] / n[c] for c in node["children"] if n[c]]
                    gain = max(sum(below) - s[at] * s[at] / n[at], 0.0) if below else 0.0
                    nodes_now.append((t, at, n[at], s[at], gain, given[node["feature"]] if "feature" in node else -1))
        if not nodes_now:
            return set()
        scale = sum(q for (t, _), (_, _, q) in of_leaf.items() if t == 0) / sum(n for (t, _), (n, _, _) in of_leaf.items() if t == 0)
        above = F.broadcast(spark.createDataFrame(paths, "tree int, leaf int, node int"))
        now = F.broadcast(spark.createDataFrame(nodes_now, "tree int, node int, all_n long, all_s double, gain double, place long"))
        rest_n, rest_s = F.col("all_n") - F.col("n"), F.col("all_s") - F.col("s")
        whole = F.col("all_s") * F.col("all_s") / F.col("all_n")
        found = by_leaf.where(~F.col("key").isin(given)).join(above, ["tree", "leaf"]).groupBy("tree", "node", "key") \
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).join(now, ["tree", "node"]).where("n < all_n") \
            .withColumn("won", F.col("s") * F.col("s") / F.col("n") + rest_s * rest_s / rest_n - whole) \
            .withColumn("near", EQUAL_GAINS * (F.col("gain") + whole / 1000 + F.lit(EQUAL_GAINS * scale) * F.col("all_n")))
        more = F.col("won") - F.col("gain")
        wins = (F.col("won") > F.col("near")) & ((more > F.col("near")) | ((more >= -F.col("near")) & (F.col("key") < F.col("place"))))
        best = Window.partitionBy("tree", "node").orderBy(F.col("won").desc(), F.col("key"))
        winners = found.where(wins).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= KEYS_PER_NODE)
        missed = {r.key for r in winners.select("key").distinct().collect()}
        if missed:
            close = found.groupBy("key").agg(F.max(more).alias("more")).orderBy(F.col("more").desc(), "key").limit(len(given))
            missed |= {r.key for r in close.collect()}
        return missed
    finally:
        by_leaf.unpersist()


def fit_pipeline(pipeline: Pipeline, train: DataFrame, whole_keys: int = WHOLE_KEYS) -> PipelineModel:
    """``pipeline.fit(train)`` whose trees do not count every row over every key.

    Beyond ``whole_keys`` one-hot features the trees start from the numeric ones.  The
    keys that would have won a node are added and the trees fitted again, until there
    is none.  A round settles at least the first node that missed a key, so in the end
    the trees are those of the whole vector, up to splits whose gain is rounding; a
    slice of the vector feeds them.  The features at least double with each round:
    if nearly all keys win somewhere, the rounds cost about twice the fit on all.
    """
    *before, gbt = pipeline.getStages()
    made = Pipeline(stages=before).fit(train)
    rows = made.transform(train)
    first = rows.select("features").first()
    width = first.features.size if first else 0
    n_keys = width - 1 - len(NUMERIC_FEATURES) if isinstance(before[0], OneHotEncoder) else 0
    if n_keys <= whole_keys:
        return PipelineModel([*made.stages, gbt.fit(rows)])
    rows = rows.select("ip_num", gbt.getLabelCol(), "features").persist()
    keys: set[int] = set()
    try:
        while True:
            given = [*sorted(keys), *range(n_keys, width)]
            slicer = VectorSlicer(inputCol="features", outputCol="tree_features", indices=given)
            sliced = slicer.transform(rows)
            model = gbt.copy({gbt.featuresCol: "tree_features"}).fit(sliced)
            missed = missed_keys(model, sliced, gbt.getLabelCol(), given)
            if not missed:
                return PipelineModel([*made.stages, slicer, model])
            keys |= missed
    finally:
        rows.unpersist()


class KeyedRegressionModel:
    """Key index table + fitted pipeline.

    The key index plays the part of a frequency-ordered string indexer with
    unseen keys kept (index ``n``), but it stays a distributed table joined
    onto the rows: no list of all keys is gathered on the driver.
    """

    def __init__(self, index: DataFrame, n_keys: int, pipeline: PipelineModel, key: str = "src_ip"):
        self.index, self.n_keys, self.pipeline, self.key = index, n_keys, pipeline, key

    def encode(self, df: DataFrame) -> DataFrame:
        return encode_key(df, self.index, self.n_keys, self.key)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.encode(df))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.index.write.mode("overwrite").parquet(f"{path}/key_index")

    @classmethod
    def load(cls, spark, path: str, key: str = "src_ip") -> "KeyedRegressionModel":
        index = spark.read.parquet(f"{path}/key_index")
        return cls(index, index.count(), PipelineModel.load(f"{path}/pipeline"), key)


def fit_key_index(df: DataFrame, key: str = "src_ip") -> DataFrame:
    """``(key, ip_num)``: index by descending frequency, ties alphabetical."""
    return index_by_frequency(df, key, "ip_num").select(key, "ip_num")


def bound_key_index(index: DataFrame, max_keys: int | None) -> tuple[DataFrame, int]:
    """The index and its number of places, cut to the ``max_keys`` most frequent keys.

    The keys beyond, like unseen ones, share place ``max_keys`` in ``encode_key``: no
    row is lost, and the look-up table, the one-hot width and the statistics of a
    tree's node are bounded by ``max_keys + 1`` however many sources there are.
    """
    n_keys = index.count()
    if max_keys is None or n_keys <= max_keys:
        return index, n_keys
    return index.where(F.col("ip_num") < max_keys), max_keys


def encode_key(df: DataFrame, index: DataFrame, n_keys: int, key: str = "src_ip") -> DataFrame:
    """Attach ``ip_num`` (a double, as MLlib encoders expect); unseen keys get ``n_keys``."""
    from .joins import bounded_broadcast
    return df.join(bounded_broadcast(index.select(key, "ip_num")), key, "left") \
        .withColumn("ip_num", F.coalesce(F.col("ip_num"), F.lit(n_keys)).cast("double"))


def complete_feature_rows(logs_with_lag: DataFrame, prev_col: str = "prev_unq_dst_ip") -> DataFrame:
    """Rows the assembler keeps (no null input) - assembled by MLlib itself."""
    assembler = VectorAssembler(inputCols=[prev_col, *NUMERIC_FEATURES], outputCol="features",
                                handleInvalid="skip")
    return assembler.transform(logs_with_lag).drop("features")


def fit_and_predict(logs: DataFrame, cutoff: str, model_path: str | None = None, seed: int = 42,
                    max_iter: int = 20, key_encoding: str = "onehot",
                    max_keys: int | None = None) -> tuple[KeyedRegressionModel, DataFrame]:
    """Model and predictions of the rows from ``cutoff`` on; one-hot keys beyond the ``max_keys`` most frequent share a feature."""
    # every estimator stage and boosting round re-reads the features: write the
    # model's columns once, as they leave the lag window, instead of recomputing it
    spark = logs.sparkSession
    path = scratch_path(spark, "features")
    used = ["event_id", "src_ip", "timestamp", "unq_dst_ip", "prev_unq_dst_ip", *NUMERIC_FEATURES]
    lagged = add_lag_feature(logs)
    lagged.select(*[c for c in used if c in lagged.columns]).write.parquet(path)
    feats = spark.read.parquet(path)
    train, test = time_split(feats, cutoff)
    # checkpointed by the dense numbering
    index, n_keys = bound_key_index(fit_key_index(train), max_keys if key_encoding == "onehot" else None)
    pipeline = fit_pipeline(regression_pipeline(seed=seed, max_iter=max_iter, key_encoding=key_encoding),
                            encode_key(train, index, n_keys))
    model = KeyedRegressionModel(index, n_keys, pipeline)
    if model_path:
        model.save(model_path)
    return model, model.transform(test)


def evaluate(pred: DataFrame, label: str = "unq_dst_ip") -> dict[str, float]:
    out = {}
    for m in ("rmse", "mae"):
        out[m] = RegressionEvaluator(metricName=m, predictionCol="prediction", labelCol=label).evaluate(pred)
    return out
