"""Forests and trees as tables of their nodes.

A fitted model is written in Spark's own form and read back, so that its structure can be counted,
changed and scored. Like the model itself, the nodes are held by the driver: their number depends on the
trees and their depth, not on the data, and is checked. Changed nodes are saved as a model again, so that Spark's
own model scores rows and routes them to its leaves, in a single scan without a join; of the leaves only counts come back.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tabloom import runtime
from tabloom.operators import models

# Most nodes of a model that is read; a forest of 100 trees of depth 5 has 6,300 at most.
MAX_NODES = 1 << 20

_SCHEMA = pa.schema(
    [
        *[(name, pa.int32()) for name in ("tree", "node", "parent")],
        ("path", pa.string()),
        ("feature", pa.string()),
        ("threshold", pa.float64()),
        ("low", pa.int32()),
        ("high", pa.int32()),
        ("gain", pa.float64()),
        ("impurity", pa.float64()),
        ("bag", pa.int64()),
        ("rows", pa.int64()),
        ("weights", pa.list_(pa.float64())),
    ]
)


@dataclass(frozen=True)
class NodeForest:
    """The nodes of a forest or a single tree, per tree by number.

    A node is a dict with the columns of :meth:`table`: ``tree``, ``node`` (0 is the root), ``parent``, ``path`` (0 and 1 for low and
    high, from the root);
    ``feature``, ``threshold``, ``low`` (the child up to the threshold), ``high`` and ``gain``, all missing at a leaf;
    ``impurity``; ``bag``, the rows of the tree's own sample; ``weights``, their weight per class; and
    ``rows``, missing until counted by :func:`with_rows`.
    """

    trees: tuple[dict[int, dict], ...]
    fitted: models.Fitted
    grown: tuple[dict[int, dict], ...]  # as the model has them, before any change

    @property
    def features(self) -> tuple[str, ...]:
        return self.fitted.features

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [node for tree in self.trees for node in tree.values()]
        return runtime.local_table(spark, rows, _SCHEMA)

    @cached_property
    def pruned(self) -> models.Fitted:
        """Spark's model of the nodes that are left, saved and loaded once."""
        return self.fitted if self.trees == self.grown else _model_of(self)

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (class) and ``p1`` (probability of class 1); a missing feature is an error."""
        return scored(self, df)


def _model_of(forest: NodeForest) -> models.Fitted:
    """The model with the nodes of ``forest`` in place of its own."""
    spark, model = SparkSession.active(), forest.fitted.model
    path = runtime.scratch_path(spark, "model")
    model.save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    rows = []
    for nodes in forest.trees:
        places = {number: place for place, number in enumerate(sorted(nodes))}  # numbers without gaps
        for number, place in places.items():
            node = nodes[number]
            inner, most = node["low"] is not None, max(node["weights"])
            split = (forest.features.index(node["feature"]), [node["threshold"]], -1) if inner else (-1, [], -1)
            children = (places[node["low"]], places[node["high"]]) if inner else (-1, -1)
            gain = node["gain"] if inner else -1.0
            said = float(node["weights"].index(most))
            data = {
                "id": place, "prediction": said, "impurity": node["impurity"], "impurityStats": node["weights"],
                "rawCount": node["bag"], "gain": gain, "leftChild": children[0], "rightChild": children[1],
                "split": dict(zip(("featureIndex", "leftCategoriesOrThreshold", "numCategories"), split, strict=True)),
            }
            rows.append({"treeID": node["tree"], "nodeData": data} if "treeID" in schema.names else data)
    runtime.local_table(spark, rows, to_arrow_schema(schema)).write.mode("overwrite").parquet(f"{path}/data")
    return models.Fitted(type(model).load(path), forest.features)


def read_nodes(spark: SparkSession, fitted: models.Fitted) -> NodeForest:
    """The nodes of a fitted tree or forest of continuous features."""
    path = runtime.scratch_path(spark, "model")
    fitted.model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    saved = saved.select("treeID", "nodeData.*") if "treeID" in saved.columns else saved.withColumn("treeID", F.lit(0))
    rows = saved.limit(MAX_NODES + 1).collect()
    if len(rows) > MAX_NODES:
        raise ValueError(f"the model has more than {MAX_NODES} nodes")
    trees: dict[int, dict[int, dict]] = {}
    for row in sorted(rows, key=lambda r: (r["treeID"], r["id"])):
        inner, split = row["leftChild"] >= 0, row["split"]
        if inner and split["numCategories"] >= 0:
            raise ValueError("splits by categories have no threshold")
        trees.setdefault(row["treeID"], {})[row["id"]] = {
            "tree": row["treeID"],
            "node": row["id"],
            "parent": None,
            "path": "",
            "feature": fitted.features[split["featureIndex"]] if inner else None,
            "threshold": split["leftCategoriesOrThreshold"][0] if inner else None,
            "low": row["leftChild"] if inner else None,
            "high": row["rightChild"] if inner else None,
            "gain": row["gain"] if inner else None,
            "impurity": row["impurity"],
            "bag": row["rawCount"],
            "rows": None,
            "weights": list(row["impurityStats"]),
        }
    for nodes in trees.values():
        for number, node in nodes.items():  # parents come before their children
            for side, child in enumerate((node["low"], node["high"])):
                if child is not None:
                    nodes[child] |= {"parent": number, "path": f"{node['path']}{side}"}
    grown = tuple(trees[t] for t in sorted(trees))
    return NodeForest(grown, fitted, grown)


def _leaves(trees: Sequence[dict[int, dict]]) -> list[dict]:
    """All leaves; a leaf's number is its place here. Within a tree they stand from left to right."""
    return [node for nodes in trees for node in nodes.values() if node["low"] is None]


def _literal(values: Sequence, kind: str) -> Column:
    """A literal array; one JSON text is quick to plan and is folded once."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def _routed(forest: NodeForest, df: DataFrame) -> DataFrame:
    """Add ``forest__leaves``, the number of the model's leaf in each tree."""
    model = forest.fitted.model.copy()
    for column in ("Prediction", "RawPrediction", "Probability"):
        getattr(model, f"set{column}Col")("")
    model.setLeafCol("forest__leaf")
    found = model.transform(models.assemble(df, forest.features, "features__vector")).drop("features__vector")
    leaf = F.col("forest__leaf")
    places = F.array(leaf) if found.schema["forest__leaf"].dataType.simpleString() == "double" else vector_to_array(leaf)
    starts, total = [], 0  # a model numbers the leaves of each tree from 0
    for nodes in forest.grown:
        starts.append(total)
        total += len(_leaves([nodes]))
    numbers = F.zip_with(places, _literal(starts, "int"), lambda place, start: place.cast("int") + start)
    return found.withColumn("forest__leaves", numbers).drop("forest__leaf")


def scored(forest: NodeForest, df: DataFrame) -> DataFrame:
    """Every tree votes with the class shares of the leaf; the class with most votes wins, the first on ties."""
    found = forest.pruned.model.transform(models.assemble(df, forest.features, "features__vector"))
    p1 = F.get(vector_to_array("probability"), F.lit(1))
    return found.withColumn("p1", p1).drop("features__vector", "rawPrediction", "probability")


def with_rows(forest: NodeForest, df: DataFrame) -> NodeForest:
    """Fill ``rows``: how many rows of ``df`` pass each node.

    Rows with the same features are counted first, so each feature vector is routed through the trees once, however many
    rows have it. The model's leaves are counted on the map side; an inner node has the rows of its children.
    """
    vectors = df.groupBy(*forest.features).agg(F.count("*").alias("forest__n"))
    reached = _routed(forest, vectors).select("forest__n", F.explode("forest__leaves").alias("leaf"))
    counted = {r["leaf"]: r["n"] for r in reached.groupBy("leaf").agg(F.sum("forest__n").alias("n")).collect()}  # a row per leaf
    rows = {(leaf["tree"], leaf["node"]): counted.get(i, 0) for i, leaf in enumerate(_leaves(forest.grown))}
    for nodes in forest.grown:
        for number in sorted(nodes, reverse=True):  # children before their parents
            node = nodes[number]
            if node["low"] is not None:
                rows[node["tree"], number] = rows[node["tree"], node["low"]] + rows[node["tree"], node["high"]]
    filled = [{n: node | {"rows": rows[node["tree"], n]} for n, node in nodes.items()} for nodes in forest.trees]
    return replace(forest, trees=tuple(filled))


def collapsed(forest: NodeForest, least: int, by: str = "rows") -> NodeForest:
    """The forest with every inner node of fewer than ``least`` rows made a leaf: a minimum split size.

    ``by`` counts rows that pass (see :func:`with_rows`) or those of the tree's own sample (``bag``). What a node
    does depends on its own rows only, so cutting afterwards gives the tree that would have grown under the limit.
    """
    leaf = {"feature": None, "threshold": None, "low": None, "high": None, "gain": None}
    trees = []
    for nodes in forest.trees:
        kept: dict[int, dict] = {}
        for number, node in nodes.items():
            if node["parent"] is None or (node["parent"] in kept and kept[node["parent"]]["low"] is not None):
                kept[number] = node | leaf if node[by] < least else node
        trees.append(kept)
    return replace(forest, trees=tuple(trees))


def importance(spark: SparkSession, forest: NodeForest) -> DataFrame:
    """Rows (feature, importance): mean decrease in impurity, per tree as a share of its whole, largest first; sums to 1.

    A tree without a split takes no part; a feature without one has importance 0.
    """
    shares = dict.fromkeys(forest.features, 0.0)
    for nodes in forest.trees:
        drops = [(n["feature"], n["gain"] * sum(n["weights"])) for n in nodes.values() if n["gain"] is not None]
        whole = sum(drop for _, drop in drops)
        for feature, drop in drops:
            shares[feature] += drop / whole if whole else 0.0
    whole = sum(shares.values())
    rows = [{"feature": f, "importance": v / whole if whole else 0.0} for f, v in shares.items()]
    schema = pa.schema([("feature", pa.string()), ("importance", pa.float64())])
    return runtime.local_table(spark, rows, schema).orderBy(F.desc("importance"), "feature")
