"""Forests, trees and logistic regressions as tables: their structure and optimality against SQL.

The first queries fit models to a label that is a rule of the cells of the orders (see
:mod:`tabloom.plans.model_queries`), so that SQL can grow the tree. The others take the models of the
patient plan with their real settings and state what must hold for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.operators import metrics, models, scale, trees
from tabloom.plans import patient
from tabloom.plans.catalog import Catalog
from tabloom.plans.model_queries import cells
from tabloom.plans.patient_queries import stored_study
from tabloom.plans.split_queries import QUOTA_SQL, hash_sql
from tabloom.plans.standins import DOCUMENT_FEATURES, STUDY_SQL

CATALOG = Catalog()

_STEPS = ("is_o", "is_p", "over_1", "over_2")
_LIMIT = 5000  # rows of a node that the shortened tree splits

_RULE_SQL = """flags AS (
    SELECT (o_orderstatus = 'O')::INT AS is_o, (o_orderstatus = 'P')::INT AS is_p,
      (o_totalprice > 90000)::INT AS over_1, (o_totalprice > 180000)::INT AS over_2 FROM orders),
  ruled AS (SELECT *, ((over_1 = 1 AND is_p = 0) <> (over_2 = 1 AND is_o = 1))::INT AS y FROM flags)"""


def ruled_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The cells' yes/no features and a label ``y`` that is a rule of them."""
    yes = {c: F.col(c) == 1.0 for c in _STEPS}
    rule = (yes["over_1"] & ~yes["is_p"]) != (yes["over_2"] & yes["is_o"])
    return runtime.store(cells(spark, folder).select("o_orderkey", *_STEPS, rule.cast("int").alias("y")), "ruled")


def _grown_sql() -> str:
    """Tables ``held`` and ``best`` of the tree that always takes the split with the largest gain."""
    gini = "2.0 * ({pos}) / ({n}) * (1 - 1.0 * ({pos}) / ({n}))"
    flag = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_STEPS)) + " END"
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_STEPS)) + " END"
    parts = [
        _RULE_SQL,
        f"m0 AS (SELECT {', '.join(_STEPS)}, '' AS path, count(*) AS n, sum(y) AS pos FROM ruled GROUP BY ALL)",
    ]
    for level in range(len(_STEPS)):
        parts += [
            f"t{level} AS (SELECT path, sum(n) AS n, sum(pos) AS pos FROM m{level} GROUP BY path)",
            f"""s{level} AS (SELECT path, f, sum(n) FILTER (v = 0) AS nl, coalesce(sum(pos) FILTER (v = 0), 0) AS pl,
                sum(n) FILTER (v = 1) AS nh, coalesce(sum(pos) FILTER (v = 1), 0) AS ph
              FROM (SELECT path, f, n, pos, {flag} AS v FROM m{level}, range({len(_STEPS)}) r(f)) GROUP BY path, f)""",
            f"""g{level} AS (SELECT path, f, n, {gini.format(pos="pos", n="n")}
                - 1.0 * nl / n * {gini.format(pos="pl", n="nl")} - 1.0 * nh / n * {gini.format(pos="ph", n="nh")} AS gain
              FROM s{level} JOIN t{level} USING (path) WHERE nl > 0 AND nh > 0)""",
            f"""b{level} AS (SELECT path, {names} AS feature, f, gain, n FROM g{level} WHERE gain > 1e-12
              QUALIFY row_number() OVER (PARTITION BY path ORDER BY round(gain, 12) DESC, f) = 1)""",
            f"m{level + 1} AS (SELECT m.* REPLACE (m.path || ({flag})::VARCHAR AS path) FROM m{level} m JOIN b{level} b ON m.path = b.path)",
        ]
    last = len(_STEPS)
    parts.append(f"t{last} AS (SELECT path, sum(n) AS n, sum(pos) AS pos FROM m{last} GROUP BY path)")
    held = " UNION ALL ".join(f"SELECT * FROM t{i}" for i in range(last + 1))
    best = " UNION ALL ".join(f"SELECT path, feature, gain, n FROM b{i}" for i in range(last))
    parts += [f"held AS ({held})", f"best AS ({best})"]
    return ", ".join(parts)


def rule_tree(spark: SparkSession, folder: str) -> tuple[DataFrame, trees.NodeForest]:
    rows = ruled_cells(spark, folder)
    fitted = models.fit_tree(models.fixed_layout(rows, ["o_orderkey"]), _STEPS, "y", depth=5, min_leaf=1)
    return rows, trees.with_rows(trees.read_nodes(spark, fitted), rows)


def _nodes(spark: SparkSession, forest: trees.NodeForest) -> DataFrame:
    return forest.table(spark).select(
        "path",
        "feature",
        "rows",
        F.element_at("weights", 2).cast("long").alias("positives"),
        F.round("gain", 8).alias("gain"),
    )


@CATALOG.query(
    f"""WITH {_grown_sql()} SELECT h.path, b.feature, h.n::BIGINT AS rows, h.pos::BIGINT AS positives, round(b.gain, 8) AS gain
        FROM held h LEFT JOIN best b ON h.path = b.path"""
)
def rule_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of a tree: its split, its rows and what the split gains."""
    return _nodes(spark, rule_tree(spark, folder)[1])


@CATALOG.query(
    f"""WITH {_grown_sql()}, cut AS (SELECT * FROM best WHERE n >= {_LIMIT}),
          kept AS (SELECT h.* FROM held h WHERE h.path = '' OR substr(h.path, 1, len(h.path) - 1) IN (SELECT path FROM cut))
        SELECT h.path, b.feature, h.n::BIGINT AS rows, h.pos::BIGINT AS positives, round(b.gain, 8) AS gain
        FROM kept h LEFT JOIN cut b ON h.path = b.path"""
)
def rule_nodes_min_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same tree with a minimum split size."""
    return _nodes(spark, trees.collapsed(rule_tree(spark, folder)[1], _LIMIT))


@CATALOG.query(
    f"""WITH {_grown_sql()}, cut AS (SELECT * FROM best WHERE n >= {_LIMIT}),
          kept AS (SELECT h.path, h.n, h.pos, b.path IS NULL AS is_leaf FROM held h LEFT JOIN cut b ON h.path = b.path
            WHERE h.path = '' OR substr(h.path, 1, len(h.path) - 1) IN (SELECT path FROM cut)),
          leaves AS (SELECT n, pos, (2 * pos > n)::INT AS p FROM kept WHERE is_leaf)
        SELECT 0 AS label, coalesce(sum(n - pos) FILTER (p = 0), 0)::BIGINT AS predicted_0, coalesce(sum(n - pos) FILTER (p = 1), 0)::BIGINT AS predicted_1,
          0::BIGINT AS predicted_other FROM leaves
        UNION ALL SELECT 1, coalesce(sum(pos) FILTER (p = 0), 0)::BIGINT, coalesce(sum(pos) FILTER (p = 1), 0)::BIGINT, 0 FROM leaves"""
)
def rule_tree_min_split(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion table of the tree with a minimum split size: the majority of each leaf that is left."""
    rows, forest = rule_tree(spark, folder)
    return metrics.confusion_matrix(trees.collapsed(forest, _LIMIT).apply(rows), "y", "prediction", (0, 1))


_SHARES_SQL = f"""WITH {_grown_sql()}, names AS (SELECT unnest([{", ".join(f"'{c}'" for c in _STEPS)}]) AS feature)
  SELECT n.feature, round(coalesce(sum(b.gain * b.n), 0) / (SELECT sum(gain * n) FROM best), 8) AS importance
  FROM names n LEFT JOIN best b ON n.feature = b.feature GROUP BY 1"""


@CATALOG.query(_SHARES_SQL)
def rule_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Impurity importances, from the node table."""
    table = trees.importance(spark, rule_tree(spark, folder)[1])
    return table.withColumn("importance", F.round("importance", 8))


@CATALOG.query(_SHARES_SQL)
def rule_importance_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Impurity importances of a forest whose trees all see every row and feature, so that all are the same tree."""
    rows = ruled_cells(spark, folder)
    fitted = models.fit_forest(models.fixed_layout(rows, ["o_orderkey"]), _STEPS, "y", trees=5, depth=5, subset="all", bootstrap=False)
    table = trees.importance(spark, trees.read_nodes(spark, fitted))
    return table.withColumn("importance", F.round("importance", 8))


_FORESTS = ("forest_30", "forest_100", "balanced_forest_100", "balanced_tree")


@CATALOG.query(
    f"""WITH {_RULE_SQL}, sizes AS (SELECT y, count(*) AS n FROM ruled GROUP BY y)
        SELECT model, y AS label, CASE y WHEN 0 THEN n ELSE 0 END::BIGINT AS predicted_0,
          CASE y WHEN 1 THEN n ELSE 0 END::BIGINT AS predicted_1, 0::BIGINT AS predicted_other
        FROM sizes, (SELECT unnest([{", ".join(f"'{m}'" for m in _FORESTS)}]) AS model)"""
)
def rule_forests(spark: SparkSession, folder: str) -> DataFrame:
    """Forests and the tree with the settings of the plans, sampled rows and features included: the vote finds the rule."""
    rows = ruled_cells(spark, folder)
    study = patient.Study(rows, ("o_orderkey",), _STEPS, "y")
    found = (
        models.fit_forest(models.fixed_layout(rows, study.key), _STEPS, "y", trees=30, seed=123),
        patient.fit_forest(rows, study),
        patient.fit_forest(rows, study, balance=True),
        patient.fit_balanced_tree(rows, study),
    )
    # a prediction depends on the features alone: rows that share them are scored once
    cases = runtime.store(rows.groupBy(*_STEPS, "y").agg(F.count("*").alias("n")), "cases")
    tables = [
        metrics.confusion_matrix(fitted.apply(cases), "y", "prediction", (0, 1), count="n").withColumn("model", F.lit(name))
        for name, fitted in zip(_FORESTS, found, strict=True)
    ]
    stacked = tables[0]
    for more in tables[1:]:
        stacked = stacked.unionByName(more)
    return stacked


@CATALOG.query(
    f"""WITH {STUDY_SQL}, sizes AS (SELECT count(*) - ceil(0.3 * count(*))::BIGINT AS train, ceil(0.3 * count(*))::BIGINT AS test FROM study),
          models AS (SELECT 'forest' AS model, unnest(range(100))::INT AS tree
            UNION ALL SELECT 'balanced_forest', unnest(range(100))::INT UNION ALL SELECT 'balanced_tree', 0)
        SELECT model, tree, train AS root_rows, train AS leaf_rows, 0::BIGINT AS small_splits, 0::BIGINT AS broken_sums, test AS same_predictions
        FROM models, sizes"""
)
def forest_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """The patient models, tree by tree: rows at the root and in all leaves, splits of too few rows, nodes whose children
    do not add up, and test rows on which the node table predicts what Spark's model does (before the minimum split size)."""
    study = stored_study(spark, folder)
    train, test = study.sides()
    grown = {
        "forest": patient.grow_forest(train, study),
        "balanced_forest": patient.grow_forest(train, study, balance=True),
        "balanced_tree": patient.grow_balanced_tree(train, study),
    }
    told = None
    for name, fitted in grown.items():
        forest = trees.with_rows(trees.read_nodes(spark, fitted), train)
        both = fitted.apply(test).withColumnsRenamed({"prediction": "theirs", "p1": "their_p1"})
        same = (F.col("prediction") == F.col("theirs")) & (F.abs(F.col("p1") - F.col("their_p1")) < 1e-12)
        agreed = forest.apply(both).filter(same).count()
        nodes = trees.collapsed(forest, patient.MIN_SPLIT).table(spark)
        children = nodes.filter("parent IS NOT NULL").groupBy("tree", F.col("parent").alias("node")).agg(F.sum("rows").alias("below"))
        checked = nodes.join(children, ["tree", "node"], "left")
        table = checked.groupBy("tree").agg(
            F.sum(F.when(F.col("path") == "", F.col("rows"))).alias("root_rows"),
            F.sum(F.when(F.col("feature").isNull(), F.col("rows"))).alias("leaf_rows"),
            F.count_if(F.col("feature").isNotNull() & (F.col("rows") < patient.MIN_SPLIT)).alias("small_splits"),
            F.count_if(F.col("below") != F.col("rows")).alias("broken_sums"),
        )
        table = table.select(F.lit(name).alias("model"), "*", F.lit(agreed).cast("long").alias("same_predictions"))
        told = table if told is None else told.unionByName(table)
    return told


_SIDES_SQL = f"""{STUDY_SQL}, {QUOTA_SQL.replace("FROM labels", "FROM study")},
  train AS (SELECT s.* FROM study s JOIN quotas q ON s.quality = q.quality
    QUALIFY row_number() OVER (PARTITION BY s.quality ORDER BY {hash_sql('s.doc_id', 42, 15)}, s.doc_id) <= q.quota),
  facts AS (SELECT {", ".join(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS {c}_s" for c in DOCUMENT_FEATURES)} FROM train),
  scaled AS (SELECT {", ".join(f"({c} - {c}_m) / {c}_s AS {c}" for c in DOCUMENT_FEATURES)}, 1.0 AS "(intercept)", quality,
    1.0 * count(*) OVER () / (2 * count(*) OVER (PARTITION BY quality)) AS w FROM train, facts)"""


def _equations_sql() -> str:
    names = (*DOCUMENT_FEATURES, "(intercept)")
    rows = [
        f"""SELECT '{model}' AS model, '{c}' AS feature, round(sum({w} * quality * "{c}") / sum({w}), 4) + 0.0 AS moment FROM scaled"""
        for model, w in (("balanced", "w"), ("plain", "1.0"))
        for c in names
    ]
    return f"WITH {_SIDES_SQL} {' UNION ALL '.join(rows)}"


@CATALOG.query(_equations_sql())
def logit_equations(spark: SparkSession, folder: str) -> DataFrame:
    """Both logistic regressions on the train side are at their optimum: weighted sums of probability times feature, plus
    what the penalty pulls, are those of label times feature, which SQL takes from the data alone."""
    study = stored_study(spark, folder)
    train, _ = study.sides()
    train = runtime.store(models.balanced(scale.fit_standard(train, study.features).apply(train), study.label), "train")
    fits = {
        "balanced": (models.fit_logit(train, study.features, study.label, weight="weight", inverse_penalty=1.0, iterations=500, tolerance=1e-12), "weight", 1.0),
        "plain": (models.fit_logit(train, study.features, study.label, iterations=500, tolerance=1e-12), None, None),
    }
    told = None
    for name, (fitted, weight, penalty) in fits.items():
        table = models.score_equations(train, fitted, study.label, weight=weight, inverse_penalty=penalty)
        table = table.select(F.lit(name).alias("model"), "feature", (F.round("fitted", 4) + F.lit(0.0)).alias("moment"))
        told = table if told is None else told.unionByName(table)
    return told
