"""Queries of ranks, splits and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.operators import classes, rank, scale, split
from tabloom.plans.catalog import Catalog
from tabloom.plans.standins import DOCUMENT_FEATURES, LINES_SQL, STUDY_SQL, labelled_documents, lines, table

CATALOG = Catalog()


def hash_sql(key: str, seed: int, digits: int) -> str:
    return f"CAST(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, {digits})) AS UBIGINT)"


@CATALOG.query(
    f"""WITH {LINES_SQL} SELECT line_id, CASE WHEN {hash_sql('line_id', 123, 8)} < 3435973837
          THEN 'train' ELSE 'test' END AS split FROM lines"""
)
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    """80/20 split of the line items by key hash."""
    items = lines(spark, folder).select("line_id")
    return split.hash_split(items, ["line_id"], {"train": 0.8, "test": 0.2}, 123)


@CATALOG.query(
    f"""SELECT split, count(*) AS n, count(DISTINCT l_orderkey) AS orders FROM (
          SELECT l_orderkey, CASE WHEN {hash_sql('l_orderkey', 123, 8)} < 3435973837
            THEN 'train' ELSE 'test' END AS split FROM lineitem) GROUP BY 1"""
)
def group_split(spark: SparkSession, folder: str) -> DataFrame:
    """All items of an order on one side."""
    parts = split.hash_split(
        table(spark, folder, "lineitem").select("l_orderkey"), ["l_orderkey"], {"train": 0.8, "test": 0.2}, 123
    )
    # one row per order first, so that an order with many items adds up inside its tasks
    orders = parts.groupBy("split", "l_orderkey").agg(F.count("*").alias("n"))
    return orders.groupBy("split").agg(F.sum("n").alias("n"), F.count("*").alias("orders"))


@CATALOG.query(
    f"""SELECT event_id, CASE WHEN row_number() OVER (ORDER BY {hash_sql('event_id', 42, 15)}, event_id)
          <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM events"""
)
def exact_split(spark: SparkSession, folder: str) -> DataFrame:
    """Random split with an exact train size."""
    return split.exact_split(table(spark, folder, "events").select("event_id"), ["event_id"], 0.8, 42)


@CATALOG.query(
    f"""WITH {LINES_SQL} SELECT line_id,
          row_number() OVER (ORDER BY {hash_sql('line_id', 7, 15)}, line_id) AS place FROM lines"""
)
def hash_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Random but fixed global order of the line items."""
    return rank.hash_rank(lines(spark, folder).select("line_id"), "place", ["line_id"], 7)


QUOTA_SQL = """sizes AS (SELECT quality, count(*) AS n, sum(count(*)) OVER () AS total FROM labels GROUP BY 1),
  drawn AS (SELECT *, total - ceil(0.3 * total) AS k FROM sizes),
  parts AS (SELECT *, floor(n * k / total) AS whole, (n * k) % total AS rest FROM drawn),
  quotas AS (SELECT quality, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, quality)
    <= k - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM parts)"""


@CATALOG.query(
    f"""WITH {QUOTA_SQL} SELECT l.doc_id, l.quality,
          CASE WHEN row_number() OVER (PARTITION BY l.quality ORDER BY {hash_sql('l.doc_id', 42, 15)}, l.doc_id)
            <= q.quota THEN 'train' ELSE 'test' END AS split
        FROM labels l JOIN quotas q ON l.quality = q.quality"""
)
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    """70/30 split with equal class shares and exact sizes."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return split.stratified_split(labels, ["doc_id"], "quality", 0.3, 42)


@CATALOG.query(
    f"""WITH starts AS (SELECT quality, sum(count(*)) OVER (ORDER BY quality) - count(*) AS start
          FROM labels GROUP BY 1)
        SELECT l.doc_id, l.quality, CAST((s.start - 1 + row_number() OVER (PARTITION BY l.quality
            ORDER BY {hash_sql('l.doc_id', 42, 15)}, l.doc_id)) % 5 AS INT) AS fold
        FROM labels l JOIN starts s ON l.quality = s.quality"""
)
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    """Five folds with equal class shares."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return split.stratified_folds(labels, ["doc_id"], "quality", 5, 42)


@CATALOG.query(
    """SELECT quality, count(*) AS n,
         round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight
       FROM labels GROUP BY 1"""
)
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Weights under which both classes count the same."""
    weights = classes.class_weights(table(spark, folder, "labels").select("quality"), "quality")
    return weights.withColumn("weight", F.round("weight", 6))


@CATALOG.query(
    """SELECT e.event_id, round((SELECT count(*) FROM events)
         / ((SELECT count(DISTINCT event_type) FROM events) * t.n), 6) AS weight
       FROM events e JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) t
         ON e.event_type = t.event_type"""
)
def row_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The class weight on every row."""
    events = table(spark, folder, "events").select("event_id", "event_type")
    weighted = classes.with_class_weight(events, "event_type")
    return weighted.select("event_id", F.round("weight", 6).alias("weight"))


@CATALOG.query(
    f"""WITH {LINES_SQL}, train AS (SELECT * FROM lines WHERE {hash_sql('line_id', 123, 8)} < 3435973837),
          m AS (SELECT avg(l_quantity) AS qa, stddev_pop(l_quantity) AS qs,
            avg(l_extendedprice) AS pa, stddev_pop(l_extendedprice) AS ps FROM train)
        SELECT line_id, round((l_quantity - qa) / qs, 6) AS l_quantity, round((l_extendedprice - pa) / ps, 6) AS l_extendedprice
        FROM lines, m WHERE {hash_sql('line_id', 123, 8)} >= 3435973837"""
)
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows standardised with the statistics of the train rows."""
    items = lines(spark, folder).select("line_id", "l_quantity", "l_extendedprice")
    parts = split.hash_split(items, ["line_id"], {"train": 0.8, "test": 0.2}, 123)
    names = ["l_quantity", "l_extendedprice"]
    scaling = scale.fit_standard(parts.filter(F.col("split") == "train"), names)
    scaled = scaling.apply(parts.filter(F.col("split") == "test"))
    return scaled.select("line_id", *[F.round(c, 6).alias(c) for c in names])


def _robust_sql(names: tuple[str, ...]) -> str:
    facts = ", ".join(
        f"quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_w" for c in names
    )
    scaled = ", ".join(
        f"round(({c} - {c}_m) / CASE WHEN {c}_w = 0 THEN 1 ELSE {c}_w END, 6) AS {c}" for c in names
    )
    return f"WITH {STUDY_SQL}, m AS (SELECT {facts} FROM study) SELECT doc_id, {scaled} FROM study, m"


@CATALOG.query(_robust_sql(DOCUMENT_FEATURES))
def robust_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Document features scaled by median and quartile distance."""
    documents = runtime.store(labelled_documents(spark, folder), "features")
    scaled = scale.fit_robust(documents, DOCUMENT_FEATURES).apply(documents)
    return scaled.select("doc_id", *[F.round(c, 6).alias(c) for c in DOCUMENT_FEATURES])
