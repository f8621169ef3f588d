"""What filters do to each other: every order of them, told from one decision diagram per part.

1. One scan gives every document the conditions that it fails, as bits of a mask. The condition
   "equal to the text of a smaller id" needs the smallest id per text: equal rows are counted
   into one first, the smallest id is found on the map side per text digest, and rows meet
   it by (digest, id), so a text that holds a third of all rows is spread over its ids.
2. Documents are counted per part and mask. A part has at most 2^n masks, whatever its size.
3. Each part's counts become a reduced decision diagram with a variable per filter, whose leaves are
   counts. An order of the filters is an order of the variables; the path on which all filters
   pass holds what each step keeps, and the branch it leaves at a step what the step removes. All orders
   are visited by swapping neighbouring levels, one swap per order, so nothing is counted again.

Only keys, digests and masks are shuffled. A task of step 3 holds the counts of one part.

Defined cases: a missing text is the empty one; parts are the values of a column, a missing value
being the empty string; a missing id is neither smaller nor larger than another, so its row is never
the later copy and makes no other row one; rows that repeat an id and its text are not later copies of
each other; labels that repeat an id count if one of them says so, and labels without an id never; an
empty table gives an empty result. Only the named columns are read, under names of their own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_CAPITALS = 3  # percent of the characters
SYMBOLS = "#$%&*|"
_SALTS = 64
_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)

Count = tuple[int, ...]


class _Node:
    __slots__ = ("failed", "passed", "variable")

    def __init__(self, variable: int, passed, failed):
        self.variable, self.passed, self.failed = variable, passed, failed


class Diagram:
    """A reduced decision diagram from the outcomes of n filters to counts; ``order`` lists the variables from the top.

    A node is (variable, branch of a pass, branch of a fail) and exists once per variable and
    branches; where both branches are one, it is left out and stands for both. Leaves are counts.
    """

    def __init__(self, n: int, counts: dict[int, Count], width: int):
        self.order, self.zero = list(range(n)), (0,) * width
        self._made: dict[tuple, _Node] = {}
        self._sums: dict[tuple[_Node, int], Count] = {}
        self.root = self._build(0, list(counts.items()))

    def _build(self, level: int, counts: list[tuple[int, Count]]):
        if not counts:
            return self.zero
        if level == len(self.order):
            return counts[0][1]
        sides = ([c for c in counts if bool(c[0] >> level & 1) == failed] for failed in (False, True))
        return self._node(level, *(self._build(level + 1, side) for side in sides))

    def _node(self, variable: int, passed, failed):
        if passed == failed:
            return passed
        return self._made.setdefault((variable, passed, failed), _Node(variable, passed, failed))

    def _branches(self, node, variable: int) -> tuple:
        if isinstance(node, _Node) and node.variable == variable:
            return node.passed, node.failed
        return node, node

    def swap(self, level: int) -> None:
        """Exchange the variables of ``level`` and the level below it; nodes further down stay as they are."""
        upper, lower = self.order[level : level + 2]
        done: dict[_Node, object] = {}

        def moved(node):
            if not isinstance(node, _Node) or self.order.index(node.variable) > level + 1:
                return node
            if node not in done:
                if node.variable in (upper, lower):
                    (pp, pf), (fp, ff) = (self._branches(b, lower) for b in self._branches(node, upper))
                    done[node] = self._node(lower, self._node(upper, pp, fp), self._node(upper, pf, ff))
                else:
                    done[node] = self._node(node.variable, moved(node.passed), moved(node.failed))
            return done[node]

        self._made = {k: n for k, n in self._made.items() if self.order.index(n.variable) > level + 1}
        self.root = moved(self.root)
        self.order[level : level + 2] = lower, upper
        self._sums = {}

    def _sum(self, node, level: int) -> Count:
        """Counts of all outcomes of the variables from ``level`` down."""
        left = len(self.order) - level
        if not isinstance(node, _Node):
            return tuple(c << left for c in node)
        if (node, level) not in self._sums:
            own = self.order.index(node.variable)
            both = zip(self._sum(node.passed, own + 1), self._sum(node.failed, own + 1))
            self._sums[node, level] = tuple(a + b << own - level for a, b in both)
        return self._sums[node, level]

    def steps(self) -> Iterator[tuple[int, Count, Count]]:
        """Along the path on which all filters pass: variable, counts kept and counts removed at each level."""
        node = self.root
        for level, variable in enumerate(self.order):
            passed, failed = self._branches(node, variable)
            yield variable, self._sum(passed, level + 1), self._sum(failed, level + 1)
            node = passed


def neighbour_swaps(n: int) -> Iterator[int]:
    """Levels whose swaps with the next one lead through all orders of n variables, each once."""
    places, ways = list(range(n)), [-1] * n
    while True:
        # the largest value that can move towards a smaller neighbour
        for value in reversed(range(n)):
            at = places.index(value)
            to = at + ways[value]
            if 0 <= to < n and places[to] < value:
                break
        else:
            return
        places[at], places[to] = places[to], places[at]
        for larger in range(value + 1, n):
            ways[larger] = -ways[larger]
        yield min(at, to)


def all_orders(n: int, counts: dict[int, Count], names: str) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part.

    ``counts`` maps masks to numbers of documents, good ones and toxic ones. A filter removes all that fail
    it when it comes first, and what nothing else removes when it comes last.
    """
    diagram = Diagram(n, counts, 3)
    seen = [("".join(names[v] for v in diagram.order), list(diagram.steps()))]
    for level in neighbour_swaps(n):
        diagram.swap(level)
        seen.append(("".join(names[v] for v in diagram.order), list(diagram.steps())))
    fails, alone, shares = [0] * n, [0] * n, [0] * n
    for _, steps in seen:
        fails[steps[0][0]], alone[steps[-1][0]] = steps[0][2][0], steps[-1][2][0]
        for variable, _, removed in steps:
            shares[variable] += removed[0]
    return [
        (order, i, kept[0], gone[0], fails[v] - gone[0], alone[v], gone[1], gone[2], shares[v])
        for order, steps in seen
        for i, (v, kept, gone) in enumerate(steps, 1)
    ]


def conditions(body: Column, words: Column) -> list[Column]:
    """The conditions A to D that a text fails: few words, repeated words, capitals, symbols."""
    capitals = F.length(body) - F.length(F.regexp_replace(body, "[A-Z]+", ""))
    return [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        100 * capitals > MOST_CAPITALS * F.length(body),
        body.rlike(f"[{SYMBOLS}]"),
    ]


def failure_masks(docs: DataFrame, *, key: str = "doc_id", body: str = "text", part: str = "lang") -> DataFrame:
    """``doc``, ``digest``, ``part``, ``mask`` and ``n``, the number of equal rows; stored.

    Bits 0 to 3 of the mask are the conditions A to D, bit 4 is E, a later copy of a text.
    """
    whole = docs.select(
        F.col(key).alias("doc"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        text.whole(F.col(body)).alias("body"),
    ).withColumn("words", text.words(F.col("body")))
    mask = sum(F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions(F.col("body"), F.col("words"))))
    scanned = whole.select("doc", "part", F.unhex(F.sha2("body", 256)).alias("digest"), mask.alias("mask"))
    rows = runtime.store(scanned.groupBy("doc", "digest", "part", "mask").agg(F.count("*").alias("n")), "masks")
    first = rows.filter(F.col("doc").isNotNull()).groupBy("digest").agg(F.min("doc").alias("doc"))
    marked = rows.join(first.withColumn("is_first", F.lit(True)), ["digest", "doc"], "left")
    later = F.col("doc").isNotNull() & F.col("is_first").isNull()
    return marked.withColumn("mask", F.col("mask") + F.when(later, 1 << 4).otherwise(0)).drop("is_first")


def with_labels(masks: DataFrame, labels: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Add ``good`` and ``toxic``; rows without an id are spread over ``_SALTS`` tasks, for they meet no label."""
    said = (
        labels.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("doc"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .withColumn("salt", F.lit(0))
    )
    salt = F.when(F.col("doc").isNull(), F.pmod(F.hash("digest"), F.lit(_SALTS))).otherwise(0)
    joined = masks.withColumn("salt", salt).join(said, ["doc", "salt"], "left").drop("salt")
    return joined.fillna(0, ["good", "toxic"])


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The table of all orders from ``part``, ``mask``, ``n``, ``good`` and ``toxic``."""
    counts = masks.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )

    def diagrams(rows: pa.Table) -> pa.Table:
        held = rows.to_pylist()
        found = all_orders(len(filters), {r["mask"]: (r["docs"], r["good"], r["toxic"]) for r in held}, filters)
        columns = [pa.array([held[0]["part"]] * len(found), pa.string()), pa.array([f[0] for f in found], pa.string())]
        columns.append(pa.array([f[1] for f in found], pa.int32()))
        columns += [pa.array([f[i] for f in found], pa.int64()) for i in range(2, 9)]
        return pa.table(columns, [field.split()[0] for field in _SCHEMA.split(", ")])

    return counts.groupBy("part").applyInArrow(diagrams, _SCHEMA)


@CATALOG.query(
    rf"""
    WITH words AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ),
    firsts AS (SELECT body, min(doc_id) AS first FROM words GROUP BY body),
    failed AS (
      SELECT d.part, d.doc_id,
        (len(w) < {LEAST_WORDS})::INT AS a,
        (100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w))::INT AS b,
        (100 * len(regexp_replace(d.body, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * len(d.body))::INT AS c,
        regexp_matches(d.body, '[{SYMBOLS}]')::INT AS d,
        coalesce(d.doc_id > f.first, false)::INT AS e
      FROM words d JOIN firsts f ON d.body = f.body
    ),
    said AS (
      SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels
      WHERE doc_id IS NOT NULL GROUP BY doc_id
    ),
    masks AS (
      SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n,
        sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM failed f LEFT JOIN said s ON f.doc_id = s.doc_id GROUP BY 1, 2
    ),
    letters AS (SELECT * FROM (VALUES {", ".join(f"('{f}')" for f in FILTERS)}) t(x)),
    orders AS (
      SELECT a.x || b.x || c.x || d.x || e.x AS o
      FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ),
    steps AS (
      SELECT o AS filter_order, i::INT AS step, 1 << (ascii(o[i]) - 65) AS own,
        coalesce(list_sum(list_transform(range(1, i), lambda j: 1 << (ascii(o[j]) - 65))), 0)::INT AS before
      FROM orders, range(1, 6) t(i)
    ),
    told AS (
      SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (mask & before > 0 AND mask & own > 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own > 0), 0)::BIGINT AS toxic_lost
      FROM masks, steps GROUP BY ALL
    )
    SELECT * EXCLUDE own, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM told
    """
)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.table(spark, folder, "documents")
    return audit(with_labels(failure_masks(docs), text.table(spark, folder, "labels")))
