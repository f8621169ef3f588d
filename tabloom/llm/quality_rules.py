"""Quality rules: the shape of a text, and lines that many documents of a host share.

The method counts, for every host and normalised line (hashed), the distinct documents that
hold it, and removes lines above the limits. A document that loses so much that fewer than
``least_words`` words stay is depleted and rejected. Documents with the same text count once,
so copies do not make their own lines look like boilerplate. Only lines above the limits meet
the documents again.

A line is above the limits if at least ``least_docs`` distinct documents of its host hold it and
they are more than ``most_share`` of the host's distinct documents or more than ``most_docs``,
whichever is less, so that the limit does not grow with the host.

Everything is a column expression or a join; the words of one document are handled inside its row.

Defined cases: a missing text counts as empty and fails the base rule; a missing host is a host
of its own; rows that share key, host and text are judged alike; lines without a word are never
removed. An empty table gives an empty result. Added columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

LEAST_WORDS = 50
REPEAT_PERCENT = 50
LEAST_DOCS = 10
MOST_SHARE = 0.1
MOST_DOCS = 100


def repeated_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more, first ones included.

    Windows are compared by a 64-bit hash. Only a text in which some hash repeats is sorted.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(rows: Column) -> Column:
            def repeats(row: Column, k: Column) -> Column:
                before, after = F.get(rows, k - 1), F.get(rows, k + 1)
                return F.coalesce(before["h"] == row["h"], F.lit(False)) | F.coalesce(
                    after["h"] == row["h"], F.lit(False)
                )

            return F.array_sort(F.transform(F.filter(rows, repeats), lambda row: row["i"]))

        def union(at: Column) -> Column:
            gaps = F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - i, F.lit(3))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

        return text.let(text.let(placed, starts), union)

    def windows(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - 3)
        hashed = F.transform(starts, lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
        return F.when(F.size(ws) >= 3, hashed).otherwise(F.array().cast("array<bigint>"))

    def count(hashes: Column) -> Column:
        unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(unique, F.lit(0).cast("long")).otherwise(covered(hashes))

    return text.let(text.let(words, windows), count)


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(text.WHITE)) != ""


def shape(source: Column) -> dict[str, Column]:
    """Counts of a text, in one column: words, their characters, symbols, repeated lines and words."""
    whole = text.whole(source)

    def counts(ws: Column) -> Column:
        lines = F.filter(F.split(whole, "\n"), has_word)
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            text.let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            repeated_words(ws).alias("n_repeat_words"),
        )

    return text.let(text.words(source), counts)


def normal_line(line: Column) -> Column:
    """White space runs as one blank, none at the ends, lower case, digits alike."""
    plain = F.btrim(F.regexp_replace(line, text.WHITE_RUN, " "), F.lit(" "))
    return F.regexp_replace(F.lower(plain), r"[0-9]+", "0")


def _host_key(host: Column) -> Column:
    """Hosts by hash; a missing host is one of its own."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("")))


def body_keys(docs: DataFrame, host: str, body: str) -> list[Column]:
    """``host_key`` and ``body_hash``: what documents that are judged alike share."""
    return [_host_key(F.col(host)).alias("host_key"), F.xxhash64(text.whole(F.col(body))).alias("body_hash")]


def line_table(docs: DataFrame, host: str, body: str) -> DataFrame:
    """One row per line with a word: keys of the document, ``pos``, ``line`` and ``line_hash``."""
    lines = docs.select(
        *body_keys(docs, host, body), F.posexplode(F.split(text.whole(F.col(body)), "\n")).alias("pos", "line")
    ).filter(has_word(F.col("line")))
    return lines.withColumn("line_hash", F.xxhash64(normal_line(F.col("line"))))


def frequent_lines(
    docs: DataFrame,
    *,
    host: str = "source",
    body: str = "text",
    least_docs: int = LEAST_DOCS,
    most_share: float = MOST_SHARE,
    most_docs: int = MOST_DOCS,
) -> DataFrame:
    """``host_key``, ``line_hash`` and ``line_docs`` of lines above the limits.

    Distinct documents are found before they are counted, both with map-side combining, so a
    line that most documents hold is spread over all tasks.
    """
    sizes = docs.select(*body_keys(docs, host, body)).distinct().groupBy("host_key").agg(F.count("*").alias("host_docs"))
    held = line_table(docs, host, body).select("host_key", "line_hash", "body_hash").distinct()
    counted = held.groupBy("host_key", "line_hash").agg(F.count("*").alias("line_docs"))
    over = F.col("line_docs") > F.least(F.col("host_docs") * F.lit(most_share), F.lit(float(most_docs)))
    often = counted.filter(F.col("line_docs") >= least_docs)
    return often.join(sizes, "host_key").filter(over).select("host_key", "line_hash", "line_docs")


def depleted(
    docs: DataFrame, limits: DataFrame, *, host: str = "source", body: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """``host_key`` and ``body_hash`` of documents left with too few words once lines are removed."""
    lines = line_table(docs, host, body)
    removed = (
        lines.join(limits.select("host_key", "line_hash"), ["host_key", "line_hash"], "left_semi")
        .groupBy("host_key", "body_hash", "pos")
        .agg(F.max(text.word_count(F.col("line"))).alias("n_words"))
        .groupBy("host_key", "body_hash")
        .agg(F.sum("n_words").alias("n_removed"))
    )
    totals = docs.select(*body_keys(docs, host, body), text.word_count(F.col(body)).alias("n_words")).distinct()
    left = F.col("n_words") - F.col("n_removed")
    return totals.join(removed, ["host_key", "body_hash"]).filter(left < least_words).select("host_key", "body_hash")


def judge(
    docs: DataFrame,
    *,
    host: str = "source",
    body: str = "text",
    least_words: int = LEAST_WORDS,
    repeat_percent: int = REPEAT_PERCENT,
    least_docs: int = LEAST_DOCS,
    most_share: float = MOST_SHARE,
    most_docs: int = MOST_DOCS,
    limits: DataFrame | None = None,
) -> DataFrame:
    """Add the counts of :func:`shape`, ``base_failed`` and ``kept``.

    ``limits`` are the frequent lines if they are known already.
    """
    if limits is None:
        limits = runtime.store(
            frequent_lines(docs, host=host, body=body, least_docs=least_docs, most_share=most_share, most_docs=most_docs),
            "lines",
        )
    rejected = runtime.store(depleted(docs, limits, host=host, body=body, least_words=least_words), "depleted")
    counts = shape(F.col(body))
    plain = docs.drop(*_ADDED)
    shaped = plain.withColumns({"shape": counts, **dict(zip(("host_key", "body_hash"), body_keys(docs, host, body)))})
    fails = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    found = shaped.join(rejected.withColumn("depleted", F.lit(True)), ["host_key", "body_hash"], "left")
    return (
        found.select(*plain.columns, "shape.*", F.coalesce("depleted", F.lit(False)).alias("depleted"))
        .withColumn("base_failed", fails)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    )


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ADDED = (*_COUNTS, "shape", "host_key", "body_hash", "depleted", "base_failed", "kept")


def without_frequent_lines(docs: DataFrame, limits: DataFrame, *, host: str = "source", body: str = "text") -> DataFrame:
    """The documents with lines above the limits taken out of their text.

    The limits of one host travel as one array to its documents; a host has fewer such lines
    than 1 / ``most_share`` times the lines of its longest document, or 1 / ``most_docs`` of all its lines. A
    document first takes the limits that it meets out of them, so a long one costs lines plus limits.
    """
    own = limits.groupBy(F.col("host_key").alias("quality__host")).agg(F.collect_set("line_hash").alias("quality__limits"))
    keyed = docs.withColumn("quality__key", _host_key(F.col(host)))
    joined = keyed.join(own, F.col("quality__key") == F.col("quality__host"), "left")
    none = F.array().cast("array<bigint>")

    def rest(lines: Column) -> Column:
        hashes = F.transform(lines, lambda line: F.when(has_word(line), F.xxhash64(normal_line(line))))
        met = lambda own_hashes: F.array_intersect(own_hashes, F.coalesce("quality__limits", none))
        stay = lambda pair: F.filter(
            lines, lambda _, i: ~F.coalesce(F.array_contains(pair["met"], F.get(pair["hashes"], i)), F.lit(False))
        )
        return text.let(hashes, lambda h: text.let(F.struct(h.alias("hashes"), met(h).alias("met")), stay))

    left = text.let(F.split(F.col(body), "\n"), rest)
    return joined.withColumn(body, F.array_join(left, "\n")).select(*docs.columns)


@CATALOG.query(
    rf"""
    WITH lines AS (
      SELECT doc_id, source, coalesce(text, '') AS body,
        unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents
    ),
    full_lines AS (
      SELECT *, lower(line) AS lowered FROM lines WHERE regexp_matches(line, '[^ 	-
]')
    ),
    normal AS (
      SELECT *, regexp_replace(trim(regexp_replace(lowered, '[ 	-
]+', ' ', 'g'), ' '), '[0-9]+', '0', 'g') AS key,
        len(regexp_extract_all(line, '[^ 	-
]+'))::BIGINT AS line_words
      FROM full_lines
    ),
    hosts AS (SELECT source, count(DISTINCT coalesce(text, '')) AS host_docs FROM documents GROUP BY source),
    limits AS (
      SELECT n.source, n.key FROM normal n JOIN hosts h ON n.source IS NOT DISTINCT FROM h.source
      GROUP BY n.source, n.key
      HAVING count(DISTINCT body) >= {LEAST_DOCS} AND count(DISTINCT body) > least(any_value(host_docs) * {MOST_SHARE}::DOUBLE, {MOST_DOCS})
    ),
    lost AS (
      SELECT source, body, sum(line_words) AS lost FROM (
        SELECT DISTINCT n.source, n.body, n.pos, n.line_words FROM normal n JOIN limits l
          ON n.key = l.key AND n.source IS NOT DISTINCT FROM l.source)
      GROUP BY source, body
    ),
    split AS (
      SELECT doc_id, source, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words
      FROM documents
    ),
    placed AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS row_id FROM split),
    windows AS (
      SELECT row_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
      FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM placed)
    ),
    marked AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows),
    covered AS (
      SELECT row_id, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS place FROM marked WHERE n > 1) GROUP BY row_id
    ),
    counted AS (
      SELECT p.row_id, p.doc_id, p.source, p.body, len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(p.body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (SELECT count(line) - count(DISTINCT line) FROM (
          SELECT unnest(string_split(p.body, chr(10))) AS line) WHERE regexp_matches(line, '[^ 	-
]'))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM placed p LEFT JOIN covered USING (row_id)
    ),
    based AS (
      SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM counted
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT (lost IS NOT NULL AND n_words - lost < {LEAST_WORDS}) AS kept
    FROM based b LEFT JOIN lost l ON b.source IS NOT DISTINCT FROM l.source AND b.body = l.body
    """
)
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.table(spark, folder, "documents").select("doc_id", "text", "source")
    return judge(docs).select("doc_id", *_COUNTS, "base_failed", "kept")
