"""Queries of the corpus plans on documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.functions import sequences, text
from tabloom.operators import pairs, rank, vocab
from tabloom.plans import corpus
from tabloom.plans.catalog import Catalog
from tabloom.plans.standins import TURNS_SQL, sql_tokens, table, turns
from tabloom.sources import tables

CATALOG = Catalog()

_LENGTH = 11


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.tokenized(table(spark, folder, "documents"), "doc_id", "text")


def _french(spark: SparkSession, folder: str) -> DataFrame:
    french = table(spark, folder, "documents").filter(F.col("lang") == "fr")
    return vocab.tokenized(french, "doc_id", "text")


_DOCS_SQL = f"docs AS (SELECT doc_id, lang, {sql_tokens('text')} AS w FROM documents)"
_FRENCH_SQL = f"{_DOCS_SQL}, fr AS (SELECT doc_id, w FROM docs WHERE lang = 'fr')"


def _places_sql(source: str, key: str, words: str = "w") -> str:
    return f"SELECT {key}, unnest({words}) AS token, unnest(range(1, len({words}) + 1)) AS pos FROM {source}"


def _vocab_sql(name: str, source: str, key: str, words: str = "w") -> str:
    return f"""{name} AS (
      SELECT token, n, row_number() OVER (ORDER BY first_place) + 2 AS token_id FROM (
        SELECT token, count(*) AS n, min(({key}, pos)) AS first_place
        FROM ({_places_sql(source, key, words)}) GROUP BY 1)
      UNION ALL VALUES ('<PAD>', 0, 0), ('<SOS>', 0, 1), ('<EOS>', 0, 2))"""


def _ids_sql(source: str, key: str, words: str, voc: str, length: int) -> str:
    """(key, ids): marked, cut and padded id lists."""
    return f"""(SELECT s.{key}, list_concat(list_concat([1], coalesce(g.ids, [])), list_concat([2], [0 FOR i IN range({length})]))[1:{length}] AS ids
      FROM {source} s LEFT JOIN (
        SELECT p.{key}, list(coalesce(v.token_id, 0) ORDER BY p.pos) AS ids
        FROM ({_places_sql(source, key, words)}) p LEFT JOIN {voc} v ON v.token = p.token GROUP BY 1) g
      ON g.{key} = s.{key})"""


@CATALOG.query(f"WITH {_DOCS_SQL} SELECT doc_id, len(w) AS n_tokens, md5(array_to_string(w, ' ')) AS digest FROM docs")
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, as count and digest."""
    return _documents(spark, folder).select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.md5(text.join_words("tokens")).alias("digest")
    )


@CATALOG.query(
    f"""SELECT doc_id, md5(array_to_string({sql_tokens("replace(replace(text, chr(10), ' '), chr(9), ' ')")}, ' ')) AS digest
        FROM documents"""
)
def tokenize_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens with line breaks as separators."""
    tokens = vocab.tokenized(table(spark, folder, "documents"), "doc_id", "text", newline_as_space=True)
    return tokens.select("doc_id", F.md5(text.join_words("tokens")).alias("digest"))


@CATALOG.query(f"WITH {_DOCS_SQL} SELECT token, count(*) AS n FROM (SELECT unnest(w) AS token FROM docs) GROUP BY 1")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Frequency of every token."""
    return vocab.token_counts(_documents(spark, folder))


@CATALOG.query(
    f"""WITH {_DOCS_SQL}, p AS ({_places_sql('docs', 'doc_id')})
        SELECT token, count(*) AS n, min(doc_id) AS first_key,
          CAST(min({{'d': doc_id, 'p': pos}}).p - 1 AS INT) AS first_pos FROM p GROUP BY 1"""
)
def first_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    """First place of every token."""
    return vocab.first_occurrences(_documents(spark, folder), "doc_id")


@CATALOG.query(f"WITH {_DOCS_SQL}, {_vocab_sql('voc', 'docs', 'doc_id')} SELECT token, n, token_id FROM voc")
def build_vocab(spark: SparkSession, folder: str) -> DataFrame:
    """Vocabulary of all documents."""
    return vocab.build_vocab(_documents(spark, folder), "doc_id")


@CATALOG.query(
    f"WITH {_DOCS_SQL}, {_vocab_sql('voc', 'docs', 'doc_id')} SELECT token_id, token FROM voc WHERE token_id < 10"
)
def vocab_head(spark: SparkSession, folder: str) -> DataFrame:
    """First ten entries of the vocabulary."""
    return corpus.vocab_head(vocab.build_vocab(_documents(spark, folder), "doc_id"))


@CATALOG.query(f"WITH {_DOCS_SQL}, {_vocab_sql('voc', 'docs', 'doc_id')} SELECT count(*) AS entries FROM voc")
def vocab_size(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of the vocabulary, special tokens included."""
    return vocab.vocab_size(vocab.build_vocab(_documents(spark, folder), "doc_id"))


@CATALOG.query(
    f"""WITH {_FRENCH_SQL}, {_vocab_sql('voc', 'fr', 'doc_id')}
        SELECT doc_id, array_to_string(ids, ' ') AS ids FROM {_ids_sql('docs', 'doc_id', 'w', 'voc', _LENGTH)}"""
)
def encode_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as id sequences of the French vocabulary; words outside it become PAD."""
    words = vocab.build_vocab(_french(spark, folder), "doc_id")
    ids = vocab.encode(_documents(spark, folder), words, "doc_id", _LENGTH)
    return ids.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@CATALOG.query(
    f"""WITH {_FRENCH_SQL} SELECT token, count(*) AS n FROM (SELECT unnest(w) AS token FROM docs)
        WHERE token NOT IN (SELECT unnest(w) FROM fr) GROUP BY 1"""
)
def oov_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents that the French ones lack."""
    words = vocab.build_vocab(_french(spark, folder), "doc_id")
    return vocab.unknown_tokens(_documents(spark, folder), words)


@CATALOG.query(
    f"""WITH {_DOCS_SQL}, {_vocab_sql('voc', 'docs', 'doc_id')}
        SELECT d.doc_id, len(d.w) AS n_ids, md5(array_to_string(list(v.token_id ORDER BY p.pos), ' ')) AS digest
        FROM docs d JOIN ({_places_sql('docs', 'doc_id')}) p ON p.doc_id = d.doc_id JOIN voc v ON v.token = p.token
        GROUP BY 1, 2"""
)
def encode_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as ids, without marks and padding."""
    tokens = runtime.store(_documents(spark, folder), "tokens")  # read by each pass over the words
    words = vocab.build_vocab(tokens, "doc_id")
    ids = vocab.encode_strict(tokens, words, "doc_id", own=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.md5(joined).alias("digest"))


@CATALOG.query(
    f"""WITH {_DOCS_SQL}, {_vocab_sql('voc', 'docs', 'doc_id')}
        SELECT doc_id, array_to_string(list_concat(list_concat(w, ['<EOS>']), ['<PAD>' FOR i IN range({_LENGTH})])[1:{_LENGTH - 1}], ' ') AS text
        FROM docs"""
)
def decode_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Padded id sequences turned back into text, the start mark cut."""
    tokens = _documents(spark, folder)
    words = vocab.build_vocab(tokens, "doc_id")
    return vocab.decode(vocab.encode(tokens, words, "doc_id", _LENGTH), words, "doc_id")


@CATALOG.query(
    f"""WITH {_DOCS_SQL} SELECT count(*) AS sentences, CAST(sum(len(w)) AS BIGINT) AS tokens FROM docs"""
)
def corpus_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Number of documents and tokens."""
    return corpus.corpus_counts(_documents(spark, folder), "doc_id")


@CATALOG.query(
    """SELECT "row", event_id, value FROM (
         SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS "row", event_id, value FROM events)
       WHERE "row" IN (0, 1000, 3000)"""
)
def ordinal_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events at three places of the order in time."""
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    placed = rank.ordered_rank(events, "place", ["ts", "event_id"])
    numbered = placed.select((F.col("place") - 1).alias("row"), "event_id", "value")
    return corpus.sample_lines(numbered, "row", (0, 1000, 3000))


@CATALOG.query(f"WITH {TURNS_SQL} SELECT pair_id, md5(source) AS source, md5(target) AS target FROM turns")
def pair_corpora(spark: SparkSession, folder: str) -> DataFrame:
    """Source and target texts joined on their key."""
    both = turns(spark, folder)
    paired = pairs.pair_by_key(
        both.select("pair_id", F.col("source").alias("text")),
        both.select("pair_id", F.col("target").alias("text")),
        "pair_id",
    )
    return paired.select("pair_id", F.md5("source").alias("source"), F.md5("target").alias("target"))


_PAIRS_SQL = f"""{TURNS_SQL}, toks AS (
  SELECT pair_id, {sql_tokens('source')} AS sw, {sql_tokens('target')} AS tw FROM turns),
  {_vocab_sql('sv', 'toks', 'pair_id', 'sw')}, {_vocab_sql('tv', 'toks', 'pair_id', 'tw')}"""


@CATALOG.query(
    f"""WITH {_PAIRS_SQL} SELECT s.pair_id, array_to_string(s.ids, ' ') AS src_ids,
          array_to_string(t.ids[1:{_LENGTH - 1}], ' ') AS tgt_in, array_to_string(t.ids[2:{_LENGTH}], ' ') AS tgt_out,
          array_to_string([CAST(i = 0 AS INT) FOR i IN s.ids], '') AS src_pad,
          array_to_string([CAST(i = 0 AS INT) FOR i IN t.ids[1:{_LENGTH - 1}]], '') AS tgt_pad,
          CASE WHEN row_number() OVER (ORDER BY CAST(('0x' || substr(md5('42|' || CAST(s.pair_id AS VARCHAR)), 1, 15)) AS UBIGINT), s.pair_id)
            <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split
        FROM {_ids_sql('toks', 'pair_id', 'sw', 'sv', _LENGTH)} s
        JOIN {_ids_sql('toks', 'pair_id', 'tw', 'tv', _LENGTH)} t ON t.pair_id = s.pair_id"""
)
def training_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Model inputs from question and answer turns."""
    # the pairs come from a join of whole texts and are read once per vocabulary and side
    ready = pairs.training_pairs(runtime.store(turns(spark, folder), "turns"), "pair_id", _LENGTH)
    shown = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("src_ids", "tgt_in", "tgt_out")]
    masks = [F.array_join(F.col(c).cast("array<int>").cast("array<string>"), "").alias(c) for c in ("src_pad", "tgt_pad")]
    return ready.select("pair_id", *shown, *masks, "split")


@CATALOG.query(
    f"""WITH {_FRENCH_SQL}, {_vocab_sql('voc', 'fr', 'doc_id')}
        SELECT doc_id, len(list_filter(ids, lambda i: i = 0)) AS padded FROM {_ids_sql('docs', 'doc_id', 'w', 'voc', 30)}"""
)
def padding_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Masked positions per document."""
    words = vocab.build_vocab(_french(spark, folder), "doc_id")
    ids = vocab.encode(_documents(spark, folder), words, "doc_id", 30)
    masked = F.size(F.filter(sequences.pad_mask("ids"), lambda x: x))
    return ids.select("doc_id", masked.cast("long").alias("padded"))


def _write_lines(df: DataFrame, order: str, column: str, path: str) -> None:
    """Headerless CSV parts in key order, one line per text."""
    flat = df.select(order, F.regexp_replace(column, r"[\r\n]", " ").alias("text"))
    tables.write_table(
        flat.orderBy(order).select("text"), path, fmt="csv", header=False, escape='"', emptyValue=""
    )


@CATALOG.query(
    f"""WITH {TURNS_SQL} SELECT row_number() OVER (ORDER BY pair_id) - 1 AS "row",
          md5(regexp_replace(source, '[\\r\\n]', ' ', 'g')) AS source,
          md5(regexp_replace(target, '[\\r\\n]', ' ', 'g')) AS target FROM turns"""
)
def paired_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two line files written in key order, read back and paired by line position."""
    both = runtime.store(turns(spark, folder), "turns")
    paths = {side: runtime.scratch_path(spark, side) for side in ("source", "target")}
    for side, path in paths.items():
        _write_lines(both, "pair_id", side, path)
    paired = corpus.read_pairs(spark, paths["source"], paths["target"])
    return paired.select("row", F.md5("source").alias("source"), F.md5("target").alias("target"))


@CATALOG.query(
    """SELECT o_orderpriority || '' AS "text", count(*) AS n FROM orders GROUP BY 1"""
)
def first_field(spark: SparkSession, folder: str) -> DataFrame:
    """First field of a headerless file with several fields."""
    path = runtime.scratch_path(spark, "fields")
    fields = table(spark, folder, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    tables.write_table(fields, path, fmt="csv", header=False)
    return tables.read_first_field(spark, path).groupBy("text").agg(F.count("*").alias("n"))
