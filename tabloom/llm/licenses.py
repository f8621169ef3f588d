"""License scans: headers and licence files against templates, then inheritance by directory.

Terms are words of the templates. Their inverse document frequency is counted over all
documents. A header is a line with a licence cue together with the lines that follow it
(``HEADER_LINES`` at most; every shorter run is tried as well), or a whole block between blank lines that holds a
cue and has more lines than that; a licence file is a text that as a whole resembles a template. Headers and files
are compared with the notices of ``TEMPLATES``, files also with whole licence texts, if a table of them is given
(see :func:`licence_texts`). Headers, texts and templates are sparse TF-IDF vectors; words that
no template holds count with the largest weight in the length of a vector, so they pull the
cosine down. The best template above the limit (``LEAST_FILE`` is the higher one, for a long text shares its common words
with every notice) is the licence of the header or file. An SPDX tag and
the identifier after it are one term, so a tag with an identifier of no template is no licence.

A document without a header of its own takes the licence of the nearest directory above it that
holds a licence file: every distinct directory meets its ancestors by an equi-join on paths.

Only texts with a cue are cut into terms; all joins are on terms, units or paths, and their hot
keys (a term in most headers, a directory with most files) are combined on the map side or
joined to a side with one row per key.

Defined cases: a missing or empty text has no header; a missing path, or one without ``/``, has
the root as its directory; equal scores take the template that sorts first; several licence
files in one directory: the best score, then the template that sorts first; rows that share path
and text get the same result. An empty table gives an empty result. Only the columns named in
``scan`` are returned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom import runtime
from tabloom.llm import text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

# Notices by which public licences are applied or recognised.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License.",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "Artistic-1.0": ("The Artistic License",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has dedicated this work to the public domain, CC0 1.0.",
        "CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "GFDL-1.2": (
        "GNU Free Documentation License, Version 1.2",
        "GNU Free Documentation License Version 1.2, November 2002",
    ),
    "GFDL-1.3": (
        "GNU Free Documentation License, Version 1.3",
        "GNU Free Documentation License Version 1.3, 3 November 2008",
    ),
    "GPL-1.0": (
        "GNU GENERAL PUBLIC LICENSE Version 1, February 1989",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL-2.0": (
        "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    ),
    "LGPL-2.1": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: LGPL-3.0",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-1.1": ("MOZILLA PUBLIC LICENSE Version 1.1",),
    "MPL-2.0": (
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
# Identifiers of older licences. A scan with ``TEMPLATES`` alone knows these licences by their titles only.
OLDER_TAGS = {
    "Artistic-1.0": ("Artistic-1.0",),
    "GFDL-1.2": ("GFDL-1.2", "GFDL-1.2-only", "GFDL-1.2-or-later"),
    "GFDL-1.3": ("GFDL-1.3", "GFDL-1.3-only", "GFDL-1.3-or-later"),
    "GPL-1.0": ("GPL-1.0", "GPL-1.0-only", "GPL-1.0-or-later"),
    "GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "LGPL-2.0": ("LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later"),
    "LGPL-2.1": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "MPL-1.1": ("MPL-1.1",),
}
WITH_OLDER_TAGS = {
    name: notices + tuple(f"SPDX-License-Identifier: {tag}" for tag in OLDER_TAGS.get(name, ()))
    for name, notices in TEMPLATES.items()
}
CUE = r"(?i)licen[cs]e|copyright|spdx|permission is hereby|redistribution and use|public domain|\bcc0\b"
LEAST_COSINE = 0.4
LEAST_FILE = 0.6
HEADER_LINES = 4
_BREAK = r"\n[ \t\r]*\n"
_TERM = r"[^0-9a-z.-]+"
_TAG = "spdx-license-identifier"


def terms(body: Column) -> Column:
    """Lower-case words of letters, digits, dots and dashes, without dots and dashes at their ends.

    An SPDX tag takes the identifier after it into its own word.
    """
    lower = F.lower(body)
    tagged = F.when(F.contains(lower, F.lit(_TAG)), F.regexp_replace(lower, f"{_TAG} *: *", f"{_TAG}-")).otherwise(lower)
    cut = F.split(tagged, _TERM)
    return F.filter(F.transform(cut, lambda t: F.btrim(t, F.lit(".-"))), lambda t: t != "")


def licence_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``license`` (the file's name) and ``body`` of a folder that holds one whole licence text per file."""
    read = spark.read.text(folder, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_path"), "[^/]+$", 0)
    return read.select(F.url_decode(name).alias("license"), F.col("value").alias("body"))


def template_terms(spark: SparkSession, templates: Mapping[str, Sequence[str]], whole: DataFrame | None = None) -> DataFrame:
    """``kind``, ``license``, ``variant``, ``term``, ``tf``: as many rows as the templates have distinct terms, for each kind.

    Notices stand for headers and files, the licence texts of ``whole`` for files only (``variant`` -1).
    """
    schema = pa.schema([("license", pa.string()), ("variant", pa.int32()), ("body", pa.string())])
    rows = [{"license": k, "variant": i, "body": v} for k, vs in sorted(templates.items()) for i, v in enumerate(vs)]
    notices = runtime.local_table(spark, rows, schema)
    bodies = notices.select(F.explode(F.array(F.lit("header"), F.lit("file"))).alias("kind"), "*")
    if whole is not None:
        bodies = bodies.union(whole.select(F.lit("file"), "license", F.lit(-1), text.whole(F.col("body"))))
    exploded = bodies.withColumn("term", F.explode(terms(F.col("body"))))
    return exploded.groupBy("kind", "license", "variant", "term").agg(F.count("*").alias("tf"))


def inverse_frequencies(docs: DataFrame, body: str, vocabulary: list[str]) -> DataFrame:
    """``term`` and ``idf`` over all documents for every word of the vocabulary."""
    held = docs.select(F.explode(F.array_distinct(F.filter(terms(text.whole(F.col(body))), lambda t: t.isin(vocabulary)))).alias("term"))
    counts = held.groupBy("term").agg(F.count("*").alias("df"))
    known = runtime.local_table(docs.sparkSession, [{"term": t} for t in vocabulary], pa.schema([("term", pa.string())]))
    return known.join(counts, "term", "left").select("term", _idf(F.coalesce("df", F.lit(0)), docs.count()).alias("idf"))


def _idf(frequency: Column, total: int) -> Column:
    return F.log(F.lit(float(1 + total)) / (1 + frequency)) + 1


def units(docs: DataFrame, path: str, body: str) -> DataFrame:
    """Headers and whole texts of documents with a cue: ``doc`` (path and text hash), ``kind``, ``part``, ``body``."""
    cued = docs.filter(F.col(body).rlike(CUE)).select(
        F.xxhash64(F.coalesce(path, F.lit("")), F.col(body)).alias("doc"), F.col(body).alias("whole")
    ).distinct()
    lines = cued.withColumn("lines", F.split("whole", "\n"))
    cue = lambda line, i: F.when(line.rlike(CUE), F.struct((i + 1).alias("at"), F.slice("lines", i + 1, HEADER_LINES).alias("some")))
    starts = lines.select("doc", F.explode(F.filter(F.transform("lines", cue), lambda s: s.isNotNull())).alias("start"))
    runs = starts.select("doc", "start.*", F.explode(F.array(*[F.lit(k) for k in range(1, HEADER_LINES + 1)])).alias("take"))
    headers = runs.filter(F.col("take") <= F.size("some")).select(
        "doc",
        F.lit("header").alias("kind"),
        F.concat_ws(":", "at", "take").alias("part"),
        F.array_join(F.slice("some", F.lit(1), F.col("take")), " ").alias("body"),
    )
    blocks = cued.select("doc", F.posexplode(F.split("whole", _BREAK)).alias("at", "block"))
    long = F.col("block").rlike(CUE) & (F.size(F.split("block", "\n")) > HEADER_LINES)  # runs cover the others
    whole_blocks = blocks.filter(long).select("doc", F.lit("header"), F.concat_ws(":", F.lit("block"), F.col("at") + 1), "block")
    return headers.union(whole_blocks).union(cued.select("doc", F.lit("file"), F.lit("whole"), "whole"))


def best_matches(
    found: DataFrame,
    weights: DataFrame,
    templates: DataFrame,
    total: int,
    least: float = LEAST_COSINE,
    least_file: float = LEAST_FILE,
) -> DataFrame:
    """The best template of every ``doc`` and ``kind``: ``license`` and ``score`` (rounded cosine)."""
    spread = found.select("doc", "kind", "part", F.explode(terms(F.col("body"))).alias("word"))
    unit = ["doc", "kind", "part"]
    counted = (
        spread.groupBy(*unit, "word")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(weights.withColumnRenamed("term", "word")), "word", "left")  # terms of the templates
        .withColumn("weight", F.col("tf") * F.coalesce("idf", _idf(F.lit(0), total)))
    )
    lengths = counted.groupBy(*unit).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("length"))
    vectors = templates.join(F.broadcast(weights), "term").withColumn("t_weight", F.col("tf") * F.col("idf"))
    norms = vectors.groupBy("kind", "license", "variant").agg(F.sqrt(F.sum(F.col("t_weight") ** 2)).alias("t_length"))
    sides = vectors.withColumnRenamed("term", "word").drop("tf", "idf").join(norms, ["kind", "license", "variant"])
    dots = (
        counted.filter(F.col("idf").isNotNull())
        .join(F.broadcast(sides), ["kind", "word"])
        .groupBy(*unit, "license", "variant", "t_length")
        .agg(F.sum(F.col("weight") * F.col("t_weight")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / (F.col("length") * F.col("t_length")), 4)
    limit = F.when(F.col("kind") == "file", least_file).otherwise(least)
    scored = dots.join(lengths, unit).withColumn("score", cosine).filter(F.col("score") >= limit)
    found = scored.groupBy("doc", "kind").agg(_best().alias("best"))
    return found.select("doc", "kind", "best.license", (-F.col("best.under")).alias("score"))


def _best() -> Column:
    """The highest score, and among equal ones the licence that sorts first."""
    return F.min(F.struct((-F.col("score")).alias("under"), "license"))


def directory(path: Column) -> Column:
    """The directory of a path without a slash at its end; the root is empty."""
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"/?[^/]*$", "")


def inherited(directories: DataFrame, files: DataFrame) -> DataFrame:
    """``dir``, and ``license`` and ``from_dir`` of the nearest of it and its ancestors that holds a file."""
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    spread = directories.select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("from_dir"))
    met = spread.join(files, "from_dir")
    nearest = F.max_by(F.struct("license", "from_dir"), F.length("from_dir"))
    return met.groupBy("dir").agg(nearest.alias("found")).select("dir", "found.*")


def scan(
    docs: DataFrame,
    *,
    path: str = "path",
    body: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    whole: DataFrame | None = None,
    least: float = LEAST_COSINE,
    least_file: float = LEAST_FILE,
) -> DataFrame:
    """The columns of ``docs`` but the text, and ``license``, ``score``, ``origin`` and ``from_dir``.

    ``origin`` is ``header``, ``inherited`` or missing; ``from_dir`` is the directory a licence comes from. ``whole`` is a
    table of licence texts (``license``, ``body``), whose distinct words are few enough to be held by the driver.
    """
    spark = docs.sparkSession
    sides = template_terms(spark, templates, whole)
    vocabulary = sorted({row["term"] for row in sides.select("term").collect()})  # of the templates
    weights = runtime.store(inverse_frequencies(docs, body, vocabulary), "weights")
    best = runtime.store(best_matches(units(docs, path, body), weights, sides, docs.count(), least, least_file), "matches")
    plain = docs.drop("license", "score", "origin", "from_dir", "scan__dir", "scan__doc")
    keyed = plain.withColumns(
        {
            "scan__doc": F.xxhash64(F.coalesce(path, F.lit("")), text.whole(F.col(body))),
            "scan__dir": directory(F.col(path)),
        }
    ).drop(body)
    file_best = best.filter(F.col("kind") == "file").select(F.col("doc").alias("scan__doc"), "license", "score")
    files = (
        keyed.select("scan__doc", F.col("scan__dir").alias("from_dir"))
        .join(file_best, "scan__doc")
        .groupBy("from_dir")
        .agg(_best()["license"].alias("license"))
    )
    from_above = runtime.store(inherited(keyed.select(F.col("scan__dir").alias("dir")), files), "inherited").select(
        F.col("dir").alias("scan__dir"), F.col("license").alias("above"), "from_dir"
    )
    own = best.filter(F.col("kind") == "header").select(F.col("doc").alias("scan__doc"), "license", "score")
    joined = keyed.join(own, "scan__doc", "left").join(from_above, "scan__dir", "left")
    has = F.col("license").isNotNull()
    origin = F.when(has, F.lit("header")).when(F.col("above").isNotNull(), F.lit("inherited"))
    return joined.select(
        *[c for c in plain.columns if c != body],
        F.coalesce("license", "above").alias("license"),
        "score",
        origin.alias("origin"),
        F.when(~has, F.col("from_dir")).alias("from_dir"),
    )


def _terms_sql(body: str) -> str:
    return (
        f"list_filter([regexp_replace(t, '^[.-]+|[.-]+$', '', 'g') FOR t IN "
        f"string_split_regex(regexp_replace(lower({body}), '{_TAG} *: *', '{_TAG}-', 'g'), '{_TERM}')], lambda t: t <> '')"
    )


def _templates_sql() -> str:
    return ", ".join(f"('{k}', {i}, '{v}')" for k, vs in WITH_OLDER_TAGS.items() for i, v in enumerate(vs))


@CATALOG.query(
    f"""
    WITH docs AS (
      SELECT doc_id, coalesce(text, '') AS body,
        concat_ws('/', source, lang, printf('%06d', doc_id // 100), doc_id::VARCHAR) AS path FROM documents
    ),
    placed AS (SELECT *, regexp_replace(path, '/?[^/]*$', '') AS dir FROM docs),
    templates AS (SELECT * FROM (VALUES {_templates_sql()}) t(license, variant, body)),
    t_terms AS (
      SELECT license, variant, term, count(*) AS tf
      FROM (SELECT license, variant, unnest({_terms_sql('body')}) AS term FROM templates) GROUP BY ALL
    ),
    held AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({_terms_sql('body')})) AS term FROM docs) GROUP BY 1),
    idf AS (
      SELECT term, ln((1.0 + (SELECT count(*) FROM docs))::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf
      FROM (SELECT DISTINCT term FROM t_terms) LEFT JOIN held USING (term)
    ),
    cued AS (SELECT doc_id, body, string_split(body, chr(10)) AS lines FROM docs WHERE regexp_matches(body, '{CUE}')),
    starts AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS at_line FROM cued),
    units AS (
      SELECT doc_id, 'header' AS kind, at_line || ':' || take AS part,
        array_to_string(lines[at_line : at_line + take - 1], ' ') AS body
      FROM starts, range(1, {HEADER_LINES + 1}) r(take)
      WHERE regexp_matches(lines[at_line], '{CUE}') AND at_line + take - 1 <= len(lines)
      UNION ALL SELECT doc_id, 'header', 'block:' || at_block, blocks[at_block] FROM (
        SELECT doc_id, string_split_regex(body, '{_BREAK}') AS blocks, unnest(range(1, len(blocks) + 1)) AS at_block FROM cued
      ) WHERE regexp_matches(blocks[at_block], '{CUE}') AND len(string_split(blocks[at_block], chr(10))) > {HEADER_LINES}
      UNION ALL SELECT doc_id, 'file', 'whole', body FROM cued
    ),
    counted AS (
      SELECT doc_id, kind, part, term, count(*) AS tf
      FROM (SELECT doc_id, kind, part, unnest({_terms_sql('body')}) AS term FROM units) GROUP BY ALL
    ),
    weighed AS (
      SELECT c.*, idf, tf * coalesce(idf, ln((1.0 + (SELECT count(*) FROM docs))::DOUBLE) + 1) AS weight
      FROM counted c LEFT JOIN idf USING (term)
    ),
    lengths AS (SELECT doc_id, kind, part, sqrt(sum(weight * weight)) AS length FROM weighed GROUP BY ALL),
    vectors AS (SELECT license, variant, term, tf * idf AS t_weight FROM t_terms JOIN idf USING (term)),
    norms AS (SELECT license, variant, sqrt(sum(t_weight * t_weight)) AS t_length FROM vectors GROUP BY ALL),
    scored AS (
      SELECT doc_id, kind, license, round(sum(weight * t_weight) / (any_value(length) * any_value(t_length)), 4) AS score
      FROM weighed JOIN vectors USING (term) JOIN norms USING (license, variant) JOIN lengths USING (doc_id, kind, part)
      GROUP BY doc_id, kind, part, license, variant
    ),
    best AS (
      SELECT doc_id, kind, license, score FROM scored WHERE score >= CASE kind WHEN 'file' THEN {LEAST_FILE} ELSE {LEAST_COSINE} END
      QUALIFY row_number() OVER (PARTITION BY doc_id, kind ORDER BY score DESC, license) = 1
    ),
    files AS (
      SELECT dir AS from_dir, license FROM placed JOIN best USING (doc_id) WHERE kind = 'file'
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1
    ),
    above AS (
      SELECT dir, license, from_dir FROM (SELECT DISTINCT dir FROM placed) JOIN files
        ON from_dir = '' OR dir = from_dir OR starts_with(dir, from_dir || '/')
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(from_dir) DESC) = 1
    )
    SELECT p.doc_id, p.path, coalesce(b.license, a.license) AS license, b.score,
      CASE WHEN b.license IS NOT NULL THEN 'header' WHEN a.license IS NOT NULL THEN 'inherited' END AS origin,
      CASE WHEN b.license IS NULL THEN a.from_dir END AS from_dir
    FROM placed p LEFT JOIN best b ON b.doc_id = p.doc_id AND b.kind = 'header' LEFT JOIN above a ON a.dir = p.dir
    """
)
def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.table(spark, folder, "documents")
    place = F.concat_ws("/", "source", "lang", F.format_string("%06d", F.floor(F.col("doc_id") / 100)), "doc_id")
    return scan(docs.select("doc_id", place.alias("path"), "text"), templates=WITH_OLDER_TAGS)
