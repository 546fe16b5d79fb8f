"""License scans on DataFrame functions alone.

Lines of a file are compared with licence templates by sparse TF-IDF cosine. What a file says itself holds; a file that
says nothing inherits from the licence file of its nearest ancestor directory, found by joins on directory paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import UPPER, ascii_lower, require, shared_root, written

#: Statements that files carry in their headers and licence files. The wording is the licences' own.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
#: Characters that separate terms, as a translation to spaces.
_MARKS = "\t\x0b\x0c\r,;:()[]{}<>\"'`!?*#/\\|=+_&%$@^~"
#: Copies of a directory's row on the small side of the last join: one directory may hold a third of all files.
SALTS = 8
LICENCE_FILES = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"


@dataclass(frozen=True)
class LicenseConfig:
    """``least``: cosine from which a line states a licence."""

    least: float = 0.7


def terms(text: Column) -> Column:
    """Distinct terms: lower-cased, separated by white space and marks, without full stops at their ends."""
    plain = F.translate(ascii_lower(text), _MARKS, " " * len(_MARKS))
    parts = F.transform(F.split(plain, " "), lambda w: F.rtrim(w, F.lit(".")))
    return F.array_distinct(F.filter(parts, lambda w: w != ""))


def python_terms(text: str) -> list[str]:
    plain = text.translate(str.maketrans(UPPER, UPPER.lower())).translate(str.maketrans(_MARKS, " " * len(_MARKS)))
    return list(dict.fromkeys(w for w in (x.rstrip(".") for x in plain.split(" ")) if w))


def template_terms() -> list[tuple[str, int, list[str]]]:
    return [(name, i, python_terms(text)) for name, texts in TEMPLATES.items() for i, text in enumerate(texts)]


def statements(files: DataFrame, cfg: LicenseConfig | None = None, folder: str | None = None) -> DataFrame:
    """``path``, ``license``, ``cosine``: the best statement of each file that has one at ``cfg.least`` or more.

    ``idf`` of a template's term is ``ln((1 + n) / (1 + df)) + 1`` over all ``n`` files; other terms count as found in
    one file. A line is a set of terms. Lines are whole, however long. Ties go to the first name.
    """
    require(files, "path", "text")
    spark = files.sparkSession
    cfg, folder = cfg or LicenseConfig(), folder or shared_root(spark)
    known = sorted({t for _, _, ts in template_terms() for t in ts})
    literal = F.array(*[F.lit(t) for t in known])
    text = F.coalesce(F.col("text"), F.lit(""))

    # Lines that hold a term of a template, from one pass; only their terms of templates and their size are kept.
    lines = files.select("path", F.explode(F.split(text, "\n", -1)).alias("line"))
    told = lines.select("path", terms(F.col("line")).alias("ts")).select(
        "path", F.array_intersect("ts", literal).alias("hit"), F.size("ts").alias("n")
    )
    told = written(told.where(F.size("hit") > 0), folder, "lines")
    size = files.agg(F.count(F.lit(1)).alias("n_files"))
    df = told.select("path", F.explode("hit").alias("t")).distinct().groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    all_terms = spark.createDataFrame([(t,) for t in known], "t string")
    idf = all_terms.join(df, "t", "left").crossJoin(size).select(
        "t", (F.log((1 + F.col("n_files")) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("w")
    )  # one row for each term of the templates
    idf = written(idf.coalesce(1), folder, "idf")
    table = {r.t: r.w for r in idf.collect()}  # as many as the templates have terms
    n_files = size.first()[0]
    other = F.log(F.lit((1 + n_files) / 2)) + 1

    weights = F.create_map(*[F.lit(x) for t, w in sorted(table.items()) for x in (t, float(w))])
    squares = F.aggregate("hit", F.lit(0.0), lambda s, t: s + F.element_at(weights, t) * F.element_at(weights, t))
    measured = told.withColumn("inner", squares).withColumn("whole", F.col("inner") + (F.col("n") - F.size("hit")) * other * other)
    # No template is nearer than the line's own part within the templates' terms.
    measured = measured.where(F.col("inner") >= cfg.least**2 * F.col("whole"))

    found = []
    for name, i, own in template_terms():
        norm = sum(table[t] ** 2 for t in own) ** 0.5
        dot = F.aggregate(
            F.array_intersect("hit", F.array(*[F.lit(t) for t in own])), F.lit(0.0),
            lambda s, t: s + F.element_at(weights, t) * F.element_at(weights, t),
        )
        found.append(F.struct((dot / (norm * F.sqrt("whole"))).alias("cosine"), F.lit(name).alias("license")))
    best = measured.select("path", F.explode(F.array(*found)).alias("f")).where(F.col("f.cosine") >= cfg.least)
    rank = F.struct(-F.col("f.cosine"), F.col("f.license"))
    return best.groupBy("path").agg(F.min_by("f", rank).alias("f")).select("path", "f.license", "f.cosine")


def directory(path: Column) -> Column:
    """Path without its last part; empty at the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(of: Column) -> Column:
    """The directory and all above it, down from the root: ``['', 'a', 'a/b']``."""
    parts = F.filter(F.split(of, "/"), lambda p: p != "")
    return F.concat(
        F.array(F.lit("")),
        F.transform(F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.array().cast("array<int>")),
                    lambda n: F.array_join(F.slice(parts, 1, n), "/")),
    )


def scan(files: DataFrame, cfg: LicenseConfig | None = None, folder: str | None = None) -> DataFrame:
    """``path``, ``license``, ``cosine``, ``source`` (``own``, ``inherited``, ``none``), ``from_dir`` for every row of ``files``.

    Files named LICENSE, COPYING or NOTICE (with any ending) speak for their directory; several in one are settled by
    the highest cosine, then the name. A null or empty path is a file at the root. Null and empty texts state nothing.
    Rows that repeat a path are all returned and share the best statement of that path. Other columns are ignored; an
    empty table gives an empty result.
    """
    require(files, "path", "text")
    folder = folder or shared_root(files.sparkSession)
    files = files.select(F.coalesce("path", F.lit("")).alias("path"), "text")
    said = written(statements(files, cfg, f"{folder}/statements"), folder, "said")
    speaks = said.where(F.col("path").rlike(LICENCE_FILES)).withColumn("dir", directory(F.col("path")))
    rank = F.struct(-F.col("cosine"), F.col("license"))
    speaks = speaks.groupBy("dir").agg(F.min_by(F.struct("license", "cosine"), rank).alias("l"))
    speaks = written(speaks, folder, "speaks")

    # Directories, not files, meet their ancestors.
    dirs = files.select(directory(F.col("path")).alias("dir")).distinct()
    above = dirs.select("dir", F.posexplode(ancestors(F.col("dir"))).alias("depth", "above"))
    near = above.join(speaks.withColumnRenamed("dir", "above"), "above").groupBy("dir").agg(
        F.max_by(F.struct("l.license", "l.cosine", F.col("above").alias("from_dir")), "depth").alias("h")
    )
    near = near.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = files.select("path", directory(F.col("path")).alias("dir"), F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int").alias("salt"))
    own = F.struct("license", "cosine").alias("o")
    out = placed.join(said.select("path", own), "path", "left").join(near, ["dir", "salt"], "left")
    return out.select(
        "path", F.coalesce("o.license", "h.license").alias("license"), F.coalesce("o.cosine", "h.cosine").alias("cosine"),
        F.when(F.col("o").isNotNull(), "own").when(F.col("h").isNotNull(), "inherited").otherwise("none").alias("source"),
        F.when(F.col("o").isNull(), F.col("h.from_dir")).alias("from_dir"),
    )
