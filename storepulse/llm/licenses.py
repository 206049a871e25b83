"""Licence scan: sparse TF-IDF cosine to templates, then inheritance down the directory tree.

1. Document frequencies of the templates' terms are counted over all files. A
   term outside the templates weighs as one that no file has: it can only make a text less like
   a template.
2. Every line of a file, and every run of short lines (a notice set over several), is compared
   with the short notices; a licence file (by its name, or because a notice is all it says) is
   also compared as a whole with the longer texts. The best template at ``THRESHOLD`` or
   more is the file's own licence; a tie goes to the first template in code-point order.
3. The licence of a directory is that of its licence files (the highest score, then the
   first path). Every directory takes the licence of its nearest ancestor
   (itself included) that has one, by joining the ancestors of all distinct
   directories with the directories' licences; files without a licence of
   their own take their directory's.

Origin says where a licence comes from: ``header``, ``file``, ``inherited`` or ``none``.
Null text has no licence of its own but may inherit; a file with null path has no
directory and can't inherit. Repeated rows are separate files. Extra
columns pass through; result columns replace those of the same name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.common import staged

#: Production parameters.
THRESHOLD = 0.6
#: Lines up to this many characters may belong to a notice over several lines.
SHORT_LINE = 200

#: Notices by SPDX identifier, as projects put them into headers, and openings of licence files.
TEMPLATES: dict[str, list[str]] = {
    "0BSD": ["Licensed under the Zero-Clause BSD License.", "SPDX-License-Identifier: 0BSD"],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License v3.0.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law the author has waived all copyright: CC0 1.0 Universal."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License v2.0.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC"],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}

_TERM = re.compile(r"[a-z]+|\d+(?:\.\d+)*")
_MARKS = re.compile(r"^[\s/*#;%<!\-]+")
_LICENCE_NAME = re.compile(r"(?:^|/)(?:licen[cs]e|copying|unlicense)(?:[.-][^/]*)?$", re.I)
_RESULT = ("own_license", "score", "license", "origin", "license_path")


def terms(text: str) -> list[str]:
    """Lower-cased words and version numbers; ``3.0`` and ``3`` are one term."""
    return [t[:-2] if t.endswith(".0") else t for t in _TERM.findall(text.lower())]


VOCABULARY = sorted({t for texts in TEMPLATES.values() for x in texts for t in terms(x)})


class Templates:
    """TF-IDF vectors of unit length of all notices."""

    def __init__(self, frequency: dict[str, int], files: int):
        self.idf = {t: math.log((1 + files) / (1 + frequency.get(t, 0))) + 1 for t in VOCABULARY}
        self.other = math.log(1 + files) + 1
        self.vectors = []
        for name, texts in sorted(TEMPLATES.items()):
            for text in texts:
                weights = {t: n * self.idf[t] for t, n in Counter(terms(text)).items()}
                length = math.sqrt(sum(w * w for w in weights.values()))
                self.vectors.append((name, {t: w / length for t, w in weights.items()}))

    def best(self, text: str) -> tuple[str | None, float]:
        """(licence, cosine) of the most similar notice."""
        counts = Counter(terms(text))
        if sum(t in self.idf for t in counts) < 2:
            return None, 0.0
        weights = {t: n * self.idf.get(t, self.other) for t, n in counts.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        found, score = None, 0.0
        for name, vector in self.vectors:
            cosine = sum(w * weights[t] for t, w in vector.items() if t in weights) / length
            if cosine > score + 1e-12:
                found, score = name, cosine
        return found, min(1.0, score)


def segments(text: str) -> Iterator[str]:
    """Every line without comment marks, and every run of at least two short lines as one."""
    run: list[str] = []
    for line in [*text.split("\n"), None]:
        plain = _MARKS.sub("", line).strip() if line is not None else ""
        if plain:
            yield plain
        if plain and len(plain) <= SHORT_LINE:
            run.append(plain)
        else:
            if len(run) > 1:
                yield " ".join(run)
            run = []


def own_license(path: str | None, text: str | None, templates: Templates, threshold: float) -> tuple[str | None, float, bool]:
    """(licence or None, best cosine, whether this is a licence file)."""
    named = bool(path and _LICENCE_NAME.search(path))
    if not text:
        return None, 0.0, named
    name, score = max((templates.best(s) for s in segments(text)), key=lambda x: x[1], default=(None, 0.0))
    whole, whole_score = templates.best(text)
    if named and whole_score > score:
        name, score = whole, whole_score
    if score < threshold:
        return None, score, named
    return name, score, named or whole_score >= threshold


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary, counts, files = set(VOCABULARY), Counter(), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            files += 1
            counts.update(vocabulary.intersection(terms(text or "")))
    counts[""] = files
    yield pa.RecordBatch.from_pydict({"term": list(counts), "n": list(counts.values())})


def _own(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(*shared.value)
        for batch in batches:
            found = [
                own_license(path, text, templates, threshold)
                for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True)
            ]
            new = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*(c for c, n in zip(batch.columns, batch.schema.names) if n != "text"), *new],
                names=[*(n for n in batch.schema.names if n != "text"), "own_license", "score", "license_file"],
            )

    return run


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (path, text and others) without text, with own_license, score, license, origin and license_path."""
    spark = files.sparkSession
    rows = files.drop(*[c for c in files.columns if c.lower() in (*_RESULT, "license_file", "directory")])
    counted = rows.select("text").mapInArrow(_frequencies, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {r["term"]: r["n"] for r in counted.collect()}  # at most the vocabulary and one
    shared = spark.sparkContext.broadcast((frequency, frequency.get("", 0)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    found = rows.mapInArrow(_own(shared, threshold), f"{schema}, own_license string, score double, license_file boolean")
    found = staged(found.withColumn("directory", F.regexp_replace("path", "/?[^/]*$", "")), "license-files")

    sources = (
        found.filter("license_file and own_license is not null and directory is not null")
        .groupBy("directory").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "own_license")).alias("f"))
        .select(F.col("directory").alias("ancestor"), F.col("f.own_license").alias("inherited"), F.col("f.path").alias("from_path"))
    )
    parts = F.when(F.col("directory") == "", F.array().cast("array<string>")).otherwise(F.split("directory", "/"))
    ancestors = F.transform(F.sequence(F.lit(0), F.size("parts")), lambda k: F.concat_ws("/", F.slice("parts", 1, k)))
    directories = found.select("directory").filter("directory is not null").distinct().withColumn("parts", parts)
    nearest = (
        directories.select("directory", F.posexplode(ancestors).alias("depth", "ancestor"))
        .join(sources, "ancestor")
        .groupBy("directory").agg(F.max(F.struct("depth", "inherited", "from_path")).alias("f"))
        .select(F.col("directory").alias("d"), "f.inherited", "f.from_path")
    )
    own = F.col("own_license").isNotNull()
    return (
        found.join(nearest, F.col("directory") == F.col("d"), "left")
        .withColumn("license", F.coalesce("own_license", "inherited"))
        .withColumn("origin", F.when(own & F.col("license_file"), "file").when(own, "header")
                    .when(F.col("inherited").isNotNull(), "inherited").otherwise("none"))
        .withColumn("license_path", F.when(own, F.col("path")).otherwise(F.col("from_path")))
        .drop("directory", "license_file", "d", "inherited", "from_path")
    )


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source, hundreds of doc_id, doc_id."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(".txt"))
    folder = F.coalesce(F.expr("doc_id div 100").cast("string"), F.lit("-"))
    return docs.withColumn("path", F.concat_ws("/", F.coalesce("source", F.lit("-")), folder, name))
