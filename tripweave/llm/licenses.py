"""Licence scan: canonical forms of texts, looked up by digest among known ones."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Known licences, beyond which they are joined by a shuffle instead of a copy to each executor.
BROADCAST_KNOWN = 100_000

# Spellings that count as one, as words of a text in lower case without punctuation.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
}

# Names of licences and usual notices that stand for them.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
)

# Short licences in full.
MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear
in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""
TEXTS = (("MIT", MIT), ("MIT", "MIT License\n" + MIT), ("ISC", ISC), ("ISC", "ISC License\n" + ISC))

# A line that names who holds the copyright, in lower case: it begins with the word,
# but not as part of "copyright notice" and the like, or with a sign for it.
_HOLDER = re.compile(
    r"(?:[^\w]|_)*(?:copyright\b(?!\s+(?:notice|holder|owner|law|licen[cs]e))|\(c\).*[0-9]{4}|©)"
)
# Words that a title line has at most.
TITLE_WORDS = 4
_WORD = re.compile(r"[^\W_]+")
_ENDS = re.compile(r"(?<=[.!?])\s+")


def canonical_words(text: str) -> list[str]:
    """Words of letters and digits in lower case; equivalent spellings are one.

    Lines that name the holder of the copyright don't count, nor does a title:
    the first line, if others follow, when it has at most four words and one of
    them is licence or license.
    """
    lines = [_WORD.findall(line) for line in text.lower().split("\n") if not _HOLDER.match(line)]
    lines = [words for words in lines if words]
    if len(lines) > 1 and is_title(lines[0]):
        lines = lines[1:]
    return [SPELLINGS.get(word, word) for words in lines for word in words]


def is_title(words: list[str]) -> bool:
    return len(words) <= TITLE_WORDS and ("license" in words or "licence" in words)


def digest(words: list[str]) -> bytes:
    return hashlib.sha256(" ".join(words).encode()).digest()


def units(text: str) -> Iterator[tuple[str, str]]:
    """The whole text, its lines if there are several, and the sentences of lines that hold several."""
    yield "text", text
    lines = text.split("\n")
    for line in lines:
        if len(lines) > 1:
            yield "line", line
        sentences = _ENDS.split(line.strip(" "))
        if len(sentences) > 1:
            for sentence in sentences:
                yield "sentence", sentence


def begins(text: str) -> str:
    """The first two letters of a text's first word, which no spelling changes; of holders' lines none."""
    found = _WORD.search(text)
    return found[0][:2].lower() if found else ""


def known_licenses(spark: SparkSession) -> DataFrame:
    """The licences above: license_id, text."""
    return spark.createDataFrame([*NOTICES, *TEXTS], "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Texts, or lines or sentences of them, that are known licences as a whole.

    `docs` has doc_id and text, `known` license_id and text. The whole text,
    each line and each sentence of a line are units; a unit's canonical form
    is hashed and joined to the known ones' digests. Returns doc_id, unit
    ("text", "line" or "sentence"), license_id and n_found, the number of such
    units; a line that is one sentence counts as a line only, a text of one
    line as a text only. Units without a letter or digit, and null texts,
    match nothing; nor do known texts without an id. Rows that share a doc_id
    are counted together; a null doc_id is an id of its own.
    """
    wanted = known.where("license_id is not null and text is not null").select("license_id", "text")
    wanted = wanted.mapInArrow(_known_rows, "license_id string, start string, digest binary").distinct()
    starts = {row.start for row in wanted.select("start").distinct().collect()}
    found = docs.select("doc_id", "text").where("text is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = found.mapInArrow(_unit_rows(starts), f"doc_id {kind}, unit string, digest binary")
    wanted = wanted.drop("start").distinct()
    if wanted.limit(BROADCAST_KNOWN + 1).count() <= BROADCAST_KNOWN:
        wanted = F.broadcast(wanted)
    return found.join(wanted, "digest").groupBy("doc_id", "unit", "license_id").agg(F.count("*").alias("n_found"))


def _known_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(name, canonical_words(text)) for name, text in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
        rows = [(name, words[0][:2], digest(words)) for name, words in rows if words]
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        kinds = (pa.string(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["license_id", "start", "digest"]
        )


def _unit_rows(starts: set[str]):
    """Digests of units that begin like a known text; at most 1,296 beginnings of ASCII texts are told apart."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, names, digests = [], [], []
            for i, text in enumerate(batch.column(1)):
                for unit, part in units(text.as_py()):
                    low = part[:0] if unit != "text" else part.lower()
                    held = "copyright" in low or "(c)" in low or "©" in low or "licen" in low[:100]
                    if not held and begins(part) not in starts:
                        continue
                    words = canonical_words(part)
                    if words:
                        at.append(i)
                        names.append(unit)
                        digests.append(digest(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(names, pa.string()), pa.array(digests, pa.binary())],
                names=["doc_id", "unit", "digest"],
            )

    return rows
