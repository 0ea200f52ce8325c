"""Licence lookup by canonical digest.

A text is normalised (case, punctuation, blanks, copyright lines, equivalent spellings) and hashed; the digest is
joined with those of known licence texts and notices. Whole texts and single lines are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import contains_any, let
from hirelens.llm.common import store

# Public licence texts and notices.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE.")
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. ")
_ISC_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. ")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
    "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
    "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
    "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend "
    "this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
    "software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.")
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
    "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
    "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
    "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
    "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
    "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
    "distribution.")
KNOWN = [
    ("MIT", "MIT License " + _MIT_GRANT), ("MIT", "The MIT License (MIT) " + _MIT_GRANT), ("MIT", _MIT_GRANT),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("ISC", "ISC License " + _ISC_GRANT + _ISC_AS_IS), ("ISC", _ISC_GRANT + _ISC_AS_IS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted. " + _ISC_AS_IS),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_GRANT + _BSD_AS_IS), ("BSD-2-Clause", _BSD_GRANT + _BSD_AS_IS),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_GRANT + _BSD_NAMES + _BSD_AS_IS),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_AS_IS),
    ("Zlib", "zlib License " + _ZLIB), ("Zlib", _ZLIB),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Unlicense", _UNLICENSE), ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Steps in order: pattern and what stands in its place. A statement of copyright goes up to the end of its line, or up to
# the words a licence goes on with where a text has lost its lines; one without either goes up to its years. No step but
# the last takes a line end away.
_GOES_ON = "all rights reserved|permission|redistribution|licensed|released|this software|the software|this is free"
_COPYRIGHT = [
    (r"(copyright[ \t]*(?:\(c\)|©|[0-9]{4})|©[ \t]*[0-9]{4})[^\n]{0,200}?(\n|\z|" + _GOES_ON + ")", " $2"),
    (r"(copyright[ \t]*)?(?:\(c\)|©)[ \t]*[0-9]{4}([ \t]*[-,–][ \t]*[0-9]{4})*", " "),
]
_WORDS = [
    ("all rights reserved", " "),
    ("licence", "license"), ("sub-license", "sublicense"), ("non-infringement", "noninfringement"),
    ("favour", "favor"), ("organisation", "organization"),
]
_ADDRESS = ("https?://", "")
_SIGNS = [("&", " and "), ("and/or", "and or")]
_REST = (r"[^\p{L}\p{N}]+", " ")
STEPS = [*_COPYRIGHT, *_WORDS, _ADDRESS, *_SIGNS, _REST]
_SQL_STEPS = [(p, r.replace("$2", r"\2")) for p, r in STEPS]


def canonical_lines(text: Column) -> Column:
    """The text with every line normalised on its own, blanks at the ends of lines left; a null is empty.

    The steps end at line ends, so lines need no pass of their own. Fixed words are replaced without patterns, and the
    patterns read a text only where one of their words is.
    """

    def patterns(value: Column, steps: list[tuple[str, str]], marks: list[str]) -> Column:
        def changed(t: Column) -> Column:
            out = t
            for pattern, by in steps:
                out = F.regexp_replace(out, pattern, by)
            return F.when(contains_any(t, marks), out).otherwise(t)

        return let(value, changed)

    out = patterns(F.lower(F.coalesce(text, F.lit(""))), _COPYRIGHT, ["copyright", "©", "(c)"])
    for word, by in _WORDS:
        out = F.replace(out, F.lit(word), F.lit(by))
    out = patterns(out, [_ADDRESS], ["://"])
    for sign, by in _SIGNS:
        out = F.replace(out, F.lit(sign), F.lit(by))
    # the small letters stand for themselves and are found sooner than their class
    return F.regexp_replace(out, r"[^a-z0-9\n\p{L}\p{N}]+", " ")


def canonical(text: Column) -> Column:
    """The normalised text; a null is empty."""
    return F.trim(F.regexp_replace(canonical_lines(text), r"[ \n]*\n[ \n]*", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """digest and licence of each known text."""
    pairs = F.arrays_zip(F.lit([k for k, _ in known]).alias("licence"), F.lit([t for _, t in known]).alias("text"))
    rows = spark.range(1).select(F.explode(pairs).alias("x"))
    return rows.select(digest(F.col("x.text")).alias("digest"), "x.licence").dropDuplicates(["digest"])


def folder_digests(spark, path: str) -> DataFrame:
    """digest and licence of a folder of licence texts, one file each and named like its licence, such as the list of
    texts that many systems keep. Files of one canonical text are one row."""
    files = spark.read.text(path, wholetext=True).select(
        digest(F.col("value")).alias("digest"), F.regexp_extract("_metadata.file_name", r"^(.*?)(\.txt)?$", 1).alias("licence"))
    return files.groupBy("digest").agg(F.min("licence").alias("licence"))


def find_licences(docs: DataFrame, known: list[tuple[str, str]] = KNOWN, more: DataFrame | None = None) -> DataFrame:
    """``docs`` with digest, licence (of the whole text, or null) and notices (licences of single lines, in order).

    ``more`` are digests and licences besides the ``known`` texts, for instance of :func:`folder_digests`. A text that
    differs from all known ones by more than the canonical form, for instance by a clause of its own, is not found.

    A null or empty text has the digest of the empty text and no licence. Repeated rows are treated alike. Lines are
    told apart by text, so that the result of a text is worked out once and joined to all its copies.
    """
    kept = [c for c in docs.columns if c not in ("digest", "licence", "notices")]
    whole = known_digests(docs.sparkSession, known)
    if more is not None:
        whole = whole.union(more.select("digest", "licence")).groupBy("digest").agg(F.min("licence").alias("licence"))
    whole = store(whole, "known")  # its size on disk lets the optimizer broadcast it if it is small
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.xxhash64(F.lit(1), text).alias("__k1"), F.xxhash64(F.lit(2), text).alias("__k2")]
    # A known notice is a line without a copyright line, so a line is canonical by the same steps.
    lines = docs.select(*key, F.explode(F.array_distinct(F.split(canonical_lines(text), "\n"))).alias("line"))
    hits = lines.select("__k1", "__k2", F.sha2(F.trim("line"), 256).alias("digest")).join(whole, "digest")
    notices = store(hits.groupBy("__k1", "__k2").agg(F.array_sort(F.collect_set("licence")).alias("notices")), "notices")
    rows = docs.select(*kept, *key, digest(F.col("text")).alias("digest")).join(whole, "digest", "left")
    rows = rows.join(notices, ["__k1", "__k2"], "left")
    return rows.select(*kept, "digest", "licence", F.coalesce(
        "notices", F.expr("cast(array() as array<string>)")).alias("notices"))


def _sql_canonical(column: str) -> str:
    out = f"lower(coalesce({column}, ''))"
    for pattern, by in _SQL_STEPS:
        out = f"regexp_replace({out}, '{pattern}', '{by}', 'g')"
    return f"trim({out})"


def oracle() -> str:
    """DuckDB SQL for doc_id, digest, licence and notices (joined by commas)."""
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in KNOWN)
    return f"""
WITH known AS (SELECT sha256({_sql_canonical('t')}) AS digest, min(k) AS licence FROM (VALUES {values}) v(k, t) GROUP BY 1),
lines AS (SELECT DISTINCT doc_id, licence FROM
  (SELECT doc_id, sha256({_sql_canonical('line')}) AS digest
   FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)) l
  JOIN known USING (digest)),
notices AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS notices FROM lines GROUP BY doc_id)
SELECT d.doc_id, d.digest, k.licence, coalesce(n.notices, '') AS notices
FROM (SELECT doc_id, sha256({_sql_canonical('text')}) AS digest FROM documents) d
LEFT JOIN known k USING (digest) LEFT JOIN notices n ON n.doc_id = d.doc_id"""
