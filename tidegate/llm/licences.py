"""Licence scans by canonical digests.

A text is brought to a canonical form (lower case, equivalent spellings, no copyright lines, words
only) and looked up whole by its digest among known licence texts.  The texts looked up are the
document itself and each of its lines, since notices stand on lines of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Licences with notices and texts by which they are granted.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "Licensed under CC0 1.0"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("ISC", "Released under the ISC License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    (
        "MIT",
        "MIT License\nCopyright (c) year holder\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
        "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Copyright (c) year holder\nPermission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
        "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE.",
    ),
)
# Whole licence texts by the SHA-256 of their canonical form.
DIGESTS = (
    ("Apache-2.0", "b26da4ca484ac09b65fe4c8008336324f6146bd0137f20c4f3199115b4e35bc3"),
    ("Artistic-1.0-Perl", "748074a6b75acff75524019ae674bbe0673df584b124a5cd2b0db2ef4537f878"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "92f195ae84ff559b03177551e6c1166f57d3cc30f5a7d806b4039e24906bd8de"),
    ("GFDL-1.2", "ecc9d73d27981e1847fadde8b5fc33380c966b8303b54725c87da872354c90f8"),
    ("GFDL-1.3", "bd53691acec857a07852a20a4d9257e17f4ca9eb116e3f04a36c40d4116e29be"),
    ("GPL-1.0", "b4583e68db0c858fa1b9028c689e3bddd78f836f274e963327fa158ec729531d"),
    ("GPL-2.0", "8ceef37851021afc07e4d5138e4c1c58b285e876796ca1a6cfa5eaa9ffaea599"),
    ("GPL-3.0", "bc8bb69aa8f949d94a3db853dcd0b0d9d1eae303796d5c80cb9fd5c6dab3ce1e"),
    ("LGPL-2.0", "f917eb230a461b72c0d7845f5737ef74651abb0524547082a9645bc154d5ecd4"),
    ("LGPL-2.1", "06f44ebf9515e6c412985cf8f2c6b133e91f457a1f520a900164472a54c1dc58"),
    ("LGPL-3.0", "99c1a85dc9c673acfd6a330c4a68bd319185c3d6b8f4888157bf159e2ee60285"),
    ("MPL-1.1", "d176bfd3156f073d3283de58e1c5628ad6c9f102a669c3045d85a6562794e0cf"),
    ("MPL-2.0", "d967acc6ac57ac0410b353c5ae5266cdc1affe6b50883a3da362e3028c5c1f19"),
)
# Words that count as equal, as (found, put in its place).
EQUIVALENT = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("version", "v"),
    ("v2", "v 2"),
    ("v3", "v 3"),
    ("non commercial", "noncommercial"),
    ("share alike", "sharealike"),
    ("sub license", "sublicense"),
    ("merchantibility", "merchantability"),
    ("noninfringment", "noninfringement"),
    ("organisation", "organization"),
    ("authorised", "authorized"),
)
#: Lines that only say who holds the copyright, in lower case.
COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*$|^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
#: What is no part of a word.
BETWEEN = r"[^\p{L}\p{N}]+"
#: Known texts that are sent to all tasks; a longer list joins by shuffle.
BROADCAST_ROWS = 50_000


def _same_words(words: Column) -> Column:
    """Words made equal one by one: each stands between spaces of its own, so neighbours are no hindrance."""

    def apart(text: str) -> str:
        return f" {text.replace(' ', '  ')} "

    words = F.concat(F.lit(" "), F.replace(F.trim(words), F.lit(" "), F.lit("  ")), F.lit(" "))
    for found, put in EQUIVALENT:
        words = F.replace(words, F.lit(apart(found)), F.lit(apart(put)))
    return F.trim(F.replace(words, F.lit("  "), F.lit(" ")))


def without_copyright(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), COPYRIGHT, " ")


def canonical(lowered: Column) -> Column:
    """Words of a lower-case text joined by one space, words of equal meaning made equal."""
    return _same_words(F.regexp_replace(lowered, BETWEEN, " "))


def known_licences(spark: SparkSession) -> DataFrame:
    """The built-in list: ``licence`` with its ``text``, or the ``digest`` of its canonical form."""
    rows = [(name, text, None) for name, text in KNOWN] + [(name, None, digest) for name, digest in DIGESTS]
    return spark.createDataFrame(rows, "licence string, text string, digest string")


def find_licences(docs: DataFrame, known: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The kept columns as struct ``row``, with ``whole`` (licence of the entire text, NULL if none) and
    ``notices`` (array of (line, licence) of lines that are known texts as a whole, lines from 0).

    Texts are equal if their canonical forms are; an empty canonical form is none.  A form that
    several known licences share counts as the first of them by name.  ``known`` has ``licence`` and ``text``,
    or in its place the ``digest`` of its form.  NULL texts have no lines.  The
    forms are joined by digest; only those found travel on, keyed by a hash of the text, so copies of
    a text share them.  Other columns take no part.
    """
    empty = F.sha2(F.lit(""), 256)
    digest = F.sha2(canonical(without_copyright(F.col("text"))), 256)
    if "digest" in known.columns:
        digest = F.coalesce("digest", digest)
    found = (
        known.select("licence", digest.alias("digest"))
        .where(F.col("digest") != empty)
        .groupBy("digest")
        .agg(F.min("licence").alias("licence"))
    )
    lookup = F.broadcast(found) if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else found
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("text"))
    forms = keyed.select("key", F.posexplode(_forms(without_copyright(F.col("text")))).alias("place", "form"))
    digests = forms.where("form != ''").select("key", (F.col("place") - 1).alias("line"), F.sha2("form", 256).alias("digest"))
    hits = digests.join(lookup, "digest").groupBy("key").agg(F.collect_set(F.struct("line", "licence")).alias("hits"))
    joined = keyed.select("row", "key").join(hits, "key", "left")
    return joined.select(
        "row",
        F.get(F.filter("hits", lambda h: h["line"] == -1), F.lit(0))["licence"].alias("whole"),
        F.coalesce(F.array_sort(F.filter("hits", lambda h: h["line"] >= 0)), F.expr("array()").cast("array<struct<line: int, licence: string>>")).alias("notices"),
    )


def _forms(lowered: Column) -> Column:
    """Canonical forms of the entire text and then of each line."""
    return F.concat(F.array(canonical(lowered)), F.transform(F.split(lowered, "\n"), canonical))
