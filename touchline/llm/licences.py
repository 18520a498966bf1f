"""Licence scans by canonical digest.

Texts are brought to a canonical form (case, punctuation, copyright lines, equivalent spellings, white
space) and hashed whole; a join with the digests of known texts names the licence. Nothing is
searched for inside a text, so a text that only mentions a licence isn't taken for it. What is looked
up are whole documents, their lines, and runs of consecutive paragraphs as long as a known text is: so a
text of many paragraphs is found under a title or inside a longer document, too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import table
from touchline.session import materialise

# Notices as licences are announced, by the names of the SPDX list.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
]

_BSD_INTRO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
NOTICES += [
    ("BSD-2-Clause", _BSD_INTRO + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_INTRO + _BSD_NAMES + _BSD_DISCLAIMER),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\n"
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions:\n\n"
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required.\n\n"
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software.\n\n"
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.\n\n"
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
        "copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
        "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\n"
        "For more information, please refer to <https://unlicense.org>",
    ),
]

# Long texts as published, by the digest of the whole, the number of paragraphs, and the digest
# of these as a run (see :func:`text_digests`, which makes them of a text).
LONG_TEXTS = [
    ("Apache-2.0", "ba8795096814c631163b2377beebcd96", 32, "fd0a62421bbe3dcd5495d5ab10f5619a"),
    ("GPL-1.0", "ade87a78bf014a58871d850eee2cea43", 50, "ecd3b6d3254905e0b221f5aaec01d8f7"),
    ("GPL-2.0", "332aa40eb02242827361318229c4f06d", 59, "90b384ad9b448ab09a9f7cf9664e7bcd"),
    ("GPL-3.0", "ab429b72139abbff57a42cd1e05317ba", 122, "4b2e99da5e05c78d443e5da239260e68"),
    ("LGPL-2.0", "ad9522f5181431766c538e508576eb68", 83, "c5411093d9c69b746d8fef7fa50d884d"),
    ("LGPL-2.1", "f6852ce197667e27deb326bd43292466", 85, "9c6deb0cdaffbe82a7ff7665f81a31a5"),
    ("LGPL-3.0", "8b0d0e66b98cf8b4c370b34e014ab55a", 37, "fce50f1f1407dc08e745012f2fa0c95f"),
    ("MPL-1.1", "5bf0f1ab374ef0ff3b09349ed2b2a615", 73, "72781f83c55a650304685b8b05e52ab8"),
    ("MPL-2.0", "ec478cba5e9cddce82a533236ad5ab8f", 83, "c8f85b9186f3bd26e079ca070d7b9f08"),
    ("CC0-1.0", "feb3934e97f1f0bb2227716d4a8fcae9", 13, "78b6df077b765cb828f0ed8907ffefc9"),
    ("Artistic-1.0-Perl", "950033aba005da7eb577cc43ea58c059", 29, "44bb19544aa57fc43c060451093111ff"),
    ("GFDL-1.2", "2571d6a6ff1344bb41cc7fb8ed65e40e", 57, "3699606dcb35f4f3e084b7a4d0661c16"),
    ("GFDL-1.3", "e4ecbdacbe42c732a255caf126137243", 67, "a9f5574894ca01dec53d743231efd726"),
]

# Spellings that mean the same, applied in this order to lower-cased text.
SPELLINGS = [
    (r"https?://", ""),
    (r"©|\(c\)|&copy;", "copyright"),
    (r"\blicence", "license"),
    (r"\bsub-licen[cs]e", "sublicense"),
    (r"\bnon-?commercial\b", "nc"),
    (r"\bversion\b|\bv\.\s", " "),
    (r"\bcreative commons\b", "cc"),
    (r"\battribution\b", "by"),
    (r"\bmerchantibility\b", "merchantability"),
    (r"&", " and "),
    (r"\band/or\b", "and or"),
]


# A line that names holders: with a sign or a year, so that prose whose line begins with the word stays.
# Only \n ends a line.
COPYRIGHT_LINE = (
    r"(?md)^[^\p{L}\p{N}\n]*(?:copyright[^\p{L}\p{N}\n]+(?:copyright|by)\b|copyright\b[^\n]*(?:[0-9]{4}|\byear\b|\byyyy\b)"
    r"|all rights reserved\b)[^\n]*"
)


def canonical(text: Column) -> Column:
    """The canonical form of a text, line by line: copyright lines are empty, words single-spaced."""
    form = F.lower(text)
    for pattern, instead in SPELLINGS:
        form = F.regexp_replace(form, pattern, instead)
    form = F.regexp_replace(form, COPYRIGHT_LINE, "")
    return F.regexp_replace(form, r"[^\p{L}\p{N}\n]+", " ")


def _joined(lines: Column) -> Column:
    """Canonical lines as one text without line ends, or null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(lines, r"\s+", " ")), F.lit(""))


def _paragraphs(form: Column) -> Column:
    """The digests of a canonical text's paragraphs."""
    joined = F.transform(F.split(form, r"\n\s*\n"), _joined)
    return F.transform(F.filter(joined, lambda x: x.isNotNull()), lambda x: F.md5(x.cast("binary")))


def _run_digest(paragraphs: Column) -> Column:
    return F.md5(F.array_join(paragraphs, "").cast("binary"))


def text_digests(texts: DataFrame) -> DataFrame:
    """(license, digest, n_paragraphs, run) of known texts (license, text)."""
    forms = texts.select("license", canonical(F.col("text")).alias("form"))
    parts = forms.select("license", F.md5(_joined(F.col("form")).cast("binary")).alias("digest"), _paragraphs(F.col("form")).alias("p"))
    return parts.select("license", "digest", F.size("p").alias("n_paragraphs"), _run_digest(F.col("p")).alias("run"))


def known_digests(
    spark: SparkSession,
    texts: Sequence[tuple[str, str]] = NOTICES,
    digests: Sequence[tuple[str, str, int, str]] = LONG_TEXTS,
) -> DataFrame:
    """license, digest, n_paragraphs, run: one row for each known text, given as such or by its digests."""
    known = text_digests(spark.createDataFrame(list(texts), "license string, text string"))
    more = spark.createDataFrame(list(digests), "license string, digest string, n_paragraphs int, run string")
    return known.unionByName(more).distinct()


def _units(form: Column, paragraphs: Column, lengths: Sequence[int]) -> Column:
    """Whole text, lines and runs of as many paragraphs as ``lengths`` has, as (kind, digest)."""
    at = lambda kind, digest: F.struct(F.lit(kind).alias("kind"), digest.alias("digest"))
    text = lambda kind: lambda x: at(kind, F.md5(_joined(x).cast("binary")))

    def runs(length: int) -> Column:
        places = F.when(F.size(paragraphs) >= length, F.sequence(F.lit(1), F.size(paragraphs) - length + 1))
        some = F.transform(places, lambda i: at("paragraph", _run_digest(F.slice(paragraphs, i, F.lit(length)))))
        return F.coalesce(some, F.array().cast("array<struct<kind: string, digest: string>>"))

    kinds = [F.array(text("document")(form)), F.transform(F.split(form, r"\n"), text("line")), *map(runs, lengths)]
    return F.filter(F.concat(*kinds), lambda x: x["digest"].isNotNull())


def find_licences(df: DataFrame, known: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` columns, place, kind, license: a row for each unit of a text that is a known licence text.

    The driver asks ``known`` for the different numbers of paragraphs of its texts, a few dozen.
    """
    known = materialise(known, "licence-digests")
    lengths = sorted(r.n_paragraphs for r in known.select("n_paragraphs").distinct().collect() if r.n_paragraphs)
    either = known.select(
        "license",
        F.inline(
            F.array(
                F.struct(F.lit(False).alias("is_run"), F.col("digest")),
                F.struct(F.lit(True).alias("is_run"), F.col("run").alias("digest")),
            )
        ),
    ).distinct()
    # Each step is a column of its own and used several times, so it is worked out once.
    forms = df.select(F.struct(*[F.col(c) for c in keep]).alias("_kept"), canonical(F.col(text)).alias("_form"))
    parts = forms.select("_kept", "_form", _paragraphs(F.col("_form")).alias("_paragraphs"))
    each = _units(F.col("_form"), F.col("_paragraphs"), lengths)
    units = parts.select("_kept", F.posexplode(each).alias("place", "_unit"))
    found = units.select("_kept", "place", "_unit.kind", "_unit.digest", (F.col("_unit.kind") == "paragraph").alias("is_run"))
    return found.join(either, ["digest", "is_run"]).select("_kept.*", "place", "kind", "license")


def scan(df: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``key`` (as doc_id) with ``licenses`` (names in order, joined by commas; empty if
    none), ``n_lines`` (lines that are a licence text) and ``whole`` (the whole text is one).

    Null and empty texts have no licence; equal rows get equal results. A long text is brought to its form
    whole, as one value of a row, so it may be as long as Spark's strings (2 GB) and needs some multiples of
    its size. Matches are found by key and text together, so a key that is repeated with another text
    doesn't mix. They are written out, so that the join back is planned by their true size.
    """
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = df.select(F.col(key).alias("doc_id"), digest.alias("digest_of"), F.col(text).alias("text"))
    found = find_licences(rows, known, ["doc_id", "digest_of"]).distinct()
    matches = materialise(
        found.groupBy(F.col("doc_id").alias("_id"), F.col("digest_of").alias("_of")).agg(
            F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
            F.count_if(F.col("kind") == "line").alias("n_lines"),
            F.max(F.col("kind") == "document").alias("whole"),
        ),
        "licences",
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest_of") == F.col("_of"))
    return (
        rows.select("doc_id", "digest_of")
        .join(matches, same, "left")
        .select(
            "doc_id",
            F.coalesce("licenses", F.lit("")).alias("licenses"),
            F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce("whole", F.lit(False)).alias("whole"),
        )
    )


def op7_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that all documents carry as a line, a run of paragraphs or their whole text."""
    return scan(table(spark, sf_dir, "documents"), known_digests(spark))
