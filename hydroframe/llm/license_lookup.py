"""Licence scan by canonical digest lookup (operator 2).

A text is brought to a canonical form: letters lower-cased, copyright lines removed, every run
of anything but letters and digits made one blank, equivalent spellings made one. The SHA-256
of the canonical form of an entire text is joined by hash with the digests of known licence
texts. A line that is as a whole a known notice is looked up in the same way and reported
beside it. The known texts are ``LICENCE_TEXTS``, those of ``LICENCE_DIGESTS`` and the caller's own;
their table follows no input, so it is broadcast; documents are never shuffled.

Edge cases: a null text counts as empty, which matches nothing; a text of copyright lines only
is empty too; texts of any length are hashed whole; of licences with one canonical text the first
by name counts; columns of any other name do not matter; repeated rows are separate rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroframe.llm.common import text_or_empty

# Published licence texts and notices.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
of the Software, and to permit persons to whom the Software is furnished to do so"""
_MIT_TERMS = """The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted"""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
LICENCE_TEXTS: dict[str, list[str]] = {
    "MIT": [*(f"{title}\n{_MIT_GRANT}, subject to the following conditions:\n{_MIT_TERMS}\n{_MIT_WARRANTY}"
              for title in ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)")),
            f"{_MIT_GRANT}, subject to the following conditions:\n{_MIT_TERMS}\n{_MIT_WARRANTY}",
            "Released under the MIT License.", "Licensed under the MIT License."],
    "MIT-0": [f"MIT No Attribution\n{_MIT_GRANT}.\n{_MIT_WARRANTY}", f"{_MIT_GRANT}.\n{_MIT_WARRANTY}"],
    "ISC": [f"ISC License\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear "
            f"in all copies.\n{_ISC_WARRANTY}",
            f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all "
            f"copies.\n{_ISC_WARRANTY}"],
    "0BSD": [f"BSD Zero Clause License\n{_ISC_GRANT}.\n{_ISC_WARRANTY}", f"{_ISC_GRANT}.\n{_ISC_WARRANTY}"],
    "BSD-2-Clause": [f"BSD 2-Clause License\n{_BSD_GRANT}\n{_BSD_WARRANTY}", f"{_BSD_GRANT}\n{_BSD_WARRANTY}"],
    "BSD-3-Clause": [f"BSD 3-Clause License\n{_BSD_GRANT}\n{_BSD_ENDORSE}\n{_BSD_WARRANTY}",
                     f"{_BSD_GRANT}\n{_BSD_ENDORSE}\n{_BSD_WARRANTY}"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\")."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."],
}
# Digests of the canonical forms of published full texts.
LICENCE_DIGESTS: dict[str, str] = {
    "Apache-2.0": "04e64e0427d80fdde16fa8415931bf2c09bc943f13ec322a09df188bf23a3543",
    "Artistic-1.0-Perl": "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",
    "BSD-3-Clause": "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651",
    "CC0-1.0": "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e",
    "GFDL-1.2": "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b",
    "GFDL-1.3": "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d",
    "GPL-1.0": "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224",
    "GPL-2.0": "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
    "GPL-3.0": "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
    "LGPL-2.0": "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
    "LGPL-2.1": "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "b4fb601cd1d708fd4d48958cfaecb8bb919d60af95b4704afb85d1a886f8b303",
    "MPL-2.0": "12274540925f246f7614a52b7ebddfbe0463ff1ab194088c554c73552c45582d",
}
# Lines that only name a right holder, and spellings that count as the same word.
COPYRIGHT_LINE = (r"^[ \t#*/;-]*((copyright|COPYRIGHT|Copyright)[ \t ]*(\([cC]\)|©|[0-9][0-9][0-9][0-9]|<|\[|by )"
                  r"|(Copyright|COPYRIGHT)[ \t ]+[A-Z][^\n.;:]*,[ \t ]*[0-9][0-9][0-9][0-9](-[0-9][0-9][0-9][0-9])?\.?[ \t]*$"
                  r"|\([cC]\)[ \t]*[0-9][0-9][0-9][0-9]|©|[aA]ll [rR]ights [rR]eserved)[^\n]*$")
SPELLINGS = [(r"\b(sub)?licenc(e|ed|es|ees?|ing|or)\b", r"\1licens\2"), (r"\bsub licens", "sublicens"),
             (r"\bnon infring", "noninfring"), (r"\b(fav|behavi|hon|lab|col)our", r"\1or"),
             (r"\b(organ|author|util|recogn|min?im)is(e|ed|es|ing|ation|ations)\b", r"\1iz\2"),
             (r"\backnowledgement", "acknowledgment"), (r"\bcopyright owner", "copyright holder"),
             (r"\bwhilst\b", "while"), (r"\bhttps\b", "http")]
START = "[A-Za-z0-9][A-Za-z0-9]?"  # the first letters of a line, which no spelling changes


def canonical(text: Column) -> Column:
    out = F.regexp_replace(text, "(?md)" + COPYRIGHT_LINE, "")
    out = F.translate(out, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))
    for pattern, spelling in SPELLINGS:
        out = F.regexp_replace(out, pattern, spelling.replace("\\", "$"))
    return out


def _known_texts(spark: SparkSession, licences: DataFrame | None) -> DataFrame:
    """license_id and canonical form of the texts that are known as such."""
    rows = [(k, t) for k, texts in sorted(LICENCE_TEXTS.items()) for t in texts]
    whole = F.inline(F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(t).alias("t")) for k, t in rows]))
    texts = spark.range(1).select(whole).select("license_id", canonical(F.col("t")).alias("t"))
    if licences is not None:
        texts = texts.unionByName(licences.select("license_id", canonical(F.col("text")).alias("t")))
    return texts.where("license_id is not null and t != ''")


def known_starts(spark: SparkSession, licences: DataFrame | None = None) -> list[str]:
    """The first letters of all known texts: at most 36 * 37 pairs of letters and digits.

    The texts known by digest only are full licences of many lines; no single line is one of them
    but for a text without line feeds, which is looked up as an entire text.
    """
    starts = _known_texts(spark, licences).select(F.lower(F.regexp_extract("t", START, 0)).alias("s"))
    return sorted(r["s"] for r in starts.distinct().collect())


def known_digests(spark: SparkSession, licences: DataFrame | None = None) -> DataFrame:
    """license_id and canonical digest of every known text, and of ``licences`` (license_id, text)."""
    digests = _known_texts(spark, licences).select("license_id", F.sha2("t", 256).alias("digest"))
    full = F.inline(F.array(*[F.struct(F.lit(k).alias("license_id"), F.lit(d).alias("digest"))
                              for k, d in LICENCE_DIGESTS.items()]))
    return (digests.unionByName(spark.range(1).select(full))
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan_licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  licences: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, canonical_sha256, license_id, notice_ids.

    license_id names the licence that the entire text is (null if none); notice_ids lists the
    licences, by name and joined by commas, whose notice is a whole line of it. ``licences``
    (license_id, text) are known beside the shipped ones.
    """
    known = known_digests(docs.sparkSession, licences)
    table = F.create_map(*[F.lit(x) for r in known.collect() for x in (r["digest"], r["license_id"])])
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    # A line can be a known text only if it starts as one does; other lines need no digest.
    starts = F.array(*[F.lit(x) for x in known_starts(docs.sparkSession, licences)])
    lines = F.filter(F.split("text", "\n"), lambda x: F.array_contains(starts, F.lower(F.regexp_extract(x, START, 0))))
    found = F.transform(lines, lambda x: F.try_element_at(table, F.sha2(canonical(x), 256)))
    notices = F.array_join(F.array_sort(F.array_distinct(F.array_compact(found))), ",")
    scanned = own.select("doc_id", F.sha2(canonical(F.col("text")), 256).alias("canonical_sha256"), notices.alias("notice_ids"))
    return (scanned.join(F.broadcast(known.withColumnRenamed("digest", "canonical_sha256")), "canonical_sha256", "left")
            .select("doc_id", "canonical_sha256", "license_id", "notice_ids"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(expr: str) -> str:
    out = f"regexp_replace({expr}, {_sql_text('(?m)' + COPYRIGHT_LINE)}, '', 'g')"
    out = f"translate({out}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"
    for pattern, spelling in SPELLINGS:
        out = f"regexp_replace({out}, {_sql_text(pattern)}, {_sql_text(spelling)}, 'g')"
    return out


def oracle() -> str:
    texts = ", ".join(f"({_sql_text(k)}, {_sql_text(t)})" for k, ts in sorted(LICENCE_TEXTS.items()) for t in ts)
    digests = ", ".join(f"({_sql_text(k)}, {_sql_text(d)})" for k, d in LICENCE_DIGESTS.items())
    return f"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id
  FROM (SELECT license_id, sha256({_canonical_sql('t')}) AS digest FROM (VALUES {texts}) v(license_id, t)
    UNION ALL SELECT * FROM (VALUES {digests}) w(license_id, digest)) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
notices AS (
  SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids
  FROM lines JOIN known ON digest = sha256({_canonical_sql('line')}) GROUP BY r)
SELECT doc_id, sha256({_canonical_sql('text')}) AS canonical_sha256, license_id, coalesce(ids, '') AS notice_ids
FROM d LEFT JOIN notices USING (r) LEFT JOIN known ON digest = sha256({_canonical_sql('text')})
"""
