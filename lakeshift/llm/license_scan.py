"""Licence scan by canonical digest (operator 2), in DataFrame functions only.

A text is brought into a canonical form - one case, no copyright lines, one
spelling of equivalent words, no punctuation, single spaces - and the digest of
the whole of it is joined to the digests of known licence texts. Documents'
lines and paragraphs are looked up the same way, as whole texts of their own,
which finds licence notices inside documents. The known texts are a constant
of this module (a few dozen rows), so both joins broadcast them and no text is
shuffled. Only texts that contain one of a few words, of which every known text
contains one, are brought into canonical form; that filter loses nothing.

Defined results: null and empty texts match nothing; repeated rows get a row
each; a document with a null doc_id gets its row too; an empty table gives no
rows; texts of any length are looked at whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import Stage, table

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
)
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
_BSD_NAME = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_TAIL = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

#: Fixed values: (name, text) of known licences and of the notices that refer to one.
KNOWN = [
    ("MIT", "MIT License\n" + _GRANT + "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", "ISC License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _AS_IS),
    ("0BSD", "Zero-Clause BSD License\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _AS_IS),
    ("BSD-2-Clause", _BSD_HEAD + "1. " + _BSD_SOURCE + "2. " + _BSD_BINARY + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + "1. " + _BSD_SOURCE + "2. " + _BSD_BINARY + "3. " + _BSD_NAME + _BSD_TAIL),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
]

#: Spellings that count as one, applied to lower-case text.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("http://", "https://"),
    ("&", " and "),
]

#: Every known text has one of these; written as a pattern that Java and RE2 read alike.
TELLTALE = "(?i)licen[sc]|warrant|permission"
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[ \t]*(\(c\)|©|[0-9]{4}|<year>|\[yyyy\]|\[year\])[^\n]*$|(?m)^[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*$"
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(one))
    return F.trim(F.regexp_replace(out, NOT_A_WORD, " "))


def digest(text: Column) -> Column:
    """Digest of a text's canonical form; null where no known text can be meant."""
    return F.when(text.rlike(TELLTALE), F.sha2(canonical(text), 256))


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license): one row per distinct canonical text of KNOWN."""
    known = spark.createDataFrame(KNOWN, "license string, text string")
    return known.select(digest(F.col("text")).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, license, notices, n_notices): the licence that a document is, and those its lines or paragraphs name.

    ``notices`` has the names in order, joined by commas, and is empty without any.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "licenses")
    known = F.broadcast(known_digests(spark))  # at most one row for each entry of KNOWN
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    whole = stage.write(keyed.select("doc_id", "key", digest(F.col("text")).alias("digest")), "whole")
    marked = keyed.where(F.col("text").rlike(TELLTALE))
    units = marked.select("doc_id", "key", F.explode(F.concat(F.split("text", "\n"), F.filter(F.split("text", r"\n[ \t]*\n"), lambda p: p.contains("\n")))).alias("unit"))
    found = units.select("doc_id", "key", digest(F.col("unit")).alias("digest")).where(F.col("digest").isNotNull()).join(known, "digest")
    per_doc = found.groupBy("doc_id", "key").agg(F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("notices"), F.count_distinct("digest").cast("long").alias("n_notices"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "its_id", "key": "its_key"})
    named = whole.join(known, "digest", "left")
    out = named.join(per_doc, F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("key") == F.col("its_key")), "left")
    return out.select("doc_id", "license", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notices", F.lit(0)).alias("n_notices"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g')"
    for other, one in SPELLINGS:
        out = f"replace({out}, '{other}', '{one}')"
    return f"trim(regexp_replace({out}, '{NOT_A_WORD}', ' ', 'g'))"


def _digest_sql(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{TELLTALE}') THEN sha256({_canonical_sql(text)}) END"


ORACLE = f"""
WITH texts(license, text) AS (VALUES {", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in KNOWN)}),
known AS (SELECT {_digest_sql("text")} AS digest, min(license) AS license FROM texts GROUP BY 1),
units AS (
  SELECT doc_id, text, unnest(list_concat(string_split(text, chr(10)), list_filter(regexp_split_to_array(text, '\\n[ \\t]*\\n'), lambda p: contains(p, chr(10))))) AS unit
  FROM documents WHERE regexp_matches(text, '{TELLTALE}')
), found AS (
  SELECT DISTINCT doc_id, text, license, digest FROM (SELECT doc_id, text, {_digest_sql("unit")} AS digest FROM units) JOIN known USING (digest)
), per_doc AS (
  SELECT doc_id, text, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(DISTINCT digest) AS n_notices FROM found GROUP BY 1, 2
)
SELECT d.doc_id, k.license, coalesce(p.notices, '') AS notices, coalesce(p.n_notices, 0) AS n_notices
FROM documents d LEFT JOIN known k ON k.digest = {_digest_sql("d.text")}
LEFT JOIN per_doc p ON p.doc_id IS NOT DISTINCT FROM d.doc_id AND p.text = d.text
"""
