"""Licence scan by canonical digests.

A text and each of its lines are brought to a canonical form: lower case, copyright lines out,
everything but letters and digits one space, equivalent spellings made one. The SHA-256 of the form
is looked up in a hash join with the digests of known licences, so only entire texts match: a
document that is a licence, or a line that is a licence notice, and none that merely mentions one.

DataFrame code only. The known licences are a parameter, a list of texts; the default has the short permissive
licences whole, with and without their title, and common notices, not the long licences themselves. Their digests are broadcast if
they are at most ``FEW``. What is joined are digests, not texts, in place; hits alone are shuffled.

Defined cases: null and empty texts have no form and no hit; a notice that stands on several lines of
a document counts once; rows that repeat an id are one document; a null id keeps its hits under
null; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence texts and notices.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD_OPENING = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_CLOSING = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL_NOTICE = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
KNOWN: tuple[tuple[str, str], ...] = (
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", MIT),
    ("MIT", "MIT License " + MIT),
    ("MIT", "The MIT License (MIT) " + MIT),
    ("BSD-2-Clause", BSD_OPENING + BSD_CLOSING),
    ("BSD-2-Clause", "BSD 2-Clause License " + BSD_OPENING + BSD_CLOSING),
    ("BSD-3-Clause", BSD_OPENING + BSD_THIRD + BSD_CLOSING),
    ("BSD-3-Clause", "BSD 3-Clause License " + BSD_OPENING + BSD_THIRD + BSD_CLOSING),
    ("Apache-2.0", APACHE_NOTICE),
    ("GPL-3.0-or-later", GPL_NOTICE),
)
#: Known texts up to which their digests, 100 bytes each, are broadcast whatever Spark estimates.
FEW = 100_000

#: Patterns and what they become, in this order, on a text in lower case.
STEPS: tuple[tuple[str, str], ...] = (
    # A copyright line names a year or has the sign; "copyright notice ..." is text.
    (r"(?m)^[^\p{L}\p{N}\n]*(?:copyright[\x20\t]+(?:\(c\)|©|[0-9]{4})|\(c\)[\x20\t]*(?:copyright[\x20\t]+)?[0-9]{4}|©)[^\n]*$", " "),
    (r"[^\p{L}\p{N}]+", " "),
    (r"\blicenc", "licens"),
    (r"\blicensed work\b", "work"),
    (r"\b(?:v|ver|version) ?([0-9])", "version {1}"),
    (r"\b([0-9]+) 0\b", "{1}"),
    (r"\b(?:gnu )?gpl\b", "gnu general public license"),
    (r"\bcreative commons (?:attribution|by)\b", "cc by"),
    (r"\bnon ?commercial\b", "nc"),
)


def canonical(text: str) -> str:
    """SQL of the canonical form of an expression."""
    out = f"lower({text})"
    for pattern, to in STEPS:
        out = f"regexp_replace({out}, r'{pattern}', '{to.replace('{1}', '$1')}')"
    return f"trim({out})"


def known_digests(docs: DataFrame, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """(digest, license_id), by the same expressions as the texts."""
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("t")) for name, text in known]))
    listed = docs.sparkSession.range(1).select(rows.alias("k")).select("k.*")
    return listed.select(F.expr(f"sha2({canonical('t')}, 256)").alias("digest"), "license_id").distinct()


def license_scan(docs: DataFrame, id: str = "doc_id", text: str = "text",
                 known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """(id, license_id, whole: the entire text is that licence, n_lines: distinct lines that are)."""
    whole: Column = F.expr(f"named_struct('whole', true, 'digest', sha2({canonical('_text')}, 256))")
    lines: Column = F.expr(
        "transform(array_distinct(split(_text, '\n', -1)), "
        f"x -> named_struct('whole', false, 'digest', sha2({canonical('x')}, 256)))")
    units = docs.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("_text")).select(
        "id", F.explode(F.concat(F.array(whole), lines)).alias("u")).select("id", "u.*")
    digests = known_digests(docs, known)
    hits = units.join(F.broadcast(digests) if len(known) <= FEW else digests, "digest")
    return hits.groupBy("id", "license_id").agg(
        F.bool_or("whole").alias("whole"), F.countDistinct(F.when(~F.col("whole"), F.col("digest"))).alias("n_lines"))
