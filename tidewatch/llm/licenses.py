"""Find known licences by the digest of the canonical text.

A text is put into canonical form (lower case, copyright lines out, spellings
made one, everything but letters and digits to single spaces) and its SHA-256 is
joined with the digests of known licences, put into the same form. The unit is a
whole text: either a document or one line of it, never a part of a line.

Null and empty texts have the digest of the empty text and no licence; so has a
text of copyright lines alone. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import text_udf
from tidewatch.llm.wordings import wordings

#: Spellings that mean the same, as (pattern, put instead).
SPELLINGS = (
    ("licence", "license"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("cancelled", "canceled"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("programme", "program"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("per cent", "percent"),
    ("whilst", "while"),
)
#: Fixed value: lines that may name a right holder, in lower case, behind marks of comments or lists.
COPYRIGHT_LINE = r"(?m)^[ \t/*#;%!|>.<\"'-]*((?:portions[ \t]+)?copyright\b|\(c\)|©)([^\n]*)$"
#: Fixed value: what may follow such a line and belongs to it, on the next line with words.
RESERVED = r"(?:\n[^\w\n]*)+(?:[^\n]{0,80}?[^\w\n])?all rights reserved[^\w\n]*$"
#: Fixed value: what names a holder behind the word, whatever follows.
NAMED = r"[ \t:]*(?:\(c\)|©|&copy;|[0-9]{4}|[\[{<(](?:yyyy|year|date)|(?:holders?|owners?)[ \t]*:)"
#: Words of sentences about copyright, which no holder's line has.
SENTENCE = frozenset(
    "a act agreement an any are as be been can claim claims disclaimer do does for from grant granted grants has have "
    "holder holders if in infringement infringements interest interests is it its law laws license licensed licenses "
    "licence licensed licences line lines material may means must no not notice notices obligations on or other owner "
    "owners ownership patent permission policy portions protected protection registration right rights shall should "
    "statement statements status subject such term terms that this to trademark treaties treaty under was were "
    "which who will with work works you your".split()
)
#: Words with which no holder's name begins.
NOT_FIRST = frozenset("also and by doctrines library like of program related resulting software the those".split())
#: Fixed value: a holder's line without a year or a sign has at most so many words.
HOLDER_WORDS = 12

#: Wordings of well-known public licences and of short notices.
KNOWN = (
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT notice", "Released under the MIT License."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0 notice", "This work is licensed under the GNU General Public License, version 2."),
)


_COPYRIGHT = re.compile(f"{COPYRIGHT_LINE}(?:{RESERVED})?")
_NAMED = re.compile(NAMED)
_LISTED = re.compile(r"[ \t]*(?:you must|under patent claims|the licen[sc]es|representations)\b")
_NAME_WORD = re.compile(r"[^\W_]+")
_WORD = re.compile(r"[^\W_]")
_NOT_WORD = re.compile(r"[\W_]+")


def _without_holder(found: re.Match) -> str:
    """Nothing if the line names a right holder, else the line: a sentence or an item ``(c)``."""
    lead, rest = found.group(1), found.group(2)
    if lead in ("(c)", "©"):
        return found.group() if lead == "(c)" and _LISTED.match(rest) else " "
    if _NAMED.match(rest):
        return " "
    names = _NAME_WORD.findall(rest.split("all rights reserved")[0])
    names = names[1:] if names[:1] == ["by"] else names
    named = names[1:2] if names[:1] == ["the"] else names[:1]
    holder = bool(named) and named[0] not in NOT_FIRST and len(names) <= HOLDER_WORDS and SENTENCE.isdisjoint(names)
    return " " if holder else found.group()


def canonical(text: str) -> str:
    """The form in which equal wordings are equal texts."""
    plain = text.lower()
    if "copyright" in plain or "(c)" in plain or "©" in plain:
        plain = _COPYRIGHT.sub(_without_holder, plain)
    plain = _NOT_WORD.sub(" ", plain).strip()
    for found, put in SPELLINGS:
        plain = plain.replace(found, put)
    return plain


def digest(text: str) -> str:
    return hashlib.sha256(canonical(text).encode()).hexdigest()


def _digests(texts: pa.Array) -> pa.Array:
    """Of the text, then of each of its lines; null for a line without a word."""
    rows = []
    for text in texts.to_pylist():
        lines = text.split("\n")
        found = [digest(line) if _WORD.search(line) else None for line in lines]
        rows.append([digest(text) if len(lines) > 1 or not found[0] else found[0], *found])
    return pa.array(rows, pa.list_(pa.string()))


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """Rows: license_id, license_digest. One id per digest, the first by code point.

    Of ``KNOWN`` and all of ``wordings`` if no list is given. A list in the program, so it is marked for broadcast; a table given to ``scan``
    is joined as its size asks for.
    """
    first: dict[str, str] = {}
    if known is None:
        known = set(wordings(KNOWN, canonical))
    for name, text in sorted(known, reverse=True):
        first[digest(text)] = name
    rows = [(name, key) for key, name in first.items()]
    return F.broadcast(spark.createDataFrame(rows, "license_id string, license_digest string"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rows doc_id, line, digest, license_id.

    One row per document with ``line`` 0 and a licence or null, and one row for
    each line, counted from 1, that is a known wording.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    digests = text_udf(_digests, "array<string>")(F.col("text"))
    each = docs.select("doc_id", F.posexplode(digests).alias("line", "digest"))
    each = each.where(F.col("digest").isNotNull())
    joined = each.join(known, F.col("digest") == F.col("license_digest"), "left")
    kept = joined.where((F.col("line") == 0) | F.col("license_id").isNotNull())
    return kept.select("doc_id", "line", "digest", "license_id")
