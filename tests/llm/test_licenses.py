import re
from importlib import resources

import pytest

from tidewatch.llm import licenses, wordings

MIT = dict(licenses.KNOWN)["MIT"]


def test_equal_wordings_have_one_digest():
    other = "Copyright (c) 2020 Somebody\n\n" + MIT.upper().replace(" ", "\n  ").replace(",", " ,")
    assert licenses.digest(other) == licenses.digest(MIT)
    assert licenses.digest("This LICENCE, per cent") == licenses.digest("this license percent")
    assert licenses.digest(MIT + " not") != licenses.digest(MIT)


def test_whole_texts_and_whole_lines(spark):
    notice = "Released under the MIT License."
    rows = [(1, MIT), (2, f"prose\n{notice.lower()}\n\nmore"), (3, f"prose {notice}"), (4, notice), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.line): r.license_id for r in licenses.scan(docs).collect()}
    assert found == {
        (1, 0): "MIT", (2, 0): None, (2, 2): "MIT notice", (3, 0): None,
        (4, 0): "MIT notice", (4, 1): "MIT notice", (5, 0): None, (6, 0): None,
    }


def test_odd_rows(odd_docs, no_docs):
    assert licenses.scan(odd_docs).where("line = 0").count() == odd_docs.count()
    assert licenses.scan(no_docs).isEmpty()


def test_a_table_of_licences_can_be_given(spark):
    known = spark.createDataFrame([("mine", licenses.digest("my text"))], "license_id string, license_digest string")
    docs = spark.createDataFrame([(1, "My, text!")], "doc_id long, text string")
    assert licenses.scan(docs, known).where("line = 0").first().license_id == "mine"


BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED.  IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""
PUBLISHED = {
    "MIT": "MIT License\n\nCopyright (c) 2020 X\n\n{}",
    "ISC": "The ISC License\n\nCopyright (c) 2020, X\n\n{}",
    "0BSD": "Zero-Clause BSD\n\n{}",
}


def test_licences_as_published(spark):
    folder = resources.files("tidewatch.llm") / "license_texts"
    files = {key: (folder / f"{key}.txt").read_text("utf-8") for key in wordings.FILES}
    rows = [(key, text) for key, text in files.items()]
    rows += [(key, form.format(dict(licenses.KNOWN)[key])) for key, form in PUBLISHED.items()]
    rows.append(("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, X\n\n" + BSD3))
    # The forms in which they are met: no title, no appendix, another address, another scheme.
    rows.append(("Apache-2.0", files["Apache-2.0"].split("   APPENDIX")[0].replace("http:", "https:")))
    rows.append(("GPL-2.0", files["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")))
    rows.append(("GPL-3.0", files["GPL-3.0"].replace("https:", "http:").split("How to Apply")[0]))
    rows.append(("MPL-2.0", files["MPL-2.0"].split("==\n", 1)[1]))
    notice = files["Apache-2.0"][files["Apache-2.0"].index("   Licensed under the") :]
    rows += [("Apache-2.0 notice", notice), ("MPL-2.0 notice", "SPDX-License-Identifier: MPL-2.0")]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.license_id for r in licenses.scan(docs).where("line = 0").collect()}
    assert [(key, found[i]) for i, (key, _) in enumerate(rows)] == [(key, key) for key, _ in rows]


def test_forms_are_canonical_and_mean_one_licence():
    forms = set(wordings.wordings(licenses.KNOWN, licenses.canonical)) - set(licenses.KNOWN)
    assert all(licenses.canonical(text) == text and text for _, text in forms)
    ids: dict[str, set] = {}
    for key, text in forms:
        ids.setdefault(text, set()).add(key)
    assert not {text: found for text, found in ids.items() if len(found) > 1}


@pytest.mark.parametrize(
    "head",
    [
        "Copyright Jane Doe 2020", "Copyright the X Authors", "Copyright The Regents of the University of X. All rights reserved.",
        "Copyright holder: Jane Doe", "Copyright: Jane Doe <jane@x.org>", "Copyright by Jane Doe", "// Copyright (c) 2020 X",
        " * Copyright (c) 2020 X\n * All rights reserved.", "# Copyright Jane Doe\n#\n# All Rights Reserved", "Copyright (c) 2020 X\n\nAll rights reserved.",
        "Copyright (c) 1989, 1993\n\tThe Regents of X.  All rights reserved.", "Copyright [yyyy] [name of copyright owner]", "Copyright 2019\nCopyright Y and Z", "(c) the X Authors", "\u00a9 X",
    ],
)
def test_header_lines_are_no_part_of_a_wording(head):
    assert licenses.digest(f"{head}\n\n{MIT}") == licenses.digest(MIT)
    assert licenses.canonical(f"MIT License\n{head}\n{MIT}") == "mit license " + licenses.canonical(MIT)


def test_sentences_about_copyright_stay_however_they_are_wrapped():
    longest: dict[str, str] = {}
    for key, text in wordings.wordings(licenses.KNOWN, licenses.canonical):
        if (key, text) not in licenses.KNOWN and len(text) > len(longest.get(key, "")):
            longest[key] = text
    for text in longest.values():
        found = text.split()
        for i, word in enumerate(found):
            if word == "copyright" and found[i + 1 : i + 2] not in (["c"], ["yyyy"], ["year"]):
                for n in range(1, 15):
                    parts = found[:i], found[i : i + n], found[i + n :]
                    assert licenses.canonical("\n".join(" ".join(p) for p in parts)) == text, parts[1]
    items = "(c) You must retain, in the Source form\n(c) under Patent Claims\nAll rights reserved."
    assert licenses.canonical(items) == "c you must retain in the source form c under patent claims all rights reserved"


def test_a_rewrapped_text_has_the_same_digest():
    text = (resources.files("tidewatch.llm") / "license_texts" / "Apache-2.0.txt").read_text("utf-8")
    body = text[text.index("TERMS AND") : text.index("APPENDIX")]
    assert licenses.digest(re.sub(r"(?<=\S)\n +(?=[a-z])", " ", body)) == licenses.digest(body)
