"""Wordings of public licences and of their standard notices, with the forms they are published in.

``license_texts`` has the texts as published; a licence may also come without its title or
its appendix, with another address of its publisher, or with ``http`` for ``https``. Each such
form is a wording of its own here. Forms with names filled in by the user of a licence (but for
copyright lines) cannot be listed.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator
from importlib import resources

#: Per file, where the text may begin and where it may end, as canonical words.
_GNU_BEGIN = ("everyone is permitted to copy", "preamble")
_GNU_END = ("how to apply these terms to your new",)
FILES = {
    "Apache-2.0": (("terms and conditions for use", "1 definitions"), ("end of terms and conditions", "appendix how to apply")),
    "Apache-2.0 WITH LLVM-exception": (("terms and conditions for use", "1 definitions"), ()),
    "Artistic-1.0-Perl": (("preamble",), ()),
    "BSL-1.0": (("permission is hereby granted",), ()),
    "CC0-1.0": (("cc0 1 0 universal", "creative commons corporation is not", "statement of purpose"), ()),
    "GFDL-1.2": (("everyone is permitted to copy", "0 preamble"), ("addendum how to use",)),
    "GFDL-1.3": (("everyone is permitted to copy", "0 preamble"), ("addendum how to use",)),
    "GPL-1.0": (_GNU_BEGIN, ("end of terms and conditions", "appendix how to apply")),
    "GPL-2.0": (("version 2 june 1991", *_GNU_BEGIN), ("end of terms and conditions", *_GNU_END)),
    "GPL-3.0": (("version 3 29 june 2007", *_GNU_BEGIN), ("end of terms and conditions", *_GNU_END)),
    "LGPL-2.0": (("version 2 june 1991", *_GNU_BEGIN), ("end of terms and conditions", *_GNU_END)),
    "LGPL-2.1": (("version 2 1 february 1999", *_GNU_BEGIN), ("end of terms and conditions", *_GNU_END)),
    "LGPL-3.0": (("version 3 29 june 2007", "everyone is permitted to copy", "this version of the gnu lesser"), ()),
    "MPL-1.1": (("1 definitions",), ("exhibit a mozilla public license",)),
    "MPL-2.0": (("1 definitions",), ("exhibit a source code form license notice",)),
    "Unlicense": ((), ("for more information please refer to",)),
    "Zlib": ((), ()),
}
#: What a text without its appendix, or without the appendix's notice, ends with.
LAST = ("end of terms and conditions", "identification within third party archives")
#: Titles that stand before a text, the file's own aside.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "Free Public License 1.0.0", "0BSD", "0BSD License", "BSD 0-Clause License", "Zero-Clause BSD (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "2-Clause BSD License", "The 2-Clause BSD License", "FreeBSD License", "BSD License", "The BSD License", "BSD-2-Clause", "The BSD 2-Clause License (BSD-2-Clause)", "License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "The New BSD License", "Modified BSD License", "Revised BSD License", "3-Clause BSD License", "The 3-Clause BSD License", "BSD License", "The BSD License", "BSD-3-Clause", "License"),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC", "ISC Licence", "Internet Systems Consortium License", "License"),
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "MIT", "(MIT License)", "(The MIT License)", "Expat License", "The Expat License", "MIT/Expat License", "MIT License (Expat)", "License"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License, Version 1.0", "Boost Software License"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License Version 2.0", "Mozilla Public License 2.0"),
    "Unlicense": ("The Unlicense", "Unlicense", "UNLICENSE"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "License"),
    "Apache-2.0": ("Apache License", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "Apache License 2.0"),
}
#: What a publisher changed over the years; any of a group may stand for any other.
ADDRESSES = (
    "51 franklin street fifth floor boston ma 02110 1301 usa",
    "51 franklin st fifth floor boston ma 02110 1301 usa",
    "59 temple place suite 330 boston ma 02111 1307 usa",
    "59 temple place suite 330 boston ma 02111 usa",
    "675 mass ave cambridge ma 02139 usa",
)
CHANGES = (
    ADDRESSES,
    ("https www gnu org licenses", "http www gnu org licenses"),
    ("https www gnu org philosophy why not lgpl html", "http www gnu org philosophy why not lgpl html", "https www gnu org licenses why not lgpl html", "http www gnu org licenses why not lgpl html"),
    ("http www apache org licenses", "https www apache org licenses"),
    ("http www apache org licenses terms", "http www apache org licenses license 2 0 terms"),
    ("https www apache org licenses terms", "https www apache org licenses license 2 0 terms"),
    ("http mozilla org mpl 2 0", "https mozilla org mpl 2 0", "https www mozilla org mpl 2 0"),
    ("https www mozilla org mpl", "http www mozilla org mpl"),
    ("http unlicense org", "https unlicense org"),
    ("gnu lesser general public license instead of this license", "gnu library general public license instead of this license"),
    ("copyright yyyy name of copyright owner", ""),
)

_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE {by} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {liable} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_NAMES = "Neither the name of {name} nor the names of {its} contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_PARTIES = (
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDERS OR CONTRIBUTORS"),
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT OWNER OR CONTRIBUTORS"),
    ("COPYRIGHT HOLDER AND CONTRIBUTORS", "COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("AUTHOR AND CONTRIBUTORS", "AUTHOR OR CONTRIBUTORS"),
    ("AUTHORS AND CONTRIBUTORS", "AUTHORS OR CONTRIBUTORS"),
    ("REGENTS AND CONTRIBUTORS", "REGENTS OR CONTRIBUTORS"),
    ("AUTHOR", "AUTHOR"),
)
_HOLDERS = (
    ("the copyright holder", "its"), ("the copyright holder", "the"), ("the copyright holders", "its"),
    ("the copyright holders", "their"), ("the copyright owner", "its"), ("the author", "the"), ("the author", "its"),
    ("the authors", "its"), ("the University", "its"), ("the organization", "its"), ("the project", "its"),
    ("this project", "its"), ("the owner", "its"),
)


def _bsd() -> Iterator[tuple[str, str]]:
    names = [_NAMES.format(name=name, its=its) for name, its in _HOLDERS]
    head = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    for (by, liable), marks in itertools.product(_PARTIES, (("", "", ""), ("1. ", "2. ", "3. "), ("a. ", "b. ", "c. "))):
        end = _WARRANTY.format(by=by, liable=liable)
        one, two = marks[0] + _SOURCE, marks[1] + _BINARY
        yield "BSD-2-Clause", f"{head} {one} {two} {end}"
        for name in names:
            yield "BSD-3-Clause", f"{head} {one} {two} {marks[2]}{name} {end}"


#: Names of licences in notices.
NAMES = {
    "0BSD": ("0BSD License", "BSD Zero Clause License", "Zero-Clause BSD License"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "GNU AGPLv3", "AGPLv3", "AGPL v3", "AGPL-3.0", "AGPL-3.0 License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2.0", "Apache-2.0", "Apache-2.0 License", "Apache 2 License", "Apache License 2", "Apache Software License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "BSD-2-Clause", "Simplified BSD License", "two-clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "BSD-3-Clause", "New BSD License", "Modified BSD License", "three-clause BSD License", "Revised BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "CC BY 4.0 License", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "CC BY-NC 4.0 License", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "CC BY-NC-ND 4.0 License", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "CC BY-NC-SA 4.0 License", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "CC BY-ND 4.0 License", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "CC BY-SA 3.0 License", "Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "CC BY-SA 4.0 License", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0", "Creative Commons Zero v1.0 Universal"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU General Public License v2", "GNU GPL v2", "GNU GPLv2", "GNU GPL version 2", "GPLv2", "GPL v2", "GPL version 2", "GPL-2.0", "GPL-2.0 License", "GPLv2 License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU General Public License v3", "GNU GPL v3", "GNU GPLv3", "GNU GPL version 3", "GPLv3", "GPL v3", "GPL version 3", "GPL-3.0", "GPL-3.0 License", "GPLv3 License"),
    "ISC": ("ISC License", "ISC"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "GNU LGPLv2.1", "LGPLv2.1", "LGPL v2.1", "LGPL-2.1", "LGPL-2.1 License"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "GNU LGPLv3", "LGPLv3", "LGPL v3", "LGPL-3.0", "LGPL-3.0 License"),
    "MIT": ("MIT License", "MIT", "Expat License"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPL-2.0", "MPL v2.0"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "Zlib": ("zlib License", "zlib/libpng License"),
}
_SUBJECTS = "This work|This project|This software|This program|This code|This file|This library|This package|This repository|This document|The code|The source code|The project".split("|")


def _one_line(name: str) -> Iterator[str]:
    for verb, the, terms in itertools.product(("licensed", "released", "distributed"), ("", "the "), ("", "the terms of ")):
        said = f"{verb} under {terms}{the}{name}"
        yield said
        for subject in _SUBJECTS:
            yield f"{subject} is {said}"
    yield f"License: {name}"


def _gnu_notice(license: str, version: str, later: bool) -> Iterator[str]:
    ends = (
        "If not, see <https://www.gnu.org/licenses/>.",
        *(f"If not, write to the Free Software Foundation, Inc., {a}" for a in ADDRESSES),
    )
    asked = (
        [f"either version {version} of the License, or (at your option) any later version."]
        if later
        else [f"version {version}.", f"version {version} of the License.", f"version {version} only."]
    )
    for which, end, thing in itertools.product(asked, ends, ("program", "library", "software", "file")):
        head = f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {license} as published by the Free Software Foundation"
        yield (
            f"{head}, {which} This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
            "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
            f"See the {license} for more details. You should have received a copy of the {license} along with this {thing}. {end}"
        )


def _notices() -> Iterator[tuple[str, str]]:
    for key, names in NAMES.items():
        yield f"{key} notice", f"SPDX-License-Identifier: {key}"
        for name in names:
            for said in _one_line(name):
                yield f"{key} notice", said
    for key, name, version in (
        ("GPL-2.0", "GNU General Public License", "2"),
        ("GPL-3.0", "GNU General Public License", "3"),
        ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
        ("LGPL-3.0", "GNU Lesser General Public License", "3"),
        ("AGPL-3.0", "GNU Affero General Public License", "3"),
    ):
        for ending, later in (("only", False), ("or-later", True)):
            yield f"{key} notice", f"SPDX-License-Identifier: {key}-{ending}"
            for text in _gnu_notice(name, version, later):
                yield f"{key} notice", text
    yield (
        "Apache-2.0 notice",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    )
    yield (
        "MPL-2.0 notice",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    )
    for see in ("accompanying", "the accompanying"):
        yield (
            "BSL-1.0 notice",
            f"Distributed under the Boost Software License, Version 1.0. (See {see} file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
        )


def _short(known) -> Iterator[tuple[str, str]]:
    """The short licences of ``known``, also in their usual other wordings."""
    texts = dict(known)
    mit, isc, zero = texts["MIT"], texts["ISC"], texts["0BSD"]
    yield "MIT", mit
    yield "MIT", mit.replace("permission notice shall", "permission notice (including the next paragraph) shall")
    yield "MIT", mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS OR AUTHORS")
    for key, text in (("ISC", isc), ("ISC", isc.replace("and/or distribute", "and distribute")), ("0BSD", zero)):
        yield key, text
        yield key, text.replace("THE AUTHOR DISCLAIMS", "THE AUTHORS DISCLAIM").replace("AUTHOR BE", "AUTHORS BE")


def _whole(canonical: Callable[[str], str]) -> Iterator[tuple[str, str]]:
    folder = resources.files("tidewatch.llm") / "license_texts"
    for key, (begins, ends) in FILES.items():
        plain = canonical((folder / f"{key}.txt").read_text("utf-8"))
        starts = [0, *(plain.index(canonical(b)) for b in begins)]
        # An appendix is at the end; its title may stand in the text as well.
        stops = [len(plain), *(plain.rindex(canonical(e)) for e in ends)]
        for last in LAST:
            if last in plain and "end of terms and conditions" in ends:
                stops.append(plain.rindex(last) + len(last))
        for start, stop in itertools.product(sorted(set(starts)), sorted(set(stops))):
            yield key, plain[start:stop].strip()


def _changed(plain: str) -> set[str]:
    """The text with each group of changes made alike throughout it."""
    found = {plain}
    for group in CHANGES:
        for text in list(found):
            for old, new in itertools.permutations(group, 2):
                if old and old in text:
                    found.add(re.sub(" +", " ", text.replace(old, new)).strip())
    return found


def wordings(known, canonical: Callable[[str], str]) -> Iterator[tuple[str, str]]:
    """``known``, then (id, canonical text) of every form of each licence and notice."""
    yield from known
    for key, text in itertools.chain(_short(known), _bsd(), _whole(canonical)):
        titles = ["", *(canonical(title) for title in TITLES.get(key, ()))]
        for plain in _changed(canonical(text)):
            for title in titles:
                yield key, f"{title} {plain}".strip()
    for key, text in _notices():
        for plain in _changed(canonical(text)):
            yield key, plain
