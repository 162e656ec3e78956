"""License scans by canonical digests.

A text is brought to a canonical form: lower case; copyright lines go; punctuation and white space become single
spaces; equivalent spellings become one. The SHA-256 of the whole canonical text is looked up among the digests of
known licences by a hash join. The scanned units are whole documents and, since notices stand on lines of their own,
every whole line; a unit matches entirely or not at all. Texts and lines without any of a few strings, of which
every known text has one whatever its spelling, are not brought to canonical form.

The known texts are a parameter: by default KNOWN, with the entire texts of the folder license_texts (one file per SPDX
name) and notices made of phrases and licence names. Only their digests are broadcast, one row per distinct text.

Defined cases: null and empty texts match nothing; rows without doc_id are scanned like others; repeated rows count
each; an empty table gives an empty result; other columns are ignored. Units that are empty in canonical form match nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import narrow

#: Equivalent spellings, on canonical text of single-spaced words: (word or phrase, its one form). Fixed values.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sublicence", "sublicense"),
    ("non commercial", "noncommercial"), ("organisation", "organization"), ("organisations", "organizations"),
    ("merchantibility", "merchantability"), ("favour", "favor"), ("authorised", "authorized"), ("recognised", "recognized"),
    ("v 2", "version 2"), ("v 3", "version 3"), ("v2", "version 2"), ("v3", "version 3"), ("version 2 0", "version 2"), ("version 3 0", "version 3"),
    ("creative commons", "cc"), ("https", "http"), ("copyright holders", "copyright holder"), ("copyright owner", "copyright holder"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
"""

_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""

_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Known texts and notices by SPDX name. Fixed values.
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This work is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0-only", "Released under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Released under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
)

def _entire(folder: str = "license_texts") -> list[tuple[str, str]]:
    """(SPDX name, text) of the folder's files, also without the appendix on how to apply the licence."""
    out = []
    for file in sorted((f for f in files(__package__).joinpath(folder).iterdir() if f.name.endswith(".txt")), key=lambda f: f.name):
        text = file.read_text(encoding="utf-8")
        out.append((file.name.removesuffix(".txt"), text))
        terms, end, appendix = text.partition("END OF TERMS AND CONDITIONS")
        if appendix.strip():
            out += [(file.name.removesuffix(".txt"), terms), (file.name.removesuffix(".txt"), terms + end)]
    return out


#: Names in notices by SPDX name; a leading "the" may be missing.
NAMED = {
    "MIT": ("MIT License", "MIT"), "ISC": ("ISC License",), "Zlib": ("zlib License",), "Unlicense": ("Unlicense",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License"), "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License"),
    "MPL-1.1": ("Mozilla Public License, version 1.1", "Mozilla Public License 1.1"), "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
} | {
    f"{short}-{v}-{kind}": (f"GNU {name}, version {v.removesuffix('.0')}{more}", f"GNU {name} {form}{more}", f"GNU {name} v{v.removesuffix('.0')}{more}")
    for short, name, versions in (
        ("GPL", "General Public License", ("1.0", "2.0", "3.0")), ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
        ("LGPL", "Library General Public License", ("2.0",)), ("AGPL", "Affero General Public License", ("3.0",)))
    for v in versions for form in (v.removesuffix(".0"),) for kind, more in (("only", ""), ("or-later", " or later"))
} | {
    f"CC-{kind}-{v}": (f"CC {kind} {v}", f"Creative Commons {name} {v} International License" if v == "4.0" else f"Creative Commons {name} {v} Unported License")
    for v in ("3.0", "4.0")
    for kind, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
}
PHRASES = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This software is licensed under", "This project is licensed under")

KNOWN += tuple(_entire())
KNOWN += tuple((name, f"{phrase} {the}{own}.") for name, owns in NAMED.items() for own in owns for phrase in PHRASES for the in ("the ", ""))
KNOWN += tuple((name, f"SPDX-License-Identifier: {name}") for name in NAMED)

#: Beginnings that everyday texts are full of, so that they tell little.
EVERYDAY = ("under", "other", "which", "their", "there", "these", "those", "where", "about", "would", "after", "first")

COPYRIGHT = r"(?im)^[ \t]*(?:copyright\b[ \t]*(?:\(c\)|©|[0-9])|\(c\)[ \t]|©)[^\n]*$"
ALL_RIGHTS = r"(?im)^[ \t]*all rights reserved\.?[ \t]*$"
MARKS = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(text, COPYRIGHT, " "), ALL_RIGHTS, " ")
    c = F.concat(F.lit(" "), F.regexp_replace(F.lower(c), MARKS, "  "), F.lit(" "))  # two spaces: equal neighbours share none
    for old, new in SPELLINGS:
        c = F.replace(c, F.lit(_spaced(old)), F.lit(_spaced(new)))
    return F.regexp_replace(F.trim(c), " +", " ")


def canonical_text(text: str) -> str:
    c = re.sub(ALL_RIGHTS, " ", re.sub(COPYRIGHT, " ", text))
    c = " " + re.sub(r"[\W_]+", "  ", c.lower()) + " "
    for old, new in SPELLINGS:
        c = c.replace(_spaced(old), _spaced(new))
    return re.sub(" +", " ", c.strip(" "))


def _spaced(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def known_digests(known: Sequence[tuple[str, str]] = KNOWN) -> list[tuple[str, str]]:
    """(digest, licence), one row per distinct canonical text."""
    return sorted({hashlib.sha256(canonical_text(t).encode()).hexdigest(): name for name, t in known}.items())


def stems(known: Sequence[tuple[str, str]] = KNOWN) -> list[str]:
    """A few strings of letters, one of which is in the lower-case form of every text that equals a known one; none if there are no such.

    A string that no spelling brings in is in a canonical text only if it was in the text before. Of all beginnings (of 5
    letters or more) of the known texts' words those are taken, one by one, that are in most of the texts left.
    """
    left = {c for c in (canonical_text(t) for _, t in known) if c}
    having: dict[str, set[str]] = {}
    for c in left:
        for w in set(c.split(" ")):
            if re.fullmatch("[a-z]{5,}", w):
                having.setdefault(w[:5], set()).add(c)
    brought = lambda s: any(s in word for old, new in SPELLINGS for word in new.split(" ") if s not in old)
    having = {s: own for s, own in having.items() if not brought(s)}
    found = []
    while left:
        best = max(sorted(having), key=lambda s: (len(having[s] & left) > 0, s not in EVERYDAY, len(having[s] & left)), default=None)
        if best is None or not having[best] & left:
            return []
        found.append(best)
        left -= having.pop(best)
    return found


def license_scan(docs: DataFrame, text: str = "text", known: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    """(doc_id, scope, line_no, license) of each unit that is one of the known (licence, text): scope 'text' or 'line'; line_no from 0, -1 for whole texts."""
    spark = docs.sparkSession
    digests = F.broadcast(spark.createDataFrame(known_digests(known), "digest string, license string"))
    some = "|".join(stems(known))
    may_match = lambda c: F.rlike(F.lower(c), F.lit(some))
    own = narrow(docs, {"doc_id": "long", text: "string"}).filter(F.col(text).isNotNull() & may_match(F.col(text)))
    units = own.select("doc_id", F.posexplode(F.concat(F.array(F.col(text)), F.split(F.col(text), "\n"))).alias("at", "unit")).filter(may_match(F.col("unit")))
    scope = F.when(F.col("at") == 0, F.lit("text")).otherwise(F.lit("line")).alias("scope")
    units = units.select("doc_id", scope, F.when(F.col("at") == 0, F.lit(-1)).otherwise(F.col("at") - 1).alias("line_no"), canonical(F.col("unit")).alias("canon")).filter("canon <> ''")
    units = units.withColumn("digest", F.sha2(F.encode("canon", "UTF-8"), 256))
    return units.join(digests, "digest").select("doc_id", "scope", "line_no", "license")
