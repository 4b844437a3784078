"""Licence recognition by sentences and rules, in DataFrame operations only.

A text is cut at line and sentence ends and normalised; known licence sentences are
found in it whole, across those cuts. The identifiers found, in order, are then matched against rules, the most
specific first; what a rule matches is used up. Rows never leave their partition.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of licence texts, by identifier.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",  # noqa: E501
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",  # noqa: E501
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",  # noqa: E501
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",  # noqa: E501
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",  # noqa: E501
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",  # noqa: E501
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-basis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",  # noqa: E501
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl2-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",  # noqa: E501
    "gpl3-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",  # noqa: E501
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",  # noqa: E501
    "gpl-see": "See the GNU General Public License for more details.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights": "All rights reserved.",
}

# Names by which a sentence grants a licence, and the licence's short name.
NAMES = {
    "MIT License": "MIT", "ISC License": "ISC", "zlib License": "Zlib", "Unlicense": "Unlicense", "Apache License, Version 2.0": "Apache-2.0",
    "BSD 2-Clause License": "BSD-2-Clause", "BSD 3-Clause License": "BSD-3-Clause", "Mozilla Public License, version 2.0": "MPL-2.0", "CC0 1.0": "CC0-1.0",
}
NAMES |= {f"GNU {long}General Public License, version {v}": f"{short}GPL-{v}.0" for long, short in (("", ""), ("Lesser ", "L"), ("Affero ", "A")) for v in (1, 2, 3)}
NAMES |= {f"CC {kind} {v}": f"CC-{kind}-{v}" for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("1.0", "2.0", "2.5", "3.0", "4.0")}
PHRASES = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This software is licensed under", "This file is licensed under")

# Ordered rules: licence, and the sentences that stand for it when they follow each other.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["grant:Apache-2.0", "apache-use", "apache-copy", "apache-basis", "apache-see"]),
    ("Apache-2.0", ["grant:Apache-2.0", "apache-use", "apache-copy"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-hope", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-hope", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("Unlicense", ["unlicense"]),
    ("LicenseRef-all-rights-reserved", ["all-rights"]),
    *((short, [f"grant:{short}"]) for short in dict.fromkeys(NAMES.values())),
]

# Spaces, sentence ends, what is deleted first, what parts words; and words one of which any known sentence has.
_SPACE = r"[\x20\x09-\x0D]"
_NOISE = r'[#*$%&|<>!"]'
_END = rf"[.?;:]+({_SPACE}+|\z)|\n+"
_PART = r"[^\p{L}\p{N}]+"
_SPEAKS = r"licen[sc]|copyright|permission|redistribut|warrant|rights|liab|released|distributed under"


def normalised(sentence: str) -> str:
    """What ``sentences`` makes of a single sentence."""
    return re.sub(r"[\W_]+", " ", re.sub(_NOISE, "", sentence.lower())).strip()


def _pieces(text: str) -> list[str]:
    found = (normalised(p) for p in re.split(r"[.?;:]+(?:\s+|\Z)|\n+", re.sub(_NOISE, "", text)))
    return [p for p in found if re.search(_SPEAKS, p)]


def known() -> dict[str, str]:
    """Normalised sentence to identifier. A known text that itself parts into sentences is known by its first."""
    table = {}
    for name, text in SENTENCES.items():
        table[_pieces(text)[0]] = name
    for phrase in PHRASES:
        for name, short in NAMES.items():
            for the in ("the ", ""):
                table[normalised(f"{phrase} {the}{name}")] = f"grant:{short}"
    return table


# Licence sentences as they stand in files, on any number of lines: normalised words, in which a space may also be a break.
_HOLDER = r"\S+(?: \S+){0,19}?"
_WHOLE = {name: normalised(text) for name, text in SENTENCES.items() if not re.match("bsd-names|gpl|apache-copy", name)}
_WHOLE |= {
    "apache-copy": "you may obtain a copy of the license at https? www apache org licenses license 2 0",
    "bsd-names": rf"(?:neither the names? of {_HOLDER} nor the names? of {_HOLDER}|(?:the )?names? of {_HOLDER}) may (?:not )?be used to endorse or promote products derived from this software without (?:specific )?prior written permission",  # noqa: E501
    "bsd-advert": rf"all advertising materials mentioning features or use of this software must display the following acknowledge?ment(?: this product includes software developed by {_HOLDER}$)?",
    "bsd-as-is": rf"this software is provided by {_HOLDER} as is and any express(?:ed)? or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",  # noqa: E501
    "bsd-liability": rf"in no event shall {_HOLDER} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",  # noqa: E501
}
_FAMILY: list[tuple[str, list[str]]] = []
for _long, _short, _versions in (("", "gpl", ("1", "2", "3")), ("(?:lesser|library) ", "lgpl", ("2", "2.1", "3")), ("affero ", "agpl", ("3",))):
    _licence = f"gnu {_long}general public license"
    _from = f"this (?:program|library|file|software) is free software you can redistribute it and or modify it under the terms of the {_licence} as published by the free software foundation"
    for _v in _versions:
        _words = f"version {_v.replace('.', ' ')} of the license"
        _WHOLE[f"{_short}{_v}-later"] = f"{_from} (?:either )?{_words} or at your option any later version"
        _WHOLE[f"{_short}{_v}-only"] = rf"{_from} {_words}$(?!\n(?:or|and) )"
    _hope = "(?:program|library|file|software) is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
    _WHOLE["gpl-hope"] = f"this {_hope}"
    _WHOLE[f"{_short}-see"] = f"see the {_licence} for more details"
    _WHOLE[f"{_short}-copy"] = f"you should have received a copy of the {_licence} along with this (?:program|library|file|software)(?: if not see https? www gnu org licenses)?"
    _tails = ["gpl-hope", f"{_short}-see", f"{_short}-copy"]
    for _v in reversed(_versions):
        for _kind, _suffix in (("later", "or-later"), ("only", "only")):
            _name = f"{_short.upper()}-{_v if '.' in _v else _v + '.0'}-{_suffix}"
            _FAMILY += [(_name, [f"{_short}{_v}-{_kind}", *_tails[:n]]) for n in (3, 2, 0)]

_NAMED = {normalised(name): short for name, short in NAMES.items()}
_NAMED |= {f"{normalised(name)} {later}": f"{short}-or-later" for name, short in NAMES.items() if name.startswith("GNU ") for later in ("or later", "or any later version", "or at your option any later version")}
_FORMAL = f"(?:{'|'.join(map(normalised, PHRASES))})(?: the)?"
_GRANT = f"{_FORMAL} (?:{'|'.join(sorted(_NAMED, key=len, reverse=True))})(?: the license)?"
# The number of a list's entry may stand before a sentence.
_MARK = "(?:(?:[0-9]{1,2}|[a-e]) )?"

# Rules for whole sentences: what has more sentences first.
_BSD = ["bsd-grant", "bsd-source", "bsd-binary"]
WHOLE_RULES: list[tuple[str, list[str]]] = [
    *((name, [*_BSD, *more, *end]) for end in (["bsd-as-is", "bsd-liability"], []) for name, more in (("BSD-4-Clause", ["bsd-advert", "bsd-names"]), ("BSD-4-Clause", ["bsd-advert"]), ("BSD-3-Clause", ["bsd-names"]), ("BSD-2-Clause", []))),  # noqa: E501
    *_FAMILY,
    *((name, ids) for name, ids in RULES if not any(i.startswith(("gpl", "bsd")) for i in ids)),
    *((short, [f"grant:{short}"]) for short in dict.fromkeys(_NAMED.values()) if short.endswith("-or-later")),
]


def _over_breaks(pattern: str) -> str:
    return f"(?m)^{_MARK}(?:{pattern})$".replace(" ", r"[ \n]")


_ANY = _over_breaks("|".join([_GRANT, *_WHOLE.values()]))
# As _SPEAKS, before breaks are taken out.
_MAYBE = _SPEAKS.replace(" ", r"[^\p{L}\p{N}]+")


def fragments(text: Column) -> Column:
    """What lies between line ends and sentence ends, normalised; empty ones are left out."""
    clean = F.regexp_replace(F.lower(text), _NOISE, "")
    each = F.transform(F.split(clean, _END, -1), lambda s: F.trim(F.regexp_replace(s, _PART, " ")))
    return F.filter(each, lambda s: s != "")


def _identified(found: Column) -> Column:
    """The identifier of what ``_ANY`` matched."""
    named = F.create_map(*(F.lit(x) for pair in _NAMED.items() for x in pair))
    bare = F.regexp_replace(F.translate(found, "\n", " "), f"^{_MARK}{_FORMAL} | the license$", "")
    out = F.when(found.rlike(_over_breaks(_GRANT)), F.concat(F.lit("grant:"), F.try_element_at(named, bare)))
    for name, pattern in _WHOLE.items():
        out = out.when(found.rlike(rf"\A{_over_breaks(pattern)}\z"), F.lit(name))
    return F.coalesce(out, F.lit("?"))


def recognise(text: Column | str = "text") -> Column:
    """Struct (sentence_ids, licences, unmatched) of a whole text.

    A known sentence is found whole, however it is broken into lines, comment signs before them or not.
    ``sentence_ids`` are the identifiers in order, each in angle brackets, ``<?>`` for any other piece of a line
    that speaks of licences. ``licences`` are those whose rules matched, in the order
    of the rules; ``unmatched`` counts identifiers that no rule used. Null and empty texts have none; long
    ones are looked at whole.
    """
    text = F.col(text) if isinstance(text, str) else text

    def sequence(stream: Column) -> Column:
        ids = F.transform(F.regexp_extract_all(stream, F.lit(_ANY), F.lit(0)), lambda s: F.concat(F.lit("<"), _identified(s), F.lit(">")))
        rest = F.transform(F.split(stream, _ANY, -1), lambda s: F.array_join(F.transform(F.filter(F.split(s, "\n", -1), lambda x: x.rlike(_SPEAKS)), lambda x: F.lit("<?>")), ""))  # noqa: E501
        return F.array_join(F.flatten(F.zip_with(rest, ids, lambda r, i: F.array(r, F.coalesce(i, F.lit(""))))), "")

    streams = F.transform(F.array(F.array_join(fragments(text), "\n")), sequence)
    return _apply(F.when(F.lower(text).rlike(_MAYBE), F.get(streams, F.lit(0))).otherwise(""))


def _apply(sequence: Column) -> Column:
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("pattern")) for name, ids in WHOLE_RULES))

    def use(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["pattern"])
        found = F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"])
        return F.struct(F.replace(state["left"], rule["pattern"], F.lit("!")).alias("left"), found.alias("found"))

    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))
    finish = lambda s: F.struct(
        sequence.alias("sentence_ids"), F.array_distinct(s["found"]).alias("licences"), F.regexp_count(s["left"], F.lit("<")).cast("bigint").alias("unmatched")
    )
    nothing = F.struct(F.lit("").alias("sentence_ids"), F.array().cast("array<string>").alias("licences"), F.lit(0).cast("bigint").alias("unmatched"))
    return F.when(sequence == "", nothing).otherwise(F.aggregate(rules, start, use, finish))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences (comma-joined) and unmatched for every row of (doc_id, text)."""
    found = docs.select("doc_id", recognise("text").alias("r"))
    return found.select("doc_id", "r.sentence_ids", F.array_join("r.licences", ",").alias("licences"), "r.unmatched")


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def scan_sql() -> str:
    """The same in SQL for sentences that stand on one line each; wrapped sentences, GNU and BSD headers in full are beyond it."""
    table = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in known().items())
    steps, last = [], "r0"
    for k, (name, ids) in enumerate(RULES, 1):
        pattern = _quoted("".join(f"<{i}>" for i in ids))
        found = f"case when contains(remains, {pattern}) then list_append(found, {_quoted(name)}) else found end"
        steps.append(f"r{k} as (select k, doc_id, sentence_ids, replace(remains, {pattern}, '!') as remains, {found} as found from {last})")
        last = f"r{k}"
    return rf"""
with known(sentence, id) as (values {table}),
docs as (select row_number() over () as k, doc_id, text from documents),
each as (
    select k, no, trim(regexp_replace(s, '{_PART}', ' ', 'g')) as sentence
    from docs, unnest(string_split_regex(regexp_replace(lower(text), '{_NOISE}', '', 'g'), '{_END}')) with ordinality as t(s, no)
), ids as (
    select k, string_agg('<' || coalesce(id, '?') || '>', '' order by no) as sentence_ids
    from each left join known using (sentence) where regexp_matches(sentence, '{_SPEAKS}') group by k
), r0 as (
    select k, doc_id, coalesce(sentence_ids, '') as sentence_ids, coalesce(sentence_ids, '') as remains, []::varchar[] as found
    from docs left join ids using (k)
), {", ".join(steps)}
select doc_id, sentence_ids, length(remains) - length(replace(remains, '<', '')) as unmatched,
       array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ',') as licences
from {last}
"""
