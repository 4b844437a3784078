from __future__ import annotations

import re

import duckdb
import pandas as pd
import pytest

from barhouse.llm import licences
from tests.llm.cases import ALL_IDS, awkward, clashing, empty, ids

S = licences.SENTENCES
MIT = " ".join(S[k] for k in ("mit-grant", "mit-notice", "mit-as-is", "mit-liability"))
BSD = "\n".join(f"* {S[k]}" for k in ("bsd-grant", "bsd-source", "bsd-binary"))
CASES = [
    (MIT, "MIT"),
    (f"Copyright 2020 A. Author\n{BSD}\n{S['bsd-names']}", "BSD-3-Clause"),
    (BSD, "BSD-2-Clause"),
    (f"{S['bsd-source']} {S['bsd-grant']}", ""),
    ("Text.\nLicensed under CC BY-NC 4.0. More text.", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("released UNDER the mit license.###", "MIT"),
    ("LICENSED!! UNDER!! THE!! APACHE!! LICENSE,!! VERSION!! 2.0.!!", "Apache-2.0"),
    (f"Licensed under the Apache License, Version 2.0; {S['apache-use']} {S['apache-copy']}. {S['apache-basis']} {S['apache-see']}", "Apache-2.0"),
    ("The licence is secret.", ""),
    (f"Released under the MIT License.\n{MIT}\nLicensed under CC BY 4.0", "MIT,CC-BY-4.0"),
    ("", ""),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id bigint, text string")
    return docs, {r["doc_id"]: r for r in licences.scan(docs).collect()}


def plain(text):
    """Sentences, identifiers and rules one after the other."""
    table = licences.known()
    ids = [table.get(s, "?") for s in licences._pieces(text)]
    out, left = [], list(ids)
    for name, rule in licences.RULES:
        i = 0
        while i + len(rule) <= len(left):
            if left[i : i + len(rule)] == rule:
                left[i : i + len(rule)] = ["!"]
                out.append(name)
            i += 1
    return ids, list(dict.fromkeys(out)), sum(x != "!" for x in left)


def test_cases(found):
    for i, (text, want) in enumerate(CASES):
        ids, names, unmatched = plain(text)
        r = found[1][i]
        assert r["licences"] == want == ",".join(names)
        assert re.findall(r"<(.*?)>", r["sentence_ids"]) == ids and r["unmatched"] == unmatched


def test_every_known_sentence_is_found_again():
    for text in S.values():
        assert licences._pieces(text)[0] in licences.known()
    assert all(re.search(licences._SPEAKS, s) for s in licences.known())


def test_sql_agrees(spark, found):
    documents = pd.DataFrame({"doc_id": range(len(CASES)), "text": [t for t, _ in CASES]})
    con = duckdb.connect()
    con.register("documents", documents)
    theirs = con.execute(licences.scan_sql()).fetch_df().sort_values("doc_id").reset_index(drop=True)
    ours = licences.scan(found[0]).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(ours[theirs.columns], theirs, check_dtype=False)


def test_awkward_documents(spark):
    got = licences.scan(clashing(spark))
    assert ids(got) == ALL_IDS
    assert {(r["licences"], r["sentence_ids"], r["unmatched"]) for r in got.collect()} == {("", "", 0)}
    assert licences.scan(empty(spark)).count() == 0
    plan = licences.scan(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


MIT_FILE = """Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE.
"""
APACHE_FILE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
BSD_START = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_ADVERT = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by Example Inc.
"""
BSD_NAMES = """4. Neither the name of Example Inc. nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
GPL_FILE = """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; {version}
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
LATER = "either version {} of the License, or\n * (at your option) any later version."
LGPL_FILE = GPL_FILE.replace("GNU General", "GNU Lesser General").replace("program", "library")
FILES = [
    (MIT_FILE, "MIT", 1),
    (APACHE_FILE, "Apache-2.0", 0),
    (APACHE_FILE.replace("# ", "// "), "Apache-2.0", 0),
    (BSD_START + BSD_END, "BSD-2-Clause", 0),
    (BSD_START + BSD_NAMES + BSD_END, "BSD-3-Clause", 0),
    (BSD_START + BSD_ADVERT + BSD_NAMES + BSD_END, "BSD-4-Clause", 0),
    (GPL_FILE.format(version=LATER.format(2)), "GPL-2.0-or-later", 0),
    (GPL_FILE.format(version=LATER.format(3)), "GPL-3.0-or-later", 0),
    (GPL_FILE.format(version="version 2 of the License."), "GPL-2.0-only", 0),
    (GPL_FILE.format(version="version 2 of the License,\n * or version 7 of it."), "", None),
    (GPL_FILE.format(version=LATER.format(4)), "", None),
    (LGPL_FILE.format(version=LATER.format(2.1)), "LGPL-2.1-or-later", 0),
    (GPL_FILE.replace("GNU General", "GNU Affero General").format(version=LATER.format(3)), "AGPL-3.0-or-later", 0),
    ("Distributed\nunder the GNU General Public License, version 2\nor (at your option) any later version.", "GPL-2.0-or-later", 0),
    ("Distributed\nunder CC\nBY 4.0", "CC-BY-4.0", 0),
]


def test_licences_as_they_stand_in_files(spark):
    docs = spark.createDataFrame([(i, f[0]) for i, f in enumerate(FILES)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licences.scan(docs).collect()}
    for i, (_, want, unmatched) in enumerate(FILES):
        assert got[i]["licences"] == want, got[i]
        assert unmatched in (None, got[i]["unmatched"]), got[i]
