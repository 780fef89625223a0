import os

import oracle
import pytest
from cases import edge_docs

from lapwise.llm import licenses

FOLDER = "/root/testdata/sf0.001"

MIT = """MIT License

Copyright (c) 2020 Somebody

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


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(docs).collect()}


def test_sequences_and_order(spark):
    got = scan(spark, [
        MIT,
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "text\nReleased under the MIT License.\nmore text. And more. And more. Licensed under CC BY-NC 4.0.",
        "Licensed under the Foo License, Version 9.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        None,
        "",
        "the mit license was released under the stone",
    ])
    assert got[0].licences == "MIT" and got[0].n_unmatched == 0 and got[0].n_known == 5
    assert got[1].licences == "Apache-2.0"
    assert got[2].licences == "CC-BY-NC-4.0,MIT"
    assert got[3].licences == "" and got[3].n_unknown == 1
    assert got[4].n_unmatched == 1 and got[4].licences == ""
    assert (got[5].licences, got[5].n_known, got[5].n_unknown) == ("", 0, 0) == (
        got[6].licences, got[6].n_known, got[6].n_unknown)
    assert got[7].licences == "" and got[7].n_unknown == 1


NOTICES = {
    "Apache-2.0": """# Copyright 2021 Somebody
#
# Licensed under the Apache License, Version 2.0 (the "License");
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

import os
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
""",
    "GPL-2.0-or-later": """/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 */
""",
    "GPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
""",
    "LGPL-2.1-or-later": """// This library is free software; you can redistribute it and/or
// modify it under the terms of the GNU Lesser General Public
// License as published by the Free Software Foundation; either
// version 2.1 of the License, or (at your option) any later version.
""",
    "AGPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as
    published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version.
""",
    "MPL-2.0": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.
""",
    "Zlib": """  This software is provided 'as-is', without any express or implied
  warranty.  In no event will the authors be held liable for any damages
  arising from the use of this software.

  Permission is granted to anyone to use this software for any purpose,
  including commercial applications, and to alter it and redistribute it
  freely, subject to the following restrictions:
""",
    "BSL-1.0": """//          Copyright Somebody 2021.
// Distributed under the Boost Software License, Version 1.0.
//    (See accompanying file LICENSE_1_0.txt or copy at
//          https://www.boost.org/LICENSE_1_0.txt)
""",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n",
    "MIT": MIT,
}


def test_unaltered_notices(spark):
    got = scan(spark, list(NOTICES.values()))
    assert {name: got[i].licences for i, name in enumerate(NOTICES)} == {name: name for name in NOTICES}


@pytest.mark.parametrize("leader", ["", "// ", "# ", " * ", "/* ", "-- ", "; "])
def test_licence_tags(spark, leader):
    texts = [f"{leader}SPDX-License-Identifier: {name}\nint main;" for name in licenses.SPDX]
    texts += [f"{leader}spdx-license-identifier: GPL-2.0+ */", f"{leader}SPDX-License-Identifier: (MIT OR ISC)"]
    got = scan(spark, texts)
    assert [got[i].licences for i in range(len(texts))] == [*licenses.SPDX, "GPL-2.0-or-later", "MIT"]


def test_sentences_far_apart_make_no_licence(spark):
    first, *rest = MIT.split("\n\n")
    grant = rest[1] + "\n\n"
    near, far = "One line. ", "One line. Two lines. Three lines. Four lines. "
    got = scan(spark, [grant + near + "\n\n".join(rest[2:]), grant + far + "\n\n".join(rest[2:])])
    assert got[0].licences == "MIT" and got[1].licences == "" and got[1].n_unmatched == 4


def test_edges(spark):
    docs = edge_docs(spark)
    got = licenses.scan(docs)
    assert got.count() == docs.count()
    assert [r.licences for r in got.where("doc_id = 18").collect()] == ["MIT"]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_plan_has_no_exchange_and_no_python(spark, tmp_path):
    spark.range(3).selectExpr("id as doc_id", "string(id) as text").write.parquet(str(tmp_path / "d"))
    plan = licenses.scan(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_reference_sql(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert oracle.differences(licenses.scan(docs), oracle.connect(FOLDER), licenses.reference_sql()) == []
