"""Licence notices as they stand in real files: plain and commented, with either line end."""

import duckdb
import pytest
from cases import words
from compare import difference
from pyspark.sql import functions as F

from culvert.llm import licences

GPL = """Copyright (C) 2020 Someone

This program is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{comma} either version {version} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.
"""
APACHE = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Someone

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
NOTICES = [
    (GPL.format(mark=":", comma=",", version=3), [5], ["GPL-3.0-or-later"]),
    (GPL.format(mark=";", comma=";", version=2), [7], ["GPL-2.0-or-later"]),
    (APACHE, [3], ["Apache-2.0"]),
    (MIT, [0], ["MIT"]),
    (BSD, [10], ["BSD-2-Clause"]),
    (BSD + BSD3, [9], ["BSD-3-Clause"]),
]


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.licence_rules, r.licences) for r in licences.scan(docs).orderBy("doc_id").collect()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("leader", ["", "# ", " * ", "// "])
def test_genuine_notices(spark, leader, end):
    texts = ["".join(f"{leader}{x}".rstrip() + end for x in t.splitlines()) for t, _, _ in NOTICES]
    texts += [f"/*{end}{t}{end}*/{end}int main;{end}" for t in texts]
    assert scanned(spark, texts) == 2 * [(rules, names) for _, rules, names in NOTICES]


def test_every_rule_of_whole_notices_is_reached(spark):
    assert {5, 7, 3, 0, 9, 10} == {x for rules, _ in scanned(spark, [t for t, _, _ in NOTICES]) for x in rules}


def test_what_stands_behind_marks_is_still_found(spark):
    prose = " ".join(words(30, 4))
    texts = [
        f"{prose}: Licensed under the\nMIT License; {prose}",
        f"{prose}.\nThis work is licensed under the GNU General\nPublic License, version 3.\n{prose}",
        f"Licensed under the\nMIT License\n\nhttps://example.org/{prose}",
        f"{prose}:\nAll rights reserved.",
    ]
    assert [names for _, names in scanned(spark, texts)] == [["MIT"], ["GPL-3.0-only"], ["MIT"], ["proprietary"]]


LGPL = GPL.replace("This program is", "This library is").replace("GNU General", "GNU Lesser General")
AGPL = GPL.replace("GNU General", "GNU Affero General")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """Copyright (c) 2020 Someone. All rights reserved.

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/

SPDX-License-Identifier: EPL-2.0
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software.
"""
MORE = [
    (LGPL.format(mark=";", comma=";", version="2.1"), ["LGPL-2.1-or-later"]),
    (LGPL.format(mark=":", comma=",", version=3), ["LGPL-3.0-or-later"]),
    (AGPL.format(mark=":", comma=",", version=3), ["AGPL-3.0-or-later"]),
    (MPL, ["MPL-2.0"]),
    (ISC, ["ISC"]),
    (EPL, ["EPL-2.0"]),
    (UNLICENSE, ["Unlicense"]),
    ("Copyright 2020 Someone.\nAll rights reserved.\n\n" + BSD + BSD3, ["BSD-3-Clause"]),
    ("Copyright 2020 Someone.\nAll rights reserved.\n", ["proprietary"]),
    *((f"SPDX-License-Identifier: {name}\n", [name]) for name, _ in licences.SPDX),
]


def variants(texts):
    for leader in ("", "# ", " * ", "// "):
        for end in ("\n", "\r\n"):
            for text in texts:
                yield "".join(f"{leader}{x}".rstrip() + end for x in text.splitlines())


def test_more_genuine_notices(spark):
    found = [names for _, names in scanned(spark, list(variants([t for t, _ in MORE])))]
    assert found == 8 * [names for _, names in MORE]


def test_a_notice_in_a_wide_box_or_far_from_its_address(spark):
    boxed = "".join("#" + " " * 300 + x + " " * 300 + "#\n" for x in MIT.splitlines())
    far = APACHE.replace("\n\n    http", "\n" + " \n" * 400 + "    http")
    assert [names for _, names in scanned(spark, [boxed, far])] == [["MIT"], ["Apache-2.0"]]


def test_the_sql_states_the_operator(spark):
    texts = list(variants([t for t, *_ in [*NOTICES, *MORE]]))
    texts += [f"/*\n{t}\n*/\nint main; {t}" for t in texts[:15]] + [None, "", "\n\n", "a.\n\nhttp://x\n\n\n\nhttp://y"]
    prose = " ".join(words(30, 4))
    texts += [f"{prose}: Licensed under the\nMIT License; {prose}", APACHE.replace("\n\n    http", "\n \n\n\t\n http"), "MIT License\n\n\n\nhttps://a"]
    rows = [(i, t) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    lists = ("licence_ids", "licences", "licence_rules")
    shown = found.select("doc_id", *[F.array_join(name, ",").alias(name) for name in lists], "licence_kind")
    assert difference(shown, con, licences.oracle()) is None
