import duckdb
import pandas as pd

from mdlake.llm.license_scan import SENTENCES, UNKNOWN, oracle_sql, scan


def sentence(id_):
    return SENTENCES[id_].capitalize()


def test_rules_in_order(spark):
    mit = "\n".join(sentence(i) + "." for i in ("mit-grant", "mit-condition", "mit-warranty", "mit-liability"))
    bsd = ". ".join(sentence(i) for i in ("bsd-grant", "bsd-source", "bsd-binary"))
    cases = [
        (1, None, [], 0),
        (2, "", [], 0),
        (3, "Nothing to see.", [], 0),
        (4, "Intro.\n" + mit + "\nEnd", ["MIT"], 4),
        (5, bsd + "; " + sentence("bsd-name") + ".", ["BSD-3-Clause"], 4),
        (6, bsd, ["BSD-2-Clause"], 3),
        (7, "A. Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.", ["Apache-2.0", "MIT"], 2),
        (8, sentence("bsd-source"), [UNKNOWN], 1),
        (9, sentence("bsd-binary") + ".\n" + bsd, ["BSD-2-Clause", UNKNOWN], 4),
        (10, "Licensed under CC BY-NC 4.0. " + "word " * 200_000 + ". RELEASED UNDER THE MIT LICENSE!!", ["CC-BY-NC-4.0", "MIT"], 2),
        (11, "Released under the MIT License. " * 3, ["MIT"], 3),
    ]
    rows = [c[:2] for c in cases] + [(None, cases[3][1]), cases[3][:2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS licenses", "1 AS sentence_ids")
    got = scan(docs).collect()
    assert len(got) == len(rows)
    assert [(r.doc_id, r.licenses, len(r.sentence_ids)) for r in got[: len(cases)]] == [(c[0], sorted(c[2]), c[3]) for c in cases]
    assert got[-2].doc_id is None and got[-1].licenses == ["MIT"]
    assert scan(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


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
"""
BSD = """# Copyright (c) 2020, Someone
# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# 1. Redistributions of source code must retain the above copyright notice, this
#    list of conditions and the following disclaimer.
# 2. Redistributions in binary form must reproduce the above copyright notice,
#    this list of conditions and the following disclaimer in the documentation
#    and/or other materials provided with the distribution.
"""
GPL = """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""

ASF = """# Licensed to the Apache Software Foundation (ASF) under one or more
# contributor license agreements.  See the NOTICE file distributed with
# this work for additional information regarding copyright ownership.
# The ASF licenses this file to You under the Apache License, Version 2.0
# (the "License"); you may not use this file except in compliance with
# the License.  You may obtain a copy of the License at
#
#    http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os
"""
APACHE_TEXT = """
                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.

   2. Grant of Copyright License. Subject to the terms and conditions of
      this License, each Contributor hereby grants to You a perpetual,
      worldwide, non-exclusive, no-charge, royalty-free, irrevocable
      copyright license to reproduce, prepare Derivative Works of,
      publicly display, publicly perform, sublicense, and distribute the
      Work and such Derivative Works in Source or Object form.
"""
GPL_TEXT = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble

  The GNU General Public License is a free, copyleft license for
software and other kinds of works.
"""
MPL_TEXT = "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n--------------\n"
MPL_HEADER = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
"""
CC = "Attribution-ShareAlike 4.0 International\n\nCreative Commons Attribution-ShareAlike 4.0 International Public\nLicense\n\nBy exercising the Licensed Rights"


def test_texts_as_they_are_wrapped(spark):
    cases = [
        (MIT, ["MIT"], 3),
        (MIT.partition("\n\n")[2].replace("Someone\n\n", "Someone\n").replace("\n", "\r\n"), ["MIT"], 2),
        (BSD, ["BSD-2-Clause"], 3),
        (GPL, ["GPL-2.0-or-later"], 6),
        (GPL.replace("General", "Affero General").replace("Foundation; either version 2", "Foundation, either version 3"), ["AGPL-3.0-or-later"], 5),
        (GPL.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 2.1"), ["LGPL-2.1-or-later"], 6),
        (APACHE, ["Apache-2.0", UNKNOWN], 3),
        ("// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy", ["MPL-2.0"], 1),
        ("This software is licensed under\nthe MIT License.", ["MIT"], 1),
        ("int x;\n// SPDX-License-Identifier: LGPL-3.0-only\nint y;", ["LGPL-3.0-only"], 1),
        ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", ["ISC"], 1),
        ("This is free and unencumbered software released into the\npublic domain.", ["Unlicense"], 1),
        ("Released under the MIT License\nwith some more words\n" * 3, ["MIT"], 3),
        (ASF, ["Apache-2.0"], 7),
        (APACHE_TEXT, ["Apache-2.0"], 3),
        (GPL_TEXT, ["GPL-3.0"], 3),
        (GPL_TEXT.replace("GENERAL", "LESSER GENERAL").partition("Preamble")[0], ["LGPL-3.0"], 2),
        (MPL_TEXT, ["MPL-2.0"], 1),
        (MPL_HEADER, ["MPL-2.0"], 2),
        (BOOST, ["BSL-1.0"], 2),
        ("// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file)", ["BSL-1.0"], 1),
        (ZLIB, ["Zlib"], 5),
        (ZLIB.partition("Permission")[0], [UNKNOWN], 2),
        (CC, ["CC-BY-SA-4.0"], 1),
        ("This work is licensed under a Creative Commons\nAttribution 4.0 International License.", ["CC-BY-4.0"], 1),
        ("CC0 1.0 Universal\n\nStatement of Purpose", ["CC0-1.0"], 1),
        ("\n\n \n", [], 0),
        ("the\n" * 3000, [], 0),
    ]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.licenses, len(r.sentence_ids)) for r in scan(docs).collect()}
    assert got == {i: (sorted(c[1]), c[2]) for i, c in enumerate(cases)}
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(cases)), "text": [c[0] for c in cases]}))
    rows = {r[0]: r[1:] for r in con.sql("SELECT doc_id, licenses, sentence_ids FROM (" + oracle_sql() + ")").fetchall()}
    assert rows == {r.doc_id: (",".join(r.licenses), ",".join(r.sentence_ids)) for r in scan(docs).collect()}
