from wapspark.llm import license_scan as L
from llm_fixtures import docs  # noqa: F401

TAG = "// SPDX-License-Identifier: "
CASES = [
    (TAG + "MIT OR Apache-2.0", {"MIT", "Apache-2.0"}, "MIT OR Apache-2.0"),
    (TAG + "(MIT OR Apache-2.0) AND BSD-3-Clause\ncode", {"MIT", "Apache-2.0", "BSD-3-Clause"},
     "(MIT OR Apache-2.0) AND BSD-3-Clause"),
    ("/* SPDX-License-Identifier:  GPL-2.0+ or\tMPL-2.0 */", {"GPL-2.0-or-later", "MPL-2.0"},
     "GPL-2.0+ or MPL-2.0"),
    (TAG + "GPL-2.0-only WITH Classpath-exception-2.0", {"GPL-2.0-only"},
     "GPL-2.0-only WITH Classpath-exception-2.0"),
    ("<!-- spdx-license-identifier: ISC AND Unlicense -->\nx", {"ISC", "Unlicense"},
     "ISC AND Unlicense"),
    (TAG + "LGPL-2.1-or-later OR Other-1.0", {"LGPL-2.1-or-later"}, "LGPL-2.1-or-later OR Other-1.0"),
    (TAG + "MIT", {"MIT"}, ""),
    (TAG + "MPL-2.0\nint x;", {"MPL-2.0"}, ""),
    (TAG + "AGPL-3.0-or-later", {"AGPL-3.0-or-later"}, ""),
    (TAG + "MIT or whatever you like", set(), ""),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
     {"Apache-2.0", "MIT"}, ""),
    ("Licensed under either of\n * Apache License, Version 2.0\n"
     "   (http://www.apache.org/licenses/LICENSE-2.0)\n * or MIT license\n", {"Apache-2.0", "MIT"}, ""),
    ("Licensed under the Apache License, Version 2.0 or the MIT license, at your option.",
     {"Apache-2.0", "MIT"}, ""),
    ("This Source Code Form is subject to the terms of the Mozilla Public\n"
     " * License, v. 2.0. If a copy of the MPL was not distributed", {"MPL-2.0"}, ""),
    ("# This library is free software; you can redistribute it and/or\n# modify it under the terms of"
     " the GNU Lesser General Public\n# License as published by the Free Software Foundation; either\n"
     "# version 2.1 of the License, or (at your option) any later version.", {"LGPL-2.1-or-later"}, ""),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
     " Affero General Public License as published by the Free Software Foundation, either version 3 of"
     " the License, or (at your option) any later version.", {"AGPL-3.0-or-later"}, ""),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without"
     " fee is hereby granted, provided that the above", {"ISC"}, ""),
    ("This is free and unencumbered software released into the public domain.", {"Unlicense"}, ""),
    ("This is in the public domain or so I think.", set(), ""),
    ("", set(), ""), (None, set(), ""),
]


def test_expressions_and_further_licenses(docs):
    got = {r.doc_id: r for r in L.scan(docs(list(enumerate(c[0] for c in CASES)))).collect()}
    whole = {r.doc_id: r.expressions for r in L.expressions(
        docs(list(enumerate(c[0] for c in CASES)))).collect()}
    for i, (text, names, expressions) in enumerate(CASES):
        assert set(filter(None, got[i].licenses.split(","))) == names, (i, text, got[i])
        assert whole[i] == ([expressions] if expressions else []), (i, whole[i])
        assert (got[i].license is None) == (not names)


def test_expressions_follow_the_sentences(docs):
    text = TAG + "MIT OR ISC\nReleased under the MIT license.\n" + TAG + "Apache-2.0 OR MIT\n"
    row = L.scan(docs([(1, text)])).first()
    assert row.sentence_ids == "mit/notice,mit/spdx,isc/spdx,apache-2.0/spdx,mit/spdx"
    assert row.n_sentences == 5
    assert L.expressions(docs([(1, text)])).first().expressions == ["MIT OR ISC", "Apache-2.0 OR MIT"]


def test_without_tags_in_the_table(docs):
    row = L.scan(docs([(1, TAG + "MIT OR ISC")]), sentences={"all rights reserved": "r"},
                 rules=[("R", ["r"])]).first()
    assert row.licenses == "" and row.license is None


def test_many_expressions_in_one_text(docs):
    row = L.scan(docs([(1, (TAG + "MIT OR Apache-2.0\n") * 5000)])).first()
    assert row.n_sentences == 10000 and row.licenses == "Apache-2.0,MIT"
