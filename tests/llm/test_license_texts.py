import pytest

from wapspark.llm import license_scan as L
from llm_fixtures import docs  # noqa: F401

APACHE = """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
MIT = """MIT License

Copyright (c) 2020 A. Holder

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
BSD2 = """Copyright (c) 2020, A. Holder
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
BSD3 = BSD2 + """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
LINUX = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
"""
WHOLE = [(APACHE, "Apache-2.0"), (MIT, "MIT"), (GPL.format(3), "GPL-3.0-or-later"),
         (GPL.format(2), "GPL-2.0-or-later"), (LINUX, "GPL-2.0-only"), (BSD2, "BSD-2-Clause"),
         (BSD3.format("the copyright holder"), "BSD-3-Clause"), (BSD3.format("Own Inc."), "BSD-3-Clause")]
TAGS = [("Apache-2.0", "Apache-2.0"), ("MIT", "MIT"), ("GPL-2.0", "GPL-2.0-only"),
        ("GPL-2.0-only", "GPL-2.0-only"), ("GPL-2.0+", "GPL-2.0-or-later"),
        ("GPL-3.0-or-later", "GPL-3.0-or-later"), ("BSD-3-Clause", "BSD-3-Clause"), ("MIT-0", None),
        ("BSD-3-Clause-Clear", None), ("MIT OR Apache-2.0", "Apache-2.0")]
CLAUSES = [("This project is released under the MIT License, see LICENSE.", "MIT"),
           ("It's licensed under the GNU General Public License, version 2 or later.", "GPL-2.0-or-later"),
           ("Licensed under the GNU General Public License, version 2, or (at your option)\n"
            "any later version.", "GPL-2.0-or-later"),
           ("Licensed under the GNU General Public License, version 2 or newer", None),
           ("Licensed under the GNU General Public License, version 2.1", None),
           ("This is not licensed under the MIT License.", None),
           ("It isn't licensed under the MIT License.", None),
           ("Licensed under the Apache. License version 2.0", None)]


def comment(text, lead, first="", last=""):
    return first + "\n".join((lead + line).rstrip() for line in text.split("\n")) + last


@pytest.mark.parametrize("form", [
    lambda t: t,
    lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
    lambda t: t.replace("\n", "\r\n"),
    lambda t: comment(t, "# ", "#!/bin/sh\n", "\nexit 0"),
    lambda t: comment(t, "// "),
    lambda t: comment(t, " * ", "/*\n", "\n */\nint x;"),
    lambda t: comment(t, ".. "),
    lambda t: "\n".join(f"/* {line:78} */" for line in t.split("\n"))],
    ids=["wrapped", "unwrapped", "crlf", "hash", "slashes", "stars", "dots", "box"])
def test_standard_texts(docs, form):
    texts = [(form(t), want) for t, want in WHOLE]
    texts += [(form(f"x\n\nSPDX-License-Identifier: {tag}\n\ny"), want) for tag, want in TAGS]
    got = {r.doc_id: r.license for r in L.scan(docs([(i, t) for i, (t, _) in enumerate(texts)])).collect()}
    assert [got[i] for i in range(len(texts))] == [want for _, want in texts]


def test_clauses_inside_longer_sentences(docs):
    got = {r.doc_id: r.license for r in L.scan(docs([(i, t) for i, (t, _) in enumerate(CLAUSES)])).collect()}
    assert [got[i] for i in range(len(CLAUSES))] == [want for _, want in CLAUSES]
