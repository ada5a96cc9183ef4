import re

import duckdb

from wapspark.llm import license_scan as L
from llm_fixtures import docs  # noqa: F401

MARKS = re.compile(r"[^a-z0-9\x80-\U0010FFFF]+")


def brute(text):
    """Identifiers, then rules in order, each taking its identifiers."""
    ids = []
    for s in re.split(r"[.!?]+(?=[\x09-\x0D\x20]|\Z)|\n", text or ""):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
        found = L.SENTENCES.get(MARKS.sub(" ", low).strip(" "))
        ids += [found] if found else []
    left, names = list(ids), []
    for name, rule in L.RULES:
        matched = False
        while True:
            at, place = [], 0
            for want in rule:
                place = next((i for i in range(place, len(left)) if left[i] == want), None)
                if place is None:
                    break
                at.append(place)
                place += 1
            if len(at) < len(rule):
                break
            matched = True
            left[at[0]:at[-1] + 1] = [None] * (at[-1] + 1 - at[0])
        names += [name] if matched and name not in names else []
    return len(ids), ",".join(ids), ",".join(names), names[0] if names else None


APACHE = "Licensed under the Apache License, Version 2.0."
TEXTS = [None, "", APACHE, "x\n" + APACHE + " More text. You may not use this file except in compliance"
         " with the License.\ny", "Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
         "This work is licensed  under the GNU General Public License, version 3.",
         "licensed under nothing at all", "All rights reserved. " * 2000,
         "Not licensed under the Apache License, Version 2.0.", APACHE.upper(),
         "This program is free software: you can redistribute it and/or modify it under the terms of"
         " the GNU General Public License.\nEither version 3 of the License, or (at your option) any"
         " later version.", APACHE + "\n" + APACHE]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_matches_brute_force(docs, spark):
    rows = list(enumerate(TEXTS)) + [(None, APACHE), (None, APACHE), (3, "x")]
    assert rows_of(L.scan(docs(rows))) == sorted(((i, *brute(t)) for i, t in rows), key=str)
    assert L.scan(docs([])).count() == 0


def test_documents_match_sql_and_brute_force(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    got = rows_of(L.scan(spark.read.parquet(path)))
    assert any(r[4] for r in got)
    texts = dict(duckdb.execute(f"select doc_id, text from '{path}'").fetchall())
    assert got == sorted(((i, *brute(t)) for i, t in texts.items()), key=str)
    assert got == sorted(duckdb.execute(L.oracle_sql(f"'{path}'")).fetchall(), key=str)


def test_plan_has_no_python_and_no_shuffle(docs):
    plan = L.scan(docs([(1, APACHE)]))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Exchange"))
