"""License scans by sentence rules (operator 2), DataFrame functions only.

A text is normalised (A-Z folded, marks and line breaks to spaces, comment
marks at a line's start dropped, ends of sentences kept) and searched for known
license sentences, each with an identifier. A known sentence may be wrapped over
lines and stand inside a longer one, but not go over a sentence's end; where
several fit, the longest counts. It doesn't count after a "not", nor before a
further number or an "or later" that it doesn't hold itself, and the sentence
of an SPDX tag counts only if nothing follows its identifier in the line. What a
tag's line holds beyond one identifier (OR, AND, WITH, parentheses) is read as an
expression: the identifiers of its licenses follow those of the sentences, in
their order, an exception after WITH aside; ``expressions`` returns the whole, for
only that tells a choice of licenses from several at once. The identifiers in a text's order are matched against
license rules: sequences of identifiers, tried in order of the list. A rule
takes the first place where its identifiers follow one another (unknown
sentences may stand between); an identifier that one rule has taken serves no
later one.

Both tables are parameters, small and fixed, and compiled into expressions: no
join and no shuffle. Only texts that hold a word of ``ANCHORS`` are normalised;
every known sentence must hold one.

Defined results: a null or empty text has no sentences and no license; rows
with null or repeated ids are scanned one by one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences (normalised) and their identifiers (fixed values).
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-2.0/notice",
    "you may not use this file except in compliance with the license": "apache-2.0/use",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-2.0/url",
    "spdx license identifier apache 2 0": "apache-2.0/spdx",
    "released under the mit license": "mit/notice",
    "licensed under the mit license": "mit/notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without restriction":
        "mit/grant",
    "spdx license identifier mit": "mit/spdx",
    "the software is provided as is without warranty of any kind": "as-is",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0/notice",
    "licensed under the gnu general public license version 3": "gpl-3.0/notice",
    "licensed under the gnu general public license version 2": "gpl-2.0/notice",
    "this program is free software you can redistribute it and or modify it under the terms of the"
    " gnu general public license": "gpl/free",
    "either version 3 of the license or at your option any later version": "gpl-3.0/later",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0/notice",
    "licensed under cc by 4 0": "cc-by-4.0/notice",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0/notice",
    "this work is licensed under a creative commons attribution 4 0 international license":
        "cc-by-4.0/notice",
    "redistribution and use in source and binary forms with or without modification are permitted":
        "bsd/grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products": "bsd/endorse",
    "all rights reserved": "reserved",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without restriction"
    " including without limitation the rights to use copy modify merge publish distribute sublicense"
    " and or sell copies of the software and to permit persons to whom the software is furnished to"
    " do so subject to the following conditions": "mit/grant",
    "the software is provided as is without warranty of any kind express or implied": "as-is",
    "licensed under the gnu general public license version 3 0": "gpl-3.0/notice",
    "licensed under the gnu general public license version 2 0": "gpl-2.0/notice",
    "either version 2 of the license or at your option any later version": "gpl-2.0/later",
    "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met": "bsd/grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission": "bsd/endorse",
    # The holder's own name may stand before it.
    "nor the names of its contributors may be used to endorse or promote products derived from this"
    " software without specific prior written permission": "bsd/endorse",
}
_FREE = ("this program is free software you can redistribute it and or modify it under the terms of"
         " the gnu general public license")
for _v in ("2", "3"):
    SENTENCES |= {f"{_FREE} as published by the free software foundation version {_v} of the license":
                  f"gpl-{_v}.0/only",
                  f"{_FREE} version {_v} as published by the free software foundation":
                  f"gpl-{_v}.0/only"}
    SENTENCES |= {f"licensed under the gnu general public license version {_v}{_dot} {_more}":
                  f"gpl-{_v}.0/notice-later" for _dot in ("", " 0") for _more in (
                      "or later", "or any later version", "or at your option any later version", "plus")}
    SENTENCES |= {f"spdx license identifier gpl {_v} 0{_more}": f"gpl-{_v}.0/spdx{_id}"
                  for _more, _id in (("", ""), (" only", ""), (" or later", "-later"),
                                     (" plus", "-later"))}
SENTENCES |= {f"spdx license identifier {_name}": f"{_id}/spdx" for _name, _id in (
    ("bsd 2 clause", "bsd-2-clause"), ("bsd 3 clause", "bsd-3-clause"), ("cc by 4 0", "cc-by-4.0"),
    ("cc by sa 4 0", "cc-by-sa-4.0"), ("cc by nc 4 0", "cc-by-nc-4.0"), ("mpl 2 0", "mpl-2.0"),
    ("isc", "isc"), ("unlicense", "unlicense"))}
SENTENCES |= {
    # Of version 2 alone; its "v." ends a sentence.
    "this source code form is subject to the terms of the mozilla public license v": "mpl-2.0/notice",
    "licensed under the mozilla public license version 2 0": "mpl-2.0/notice",
    "permission to use copy modify and or distribute this software for any purpose with or without"
    " fee is hereby granted": "isc/grant",
    "this is free and unencumbered software released into the public domain": "unlicense/notice",
    # Two licenses in one sentence.
    "licensed under either of apache license version 2 0": "apache-2.0/notice",
    "licensed under either the apache license version 2 0": "apache-2.0/notice",
    "or mit license": "mit/notice", "or the mit license": "mit/notice",
    "licensed under either of the mit license": "mit/notice",
    "licensed under either the mit license": "mit/notice",
    "or apache license version 2 0": "apache-2.0/notice",
    "or the apache license version 2 0": "apache-2.0/notice",
}
# The same family's other licenses: name in a sentence, identifier, versions.
for _name, _id, _versions in (("lesser general public license", "lgpl", ("2 1", "3", "3 0")),
                              ("affero general public license", "agpl", ("3", "3 0"))):
    for _v in _versions:
        _n = f"{_id}-{_v.replace(' ', '.') if ' ' in _v else _v + '.0'}"
        _by = (f"this program is free software you can redistribute it and or modify it under the"
               f" terms of the gnu {_name}", f"this library is free software you can redistribute it"
               f" and or modify it under the terms of the gnu {_name}")
        _later = "or at your option any later version"
        SENTENCES |= {f"licensed under the gnu {_name} version {_v}": f"{_n}/notice",
                      f"licensed under the gnu {_name} version {_v} or later": f"{_n}/notice-later",
                      f"licensed under the gnu {_name} version {_v} {_later}": f"{_n}/notice-later"}
        SENTENCES |= {f"{_b} as published by the free software foundation either version {_v} of the"
                      f" license {_later}": f"{_n}/notice-later" for _b in _by}
        SENTENCES |= {f"spdx license identifier {_id} {_v}{_more}": f"{_n}/spdx{_to}"
                      for _more, _to in (("", ""), (" only", ""), (" or later", "-later"),
                                         (" plus", "-later")) if " " in _v}

# Rules in the order in which they are tried: license and identifiers (fixed
# values); longer sequences before the shorter ones that they hold.
RULES = [
    ("Apache-2.0", ["apache-2.0/notice", "apache-2.0/use"]),
    ("Apache-2.0", ["apache-2.0/notice", "apache-2.0/url"]),
    ("Apache-2.0", ["apache-2.0/notice"]),
    ("Apache-2.0", ["apache-2.0/spdx"]),
    ("MIT", ["mit/grant", "as-is"]),
    ("MIT", ["mit/notice"]),
    ("MIT", ["mit/grant"]),
    ("MIT", ["mit/spdx"]),
    ("GPL-3.0-or-later", ["gpl/free", "gpl-3.0/later"]),
    ("GPL-3.0-only", ["gpl-3.0/notice"]),
    ("GPL-2.0-only", ["gpl-2.0/notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0/notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0/notice"]),
    ("CC-BY-4.0", ["cc-by-4.0/notice"]),
    ("BSD-3-Clause", ["bsd/grant", "bsd/endorse"]),
    ("BSD-2-Clause", ["bsd/grant"]),
    ("GPL-2.0-or-later", ["gpl/free", "gpl-2.0/later"]),
    ("GPL-3.0-or-later", ["gpl-3.0/notice-later"]),
    ("GPL-2.0-or-later", ["gpl-2.0/notice-later"]),
    ("GPL-3.0-only", ["gpl-3.0/only"]),
    ("GPL-2.0-only", ["gpl-2.0/only"]),
    ("GPL-3.0-only", ["gpl-3.0/spdx"]),
    ("GPL-3.0-or-later", ["gpl-3.0/spdx-later"]),
    ("GPL-2.0-only", ["gpl-2.0/spdx"]),
    ("GPL-2.0-or-later", ["gpl-2.0/spdx-later"]),
    ("BSD-3-Clause", ["bsd-3-clause/spdx"]),
    ("BSD-2-Clause", ["bsd-2-clause/spdx"]),
    ("CC-BY-4.0", ["cc-by-4.0/spdx"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4.0/spdx"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4.0/spdx"]),
    *[(_name, [f"{_name.lower()}/{_what}"]) for _name, _what in (
        ("MPL-2.0", "notice"), ("ISC", "grant"), ("Unlicense", "notice"),
        ("MPL-2.0", "spdx"), ("ISC", "spdx"), ("Unlicense", "spdx"))],
    *[(f"{_name}-{_to}", [f"{_name.lower()}/{_what}{_end}"])
      for _name in ("LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for _what in ("notice", "spdx")
      for _to, _end in (("only", ""), ("or-later", "-later"))],
]

# Every known sentence holds one of these (fixed values).
ANCHORS = ["licen", "permission", "redistribut", "provided as is", "rights reserved", "contributors",
           "public domain"]

# Marks in normalised texts: the end of a sentence (. ! or ? before white space
# or the end), and the end of a line.
STOP, LINE = "\x01", "\x02"
WORD = r"a-z0-9\x80-\x{10FFFF}"


def normalise(text: Column) -> Column:
    """A text's words in lower case, with spaces, STOP and LINE between."""
    out = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + STOP + LINE,
                      "abcdefghijklmnopqrstuvwxyz  ")
    # What leads a line, blank lines before it included, is a comment's mark.
    out = F.regexp_replace(out, rf"\n[^{WORD}]*+", LINE)
    out = F.regexp_replace(out, r"[.!?]+(?=[\x09-\x0D\x20\x02]|$)", STOP)
    out = F.regexp_replace(out, r"(?<=[0-9])\+", " plus ")
    return F.regexp_replace(out, rf"[^{WORD}{STOP}{LINE}]++", " ")


def _sentence_pattern(sentences: dict[str, str]) -> str:
    """Any known sentence in a normalised text, the longest first."""
    gap = f"[ {LINE}]+"
    whole = sorted(sentences, key=lambda s: (-len(s), s))
    tags = [s.replace(" ", gap) for s in whole if s.startswith("spdx ")]
    rest = [s.replace(" ", gap) for s in whole if not s.startswith("spdx ")]
    later = rf"(?:(?:or|and|to)[ {LINE}])?(?:at your option )?(?:any )?(?:later|newer|higher|plus)"
    negated = rf"(?<![^{WORD}](?:not|never|nor|not be)[ {LINE}]{{1,3}})" \
              rf"(?<!^(?:not|never|nor)[ {LINE}]{{1,3}})(?<!n[ \u2019]t[ {LINE}]{{1,3}})"
    ends = [rf"(?:{'|'.join(tags)})(?= ?(?:[{STOP}{LINE}]|$))"] if tags else []
    ends += [rf"(?:{'|'.join(rest)})(?![{WORD}])(?!{gap}(?:[0-9]|{later}))"] if rest else []
    return rf"(?<![{WORD}]){negated}(?:{'|'.join(ends)})"


def _identifiers(text: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of a text's known sentences, in their order."""
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    anchor = "(?i)" + "|".join(a.replace(" ", "[^A-Za-z0-9]+") for a in ANCHORS)
    hits = F.regexp_extract_all(normalise(text), F.lit(_sentence_pattern(sentences)), F.lit(0))
    ids = F.transform(hits, lambda s: F.try_element_at(
        known, F.regexp_replace(s, f"[ {LINE}]+", " ")))
    # A text without an anchor, and that is most, is not normalised.
    return F.coalesce(F.when(text.rlike(anchor), ids), F.array().cast("array<string>"))


# An SPDX tag with more than an identifier in its line; what is between the
# licenses of its expression, and an exception.
EXPRESSION = (r"(?i)spdx-license-identifier:[\x20\t]*([(\x20\t]*[a-z0-9.+-]+[)\x20\t]*(?:"
              r"[\x20\t]+(?:or|and|with)[\x20\t]+[(\x20\t]*[a-z0-9.+-]+[)\x20\t]*)+)"
              r"(?=-->|$|[\r\n]|[^a-z0-9.+\x20\t-])")
OPERATOR = r"(?i)[)\x20\t]*[\x20\t)](?:or|and)[\x20\t(][(\x20\t]*"
EXCEPTION = r"(?i)[\x20\t]+with[\x20\t]+[a-z0-9.+-]+"
TAG = "spdx license identifier "


def _expressions(text: Column) -> Column:
    """The compound expressions of a text's SPDX tags."""
    found = F.regexp_extract_all(text, F.lit(EXPRESSION), F.lit(1))
    spaced = F.transform(found, lambda e: F.trim(F.regexp_replace(e, r"[\x20\t]+", " ")))
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(text.rlike("(?i)spdx-license-identifier:"), spaced), none)


def _licenses_of(expressions: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of the known licenses in expressions, in their order."""
    tags = {k.removeprefix(TAG): v for k, v in sentences.items() if k.startswith(TAG)}
    if not tags:
        return F.array().cast("array<string>")
    known = F.create_map(*[F.lit(x) for pair in tags.items() for x in pair])
    names = F.flatten(F.transform(expressions, lambda e: F.split(
        F.regexp_replace(e, EXCEPTION, ""), OPERATOR)))
    plain = F.transform(names, lambda n: F.trim(F.regexp_replace(F.regexp_replace(
        F.lower(n), r"\+", " plus"), r"[^a-z0-9]+", " ")))
    return F.filter(F.transform(plain, lambda n: F.try_element_at(known, n)),
                    lambda i: i.isNotNull())


def _rule_pattern(ids: list[str]) -> str:
    """A rule over the identifiers' text ``|a|b|``: its identifiers in order,
    others between."""
    quoted = [r"\Q" + i + r"\E" for i in ids]
    return r"\|" + r"\|(?:[^|]+\|)*?".join(quoted) + r"(?=\|)"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sentences: dict[str, str] = SENTENCES, rules: list = RULES) -> DataFrame:
    """Per row: the id, ``n_sentences`` (known ones), ``sentence_ids`` (joined
    by commas), ``licenses`` (of all rules that match, in rule order, joined by
    commas) and ``license`` (of the first rule; null without one)."""
    missing = [s for s in sentences if not any(a in s for a in ANCHORS)]
    if missing:
        raise ValueError(f"no anchor in {missing}")
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.concat(
        _identifiers(text, sentences), _licenses_of(_expressions(text), sentences)).alias("ids"))
    state = F.struct(F.concat(F.lit("|"), F.array_join("ids", "|"), F.lit("|")).alias("left"),
                     F.array().cast("array<string>").alias("found"))
    listed = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_rule_pattern(ids)).alias("p"))
                       for name, ids in rules])
    matched = F.aggregate(listed, state, lambda s, r: F.when(
        F.regexp_like(s["left"], r["p"]), F.struct(
            F.regexp_replace(s["left"], r["p"], F.lit("|-")).alias("left"),
            F.concat(s["found"], F.array(r["name"])).alias("found"))).otherwise(s))
    none = F.array().cast("array<string>")
    found = F.when(F.size("ids") > 0, F.array_distinct(matched["found"])).otherwise(none)
    return rows.withColumn("found", found).select(
        "doc_id", F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"), F.array_join("found", ",").alias("licenses"),
        F.get("found", 0).alias("license"))


def expressions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``expressions``, the compound ones of its SPDX tags
    as written (an array, white space as one space each)."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       _expressions(F.coalesce(text_col, F.lit(""))).alias("expressions"))


def oracle_sql(table: str, sentences: dict[str, str] = SENTENCES, rules: list = RULES) -> str:
    """The same result by joins and windows over exploded sentences, as DuckDB
    SQL, for texts whose known sentences are sentences of one line each, without
    compound expressions; rules of at most two identifiers."""
    def rows(items):
        return ", ".join("(" + ", ".join(
            "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'" for x in r) + ")"
            for r in items)
    known = rows(sentences.items())
    wanted = rows((k, name, ids[0], ids[1] if len(ids) > 1 else None)
                  for k, (name, ids) in enumerate(rules))
    return f"""
WITH known(sentence, sid) AS (VALUES {known}),
rules(nr, name, a, b) AS (VALUES {wanted}),
cut AS (SELECT doc_id, unnest(string_split_regex(coalesce(text, ''),
            '[.!?]+([\\x09-\\x0D\\x20]|$)|\\n')) AS s,
        generate_subscripts(string_split_regex(coalesce(text, ''),
            '[.!?]+([\\x09-\\x0D\\x20]|$)|\\n'), 1) AS pos FROM {table}),
hits AS (SELECT doc_id, pos, sid FROM cut JOIN known ON sentence =
         trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'))),
found AS (SELECT doc_id, nr, name FROM rules r, (SELECT DISTINCT doc_id FROM hits) d
          WHERE EXISTS (SELECT 1 FROM hits x WHERE x.doc_id = d.doc_id AND x.sid = r.a
                        AND (r.b IS NULL OR EXISTS (SELECT 1 FROM hits y WHERE y.doc_id = d.doc_id
                                                    AND y.sid = r.b AND y.pos > x.pos)))),
names AS (SELECT doc_id, name, min(nr) AS nr FROM found GROUP BY doc_id, name)
SELECT t.doc_id, coalesce(h.n, 0)::BIGINT AS n_sentences, coalesce(h.ids, '') AS sentence_ids,
       coalesce(n.names, '') AS licenses, n.first AS license
FROM {table} t
LEFT JOIN (SELECT doc_id, count(*) n, string_agg(sid, ',' ORDER BY pos) ids FROM hits GROUP BY 1) h
    ON h.doc_id = t.doc_id
LEFT JOIN (SELECT doc_id, string_agg(name, ',' ORDER BY nr) names, arg_min(name, nr) AS first
           FROM names GROUP BY 1) n ON n.doc_id = t.doc_id"""
