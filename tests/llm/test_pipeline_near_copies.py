import re

import corpus_pipeline as P
from llm_fixtures import docs  # noqa: F401


def kept(rows):
    """Least ids of the groups by five-word Jaccard of 0.8 or more."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                up[max(find(i), find(j))] = min(find(i), find(j))
    return sorted(i for i in sets if find(i) == i)


def words(prefix, n):
    return [f"{prefix}{k}" for k in range(n)]


def test_five_words_and_four_fifths(spark, docs):
    base = words("a", 52)                                  # 48 sequences of five words
    changed = [*base[:47], *words("b", 5)]                 # 43 of 53: 0.81; of four words 44 of 54: 0.815
    apart = [*base[:46], *words("c", 6)]                   # 42 of 54: 0.78
    at = words("d", 13)                                    # 9 sequences
    rows = [(1, base), (2, changed), (3, apart), (4, at), (5, at[:12]), (6, [*at[:12], "x"]),
            (7, at[1:11]), (8, words("e", 4)), (9, words("f", 30)), (10, [*words("f", 29), "x"])]
    rows = [(i, " ".join(w)) for i, w in rows]
    want = kept(rows)
    assert 2 not in want and 3 in want
    got = P.drop_near_copies(spark, docs(rows), "")
    assert sorted(r.doc_id for r in got.collect()) == want


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("text is not null")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = P.drop_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == kept(rows)


def test_rows_without_an_id_stay(spark, docs):
    text = " ".join(words("a", 40))
    for rows in ([(1, text), (None, text)], [(1, text), (None, text), (None, text), (None, "b"), (2, None)],
                 [(None, text), (None, text)], [(3, text), (3, text), (3, "x y"), (4, text)]):
        got = sorted(((r.doc_id, r.text) for r in P.drop_near_copies(spark, docs(rows), "").collect()), key=str)
        want = [r for r in rows if r[0] is None] + sorted(
            {r for r in rows if r[0] is not None and not (r[1] == text and r[0] == 4)}, key=str)
        assert got == sorted(want, key=str)
