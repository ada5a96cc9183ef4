import re
from collections import Counter

import pytest

from wapspark.llm import quality_rules as Q
from llm_fixtures import docs  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(words, size):
    seen = Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    got = set()
    for i in range(len(words) - size + 1):
        if seen[tuple(words[i:i + size])] > 1:
            got.update(range(i, i + size))
    return got


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, words))
    repeat = len(covered(words, 3))
    out = {"n_words": len(words), "word_chars": chars,
           "n_symbols": sum(c in "#*$%&|<>" for c in text),
           "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeat}
    out["base_failed"] = len(words) < 50 or 100 * repeat > 50 * len(words)
    shares = [sum(len(words[i]) for i in covered(words, k)) / max(chars, 1) for k in range(5, 11)]
    seen = Counter(lines)
    shares.append(sum(sum(map(len, WORD.findall(x))) for x in lines if seen[x] > 1) / max(chars, 1))
    out["kept"] = not out["base_failed"] and max(shares) <= 0.5
    out["coverage_10"], out["line_coverage"] = shares[5], shares[6]
    return out


TEXTS = ["", None, "  \n\t", "one", "a\na\n\na \n", "é# ü$ <x>|&%*\n" * 40,
         " ".join(f"w{i}" for i in range(60)), "\n".join(f"line {i} é" for i in range(40)),
         "\n".join(["the same long line of words here"] * 3 + [f"x{i}" for i in range(200)]),
         "x" * 5000, "a b c\x0bd\x0ce\rf g  h\n" * 30, "word " * 3000]


def check(rows, got):
    assert len(got) == len(rows)
    for (i, text), r in zip(rows, sorted(got, key=lambda r: r["doc_id"])):
        for k, v in brute(text).items():
            assert r[k] == (pytest.approx(v) if isinstance(v, float) else v), (i, k)


def test_matches_brute_force_on_odd_texts(docs):
    rows = list(enumerate(TEXTS))
    check(rows, Q.measure(docs(rows)).collect())


def test_matches_brute_force_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in d.collect())
    check(rows, Q.measure(d).collect())


def test_keep_carries_all_columns_and_rows_repeat(docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, good), (1, good), (2, "junk " * 100), (None, good), (3, None)]
    d = docs(rows)
    kept = Q.keep(d)
    assert kept.columns == d.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [
        (False, 1), (False, 1), (True, None)]
    assert Q.measure(docs([])).count() == 0 and Q.keep(docs([])).count() == 0


def test_chunks_do_not_change_results(docs, monkeypatch):
    rows = list(enumerate(TEXTS))
    whole = {r["doc_id"]: r for r in Q.measure(docs(rows)).collect()}
    import pyarrow as pa
    from wapspark.llm import words as W
    for size in (1, 17, 4000):
        at = 0
        for chunk in W.text_chunks(pa.array(TEXTS), size):
            got = Q.measure_chunk(chunk, Q.Limits())
            for r in range(chunk.rows):
                assert got["n_repeat_words"][r] == whole[at]["n_repeat_words"]
                assert got["kept"][r] == whole[at]["kept"]
                at += 1
        assert at == len(TEXTS)
