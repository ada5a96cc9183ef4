import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from wapspark.llm import packing as K
from llm_fixtures import docs  # noqa: F401

PATH = P.path("byte_bpe_50k.json")


def ids_of(rows):
    t = Tokenizer.from_file(PATH)
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4") for _, x in rows]


def check(rows, pieces, most_padding):
    """Every id in one piece, sums right, sequences gapless, little padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for (d, _), ids in zip(rows, ids_of(rows)):
        own = sorted(by_doc[d], key=lambda p: p.start)
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own]))[:-1]
        assert sum(p.length for p in own) == len(ids)
        for p in own:
            assert p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    padding = 0
    for own in by_seq.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0] + [p.length for p in own]))[:-1]
        total = sum(p.length for p in own)
        assert total <= 2048
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    assert padding <= most_padding
    assert sorted(by_seq) == list(range(len(by_seq)))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_documents_pack_without_padding(spark, sf):
    d = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    check(rows, K.pack(d, PATH).collect(), 2048)


def test_odd_texts(docs):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (4, "<|endoftext|>"), (8, "a <|endoftext|> b"),
            (9, "<|endof"), (10, "text|><|endoftext|><|endoftext|>"), (5, "a​ \x1c z"),
            (6, "x " * 2046 + "x"), (7, "  \n")]
    check(rows, K.pack(docs(rows), PATH).collect(), 2 * 2048)
    assert K.pack(docs([]), PATH).count() == 0


def test_repeated_and_null_ids(docs):
    rows = [(None, "one two three"), (None, "one two three"), (5, "four"), (5, "four five")]
    got = K.pack(docs(rows), PATH).collect()
    assert sum(p.length for p in got) == sum(map(len, ids_of(rows)))
    assert sum(p.start == 0 for p in got) == 4


@pytest.mark.parametrize("seed", range(3))
def test_patterns_meet_demand_near_the_bound(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = K.length_classes(2048)
    assert sizes[-1] == 2048 and (np.diff(sizes) > 0).all() and len(sizes) < 200
    demand = rng.integers(0, 400, len(sizes)) * (rng.random(len(sizes)) < .6)
    counts = spark.createDataFrame([(c, int(n)) for c, n in enumerate(demand)], "class int, n long")
    slots = counts.coalesce(1).mapInArrow(K._solve(sizes, 2048), K._SLOTS).collect()
    used, met = defaultdict(int), np.zeros(len(sizes), int)
    for r in slots:
        met[r["class"]] += r.hi - r.lo
        for k in range((r.hi - r.lo) // r.per):
            used[r.base + k] += r.per * sizes[r["class"]]
    assert (met == demand).all()
    assert max(used.values()) <= 2048 and len(used) == slots[0].end
    assert len(used) <= 1.1 * (demand @ sizes) / 2048 + 3


def test_no_items():
    patterns, times = K.cutting_stock(K.length_classes(64), np.zeros(len(K.length_classes(64))), 64)
    assert len(patterns) == 0 and len(times) == 0
