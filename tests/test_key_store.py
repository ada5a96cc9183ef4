"""P8–P11 at rest: only touched buckets are rewritten, revoked bytes stand nowhere."""

import datetime as dt
import glob
import os

import pytest

from wapspark.operators import shredding
from wapspark.operators.key_store import KeyStore
from wapspark.sources.versioned import VersionedTable

T0 = dt.datetime(2024, 1, 1)
M1, M2 = b"0123456789abcdef", b"fedcba9876543210"


def users(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id int")


def held(path):
    return b"".join(open(f, "rb").read() for f in glob.glob(f"{path}/**", recursive=True) if os.path.isfile(f))


def test_deletions_rewrite_their_buckets_only(spark, tmp_path):
    path = str(tmp_path / "keys")
    store = KeyStore(spark, path, "m1", M1, buckets=16)
    assert store.issue(users(spark, range(200)), as_of=T0) == 16
    assert store.issue(users(spark, range(200)), as_of=T0) == 0
    data = spark.createDataFrame([(i, f"name {i}") for i in range(200)], "user_id int, name string")
    enc = shredding.encrypt_column(data, "user_id", "name", store.keys(), "c")[0].checkpoint()
    before = store.table.manifest()["parts"]
    wrapped = {r.user_id: bytes(r.wrapped_key) for r in store.table.read().collect()}
    plain = {r.user_id: bytes(r.encryption_key) for r in store.keys().collect()}
    assert not any(k in held(path) for k in plain.values()) and wrapped[7] in held(path)
    done, touched = store.delete(users(spark, [7, 999]), as_of=T0)
    assert touched <= 2 and sorted(r.user_id for r in done.collect()) == [7, 999]
    after = store.table.manifest()["parts"]
    assert sum(before[p] != after[p] for p in before) == touched
    assert wrapped[7] not in held(path) and wrapped[8] in held(path)
    read = {r.user_id: r.name for r in shredding.decrypt_column(enc, "user_id", "c", store.keys(), "name").collect()}
    assert read == {i: None if i == 7 else f"name {i}" for i in range(200)}
    # a user that comes again gets a new key, the old data stays unreadable
    assert store.issue(users(spark, [7]), as_of=T0) == 1
    again = {r.key_version: r.is_active for r in store.keys().filter("user_id = 7").collect()}
    assert again == {1: False, 2: True}


def test_a_new_master_opens_what_the_old_one_no_longer_does(spark, tmp_path):
    path = str(tmp_path / "keys")
    store = KeyStore(spark, path, "m1", M1, buckets=4)
    store.issue(users(spark, range(20)), as_of=T0)
    plain = {r.user_id: bytes(r.encryption_key) for r in store.keys().collect()}
    store.rotate_master("m2", M2)
    fresh = KeyStore(spark, path, "m2", M2, buckets=4)
    assert {r.user_id: bytes(r.encryption_key) for r in fresh.keys().collect()} == plain
    with pytest.raises(Exception, match="AES"):
        KeyStore(spark, path, "m1", M1, buckets=4).keys().collect()
    assert M2.hex().upper() not in fresh.keys()._jdf.queryExecution().toString().upper()
    assert KeyStore(spark, str(tmp_path / "none"), "m", M1).keys().count() == 0


def test_a_crash_leaves_the_keys_as_they_were(spark, tmp_path, monkeypatch):
    store = KeyStore(spark, str(tmp_path / "keys"), "m1", M1, buckets=4)
    store.issue(users(spark, range(20)), as_of=T0, test_seed="s")

    def dies(self, version, content):
        raise RuntimeError("died")
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_put", dies)
        with pytest.raises(RuntimeError, match="died"):
            store.delete(users(spark, [3]), as_of=T0)
    assert store.keys().filter("is_active").count() == 20
    store.delete(users(spark, [3]), as_of=T0)
    assert store.keys().filter("is_active").count() == 19
