"""Masking and pseudonymisation as Column functions.

No Python UDFs: every function is a composition of built-in expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wapspark.functions.scalar import _c, ColumnOrName, pg_concat

# Fixed value: salt used when none (or an empty one) is configured.
DEFAULT_SALT = "DEFAULT_SALT_CHANGE_ME"


def mask_email(c: ColumnOrName, strict: bool = True) -> Column:
    """NULL → NULL; ≤5 characters → ``***``; else first 2 + ``***`` + the
    domain from ``@``. Without ``@`` the reference form (strict=False) leaks
    the whole value after the prefix; strict=True keeps only the prefix."""
    s = _c(c).cast("string")
    at = F.position(F.lit("@"), s)
    tail = F.right(s, F.length(s) - at + 1)
    if strict:
        tail = F.when(at > 0, tail).otherwise(F.lit(""))
    return (F.when(s.isNull(), F.lit(None).cast("string"))
             .when(F.length(s) <= 5, F.lit("***"))
             .otherwise(F.concat(F.left(s, F.lit(2)), F.lit("***"), tail)))


def mask_id(c: ColumnOrName) -> Column:
    """≤8 characters → ``****``; else first 2 + ``****`` + last 4."""
    s = _c(c).cast("string")
    return (F.when(s.isNull(), F.lit(None).cast("string"))
             .when(F.length(s) <= 8, F.lit("****"))
             .otherwise(F.concat(F.left(s, F.lit(2)), F.lit("****"), F.right(s, F.lit(4)))))


def mask_name(c: ColumnOrName) -> Column:
    s = _c(c).cast("string")
    return F.when(s.isNotNull(), F.concat(F.left(s, F.lit(1)), F.lit("***")))


def pseudonymize(c: ColumnOrName, salt: str | None = None) -> Column:
    """``'U_' || md5(salt || id)[1:16]``; NULL id → NULL."""
    salt = salt or DEFAULT_SALT
    s = _c(c).cast("string")
    return F.when(s.isNotNull(),
                  F.concat(F.lit("U_"), F.substring(F.md5(F.concat(F.lit(salt), s)), 1, 16)))


def md5_user_tag(c: ColumnOrName) -> Column:
    """``CONCAT('user_', MD5(id::TEXT))``; NULL id → ``'user_'`` (P5)."""
    return pg_concat(F.lit("user_"), F.md5(_c(c).cast("string")))


def md5_short_tag(c: ColumnOrName) -> Column:
    """``CONCAT('U', LEFT(MD5(id::TEXT), 8))``."""
    return pg_concat(F.lit("U"), F.left(F.md5(_c(c).cast("string")), F.lit(8)))


def mask_keep_last(c: ColumnOrName, visible_digits: int = 4, mask_char: str = "*") -> Column:
    """Replace all but the last ``visible_digits`` characters by ``mask_char``;
    values no longer than ``visible_digits`` pass unchanged (P7)."""
    s = _c(c).cast("string")
    hidden = F.greatest(F.length(s) - visible_digits, F.lit(0))
    return F.when(s.isNotNull(),
                  F.concat(F.repeat(F.lit(mask_char), hidden), F.right(s, F.lit(visible_digits))))


def register_sql_functions(spark: SparkSession, salt: str | None = None) -> None:
    """Expose the pseudonym to SQL users as a temporary SQL function."""
    salt = (salt or DEFAULT_SALT).replace("'", "''")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION pseudonymize_user(original_id INT) "
        "RETURNS STRING RETURN CASE WHEN original_id IS NULL THEN NULL ELSE "
        f"concat('U_', substring(md5(concat('{salt}', cast(original_id AS STRING))), 1, 16)) END")


# Rule registry for configuration-driven masking (P7, Z3). Each entry maps
# a column and its params to the masked Column.
MASKERS: dict[str, Callable[..., Column]] = {
    "mask_transaction_id": lambda col, p: mask_keep_last(
        col, int(p.get("visible_digits", 4)), str(p.get("mask_char", "*"))),
    "mask_keep_last": lambda col, p: mask_keep_last(
        col, int(p.get("visible_digits", 4)), str(p.get("mask_char", "*"))),
    "mask_email": lambda col, p: mask_email(col, bool(p.get("strict", True))),
    "mask_id": lambda col, p: mask_id(col),
    "mask_name": lambda col, p: mask_name(col),
    "pseudonymize": lambda col, p: pseudonymize(col, p.get("salt")),
}


def register_masker(name: str, fn: Callable[..., Column]) -> None:
    MASKERS[name] = fn


def load_masking_rules(path: str) -> dict:
    """Read a masking config ``{fields: {col: {type, params}}, default_action}``
    (a small driver-side config file, not data)."""
    with open(path, encoding="utf-8") as fh:
        return json.load(fh)


def apply_masking(df: DataFrame, rules: dict, on_unknown: str = "fail") -> DataFrame:
    """Apply every configured rule in one projection. Fields absent from the
    frame are skipped. Unknown rule types fail unless ``on_unknown='keep'``."""
    out = {}
    for field, rule in (rules.get("fields") or {}).items():
        if field not in df.columns:
            continue
        fn = MASKERS.get(rule.get("type"))
        if fn is None:
            if on_unknown == "keep":
                continue
            raise ValueError(f"unknown masking rule type {rule.get('type')!r} for {field}")
        out[field] = fn(F.col(field), rule.get("params") or {})
    return df.withColumns(out) if out else df
