"""Secret scans with linked parts (operator 8), DataFrame functions only.

Base spans (assigned values, access identifiers, hexadecimal runs) are found by
pattern. Weaker parts (shorter or unnamed identifiers, bare tokens, endpoints)
say nothing alone: an interval join over scopes of code points links parts of
a text, and a weak one is reported only where its complement stands nearby:

* a bare token beside an identifier or an endpoint,
* an identifier beside a secret,
* an endpoint beside both an identifier and a secret.

Matches and what stands between them are cut out once a pattern and zipped;
their positions come from running totals of these lengths, a window within one
text, so a text with many matches costs no more than sorting them. Spans depend
on the text only: copies are scanned for links once, by two hashes of the text.
A scope's cell holds a bounded number of parts, for every part has a least
length. ``redact`` cuts a text into pages of bounded length, removes spans page
by page and joins the pages again.

Defined results: a null or empty text has no spans; rows with null or repeated
ids are reported one by one; an empty table gives no rows; other columns are
ignored by ``scan`` and carried through unchanged by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wapspark.session import ensure_checkpoint_dir

SCOPE = 200  # code points between parts that belong together, at most
PAGE = 2000  # code points of a page that is redacted at once

# Kinds of spans, their order where starts are equal, and their patterns
# (fixed values). A match of ``assign`` counts if its value has 6 characters.
ASSIGN = (r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
WEAK = {
    "identifier": (r"""(?i)\b(?:access_key_id|client_id|account_id|user_?name|login)["']?\x20*"""
                   r"""[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}|\b(?-i:A[KS]IA[A-Z0-9]{8,15})\b"""),
    "bare": r"(?<![A-Za-z0-9+/=_-])(?=[a-z0-9+/]*[A-Z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{32,}={0,2}",
    "endpoint": r"""(?i)\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)"""
                r"""://[^\x09-\x0D\x20"'<>]{4,}""",
}
# A substring that a text must hold for a pattern to match, if there is one.
_NEEDS = {"access": "AKIA", "endpoint": "://"}
KINDS = [*BASE, *WEAK]
_SECRET, _IDENTIFIER = ["assign", "hex", "bare"], ["access", "identifier"]
_KEY = ["k1", "k2"]


def _hits(text: Column, kind: str) -> Column:
    """Per match: its kind, place among the matches, length of what stands
    between it and the one before, its own length, and whether it counts."""
    pattern = {**BASE, **WEAK}[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    good = (lambda m: F.length(F.regexp_extract(m, pattern, 1)) >= 6) if kind == "assign" else (
        lambda m: F.lit(True))
    # Zipped outside of the lambda, which is evaluated for each match. What
    # follows the last match has no partner.
    both = F.filter(F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
                    lambda z: z["m"].isNotNull())
    rows = F.transform(both, lambda z, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"),
        F.length(z["g"]).cast("long").alias("gap"), F.length(z["m"]).cast("long").alias("len"),
        good(z["m"]).alias("good")))
    may = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else text.rlike(pattern)
    return F.when(may, rows)


def _spans(rows: DataFrame) -> DataFrame:
    """Parts of each text key: kind, start and end (exclusive), code points."""
    each = rows.select(*_KEY, F.explode("hits").alias("h")).select(*_KEY, "h.*")
    order = Window.partitionBy(*_KEY, "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(order)
    return (each.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
            .filter("good").select(*_KEY, "kind", "start", "end"))


def _cells(start: Column, end: Column) -> Column:
    """Every scope that an interval touches."""
    return F.explode(F.sequence(F.floor(start / SCOPE), F.floor(end / SCOPE)))


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Parts of ``left`` with a part of ``right`` at most ``SCOPE`` away, by an
    interval join over cells."""
    wide = left.withColumn("cell", _cells(F.greatest(F.col("start") - SCOPE, F.lit(0)),
                                         F.col("end") + SCOPE))
    others = right.select(*[F.col(c).alias(f"r_{c}") for c in (*_KEY, "kind", "start", "end")])
    others = others.withColumn("r_cell", _cells(F.col("r_start"), F.col("r_end")))
    near = (F.expr("k1 = r_k1 and k2 = r_k2 and cell = r_cell")
            & (F.col("r_start") <= F.col("end") + SCOPE) & (F.col("start") <= F.col("r_end") + SCOPE)
            & ~F.expr("kind = r_kind and start = r_start"))
    return wide.join(others, near, "left_semi").drop("cell").distinct()


def _of(parts: DataFrame, kinds: list[str]) -> DataFrame:
    return parts.filter(F.col("kind").isin([KINDS.index(k) for k in kinds]))


def _linked(parts: DataFrame) -> DataFrame:
    """Weak parts whose complement stands nearby and that no base span meets."""
    secret, identifier = _of(parts, _SECRET), _of(parts, _IDENTIFIER)
    endpoint = _of(parts, ["endpoint"])
    found = (_beside(_of(parts, ["bare"]), identifier.union(endpoint))
             .union(_beside(_of(parts, ["identifier"]), secret))
             .union(_beside(_beside(endpoint, identifier), secret)))
    base = _of(parts, list(BASE)).select(
        F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("start").alias("bs"),
        F.col("end").alias("be"), _cells(F.col("start"), F.col("end")).alias("b_cell"))
    met = found.withColumn("cell", _cells(F.col("start"), F.col("end"))).join(
        base, F.expr("k1 = b1 and k2 = b2 and cell = b_cell and start < be and bs < end"),
        "left_semi").select(*_KEY, "kind", "start").distinct()
    return found.join(met, [*_KEY, "kind", "start"], "left_anti").select(*parts.columns)


def _keyed(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the text's hashes and its matches of all kinds."""
    kinds = [F.coalesce(_hits(text, k), F.array().cast(
        "array<struct<kind:int,i:int,gap:bigint,len:bigint,good:boolean>>")) for k in KINDS]
    return (docs.withColumn("k1", F.xxhash64(text)).withColumn("k2", F.crc32(text))
            .withColumn("hits", F.concat(*kinds)))


def _reports(keyed: DataFrame) -> DataFrame:
    """Per text key with spans: arrays of base spans and of all spans."""
    once = keyed.filter("size(hits) > 0").groupBy(*_KEY).agg(F.first("hits").alias("hits"))
    parts = _spans(once).checkpoint()
    base = _of(parts, list(BASE)).withColumn("base", F.lit(True))
    span = base.union(_linked(parts).withColumn("base", F.lit(False)))
    listed = span.groupBy(*_KEY).agg(F.array_sort(F.collect_list(
        F.struct("start", "kind", "end", "base"))).alias("spans"))
    return listed.withColumn("base", F.filter("spans", lambda s: s["base"]))


def _count(kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_assign``, ``n_access``, ``n_hex``, ``base`` and
    ``spans`` (kind:start:end, by start and kind, joined by commas)."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    keyed = _keyed(rows, F.col("text")).select("doc_id", *_KEY, "hits").checkpoint()
    found = _reports(keyed).select(
        *_KEY, *[_count(k).alias(f"n_{k}") for k in BASE],
        _text_of(F.col("base")).alias("base"), _text_of(F.col("spans")).alias("spans"))
    return keyed.select("doc_id", *_KEY).join(found, _KEY, "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span (overlapping ones as one) replaced by
    ``mark``. Texts without any match pass by without a shuffle."""
    ensure_checkpoint_dir(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col(f"row.{text_col}")
    some = F.lit(False)
    for kind, pattern in {**BASE, **WEAK}.items():
        may = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else text.rlike(pattern)
        some = some | F.coalesce(may, F.lit(False))
    marked = docs.select(row).withColumn("some", some)
    clean = marked.filter(~F.col("some")).select("row.*")
    keyed = _keyed(marked.filter("some").select("row"), text)
    spans = _reports(keyed.select(*_KEY, "hits")).select(*_KEY, F.explode("spans").alias("s")).select(
        *_KEY, F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    # Overlapping spans as one: a span beyond all ends before it begins anew.
    order = Window.partitionBy(*_KEY).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = (spans.withColumn("fresh", F.when(F.col("start") < before, 0).otherwise(1))
           .withColumn("nth", F.sum("fresh").over(upto)).groupBy(*_KEY, "nth")
           .agg(F.min("start").alias("s"), F.max("end").alias("e")))
    cut = (one.withColumn("page", F.explode(F.sequence(F.expr(f"s div {PAGE}"),
                                                       F.expr(f"(e - 1) div {PAGE}"))))
           .groupBy(*_KEY, "page").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("cut")))
    pages = keyed.groupBy(*_KEY).agg(F.first(text).alias("t")).select(*_KEY, F.posexplode(
        F.regexp_extract_all("t", F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))).alias("p", "piece")).select(
        *_KEY, F.col("p").cast("long").alias("page"), "piece")
    pages = pages.join(cut, [*_KEY, "page"], "left")
    low = F.col("page") * PAGE
    # Of each span: what stands before it since the last one, and the mark
    # where the span begins on this page.
    last = F.transform("cut", lambda x: F.least(x["e"] - low, F.lit(PAGE).cast("long")))
    pairs = F.zip_with("cut", F.concat(F.array(F.lit(0).cast("long")), last), lambda x, b: F.struct(
        x["s"].alias("s"), b.alias("b")))
    kept = F.transform(F.filter(pairs, lambda z: z["s"].isNotNull()), lambda z: F.concat(
        F.substring("piece", (z["b"] + 1).cast("int"),
                    F.greatest(z["s"] - low - z["b"], F.lit(0)).cast("int")),
        F.when(z["s"] >= low, F.lit(mark)).otherwise(F.lit(""))))
    tail = F.substring("piece", (F.element_at(last, -1) + 1).cast("int"), F.lit(PAGE))
    pages = pages.withColumn("piece", F.when(F.col("cut").isNotNull(), F.concat(
        F.array_join(kept, ""), tail)).otherwise(F.col("piece")))
    texts = pages.groupBy(*_KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("page", "piece"))), lambda x: x["piece"]), "").alias("new"))
    joined = keyed.select("row", *_KEY).join(texts, _KEY, "left")
    new = F.coalesce("new", text)
    found = joined.select(F.col("row").withField(text_col, new).alias("row")).select("row.*")
    return clean.unionByName(found) if len(set(docs.columns)) == len(docs.columns) else clean.union(found)
