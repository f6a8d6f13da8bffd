"""Canonical exact document fingerprints, DataFrame expressions only.

The canonical form of a text is its compatibility composition (NFKC), case-folded, composed again, with every run of
white space as one space and none at the ends. Its fingerprint is a 128-bit xxhash (two 64-bit hashes of different
prefixes). Texts of one hash are then compared byte for byte: where canonical forms differ, all but the first in byte
order get a suffix, so equal fingerprints mean equal canonical forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.common import small_side, written

# Static methods of the Unicode library that Spark's collations come with.
NORMALIZER, CHARACTERS = "com.ibm.icu.text.Normalizer", "com.ibm.icu.lang.UCharacter"

HASH = ["h1", "h2"]


def canonical(text: Column) -> Column:
    """The canonical form. Texts that are ASCII throughout need no Unicode tables."""
    composed = F.reflect(F.lit(NORMALIZER), F.lit("compose"), text, F.lit(True))
    folded = F.reflect(F.lit(CHARACTERS), F.lit("foldCase"), composed, F.lit(True))
    full = F.reflect(F.lit(NORMALIZER), F.lit("compose"), folded, F.lit(True))
    form = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(full)
    return F.trim(F.regexp_replace(form, r"(?U)\s+", " "))


def hashes(form: Column) -> list[Column]:
    return [F.xxhash64(F.lit(p), form) for p in ("a", "b")]


def text_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, r): null texts as empty; r tells rows of one doc_id apart by their texts."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("r", F.xxhash64("text"))


def rising_buckets(rows: DataFrame, per_bucket: int, segments: int) -> tuple[dict, dict, Column, int]:
    """Columns to add in two steps, a bucket number from them that rises with (doc_id, r), and how many buckets there are.

    A bucket has about per_bucket rows.

    Quantiles of doc_id cut the ids into segments, each of which has buckets of equal width between its least and greatest id;
    an id so frequent that it fills a segment is dealt by r. What the driver sees is bounded by segments.
    """
    n = rows.count()
    segments = max(1, min(segments, n // per_bucket))
    cuts = rows.agg(F.percentile_approx("doc_id", F.lit([k / segments for k in range(1, segments + 1)]), F.lit(20 * segments)).alias("q")).first().q or []
    often = {a for a, b in zip(cuts, cuts[1:], strict=False) if a == b}
    starts = sorted(set(cuts) | {a + 1 for a in often if a < 2**63 - 1})
    steps = [1 << k for k in range(len(starts).bit_length() - 1, -1, -1)]
    held = F.lit(starts) if starts else F.array().cast("array<bigint>")
    # the number of starts that are not above the id, by bisection
    segment = F.aggregate(F.lit(steps or [1]), F.lit(0), lambda at, s: F.when(F.get(held, at + s - 1) <= F.col("doc_id"), at + s).otherwise(at))
    found = {r.s: r for r in rows.groupBy(segment.alias("s")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).collect()}
    low, width, buckets, alone, base, total = [], [], [], [], [], 0
    for s in range(len(starts) + 1):
        r = found.get(s)
        low.append(float(r.low) if r else 0.0)
        buckets.append(max(1, r.n // per_bucket) if r else 1)
        width.append(max(1.0, (r.high - r.low) / buckets[-1]) if r else 1.0)
        alone.append(bool(r) and r.low == r.high)
        base.append(total)
        total += buckets[-1]
    of = lambda values: F.get(F.lit(values), F.col("s"))
    by_id = (F.col("doc_id").cast("double") - F.col("low")) / F.col("width")  # doubles keep the order
    by_r = (F.col("r") / F.lit(2.0**64) + 0.5) * F.col("buckets")
    sub = F.least(F.floor(F.when(F.col("alone"), by_r).otherwise(by_id)), F.col("buckets") - 1)
    return {"s": segment}, {"low": of(low), "width": of(width), "buckets": of(buckets), "alone": of(alone), "base": of(base)}, F.col("base") + sub, total


def following(keys: DataFrame, count: int, fan: int = 4096) -> DataFrame:
    """(b, next_b) of distinct numbers b below count: the next smaller one there is, the greatest after the smallest."""
    if count <= fan:  # at most fan rows
        w = Window.orderBy(F.desc("b"))
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return keys.select("b", F.coalesce(F.lead("b").over(w), F.first("b").over(whole)).alias("next_b"))
    keys = keys.withColumn("upper", F.expr(f"b div {fan}"))
    after = keys.withColumn("next_b", F.lead("b").over(Window.partitionBy("upper").orderBy(F.desc("b"))))
    tops = keys.groupBy("upper").agg(F.max("b").alias("top"))
    over = following(tops.select(F.col("upper").alias("b")), -(-count // fan), fan).withColumnsRenamed({"b": "upper", "next_b": "next_upper"})
    over = over.join(tops.withColumnRenamed("upper", "next_upper"), "next_upper").select("upper", "top")
    return after.join(over, "upper").select("b", F.coalesce("next_b", "top").alias("next_b"))


def with_next(rows: DataFrame, per_bucket: int = 64, segments: int = 1024, many: int = 256) -> DataFrame:
    """Add next_id, next_r and next_text: the row that follows in descending (doc_id, r) order, the first after the last.

    Rows are dealt to buckets of neighbours of about per_bucket rows; a bucket's last row takes the first of the next bucket
    that has rows, which is found over buckets, buckets of buckets and so on, so no task sees all rows. Rows without doc_id
    stand outside the circle and have no next row. A row that occurs more than many times stands in the circle once; its other
    copies, which no bucket could part, follow each other.
    """
    none = {"next_id": F.lit(None).cast("long"), "next_r": F.lit(None).cast("long"), "next_text": F.lit(None).cast("string")}
    outside = rows.where("doc_id is null").withColumns(none)
    rows = rows.where("doc_id is not null")
    repeated = written(rows.groupBy("doc_id", "r").agg(F.count("*").alias("n")).where(F.col("n") > many).select("doc_id", "r"), "repeated")
    if repeated.take(1):
        side = small_side(repeated)
        grouped = rows.join(side, ["doc_id", "r"], "left_semi").groupBy("doc_id", "text", "r").agg(F.count("*").alias("n"))
        own = {"next_id": F.col("doc_id"), "next_r": F.col("r"), "next_text": F.col("text"), "copy": F.explode(F.sequence(F.lit(2), F.col("n")))}
        outside = outside.unionByName(grouped.where("n > 1").withColumns(own).drop("n", "copy"))
        rows = rows.join(side, ["doc_id", "r"], "left_anti").select("doc_id", "text", "r").unionByName(grouped.drop("n"))
    segment, values, bucket, count = rising_buckets(rows.select("doc_id", "r"), per_bucket, segments)
    rows = rows.withColumns(segment).withColumns(values).select("doc_id", "text", "r", bucket.cast("long").alias("b"))
    w = Window.partitionBy("b").orderBy(F.desc("doc_id"), F.desc("r"), F.desc("text"))
    within = rows.withColumns({"next_id": F.lead("doc_id").over(w), "next_r": F.lead("r").over(w), "next_text": F.lead("text").over(w), "k": F.row_number().over(w)})
    # the first row of each bucket, from the same exchange
    heads = within.where("k = 1").select(F.col("b").alias("next_b"), F.col("doc_id").alias("h_id"), F.col("text").alias("h_text"), F.col("r").alias("h_r"))
    after = following(rows.select("b").distinct(), count)
    last = within.join(after.join(heads, "next_b").drop("next_b"), "b", "left")
    own = F.col("next_id").isNotNull()
    inside = last.select(
        "doc_id", "text", "r",
        F.coalesce("next_id", "h_id").alias("next_id"),
        F.when(own, F.col("next_r")).otherwise(F.col("h_r")).alias("next_r"),
        F.when(own, F.col("next_text")).otherwise(F.col("h_text")).alias("next_text"),
    )
    return inside.unionByName(outside)


def edited_text(text: Column, following: Column) -> Column:
    """text with its last third (rounded down) replaced by as many first characters of the following text, or all it has."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - cut), F.substr(F.coalesce(following, F.lit("")), F.lit(1), cut))


def _digest(h1: str, h2: str, rank: str) -> Column:
    hexed = [F.lower(F.lpad(F.hex(F.col(h)), 16, "0")) for h in (h1, h2)]
    return F.concat(*hexed, F.when(F.col(rank) > 0, F.concat(F.lit("-"), F.col(rank).cast("string"))).otherwise(""))


def collisions(texts: DataFrame) -> DataFrame:
    """(h1, h2, form, rank) of canonical forms that share their hash with another form; rank counts from 0 in byte order.

    texts: (h1, h2, form). Equal forms are merged before the shuffle, so a group of copies arrives as one row per task.
    """
    forms = texts.groupBy(*HASH, "form").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*HASH)
    return forms.withColumns({"k": F.count("*").over(w), "rank": F.row_number().over(w.orderBy("form")) - 1}).where("k > 1").select(*HASH, "form", "rank")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint for every row of docs (doc_id, text); a null text counts as empty, repeated rows give equal rows."""
    rows = text_rows(docs).withColumn("form", canonical(F.col("text")))
    rows = rows.select("doc_id", "r", "form", *(h.alias(n) for h, n in zip(hashes(F.col("form")), HASH, strict=True)))
    shared = rows.groupBy(*HASH).agg(F.count("*").alias("n")).where("n > 1").select(*HASH)
    clash = collisions(rows.join(shared, HASH, "left_semi").select(*HASH, "form"))
    out = rows.join(clash, [*HASH, "form"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    return out.select("doc_id", _digest("h1", "h2", "rank").alias("fingerprint"))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, for every row of docs
    (doc_id, text). An edited text ends with the beginning of the next row's text (see with_next). Likeness of exact
    digests is 1 for equal and 0 for different ones. Rows without doc_id have no next text: they end early and near_next is
    the likeness to the empty text. Bytes are compared only for texts whose hash occurs twice; for these alone the texts
    are read and edited a second time.
    """
    rows = text_rows(docs)
    form = lambda c: hashes(canonical(F.col(c)))
    seen = with_next(rows).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    (h1, h2), (e1, e2), (x1, x2) = form("text"), form("edited"), hashes(canonical(F.coalesce("next_text", F.lit(""))))
    base = written(
        seen.select(
            "doc_id", "r", "next_id", "next_r",
            F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            h1.alias("h1"), h2.alias("h2"), e1.alias("e1"), e2.alias("e2"), x1.alias("x1"), x2.alias("x2"),
        ),
        "fingerprints",
    )
    sides = base.select("h1", "h2").unionByName(base.select(F.col("e1").alias("h1"), F.col("e2").alias("h2")))
    shared = written(sides.groupBy(*HASH).agg(F.count("*").alias("n")).where("n > 1").select(*HASH), "shared")
    whole = base.join(shared, HASH, "left_semi").select("doc_id", "r", "h1", "h2").distinct()
    edits = base.join(shared.select(F.col("h1").alias("e1"), F.col("h2").alias("e2")), ["e1", "e2"], "left_semi")
    edits = edits.select("doc_id", "r", "next_id", "next_r", "e1", "e2").distinct()
    wanted = whole.select("doc_id", "r").unionByName(edits.select("doc_id", "r"))
    wanted = wanted.unionByName(edits.select(F.col("next_id").alias("doc_id"), F.col("next_r").alias("r"))).distinct()
    key = lambda a, b: F.col(f"a.{a}").eqNullSafe(F.col(f"b.{b}"))
    texts = rows.alias("a").join(wanted.alias("b"), key("doc_id", "doc_id") & key("r", "r"), "left_semi").dropDuplicates(["doc_id", "r"])
    texts = written(texts, "texts")
    own = whole.alias("a").join(texts.alias("b"), key("doc_id", "doc_id") & key("r", "r")).select("a.h1", "a.h2", canonical(F.col("b.text")).alias("form"))
    edit = (
        edits.alias("a")
        .join(texts.alias("b"), key("doc_id", "doc_id") & key("r", "r"))
        .select("a.*", "b.text")
        .alias("a")
        .join(texts.alias("b"), key("next_id", "doc_id") & key("next_r", "r"), "left")
        .select("a.doc_id", "a.r", "a.next_id", "a.next_r", F.col("a.e1").alias("h1"), F.col("a.e2").alias("h2"), canonical(edited_text(F.col("a.text"), F.col("b.text"))).alias("form"))
    )
    clash = written(collisions(own.unionByName(edit.select("h1", "h2", "form"))), "collisions")
    out = base.withColumns({c: F.lit(0) for c in ("rank", "edited_rank", "next_rank")})
    if clash.take(1):  # two forms of one 128-bit hash: rank them in all three places
        ranked = texts.withColumn("form", canonical(F.col("text")))
        ranked = ranked.select("doc_id", "r", "form", *(h.alias(n) for h, n in zip(hashes(F.col("form")), HASH, strict=True)))
        ranked = ranked.join(clash, [*HASH, "form"]).select("doc_id", "r", F.col("rank").alias("k"))
        out = _ranked(out, ranked, "doc_id", "r", "rank")
        out = _ranked(out, ranked, "next_id", "next_r", "next_rank")
        late = edit.join(clash, [*HASH, "form"]).select("doc_id", "r", "next_id", "next_r", F.col("rank").alias("k")).distinct()
        late = late.alias("b")
        match = key("doc_id", "doc_id") & key("r", "r") & key("next_id", "next_id") & key("next_r", "next_r")
        out = out.alias("a").join(late, match, "left").select("a.*", F.col("b.k")).withColumn("edited_rank", F.coalesce("k", F.lit(0))).drop("k")
    out = out.select(
        "doc_id", "n_chars", "edited_sha256",
        _digest("h1", "h2", "rank").alias("fingerprint"), _digest("e1", "e2", "edited_rank").alias("edited_fingerprint"),
        _digest("x1", "x2", "next_rank").alias("next_fingerprint"),
    )
    same = lambda c: (F.col("fingerprint") == F.col(c)).cast("double")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        same("edited_fingerprint").alias("near_edited"), same("next_fingerprint").alias("near_next"),
    )


def _ranked(out: DataFrame, ranked: DataFrame, doc_id: str, r: str, name: str) -> DataFrame:
    on = F.col(f"a.{doc_id}").eqNullSafe(F.col("b.doc_id")) & F.col(f"a.{r}").eqNullSafe(F.col("b.r"))
    joined = out.alias("a").join(ranked.alias("b"), on, "left").select("a.*", F.col("b.k"))
    return joined.withColumn(name, F.coalesce("k", F.lit(0))).drop("k")
