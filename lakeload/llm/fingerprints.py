"""Operator 1: document fingerprints from closed syncmers (DataFrame functions only).

A text is a sequence of tokens (runs of non-blanks, cut every 16 characters so that a text without blanks
still has many). Its k-mers are K consecutive tokens, its inner substrings S-mers of S tokens. A k-mer is
an anchor when its smallest S-mer hash is the first or the last one. That depends on the k-mer alone,
never on its surroundings, so an unchanged passage keeps its anchors wherever it stands, and at least one
of any K - S + 1 consecutive k-mers is an anchor. Anchors are of this one kind at every length, so short and
long texts can be compared; K is small, so that short texts have enough of them. The few k-mers of a text too
short to be sure of an anchor (fewer than 2 K - S tokens) are all anchors where none is closed; a text of fewer
than K tokens has the hash of the whole text as its only one.

The fingerprint lists the anchors' 32-bit hashes in text order as lowercase hex, eight digits each; the
likeness of two is the Dice share of distinct anchors they have in common. ``with_anchors`` can also give the anchors' token
offsets (``positions``), for positional matching.

``edited_pairs`` needs the next document in descending id order. Rows are ordered by id, then the text's hash, then their
place in the input, so that no two are equal and a repeated id, or a row repeated a million times, is cut like any other. That
order is cut into ranges at the quantiles of a sample (``SAMPLE`` rows a range), each range's first document also visits the
range before it as a guest, and the first of all visits the last. One shuffle then puts every document beside its successor.
The input is read three times and must give the same rows each time, as a table does.

Defined results: a NULL text counts as empty; empty and blank texts have one whole-text anchor; NULL ids
come last; rows with equal ids stand in the order of their text's hash; an empty table gives no rows; a
table of one document is its own successor; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, shuffle_width

K, S = 3, 1
TOKEN = r"[^\x20\x09-\x0D]{1,16}"
LOWEST = -(1 << 63)
SAMPLE = 32                   # rows of the sample for each range


def with_anchors(df: DataFrame, text: str, out: str, k: int = K, positions: str | None = None) -> DataFrame:
    """Add ``out``, the anchor hashes of column ``text`` in text order (array<int>).

    S-mers are single tokens.
    """
    tok, mer, pos = f"__{out}_tok", f"__{out}_mer", positions or f"__{out}_pos"
    edge = k - S                                   # offset of the last S-mer in a k-mer
    get = lambda i: F.get(F.col(mer), i)
    df = df.withColumn(tok, F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)))
    df = df.withColumn(mer, F.transform(F.col(tok), lambda w: F.xxhash64(w)))
    closed = lambda i: F.least(*[get(i + j) for j in range(edge + 1)]).isin(get(i), get(i + edge))
    every = F.sequence(F.lit(0), F.size(tok) - k)
    df = df.withColumn(pos, F.when(F.size(tok) >= k, F.filter(every, closed)).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(pos, F.when((F.size(pos) == 0) & (F.size(tok) >= k), every).otherwise(F.col(pos)))
    spelled = F.transform(F.col(pos), lambda i: F.hash(*[get(i + j) for j in range(edge + 1)]))
    df = df.withColumn(out, F.when(F.size(pos) > 0, spelled).otherwise(F.array(F.hash(F.col(text)))))
    return df.drop(*[c for c in (tok, mer, pos) if c != positions])


def fingerprint(anchors: str) -> Column:
    """Eight hex digits per anchor, in text order."""
    wide = lambda a: F.lpad(F.lower(F.hex(a.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0")
    return F.concat_ws("", F.transform(F.col(anchors), wide))


def likeness(a: str, b: str) -> Column:
    """Dice share of distinct anchors; both arrays hold distinct values."""
    return 2.0 * F.size(F.array_intersect(F.col(a), F.col(b))) / (F.size(a) + F.size(b))


def _range_of(place: list[Column], bounds: list[tuple]) -> Column:
    """Number of bounds at or below the place, by binary search in literal arrays."""
    if not bounds:
        return F.lit(0)
    held = [F.array(*[F.lit(b[i]).cast("long") for b in bounds]) for i in range(len(place))]
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def at_or_below(mid):
        reached = F.lit(True)
        for own, column in reversed(list(zip(place, held))):
            bound = F.get(column, mid)
            reached = (bound < own) | (bound == own) & reached
        return reached

    def halve(at, _):
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        step = F.when(at_or_below(mid), F.struct((mid + 1).alias("lo"), at["hi"].alias("hi"))).otherwise(F.struct(at["lo"].alias("lo"), mid.alias("hi")))
        return F.when(at["lo"] < at["hi"], step).otherwise(F.struct(at["lo"].alias("lo"), at["hi"].alias("hi")))
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.aggregate(steps, start, halve, lambda at: at["lo"])


def with_successor(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(range, guest, key, doc_id, text, text_hash, row), each row's successor in the same range right behind it."""
    n = ranges or 2 * shuffle_width(docs.sparkSession)
    rows = docs.select(long_id().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    # ids descend, NULL last: the complement turns the order of longs round
    rows = rows.select("doc_id", "text", "row", F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)).alias("key"), F.xxhash64("text").alias("text_hash"))
    place = ["key", "text_hash", "row"]
    # driver: SAMPLE rows a range and one row per range, whatever the number of documents
    share = min(1.0, SAMPLE * n / max(1, docs.count()))
    picked = rows.select(*place).where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30))).toArrow()
    sample = sorted(zip(*(picked[c].to_pylist() for c in place)))
    step = max(1, len(sample) // n)
    home = _range_of([F.col(c) for c in place], sample[step::step])
    heads = {r["home"]: tuple(r["head"]) for r in rows.select(home.alias("home"), F.struct(*place).alias("head")).groupBy("home").agg(F.min("head").alias("head")).collect()}
    if not heads:
        return rows.select(F.lit(0).alias("range"), F.lit(0).alias("guest"), "key", "doc_id", "text", "text_hash", "row")
    there = sorted(heads)
    before = dict(zip(there, there[-1:] + there[:-1]))
    every = range(max(there) + 1)
    visits = F.get(F.array(*[F.lit(before.get(b, 0)) for b in every]), F.col("home"))
    first = F.get(F.array(*[F.lit(heads.get(b, (0, 0, -1))[2]).cast("long") for b in every]), F.col("home"))
    at_home = F.struct(F.col("home").alias("range"), F.lit(0).alias("guest"))
    away = F.struct(visits.alias("range"), F.lit(1).alias("guest"))
    rows = rows.withColumn("home", home)
    rows = rows.withColumn("at", F.explode(F.when(F.col("row") == first, F.array(at_home, away)).otherwise(F.array(at_home))))
    return rows.select("at.range", "at.guest", "key", "doc_id", "text", "text_hash", "row")


def edited_pairs(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per document: its anchors, its edited text and that text's anchors, its successor's anchors."""
    rows = with_successor(docs, ranges)
    dealt = rows.repartition(shuffle_width(docs.sparkSession), "range")
    dealt = with_anchors(dealt, "text", "anchors").withColumn("distinct", F.array_distinct("anchors"))
    after = Window.partitionBy("range").orderBy("guest", "key", "text_hash", "row")
    paired = (dealt.withColumn("next_text", F.lead("text").over(after))
              .withColumn("next_distinct", F.lead("distinct").over(after))
              .where("guest = 0"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    paired = paired.withColumn("n_chars", F.char_length("text").cast("long"))
    paired = paired.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
                                                  F.substring(F.col("next_text"), F.lit(1), half)))
    return (with_anchors(paired.drop("next_text"), "edited", "edited_anchors")
            .withColumn("edited_distinct", F.array_distinct("edited_anchors")))


def op1_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = edited_pairs(read_table(spark, sf_dir, "documents"))
    return paired.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                         fingerprint("anchors").alias("fingerprint"),
                         fingerprint("edited_anchors").alias("edited_fingerprint"),
                         likeness("distinct", "edited_distinct").alias("near_edited"),
                         likeness("distinct", "next_distinct").alias("near_next"))
