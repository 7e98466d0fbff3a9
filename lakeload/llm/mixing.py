"""Operator 7: mix sources to target weights by Efraimidis-Spirakis sampling.

Targets. Sources in code point order (NULL last) weigh 3, 1, 2, repeating, and share 150 % of all words.
A target stops at twice its source's size; the excess goes to the others by weight until none is above.
With sources sorted by cap / weight, source k would see the level (T - caps before k) / (weights from k);
the final level is the largest of these, and target = min(cap, level * weight).

Sampling. A source's target holds whole epochs first: every document ``target div source_size`` times.
The rest is one weighted sample without replacement: documents in ascending order of the exponential key
-ln(u) / quality, u from the document's id and text, taken until the remaining budget is full (the last one in part).
The quality weight is 0.25 plus 0.75 times the share of words that end like prose (a letter, perhaps
punctuation); a document whose text is junk is so picked later than clean ones.

Order within a source never passes through one task: rows go to (source, slice) by 1 - exp(-key), which
is monotone in the key, slices get totals and prefix sums, and only a slice is sorted.

Rows are told apart by their place in the input, which must be the same at each read, as a table's is. The second and
later of rows with equal id, source and text are numbered, and the number enters u: a document that stands in a third of
all rows is spread over the slices like any other. Numbers are given within input partitions and shifted by the counts of
those before, so that no task holds all rows of one document.

Defined results: a NULL or blank text has size 0 and takes 0; a source of size 0 has target 0; NULL is a
source of its own; ties in the key go to the smaller id (NULL last), text digest and number; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, shuffle_width, stored

WORD = r"[^\x20\x09-\x0D]+"
PROSE_END = r"\p{L}[.,;:!?]?(?:[\x20\x09-\x0D]|\z)"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def n_words(col):
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one (source, source_size) row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("r") - 1, F.lit(len(weights))) + 1)
    t = (sizes.withColumn("r", F.row_number().over(by_name)).withColumn("w", w)
         .withColumn("cap", (max_epochs * F.col("source_size")).cast("double")))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "r")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("w").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("level", (share * F.sum("source_size").over(everything) - before) / behind)
    return (t.withColumn("level", F.max("level").over(everything))
            .select("source", "source_size", F.least(F.col("cap"), F.col("level") * F.col("w")).alias("target")))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (class, pid, row, ...) with ``nth``, their number within the class, from 1."""
    often = rows.groupBy("class").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("class")
    once = rows.join(often, "class", "left_anti").withColumn("nth", F.lit(1).cast("long"))
    repeated = rows.join(often, "class", "left_semi")
    before = Window.partitionBy("class").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = repeated.groupBy("class", "pid").agg(F.count(F.lit(1)).alias("__n")).withColumn("shift", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    own = repeated.withColumn("nth", F.row_number().over(Window.partitionBy("class", "pid").orderBy("row")))
    own = own.join(shift.select("class", "pid", "shift"), ["class", "pid"]).withColumn("nth", F.col("nth") + F.col("shift")).drop("shift")
    return once.unionByName(own)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        slices: int | None = None) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, taken) for every row of ``docs``, ``row`` being its place."""
    spark = docs.sparkSession
    n = slices or shuffle_width(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("pid"), long_id().alias("doc_id"),
                       F.col("source").cast("string").alias("source"), F.md5(text.cast("binary")).alias("text_key"),
                       n_words(F.col("text")).alias("size"), F.regexp_count(text, F.lit(PROSE_END)).alias("prose"))
    rows = numbered(stored(rows.withColumn("class", F.xxhash64("doc_id", "source", "text_key")), "mix_words"))
    digest = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_key", F.col("nth").cast("string")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    quality = 0.25 + 0.75 * F.least(F.lit(1.0), F.col("prose") / F.greatest(F.col("size"), F.lit(1)))
    rows = rows.withColumn("key", -F.ln(u) / quality).withColumn("slice", F.floor((1 - F.exp(-F.col("key"))) * n).cast("int"))
    rows = stored(rows.select("row", "doc_id", "source", "text_key", "nth", "size", "key", "slice"), "mix_rows")

    slices_ = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices_ = slices_.withColumn("before", F.coalesce(F.sum("words").over(in_source), F.lit(0)))
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    a, b = slices_.alias("a"), targets.alias("b")
    plan = a.join(b, F.expr("a.source <=> b.source")).select("a.source", "slice", "before", "source_size", "target")

    r, p = rows.alias("r"), plan.alias("p")
    in_slice = (Window.partitionBy("source", "slice").orderBy("key", F.col("doc_id").asc_nulls_last(), "text_key", "nth")
                .rowsBetween(Window.unboundedPreceding, -1))
    return (r.join(p, F.expr("r.source <=> p.source AND r.slice = p.slice"))
            .select("row", "doc_id", "r.source", "text_key", "nth", "size", "key", "r.slice", "before", "source_size", "target")
            .withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(in_slice), F.lit(0)))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
            .withColumn("budget", F.floor("target") - F.col("epochs") * F.col("source_size"))
            .withColumn("taken", F.col("epochs") * F.col("size")
                        + F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("ahead"))))
            .select("row", "doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per whole copy that it takes of a document, and one of the first words for a part.

    A cut text is its first words joined by single blanks; ``n_chars`` follows.
    """
    shares = mix(docs, **options).where("taken > 0").select(F.col("row").alias("__row"), F.col("taken").alias("__taken"), F.col("size").alias("__size"))
    joined = docs.withColumn("__row", F.monotonically_increasing_id()).join(shares, "__row")
    whole, rest = F.floor(F.col("__taken") / F.col("__size")), F.col("__taken") % F.col("__size")
    joined = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("__taken") / F.col("__size")))))
    cut = F.col("__copy") > whole
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)), 1, rest.cast("int")), " ")
    text = F.when(cut, first).otherwise(F.col("text"))
    out = [text.alias(c) if c == "text" else F.when(cut, F.char_length(text)).otherwise(F.col("n_chars")).cast(t).alias(c)
           if c == "n_chars" else F.col(f"`{c}`") for c, t in docs.dtypes]
    return joined.select(*out)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH x AS (SELECT *, md5(coalesce(text, '')) AS k, row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) AS nth FROM documents),
d AS (
  SELECT doc_id, source, k AS text_key, nth, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         len(regexp_extract_all(coalesce(text, ''), '\p{L}[.,;:!?]?(?:[\x20\x09-\x0D]|\z)')) AS prose,
         (('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || k || '|' || nth), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM x),
k AS (SELECT *, -ln(u) / (0.25 + 0.75 * least(1.0, prose / greatest(size, 1))) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w,
             2.0 * source_size AS cap, sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, (1.5 * total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * w)::DOUBLE AS target FROM l),
o AS (SELECT k.doc_id, k.size, t.source_size, t.target,
             coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS LAST, k.text_key, k.nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM o)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - ahead)))::BIGINT AS taken
FROM e
"""
