r"""Operator 8: secret scans with multipart credential linking (DataFrame functions only).

Base spans, leftmost and non-overlapping per kind: ``assign`` (a keyword assigned a value of 8 or more
characters), ``access`` (AKIA key ids, 16 or more), ``hex`` (32 or more). A regular expression
``\G.*?(P)`` walks a text once and yields, match by match, the skipped characters and the match; running
sums of their lengths give positions in code points.

The method adds ``weak`` spans. A run of 20 or more key characters that mixes digits, capitals and small
letters is a weak secret; alone it says little and is not reported. Access identifiers (``access`` spans,
client, account, user and application ids) and endpoints (URLs) are its complementary parts. Within a scope
of 200 code points an interval join, on the document and bins of 256 code points, reports a weak secret
only where a complementary part stands, and only if no single base span contains it: an access id and the secret
joined to it are one run, reported beside the id. Within an endpoint, that endpoint and others do not count, or
every text with two links would report their paths; an identifier in scope does, and so does a user name with
a password in the URL itself. A run within an identifier's match is the identifier's value and not reported.

Texts are read once; a narrow table of match lengths is stored, and all that follows works on it. Cost
grows with the matches: a bin holds few parts, so the interval join emits no pairs beyond a bin.

Defined results: a NULL text counts as empty; no match gives counts of 0 and the digest of the empty
string; rows that repeat the same id and text get the same result each; NULL ids are kept; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, stored

# The base kinds of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Complementary parts and weak secrets.
IDENTIFIER = r"""(?i:client|account|application|app|user|access_?key)_?(?i:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=@-]{3,}"""
ENDPOINT = r"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"'<>]+"""
USER = r"""://[^\x00-\x20"'<>/?#:@]*:(?=[^\x00-\x20"'<>/?#@]+@)"""       # of a URL, with a password behind it
WEAK = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "weak", "identifier", "endpoint", "user")
BASE = 3          # the first kinds are base ones
REPORTED = 4      # the first kinds are reported
NAMING = (1, 4, 6)   # kinds that say whose secret it is
SCOPE, BIN = 200, 256


def _matches(kind: int, text: Column, pattern: str, may: Column, ok) -> Column:
    """array<struct<kind, pos, whole, len, ok>>: lengths of (skipped + match) and of the match, in order."""
    walk = F.lit(rf"(?s)\G.*?({pattern})")
    found = F.zip_with(F.regexp_extract_all(text, walk, F.lit(0)), F.regexp_extract_all(text, walk, F.lit(1)),
                       lambda w, m: F.struct(F.char_length(w).cast("long").alias("whole"), F.char_length(m).cast("long").alias("len"), ok(m).alias("ok")))
    numbered = F.transform(found, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x["whole"].alias("whole"), x["len"].alias("len"), x["ok"].alias("ok")))
    none = F.array().cast("array<struct<kind:int,pos:int,whole:bigint,len:bigint,ok:boolean>>")
    return F.when(may, numbered).otherwise(none)


def find_parts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, parts) per row; ``parts`` holds the matches of every kind as lengths."""
    text, low = F.col("text"), F.col("low")
    holds = lambda *words: F.array_contains(F.array(*[low.contains(w) for w in words]), True)
    yes = lambda m: F.lit(True)
    rows = (docs.select(long_id().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .withColumn("low", F.lower("text")))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", "low",
                       holds("client", "account", "app", "user", "access").alias("ids"),
                       low.contains("://").alias("urls"), low.contains("akia").alias("keys"))
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    parts = F.concat(
        _matches(0, text, ASSIGN, holds("password", "passwd", "secret", "token", "api"),
                 lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 1)) >= 8),
        _matches(1, text, ACCESS, F.col("keys"), yes),
        _matches(2, text, HEX, text.rlike(HEX), yes),
        _matches(4, text, IDENTIFIER, F.col("ids"), yes),
        _matches(5, text, ENDPOINT, F.col("urls"), yes),
        _matches(6, text, USER, F.col("urls"), yes),
        _matches(3, text, WEAK, F.col("ids") | F.col("urls") | F.col("keys"), mixed))
    return rows.select("doc_id", "text_hash", parts.alias("parts"))


def link_spans(parts: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end) of the reported spans, once for equal (doc_id, text_hash)."""
    each = (parts.where(F.size("parts") > 0).dropDuplicates(["doc_id", "text_hash"])
            .select("doc_id", "text_hash", F.explode("parts").alias("m")).select("doc_id", "text_hash", "m.*"))
    walked = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    spans = (each.withColumn("end", F.sum("whole").over(walked)).where("ok")
             .select("doc_id", "text_hash", "kind", (F.col("end") - F.col("len")).alias("start"), "end"))

    def binned(df, before):
        """One row per bin that the span, widened by ``before`` on both sides, touches."""
        first, last = F.floor((F.col("start") - before) / BIN), F.floor((F.col("end") - 1 + before) / BIN)
        return df.withColumn("bin", F.explode(F.sequence(first, last)))
    weak = binned(spans.where(F.col("kind") == KINDS.index("weak")), SCOPE).alias("w")
    other = binned(spans.where(F.col("kind") != KINDS.index("weak")), 0).alias("o")
    near = weak.join(other, F.expr(f"w.doc_id <=> o.doc_id AND w.text_hash = o.text_hash AND w.bin = o.bin "
                                   f"AND o.start < w.end + {SCOPE} AND o.end > w.start - {SCOPE}"))
    kind = F.col("o.kind")
    holds = (F.col("o.start") <= F.col("w.start")) & (F.col("o.end") >= F.col("w.end"))
    any_of = lambda c: F.max(c.cast("int"))
    linked = (near.groupBy("w.doc_id", "w.text_hash", "w.kind", "w.start", "w.end")
              .agg(any_of(holds & ((kind < BASE) | (kind == 4))).alias("covered"), any_of(holds & (kind == 5)).alias("inside"),
                   any_of(kind.isin(*NAMING)).alias("named"), any_of(kind == 5).alias("urls"))
              .where("covered = 0 AND (named = 1 OR urls = 1 AND inside = 0)").drop("covered", "inside", "named", "urls"))
    return spans.where(F.col("kind") < BASE).unionByName(linked)


def scan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parts, spans): the stored matches of every row and the reported spans by (doc_id, text_hash)."""
    parts = stored(find_parts(docs), "secret_parts")
    return parts, link_spans(parts)


MASK = "[SECRET]"


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by MASK (touching spans by one) and ``n_chars`` to match."""
    _, spans = scan(docs)
    so_far = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    runs = (spans.withColumn("reach", F.max("end").over(so_far))
            .withColumn("run", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(up_to))
            .groupBy("doc_id", "text_hash", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    cuts = (runs.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
            .withColumn("cuts", F.concat(F.col("cuts"), F.array(F.struct(F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"))))))
    d = docs.withColumn("__hash", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))).alias("d")
    joined = d.join(cuts.alias("c"), F.expr("cast(d.doc_id AS bigint) <=> c.doc_id AND d.__hash = c.text_hash"), "left")
    # the pieces between the spans; the last cut stands for the end of the text
    piece = lambda x, i: F.substring(
        F.col("d.text"),
        F.coalesce(F.when(i > 0, F.get(F.col("c.cuts"), i - 1)["end"]), F.lit(0)).cast("int") + 1,
        (F.coalesce(x["start"], F.char_length("d.text").cast("long")) - F.coalesce(F.when(i > 0, F.get(F.col("c.cuts"), i - 1)["end"]), F.lit(0))).cast("int"))
    masked = F.when(F.col("c.cuts").isNull(), F.col("d.text")).otherwise(F.concat_ws(MASK, F.transform(F.col("c.cuts"), piece)))
    out = [masked.alias(c) if c == "text" else F.when(F.col("c.cuts").isNull(), F.col("d.n_chars")).otherwise(F.char_length(masked)).cast(t).alias(c)
           if c == "n_chars" else F.col(f"d.`{c}`") for c, t in docs.dtypes]
    return joined.select(*out)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, spans = scan(read_table(spark, sf_dir, "documents"))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    label = F.concat_ws(":", name, F.col("start"), F.col("end"))
    listed = spans.select("doc_id", "text_hash", "kind", F.struct("start", "kind", label.alias("label")).alias("span"))
    per_doc = listed.groupBy("doc_id", "text_hash").agg(
        *[F.count(F.when(F.col("kind") == i, True)).alias(f"n_{KINDS[i]}") for i in range(REPORTED)],
        F.array_sort(F.collect_list("span")).alias("all"))
    join = F.expr("p.doc_id <=> s.doc_id AND p.text_hash = s.text_hash")
    spelled = lambda spans_: F.concat_ws(",", F.transform(spans_, lambda x: x["label"]))
    every = F.coalesce(F.col("s.all"), F.array().cast("array<struct<start:bigint,kind:int,label:string>>"))
    counts = [F.coalesce(F.col(f"n_{KINDS[i]}"), F.lit(0)).cast("long").alias(f"n_{KINDS[i]}") for i in range(REPORTED)]
    return (parts.select("doc_id", "text_hash").alias("p").join(per_doc.alias("s"), join, "left")
            .select("p.doc_id", *counts, every.alias("all"))
            .select("doc_id", "n_assign", "n_access", "n_hex", "n_weak",
                    F.sha2(spelled(F.filter("all", lambda x: x["kind"] < BASE)).cast("binary"), 256).alias("base_sha256"),
                    spelled(F.col("all")).alias("spans")))
