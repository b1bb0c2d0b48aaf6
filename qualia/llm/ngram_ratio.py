"""Quality rules by a hashed n-gram likelihood ratio, in DataFrame operations only.

Words and word pairs of all documents are counted in ``2 ** bits`` hash buckets (the raw-corpus
multinomial), and those of trusted documents apart (the target multinomial). A document's score is
the mean over its n-grams of log p_target - log p_raw, in integer units of 2**-20 so that sums do
not depend on row order; it is kept if it passes the base rules and its score is at least the
threshold. Every row is counted and judged.

The threshold comes from the trusted documents: they are dealt into two halves by a hash of their id, and
each half is scored with the counts of the other half as its target, so no document is scored with its own
counts. With the median m and the lower quantile q (5 %) of these scores, in steps of 1/1000, the threshold
is q - FENCE (m - q): what lies that far below nearly all trusted documents is not like them. It depends on
the tables only, not on the order of rows, and may be given instead.

All trusted documents are counted. Their ids, of any number, are joined by doc_id; a bitmap of
``2 ** filter_bits`` hashed ids keeps the texts of others (nearly all, up to some millions of trusted ids) out
of that join's shuffle. The weights of the buckets are an array of ``2 ** bits`` numbers that each row's
n-grams are looked up in: nothing is exploded or joined for scoring.

Base rules: n_words, word_chars (code points in words), n_symbols (characters of #*$%&|<>),
n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words in 8-word windows
found twice or more in the text); a document fails with fewer than 20 words or with more than 30 %
repeated words.

Defined results: null text has no words and fails the base rules. Repeated rows are judged alike,
each gets its row. Null doc_ids are judged, and are never trusted. Very long texts are scored whole (their
n-grams are an array in one row). Texts without words score 0. Without trusted rows all scores are 0 (kept if
the base rules pass). An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.session import scratch_path

# Fixed value: the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
UNIT = 1 << 20


def split_words(text: Column) -> Column:
    """Words of a text; null: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _chain(hashes: str, step: int) -> Column:
    """Element-wise hash of an array with itself moved by ``step`` (the last ``step`` are not full)."""
    moved = F.slice(F.col(hashes), F.lit(step + 1), F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.zip_with(F.col(hashes), moved, lambda a, b: F.xxhash64(a, b))


def _grams(h1: str, h2: str) -> Column:
    """Hashes of all words and pairs of adjacent words, from those of words and the chain of pairs."""
    return F.concat(h1, F.slice(h2, F.lit(1), F.greatest(F.size(h2) - 1, F.lit(0))))


def bucket_of(gram: Column, bits: int) -> Column:
    return F.shiftrightunsigned(gram, 64 - bits).cast("int")


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, grams (hashes of the n-grams, with repeats) and the base columns, for rows (doc_id, text)."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(WORD))
    out = docs.select(
        "doc_id", split_words(F.col("text")).alias("words"), lines.alias("lines"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SYMBOL)).cast("long").alias("n_symbols"))
    out = out.select(
        "doc_id", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    keep = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    out = out.select(*keep, "h1", _chain("h1", 1).alias("h2"))
    keep.append("grams")
    out = out.select(*keep[:-1], _grams("h1", "h2").alias("grams"), _chain("h2", 2).alias("h4"))
    out = out.select(*keep, _chain("h4", 4).alias("h8"))
    out = out.select(*keep, F.slice("h8", 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int")).alias("w"))
    # Only texts with a repeated window take the steps below.
    out = out.select(*keep, F.when(F.size(F.array_distinct("w")) < F.size("w"), F.col("w")).alias("w"))
    out = out.select(*keep, F.array_sort(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i")))).alias("s"))
    twin = F.zip_with(
        F.col("s"), F.slice("s", 2, F.size("s")), lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])))
    out = out.select(*keep, F.array_sort(F.array_distinct(F.flatten(F.filter(twin, lambda x: x.isNotNull())))).alias("p"))
    reach = F.zip_with(
        F.col("p"), F.slice("p", 2, F.size("p")), lambda p, q: F.coalesce(F.least(q - p, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)
    out = out.select(*keep, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def gram_lists(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``grams``: hashes of all words and pairs of adjacent words, with repeats."""
    out = docs.select(*keep, F.transform(split_words(F.col("text")), lambda w: F.xxhash64(w)).alias("h1"))
    return out.select(*keep, "h1", _chain("h1", 1).alias("h2")).select(*keep, _grams("h1", "h2").alias("grams"))


def _array(rows: DataFrame, size: int, value: str) -> Column:
    """Literal array of ``value`` (long; 0 where missing) of rows (at, value) at 0..size-1: ``size`` numbers, whatever the tables."""
    found = {r["at"]: r[value] for r in rows.select("at", value).collect()}
    text = ",".join(str(found.get(i) or 0) for i in range(size))
    return F.split(F.lit(text), ",").cast("array<bigint>")  # folded to a constant before it runs


def trusted_rows(docs: DataFrame, ids: DataFrame, filter_bits: int) -> DataFrame:
    """The rows (doc_id, text) whose doc_id is in ``ids`` (column id)."""
    place = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - filter_bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place("id"), F.lit(64)).cast("int"))
    words = ids.groupBy((F.shiftrightunsigned(place("id"), 6)).alias("at")).agg(F.bit_or(bit).alias("bits"))
    bitmap = _array(words, 1 << (filter_bits - 6), "bits")
    word = F.get(bitmap, F.shiftrightunsigned(place("doc_id"), 6).cast("int"))
    flag = F.call_function("shiftrightunsigned", word, F.pmod(place("doc_id"), F.lit(64)).cast("int")).bitwiseAND(F.lit(1))
    # one plan at every size: what passes the bitmap is joined by sort-merge
    return docs.where(flag == 1).join(ids.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi")


def _half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("half")), F.lit(2)).cast("int")


def trusted_grams(docs: DataFrame, ids: DataFrame, bits: int, filter_bits: int) -> DataFrame:
    """half, buckets (of the n-grams, with repeats) of the trusted rows, written: they are read for the counts and
    for the threshold."""
    path = scratch_path(docs.sparkSession, "trusted-grams")
    trusted = trusted_rows(docs, ids, filter_bits).withColumn("half", _half(F.col("doc_id")))
    buckets = F.transform("grams", lambda g: bucket_of(g, bits))
    gram_lists(trusted, "half").select("half", buckets.alias("buckets")).write.parquet(path)
    return docs.sparkSession.read.schema("half int, buckets array<int>").parquet(path)


def gram_counts(docs: DataFrame, trusted: DataFrame, bits: int) -> DataFrame:
    """bucket, raw, half0, half1 (counts in all documents and in the two halves of the trusted ones), written."""
    spark = docs.sparkSession
    raw = gram_lists(docs).select(F.explode("grams").alias("g")).groupBy(bucket_of(F.col("g"), bits).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"))
    halves = trusted.select("half", F.explode("buckets").alias("b")).groupBy("b")
    halves = halves.agg(F.count_if(F.col("half") == 0).alias("half0"), F.count_if(F.col("half") == 1).alias("half1"))
    path = scratch_path(spark, "gram-counts")
    zero = F.lit(0).cast("long")
    raw.join(halves, F.col("bucket") == F.col("b"), "left").select(
        "bucket", "raw", F.coalesce("half0", zero).alias("half0"), F.coalesce("half1", zero).alias("half1")).write.parquet(path)
    return spark.read.schema("bucket int, raw long, half0 long, half1 long").parquet(path)


def weights(counts: DataFrame, target: Column, bits: int, smoothing: float = 1.0) -> Column:
    """Array of the buckets' weights (units of 2**-20) for the target counts ``target``; all 0 without any."""
    cells = smoothing * (1 << bits)
    sums = counts.agg(F.sum("raw").alias("n_raw"), F.sum(target).alias("n_target"))
    one = counts.select("bucket", "raw", target.alias("target")).join(F.broadcast(sums))  # a single row
    ratio = (F.log(F.col("target") + smoothing) - F.log(F.col("n_target") + cells)
             - F.log(F.col("raw") + smoothing) + F.log(F.col("n_raw") + cells))
    weight = F.when(F.col("n_target") > 0, F.round(ratio * UNIT).cast("long")).otherwise(0)
    return _array(one.select(F.col("bucket").alias("at"), weight.alias("weight")), 1 << bits, "weight")


def mean_weight(items: str, weight: Column, bucket: Callable[[Column], Column]) -> Column:
    """Mean weight of a row's n-grams in units of 2**-20 (no n-gram: 0); ``bucket`` gives an item's bucket."""
    total = F.aggregate(F.col(items), F.lit(0).cast("long"), lambda t, x: t + F.get(weight, bucket(x)))
    return F.when(F.size(items) > 0, total.cast("double") / F.size(items)).otherwise(0.0)


FENCE = 2.0
LOWER = 0.05
_STEPS = 1000


def threshold_of(trusted: DataFrame, counts: DataFrame, bits: int) -> float:
    """The least score that is kept; minus infinity without trusted n-grams in both halves."""
    other = F.when(F.col("half") == 0, mean_weight("buckets", weights(counts, F.col("half1"), bits), lambda b: b)).otherwise(
        mean_weight("buckets", weights(counts, F.col("half0"), bits), lambda b: b))
    scored = trusted.where(F.size("buckets") > 0)
    steps = scored.select(F.floor(other * _STEPS / UNIT).alias("step")).groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    found = sorted((r.step, r.n) for r in steps.collect())  # log ratios in thousandths: some ten thousand values
    both = counts.agg(F.sum("half0"), F.sum("half1")).first()
    if not found or not both[0] or not both[1]:
        return float("-inf")
    total = sum(n for _, n in found)

    def quantile(q: float) -> float:
        below = 0
        for step, n in found:
            below += n
            if below >= q * total:
                return step / _STEPS
        return found[-1][0] / _STEPS

    low, middle = quantile(LOWER), quantile(0.5)
    return low - FENCE * (middle - low)


def judge(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 16,
          threshold: float | None = None, filter_bits: int = 22) -> DataFrame:
    """Per document: doc_id, n_words, the base columns, base_failed, score, kept and threshold. ``trusted_ids``
    has the ids of trusted documents in its first column. ``threshold`` replaces the one found from them."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("id")).dropna().distinct()
    trusted = trusted_grams(src, ids, bits, filter_bits)
    counts = gram_counts(src, trusted, bits)
    least = threshold_of(trusted, counts, bits) if threshold is None else threshold
    weight = weights(counts, F.col("half0") + F.col("half1"), bits)
    score = mean_weight("grams", weight, lambda g: bucket_of(g, bits)) / UNIT
    return base_rules(src).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", score.alias("score"),
        (~F.col("base_failed") & (score >= F.lit(least))).alias("kept"), F.lit(least).alias("threshold"))
