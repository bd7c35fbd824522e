"""Benchmark decontamination: which documents contain which test items.

Size-partitioned MinHash containment search. An item is contained if at least
``threshold`` of its distinct five-word shingles stand in the document. Ordinary
MinHash bands fail here, since the Jaccard similarity of a 30-word item and a
20,000-word document is near 0. So, per size partition (items of 2^p up to
2^(p+1) - 1 shingles), an item's sketch is its m least shingle hashes, with m
one more than the largest item of the partition may miss. A document that
contains the item misses fewer than m of its shingles, hence holds at least one
of the sketch: no contained item is passed over, however long the document.

The documents' shingles meet the sketches in one join on the hash, after those
above the largest sketch hash are dropped. Sketches are a few numbers per item,
stored first, so Spark knows their size: it broadcasts them if small and
otherwise shuffles both sides. The candidates are then verified on the shingles
themselves.

Items of fewer than five words have no shingle. Such an item is contained if its
words stand in the document one after the other, and is found by a join of its
text with the documents' windows of as many words; a width that no item has costs
nothing.

Only Spark's own functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import SPACES
from wardflow.session import materialize

WIDTH = 5


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SPACES, -1), "")


def _windows(words: Column, make, width: int = WIDTH) -> Column:
    """``make`` of the words of each window, for texts of at least one window."""
    return F.when(F.size(words) >= width, F.transform(
        F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: make(*[F.element_at(words, i + k) for k in range(width)])))


def _shingles(words: Column) -> Column:
    """Distinct shingles as text; words hold no white space, so a space parts them."""
    return F.array_distinct(_windows(words, lambda *w: F.concat_ws(" ", *w)))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(hash, item): the least hashes of each item, as many as its size partition needs."""
    sized = items.select("item", F.array_sort(F.transform("shingles", lambda s: F.xxhash64(*[
        F.get(F.split(s, " "), k) for k in range(WIDTH)]))).alias("h"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.size("h").cast("double"))) + 1) - 1
    keep = F.floor(largest - F.ceil(largest * threshold - 1e-9) + 1).cast("int")
    return sized.select("item", F.explode(F.slice("h", F.lit(1), keep)).alias("hash"))


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """A row per document and item contained in it: id, ``item_id``, ``item_copies``,
    ``item_shingles``, ``shared_shingles``, ``containment`` and ``text_hash`` (of the
    document's text, to tell apart rows with one id).

    Text is lower-cased. Items of equal words are one, named by their smallest id
    (``item_copies`` says how many). An item of one to four words counts as one
    shingle and is contained where its words stand one after the other. Null and empty
    items are contained nowhere, and null and empty documents contain nothing. A
    document's words and windows are in memory while it is read. Null ids are kept, rows that share an id are judged each by its own text, and
    wholly repeated rows are reported once. Empty tables give no rows; other
    columns are not read.
    """
    words = F.array_join(_words(F.col(item_text_col)), " ")
    items = (benchmark.select(F.col(item_col).alias("item"), words.alias("words")).groupBy("words")
             .agg(F.min("item").alias("item"), F.count(F.lit(1)).alias("copies"))
             .withColumn("w", F.split("words", " ")).withColumn("shingles", _shingles(F.col("w"))))
    every = materialize(items.where("words <> ''").withColumn("item_no", F.monotonically_increasing_id())
                        .select("item_no", "item", "copies", "shingles", "words", F.size("w").alias("width")), "benchmark-items")
    items = every.where(F.col("width") >= WIDTH).select("item_no", "item", "copies", "shingles")
    keys = materialize(sketches(items.select(F.col("item_no").alias("item"), "shingles"), threshold), "benchmark-sketches")
    top = keys.agg(F.max("hash")).first()[0]
    top = -(1 << 63) if top is None else top  # no item, nothing to find

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own = texts.select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), _words(F.col("text")).alias("words"))
    rolling = own.select("id", "text_hash", F.explode(_windows(F.col("words"), lambda *w: F.xxhash64(*w))).alias("hash"))
    candidates = (rolling.where(F.col("hash") <= top).join(keys.withColumnRenamed("item", "item_no"), "hash")
                  .select("id", "text_hash", "item_no").distinct())
    candidates = materialize(candidates, "benchmark-candidates").toDF("c_id", "c_hash", "item_no")

    # verify: the shingles themselves, of candidate documents only
    pairs = own.join(candidates, own["id"].eqNullSafe(candidates["c_id"]) & (own["text_hash"] == candidates["c_hash"]))
    pairs = pairs.select("id", "text_hash", "item_no", _shingles(F.col("words")).alias("has")).join(items, "item_no")
    shared = F.size(F.array_intersect("shingles", "has"))
    found = pairs.select("id", "text_hash", "item", "copies", F.size("shingles").alias("n"), shared.alias("shared"))
    found = found.where(F.col("shared") >= F.col("n") * threshold - 1e-9)
    short = every.where(F.col("width") < WIDTH)
    for width in sorted(r.width for r in short.select("width").distinct().collect()):  # 1 to 4
        whole = _windows(F.col("words"), lambda *w: F.concat_ws(" ", *w), width)
        stands = own.select("id", "text_hash", F.explode(F.array_distinct(whole)).alias("words"))
        hit = stands.join(short.where(F.col("width") == width).select("words", "item", "copies"), "words")
        found = found.unionByName(hit.select("id", "text_hash", "item", "copies", F.lit(1).alias("n"), F.lit(1).alias("shared")))
    return (found.distinct()
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("copies").alias("item_copies"),
                    F.col("n").cast("long").alias("item_shingles"), F.col("shared").cast("long").alias("shared_shingles"),
                    (F.col("shared") / F.col("n")).alias("containment"), "text_hash"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns as they were."""
    bad = materialize(contained_items(docs, benchmark, id_col, text_col, **options).select(
        F.col(id_col).alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct(), "contaminated")
    own = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__bad_id"]) & (own == bad["__bad_hash"]), "left_anti")
