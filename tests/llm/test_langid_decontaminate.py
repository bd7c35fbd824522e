import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import SF, edge, edge_rows, empty, prose, words  # noqa: E402

from wardflow.llm import decontaminate, langid  # noqa: E402


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_text_alone_recovers_hidden_labels(spark):
    hidden = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    got = langid.identify(docs(spark), declared=F.when(~hidden, F.col("lang"))).withColumn("hidden", hidden)
    rows = got.where("hidden").collect()
    assert len(rows) > 40 and sum(r.language == r.lang for r in rows) >= 0.97 * len(rows)


def test_wrong_tags_and_noise(spark):
    """A wrong tag does not overrule a text; what is no text goes; clean rows stay."""
    frame = docs(spark)
    clean = frame.count()
    noise = spark.createDataFrame([(10_000 + i, bytes((37 * i * k + k * k * 11) % 94 + 33 for k in range(1, 400)).decode(), "en", "src0", 399)
                                   for i in range(5)], frame.schema)
    wrong = F.when(F.pmod("doc_id", F.lit(17)) == 0, F.lit("es")).otherwise(F.col("lang"))
    got = langid.identify(frame.union(noise), declared=wrong, host=F.col("source")).collect()
    assert sum(r.language_kept for r in got if r.doc_id < 10_000) == clean
    assert not any(r.language_kept for r in got if r.doc_id >= 10_000)
    assert sum(r.language == r.lang for r in got if r.doc_id < 10_000) >= 0.98 * clean


def test_edges(spark):
    got = langid.identify(edge(spark), declared=F.col("lang"), host=F.col("source"))
    # the frame has a column `language` of its own, which the result replaces
    rows = got.select("doc_id", "text", "language_kept").collect()
    assert len(rows) == len(edge_rows())
    assert not any(r.language_kept for r in rows if not words(r.text))
    assert langid.identify(empty(spark), declared=F.col("lang")).count() == 0
    assert langid.identify(edge(spark)).count() == len(edge_rows())


def test_pages(spark):
    page = spark.read.parquet(f"{SF}/pages.parquet")
    got = langid.identify_pages(page).collect()
    want = {r.page_id: r.w for r in page.select("page_id", F.regexp_extract("html", 'lang="(..)"', 1).alias("w")).collect()}
    assert len(got) == len(want) and sum(r.language == want[r.page_id] for r in got) >= 0.97 * len(got)
    odd = spark.createDataFrame([(None, None, None), (1, "notaurl", ""), (2, "http://x.fr/", "<html lang=fr>")], "page_id long, url string, html string")
    assert langid.identify_pages(odd).count() == 3
    parts = spark.createDataFrame([("https://me@Blog.a.example.FR:80/x?y",), ("x",), (None,)], "u string").select(*langid.host_parts(F.col("u"))).collect()
    assert [tuple(r) for r in parts] == [("blog.a.example.fr", "example.fr", "fr"), (None, None, None), (None, None, None)]


def brute(doc_rows, items):
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    out = set()
    for d, t in doc_rows:
        for i, x in items:
            s = shingles(x)
            both = len(s & shingles(t))
            if s and 10 * both >= 8 * len(s):
                out.add((d, i, len(s), both))
            short, w = (x or "").lower().split(), (t or "").lower().split()
            if 0 < len(short) < 5 and any(w[k:k + len(short)] == short for k in range(len(w))):
                out.add((d, i, 1, 1))
    return out


def test_contained_items(spark):
    items = [(1, prose(20, 30)), (2, prose(21, 12)), (3, "too short here"), (4, None), (5, prose(22, 200)), (None, prose(23, 15)), (7, "")]
    long = prose(24, 20_000)
    cut = prose(20, 30).split()
    rows = [(1, long + " " + items[0][1] + " " + long), (2, "x " + items[1][1].upper()), (3, " ".join(cut[:27])), (4, " ".join(cut[:20])),
            (5, " ".join(prose(22, 200).split()[10:190])), (6, "too short here"), (None, items[5][1]), (7, None), (7, items[0][1]), (1, long)]
    bench = spark.createDataFrame([(*x, 1, "z") for x in items], "item_id long, text string, doc_id long, hash string")
    frame = spark.createDataFrame([(*x, 1, "z") for x in rows], "doc_id long, text string, item_id long, hash string")
    got = decontaminate.contained_items(frame, bench).collect()
    assert {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got} == brute(rows, items)
    kept = decontaminate.decontaminate(frame, bench)
    assert kept.columns == frame.columns
    bad = {(d, t) for d, t in rows if brute([(d, t)], items)}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in rows if x not in bad), key=str)


def test_short_items(spark):
    """Items of one to four words, found where their words stand one after the other."""
    items = [(1, "forty two"), (2, "Yes."), (3, "to be or not"), (4, " \n"), (5, "one two three four five"), (6, "YES.")]
    rows = [(1, "The answer is forty\n two"), (2, "forty and two yes. or no"), (3, "TO be OR not to be"), (4, "forty two"), (5, "yes.no to be or"),
            (6, "zero one two three four five"), (7, "one two three four"), (8, None), (9, "yes."), (9, "yes.")]
    bench, frame = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contained_items(frame, bench).collect()
    want = {(d, 2 if i == 6 else i, n, k) for d, i, n, k in brute(rows, items)}
    assert {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got} == want and len(got) == len(want)
    assert {r.item_copies for r in got if r.item_id == 2} == {2}


def test_copies_of_items_are_one(spark):
    text = prose(30, 20)
    bench = spark.createDataFrame([(i, text if i else text.upper()) for i in range(50)], "item_id long, text string")
    got = decontaminate.contained_items(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string"), bench).collect()
    assert [(r.doc_id, r.item_id, r.item_copies) for r in got] == [(1, 0, 50)]


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(edge(spark), bench).count() == 0
    assert decontaminate.decontaminate(edge(spark), bench).count() == len(edge_rows())
    assert decontaminate.decontaminate(empty(spark), spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")).count() == 0
