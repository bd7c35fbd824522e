"""Rows that every operator must take: null, empty, blank and very long texts,
ties and repeated rows, null ids, and extra columns with clashing names."""
import random
import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EXTRA = ("id long, n long, h long, label string, start long, word string, score double, cls long, s long, "
         "text_hash long, hash long, language string, `__id` string, c0 string, row long")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(("the", "of", "stone", "river", "green", "walks", "and", "to", "mountain", "über", "señor")) + r.choice(("", ",", "."))
                    for _ in range(n))


def edge_rows():
    long_text = prose(7, 40_000)
    texts = [None, "", " \n\t ", "one", "one two three", prose(1, 60), prose(1, 60), prose(2, 300), long_text, "a" * 70_000,
             prose(3, 80) + "\n" + prose(3, 80), "日本語 テキスト <|endoftext|> x", "don't we'll   ok\n\n\n"]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, prose(4, 50), None, None, None), (None, None, None, None, None), (7, prose(5, 50), "xx", "", 0)]
    return rows


def edge(spark):
    extra = (1, 2, 3, "l", 4, "w", 0.5, 5, 6, 7, 8, "zz", "q", "c", 9)
    return spark.createDataFrame([r + extra for r in edge_rows()], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
