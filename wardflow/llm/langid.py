"""Language identification by fusing evidence in Bayes' manner.

For every language l the posterior is proportional to

    P(text | l)^damping  P(declared | l)  P(address suffix | l)  P(l | host)

* the text likelihood is that of hashed 4-byte windows, counted per declared
  language over the whole corpus (``damping`` allows for their overlap),
* what pages declare, and their address suffix, are weighed by how they go with
  the language that the text alone suggests, counted over the whole corpus,
* the host's prior is smoothed towards its domain's and that towards all.

A further class, ``und``, has equal odds for every window: what it wins is no
text of these languages. All counts are grouped aggregations; what reaches the
driver are the window counts (languages x buckets) and the declared-by-language
table, both of fixed size. Host and suffix tables stay tables and are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, lower_ascii, text_buffer
from wardflow.session import materialize

LANGUAGES = ("en", "fr", "de", "es")
UNDETERMINED = "und"
BITS = 14
BUCKETS = 1 << BITS
WIDTH = 4
CHUNK = 1 << 21
_MULTIPLIERS = np.asarray([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _windows(data: np.ndarray, offsets: np.ndarray):
    """(bucket, text number) of all 4-byte windows, in chunks of bounded size."""
    for at in range(0, max(len(data) - WIDTH + 1, 0), CHUNK):
        piece = lower_ascii(data[at:at + CHUNK + WIDTH - 1]).astype(np.uint32)
        n = len(piece) - WIDTH + 1
        mixed = np.zeros(n, np.uint32)
        for k in range(WIDTH):
            mixed += piece[k:k + n] * _MULTIPLIERS[k]
            mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        place = np.arange(at, at + n)
        text = np.searchsorted(offsets, place, "right") - 1
        inside = place + WIDTH <= offsets[text + 1]
        yield (mixed >> np.uint32(32 - BITS))[inside].astype(np.int64), text[inside]


def window_counts(texts: DataFrame, languages) -> DataFrame:
    """(language, bucket, n) over ``declared`` and ``text``; partial sums per task."""
    number = {name: k for k, name in enumerate(languages)}

    def run(batches):
        total = np.zeros(len(languages) * BUCKETS, np.int64)
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            kind = np.asarray([number.get(d, -1) for d in b.column(0).to_pylist()], np.int64)
            for bucket, text in _windows(data, offsets):
                use = kind[text] >= 0
                total += np.bincount(kind[text[use]] * BUCKETS + bucket[use], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((some // BUCKETS).astype(np.int32)), pa.array((some % BUCKETS).astype(np.int32)),
                                          pa.array(total[some])], ["language", "bucket", "n"])

    return texts.mapInArrow(run, "language int, bucket int, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def text_model(texts: DataFrame, languages, prior: float = 0.5) -> np.ndarray:
    """Log probabilities (languages and ``und``) x buckets."""
    counts = np.zeros((len(languages), BUCKETS))
    for r in window_counts(texts, languages).toLocalIterator():  # at most languages x buckets rows
        counts[r["language"], r["bucket"]] = r["n"]
    counts += prior
    model = np.log(counts / counts.sum(axis=1, keepdims=True))
    return np.vstack((model, np.full((1, BUCKETS), -np.log(BUCKETS)))).astype(np.float32)


def with_text_scores(docs: DataFrame, text_col: str, model: np.ndarray, damping: float) -> DataFrame:
    """``docs`` with ``__score`` (log likelihood by language) and ``__windows``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, fixed size
    names = docs.columns
    held = docs.toDF(*[f"c{i}" for i in range(len(names))])
    spot = names.index(text_col)
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(held.schema.fields))

    def run(batches):
        logs = shared.value
        kind = pa.list_(pa.float64())
        for b in batches:
            data, offsets = text_buffer(b.column(spot))
            score, n = np.zeros((len(offsets) - 1, len(logs))), np.zeros(len(offsets) - 1, np.int64)
            for bucket, text in _windows(data, offsets):
                if not len(text):
                    continue
                heads = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                n[text[heads]] += np.diff(np.concatenate((heads, [len(text)])))
                for k, row in enumerate(logs):
                    score[text[heads], k] += np.add.reduceat(row[bucket].astype(np.float64), heads)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(score * damping), kind), pa.array(n, pa.int64())],
                                             [*b.schema.names, "__score", "__windows"])

    return held.mapInArrow(run, f"{fields}, __score array<double>, __windows long").toDF(*names, "__score", "__windows")


def declared_language(value: Column, languages=LANGUAGES) -> Column:
    """The main part of a declared tag; 'other' if not among ``languages``, null if none."""
    main = F.regexp_extract(F.lower(F.trim(value)), r"^([a-z]{2,8})", 1)
    return F.when(main.isin(*languages), main).when(F.length(F.trim(value)) > 0, F.lit("other"))


def host_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, domain, suffix) of an address; null parts if there is none."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))
    domain = F.coalesce(F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)
    return host, domain, F.nullif(F.regexp_extract(host, r"\.([a-z]{2,24})$", 1), F.lit(""))


def _best(score: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in names]), F.array_position(score, F.array_max(score)).cast("int"))


def _shares(counts: DataFrame, by: str, names: list[str], prior: Column, weight: float) -> DataFrame:
    """(by, p): smoothed shares of each language. ``prior`` is an array column."""
    sums = counts.groupBy(by).agg(F.array(*[F.sum(F.when(F.col("language") == x, F.col("n")).otherwise(0)) for x in names]).alias("c"),
                                  F.sum("n").alias("all"), F.first("prior").alias("prior"))
    return sums.select(by, F.zip_with("c", prior, lambda c, p: (c + weight * p) / (F.col("all") + weight)).alias("p"))


def identify(docs: DataFrame, text_col: str = "text", declared: Column | None = None, host: Column | None = None,
             domain: Column | None = None, suffix: Column | None = None, languages=LANGUAGES, damping: float = 0.25,
             least: float = 0.5, weight: float = 20.0, undetermined: float = 0.01) -> DataFrame:
    """``docs`` with ``language``, ``language_p`` (its posterior) and ``language_kept``.

    A row is kept if a language of ``languages`` has a posterior of ``least`` or
    more; a null, empty or blank text has no language and is not kept. Evidence
    columns may be null in any row and then say nothing. Repeated rows get equal
    results, equal posteriors go to the language listed first, an empty table
    stays empty, and all other columns are kept (those named like a result give
    way to it).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    none = F.lit(None).cast("string")
    names = [*languages, UNDETERMINED]
    n = len(names)
    own = [c for c in docs.columns if c not in ("language", "language_p", "language_kept")]
    work = docs.withColumns({
        "__said": declared_language(declared if declared is not None else none, languages),
        "__host": host if host is not None else none, "__suffix": suffix if suffix is not None else none,
        "__domain": domain if domain is not None else none, "__text": F.col(text_col).cast("string")})
    model = text_model(work.select("__said", "__text"), languages)

    # how declared language, suffix, domain and host go with the text's own language
    thin = with_text_scores(work.select("__said", "__suffix", "__domain", "__host", "__text"), "__text", model, damping)
    stats = materialize(thin.where("__windows > 0").select(
        F.col("__said").alias("said"), F.col("__suffix").alias("suffix"), F.col("__domain").alias("domain"), F.col("__host").alias("host"),
        _best(F.col("__score"), names).alias("language")).groupBy("said", "suffix", "domain", "host", "language")
        .agg(F.count(F.lit(1)).alias("n")), "langid-counts")

    said = [*languages, "other"]
    seen = {(r["language"], r["said"]): r["n"] for r in stats.where("said IS NOT NULL").groupBy("language", "said")
            .agg(F.sum("n").alias("n")).collect()}  # (languages + 1) x (languages + 1) rows
    overall = {x: sum(v for (l, _), v in seen.items() if l == x) for x in names}
    says = {d: [float(np.log((seen.get((l, d), 0) + 0.5) / (overall[l] + 0.5 * len(said)))) for l in names] for d in said}
    base = {r["language"]: r["n"] for r in stats.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    known = sum(base.get(x, 0) for x in languages)
    flat = [(1 - undetermined) * (base.get(x, 0) + 1) / (known + len(languages)) for x in languages] + [undetermined]
    everywhere = F.array(*[F.lit(float(x)) for x in flat])

    by_domain = _shares(stats.where("domain IS NOT NULL").withColumn("prior", F.lit(0)), "domain", names, everywhere, weight)
    hosts = stats.where("host IS NOT NULL").join(by_domain, "domain", "left").withColumnRenamed("p", "prior")
    hosts = hosts.withColumn("prior", F.coalesce("prior", everywhere))
    by_host = materialize(_shares(hosts, "host", names, F.col("prior"), weight), "langid-hosts")
    by_suffix = stats.where("suffix IS NOT NULL").groupBy("suffix").agg(
        F.array(*[F.sum(F.when(F.col("language") == x, F.col("n")).otherwise(0)) for x in names]).alias("c"))
    sizes = F.array(*[F.lit(float(base.get(x, 0))) for x in names])
    by_suffix = materialize(by_suffix.select("suffix", F.zip_with("c", sizes, lambda c, s: F.log((c + 1.0) / (s + 2.0))).alias("said_suffix")),
                            "langid-suffixes")

    # the posterior
    full = with_text_scores(work, "__text", model, damping)
    full = (full.join(by_host.select(F.col("host").alias("__host"), F.col("p").alias("__prior")), "__host", "left")
            .join(by_suffix.select(F.col("suffix").alias("__suffix"), F.col("said_suffix").alias("__address")), "__suffix", "left"))
    nothing = F.array(*[F.lit(0.0)] * n)
    tag = nothing
    for d in said:
        tag = F.when(F.col("__said") == d, F.array(*[F.lit(x) for x in says[d]])).otherwise(tag)
    terms = [F.transform(F.coalesce("__prior", everywhere), lambda p: F.log(p)), tag, F.coalesce("__address", nothing)]
    total = F.col("__score")
    for t in terms:
        total = F.zip_with(total, t, lambda a, b: a + b)
    full = full.withColumn("__total", total)
    p = 1.0 / F.aggregate("__total", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("__total")))
    blank = ~F.coalesce(F.col("__text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    full = full.select(*[F.col(f"`{c}`") for c in own], "__total", p.alias("__p"), blank.alias("__blank"))
    language = F.when(F.col("__blank"), F.lit(UNDETERMINED)).otherwise(_best(F.col("__total"), names))
    return full.select(*[F.col(f"`{c}`") for c in own], language.alias("language"), F.col("__p").alias("language_p"),
                       (~F.col("__blank") & (language != UNDETERMINED) & (F.col("__p") >= least)).alias("language_kept"))


def identify_pages(pages: DataFrame, html_col: str = "html", url_col: str = "url", **options) -> DataFrame:
    """``identify`` with a page's own evidence: the text outside its markup, the
    language its ``html`` element declares, and its address."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    said = F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1), F.lit(""))
    host, domain, suffix = host_parts(F.col(url_col))
    got = identify(pages.withColumn("__bare", F.regexp_replace(bare, r"&[#\w]+;", " ")), "__bare", said, host, domain, suffix, **options)
    return got.drop("__bare")
