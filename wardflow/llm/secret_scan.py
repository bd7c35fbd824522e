"""Secret scans: fixed patterns, and a battery of randomness tests for the rest.

The fixed patterns find assignments, access keys and hex strings. Every other
long unbroken token is tested for being random in its inferred encoding:

* chi-squared uniformity over the encoding's alphabet (two-sided, by the
  Wilson-Hilferty cube root),
* runs above and below the middle of the alphabet,
* lag-1 serial correlation of the symbols' codes,

whose p-values Fisher's method combines. A random token's p is uniform, that of
ordinary text is near 0, and how well the two part depends on length. So the
cut is chosen per encoding and length class: with Storey's estimate of the
number of random tokens (twice those above one half), it is the lowest p at
which the share of ordinary tokens among those accepted stays under
``false_discovery``. The counts behind it are grouped aggregations over all
documents, of distinct tokens (a string that many documents repeat is one) and
then by (class, p in hundredths), so at most some hundred classes. The cut holds
for all occurrences. Few tokens make a poor estimate, so each class's counts are
shrunk towards a stated prior, ``PRIOR`` random tokens: a class with hardly any
tokens is cut at p = 0.01, one with many by its own counts.

Only Spark's own functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize

#: Fixed patterns, from the definition of the base spans.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"     # a match of AKIA[A-Z0-9]+ of 18 or more
HEX = r"[0-9a-f]{16,}"            # a run of hex digits of 16 or more
KINDS = ("assign", "access", "hex", "random")
#: Tokens to test, and their encodings: name, form, alphabet.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
_DIGITS, _UP, _LOW = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    ("base32", r"^[A-Z2-7]+$", _UP + "234567"),
    ("alnum", r"^[A-Za-z0-9]+$", _UP + _LOW + _DIGITS),
    ("base64", r"^[A-Za-z0-9+/]+$", _UP + _LOW + _DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+$", _UP + _LOW + _DIGITS + "-_"),
    ("base64mixed", r"", _UP + _LOW + _DIGITS + "+/-_"),
)
#: Random tokens added to each class, evenly over p. They let up to
#: PRIOR * false_discovery / (1 - false_discovery) more ordinary ones through per class.
PRIOR = 40
_BLOCK = 256


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _before(lengths: Column) -> Column:
    """Running sums before each element, in blocks, so that a text of many
    matches costs no quadratic copying."""
    def sums(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, v: a + v)

    def inside(ls: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / _BLOCK).cast("int")),
                             lambda b: sums(F.slice(ls, b * _BLOCK + 1, F.lit(_BLOCK))))
        heads = _let(blocks, lambda bs: F.transform(bs, lambda _, i: sums(F.slice(bs, F.lit(1), i))))
        return _let(heads, lambda hs: F.transform(ls, lambda _, i: F.get(hs, F.floor(i / _BLOCK).cast("int"))
                                                  + sums(F.slice(ls, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK))))
    return _let(lengths, lambda ls: F.when(F.size(ls) > 0, inside(ls)).otherwise(F.array().cast("array<int>")))


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, match), in code points."""
    found, rest = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def place(m: Column, p: Column) -> Column:
        steps = F.transform(m, lambda x, i: F.length(F.get(p, i)) + F.length(x))
        return _let(_before(steps), lambda at: F.transform(m, lambda x, i: F.struct(
            (F.get(at, i) + F.length(F.get(p, i))).alias("start"),
            (F.get(at, i) + F.length(F.get(p, i)) + F.length(x)).alias("end"), x.alias("match"))))
    spans = _let(F.struct(found.alias("m"), rest.alias("p")), lambda s: place(s["m"], s["p"]))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _two_sided(z: Column) -> Column:
    """Twice the normal tail beyond |z|, by the logistic approximation."""
    a = F.least(F.abs(z), F.lit(8.0))
    return F.least(F.lit(1.0), 2.0 / (1.0 + F.exp(1.5976 * a + 0.07056 * a * a * a)))


def _battery(token: Column, alphabet: str) -> Column:
    """Fisher's combination of the three tests' p-values."""
    m = float(len(alphabet))
    chars = [F.lit(c) for c in alphabet]

    def tests(s: Column) -> Column:
        n, codes = F.size(s).cast("double"), s
        total = F.aggregate(codes, F.lit(0.0), lambda a, c: a + c)
        mean = total / n
        upper = F.aggregate(codes, F.lit(0.0), lambda a, c: a + F.when(c >= m / 2, 1.0).otherwise(0.0))
        runs = F.aggregate(codes, F.struct(F.lit(0.0).alias("r"), F.lit(-1.0).alias("last")), lambda a, c: F.struct(
            (a["r"] + F.when((a["last"] < 0) | ((a["last"] >= m / 2) != (c >= m / 2)), 1.0).otherwise(0.0)).alias("r"),
            c.alias("last")), lambda a: a["r"])
        serial = _let(mean, lambda mu: F.aggregate(codes, F.struct(
            F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(None).cast("double").alias("last")), lambda a, c: F.struct(
                (a["xy"] + F.coalesce(a["last"] * (c - mu), F.lit(0.0))).alias("xy"),
                (a["xx"] + (c - mu) * (c - mu)).alias("xx"), (c - mu).alias("last")),
            lambda a: F.when(a["xx"] > 0, a["xy"] / a["xx"]).otherwise(1.0)))
        expected = 2.0 * upper * (n - upper) / n + 1.0
        spread = (expected - 1.0) * (expected - 2.0) / (n - 1.0)
        z_runs = F.when(spread > 0, (runs - expected) / F.sqrt(spread)).otherwise(8.0)
        return F.struct(z_runs.alias("runs"), (serial * F.sqrt(n)).alias("serial"))

    n = F.length(token).cast("double")
    squares = F.aggregate(F.transform(F.array(*chars), lambda c: n - F.length(F.replace(token, c, F.lit("")))),
                          F.lit(0.0), lambda a, o: a + o * o)
    df = m - 1.0
    chi = (F.pow(F.greatest(squares * m / n - n, F.lit(0.0)) / df, 1.0 / 3) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
    codes = F.transform(F.split(token, "", -1), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))
    codes = F.filter(codes, lambda c: c >= 0)

    def fisher(t: Column) -> Column:
        return _let(-(F.log(_two_sided(chi)) + F.log(_two_sided(t["runs"])) + F.log(_two_sided(t["serial"]))),
                    lambda y: F.exp(-y) * (1.0 + y + y * y / 2.0))
    return _let(_let(codes, tests), fisher)


def _tested(token: Column) -> Column:
    """(length class, p, hash) of a token; the class holds its encoding."""
    bare = F.regexp_replace(token, "=+$", "")

    def choose(t: Column) -> Column:
        size = F.floor(F.log2(F.length(t).cast("double")) * 2).cast("int")
        out = None
        for name, form, alphabet in reversed(ENCODINGS):
            value = F.struct(F.concat(F.lit(name + ":"), size.cast("string")).alias("stratum"),
                             _battery(F.lower(t) if name == "hex" else t, alphabet).alias("p"), F.xxhash64(t).alias("token"))
            out = value if out is None else F.when(t.rlike(form), value).otherwise(out)
        return out
    return _let(bare, choose)


def _as_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def _count(kind: int) -> Column:
    return F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")


def _spans(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``__base`` (array of start, kind number, end) and ``__tokens``
    (array of start, end, stratum, p, hash of the token)."""
    assign = F.filter(_matches(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= 12)
    parts = [_as_kind(spans, k) for k, spans in enumerate((assign, _matches(text, ACCESS), _matches(text, HEX)))]
    docs = docs.withColumn("__base", F.sort_array(F.concat(*parts)))
    tokens = F.filter(_matches(text, TOKEN), lambda x: ~x["match"].rlike("^[0-9a-f]+$") & ~F.exists(
        "__base", lambda b: (b["kind"] < 2) & (b["start"] < x["end"]) & (x["start"] < b["end"])))
    tested = F.transform(tokens, lambda x: _let(_tested(x["match"]), lambda t: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), t["stratum"].alias("stratum"), t["p"].alias("p"), t["token"].alias("token"))))
    return docs.withColumn("__tokens", tested)


def _cuts(found: DataFrame, false_discovery: float) -> DataFrame:
    """Per stratum the lowest accepted p, in hundredths. Strata are encodings by
    half octaves of length, so there are a few hundred at most."""
    bins = (found.select(F.explode("__tokens").alias("t"))
            .select("t.stratum", F.floor(F.col("t.p") * 100).cast("int").alias("bin"), "t.token").distinct().groupBy("stratum", "bin")
            .agg(F.count(F.lit(1)).alias("n")))
    classes = bins.groupBy("stratum").agg(F.collect_list(F.struct("bin", "n")).alias("bins"))  # 101 at most

    def held(least: Column) -> Column:
        return F.aggregate("bins", F.lit(0).cast("long"), lambda a, x: a + F.when(x["bin"] >= least, x["n"]).otherwise(0))

    def fits(b: Column) -> Column:
        share, above = 1 - b / 100, held(b)
        ordinary = F.greatest(above - 2 * F.col("half") * share, F.lit(0.0))
        return ordinary <= false_discovery * (above + PRIOR * share)
    cuts = F.filter(F.sequence(F.lit(1), F.lit(100)), fits)
    return (classes.withColumn("half", held(F.lit(50))).select("stratum", F.array_min(cuts).alias("cut")).where("cut IS NOT NULL"))


def scan(docs: DataFrame, text_col: str = "text", false_discovery: float = 0.05, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (start, kind, end) by start and then
    kind (numbers into ``KINDS``), in code points, end exclusive.

    The text (unless ``keep_text`` is false) and all other columns are kept. Null and empty texts have no spans.
    Rows are scanned one by one, repeated rows alike; an empty table stays empty.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = _spans(docs, text)
    found = materialize(found if keep_text else found.drop(text_col), "secret-spans")
    cuts = {r["stratum"]: r["cut"] for r in _cuts(found, false_discovery).collect()}  # one row per stratum
    cut = F.map_from_arrays(F.array(*[F.lit(k) for k in cuts]).cast("array<string>"),
                            F.array(*[F.lit(v) for v in cuts.values()]).cast("array<int>"))
    random = F.filter("__tokens", lambda t: F.coalesce(F.floor(t["p"] * 100) >= F.try_element_at(cut, t["stratum"]), F.lit(False)))
    return found.withColumn("secret_spans", F.sort_array(F.concat("__base", _as_kind(random, 3)))).drop("__base", "__tokens")


def listing(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: counts and hash of the base spans, and all spans."""
    got = scan(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__text", keep_text=False)
    base = F.filter("secret_spans", lambda x: x["kind"] < 3)
    return got.select(F.col("__id").alias(id_col), *[_count(k) for k in range(3)], F.sha2(listing(base), 256).alias("base_sha256"),
                      listing(F.col("secret_spans")).alias("spans"))


#: Code points of the pieces, and of the blocks in them, that ``redact`` masks one by one.
PIECE, BLOCK = 1 << 20, 1 << 12


def _masked(text: Column, begin: Column, spans: Column, mask: str) -> Column:
    """A block of text that begins at ``begin`` of the whole, with the spans that start
    in it replaced, and without what earlier ones cover."""
    end = begin + F.length(text)
    reached = F.greatest(begin, F.coalesce(F.array_max(F.transform(F.filter(spans, lambda s: s["start"] < begin), lambda s: s["end"])), begin))
    own = F.filter(spans, lambda s: (s["start"] >= begin) & (s["start"] < end))

    def plain(a: Column, b: Column) -> Column:
        return F.substring(text, a - begin + 1, F.greatest(b - a, F.lit(0)))
    return F.aggregate(own, F.struct(F.lit("").alias("out"), reached.alias("at")), lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(a["out"], plain(a["at"], s["start"]), F.lit(mask))).otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at")), lambda a: F.concat(a["out"], plain(a["at"], end)))


def _blocks(text: Column, begin: Column, spans: Column, size: int, each) -> Column:
    """``each`` of the blocks of a text that begins at ``begin``, joined. A block gets
    the spans that reach into it."""
    def one(i: Column) -> Column:
        at = begin + i * size
        near = F.filter(spans, lambda s: (s["end"] > at) & (s["start"] < at + size))
        return _let(F.substring(text, i * size + 1, F.lit(size)), lambda part: _let(near, lambda some: each(part, at, some)))
    last = F.floor((F.length(text) - 1) / size).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), one), "")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mask``; a
    null text stays null, and other columns are as they were, whatever their names.

    A text is cut into pieces and those into blocks, and each block is built once,
    so a very long text with very many secrets takes time in proportion to both.
    """
    names = docs.columns
    held = docs.toDF(*[f"c{i}" for i in range(len(names))])
    name = f"c{names.index(text_col)}"
    text, spans = F.col(name), F.col("secret_spans")
    cut = _blocks(text, F.lit(0), spans, PIECE, lambda piece, at, some: _blocks(
        piece, at, some, BLOCK, lambda part, begin, own: _masked(part, begin, own, mask)))
    return scan(held, name).withColumn(name, F.when(F.size(spans) > 0, cut).otherwise(text)).drop("secret_spans").toDF(*names)
