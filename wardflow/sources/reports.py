"""Sources and sinks: monthly reports, raw and mart tables, seeds, curation
tables, the completeness gate.

Raw tables are all-string and partitioned by ``competencia`` (period text
``YYYY-MM``).  Reloading a period is a dynamic partition overwrite: only the
partitions present in the new data are replaced, every other period survives.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIOD = "competencia"
PERIOD_FROM_NAME = r"_([0-9]{4})_([0-9]{2})(?:[^0-9]|$)"
# fixed values: file-name substrings → dataset, in precedence order
ROUTES = (("atendimentos", "atendimentos"), ("internacoes", "internacoes"),
          ("movimentacoes", "movimentacoes"))
LOCK_PREFIX = "locks/"
# fixed values: report header markers of the movements report and the cells
# that hold the unit and the date
UNIT_MARKER = "Unidade de Internação"
DATE_MARKER = "Data:"
UNIT_CELL = 6
DATE_CELL = 2
# fixed values: PII columns dropped before storage
VISIT_PII = ("NM_PACIENTE", "DT_NASC", "ENDERECO", "USUARIO_CLASSIF", "USUARIO_CAD_RECEPCAO",
             "USUARIO_ALTA", "TOTAL_CONTA", "CONTA", "CONTA_FECHADA", "REGISTRO_ANS")
ADMISSION_PII = ("PACIENTE", "CID_INT", "CD_PRESTADOR", "CD_LEITO")
MOVEMENT_PII = ("NM_PACIENTE",)


# the parser takes a fresh buffer for every line, of 2 MB if it isn't told
LINE_OPTIONS = {"inputBufferSize": "4096"}


# ---------------------------------------------------------------- file names

def period_from_path(path: Column | str) -> Column:
    """``…/tipo_YYYY_MM.ext`` → ``YYYY-MM`` (NULL when the name has none)."""
    p = F.col(path) if isinstance(path, str) else path
    y = F.regexp_extract(p, PERIOD_FROM_NAME, 1)
    m = F.regexp_extract(p, PERIOD_FROM_NAME, 2)
    return F.when(y != "", F.concat_ws("-", y, m))


def route_source(path: Column | str, routes: Sequence[tuple[str, str]] = ROUTES) -> Column:
    """Dataset of a file by name substring (first match wins); lock files and
    unknown names give NULL (rejected).  The name is the file name and its
    folder, since writers such as Spark put ``part-*`` files in a folder named
    after the report."""
    p = F.col(path) if isinstance(path, str) else path
    parts = F.split(p, "/")
    name = F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1))
    out = F.when(p.contains(LOCK_PREFIX), F.lit(None).cast("string"))
    for needle, target in routes:
        out = out.when(name.contains(needle), F.lit(target))
    return out


# ---------------------------------------------------------------- projections

def drop_pii(df: DataFrame, cols: Sequence[str], required: bool = False) -> DataFrame:
    """Without the personal columns, however their names are cased or padded.
    With ``required`` a report that lacks one of them is refused: a renamed
    column would otherwise be stored unnoticed."""
    def plain(c: str) -> str:
        return c.strip().upper()
    private = {plain(c) for c in cols}
    missing = private - {plain(c) for c in df.columns}
    if required and missing:
        raise ValueError(f"personal columns not found, report refused: {sorted(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if plain(c) not in private])


def all_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# ---------------------------------------------------------------- reports

def read_report(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                sep: str = ",") -> DataFrame:
    """Tabular report with a header row; every column read as text; the
    period comes from the file name; ``__row`` orders the rows of a file
    (split start, then position inside the split) for keep-first dedup."""
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        df = spark.read.csv(path, header=True, sep=sep, schema=schema, enforceSchema=False)
    else:
        df = spark.read.csv(path, header=True, sep=sep, inferSchema=False)
    return df.withColumns({
        PERIOD: period_from_path(F.col("_metadata.file_path")),
        "__row": F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                          F.monotonically_increasing_id().alias("i")),
    })


def csv_cells(line: Column | str, n: int, sep: str = ",") -> Column:
    """The first ``n`` cells of a text line as an array (missing ones NULL), parsed
    once: fields taken from the parsed row one by one would each parse the line."""
    row = F.from_csv(line, ", ".join(f"_c{i} string" for i in range(n)), {"sep": sep, **LINE_OPTIONS})
    return F.get(F.transform(F.array(row), lambda r: F.array(*[r.getField(f"_c{i}") for i in range(n)])), 0)


def split_cells(lines: DataFrame, ncols: int = 20, sep: str = ",") -> DataFrame:
    """``value`` → ``cells``, an array of ``ncols`` cells (missing ones NULL).  A
    line with more cells than ``ncols`` fails the job instead of losing them."""
    too_long = F.raise_error(F.concat(F.lit(f"line of more than {ncols} cells in "), F.col("file"))).cast("array<string>")
    parsed = lines.select("file", "blk", "pos", csv_cells("value", ncols + 1, sep).alias("cells"))
    return parsed.withColumn("cells", F.when(F.get("cells", ncols).isNull(), F.slice("cells", 1, ncols)).otherwise(too_long))


def read_cells(spark: SparkSession, path: str, ncols: int = 20, sep: str = ",") -> DataFrame:
    """Headerless positional report → ``file, blk, pos, cells`` where
    ``(blk, pos)`` orders the lines of a file.

    ``blk`` is the start offset of the file split that holds the line and
    ``pos`` a per-task increasing id, so no task ever holds a whole file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("blk"),
        F.monotonically_increasing_id().alias("pos"), "value")
    return split_cells(lines, ncols, sep)


def carry_headers(cells: DataFrame, unit_marker: str = UNIT_MARKER, date_marker: str = DATE_MARKER,
                  unit_cell: int = UNIT_CELL, date_cell: int = DATE_CELL) -> DataFrame:
    """Header rows set the current unit / date; carry them down to the data
    rows of the same file (parallel scan by file split)."""
    from wardflow.operators.scan import forward_fill
    c0 = F.get(F.col("cells"), 0)
    marked = cells.withColumns({
        "UNIDADE": F.when(c0.startswith(unit_marker), F.get(F.col("cells"), unit_cell)),
        "DATA": F.when(F.trim(c0) == date_marker, F.get(F.col("cells"), date_cell)),
    })
    # a header row resets its own field even when the cell is empty
    return forward_fill(marked, ["UNIDADE", "DATA"], partition_by=["file"],
                        order_by=["blk", "pos"], block_by="blk")


# ---------------------------------------------------------------- writes

def write_raw(df: DataFrame, root: str, partition: str = PERIOD, mode: str = "append") -> None:
    all_string(df).hint("rebalance", partition).write.mode(mode).partitionBy(partition).parquet(root)


def overwrite_period(df: DataFrame, root: str, partition: str = PERIOD) -> None:
    """Idempotent reload: replace exactly the partitions present in ``df``."""
    (all_string(df).hint("rebalance", partition).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(root))


def interleaved(df: DataFrame, keys: Sequence[str], bits: int = 6, column: str = "__z") -> DataFrame:
    """``df`` with the place of each row on a space-filling curve over ``keys``: the bits
    of the keys' ranks by turns, so that rows near each other in every key are near
    each other in the order, and no key comes before the others.

    A key's ranks are 2^bits ranges of its distinct values, found by a range
    partitioning of them (no task sees them all) and stored, so that one value has one
    rank wherever it is read.
    """
    from wardflow.session import materialize
    place = F.lit(0)
    for k, key in enumerate(keys):
        ranges = df.select(F.col(key).alias("__v")).distinct().repartitionByRange(1 << bits, "__v")
        ranges = materialize(ranges.select("__v", F.spark_partition_id().alias("__part")), "mart-ranges")
        # few values fill few ranges: spread them over all bits, else they would only order what the other keys leave
        used = (ranges.agg(F.max("__part")).first()[0] or 0) + 1
        ranges = ranges.select("__v", F.floor(F.col("__part") * (1 << bits) / used).cast("int").alias(f"__r{k}"))
        df = df.join(ranges, df[key].eqNullSafe(ranges["__v"])).drop("__v")
        for bit in range(bits):
            one = F.shiftright(F.col(f"__r{k}"), bit).bitwiseAND(F.lit(1))
            place = place + F.shiftleft(one, bit * len(keys) + (len(keys) - 1 - k))
    return df.withColumn(column, place).drop(*[f"__r{k}" for k in range(len(keys))])


def write_mart(df: DataFrame, root: str, partition: str = PERIOD,
               cluster_by: Sequence[str] = (), mode: str = "overwrite", interleave: bool = False, parts: int | None = None,
               by_period: bool = False) -> None:
    """Mart partitioned by period; optionally clustered (range partition +
    sort inside each period) so Parquet min/max statistics can skip.  Sorted, the
    first key skips best and the last hardly; with ``interleave`` all keys skip alike.
    ``parts``: number of ranges (default: Spark's).  ``by_period``: ``df`` is read, row
    by row, from files that hold a period each, so it is not shuffled: a task writes no
    more files than it reads."""
    out = df if by_period else df.hint("rebalance", partition)   # few files per period, a large period over many tasks
    if cluster_by:
        order = [partition, *(["__z"] if interleave else cluster_by)]
        placed = interleaved(df, cluster_by) if interleave else df
        ranged = placed.repartitionByRange(parts, *order) if parts else placed.repartitionByRange(*order)
        out = ranged.sortWithinPartitions(*order).drop("__z")
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(root))


def append_records(df: DataFrame, root: str) -> None:
    df.write.mode("append").parquet(root)


def write_seed(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_seed(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ";",
              dedup: bool = True) -> DataFrame:
    """Static reference CSV; repeated rows are removed (a repeated code would
    multiply the rows of every join)."""
    df = spark.read.csv(path, header=True, sep=sep, schema=schema)
    return df.dropDuplicates() if dedup else df


def layer_path(root: str, layer: str, table: str) -> str:
    return os.path.join(root, layer, table)


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, "raw", name))


# ---------------------------------------------------------------- curation

CURATION_SCHEMAS = {
    "curadoria_inconsistencias": "id_inconsistencia string, tipo string, teste string, "
                                 "nr_atendimento bigint, competencia date, servico string, "
                                 "detectado_em timestamp, status string",
    "curadoria_imputacao_integridade": "id_imputacao string, id_inconsistencia string, "
                                       "campo_afetado string, valor_original string, "
                                       "valor_imputado string, decidido_por string, decidido_em timestamp",
    "curadoria_decisao_logica": "id_decisao string, id_inconsistencia string, flag_prevalece string, "
                                "justificativa string, decidido_por string, decidido_em timestamp",
    "curadoria_conversao": "CD_ATENDIMENTO string, decisao string, competencia date, "
                           "atend_internacao string, destino string, unidade string, tipo string, "
                           "decidido_por string, decidido_em timestamp",
}


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The Parquet table at ``path`` (any location Spark reads), or no rows if
    there is no such path.  Any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_curation(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four curation tables; a table not yet written reads as empty."""
    return {name: read_or_empty(spark, layer_path(root, "curadoria", name), schema)
            for name, schema in CURATION_SCHEMAS.items()}


# ---------------------------------------------------------------- gate

def ready_periods(sources: Mapping[str, DataFrame], period: str = PERIOD) -> DataFrame:
    """Row count of every source per period and whether all sources have at
    least one row (the completeness gate)."""
    names = list(sources)
    u = None
    for n, df in sources.items():
        part = df.select(F.lit(n).alias("__src"), F.col(period).alias(period))
        u = part if u is None else u.unionByName(part)
    counts = u.groupBy(period).pivot("__src", names).agg(F.count(F.lit(1)))
    counts = counts.select(period, *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(f"n_{n}") for n in names])
    present = sum((F.when(F.col(f"n_{n}") > 0, 1).otherwise(0) for n in names), F.lit(0))
    return (counts.withColumn("n_fontes", present.cast("long"))
                  .withColumn("pronto", F.when(F.col("n_fontes") == len(names), 1).otherwise(0)))
