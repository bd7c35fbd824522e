"""File arrival → load just that file (Structured Streaming re-aim of the
event trigger).

A file stream over the landing folder, ``trigger(availableNow=True)``: each
run picks up only files not seen before (the checkpoint remembers them), routes
every row to its dataset by file name, stamps the period from the name, and
reloads exactly that period of the raw table (dynamic partition overwrite),
so a re-delivered or corrected file replaces its period instead of
duplicating it.

What the batches know is kept in control tables under the sink, each batch
writing its own folder, so a batch that is repeated after a failure changes
nothing:

* ``relatorios`` – every report seen (dataset, period, version, rows, refusal).  The
  newest accepted report of a dataset and period, of all batches and streams, is
  the one loaded; how files fall into batches does not matter.
* ``cargas`` – rows read, stored and left out, by report and reason.
* ``inicios`` – one claim per period that has become complete in all sources:
  the transform starts once, whichever batch or stream completes the period.
"""

from __future__ import annotations

import hashlib
import logging
import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.session import materialize, scratch_path
from wardflow.sources import control
from wardflow.sources.contracts import CONTRACTS, Contract, plain
from wardflow.sources.reports import (ADMISSION_PII, MOVEMENT_PII, PERIOD, VISIT_PII, csv_cells, drop_pii, overwrite_period,
                                     period_from_path, read_or_empty, ready_periods, route_source, split_cells)

COMPANY = "HSR"   # fixed value: the only company whose visits are loaded
SOURCES = ("atendimentos", "internacoes", "movimentacoes")
LOG = logging.getLogger("wardflow.ingest")
ROW_ORDER = ("__path", "__blk", "__pos")   # file, split start, position in the split
REPORTS = f"dataset string, {PERIOD} string, relatorio string, versao timestamp, linhas long, recusa string"
LOADS = f"dataset string, {PERIOD} string, relatorio string, motivo string, linhas long"


def _keep_first(df: DataFrame, key: str) -> DataFrame:
    """Keep the first row of each key in file order (partial top-1 before the
    shuffle, so a repeated key costs one row per task)."""
    if key not in df.columns:
        return df
    from wardflow.operators.link import top1
    # per period: one load of many reports keeps what loads of one report each keep
    return top1(df, [PERIOD, key], [c for c in ROW_ORDER if c in df.columns])


@dataclass(frozen=True)
class Loader:
    """The load step of a dataset, applied before anything is stored: other
    companies' rows and repeated ids go, and so do the personal columns."""

    key: str
    personal: tuple[str, ...]
    company: str | None = None

    def own(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("EMPRESA") == self.company) if self.company and "EMPRESA" in df.columns else df

    def __call__(self, df: DataFrame) -> DataFrame:
        return drop_pii(_keep_first(self.own(df), self.key), self.personal)


DEFAULT_LOADERS = {
    "atendimentos": Loader("CD_ATENDIMENTO", VISIT_PII, COMPANY),
    "internacoes": Loader("ATENDIMENTO", ADMISSION_PII),
    "movimentacoes": lambda df: drop_pii(df, MOVEMENT_PII),
}


def _with_file(df: DataFrame) -> DataFrame:
    """File, split and modification time of every row of a plain file scan."""
    return df.withColumns({"__path": F.col("_metadata.file_path"),
                           "__blk": F.col("_metadata.file_block_start"),
                           "__mtime": F.col("_metadata.file_modification_time")})


def _folder(path: str = "__path") -> Column:
    """The folder of a ``part-*`` file, such as a writer like Spark puts there: the
    folder is the report.  NULL for a file that is a report itself."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name.startswith("part-"), F.regexp_replace(path, "/[^/]*$", ""))


def _numbered(scan: DataFrame) -> DataFrame:
    """Rows of a plain file scan with their position: ids follow the file order."""
    return scan.withColumn("__pos", F.monotonically_increasing_id())


def _reject(rejected: DataFrame, sink: str, epoch: int) -> None:
    """Paths of rejected files, one folder per micro-batch: a retry overwrites it."""
    (rejected.select("__path").write.mode("overwrite")
     .parquet(os.path.join(sink, "_rejeitados", f"lote={epoch}")))


# ---------------------------------------------------------------- text reports

def _headers(lines: DataFrame, files: DataFrame) -> DataFrame:
    """(__path, __first, names): the first line of each file, as column names."""
    first = lines.join(files.select("__path", "__first"), "__path").where(F.col("__pos") == F.col("__first"))
    return first.select("__path", "__first", plain(F.split("value", ",")).alias("names"))


def _refusals(headers: DataFrame, contracts: dict[str, Contract]) -> DataFrame:
    """(__path, recusa): why a file is refused, null if it may be loaded."""
    dataset, problems = route_source("__path"), F.array().cast("array<string>")
    for name, contract in contracts.items():
        problems = F.when(dataset == name, contract.problems(F.col("names"))).otherwise(problems)
    return headers.select("__path", F.nullif(F.array_join(problems, "; "), F.lit("")).alias("recusa"))


MOST_COLUMNS = 128


def _by_name(lines: DataFrame, headers: DataFrame, contract: Contract) -> DataFrame:
    """The stored columns of tabular report lines, found by the names in each file's
    header; columns that a file lacks are null.  Lines are parsed as far as the widest
    header goes: the parser's time follows the cells it is asked for."""
    widest = headers.agg(F.max(F.size("names"))).first()[0] or 1
    # where a column is follows from the file alone: looked up once a file, not once a line
    places = headers.select("__path", "__first", *[(F.array_position("names", c).cast("int") - 1).alias(f"__at{i}") for i, c in enumerate(contract.stored)])
    rows = lines.join(materialize(places, "ingest-places"), "__path").where(F.col("__pos") != F.col("__first"))
    rows = rows.withColumn("__cells", csv_cells("value", min(widest, MOST_COLUMNS)))
    return rows.select(*[F.get("__cells", f"__at{i}").alias(c) for i, c in enumerate(contract.stored)], PERIOD, *ROW_ORDER)


def _movements(lines: DataFrame) -> DataFrame:
    from wardflow.plans.domain import movements_from_cells
    return movements_from_cells(split_cells(lines.select(F.col("__path").alias("file"), F.col("__blk").alias("blk"),
                                                         F.col("__pos").alias("pos"), "value")))


# ---------------------------------------------------------------- one batch

class Arrivals:
    """The load of one micro-batch (``foreachBatch`` function).

    ``read_folders(spark, paths)`` reads whole report folders again; ``loaders``
    load rows of a table-shaped batch; with ``contracts`` the batch is lines of
    text: headers are checked, and columns found by name (movements by position).
    ``on_ready(spark, periods)`` starts the transform of periods now complete.
    """

    def __init__(self, sink: str, read_folders, writer: str, loaders: dict | None = None,
                 contracts: dict[str, Contract] | None = None, on_ready: Callable | None = None):
        self.sink, self.read_folders, self.writer = sink, read_folders, writer
        self.loaders = DEFAULT_LOADERS if loaders is None else loaders
        self.contracts, self.on_ready = contracts, on_ready

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # a part file that arrives late belongs to a report whose other files
        # were loaded before: the period is overwritten, so read the whole folder
        paths = batch.select("__path").distinct().select("__path", _folder().alias("__folder"))
        found = paths.groupBy("__folder").agg(F.count(F.lit(1))).collect()  # reports of the batch
        folders = [r[0] for r in found if r[0] is not None]
        lines = _numbered(batch)
        if folders:
            again = _numbered(self.read_folders(spark, folders))
            lines = again if len(folders) == len(found) else lines.where(_folder().isNull()).unionByName(again)
        # one pass over the files; what follows reads the stored columns it needs
        lines = lines.withColumn("__to", F.coalesce(route_source("__path"), F.lit("rejeitar")))
        path = scratch_path(spark, "ingest")
        lines.write.partitionBy("__to").parquet(path)
        stored = spark.read.schema(lines.schema).parquet(path)
        files = materialize(self._files(stored), "ingest-files")
        headers = refused = None
        if self.contracts is not None:  # two rows a file; stored, since the lines below are joined with them
            tabular = F.col("__to").isin(list(self.contracts))
            headers = materialize(_headers(stored.where(tabular), files.where("__first IS NOT NULL")), "ingest-headers")
            refused = _refusals(headers, self.contracts)
        mine = control.record(self._reports(files, refused), self.sink, "relatorios", self.writer, epoch)
        # Chosen by aggregates over the reports (one row each) joined back, never a
        # window over a period.
        known = control.recorded(spark, self.sink, "relatorios", REPORTS).where("recusa IS NULL")
        newest = (known.join(mine.select("dataset", PERIOD).distinct(), ["dataset", PERIOD], "left_semi")
                       .groupBy("dataset", PERIOD).agg(F.max_by("relatorio", F.struct("versao", "relatorio")).alias("__newest")))
        newest = materialize(newest, "ingest-newest").select(F.col("dataset").alias("__dataset"), PERIOD, "__newest")
        chosen = materialize(files.join(newest, ["__dataset", PERIOD]).where(F.col("__report") == F.col("__newest"))
                             .select("__path", "__dataset", PERIOD, "__report", "n"), "ingest-chosen")
        kept = [c for c in stored.columns if c not in ("__to", "__mtime", PERIOD)]
        counts = [self._left_out(mine, newest)]
        for name in SOURCES:
            own = chosen.where(F.col("__dataset") == name)
            if not own.isEmpty():
                part = stored.where(F.col("__to") == name).select(*kept).join(own.select("__path", PERIOD), "__path")
                counts += self._load(name, part, own, headers)
        audit = control.record(reduce(DataFrame.unionByName, counts), self.sink, "cargas", self.writer, epoch)
        for r in audit.groupBy("dataset", "motivo").agg(F.sum("linhas").alias("n")).collect():  # some dozen rows
            LOG.info("%s lote %s: %s %s", r.dataset, epoch, r.n, r.motivo)
        rejected = files.where(F.col("__dataset").isNull() | F.col(PERIOD).isNull())
        if not rejected.isEmpty():
            _reject(rejected, self.sink, epoch)
        self._start(spark, mine, epoch)

    def _files(self, stored: DataFrame) -> DataFrame:
        """A row per file of the batch: its dataset, period and report, which follow from
        its name, its time and rows, and the position of its first row."""
        first = F.min(F.when(F.col("__blk") == 0, F.col("__pos")))
        files = stored.groupBy("__path").agg(F.max("__mtime").alias("m"), F.count(F.lit(1)).alias("n"), first.alias("__first"))
        return files.withColumns({"__dataset": route_source("__path"), PERIOD: period_from_path("__path"),
                                  "__report": F.coalesce(_folder(), "__path")})

    def _reports(self, files: DataFrame, refused: DataFrame | None) -> DataFrame:
        """A row per report of the batch, in the form of REPORTS."""
        files = files.join(refused, "__path", "left") if refused is not None else files.withColumn("recusa", F.lit(None).cast("string"))
        got = files.groupBy("__dataset", PERIOD, "__report").agg(F.max("m").cast("timestamp").alias("versao"), F.sum("n").alias("linhas"),
                                                                 F.array_join(F.array_sort(F.collect_set("recusa")), "; ").alias("recusa"))
        return got.select(F.col("__dataset").alias("dataset"), PERIOD, F.col("__report").alias("relatorio"), "versao", "linhas",
                          F.nullif("recusa", F.lit("")).alias("recusa"))

    def _left_out(self, mine: DataFrame, newest: DataFrame) -> DataFrame:
        """Reports that are not loaded, with the reason, as in LOADS; and the rows read of all."""
        known = mine.join(newest.withColumnRenamed("__dataset", "dataset"), ["dataset", PERIOD], "left")
        reason = (F.when(F.col("dataset").isNull(), "sem_destino").when(F.col(PERIOD).isNull(), "sem_competencia")
                  .when(F.col("recusa").isNotNull(), "recusado").when(F.col("relatorio") != F.col("__newest"), "substituido"))
        out = known.select("dataset", PERIOD, "relatorio", reason.alias("motivo"), "linhas").where("motivo IS NOT NULL")
        return out.unionByName(mine.select("dataset", PERIOD, "relatorio", F.lit("lidas").alias("motivo"), "linhas"))

    def _load(self, name: str, lines: DataFrame, files: DataFrame, headers: DataFrame | None) -> list[DataFrame]:
        """Store the newest reports of a dataset, the ``lines`` of ``files``; their counts, as in LOADS."""
        load = self.loaders.get(name)
        read = files.groupBy(PERIOD).agg(F.first("__report").alias("relatorio"), F.sum("n").alias("linhas"))
        if self.contracts is None:
            rows = lines
        elif name in self.contracts:
            headers = headers.join(files.select("__path", PERIOD), "__path")
            rows = materialize(_by_name(lines, headers.drop(PERIOD), self.contracts[name]), f"ingest-{name}")
        else:
            rows = materialize(_movements(lines), "movements")
        counts = {"outra_empresa": None, "gravadas": None}
        target = os.path.join(self.sink, name)
        kept = (load(rows) if load else rows).drop(*ROW_ORDER)
        overwrite_period(kept, target)
        # the periods just stored hold the rows of these reports and no others
        back = kept.sparkSession.read.parquet(target).withColumn(PERIOD, F.col(PERIOD).cast("string"))
        counts["gravadas"] = back.join(read.select(PERIOD), PERIOD, "left_semi").groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n"))
        if isinstance(load, Loader):
            data = rows.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("n"))
            own = load.own(rows).groupBy(PERIOD).agg(F.count(F.lit(1)).alias("m"))
            counts["outra_empresa"] = data.join(own, PERIOD, "left").select(PERIOD, (F.col("n") - F.coalesce("m", F.lit(0))).alias("n"))
        joined = read
        for reason, frame in counts.items():
            joined = (joined.join(frame.withColumnRenamed("n", reason), PERIOD, "left") if frame is not None
                      else joined.withColumn(reason, F.lit(0).cast("long")))
        rest = F.col("linhas") - F.coalesce("outra_empresa", F.lit(0)) - F.coalesce("gravadas", F.lit(0))
        if self.contracts is not None and name in self.contracts:
            joined = joined.join(headers.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("cabecalho")),
                                 PERIOD, "left")
            rest = rest - F.col("cabecalho")
        else:
            joined = joined.withColumn("cabecalho", F.lit(0).cast("long"))
        positional = self.contracts is not None and name not in self.contracts
        joined = joined.withColumn("sem_dados" if positional else "repetidas", rest)
        reasons = ["gravadas", "outra_empresa", "cabecalho", "sem_dados" if positional else "repetidas"]
        pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("motivo"), F.coalesce(F.col(r), F.lit(0)).cast("long").alias("linhas")) for r in reasons]))
        out = joined.select(PERIOD, "relatorio", pairs.alias("p")).select(F.lit(name).alias("dataset"), PERIOD, "relatorio", "p.motivo", "p.linhas")
        return [out.where("linhas > 0")]

    def _start(self, spark: SparkSession, mine: DataFrame, epoch: int) -> None:
        """Claim the periods of this batch that all sources now have, and start those won.
        A batch repeated after a failure owns its claims and starts what it did not end."""
        touched = mine.where(f"recusa IS NULL AND dataset IS NOT NULL AND {PERIOD} IS NOT NULL").select(PERIOD).distinct()
        raw = {n: read_or_empty(spark, os.path.join(self.sink, n), f"{PERIOD} string").join(touched, PERIOD, "left_semi") for n in SOURCES}
        ready = [r[0] for r in ready_periods(raw, PERIOD).where("pronto = 1").select(PERIOD).orderBy(PERIOD).collect()]  # periods of a batch
        owner, ended = f"{self.writer} {epoch}", control.control_path(self.sink, "terminos")
        won = [p for p in ready if control.claim(spark, os.path.join(starts_path(self.sink), p), owner)
               and not control.exists(spark, os.path.join(ended, p))]
        if won and self.on_ready:
            self.on_ready(spark, won)
        for p in won:
            control.claim(spark, os.path.join(ended, p), owner)


def starts_path(sink: str) -> str:
    return control.control_path(sink, "inicios")


def starts(spark: SparkSession, sink: str) -> DataFrame:
    """(competencia, escritor, lote): the batch that started each period's transform."""
    held = control.claims(spark, starts_path(sink))
    return held.select(F.element_at(F.split("path", "/"), -1).alias(PERIOD), F.split_part("owner", F.lit(" "), F.lit(1)).alias(control.WRITER),
                       F.split_part("owner", F.lit(" "), F.lit(2)).cast("long").alias(control.EPOCH))


def load_audit(spark: SparkSession, sink: str) -> DataFrame:
    """Rows by report and reason, of all batches; ``lidas`` is the sum of the other reasons."""
    return control.recorded(spark, sink, "cargas", LOADS)


def report_versions(spark: SparkSession, sink: str) -> DataFrame:
    """Every report seen, with its refusal, and whether it is the one now loaded."""
    seen = (control.recorded(spark, sink, "relatorios", REPORTS).groupBy("dataset", PERIOD, "relatorio")
            .agg(F.max(F.struct("versao", control.EPOCH, "linhas", "recusa")).alias("last")).select("dataset", PERIOD, "relatorio", "last.*"))
    newest = seen.where("recusa IS NULL").groupBy("dataset", PERIOD).agg(F.max_by("relatorio", F.struct("versao", "relatorio")).alias("n"))
    both = seen.join(newest, ["dataset", PERIOD], "left")
    return both.select("dataset", PERIOD, "relatorio", "versao", "linhas", "recusa",
                       F.coalesce(F.col("relatorio") == F.col("n"), F.lit(False)).alias("vigente"))


# ---------------------------------------------------------------- streams

def _writer(checkpoint: str) -> str:
    """One name for all runs of a stream."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def _run(stream: DataFrame, load: Arrivals, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_available(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                     schema: T.StructType, fmt: str = "parquet", options: dict | None = None,
                     loaders: dict | None = None, on_ready: Callable | None = None) -> None:
    """Process every file that arrived since the last run, then stop.
    ``options`` go to the file reader (e.g. ``{"header": "true"}`` and a
    ``pathGlobFilter`` for CSV reports read with an all-string schema);
    ``loaders`` (default: company filter and PII drop) run per dataset
    before the period is stored."""
    opts = {**(options or {}), "recursiveFileLookup": "true"}

    def read_folders(session: SparkSession, folders: list[str]) -> DataFrame:
        return _with_file(session.read.format(fmt).schema(schema).options(**opts).load(folders))

    stream = _with_file(spark.readStream.format(fmt).schema(schema).options(**opts).load(landing))
    _run(stream, Arrivals(sink, read_folders, _writer(checkpoint), loaders, on_ready=on_ready), checkpoint)


def text_arrivals(sink: str, checkpoint: str, contracts: dict[str, Contract] = CONTRACTS,
                  loaders: dict | None = None, on_ready: Callable | None = None) -> Arrivals:
    """The batch function of ``ingest_reports``."""
    return Arrivals(sink, lambda s, folders: _with_file(s.read.option("recursiveFileLookup", "true").text(folders)),
                    _writer(checkpoint), loaders, contracts, on_ready)


def ingest_reports(spark: SparkSession, landing: str, sink: str, checkpoint: str, glob: str | None = None,
                   contracts: dict[str, Contract] = CONTRACTS, loaders: dict | None = None,
                   on_ready: Callable | None = None) -> None:
    """All reports that arrived as text since the last run.  Tabular ones (comma
    separated, a header in each file) are held against their contract and their
    columns found by name; movement reports are positional, with unit and date
    headers carried down per file (block-parallel) and layouts normalised.  Reports
    that break their contract are listed with the reasons and load nothing; files
    without a period or dataset in their name are listed under ``_rejeitados``."""
    options = {"recursiveFileLookup": "true", **({"pathGlobFilter": glob} if glob else {})}
    stream = _with_file(spark.readStream.format("text").options(**options).load(landing))
    _run(stream, text_arrivals(sink, checkpoint, contracts, loaders, on_ready), checkpoint)


def ingest_movement_reports(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                            glob: str = "movimentacoes_*") -> None:
    """``ingest_reports`` of the movement reports alone."""
    ingest_reports(spark, landing, sink, checkpoint, glob)


def ready_from_raw(spark: SparkSession, sink: str, names: tuple[str, ...] = SOURCES) -> DataFrame:
    """Completeness gate on the raw tables: periods present in all sources."""
    return ready_periods({n: read_or_empty(spark, os.path.join(sink, n), f"{PERIOD} string") for n in names}, PERIOD)
