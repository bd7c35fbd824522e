"""Positional report rows: pick the layout by where the time cell is, and
map cells to named columns.  Rows that match no layout are dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.columns import is_numeric, is_time

OUTPUT_COLS = ("ATEND", "NM_PACIENTE", "HORA", "TIPO", "ORIGEM", "DESTINO",
               "TIP_ACOM", "CID", "CONVENIO", "MOTIVO_ALTA")

# fixed values: cell positions of each movement-report layout, tried in this
# order; the first cell named is the one that must hold HH:MM:SS
MOVEMENT_LAYOUTS = (
    ("HORA", {"ATEND": 1, "NM_PACIENTE": 3, "HORA": 10, "TIPO": 11, "ORIGEM": 13, "DESTINO": 15,
              "TIP_ACOM": 16, "CID": 17, "CONVENIO": 18, "MOTIVO_ALTA": 19}),
    ("HORA", {"ATEND": 1, "NM_PACIENTE": 3, "HORA": 7, "TIPO": 8, "ORIGEM": 10, "DESTINO": 12,
              "TIP_ACOM": 13, "CID": 14, "CONVENIO": 15, "MOTIVO_ALTA": 16}),
    ("HORA", {"ATEND": 1, "NM_PACIENTE": 3, "HORA": 8, "TIPO": 9, "ORIGEM": 11, "DESTINO": 13,
              "TIP_ACOM": 14, "CID": 15, "CONVENIO": 16, "MOTIVO_ALTA": 17}),
)


def cell(df_cells: str, i: int):
    return F.get(F.col(df_cells), i)


def normalise_layouts(df: DataFrame, cells: str = "cells",
                      layouts: Sequence[tuple[str, Mapping[str, int]]] = MOVEMENT_LAYOUTS,
                      keep: Sequence[str] = (), numeric_cell: int | None = 1) -> DataFrame:
    """``cells`` is an array<string> column.  Keep rows whose ``numeric_cell``
    is numeric, choose the first layout whose time cell holds a time, and
    emit its named columns (plus ``keep``)."""
    names = list(layouts[0][1])
    branches = [F.when(is_time(cell(cells, mapping[probe])),
                       F.struct(*[cell(cells, mapping[n]).alias(n) for n in names]))
                for probe, mapping in layouts]
    chosen = F.coalesce(*branches) if len(branches) > 1 else branches[0]
    out = df
    if numeric_cell is not None:
        out = out.where(is_numeric(cell(cells, numeric_cell)))
    out = out.select(*keep, chosen.alias("__row")).where(F.col("__row").isNotNull())
    return out.select(*keep, *[F.col("__row").getField(n).alias(n) for n in names])
