"""A positional report read in many splits: headers carry across split
boundaries (no task holds the whole file)."""
import os


from wardflow.plans import domain
from wardflow.sources import reports


def test_headers_carry_across_file_splits(spark, tmp_dir):
    lines, expected = [], {}
    n = 0
    for unit in range(3):
        lines.append(",".join(["Unidade de Internação: X", "", "", "", "", "", f"UNIT{unit}"] + [""] * 13))
        for d in range(4):
            lines.append(",".join(["Data:", "", f"2025-03-{10 + d:02d}"] + [""] * 17))
            for _ in range(40):
                n += 1
                cells = [""] * 20
                cells[1], cells[3], cells[10], cells[15] = str(n), "NOME", "10:00:00", f"L{n}"
                lines.append(",".join(cells))
                expected[str(n)] = (f"UNIT{unit}", f"2025-03-{10 + d:02d}")
    path = os.path.join(tmp_dir, "movimentacoes_2025_03.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        cells = reports.read_cells(spark, path)
        assert cells.select("blk").distinct().count() > 5          # the file is read in many splits
        got = {r.ATEND: (r.UNIDADE, r.DATA) for r in domain.movements_from_cells(cells).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == expected
