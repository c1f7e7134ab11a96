"""Matrix exports: any number of cells, any cell id, the axes by label."""

from celltally.operators import counts as cnt
from celltally.sinks import files as sinks

SCHEMA = "sample string, cell string, gene string, " + ", ".join(f"{m} long" for f in ("reads", "umis") for m in cnt.MEASURES[f])


def long_table(spark, rows):
    """rows: (sample, cell, gene, unspliced, spliced)"""
    return spark.createDataFrame([(s, c, g, u, x, u + x, u, x, u + x) for s, c, g, u, x in rows], SCHEMA)


def test_dotted_ids_and_axes(spark):
    t = long_table(spark, [("S", "a.b", "g1", 2, 0), ("S", "c`d", "g2", 0, 3)])
    total = cnt.pivot_matrix(t, "umis_total")
    assert total.columns == ["sample", "gene", "a.b", "c`d"]
    assert sorted(tuple(r) for r in total.collect()) == [("S", "g1", 2, 0), ("S", "g2", 0, 3)]
    assert [tuple(r) for r in cnt.pivot_matrix(t, "reads_spliced").collect()] == [("S", "g2", 3)]
    lines = {(r.measure, r.gene): r.line for r in cnt.matrix_lines(t, ["reads_spliced", "umis_spliced"]).collect()}
    assert lines == {("reads_spliced", None): "gene\tc`d", ("reads_spliced", "g2"): "g2\t3", ("umis_spliced", None): "gene\ta.b\tc`d",
                     ("umis_spliced", "g1"): "g1\t0\t0", ("umis_spliced", "g2"): "g2\t0\t3"}


def test_many_cells(spark, tmp_path):
    n = 12_000
    t = long_table(spark, [("S", f"c{i:05d}", f"g{i % 3}", i % 2, 1) for i in range(n)])
    sinks.write_matrices(cnt.matrix_lines(t, ["umis_total"]), str(tmp_path / "m"))
    got = [r.value.split("\t") for r in spark.read.text(str(tmp_path / "m" / "sample=S" / "measure=umis_total")).collect()]
    assert [x[0] for x in got] == ["gene", "g0", "g1", "g2"] and all(len(x) == n + 1 for x in got)
    for g, row in enumerate(got[1:]):
        assert row[1:] == [str(i % 2 + 1) if i % 3 == g else "0" for i in range(n)]


def test_gene_counts_are_sorted_in_files(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(F.lit("S").alias("sample"), F.when(F.col("id") % 2 == 0, "exon").otherwise("intron").alias("label"),
                                      F.concat(F.lit("g"), "id").alias("gene"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("n"))
    sinks.write_gene_counts(rows, str(tmp_path / "g"))
    for label in ("exon", "intron"):
        folder = tmp_path / "g" / f"label={label}"
        n = [int(line.split("\t")[2]) for f in sorted(folder.glob("part-*")) for line in f.read_text().splitlines()]
        assert len(n) == 10_000 and n == sorted(n, reverse=True)


def test_gene_counts_are_made_once(spark, tmp_path):
    from pyspark.sql import functions as F

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(2_000).select(F.lit("S").alias("sample"), F.when(F.col("id") % 2 == 0, "exon").otherwise("intron").alias("label"), F.concat(F.lit("g"), "id").alias("gene"), F.col("id").alias("n"))
    sinks.write_gene_counts(rows.mapInArrow(count, rows.schema), str(tmp_path / "g"))
    assert made.value == 2_000 == spark.read.text(str(tmp_path / "g")).count()


def test_entries_are_exchanged_once_for_all_measures(spark):
    t = long_table(spark, [("S", f"c{i % 7}", f"g{i}", i % 2, i % 3) for i in range(100)])
    names = [m for f in ("reads", "umis") for m in cnt.MEASURES[f]]
    lines = cnt.matrix_lines(t, names)
    plan = lines.where("gene IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("gene" in line for line in exchanges) == 1 and not any("cell" in line for line in exchanges)
    assert lines.where("measure = 'reads_unspliced' AND gene = 'g2'").count() == 0  # it has no such read
    one = lines.where("measure = 'umis_total' AND gene = 'g5'").first().line
    assert one == "g5\t0\t0\t0\t0\t0\t3\t0"
