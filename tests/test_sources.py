from tessera.plans import REGISTRY
from tessera.sources import readers as R
from tessera.sources.schemas import PROTEIN_ATOMS


def test_fixed_width_atoms_wider_than_the_layout(spark, tmp_path):
    """Atom numbers, labels and coordinates that outgrow their columns are read back whole."""
    rows = [(1, 3, [0.5, 0.25, -0.125]), (99_999, 9_999, [1.5, 0.0, 0.0]), (100_000, 10_000, [2.25, 0.0, 0.0]),
            (12_345_678_901, 3, [-123_456.5, 0.0, 0.0])]
    spark.createDataFrame(rows, "vec_id long, embedding_label int, e array<float>").selectExpr(
        "vec_id", "e AS embedding", "embedding_label AS label").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r.label: (r.n, r.x_sum) for r in REGISTRY["s09_fixed_width_atoms"].build(spark, str(tmp_path)).collect()}
    assert got == {3: (2, -12_345_600.0), 9_999: (1, 150.0), 10_000: (1, 225.0)}


def test_fixed_width_layout_moves_only_where_it_must(spark, tmp_path):
    from pyspark.sql import functions as F
    texts = {n: F.lit(v) for n, v in zip([f[0] for f in PROTEIN_ATOMS], ["ATOM", "7", "CA", "ALA", "A", "12", "1.000",
                                                                           "2.000", "3.000"])}
    one = spark.range(1)
    kept = R.write_fixed_width(one, str(tmp_path / "a"), PROTEIN_ATOMS, texts, left=("record", "atom_name"))
    line = "ATOM  %5d %-4s %3s %1s%4d    %8.3f%8.3f%8.3f" % (7, "CA", "ALA", "A", 12, 1, 2, 3)
    assert kept == PROTEIN_ATOMS and spark.read.text(str(tmp_path / "a")).first()[0] == line
    moved = R.write_fixed_width(one, str(tmp_path / "b"), PROTEIN_ATOMS, texts | {"atom_number": F.lit("1234567")})
    assert moved[1][1:3] == (7, 13) and [f[1] - g[1] for f, g in zip(moved, PROTEIN_ATOMS)][2:] == [2] * 7
    back = R.read_fixed_width(spark, str(tmp_path / "b"), moved).first()
    assert back.atom_number == 1234567 and back.residue_number == 12 and back.z_coord == 3.0
