import pytest
from pyspark.sql import functions as F

from wardgrid.functions.cells import add_cells, edge_length, hex_center, with_hex_axial


def points(spark, n=20000):
    at = F.col("id").cast("double")
    return spark.range(n).select(
        "id",
        (F.lit(-74.3) + F.pmod(at * 7919, F.lit(9973.0)) / 9973.0 * 0.7).alias("lon"),
        (F.lit(40.4) + F.pmod(at * 5381, F.lit(9967.0)) / 9967.0 * 0.6).alias("lat"),
    )


@pytest.mark.parametrize("resolution", [8, 9, 10])
def test_the_cell_has_the_nearest_centre(spark, resolution):
    df = with_hex_axial(points(spark), "lon", "lat", resolution, "c")

    def distance(dq, dr):
        x, y = hex_center(F.col("c.q") + dq, F.col("c.r") + dr, resolution)
        return F.pow(F.col("lon") - x, F.lit(2)) + F.pow(F.col("lat") - y, F.lit(2))

    around = [distance(q, r) for q in (-1, 0, 1) for r in (-1, 0, 1) if (q, r) != (0, 0)]
    assert df.where(distance(0, 0) > F.least(*around) + F.lit(1e-15)).count() == 0


def test_edges_shrink_by_root_seven():
    assert edge_length(8) / edge_length(10) == pytest.approx(7.0)


def test_cells_are_null_without_a_valid_point(spark):
    rows = [(None, 40.0), (-74.0, None), (-200.0, 40.0), (-74.0, 95.0), (float("nan"), 1.0), (-74.0, 40.7)]
    out = add_cells(spark.createDataFrame(rows, "lon double, lat double"), "lon", "lat").collect()
    assert all(r[f"hex_r{n}"] is None for r in out[:5] for n in (8, 9, 10))
    assert all(out[5][f"hex_r{n}"].startswith(f"{n}:") for n in (8, 9, 10))
