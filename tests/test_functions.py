"""Expression builders on single rows."""

from __future__ import annotations

import math

import pytest

from ratiolens.functions.attribution import explanatory_power, surprise
from ratiolens.functions.scalar import cap, gap, log_ratio, percent_text, positive_pow, quoted, ratio
from ratiolens.operators.permeability import lmdi_split


def value(spark, sql: str):
    return spark.sql(f"SELECT {sql} AS v").first()["v"]


@pytest.mark.parametrize(
    "number, text",
    [
        ("0.12345D", "12.34%"),  # half-even at 4 decimals
        ("0.12355D", "12.36%"),
        ("-0.00001D", "-0.00%"),
        ("0D", "0.00%"),
        ("12.3D", "1230.00%"),
        ("cast(NULL AS double)", "nan%"),
    ],
)
def test_percent_text(spark, number, text):
    assert value(spark, percent_text(number)) == text


def test_null_safe_arithmetic(spark):
    null = "cast(NULL AS double)"
    assert value(spark, ratio("1D", "0D")) is None
    assert value(spark, cap(null, 1.0)) is None
    assert value(spark, cap("2D", 1.0)) == 1.0
    assert value(spark, log_ratio("-1D", "2D")) is None
    assert value(spark, log_ratio("-4D", "-2D")) == pytest.approx(math.log(2))
    assert value(spark, positive_pow("-2D", 0.25)) is None
    assert value(spark, positive_pow("16D", 0.25)) == pytest.approx(2)
    assert value(spark, quoted("a'b\nc\\d")) == "a'b\nc\\d"


def test_gap_drops_rounding_noise(spark):
    assert value(spark, gap("(0.1D + 0.2D)", "0.3D")) == 0.0
    assert value(spark, gap("0.3D", "0.2D")) == pytest.approx(0.1)


def test_surprise_limits(spark):
    assert value(spark, surprise("0D", "0D")) == 0.0
    assert value(spark, surprise("0.25D", "0.25D")) == pytest.approx(0.0)
    # a zero share leaves q ln q - q ln(q/2) = q ln 2
    assert value(spark, surprise("0D", "0.5D")) == pytest.approx(0.5 * math.log(2))


def test_explanatory_power(spark):
    assert value(spark, explanatory_power("5D", "3D", "10D", "6D")) == 0.5
    assert value(spark, explanatory_power("5D", "3D", "6D", "6D")) is None


def split(spark, factors, chains, skip_first=True):
    columns = ", ".join(f"{a!r}D AS a_{n}, {p!r}D AS p_{n}" for n, (a, p) in factors.items())
    row = lmdi_split(spark.sql(f"SELECT {columns}"), chains, skip_first).first()
    return {n: row[f"g_{n}"] for n in factors}


def test_lmdi_adds_up_to_the_change(spark):
    parts = split(spark, {"x": (3.0, 2.0), "y": (0.5, 0.8), "z": (7.0, 6.0)}, [["x", "y", "z"]])
    assert sum(parts.values()) == pytest.approx(3 * 0.5 * 7 - 2 * 0.8 * 6)


def test_lmdi_negative_factors_on_both_sides(spark):
    parts = split(spark, {"x": (-3.0, -2.0), "y": (2.0, 1.5)}, [["x", "y"]])
    assert sum(parts.values()) == pytest.approx(-6 + 3)


def test_lmdi_mixed_signs_have_no_logarithm(spark):
    assert split(spark, {"x": (-3.0, 2.0), "y": (2.0, 1.5)}, [["x", "y"]]) == {"x": None, "y": None}


def test_lmdi_zero_rules(spark):
    factors = {"x": (0.0, 2.0), "y": (3.0, 4.0)}
    assert split(spark, factors, [["x", "y"]], True) == {"x": 0.0, "y": -8.0}
    assert split(spark, factors, [["x", "y"]], False) == {"x": -8.0, "y": -8.0}


def test_lmdi_equal_products_use_the_common_value(spark):
    parts = split(spark, {"x": (4.0, 2.0), "y": (1.0, 2.0)}, [["x", "y"]])
    assert parts["x"] == pytest.approx(4 * math.log(2))
    assert parts["x"] + parts["y"] == pytest.approx(0.0)


def test_lmdi_shared_factor_sums_its_parts(spark):
    factors = {"x": (2.0, 1.0), "y": (3.0, 2.0), "z": (5.0, 4.0)}
    both = split(spark, factors, [["x", "y"], ["x", "z"]])
    one = split(spark, factors, [["x", "y"]] + [["z"]])
    two = split(spark, factors, [["x", "z"]] + [["y"]])
    assert both["x"] == pytest.approx(one["x"] + two["x"])


def test_edges_of_noise_and_rounding(spark):
    """A gap within 1e-12 of the sizes is none; values are positive from the 10th place on."""
    from ratiolens.functions.scalar import gap, positive, settled

    rows = [(0.5, 0.5), (0.5, 0.5 + 4e-13), (0.5, 0.5 + 2.1e-12), (1e9, 1e9 + 1e-4), (1e9, 1e9 + 1.0), (0.0, 1e-300)]
    frame = spark.createDataFrame(rows, "a double, p double")
    gaps = [r.g for r in frame.selectExpr(f"{gap('a', 'p')} AS g").collect()]
    assert gaps == [0.0, 0.0, 0.5 - (0.5 + 2.1e-12), 0.0, -1.0, -1e-300]
    values = [4.9e-11, 5.1e-11, -4.9e-11, 0.0, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    found = frame.selectExpr(f"{positive('v')} AS yes", f"{settled('v')} AS v").collect()
    assert [r.yes for r in found] == [False, True, False, False, None]
    assert [r.v for r in found[:4]] == [0.0, 1e-10, 0.0, 0.0]
