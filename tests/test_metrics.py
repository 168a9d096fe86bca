"""Transaction metrics: edge rows and exact rounding against Python decimals."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.operators.metrics import add_metrics

SCHEMA = ("invoice_line_id string, date date, store_id int, item_id int, bottle_volume_ml int, "
          "bottle_cost decimal(10,2), bottle_price decimal(10,2), sale_bottles int")


def q(x, places):
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def model(cost, price, volume, bottles):
    """Plain-decimal model of the metric chain (each step reads the rounded earlier ones)."""
    out = {}
    out["bottle_profit"] = q(price - cost, 2)
    out["revenue"] = q(price * bottles, 2)
    out["profit"] = q((price - cost) * bottles, 2)
    out["margin"] = q(out["profit"] / out["revenue"], 4) if out["revenue"] else None
    out["cost"] = q(cost * bottles, 2)
    out["sale_gallons"] = q(Decimal(volume * bottles) / Decimal("3785.411784"), 2)
    out["sale_liters"] = q(Decimal(volume * bottles) / Decimal(1000), 2)
    for unit in ("gallon", "liter"):
        qty = out[f"sale_{unit}s"]
        for name, amount in (("cost", out["cost"]), ("price", out["revenue"]), ("profit", out["profit"])):
            out[f"{unit}_{name}"] = q(amount / qty, 2) if qty else None
    return out


def run(spark, rows):
    df = spark.createDataFrame(
        [(f"i{i:05d}", None, 1, 1, v, c, p, b) for i, (c, p, v, b) in enumerate(rows)], SCHEMA)
    return [r.asDict() for r in add_metrics(df).orderBy("invoice_line_id").collect()]


def test_reference_example(spark):
    (r,) = run(spark, [(Decimal("3.50"), Decimal("5.25"), 750, 6)])
    assert r["revenue"] == Decimal("31.50")
    assert r["sale_gallons"] == Decimal("1.19")
    assert r["margin"] == Decimal("0.3333")
    assert r["sale_liters"] == Decimal("4.50")


def test_zero_volume_gives_null_ratios(spark):
    (r,) = run(spark, [(Decimal("3.50"), Decimal("5.25"), 0, 6)])
    assert r["sale_gallons"] == Decimal("0.00")
    for c in ("gallon_cost", "gallon_price", "gallon_profit", "liter_cost", "liter_price",
              "liter_profit"):
        assert r[c] is None


money = st.integers(min_value=1, max_value=2_000_000).map(lambda c: Decimal(c).scaleb(-2))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(money, money, st.integers(0, 5000), st.integers(-50, 500)),
                min_size=1, max_size=40))
def test_matches_decimal_model(spark, rows):
    got = run(spark, rows)
    for row, r in zip(rows, got):
        expected = model(*row)
        for k, v in expected.items():
            if v is not None and abs(v) >= Decimal(10) ** (8 if k != "margin" else 6):
                v = None      # beyond the declared precision: null
            assert r[k] == v, (row, k, r[k], v)


def test_half_way_cases(spark):
    # quotients that sit exactly on, and just off, a rounding boundary
    rows = [(Decimal("0.01"), Decimal("0.02"), 1893, 1),   # gallons 0.50007 -> 0.50
            (Decimal("1.00"), Decimal("1.01"), 1000, 1),
            (Decimal("0.03"), Decimal("0.11"), 2, 4),
            (Decimal("8.32"), Decimal("589.68"), 750, 1)]
    got = run(spark, rows)
    for row, r in zip(rows, got):
        for k, v in model(*row).items():
            assert r[k] == v, (row, k, r[k], v)
