from datetime import date
from decimal import Decimal

from bankspark.operators import fx
from bankspark.sources import standin
from tests.util import bag, frame

RATES = "currency string, rate_to_usd decimal(18,6), effective_month date"


def rates(spark):
    return frame(
        spark, RATES, ("eur", Decimal("1.10"), date(2024, 1, 1)), ("EUR", Decimal("1.05"), date(2024, 1, 1)),
        ("EUR", Decimal("1.20"), date(2024, 6, 1)), ("USD", Decimal("1"), date(2024, 1, 1)),
    )


def payments(spark):
    return frame(
        spark, "id int, currency string, day date, amount decimal(18,2)",
        (1, "EUR", date(2024, 1, 31), Decimal("100.00")), (2, "EUR", date(2024, 3, 1), Decimal("100.00")),
        (3, "EUR", date(2024, 6, 1), Decimal("0.05")), (4, "EUR", date(2023, 12, 31), Decimal("7.00")),
        (5, "JPY", date(2024, 6, 1), Decimal("7.00")), (6, None, None, Decimal("7.00")),
    )


def test_exact_month_defaults_to_one_and_never_fans_out(spark):
    got = bag(fx.fx_exact_month(payments(spark), rates(spark), "currency", "day"), "id", "rate_to_usd", "is_fx_defaulted")
    assert [(i, float(r), d) for i, r, d in got] == [
        (1, 1.1, False), (2, 1.0, True), (3, 1.2, False), (4, 1.0, True), (5, 1.0, True), (6, 1.0, True),
    ]


def test_as_of_takes_the_latest_rate_before(spark):
    got = bag(fx.fx_as_of(payments(spark), rates(spark), "currency", "day"), "id", "rate_to_usd")
    assert [float(r) for _, r in got] == [1.1, 1.1, 1.2, 1.0, 1.0, 1.0]


def test_amounts_round_half_up(spark):
    got = bag(fx.convert_to_usd(payments(spark), rates(spark), "amount", "currency", "day"), "id", "amount_usd")
    assert [a for _, a in got][:3] == [Decimal("110.00"), Decimal("100.00"), Decimal("0.06")]


def test_seed_has_one_rate_per_currency_and_month(spark):
    seed = standin.exchange_rates(spark)
    assert seed.count() == 56 == seed.select("currency", "effective_month").distinct().count()
