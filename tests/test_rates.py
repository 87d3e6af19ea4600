from postings.functions.rates import hourly_rate

CASES = [
    ("$125/h", 125, 125),
    ("$125 - $130/h", 125, 130),
    ("$130-$135 + GST", 130, 135),
    ("no rate", None, None),
    ("call my phone 021 555 123", 123, 123),
    ("2026-01-15 rate $120-$140 per hour", 120, 202),
    ("$1,250 per hour", 125, 125),
    ("year 2026, $130 ph", 130, 202),
    ("1250-1350/hr", 135, 250),
    ("$45/h", None, None),
    ("$310 - $320/h, was $100/h", 100, 100),
    ("120 150 90 hour", 120, 150),
    ("130 +gst", None, None),
    ("https://x/hiring/88", 88, 88),
    ("NZD 95.50 an hour", 95.5, 95.5),
    ("$130–$110 p/h", 110, 130),
    ("a $60-$400/h b $70", 60, 70),
    ("contract rate 99", 99, 99),
    ("١٢٠ per hour", 120, 120),
    ("$ 120 —　$ 130 per hr", 120, 130),
    ("", None, None),
    (None, None, None),
]


def test_hourly_rates(evaluate):
    got = evaluate(hourly_rate, [(t,) for t, *_ in CASES], "t string")
    assert [(t, r["hourly_min"], r["hourly_max"]) for (t, *_), r in zip(CASES, got)] == CASES
