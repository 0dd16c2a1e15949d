import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marlstone.functions import (
    MESSY_FORMATS, code_lower, code_upper, date_key, line_revenue, parse_in_order,
    parse_messy_timestamp, positive_price, safe_ratio, surrogate_key, tidy, title_case,
)

TRUTH = {
    "2024-03-05 10:11:12": datetime(2024, 3, 5, 10, 11, 12),
    "2024-03-05T10:11:12": datetime(2024, 3, 5, 10, 11, 12),
    "03/05/2024": datetime(2024, 3, 5),
    "03/05/2024 10:11:12": datetime(2024, 3, 5, 10, 11, 12),
    "03-05-2024": datetime(2024, 3, 5),
    "25-12-2024": datetime(2024, 12, 25),
    "3/5/2024": datetime(2024, 3, 5),
    "2024/03/05": datetime(2024, 3, 5),
    "25-12-2024 10:11": datetime(2024, 12, 25, 10, 11),
    "12-25-2024 10:11": None,
    "03-05-2024 10:11": datetime(2024, 5, 3, 10, 11),
    "03-05-2024 10:11:12": datetime(2024, 3, 5, 10, 11, 12),
    "2024-03-05": datetime(2024, 3, 5),
    "25/12/2024": None,
    "2024-3-5": None,
    "2024-03-05 10:11:12.5": None,
    "02/30/2024": None,
    "": None,
    "soon": None,
    None: None,
}


def test_date_layouts_truth_table(spark):
    df = spark.createDataFrame([(k,) for k in TRUTH], "text string")
    rows = df.select("text", parse_messy_timestamp("text").alias("ts")).collect()
    assert {r.text: r.ts for r in rows} == TRUTH


def test_fast_parser_equals_ordered_attempts(spark):
    """Rendered dates, damaged dates and random text from the date alphabet."""
    rng = random.Random(7)
    texts = ["003/5/2024", "2024-03-05t10:11:12", "+12024-03-05", "-2024-03-05", "3/5/+12024",
             "03-05-+12024 10:11:12", "2024-03-05\n", " 2024-03-05", "00-13-2024", "13-13-2024",
             "2024-02-29 24:00:00", "2024-02-29 23:59:60", "0000-01-01", "3/5/20245", "31-04-2024",
             "29-02-2023", "02-29-2023", "12/3/2024", "1/13/2024", "13/1/2024", "00/00/0000"]
    pieces = {"yyyy": "{y:04d}", "MM": "{m:02d}", "dd": "{d:02d}", "HH": "{H:02d}", "mm": "{M:02d}",
              "ss": "{s:02d}", "M": "{m}", "d": "{d}"}
    for _ in range(3000):
        layout = rng.choice(MESSY_FORMATS).replace("'", "")
        marked = layout
        for token in ("yyyy", "MM", "dd", "HH", "mm", "ss", "M", "d"):
            marked = marked.replace(token, f"<{list(pieces).index(token)}>", 1)
        for i, token in enumerate(pieces):
            marked = marked.replace(f"<{i}>", pieces[token])
        text = marked.format(y=rng.randint(1, 9999), m=rng.randint(0, 14), d=rng.randint(0, 33),
                             H=rng.randint(0, 25), M=rng.randint(0, 61), s=rng.randint(0, 61))
        if rng.random() < 0.3:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "0", "9", "-", "/", " ", ":", "T", "+"]) + text[at + rng.randint(0, 1):]
        texts.append(text)
    for _ in range(500):
        texts.append("".join(rng.choice("0123-/ :T+") for _ in range(rng.randint(0, 20))))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    different = df.where(~parse_messy_timestamp("text").eqNullSafe(parse_in_order("text")))
    assert different.collect() == []
    assert df.where(parse_in_order("text").isNotNull()).count() > 1000


def test_text_forms(spark):
    df = spark.createDataFrame([("  são PAULO-x ", " tx ", " Canceled ")], "city string, state string, status string")
    row = df.select(title_case("city"), code_upper("state"), code_lower("status"), tidy("state")).first()
    assert tuple(row) == ("São Paulo-x", "TX", "canceled", "tx")


@pytest.mark.parametrize("price, guarded, revenue", [
    (2.5, 2.5, 7.5), (0.0, None, None), (-1.0, None, None), (None, None, None), (0.335, 0.335, 1.01),
])
def test_price_guard(spark, price, guarded, revenue):
    df = spark.createDataFrame([(3, price)], "quantity int, price double")
    row = df.select(positive_price("price"), line_revenue("quantity", "price")).first()
    assert tuple(row) == (guarded, revenue)


def test_keys_and_ratio(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 9, 23)), (None, None)], "k string, t timestamp")
    rows = df.select(date_key("t"), surrogate_key("k"), safe_ratio(F.lit(1.0), F.lit(0.0))).collect()
    assert rows[0][0] == 20240109 and rows[1][0] is None
    assert rows[1][1] == 42 and rows[0][1] not in (42, -1)
    assert rows[0][2] is None
