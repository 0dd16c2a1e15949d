import pytest
from pyspark.sql import functions as F

from marlstone.functions.masks import ANALYSTS, BI_READER, ENGINEERS
from marlstone.operators import governance

EVERYONE = {"engineer": [ENGINEERS], "analyst": [ANALYSTS], "bi": [BI_READER], "nobody": [],
            "bi_and_analyst": [BI_READER, ANALYSTS]}


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [("c1", "ann@x.example", "TX"), ("c2", "b", "CA"), ("c3", None, None)],
        "customer_id string, email string, state string")


def emails(df):
    return [r.email for r in df.orderBy("customer_id").collect()]


@pytest.mark.parametrize("role, expected", [
    ("engineer", ["ann@x.example", "b", None]),
    ("analyst", ["an***@***.***", "b***@***.***", None]),
    ("bi", ["an***@***.***", "b***@***.***", None]),
])
def test_email_mask(people, role, expected):
    assert emails(governance.secure_read(people, "dim_customer_keyed", EVERYONE[role])) == expected


@pytest.mark.parametrize("role, expected", [
    ("engineer", {"c1", "c2", "c3"}), ("analyst", {"c1", "c2", "c3"}), ("bi", {"c1"}),
    ("bi_and_analyst", {"c1", "c2", "c3"}),
])
def test_row_filter(people, role, expected):
    seen = governance.secure_read(people, "mv_sales_by_state", EVERYONE[role])
    assert {r.customer_id for r in seen.collect()} == expected


@pytest.mark.parametrize("role, expected", [
    ("engineer", ["ann@x.example", "b", None]), ("analyst", ["***REDACTED-PII***"] * 3),
])
def test_tag_policy_comes_before_the_column_mask(people, role, expected):
    tagged = governance.tag_column(people, "email", "sensitivity", "pii")
    assert emails(governance.secure_read(tagged, "dim_customer", EVERYONE[role])) == expected
    # Without the tag the column mask applies.
    untagged = governance.secure_read(people, "dim_customer", EVERYONE[role])
    assert emails(untagged)[0] == ("ann@x.example" if role == "engineer" else "an***@***.***")


def test_tags_are_listed_and_stored(spark, people, tmp_path):
    tagged = governance.tag_column(people, "email", "sensitivity", "pii")
    tagged.write.parquet(str(tmp_path / "t"))
    rows = governance.list_column_tags(spark.read.parquet(str(tmp_path / "t")), "dim_customer").collect()
    assert [tuple(r) for r in rows] == [("dim_customer", "email", "sensitivity", "pii")]


@pytest.mark.parametrize("role, layers", [
    ("engineer", {"bronze", "silver", "gold"}), ("analyst", {"gold"}), ("bi", {"gold"}), ("nobody", set()),
])
def test_layers(people, role, layers):
    for layer in ("bronze", "silver", "gold"):
        if layer in layers:
            governance.secure_read(people, "t", EVERYONE[role], layer)
        else:
            with pytest.raises(PermissionError):
                governance.secure_read(people, "t", EVERYONE[role], layer)
    rows = governance.visible_layers(people, "t", EVERYONE[role]).collect()
    assert {r.layer for r in rows if r.readable} == layers
    assert all(r.row_count == (3 if r.readable else 0) for r in rows)


def test_a_mask_for_engineers_costs_nothing(people):
    plan = governance.secure_read(people, "dim_customer_keyed", [ENGINEERS])._jdf.queryExecution().optimizedPlan()
    assert "concat" not in plan.toString()
    assert people.where(F.lit(True)).count() == 3
