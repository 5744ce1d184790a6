from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import policy, quality
from ledgerlark.operators.merge import add_column_backfilled
from tests.conftest import bag, rows


@pytest.fixture(scope="module")
def staff(spark):
    return spark.createDataFrame(
        [
            (1, "Ann", None, "ann@x.org", "Active", date(2010, 1, 1)),
            (2, " ", 1, " Bob@x.org", "active", None),
            (3, None, 9, None, None, date(1999, 1, 1)),
            (4, "Dan", 4, "ann@x.org", "Closed", date(2000, 1, 1)),
        ],
        "staff_id int, name string, supervisor_id int, email string, status string, hired date",
    )


def test_rules_fail_only_where_false(staff):
    report = quality.rule_report(staff, "staff", {
        "name set": quality.not_null("name"),
        "name not blank": quality.not_blank("name"),
        "email normal": quality.normal_form("email"),
        "status known": quality.in_domain("status", ["Active", "Closed"]),
        "hired after 2000-01-01": F.col("hired") > F.lit(date(2000, 1, 1)),
    })
    assert rows(report) == [
        ("staff", "name set", 4, 1),
        ("staff", "name not blank", 4, 1),
        ("staff", "email normal", 4, 1),
        ("staff", "status known", 4, 1),
        ("staff", "hired after 2000-01-01", 4, 2),
    ]
    assert bag(quality.violations(staff, quality.not_blank("name")).select("staff_id")) == [(2,)]


def test_unique(staff):
    assert bag(quality.duplicate_keys(staff, ["email"])) == [("ann@x.org", 2)]
    assert bag(quality.duplicate_keys(staff, ["email", "name"])) == []


def test_self_reference_with_nullable_key(staff):
    assert bag(quality.orphans(staff, "supervisor_id", staff, "staff_id").select("staff_id")) == [(3,)]


def test_set_null_on_delete(spark, staff):
    gone = spark.createDataFrame([(1,), (1,), (7,)], "staff_id int")
    got = quality.set_null_on_delete(staff, "supervisor_id", gone, "staff_id")
    assert bag(got.select("staff_id", "supervisor_id")) == [(1, None), (2, None), (3, 9), (4, 4)]
    assert got.columns == staff.columns


def test_completeness(staff):
    got = quality.completeness({"staff": (staff, "hired"), "named": (staff, "name")})
    assert bag(got) == [("named", 4, 3), ("staff", 4, 3)]


# Rows per table after the clinic seed.
CLINIC_ROWS = {
    "appointments": 4, "bills": 4, "diagnostic_tests": 2, "doctors": 3, "manufacturers": 4,
    "medications": 4, "patients": 4, "payments": 3, "prescription_items": 3, "prescriptions": 2,
    "specializations": 5, "staff": 3, "staff_roles": 5, "treatments": 2,
}


def test_backfill_leaves_no_gap_in_any_table(spark):
    tables = {
        name: (add_column_backfilled(spark.range(count), "record_ts", F.current_date()), "record_ts")
        for name, count in CLINIC_ROWS.items()
    }
    report = rows(quality.completeness(tables).orderBy("table_name"))
    assert report == [(name, count, count) for name, count in CLINIC_ROWS.items()]
    assert sum(total for _, total, _ in report) == 48


def test_principal_sees_own_rows_only(spark, rental_db):
    payment = rental_db.payment.select("customer_id")
    who = policy.first_active_principal(rental_db.customer, rental_db.rental, payment)
    assert rows(who) == [("client_ada_z",)]
    own = policy.own_rows(rental_db.rental, rental_db.customer, who)
    assert {r.customer_id for r in own.collect()} == {1} and own.count() == 3
    # Another customer's rows are absent, without an error.
    assert own.where("customer_id = 2").count() == 0
    stranger = spark.createDataFrame([("client_no_body",)], "principal string")
    assert policy.own_rows(rental_db.rental, rental_db.customer, stranger).count() == 0
    upper = spark.createDataFrame([("CLIENT_Ben_Y",)], "principal string")
    assert {r.customer_id for r in policy.own_rows(rental_db.rental, rental_db.customer, upper).collect()} == {2}


def test_columns(rental_db):
    allowed = ["customer_id", "first_name", "last_name"]
    assert policy.visible(rental_db.customer, allowed).columns == allowed
    assert policy.visible(rental_db.customer, allowed, ["last_name"]).columns == ["last_name"]
    with pytest.raises(PermissionError):
        policy.visible(rental_db.customer, allowed, ["email"])


def test_copies_of_large_supplier_keys_stay_apart(spark):
    from ledgerlark.sources import bindings

    pairs = [(1, 100_000_005), (2, 5), (12, 3), (1, 23)]
    df = spark.createDataFrame(pairs, "l_partkey long, l_suppkey long")
    assert df.select(bindings.inventory_id()).distinct().count() == 4
