from decimal import Decimal as D

from pyspark.sql import functions as F

from cartlane.operators import audit
from cartlane.schemas import TABLES
from tests.conftest import rows


def violations(report):
    return {(r["rule"], r["columns"]): r["violations"] for r in report.collect()}


def test_users(spark):
    data = [
        (1, "ann", "a@x", "1"),
        (2, "ann", "b@x", None),
        (2, "n" * 101, None, None),
        (3, "n" * 100, "a@x", "2"),
    ]
    users = spark.createDataFrame(data, "id long, username string, email string, mobile string")
    got = violations(audit.audit_table(TABLES["users"], {"users": users}))
    assert got[("not_null", "email")] == 1 and got[("not_null", "mobile")] == 2 and got[("not_null", "id")] == 0
    assert got[("length", "username")] == 1
    assert got[("unique", "id")] == 1 and got[("unique", "username")] == 1
    assert got[("unique", "email")] == 1 and got[("unique", "mobile")] == 0
    assert ("not_null", "created_at") not in got


def test_composite_key_and_references(spark):
    links = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 2), (5, None, 2), (6, 9, 9)], "id long, role_id long, user_id long")
    frames = {"role_user": links, "roles": spark.range(1, 4), "users": spark.range(1, 2)}
    got = violations(audit.audit_table(TABLES["role_user"], frames))
    assert got[("unique", "role_id,user_id")] == 2
    assert got[("reference", "role_id")] == 1 and got[("reference", "user_id")] == 3
    assert rows(audit.orphans(links, "user_id", frames["users"])) == [(2, 2), (9, 1)]
    assert rows(audit.duplicate_keys(links, ["role_id", "user_id"])) == [(1, 1, 3)]


def test_domain_and_decimals(spark):
    data = [(1, "percent", "1.005"), (2, "other", "9999999999999.99"), (3, None, "9999999999999.995"), (4, "amount", None)]
    df = spark.createDataFrame(data, "id long, type string, value string").withColumn("value", F.col("value").cast("decimal(20,3)"))
    got = violations(audit.audit_table(TABLES["discounts"], {"discounts": df}))
    assert got[("domain", "type")] == 1
    assert got[("decimal", "value")] == 1


def test_totals(spark):
    schema = ", ".join(["id long", *[f"{c} decimal(15,2)" for c in ("order_amount", "tax_amount", "discount_amount", "total_amount")]])
    data = [(1, D("10"), D("1"), D("2"), D("9")), (2, D("10"), D("1"), D("2"), D("9.01")), (3, D("10"), D("1"), D("2"), D("9.02"))]
    df = spark.createDataFrame(data, schema)
    assert rows(audit.wrong_totals(df), "id") == [(3,)]
    assert violations(audit.audit_table(TABLES["orders"], {"orders": df}))[("totals", "total_amount")] == 1


def test_empty_table_has_no_violations(spark):
    empty = spark.createDataFrame([], TABLES["orders"].schema())
    report = audit.audit_table(TABLES["orders"], {"orders": empty, "users": spark.range(3)})
    assert set(violations(report).values()) == {0}


def test_row_rules_take_one_pass(spark):
    df = spark.createDataFrame([], TABLES["orders"].schema())
    rules = audit.row_rules(TABLES["orders"], df.columns)
    plan = audit.count_row_violations(df, "orders", rules)._jdf.queryExecution().executedPlan().toString()
    assert len(rules) > 10 and plan.count("Exchange") == 1


def test_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id long, quantity int")
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    got = audit.fill_defaults(df, TABLES["orderdetails"], now)
    assert rows(got, "id", "quantity", "unit_cost") == [(1, 1, D("0.00")), (2, 5, D("0.00"))]
    made = audit.fill_defaults(spark.range(1), TABLES["transactions"], now).first()
    assert made["status"] is False
    made = audit.fill_defaults(spark.range(1), TABLES["discounts"], now).first()
    assert made["type"] == "percent" and str(made["created_at"]) == "2024-01-01 00:00:00"


def test_stored_rounds_half_away_from_zero(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(10,3)) AS amount, timestamp_ntz'2024-01-01 00:00:00.7' AS created_at FROM VALUES (2.345), (-2.345) AS t(v)")
    got = audit.stored(df, TABLES["transactions"])
    assert rows(got.select("amount")) == [(D("-2.35"),), (D("2.35"),)]
    assert str(got.first()["created_at"]) == "2024-01-01 00:00:01"
