"""raw customer file -> cleaned customers.

The rows follow from a rule: row k takes the k-th value of each column's list of
allowed values, cyclically, so every value occurs within a few rows.
"""

import csv

import pytest
from pyspark.sql import types as T

from churnlab.operators.clean import clean_customer_data, domain_audit, yes_no_audit
from churnlab.sources.io import read_raw_customers
from churnlab.sources.schemas import RAW_CUSTOMER_COLUMNS, RAW_CUSTOMER_SCHEMA

# The allowed texts of the raw columns.
YES_NO = ["No", "Yes"]
SERVICE = ["Yes", "No", "No internet service"]
VALUES = {
    "gender": ["Male", "Female"],
    "Partner": YES_NO, "Dependents": YES_NO, "PhoneService": YES_NO, "PaperlessBilling": YES_NO, "Churn": YES_NO,
    "MultipleLines": ["Yes", "No", "No phone service"],
    "InternetService": ["Fiber optic", "No", "DSL"],
    **{c: SERVICE for c in RAW_CUSTOMER_COLUMNS[9:15]},
    "Contract": ["Two year", "Month-to-month", "One year"],
    "PaymentMethod": ["Mailed check", "Credit card (automatic)", "Electronic check", "Bank transfer (automatic)"],
}


def row(k: int, **changes):
    out = {c: values[k % len(values)] for c, values in VALUES.items()}
    out |= {"customerID": f"{7000 + k}-QX", "SeniorCitizen": k % 2, "tenure": 5 * k}
    out |= {"MonthlyCharges": 18.4 + k, "TotalCharges": f"{(18.4 + k) * 5 * k:.2f}" if k else ""}
    return out | changes


def raw(spark, rows, schema=RAW_CUSTOMER_SCHEMA):
    return spark.createDataFrame([[r.get(f.name) for f in schema.fields] for r in rows], schema)


def snake(text: str) -> str:
    return "_".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def test_clean_shape_and_values(spark):
    rows = [row(k) for k in range(12)]
    out = clean_customer_data(raw(spark, rows))
    got = {r["customer_id"]: r for r in out.collect()}
    assert len(out.columns) == 23 and len(got) == 12
    for r in rows:
        c = got[r["customerID"]]
        assert c["contract_type"] == snake(r["Contract"]) and c["payment_method"] == snake(r["PaymentMethod"])
        assert c["multiple_lines"] == snake(r["MultipleLines"]) and c["tech_support"] == snake(r["TechSupport"])
        assert c["internet_service"] == snake(r["InternetService"]) and c["gender"] == snake(r["gender"])
        assert c["churned"] == (r["Churn"] == "Yes") and c["has_partner"] == (r["Partner"] == "Yes")
        assert c["senior_citizen"] == bool(r["SeniorCitizen"]) and c["tenure_months"] == r["tenure"]
        # a blank total of a new customer is 0
        assert c["total_charges"] == (float(r["TotalCharges"]) if r["TotalCharges"] else 0.0)
        assert c["source_system"] == "ibm_telco_sample" and c["is_synthetic"] is False


@pytest.mark.parametrize(
    "changes, message",
    [
        ({"TotalCharges": "n/a"}, "invalid TotalCharges"),
        ({"TotalCharges": None}, "invalid TotalCharges"),
        ({"customerID": "7001-QX"}, "duplicate"),
        ({"customerID": "\n7001-QX  "}, "duplicate"),
        ({"customerID": None}, "missing"),
        ({"Dependents": "yes"}, "Dependents contains unexpected values in 1 rows"),
        ({"Churn": "Unknown"}, "Churn contains unexpected values"),
        ({"SeniorCitizen": -1}, "SeniorCitizen"),
    ],
)
def test_invalid_rows_raise(spark, changes, message):
    with pytest.raises(ValueError, match=message):
        clean_customer_data(raw(spark, [row(1), row(2), row(3, **changes)]))


def test_every_bad_value_is_listed(spark):
    rows = [row(k, Partner=f"p{k % 60}" if k % 2 else "Yes", PaperlessBilling=None if k % 3 else "Y") for k in range(240)]
    data = raw(spark, rows)
    with pytest.raises(ValueError, match="Partner contains unexpected values in 120 rows"):
        clean_customer_data(data)
    got = {(r["column_name"], r["bad_value"]): r["row_count"] for r in yes_no_audit(data).collect()}
    assert got == {("Partner", f"p{k}"): 4 for k in range(1, 60, 2)} | {("PaperlessBilling", "Y"): 80}
    assert domain_audit(data.limit(0), {"Partner": ("Yes",)}).count() == 0


def test_missing_and_extra_columns(spark):
    schema = T.StructType([f for f in RAW_CUSTOMER_SCHEMA.fields if f.name != "tenure"])
    with pytest.raises(ValueError, match=r"Missing: \['tenure'\]"):
        clean_customer_data(raw(spark, [row(1)], schema))
    extra = T.StructType(RAW_CUSTOMER_SCHEMA.fields + [T.StructField("Region", T.StringType())])
    with pytest.raises(ValueError, match=r"Unexpected: \['Region'\]"):
        clean_customer_data(raw(spark, [row(1)], extra))


def write_csv(path, rows, columns=RAW_CUSTOMER_COLUMNS):
    with open(path, "w", newline="") as file:
        writer = csv.DictWriter(file, fieldnames=columns, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)


def test_read_raw_csv_keeps_blank_total(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", [row(0, TotalCharges="   "), row(1)])
    df = read_raw_customers(spark, str(tmp_path / "raw.csv"))
    assert df.filter("customerID = '7000-QX'").first()["TotalCharges"] == "   "
    assert clean_customer_data(df).count() == 2


def test_read_raw_csv_rejects_extra_column(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", [], [*RAW_CUSTOMER_COLUMNS, "Region"])
    with pytest.raises(ValueError, match="Region"):
        read_raw_customers(spark, str(tmp_path / "raw.csv"))


def test_files_with_another_column_order_are_not_swapped(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    write_csv(tmp_path / "raw" / "a.csv", [row(1), row(2)])
    swapped = [*RAW_CUSTOMER_COLUMNS]
    i, j = swapped.index("Partner"), swapped.index("Dependents")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    write_csv(tmp_path / "raw" / "b.csv", [row(3)], swapped)
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_customers(spark, str(tmp_path / "raw")).collect()


def test_white_space_is_stripped(spark):
    out = clean_customer_data(raw(spark, [row(4, customerID=" 7004-QX\t"), row(5, TotalCharges="\t585.00\n")]))
    got = {r["customer_id"]: r["total_charges"] for r in out.collect()}
    assert set(got) == {"7004-QX", "7005-QX"} and got["7005-QX"] == 585.0
