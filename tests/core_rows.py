"""Tables, schemas and rows the tests share."""

from datetime import date, timedelta

TESTDATA = "/root/testdata"
ANCHOR = date(2024, 6, 30)


def before(days):
    """The date ``days`` before the anchor."""
    return ANCHOR - timedelta(days=days)


def anchors_of(spark, customers, group="Churner"):
    return spark.createDataFrame(
        [(c, ANCHOR, group) for c in customers],
        "unique_customer_identifier string, ref_date date, churn_group string",
    )


CALLS = (
    "unique_customer_identifier string, event_date date, call_type string, "
    "talk_time_seconds double, hold_time_seconds double"
)
USAGE = (
    "unique_customer_identifier string, calendar_date date, "
    "usage_download_mbs double, usage_upload_mbs double"
)
CEASE = (
    "unique_customer_identifier string, cease_placed_date date, cease_completed_date string, "
    "reason_description string, reason_description_insight string"
)
INFO = (
    "unique_customer_identifier string, datevalue date, snapshot_id bigint, "
    "contract_status string, contract_dd_cancels int, dd_cancel_60_day int, ooc_days int, "
    "tenure_days int, technology string, speed double, line_speed double, "
    "sales_channel string, crm_package_name string"
)


def info_row(customer, day=ANCHOR, snapshot=1, **values):
    names = [field.split()[0] for field in INFO.split(", ")]
    base = dict.fromkeys(names) | {
        "unique_customer_identifier": customer,
        "datevalue": day,
        "snapshot_id": snapshot,
    }
    return tuple((base | values)[n] for n in names)


def by_customer(df):
    return {r["unique_customer_identifier"]: r for r in df.collect()}
