import datetime as dt

from tidemark.schemas import RAW_SCHEMAS


def T(s):
    return dt.datetime.fromisoformat(s)


def D(s):
    return dt.date.fromisoformat(s)


def raw(spark, table, rows):
    return spark.createDataFrame(rows, RAW_SCHEMAS[table])


AUTO = object()


def customer(cid, segment="smb", region="US", cost=100.0, name="A B", email=AUTO, age=30):
    return (cid, name, f"customer_{cid}@example.com" if email is AUTO else email, age, segment, region,
            cost, D("2024-01-01"))


def event(eid, cid, etype, ts, channel="email", campaign=None, clicked=None):
    if clicked is None:
        clicked = etype in ("click", "purchase")
    return (eid, cid, etype, T(ts), channel, 10, 2, clicked, campaign)


def order(oid, cid, ts, amount, status="completed", cat="home"):
    return (oid, cid, T(ts), amount, cat, status)


def churn(cid, churned, p=0.5, days=3):
    return (cid, churned, p, D("2024-01-01"), days)
