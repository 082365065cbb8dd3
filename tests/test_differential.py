"""Differential test on messy hand-made data: every registered operator on a
random nested fixture (NULL sessions, timestamp ties, repeated items, NULL
categories / prices / quantities, shared and NULL transactions, absent
parameters) against its DuckDB oracle run on the same staged rows."""

import random

import duckdb
import pytest

from clickmart.operators import sessions as S
from clickmart.operators.staging import stage_events
from clickmart.plans import materialize
from clickmart.plans import oracle as O
from clickmart.plans import registry
from fixtures import ev, frame, item
from tools.check_oracle import rows_of

RAW = {"stage_events", "market_basket_orders", "events_export_roundtrip"}  # read the driver tables directly
NAMES = ["session_start", "view_item", "view_item", "view_item", "add_to_cart", "add_to_cart", "begin_checkout",
         "add_payment_info", "purchase", "view_search_results", "page_view", "view_promotion", "select_promotion"]
CATALOG = [("Google Bag", "Home/Bags/"), ("Tee", "Home/Apparel/Men's/"), ("Cap", "Home/Shop by Brand/YouTube/"),
           ("Mug", None), ("Rain Shell", "Home/Apparel/"), ("Pen", "Home/Lifestyle/"), ("Sock", "Home/Apparel/"),
           ("Google Backpack", "Home/Bags/More Bags/")]


def make_events(seed: int, n: int = 420):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = f"u{rnd.randrange(12)}"
        gsid = None if rnd.random() < 0.08 else rnd.randrange(1, 6)
        name = rnd.choice(NAMES)
        minute = rnd.randrange(0, 300)
        ts = f"2024-01-0{1 + minute // 150} {(minute % 150) // 60 + 22 if minute % 150 < 120 else 1:02d}:{minute % 60:02d}:00"
        items = ()
        txn = rev = None
        if name in ("view_item", "add_to_cart", "begin_checkout", "purchase"):
            k = rnd.choice([0, 1, 1, 2, 3, 4])
            picks = [rnd.choice(CATALOG) for _ in range(k)]
            items = [item(nm, cat, rnd.choice([None, 5.0, 12.0, 30.0, 30.0, 80.0]), rnd.choice([None, 1, 1, 2, 3]))
                     for nm, cat in picks]
            if rnd.random() < 0.1:
                items = None
        if name in ("view_promotion", "select_promotion"):
            promo = "P-big" if rnd.random() < 0.6 else rnd.choice(["P-a", "P-b"])
            items = [item(None, None, None, None, promo=promo)]
        if name == "purchase":
            txn = None if rnd.random() < 0.1 else f"T{rnd.randrange(25)}"
            rev = float(rnd.randrange(10, 200))
        params = {}
        if rnd.random() < 0.7:
            params["source"] = rnd.choice(["google", "partner"])
            params["medium"] = rnd.choice(["cpc", "organic"])
        rows.append(ev(ts, name, user, gsid, user_id=(f"M{user}" if rnd.random() < 0.3 else None), items=items,
                       params=params, txn=txn, revenue=rev, device=rnd.choice(["desktop", "mobile", "tablet"]),
                       event_id=i))
    # many impressions of one promotion so the >50 threshold is crossed
    for j in range(60):
        rows.append(ev("2024-01-02 03:00:00", "view_promotion", f"u{j % 12}", 1,
                       items=[item(None, None, None, None, promo="P-big")], event_id=n + j))
    return rows


@pytest.mark.parametrize("seed", [11])
def test_all_operators_match_sql_on_messy_fixture(spark, monkeypatch, seed):
    staged = stage_events(frame(spark, make_events(seed))).cache()
    monkeypatch.setattr(registry, "stg", lambda spark_, sf: staged)
    monkeypatch.setattr(registry, "feats", lambda spark_, sf: S.session_features(staged))
    # fixture models are built in place, not cached as tables under a source signature
    monkeypatch.setattr(materialize, "table", lambda spark_, name, sig, build, **layout: build())
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    pdf = staged.toPandas()
    con.register("stg_fixture", pdf)
    stg_cte = O.STG_CTE.strip()
    checked = 0
    for name, sql in registry.ORACLE.items():
        if name in RAW:
            continue
        assert stg_cte in sql, name
        q = sql.replace(stg_cte, "stg AS (SELECT * FROM stg_fixture)")
        res = con.sql(q)
        want = rows_of(res.columns, res.fetchall())
        df = registry.QUERIES[name](spark, "<fixture>")
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        assert sorted(df.columns) == sorted(res.columns), name
        assert got == want, name
        checked += 1
    assert checked >= 50
    # the fixture reaches the branches the driver data does not
    assert pdf["session_unique_id"].isna().any()
    assert registry.QUERIES["promo_performance"](spark, "<fixture>").count() >= 1
