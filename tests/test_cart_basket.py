from pyspark.sql import functions as F

from clickmart.operators import basket, cart, sessions
from clickmart.operators.staging import stage_events
from fixtures import ev, frame, item


def staged(spark, rows):
    return stage_events(frame(spark, rows))


def test_cart_lines_deduplicated_before_sum(spark):
    # the same cart line twice in a session counts once (Q4); a different line value counts again
    rows = [ev("2024-01-05 10:00:00", "add_to_cart", gsid=1, items=[item("Bag", "Home/Bags/", 10.0, 2)]),
            ev("2024-01-05 10:01:00", "add_to_cart", gsid=1, items=[item("Bag", "Home/Bags/", 10.0, 2)]),
            ev("2024-01-05 10:02:00", "add_to_cart", gsid=1, items=[item("Bag", "Home/Bags/", 10.0, 3)]),
            ev("2024-01-05 10:00:00", "add_to_cart", gsid=2, items=[item("Bag", "Home/Bags/", 10.0, 1)]),
            ev("2024-01-05 10:00:00", "purchase", gsid=3, txn="T", items=[item("Bag")])]
    stg = staged(spark, rows)
    ab = stg.select("session_unique_id").distinct().filter(F.col("session_unique_id") != "u1-3")
    got = cart.cart_abandon(stg, ab).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.abandoned_session_count, r.total_lost_revenue, r.avg_lost_value) == (2, 20.0 + 30.0 + 10.0, 20.0)


def test_main_category_rule(spark):
    cats = ["Home/Bags/", "Home/Apparel/Men's/", "Home/Shop by Brand/YouTube/", "Home/Lifestyle/", None,
            "Home/Apparel/Bags", "home/bags/"]
    df = spark.createDataFrame([(c,) for c in cats], "c string")
    got = [r[0] for r in df.select(cart.main_category(F.col("c"))).collect()]
    assert got == ["Bags", "Apparel", "Accessories", "Other", "Other", "Bags", "Other"]


def test_exclude_items_case_insensitive_nulls_kept(spark):
    df = spark.createDataFrame([("Google Rain Shell",), ("rain shell x",), (None,), ("Cap",)], "item_name string")
    assert sorted([r[0] or "" for r in cart.exclude_items(df).collect()]) == ["", "Cap"]


def test_pairs_repeat_per_line_and_weights(spark):
    # A on two lines of T1 -> pair (A, B) appears twice (Q10); distinct transactions count once
    rows = [ev("2024-01-05 10:00:00", "purchase", gsid=1, txn="T1", items=[item("A"), item("A"), item("B")]),
            ev("2024-01-05 11:00:00", "purchase", gsid=2, txn="T2", items=[item("A"), item("B"), item("C")]),
            ev("2024-01-05 12:00:00", "purchase", gsid=3, txn="T3", items=[item("A"), item("B")]),
            ev("2024-01-05 12:00:00", "purchase", gsid=4, txn=None, items=[item("A"), item("B")])]
    stg = staged(spark, rows)
    pairs = basket.product_association(stg)
    got = sorted((r.transaction_id, r.product_A, r.product_B, r.line_pairs) for r in pairs.collect())
    assert got == [("T1", "A", "B", 2), ("T2", "A", "B", 1), ("T2", "A", "C", 1), ("T2", "B", "C", 1),
                   ("T3", "A", "B", 1)]
    feats = sessions.session_features(stg)
    b = basket.bundle_strategy(stg, feats).collect()
    assert [(r.product_A, r.product_B, r.pair_sales_count) for r in b] == [("A", "B", 3)]
    assert basket.bundle_strategy(stg, feats, min_sales=4).count() == 0


def test_bundle_mid_quirk(spark):
    tiers = spark.createDataFrame([("A", 10.0, "Mid"), ("B", 50.0, "High")],
                                  "item_name string, avg_price double, price_tier string")
    rows = [ev("2024-01-05 10:00:00", "purchase", gsid=g, txn=f"T{g}", items=[item("A"), item("B")]) for g in range(3)]
    stg = staged(spark, rows)
    feats = sessions.session_features(stg)
    ref = basket.bundle_strategy(stg, feats, tiers=tiers).collect()[0]
    fixed = basket.bundle_strategy(stg, feats, tiers=tiers, mid_name="Mid").collect()[0]
    assert ref.bundle_strategy_type == basket.GENERAL and fixed.bundle_strategy_type == basket.ADD_ON


def test_price_tier_orders_agree(spark):
    rows = [ev("2024-01-05 10:00:00", "view_item", gsid=1,
               items=[item(f"I{i}", price=float(p)) for i, p in enumerate([1, 2, 3, 5, 8, 13, 21, 34, 55])])]
    stg = staged(spark, rows)
    a = sorted(tuple(r) for r in basket.price_tier(stg).collect())
    b = sorted(tuple(r) for r in basket.price_tier(stg, alt_order=True).collect())
    assert a == b
    tiers = {r.item_name: r.price_tier for r in basket.price_tier(stg).collect()}
    assert tiers["I0"] == "Low" and tiers["I8"] == "High"


def test_cart_top_level_category_option(spark):
    rows = [ev("2024-01-05 10:00:00", "add_to_cart", gsid=1, items=[item("Bag", "Home/Bags/", 10.0, 1)])]
    stg = staged(spark, rows)
    ab = stg.select("session_unique_id").distinct()
    assert cart.cart_abandon(stg, ab, top_level_category=True).collect()[0].item_category == "Home"
    assert cart.cart_abandon(stg, ab).collect()[0].item_category == "Home/Bags/"
