"""Hand-made nested events (FIXTURES §1): one case per rule branch."""

from __future__ import annotations

from datetime import datetime, timezone

from clickmart.schemas import NESTED_EVENT


def us(ts: str) -> int:
    d = datetime.strptime(ts, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
    return int(d.timestamp()) * 1_000_000


def item(name, category="Home/Apparel/", price=10.0, quantity=1, promo=None, item_id=None):
    return (item_id or (name and name[:3]), name, category, price, quantity, promo)


_next_id = [0]


def ev(ts, name, user="u1", gsid=1, *, user_id=None, items=(), params=None, txn=None, revenue=None,
       device="desktop", country="KR", event_id=None, extra_params=()):
    """One nested event row (tuple in NESTED_EVENT order)."""
    _next_id[0] += 1
    ps = []
    if gsid is not None:
        ps.append(("ga_session_id", (None, gsid)))
    for k, v in (params or {}).items():
        ps.append((k, (v, None) if isinstance(v, str) else (None, v)))
    ps.extend(extra_params)
    ecommerce = (txn, revenue) if (txn is not None or revenue is not None) else None
    return (ts[:10].replace("-", ""), us(ts), name, user, user_id, ps, ecommerce,
            None if items is None else list(items), (device,), (country,),
            event_id if event_id is not None else _next_id[0])


def frame(spark, rows):
    return spark.createDataFrame(rows, NESTED_EVENT)
