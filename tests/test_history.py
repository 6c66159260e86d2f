"""Rankings that depend on what came before a view, against plain loops."""

import datetime as dt
import random

import pytest

from basketry.operators import history
from basketry.operators import recommend as rec

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def tables(spark, seed, users=4, products=24, clicks=120, sales=90):
    rng = random.Random(seed)
    inv = [(p, rng.choice("abc"), rng.choice([0, 1, 5]), rng.choice([1, 2, 2, 3])) for p in range(products)]
    seen = [(rng.randrange(users), rng.randrange(products + 2), at(rng.randrange(80))) for _ in range(clicks)]
    bought = [(rng.randrange(users), rng.randrange(products), at(rng.randrange(80))) for _ in range(sales)]
    frames = (
        spark.createDataFrame(seen, "user_id long, product_id long, event_time timestamp").repartition(3),
        spark.createDataFrame(bought, "user_id long, product_id long, purchase_time timestamp").repartition(3),
        spark.createDataFrame(inv, "product_id long, category string, stock int, rating int"),
    )
    return inv, seen, bought, frames


def views_of(inv, seen):
    category = {p: c for p, c, _, _ in inv}
    out = {}
    for u, p, t in seen:
        if p in category:
            out.setdefault((u, t), set()).add(category[p])
    return out


def ranked(inv, categories, owned):
    rows = [(p not in owned, -r, p, c) for p, c, s, r in inv if s > 0 and c in categories]
    return [(p, not new) for new, _, p, _ in sorted(rows)]


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.user_id, r.event_time), []).append((r.rn, r.product_id, r.purchased is not None))
    return {v: [x[1:] for x in sorted(rows)] for v, rows in out.items()}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("k", [1, 3, 6])
def test_bought_before(spark, seed, k):
    inv, seen, bought, frames = tables(spark, seed)
    got = found(history.ranked_bought_before(rec.Recommender(*frames, k=k)))
    want = {}
    for (u, t), categories in views_of(inv, seen).items():
        owned = {p for u2, p, t2 in bought if u2 == u and t2 <= t}
        want[u, t] = ranked(inv, categories, owned)[:k]
    assert got == {v: rows for v, rows in want.items() if rows}


def test_only_lasting_purchases_are_kept(spark):
    """A hot pair: of 2000 products bought, few are ever among the best; parts find the same."""
    rng = random.Random(2)
    inv = [(p, "a", 1, rng.randrange(1000)) for p in range(2000)]
    stocked = spark.createDataFrame(inv, "product_id long, category string, stock int, rating int")
    sales = [(7, p, at(rng.randrange(5000))) for p, _, _, _ in inv]
    df = spark.createDataFrame(sales, "user_id long, product_id long, purchase_time timestamp")
    (row,) = history.bought_over_time(df, stocked, 3, "numeric").collect()
    rating = {p: r for p, _, _, r in inv}
    want = set()
    for t in sorted({t for _, _, t in sales}):
        want |= set(sorted((p for _, p, t2 in sales if t2 <= t), key=lambda p: (-rating[p], p))[:3])
    assert {x.product_id for x in row["items"]} == want and len(want) < 60


def loop_unseen(inv, seen, bought, k):
    shown, out = {}, {}
    for (u, t), categories in sorted(views_of(inv, seen).items()):
        owned = {p for u2, p, _ in bought if u2 == u}
        picks = [x for x in ranked(inv, categories, owned) if x[0] not in shown.setdefault(u, set())][:k]
        shown[u] |= {p for p, _ in picks}
        if picks:
            out[u, t] = picks
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("k, chunk", [(1, 500), (2, 4), (6, 1)])
def test_each_product_once(spark, seed, k, chunk, monkeypatch):
    """Histories in one piece and in chunks, the shown numbers carried between them."""
    monkeypatch.setattr(history, "CHUNK_VIEWS", chunk)
    inv, seen, bought, frames = tables(spark, seed, users=3, products=30, clicks=60)
    got = found(history.ranked_unseen(rec.Recommender(*frames, k=k)))
    assert got == loop_unseen(inv, seen, bought, k)
    products = [(v[0], p) for v, rows in got.items() for p, _ in rows]
    assert len(products) == len(set(products))


def test_a_long_history_is_cut_to_what_can_show(spark):
    inv = [(p, "ab"[p % 2], 1, p) for p in range(20)]
    seen = [(7, p % 20, at(i)) for i, p in enumerate(range(3000))]
    frames = (spark.createDataFrame(seen, "user_id long, product_id long, event_time timestamp"),
              spark.createDataFrame([], "user_id long, product_id long, purchase_time timestamp"),
              spark.createDataFrame(inv, "product_id long, category string, stock int, rating int"))
    recommender = rec.Recommender(*frames, k=3)
    sizes = rec.stocked(frames[2]).groupBy("category").count().withColumnRenamed("count", "n")
    assert history._productive_views(recommender, sizes).count() == 8
    assert found(history.ranked_unseen(recommender)) == loop_unseen(inv, seen, [], 3)


def test_a_pair_reads_no_more_of_a_category_than_it_can_show(spark, monkeypatch):
    """A category of 3000 products, 7 of its best bought: the views' lists are right
    and no prefix that a user and category reads is longer than twice its need."""
    inv = [(p, "ab"[p % 2], 1, p) for p in range(6000)] + [(None, "a", 1, 9999), (5999, "b", 2, 1)]
    seen = [(1, 0, at(0)), (1, 1, at(1)), (2, 1, at(2)), (3, 0, at(3))] + [(3, 1, at(i)) for i in range(4, 20)]
    bought = [(u, p, at(0)) for u in (1, 2) for p in range(5987, 6000, 2)]
    frames = (spark.createDataFrame(seen, "user_id long, product_id long, event_time timestamp"),
              spark.createDataFrame(bought, "user_id long, product_id long, purchase_time timestamp"),
              spark.createDataFrame(inv, "product_id long, category string, stock int, rating int"))
    read = []
    prefixes = history._category_prefixes
    monkeypatch.setattr(history, "_category_prefixes", lambda r, needs: read.append(prefixes(r, needs)) or read[0])
    got = found(history.ranked_unseen(rec.Recommender(*frames, k=3)))
    want = loop_unseen([x for x in inv if x[0] is not None], seen, bought, 3)
    assert got == want
    sizes = {(r["category"], r["scale"]): len(r["all"]) for r in read[0].collect()}
    # 3 for a view, 3 + 8 with the listed purchases, 48 for 16 views
    assert sizes == {("a", 2): 4, ("b", 4): 16, ("b", 6): 64}


@pytest.mark.parametrize("seed", range(2))
def test_viewed_products_are_left_out(spark, seed):
    inv, seen, bought, frames = tables(spark, seed, clicks=300)
    got = found(history.ranked_excluding_viewed(rec.Recommender(*frames, k=3)))
    want = {}
    for (u, t), categories in views_of(inv, seen).items():
        owned = {p for u2, p, _ in bought if u2 == u}
        clicked = {p for u2, p, t2 in seen if (u2, t2) == (u, t)}
        want[u, t] = [x for x in ranked(inv, categories, owned) if x[0] not in clicked][:3]
    assert got == {v: rows for v, rows in want.items() if rows}


def test_nothing_to_rank(spark):
    *_, frames = tables(spark, 0)
    empty = [df.limit(0) for df in frames]
    for clicks, sales, inv in ((empty[0], *frames[1:]), (*frames[:2], empty[2])):
        assert history.ranked_unseen(rec.Recommender(clicks, sales, inv)).count() == 0
        assert history.ranked_bought_before(rec.Recommender(clicks, sales, inv)).count() == 0
        assert history.ranked_excluding_viewed(rec.Recommender(clicks, sales, inv)).count() == 0
