"""All-or-nothing loads, batch replacement, replay of rejects, dense keys."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.quality import LoadCheckError
from starload.plans import load as L
from starload.plans.load import open_rejects, run_load
from starload.plans.spec import KEEP, REJECT, Lookup, TableSpec
from starload.sources.published import ConcurrentLoadError, Warehouse
from starload.sources.warehouse import read_back, try_read_back

DIM = TableSpec("d_shop", "shops", [("shop_id", "id"), ("city", "city")], business_key=["shop_id"], sk="sk_shop")
CHILD = TableSpec("d_till", "tills", [("till_id", "id"), ("shop_id", "shop")], business_key=["till_id"], sk="sk_till",
                  lookups=[Lookup(["shop_id"], "d_shop", ["shop_id"], "sk_shop", on_missing=REJECT)])
FACT = TableSpec("f_sale", "sales", [("shop_id", "shop"), ("amount", "amount")], kind="fact",
                 lookups=[Lookup(["shop_id"], "d_shop", ["shop_id"], "sk_shop", on_missing=REJECT)],
                 checks={"positive": "amount > 0"}, on_check=REJECT)


def sources(spark, shops=(), sales=(), tills=()):
    return {"shops": spark.createDataFrame(list(shops), "id int, city string"),
            "sales": spark.createDataFrame(list(sales), "shop int, amount int"),
            "tills": spark.createDataFrame(list(tills), "id int, shop int")}


def load(spark, root, batch, specs=(DIM, FACT), **rows):
    return {r.table_name: r.rows for r in run_load(spark, list(specs), sources(spark, **rows), root, batch_id=batch,
                                                   audit_col=None).collect()}


def state(spark, root, *tables):
    out = {}
    for t in tables or ("d_shop", "f_sale", "f_sale_rejected"):
        df = try_read_back(spark, f"{root}/{t}")
        out[t] = None if df is None else sorted(map(str, df.collect()))
    return out


def sales(spark, root):
    return sorted((r.load_batch, r.sk_shop, r.amount) for r in read_back(spark, f"{root}/f_sale").collect())


def rejects(spark, root, table="f_sale_rejected"):
    return sorted((r.load_batch, r.source_row.shop_id, tuple(r.reject_reasons))
                  for r in read_back(spark, f"{root}/{table}").collect())


def test_a_load_killed_at_any_step_shows_nothing_and_is_made_good(spark, tmp_target, monkeypatch):
    first = dict(shops=[(1, "A"), (2, "B")], sales=[(1, 10), (2, 20), (9, 90)], tills=[(1, 1), (2, 8)])
    second = dict(shops=[(3, "C"), (9, "I")], sales=[(3, 30), (1, -1)], tills=[(3, 3)])
    specs = (DIM, CHILD, FACT)
    tables = ("d_shop", "d_till", "d_till_rejected", "f_sale", "f_sale_rejected", "f_sale_resolved")
    load(spark, tmp_target, "b1", specs, **first)
    before = state(spark, tmp_target)

    class Killed(Exception):
        pass

    steps = 0
    for at in range(20):
        calls = 0

        def dying(real):
            def step(*args, **kwargs):
                nonlocal calls
                calls += 1
                if calls > at:
                    raise Killed
                return real(*args, **kwargs)
            return step

        with monkeypatch.context() as m:
            m.setattr(Warehouse, "stage", dying(Warehouse.stage))         # after each folder is written
            m.setattr(Warehouse, "publish", dying(Warehouse.publish))     # and before the record is
            try:
                load(spark, tmp_target, "b2", specs, **second)
                break
            except Killed:
                steps += 1
        assert state(spark, tmp_target) == before
    assert steps >= 6 and Warehouse(spark, tmp_target).seq == 2
    clean = f"{tmp_target}-clean"
    load(spark, clean, "b1", specs, **first)
    load(spark, clean, "b2", specs, **second)
    assert state(spark, tmp_target, *tables) == state(spark, clean, *tables)
    after = state(spark, tmp_target, *tables)
    wh = Warehouse(spark, tmp_target)
    assert wh.vacuum() and wh.orphans() == []                              # what the killed loads left
    assert state(spark, tmp_target, *tables) == after


def test_failed_checks_publish_nothing(spark, tmp_target):
    strict = TableSpec(**{**FACT.__dict__, "on_check": "fail"})
    with pytest.raises(LoadCheckError, match="check_positive': 1"):
        load(spark, tmp_target, "b1", (DIM, strict), shops=[(1, "A")], sales=[(1, 5), (1, -5)])
    assert state(spark, tmp_target) == {"d_shop": None, "f_sale": None, "f_sale_rejected": None}


def test_a_repaired_batch_replaces_its_rows_and_rejects_even_by_nothing(spark, tmp_target):
    load(spark, tmp_target, "b1", shops=[(1, "A")], sales=[(1, 10), (7, 70), (1, -3)])
    load(spark, tmp_target, "b2", shops=[], sales=[(1, 11)])
    assert rejects(spark, tmp_target) == [("b1", 1, ("check_positive",)), ("b1", 7, ("unresolved_sk_shop",))]
    load(spark, tmp_target, "b1", shops=[], sales=[(1, 10), (1, 70), (1, 3)])
    assert sales(spark, tmp_target) == [("b1", 1, 3), ("b1", 1, 10), ("b1", 1, 70), ("b2", 1, 11)]
    assert rejects(spark, tmp_target) == []
    assert load(spark, tmp_target, "b1", shops=[], sales=[]) == {"d_shop": 1, "f_sale": 1}
    assert load(spark, tmp_target, "b2", shops=[], sales=[]) == {"d_shop": 1, "f_sale": 0}
    assert read_back(spark, f"{tmp_target}/f_sale").columns == ["amount", "sk_shop", "load_batch"]


def test_rejects_are_loaded_when_their_parent_arrives(spark, tmp_target):
    """Three batches: orphans wait, one parent comes, then the other."""
    b1 = dict(shops=[(1, "A")], sales=[(1, 10), (2, 20), (2, 20), (3, 30), (2, -2), (None, 5)])
    b2 = dict(shops=[(2, "B")], sales=[(2, 21), (3, 31)])
    b3 = dict(shops=[(3, "C")], sales=[])
    assert load(spark, tmp_target, "b1", **b1) == {"d_shop": 1, "f_sale": 1}
    assert load(spark, tmp_target, "b2", **b2) == {"d_shop": 2, "f_sale": 4}
    assert sales(spark, tmp_target) == [("b1", 1, 10), ("b1", 2, 20), ("b1", 2, 20), ("b2", 2, 21)]
    assert load(spark, tmp_target, "b3", **b3) == {"d_shop": 3, "f_sale": 6}
    want = [("b1", 1, 10), ("b1", 2, 20), ("b1", 2, 20), ("b1", 3, 30), ("b2", 2, 21), ("b2", 3, 31)]
    assert sales(spark, tmp_target) == want
    waiting = open_rejects(Warehouse(spark, tmp_target), FACT).collect()
    assert [r.source_row.amount for r in waiting] == [5]                  # a null key never resolves
    # In whatever order batches are loaded again, nothing is lost or doubled.
    for batch, rows in (("b2", b2), ("b1", b1), ("b3", b3), ("b1", b1), ("b2", b2)):
        load(spark, tmp_target, batch, **rows)
        assert sales(spark, tmp_target) == want


def test_dimension_rows_wait_for_their_parent_too(spark, tmp_target):
    specs = (DIM, CHILD)
    load(spark, tmp_target, "b1", specs, shops=[(1, "A")], tills=[(10, 5), (11, 1), (12, 6), (13, 1)])
    keys = {r.till_id: r.sk_till for r in read_back(spark, f"{tmp_target}/d_till").collect()}
    assert keys == {11: 1, 13: 2}                                          # dense: numbered after the rejects
    load(spark, tmp_target, "b2", specs, shops=[(5, "E")], tills=[(14, 6)])
    keys = {r.till_id: r.sk_till for r in read_back(spark, f"{tmp_target}/d_till").collect()}
    assert keys == {11: 1, 13: 2, 10: 3}
    waiting = open_rejects(Warehouse(spark, tmp_target), CHILD).collect()
    assert sorted((r.till_id, r.load_batch) for r in waiting) == [(12, "b1"), (14, "b2")]
    load(spark, tmp_target, "b3", specs, shops=[(6, "F")], tills=[])
    keys = {r.till_id: r.sk_till for r in read_back(spark, f"{tmp_target}/d_till").collect()}
    assert keys == {11: 1, 13: 2, 10: 3, 12: 4, 14: 5}


def test_a_fact_is_written_once_and_never_checkpointed(spark, tmp_target, monkeypatch):
    load(spark, tmp_target, "b0", (DIM,), shops=[(1, "A")])
    written = []
    real = L.Warehouse.new_folder
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("checkpointed"))
    monkeypatch.setattr(L.Warehouse, "new_folder", lambda self, t: written.append(t) or real(self, t))
    kept = TableSpec(**{**FACT.__dict__, "lookups": [Lookup(["shop_id"], "d_shop", ["shop_id"], "sk_shop",
                                                            on_missing=KEEP)], "on_check": "fail"})
    for fact in (FACT, kept):
        load(spark, tmp_target, "b1", (fact,), sales=[(1, 1), (4, 2)])
    assert written == ["f_sale", "f_sale"]
    assert sales(spark, tmp_target) == [("b1", -1, 2), ("b1", 1, 1)]


def test_batch_names_may_hold_any_character(spark, tmp_target):
    odd = "2024-01-01 10:00/é=%[x]"
    load(spark, tmp_target, odd, shops=[(1, "A")], sales=[(1, 1), (2, 2)])
    load(spark, tmp_target, "next", shops=[(2, "B")], sales=[])
    assert sales(spark, tmp_target) == [(odd, 1, 1), (odd, 2, 2)]


def test_a_second_load_from_the_same_record_is_refused(spark, tmp_target):
    load(spark, tmp_target, "b1", shops=[(1, "A")], sales=[(1, 1)])
    late = Warehouse(spark, tmp_target)
    load(spark, tmp_target, "b2", shops=[], sales=[(1, 2)])
    with pytest.raises(ConcurrentLoadError):
        late.publish()
    assert len(sales(spark, tmp_target)) == 2
