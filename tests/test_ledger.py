"""Runs that become visible at once: failures, reruns, competing runs, clearing up."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from platewise.plans import daily
from platewise.session import work_path
from platewise.sources.fixtures import EXCLUDE, PREV_CUTOFF, PREV_RUN_DATE, RUN_DATE, Fixtures
from platewise.sources.ledger import Ledger
from platewise.sources.sinks import ConcurrentWriteError

from conftest import SF_SMALL

D1, D2, D3 = (dt.date(2001, 8, d) for d in (1, 2, 3))
TABLES = ("area_category", "customer_category", "menu_category", "shop_category", "shop_category_change", "customer_category_list",
          "customer_category_kv")


def _rows(df):
    return sorted(map(str, df.collect()))


def _publish(spark, book, day, n, name="t"):
    run = book.begin(spark, day)
    run.write(name, spark.range(n).withColumn("day", F.lit(day)))
    return run.publish()


def test_a_run_that_fails_between_two_tables_is_not_seen(spark, monkeypatch):
    f, book = Fixtures(spark, SF_SMALL), Ledger(work_path(spark, "ledger"))
    o = f.order_transaction()

    def inputs(orders):
        return daily.Inputs(orders, f.order_item(), f.shop(), f.address(), None, None, None, f.category_id_mapper())

    daily.publish_day(spark, inputs(o.where(F.col("order_date") < F.lit(PREV_CUTOFF))), book, PREV_RUN_DATE, f.dish_tagging(), EXCLUDE)
    before = {t: _rows(book.read(spark, t)) for t in TABLES}
    assert all(before.values())

    with monkeypatch.context() as m:  # the area, customer, menu and shop tables are stored by then
        m.setattr(daily.gold, "shop_category_change", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            daily.publish_day(spark, inputs(o), book, RUN_DATE, f.dish_tagging(), EXCLUDE)
    assert {t: _rows(book.read(spark, t)) for t in TABLES} == before
    assert book.read_days(spark, "area_category").select("busi_dt").distinct().count() == 1

    assert daily.publish_day(spark, inputs(o), book, RUN_DATE, f.dish_tagging(), EXCLUDE) == 2
    after = {t: _rows(book.read(spark, t)) for t in TABLES}
    assert all(after[t] != before[t] for t in TABLES)
    assert {t: _rows(book.read(spark, t, number=1)) for t in TABLES} == before  # a reader of the first state keeps it

    # a rerun builds on the day before, so it gives the same tables and takes the first run's place
    assert daily.publish_day(spark, inputs(o), book, RUN_DATE, f.dish_tagging(), EXCLUDE) == 3
    assert {t: _rows(book.read(spark, t)) for t in TABLES} == after
    assert {r.busi_dt for r in book.read_days(spark, "area_category").select("busi_dt").distinct().collect()} == {PREV_RUN_DATE, RUN_DATE}


def test_days_and_reruns(spark):
    book = Ledger(work_path(spark, "ledger"))
    assert book.read(spark, "t") is None and book.read_days(spark, "t") is None
    assert [_publish(spark, book, d, n) for d, n in ((D1, 3), (D3, 5), (D2, 4))] == [1, 2, 3]
    assert book.read(spark, "t").count() == 5  # the newest day, not the newest run
    assert book.read(spark, "t", before=D3).count() == 4 and book.read(spark, "t", before=D1) is None
    assert book.read_days(spark, "t").count() == 12 and book.read_days(spark, "t", D2).count() == 9 and book.read_days(spark, "t", last=D1).count() == 3
    _publish(spark, book, D2, 7)
    assert book.read_days(spark, "t", D2, D2).count() == 7
    assert book.read(spark, "other") is None
    _publish(spark, book, dt.date(2001, 8, 4), 1, "other")  # a day without the table: the last day that has it
    assert book.read(spark, "t").count() == 5


def test_days_with_further_columns(spark):
    book = Ledger(work_path(spark, "ledger"))
    _publish(spark, book, D1, 2)
    run = book.begin(spark, D2)
    run.write("t", spark.range(1).withColumn("day", F.lit(D2)).withColumn("more", F.lit("x")))
    run.publish()
    assert sorted(map(str, [(r.id, r.more) for r in book.read_days(spark, "t").collect()])) == ["(0, 'x')", "(0, None)", "(1, None)"]


def test_of_two_runs_from_one_state_one_is_published(spark):
    book = Ledger(work_path(spark, "ledger"))
    _publish(spark, book, D1, 2)
    late = book.begin(spark, D2)
    late.write("t", spark.range(9))
    for n in (3, 4, 5):
        _publish(spark, book, D2, n)
    book.drop_superseded(spark, keep=1)  # the number that the late run would take is free again
    with pytest.raises(ConcurrentWriteError):
        late.publish()
    assert book.read(spark, "t").count() == 5
    with pytest.raises(ValueError):
        late.write("t", spark.range(1))


def test_clearing_up_keeps_what_is_named_and_what_is_under_way(spark):
    book = Ledger(work_path(spark, "ledger"))
    for n in (1, 2, 3, 4):
        _publish(spark, book, D1, n)
    under_way = book.begin(spark, D2)
    under_way.write("t", spark.range(6))
    assert book.drop_superseded(spark, keep=2) == 2
    local = book.root.removeprefix("file:")
    assert len(os.listdir(f"{local}/runs")) == 3
    assert book.read(spark, "t").count() == 4 and book.read(spark, "t", number=3).count() == 3
    under_way.publish()
    assert book.read(spark, "t").count() == 6 and book.read_days(spark, "t").count() == 10
