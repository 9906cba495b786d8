from __future__ import annotations

from datetime import UTC, date, datetime
from types import SimpleNamespace

import pytest

from orderloom import session
from orderloom.operators import audit, marts
from orderloom.plans.warehouse import Warehouse


def stub(master, shared=None):
    context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: shared))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"])
def test_scratch_of_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session._scratch_root(stub(master))
    assert session._scratch_root(stub(master, "s3a://bucket/shared/")) == "s3a://bucket/shared/orderloom-app"


def test_one_process():
    assert session.is_one_process("local") and session.is_one_process("local[8]")


def test_recency_counts_to_today_by_default(spark):
    customers = spark.createDataFrame([(1, "C1", "s")], "customer_id long, customer_nk string, segment string")
    days = spark.createDataFrame([(1, date(2020, 1, 1))], "date_id long, date_day date")
    orders = spark.createDataFrame([(1, 1, 1)], "order_id long, customer_id long, date_id long")
    items = spark.createDataFrame([], "order_id long, net_amount decimal(14,2)")
    before = datetime.now(UTC).date()
    (row,) = marts.rfm_segments(customers, orders, days, items).collect()
    after = datetime.now(UTC).date()
    assert (before - date(2020, 1, 1)).days <= row.recency_days <= (after - date(2020, 1, 1)).days


def test_error_text_is_cut_in_the_log(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.log_run(1, "2026-01-01", audit.RUNNING)
    warehouse.log_run(1, "2026-01-01", audit.FAILED, 0, "x" * 5000)
    (row,) = warehouse.run_log().collect()
    assert row.error_message == "x" * 1000
