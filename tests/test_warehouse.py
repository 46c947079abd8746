"""Building, publishing and attaching."""

import mini
import pytest
from growthlake.operators import quality
from growthlake.plans import warehouse as plans
from growthlake.plans.reports import kpis
from growthlake.plans.warehouse import Warehouse


def files(root):
    return {p: p.stat().st_mtime_ns for p in root.rglob("*") if p.is_file()}


def build(spark, root):
    tables = mini.bronze(spark)
    return Warehouse(spark, tables.__getitem__, mini.AS_OF, str(root)).build()


def test_a_second_job_reads_and_leaves_all_files(spark, tmp_path):
    expected = kpis(build(spark, tmp_path)).collect()
    before = files(tmp_path)
    assert kpis(Warehouse.open(spark, str(tmp_path))).collect() == expected
    assert files(tmp_path) == before


def test_a_failed_build_leaves_the_last_one(spark, tmp_path, monkeypatch):
    expected = kpis(build(spark, tmp_path)).collect()

    def fails(w):
        raise RuntimeError("half way")

    monkeypatch.setitem(plans.TABLES, "fct_churn", fails)
    with pytest.raises(RuntimeError, match="half way"):
        build(spark, tmp_path)
    assert kpis(Warehouse.open(spark, str(tmp_path))).collect() == expected


def test_nothing_to_open(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Warehouse.open(spark, str(tmp_path))


def test_row_checks_are_measured_while_writing(spark, tmp_path):
    """The same results as from the tables, but row checks of stored models read none of them."""
    written = build(spark, tmp_path)
    composed = Warehouse(spark, mini.bronze(spark).__getitem__, mini.AS_OF)
    again = Warehouse.open(spark, str(tmp_path))
    for results in (quality.summary, lambda w: quality.all_generic_results(w, list(plans.MODELS))):
        expected = sorted(map(repr, results(composed).collect()))
        assert sorted(map(repr, results(written).collect())) == expected
        assert sorted(map(repr, results(again).collect())) == expected
    plan = quality.summary(again)._jdf.queryExecution().executedPlan().toString()
    assert "fct_account_mrr" not in plan and "stg_crm_companies" not in plan
    schemas = [part.split("\n")[0] for part in quality.generic_results(
        again["dim_accounts"], "dim_accounts", again.measured["dim_accounts"])._jdf.queryExecution()
        .executedPlan().toString().split("ReadSchema: ")[1:]]
    assert schemas and all("company_id" not in s for s in schemas)


def test_a_build_that_breaks_a_rule_is_not_published(spark, tmp_path, monkeypatch):
    build(spark, tmp_path)
    expected = kpis(Warehouse.open(spark, str(tmp_path))).collect()
    real = plans.MODELS["fct_account_mrr"]
    monkeypatch.setitem(plans.TABLES, "fct_account_mrr", lambda w: real(w).selectExpr(
        "account_id", "mrr_month", "-mrr - 1 AS mrr", "expansion_mrr"))
    tables = mini.bronze(spark)
    with pytest.raises(plans.CheckFailed, match="dq_mrr_non_negative"):
        Warehouse(spark, tables.__getitem__, mini.AS_OF, str(tmp_path)).build(refuse=["dq_mrr_non_negative"])
    assert kpis(Warehouse.open(spark, str(tmp_path))).collect() == expected
    with pytest.raises(ValueError, match="dq_unheard_of"):
        Warehouse(spark, tables.__getitem__, mini.AS_OF, str(tmp_path)).build(refuse=["dq_unheard_of"])
