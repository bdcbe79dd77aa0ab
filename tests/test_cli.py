import datetime as dt
import json
import os

from erp_fixtures import write_tree


def test_run_all_and_cli(spark, scratch, capsys):
    from starloom.__main__ import main
    from starloom.plans.medallion import run_all
    base = os.path.join(scratch, "erp_cli")
    write_tree(base)
    out = run_all(spark, base, os.path.join(scratch, "raw_cli"), catalog="spark_catalog",
                  calendar_start=dt.date(2023, 1, 1), calendar_end=dt.date(2024, 12, 31))
    days = [r["DateId"] for r in spark.table("spark_catalog.silver.dimdate").select("DateId").collect()]
    assert (min(days), max(days)) == (20230101, 20241231)
    assert "lines without a record id in factsalesorderline_quarantine" in out["silver"]["factsalesorderline"]
    assert not [x for x in out["silver"].values() if x.startswith(("failed", "skipped"))]
    assert len(out["ingest"]) == 15 and all(r["passed"] for r in out["bronze"])
    assert "factsalesorderline" in out["silver"] and len(out["gold"]) == 2
    main([base, os.path.join(scratch, "raw_cli2")])
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert printed["gold"] == {"sales_by_fiscal_period": "overwritten", "purchases_by_vendor_country": "overwritten"}
