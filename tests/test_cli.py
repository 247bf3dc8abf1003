"""The command line: seed, load, rollup, validate, scenarios, re-seed."""

import os

from barwise import cli
from barwise import fixtures as fx
from barwise.session import scratch_path
from barwise.sinks import layout

SF = "/root/testdata/sf0.001"


def test_cli_workflow(spark):
    root = scratch_path(spark, "cli")
    nations = fx.instruments_a(spark, SF).collect()
    os.makedirs(root + "/csv")
    csv = root + "/csv/constituents.csv"
    with open(csv, "w") as f:
        f.write("Symbol,Security,GICS Sector,GICS Sub-Industry\n")
        for n in nations:
            f.write(f"{n.symbol},{n.name},{n.sector},{n.sector} sub\n")
    lake = root + "/lake"
    assert cli.main(["seed", "--constituents", csv, "--lake", lake], spark)["ticker"] == 25
    layout.write_yearly(fx.vendor_rows_a(spark, SF), root + "/data")
    rep = cli.main(["load", "--input", root + "/data", "--glob", "*.parquet", "--lake", lake],
                   spark)
    assert rep["loaded"] == rep["attempted"] > 0 and rep["unknown_symbols"] == 0
    assert cli.main(["rollup", "--lake", lake], spark)["rows"] > 0
    assert cli.main(["rollup", "--lake", lake, "--months", "2024-01"], spark)["rows"] > 0
    v = cli.main(["validate", "--lake", lake], spark)
    assert v["duplicated_keys"] == "0" and v["unknown_refs"] == "0"
    sym = "NATION_13"
    for args in (["chart", "--symbol", sym, "--start", "2024-01-01", "--end", "2024-02-01"],
                 ["daily", "--symbol", sym, "--start", "2024-01-01", "--end", "2024-02-01"],
                 ["daily_raw", "--symbol", sym, "--start", "2024-01-01", "--end", "2024-02-01"],
                 ["cross_section", "--at", "2024-01-16 19:55:00"],
                 ["movers", "--start", "2024-01-15 00:00:00", "--end", "2024-01-17 00:00:00"],
                 ["volatility", "--symbol", sym, "--start", "2024-01-01", "--end", "2024-02-01"],
                 ["market", "--start", "2024-01-02 14:30:00", "--end", "2024-01-06 00:00:00"]):
        cli.main(["scenario", *args, "--lake", lake, "--show", "3"], spark)
    # Re-seeding keeps ids and replaces names.
    with open(csv, "a") as f:
        f.write("NEWCO,New Co,AFRICA,AFRICA sub\n")
    out = cli.main(["seed", "--constituents", csv, "--lake", lake], spark)
    assert out["ticker"] == 26
    ids = {r.symbol: r.ticker_id for r in spark.read.parquet(lake + "/ticker").collect()}
    assert ids["NEWCO"] == 26


def test_cli_second_loader_calendar_pages_and_load_modes(spark):
    import pytest
    root = scratch_path(spark, "cli2")
    lake, data = root + "/lake", root + "/data"
    os.makedirs(root + "/pages")
    with open(root + "/constituents.csv", "w") as f:
        f.write("Symbol,Security,GICS Sector,GICS Sub-Industry\n")
        for n in fx.instruments_a(spark, SF).collect():
            f.write(f"{n.symbol},{n.name},{n.sector},{n.sector} sub\n")
    for i, p in enumerate(fx.pages_c(spark, SF).collect()):
        with open(f"{root}/pages/{i}.json", "w") as f:
            f.write(p.page)
    bars = fx.vendor_rows_a(spark, SF)
    assert cli.main(["pages", "--input", root + "/pages", "--out", data], spark)["rows"] == bars.count()
    cli.main(["seed", "--constituents", root + "/constituents.csv", "--lake", lake], spark)
    bars_in = ["load", "--input", data, "--glob", "*.parquet", "--lake", lake]
    first = cli.main(bars_in, spark)
    again = cli.main(bars_in, spark)  # truncates
    assert first["loaded"] == again["loaded"] == bars.count()
    with pytest.raises(ValueError):
        cli.main([*bars_in, "--append"], spark)
    assert cli.main([*bars_in, "--months"], spark)["loaded"] == bars.count()
    assert layout.read_partitioned(spark, lake + "/bar_5m").count() == bars.count()
    days = cli.main(["calendar", "--lake", lake], spark)["rows"]
    assert days == cli.main(["calendar", "--lake", lake], spark)["rows"] > 0
    second = ["market-data", "--input", data, "--glob", "*.parquet", "--constituents", root + "/constituents.csv", "--lake", lake]
    assert cli.main(second, spark)["inserted"] == bars.count()
    assert cli.main(second, spark)["inserted"] == 0


def test_module_entry_point_help():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "barwise", "--help"], cwd=root,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "seed" in out.stdout and "scenario" in out.stdout
