"""Write PLANS.md: the physical plans of the benchmark scenarios.

    python tools/explain_plans.py [sf_dir]

Tables are loaded as in bench.py (month-partitioned, clustered); each
scenario's plan is printed with ``explain("formatted")`` after one run, so
adaptive decisions (broadcasts, coalesced partitions) are final.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barwise import fixtures as fx  # noqa: E402
from barwise.plans import chart as ch  # noqa: E402
from barwise.plans import cross_section as cs  # noqa: E402
from barwise.plans import market as mk  # noqa: E402
from barwise.plans import movers as mv  # noqa: E402
from barwise.plans import rollup as ru  # noqa: E402
from barwise.operators.windows import rolling_vol  # noqa: E402
from barwise.plans.volatility import volatility_scan  # noqa: E402
from barwise.session import local_session, scratch_path  # noqa: E402
from barwise.sinks import layout as lay  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    p5m, pship, p1d, phot = (scratch_path(spark, n)
                             for n in ("bar_5m", "bar_ship", "bar_1d", "bar_hot"))
    for bars, path, lo, hi in [(fx.bars_a(spark, sf), p5m, "2023-01-01", "2025-01-01"),
                               (fx.bars_b(spark, sf), pship, "1995-01-01", "2002-01-01"),
                               (fx.bars_b(spark, sf, hot=True), phot, "1995-01-01",
                                "2002-01-01")]:
        lay.write_partitioned(lay.cluster(lay.assign_month(bars, lo, hi)), path)
    bar_5m, bar_ship = spark.read.parquet(p5m), spark.read.parquet(pship)
    bar_hot = spark.read.parquet(phot)
    ru.build_daily(bar_5m, p1d)
    bar_1d = spark.read.parquet(p1d)
    dims_a, dims_b = fx.instruments_a(spark, sf), fx.instruments_b(spark, sf)
    scenarios = {
        "Q1 ticker chart": ch.ticker_chart(bar_5m, dims_a, "NATION_7", "2024-01-08 00:00:00",
                                           "2024-01-15 00:00:00"),
        "Q2 cross-section": cs.cross_section(bar_ship, dims_b, "1998-06-15 00:00:00"),
        "Q3 top movers": mv.top_movers(bar_5m, dims_a, "2024-01-15 14:30:00",
                                       "2024-01-15 20:30:00", 20, with_volume=True),
        "Q6 volatility": volatility_scan(bar_ship, dims_b, 20),
        "Q6 volatility, one instrument with two fifths of the rows, 500-row blocks":
            rolling_vol(bar_hot, 20, block_rows=500),
        "Q9 daily rollup from bars": ru.daily_rollup_for(
            bar_5m, dims_a, "NATION_7", "2024-01-01 00:00:00", "2025-01-01 00:00:00"),
        "Q9b daily rollup from the stored table": ch.daily_chart(
            bar_1d, dims_a, "NATION_7", "2024-01-01", "2025-01-01"),
        "Q10 market volume": mk.market_volume(bar_5m, "2024-01-02 14:30:00",
                                              "2024-01-06 00:00:00"),
    }
    out = ["# Physical plans of the benchmark scenarios", "",
           f"Generated by `tools/explain_plans.py` on `{sf}` after one run of each "
           "query (final adaptive plans). Stored tables are month-partitioned and "
           "clustered by (ticker_id, ts); see README.md.", ""]
    for name, df in scenarios.items():
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue().replace(p5m, "<bar_5m>").replace(pship, "<bar_ship>")
        text = text.replace(p1d, "<bar_1d>").replace(phot, "<bar_hot>")
        out += [f"## {name}", "", "```", text.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
