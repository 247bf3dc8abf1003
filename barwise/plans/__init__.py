"""Composite queries: charts (``chart``), cross-section (``cross_section``),
top movers (``movers``), volatility (``volatility``), rollups (``rollup``)
and market volume (``market``). Import the submodules; their function
names are not re-exported here so they cannot shadow the modules."""
