"""One entry point per layer (A7): ``python -m strata {bronze,silver,gold} --root ROOT``.

Each command runs in the caller's session (an orchestrator's ``spark-submit``),
reads only storage written by the previous layer, and prints the committed
version.  Layers never share in-memory DataFrames.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from strata.layout import Layout
from strata.operators import bronze, dims, gold, silver
from strata.operators.history import VersionedTable
from strata.sources import read_zone_csv


def _months(text: str | None) -> list[tuple[int, int]] | None:
    if not text:
        return None
    out = []
    for part in text.split(","):
        y, m = part.strip().split("-")
        out.append((int(y), int(m)))
    return out


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("layer", choices=["bronze", "silver", "gold"])
    p.add_argument("--root", required=True, help="storage root holding landing/, bronze/, silver/, gold/")
    p.add_argument("--source", default="trips")
    p.add_argument("--batch-id", default=dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ"))
    p.add_argument("--months", help="reload units to (re)process, e.g. 2024-01,2024-02; default all")
    p.add_argument("--zones", help="zone lookup CSV (silver, gold)")
    p.add_argument("--tolerance-months", type=int, default=0)
    p.add_argument("--max-reject-rate", type=float, default=None, help="fail gold when exceeded")
    a = p.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    layout = Layout(a.root.rstrip("/"), a.source)
    months = _months(a.months)
    out: dict = {"layer": a.layer, "batch_id": a.batch_id}
    if a.layer == "bronze":
        out["version"] = bronze.run_bronze(spark, layout, a.batch_id, months=months)
    elif a.layer == "silver":
        zones = a.zones or f"{layout.root}/landing/zone_lookup"
        dim = dims.store_dim_zone(dims.build_dim_zone(dims.conform_zones(read_zone_csv(spark, zones))), layout.dim_zone)
        run = silver.run_silver(
            spark, layout, dim, a.batch_id, months=months, tolerance_months=a.tolerance_months
        )
        out.update(version=run.silver_version, rows=run.rows, rejected=run.rejected)
    else:
        sv = VersionedTable(spark, layout.silver)
        s, rejects, kept = silver.read_kept(sv), silver.read_rejected(sv), silver.kept_by_source(sv)
        if a.max_reject_rate is not None:
            gold.raise_on_reject_rate(gold.reject_rate(s, rejects, kept), a.max_reject_rate)
        cells = dims.zone_cells(dims.conform_zones(read_zone_csv(spark, a.zones or f"{layout.root}/landing/zone_lookup")))
        out["tables"] = gold.build_gold(spark, s, sv.current_version(), layout.gold, rejects=rejects, bridge=cells, kept=kept)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
