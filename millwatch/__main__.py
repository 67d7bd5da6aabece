"""Run one stage, or all: ``python -m millwatch all --landing PATH --run-id ID``.

``refresh`` takes in only the files that landed since the last refresh.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from millwatch.operators.serving import leaderboard
from millwatch.plans import increments, medallion
from millwatch.sources import sinks
from millwatch.sources.session import build_session


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="millwatch", description=__doc__)
    parser.add_argument("stage", choices=["bronze", "silver", "gold", "all", "refresh"])
    parser.add_argument("--landing", help="folder of JSON lines; needed for bronze and refresh")
    parser.add_argument("--run-id", help="names this run's quarantine; needed for silver")
    parser.add_argument("--lake", help="folder of the tables, needed for refresh; catalog tables if not given")
    chosen = parser.parse_args(arguments)
    wanted = ["bronze", "silver", "gold"] if chosen.stage == "all" else [chosen.stage]
    if "bronze" in wanted and not chosen.landing:
        parser.error("bronze needs --landing")
    if "silver" in wanted and not chosen.run_id:
        parser.error("silver needs --run-id")
    if chosen.stage == "refresh" and not (chosen.landing and chosen.lake):
        parser.error("refresh needs --landing and --lake")

    spark = build_session()
    if chosen.stage == "refresh":
        gold = increments.refresh(spark, chosen.landing, chosen.lake)
        if gold is not None:
            sinks.preview(leaderboard(gold))
        return
    lake = medallion.lake_at(chosen.lake) if chosen.lake else medallion.CATALOG_LAKE
    if "bronze" in wanted:
        medallion.load_bronze(spark, chosen.landing, lake)
    if "silver" in wanted:
        medallion.load_silver(spark, lake, chosen.run_id)
    if "gold" in wanted:
        gold = medallion.load_gold(spark, medallion.stored_silver(spark, lake), lake)
        sinks.preview(leaderboard(gold))


if __name__ == "__main__":
    main()
