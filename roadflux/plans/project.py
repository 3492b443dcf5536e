"""The whole project: input files to route table, emission table, exports and reports.

    python -m roadflux.plans.project INPUTS OUTPUTS [--users N]

INPUTS holds pings.parquet, rates.parquet, bus.geojson, metro.csv, nodes.parquet and
edges.parquet (see FIXTURES.md for the columns).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from roadflux.operators import candidates, emissions, flatten, modes, prep, proximity, reports, routing, trips
from roadflux.sources import readers, sinks
from roadflux.storage import materialize

ROUTE_KEYS = ["caid", "date", "row", "i"]


def routes(pings: DataFrame, subway: DataFrame, bus: DataFrame, edges: DataFrame, nodes: DataFrame, users: int | None = None, middles: DataFrame | None = None) -> DataFrame:
    """Raw pings to route rows, with their order (caid, date, row, i)."""
    steps = trips.assign_trips(prep.prepare(pings, users))
    known = modes.classify(proximity.flag_infrastructure(materialize(steps), subway, bus))
    return routing.complete_routes(candidates.with_candidates(materialize(known), edges, nodes, middles=middles), edges, nodes)


def emission_table(route_rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Route rows to the final table under its published names; every row keeps its ordinal."""
    typed = flatten.flatten_types(flatten.with_ordinal(route_rows, ROUTE_KEYS).drop("date", "row", "i"))
    return flatten.export_names(emissions.emissions(typed, rates))


def all_reports(route_table: DataFrame, final: DataFrame, raw: DataFrame) -> dict[str, DataFrame]:
    """Every report by name; each is a few rows."""
    own, done = flatten.engine_names(route_table), flatten.engine_names(final)
    fixed, gaps = own.where("corrected"), prep.gaps(raw)
    return {
        "mode_share_records": reports.record_share(own, "mode"),
        "mode_share_distance": reports.distance_share(own),
        "highway_top5": reports.record_share(own, "highway", 5),
        "routing_success": reports.routing_success(own),
        "routing_losses": reports.losses(own),
        "correction_share": reports.correction_share(own),
        "corrected_distance": reports.describe(fixed, "distance_m", [0.25, 0.5, 0.75, 0.9, 0.95]),
        "corrected_modes": reports.record_share(fixed, "mode"),
        "corrected_highways": reports.record_share(fixed, "highway", 5),
        "pure_vs_synthetic": reports.pure_vs_synthetic(own),
        "source_summary": reports.source_summary(done),
        "pollutant_inventory": reports.inventory(done, ["CO2_Equiv"]),
        "local_inventory": reports.inventory(done, ["CO2", "CO2_Equiv"]),
        "join_quality": reports.join_quality(done),
        "hourly_profile": reports.hourly_profile(done),
        "speed_curve": reports.speed_curve(done),
        "speed_by_mode": reports.speed_by_mode(own),
        "speed_box_stats": reports.box_stats(own),
        "ping_gaps": reports.describe(gaps, "gap_s", [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]),
        "ping_bursts": reports.burst_counts(gaps),
    }


def run(spark: SparkSession, inputs: str, outputs: str, users: int | None = None) -> dict[str, DataFrame]:
    """Read, compute and write everything; returns the reports.

    The projected road edges are kept in OUTPUTS/projected_edges and read from there by later runs.
    """
    pings = readers.read_pings(spark, f"{inputs}/pings.parquet")
    nodes, edges = (readers.with_walk_fallback(readers.read_parquet(spark, f"{inputs}/{x}.parquet")) for x in ("nodes", "edges"))
    bus, subway = readers.read_geojson_lines(spark, f"{inputs}/bus.geojson"), readers.read_metro(spark, f"{inputs}/metro.csv")
    middles = readers.cached_table(spark, f"{outputs}/projected_edges", lambda: candidates.centroids(edges, nodes))
    rows = materialize(routes(pings, subway, bus, edges, nodes, users, middles))
    sinks.write_parquet(flatten.route_table(rows), f"{outputs}/routes")
    sinks.write_parquet(emission_table(rows, readers.read_rates(spark, f"{inputs}/rates.parquet")), f"{outputs}/emissions")
    route_table, final = readers.read_parquet(spark, f"{outputs}/routes"), readers.read_parquet(spark, f"{outputs}/emissions")
    sinks.write_csv(sinks.kepler(final), f"{outputs}/kepler_csv")
    sinks.write_csv(sinks.light(final), f"{outputs}/kepler_light_csv")
    sinks.write_csv(sinks.super_light(final), f"{outputs}/kepler_superlight_csv")
    sinks.write_geojson(final, f"{outputs}/kepler_geojson")
    sinks.write_csv(reports.corrected_sample(flatten.engine_names(route_table), ["caid", "local_timestamp", "start_node", "end_node"]), f"{outputs}/corrected_sample_csv")
    return all_reports(route_table, final, pings)


def main() -> None:
    from roadflux.session import get_session

    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("inputs")
    parser.add_argument("outputs")
    parser.add_argument("--users", type=int, default=None, help="only the first N users of the file")
    args = parser.parse_args()
    for name, report in run(get_session(), args.inputs, args.outputs, args.users).items():
        print(f"== {name}")
        report.show(50, truncate=False)


if __name__ == "__main__":
    main()
