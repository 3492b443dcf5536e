"""The registered queries over the derived domain inputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflux.functions import clock
from roadflux.functions.bins import POLLUTANTS
from roadflux.functions.geo import with_utm
from roadflux.operators import candidates, emissions, flatten, metro, modes, paths, prep, proximity, reports, routing, trips
from roadflux.sources import fixtures as fx
from roadflux.sources import readers, sinks
from roadflux.storage import drop_folder, materialize, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(*names: str) -> list[Column]:
    return [F.round(F.col(f"`{n}`"), 6).alias(n) for n in names]


def exact6(*names: str) -> list[Column]:
    """Rounded to six digits as decimals.

    Products of short decimals often end in an exact 5 at the seventh digit, where
    engines that round the binary value differ; as decimals they round alike.
    """
    return [F.round(F.col(f"`{n}`").cast("decimal(28,10)"), 6).cast("double").alias(n) for n in names]


def micro(ts: str, name: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


# --- pings -----------------------------------------------------------------


def thinned(spark: SparkSession, sf_dir: str, fold: int | None = 4) -> DataFrame:
    return prep.downsample(prep.normalize_time(fx.pings(spark, sf_dir, fold)))


def fenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.geofence(thinned(spark, sf_dir))


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.whole_days(prep.drop_sparse_ids(fenced(spark, sf_dir)))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.prepare(fx.pings(spark, sf_dir))


def segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.assign_trips(steps(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proximity.flag_infrastructure(materialize(segmented(spark, sf_dir)), fx.lines(spark, fx.METRO_LINES), fx.lines(spark, fx.BUS_LINES))


@query
def ping_time_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = prep.normalize_time(fx.pings(spark, sf_dir))
    return local.select("caid", "ping_seq", micro("local_timestamp", "local_time"), clock.bucket(F.col("local_timestamp"), 10).cast("bigint").alias("bucket"))


@query
def user_sample_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.sample_users(fx.pings(spark, sf_dir, None), 4).select("caid", "ping_seq")


@query
def downsample_10s_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thinned(spark, sf_dir).select("caid", "ping_seq", *r6("latitude", "longitude"))


@query
def geofence_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fenced(spark, sf_dir).select("caid", "ping_seq", F.round("Distance", 6).alias("distance_km"))


@query
def sparse_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.drop_sparse_ids(fx.pings(spark, sf_dir, None), threshold=70).select("caid", "ping_seq")


@query
def complete_days_shield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(spark, sf_dir).select("caid", "ping_seq", F.col("date").cast("string").alias("day"))


@query
def lead_speed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.vectors(dated(spark, sf_dir)).select("caid", "ping_seq", *r6("dis_lineal_m", "speed_kmh"))


@query
def travel_time_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps(spark, sf_dir).select("caid", "ping_seq", *r6("travel_s"))


@query
def trip_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmented(spark, sf_dir).select("caid", "ping_seq", "trip")


@query
def near_infrastructure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir).select("caid", "ping_seq", "near_subway_line", "near_bus_route")


@query
def nearest_line_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = with_utm(fenced(spark, sf_dir).select("latitude", "longitude").distinct(), "latitude", "longitude", "x", "y")
    places = places.withColumn("place", F.concat_ws(" ", F.round("latitude", 4).cast("string"), F.round("longitude", 4).cast("string")))
    found = proximity.nearest_line(places, proximity.planar_segments(fx.lines(spark, fx.BUS_LINES)), "place")
    return found.select("place", "line_id", F.round("distance_m", 4).alias("distance_m"))


@query
def mode_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modes.classify(flagged(spark, sf_dir)).select("caid", "ping_seq", "trip", "mode")


@query
def ping_gap_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.describe(prep.gaps(fx.pings(spark, sf_dir)), "gap_s", [0.25, 0.5, 0.75, 0.9, 0.95, 0.99])
    return out.select("count", *[F.round(c, 4).alias(c) for c in out.columns if c != "count"])


@query
def ping_burst_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.burst_counts(prep.gaps(fx.pings(spark, sf_dir)))
    return out.select("pings", "within_1s", "within_5s", "within_10s", *r6("pct_1s", "pct_5s"))


@query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, thin, fence = fx.pings(spark, sf_dir), thinned(spark, sf_dir), prep.drop_sparse_ids(fenced(spark, sf_dir))
    out = reports.stage_counts(raw, thin, fence, prep.whole_days(fence))
    return out.select("raw", "thinned", "filtered", "kept", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"), *r6("noise_pct"))


# --- routes ----------------------------------------------------------------


def driving_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, nodes = fx.lattice_edges(spark), fx.lattice_nodes(spark)
    return materialize(routing.legs(candidates.with_candidates(materialize(segmented(spark, sf_dir).withColumn("mode", F.lit("Carro"))), edges, nodes)))


def fixed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of straight lattice rows as if they were chosen routes, one for every event, with several times and limits."""
    ids = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias("row"), F.floor(F.col("event_id") % 48 / 4).alias("r"), (F.col("event_id") % 4).alias("q"))
    path = F.sequence(F.col("r") * 22, F.col("r") * 22 + 5 + F.col("q") * 5)
    routes = ids.withColumn("path", path).withColumns({"graph": F.lit("drive"), "u": F.element_at("path", 1), "v": F.element_at("path", -1)})
    facts = routes.select("row", "graph", "u", "v", (F.lit(20.0) + F.col("row") * 17 % 211).alias("leg_s"), F.when(F.col("q") == 0, 15.0).otherwise(100.0).alias("limit_kmh"), (F.col("row") % 5 == 0).alias("too_fast"))
    edges = fx.lattice_edges(spark)
    distinct = routes.select("graph", "u", "v", "path").distinct()
    each = paths.path_edges(distinct, edges)
    out = facts.join(each, ["graph", "u", "v"]).join(paths.path_lengths(distinct, edges), ["graph", "u", "v"])
    start = F.timestamp_add("MINUTE", F.col("row"), F.lit("2024-01-01 06:00:00").cast("timestamp_ntz"))
    return out.withColumns({"caid": F.lit("x"), "date": F.lit("2024-01-01").cast("date"), "local_timestamp": start})


@query
def knn_edge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = candidates.candidate_nodes(fenced(spark, sf_dir), candidates.centroids(fx.lattice_edges(spark), fx.lattice_nodes(spark)), "drive")
    return found.select(*[F.round(c, 4).alias(c) for c in ("latitude", "longitude")], F.array_join(F.transform("nodes_drive", lambda n: n.cast("string")), ",").alias("nodes"))


@query
def shortest_path_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = fx.lattice_nodes(spark), fx.lattice_edges(spark)
    pairs = nodes.select("graph", F.col("node").alias("u")).join(nodes.select("graph", F.col("node").alias("v")), "graph")
    return paths.path_lengths(paths.shortest_paths(pairs, edges), edges).select("graph", "u", "v", *r6("length_m"))


@query
def route_pair_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    options, edges = routing.pairs(driving_legs(spark, sf_dir)), fx.lattice_edges(spark)
    lengths = paths.path_lengths(paths.shortest_paths(options.select("graph", "u", "v"), edges), edges)
    best = routing.select_pairs(routing.scored_pairs(options, lengths))
    return best.select("caid", F.col("date").cast("string").alias("day"), "row", "u", "v", *r6("length_m", "score"), "too_fast")


@query
def route_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs, edges = driving_legs(spark, sf_dir), fx.lattice_edges(spark)
    options = routing.pairs(legs)
    lengths = paths.path_lengths(paths.shortest_paths(options.select("graph", "u", "v"), edges), edges)
    out = routing.continue_routes(legs, routing.scored_pairs(options, lengths))
    return out.select("caid", F.col("date").cast("string").alias("day"), "row", "u", "v", "start", "too_fast")


@query
def complete_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: pings to completed route rows under their published names."""
    edges, nodes = fx.lattice_edges(spark), fx.lattice_nodes(spark)
    own = candidates.with_candidates(materialize(modes.classify(flagged(spark, sf_dir))), edges, nodes)
    return flatten.route_table(routing.complete_routes(own, edges, nodes)).withColumn("local_timestamp", micro("local_timestamp", "t"))


@query
def edge_time_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = routing.with_clock(routing.allocate(fixed_steps(spark, sf_dir)))
    return out.select("row", "i", *r6("alloc_s", "edge_kmh"), micro("edge_time", "edge_time"))


@query
def route_physics_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.correct(routing.allocate(fixed_steps(spark, sf_dir))).select("row", "i", *r6("speed_out", "distance_m"), "failed", "corrected")


@query
def stop_and_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leg as if no route had been found."""
    legs = driving_legs(spark, sf_dir)
    none = legs.select("caid", "date", "row", F.lit(None).cast("bigint").alias("u"), F.element_at("starts", 1).alias("start"))
    out = routing.fallback_rows(legs, none, fx.lattice_nodes(spark))
    return out.select("caid", F.col("date").cast("string").alias("day"), "row", "trip", *r6("latitude", "longitude"), "start_node", "end_node", "highway", "failed")


# --- emissions -------------------------------------------------------------


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emissions.features(fx.segments(spark, sf_dir))


def joined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    means = materialize(emissions.preaggregate(fx.rates(spark)))
    return emissions.exact_join(featured(spark, sf_dir), means), means


def emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emissions.emissions(fx.segments(spark, sf_dir), fx.rates(spark))


def _key(*more: str) -> list[Column]:
    return [F.col(c) for c in fx.ORDER[:-1]] + [F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate")] + [F.col(c) for c in more]


@query
def moves_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured(spark, sf_dir).select(*_key("Month", "Hour", "Day", "Road", "Source", "SpeedBin"), *r6("avg_speed_mph"))


@query
def route_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.with_ordinal(fx.segments(spark, sf_dir), fx.ORDER).select(*_key("orden_original"))


@query
def rates_preaggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emissions.preaggregate(fx.rates(spark)).select(*emissions.KEYS, *r6(*POLLUTANTS))


@query
def rates_exact_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(spark, sf_dir)[0].where("Source > 0").select(*_key(), *r6(*POLLUTANTS))


@query
def rates_curve_ffill_bfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emissions.curves(emissions.preaggregate(fx.rates(spark))).select("Source", "SpeedBin", *r6(*POLLUTANTS))


@query
def rates_imputation_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emissions.impute(*joined(spark, sf_dir)).select(*_key("Source"), *r6(*POLLUTANTS))


@query
def emission_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emitted(spark, sf_dir).select(*_key("fecha_kepler"), *exact6("distance_km_calc", *[f"Total_{p}_g" for p in POLLUTANTS]))


@query
def mode_share_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.record_share(fx.segments(spark, sf_dir), "mode")


@query
def mode_share_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distance_share(fx.segments(spark, sf_dir)).select("mode", F.round("distance_m", 4).alias("distance_m"), "pct")


@query
def highway_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.record_share(fx.segments(spark, sf_dir), "highway", 5)


@query
def routing_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.routing_success(fx.segments(spark, sf_dir)).select("moving", "failures", "topology", "physics", *r6("failed_pct", "success_pct"))


@query
def correction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of corrected rows, and which modes and roads they are on."""
    rows = fx.segments(spark, sf_dir)
    whole = reports.correction_share(rows).select(F.lit("moving").alias("part"), F.lit("all").alias("name"), F.col("corrected_rows").alias("n"), F.bround("corrected_pct", 2).alias("pct"))
    fixed = rows.where("corrected")
    by_mode = reports.record_share(fixed, "mode").select(F.lit("mode").alias("part"), F.col("mode").alias("name"), "n", "pct")
    by_road = reports.record_share(fixed, "highway", 5).select(F.lit("highway").alias("part"), F.col("highway").alias("name"), "n", "pct")
    return whole.unionByName(by_mode).unionByName(by_road)


@query
def corrected_distance_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.describe(fx.segments(spark, sf_dir).where("corrected"), "distance_m", [0.25, 0.5, 0.75, 0.9, 0.95])
    return out.select("count", *r6(*[c for c in out.columns if c != "count"]))


@query
def corrected_sample_1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.segments(spark, sf_dir)
    keys = {"k_quantity": F.round("l_quantity").cast("bigint"), "k_cents": F.round(F.col("l_extendedprice") * 100).cast("bigint"), "k_day": F.date_format("l_shipdate", "yyyy-MM-dd")}
    return reports.corrected_sample(rows.withColumns(keys), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *keys]).select(*_key("caid", "trip", "mode"))


@query
def routing_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.losses(fx.segments(spark, sf_dir))


@query
def pure_vs_synthetic_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.pure_vs_synthetic(fx.segments(spark, sf_dir))
    return out.select(*r6(*out.columns))


@query
def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.source_summary(emitted(spark, sf_dir)).select("Source", "name", "records", *r6("km", "records_pct", "km_pct"))


@query
def pollutant_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.inventory(emitted(spark, sf_dir), ["CO2_Equiv"]).select("pollutant", *[F.round(c, 3).alias(c) for c in ("grams", "kg", "pct")])


@query
def local_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.inventory(emitted(spark, sf_dir), ["CO2", "CO2_Equiv"]).select("pollutant", *[F.round(c, 3).alias(c) for c in ("grams", "kg", "pct")])


@query
def join_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.join_quality(emitted(spark, sf_dir)).select("motorised", "orphans", "zero_distance", *r6("success_pct"))


@query
def hourly_co2e_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_profile(emitted(spark, sf_dir)).select("Hour", F.round("kg", 5).alias("kg"))


@query
def speed_bin_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.speed_curve(emitted(spark, sf_dir)).select("SpeedBin", *r6("g_km"))


@query
def speed_describe_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.speed_by_mode(fx.segments(spark, sf_dir))


@query
def speed_box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.box_stats(fx.segments(spark, sf_dir))


# --- exports ---------------------------------------------------------------


def as_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emissions under published names, with stand-ins for the columns that only routing makes."""
    out = emitted(spark, sf_dir).withColumns(
        {
            "osmid": F.col("l_partkey"), "start_node": F.col("l_suppkey"), "end_node": F.col("l_suppkey") + 1,
            "latitude": F.lit(25.0) + F.col("l_linenumber") / 100, "longitude": F.lit(-100.0) - F.col("l_linenumber") / 100,
            "geometry": F.when(F.col("l_linenumber") != 5, F.concat(F.lit("POINT ("), F.col("l_suppkey").cast("string"), F.lit(" 25)"))),
        }
    )
    return flatten.export_names(out)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[exact6(c)[0] if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes])


@query
def type_flattener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes as text with some unreadable fields, brought to their final types."""
    rows = fx.segments(spark, sf_dir)
    bad = F.col("l_linenumber") == 3
    text = rows.select(
        "caid", F.when(~bad, F.col("trip").cast("string")).alias("trip"), F.when(bad, "n/a").otherwise(F.col("speed_kmh").cast("string")).alias("speed_kmh"),
        F.when(bad, "never").otherwise(F.col("local_timestamp").cast("string")).alias("local_timestamp"), F.when(~bad, F.col("failed").cast("string")).alias("failed"),
        "highway", "l_partkey", "l_extendedprice",
    )
    out = flatten.flatten_types(text.where("highway is not null"))
    return out.select("caid", "trip", "speed_kmh", F.date_format("local_timestamp", "yyyy-MM-dd HH:mm:ss").alias("local_time"), "failed", "highway", "l_partkey", "l_extendedprice")


@query
def kepler_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sinks.kepler(as_published(spark, sf_dir), sinks.KEPLER_GEO))


@query
def kepler_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sinks.light(as_published(spark, sf_dir)))


@query
def kepler_superlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sinks.super_light(as_published(spark, sf_dir)))


# --- files -----------------------------------------------------------------


def through_files(spark: SparkSession, write: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` makes of the files that ``write`` leaves in a new shared folder."""
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    write(folder)
    out = materialize(read(folder))
    drop_folder(spark, folder)
    return out


def wkt_ends(df: DataFrame, *more: str) -> DataFrame:
    """Ends of the lines' segments, six digits."""
    parts = df.select("line_id", *more).join(readers.line_segments(df.select("line_id", "geometry")), "line_id")
    return parts.select(*more, *r6("lon1", "lat1", "lon2", "lat2"))


def drawn_edges(spark: SparkSession) -> DataFrame:
    """(u, v, lon1, lat1, lon2, lat2) of the drive graph."""
    place, edges = fx.lattice_nodes(spark).where("graph = 'drive'"), fx.lattice_edges(spark).where("graph = 'drive'")
    out = edges.select("u", "v").join(place.select(F.col("node").alias("u"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1")), "u")
    return out.join(place.select(F.col("node").alias("v"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")), "v")


@query
def pings_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_pings(spark, f"{sf_dir}/events.parquet").select("event_id", "ping_seq", "user_id", *r6("value"))


@query
def rates_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = through_files(spark, lambda path: sinks.write_parquet(fx.rates(spark), path), lambda path: readers.read_rates(spark, path))
    return back.select(*emissions.KEYS, *r6(*POLLUTANTS))


@query
def routes_through_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table written and read again, wanted columns only."""
    names = [*fx.ORDER, "caid", "trip", "fecha_kepler", "Speed [km/h]", "distance_m", "highway"]
    back = through_files(spark, lambda path: sinks.write_parquet(as_published(spark, sf_dir), path), lambda path: readers.read_parquet(spark, path, names))
    return back.select(*_key("caid", "trip", "fecha_kepler"), *exact6("Speed [km/h]", "distance_m"), "highway")


@query
def kepler_csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.kepler(as_published(spark, sf_dir))
    back = through_files(spark, lambda path: sinks.write_csv(rows, path), lambda path: spark.read.schema(rows.schema).option("header", True).csv(path))
    return _rounded(back)


@query
def kepler_geojson_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "type string, properties struct<caid: string, trip: int, highway: string, start_node: string, end_node: string, distance_m: double, Total_CO2_g: double>, geometry struct<type: string, coordinates: array<double>>"
    back = through_files(spark, lambda path: sinks.write_geojson(as_published(spark, sf_dir), path), lambda path: spark.read.schema(kind).json(path))
    back = back.select("type", F.col("geometry.type").alias("shape"), F.col("geometry.coordinates")[0].alias("lon"), F.col("geometry.coordinates")[1].alias("lat"), "properties.*")
    return back.select("type", "shape", "lon", "lat", "caid", "trip", "highway", "start_node", "end_node", *exact6("distance_m", "Total_CO2_g"))


@query
def geojson_lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections of lines, some of them multi-lines, to WKT; u and v come back by the order of the ends."""
    edges = drawn_edges(spark)
    line = F.array(F.array("lon1", "lat1"), F.array("lon2", "lat2"))
    shape = F.when(F.col("u") % 2 == 0, F.concat(F.lit('{"type":"LineString","coordinates":'), F.to_json(line), F.lit("}")))
    shape = shape.otherwise(F.concat(F.lit('{"type":"MultiLineString","coordinates":'), F.to_json(F.array(line)), F.lit("}")))
    each = edges.groupBy("u").agg(F.concat_ws(",", F.collect_list(F.concat(F.lit('{"type":"Feature","properties":{},"geometry":'), shape, F.lit("}")))).alias("f"))
    files = each.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))
    back = through_files(spark, lambda path: files.write.option("maxRecordsPerFile", 1).text(path), lambda path: wkt_ends(readers.read_geojson_lines(spark, path)))
    return edges.select("u", "v", *r6("lon1", "lat1", "lon2", "lat2")).join(back, ["lon1", "lat1", "lon2", "lat2"]).select("u", "v", "lon1", "lat1", "lon2", "lat2")


@query
def metro_table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three layouts of a metro table, each through a CSV file."""
    points = fx.lattice_nodes(spark).where("graph = 'drive'").select("lat", "lon")
    text = F.concat(F.lit("LINESTRING ("), F.concat_ws(" ", F.col("lon1").cast("string"), F.col("lat1").cast("string")), F.lit(", "), F.concat_ws(" ", F.col("lon2").cast("string"), F.col("lat2").cast("string")), F.lit(")"))
    lines = drawn_edges(spark).select(text.alias("geometry"))
    tables = {"points": points, "geometry": lines, "WKT": lines.withColumnRenamed("geometry", "WKT")}
    out = [through_files(spark, lambda path, t=t: sinks.write_csv(t, path), lambda path, n=n: wkt_ends(readers.read_metro(spark, path)).withColumn("layout", F.lit(n))) for n, t in tables.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def walk_graph_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.with_walk_fallback(fx.lattice_edges(spark).where("graph = 'drive'")).select("graph", "u", "v", *r6("length"))


@query
def projected_graph_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built and kept at the first call, only read at the second."""

    def read(path: str) -> DataFrame:
        def never() -> DataFrame:
            raise RuntimeError("the table is there already")

        return readers.cached_table(spark, path, never)

    back = through_files(spark, lambda path: readers.cached_table(spark, path, lambda: with_utm(fx.lattice_nodes(spark), "lat", "lon", "x", "y")), read)
    return back.select("graph", "node", *[F.round(c, 3).alias(c) for c in ("x", "y")])


@query
def metro_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = with_utm(fx.lattice_nodes(spark).where("graph = 'drive'"), "lat", "lon", "x", "y")
    far = spots.select(F.col("node").alias("to"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    trips_ = spots.select(F.col("node").alias("trip_id"), F.col("x").alias("x1"), F.col("y").alias("y1"), ((F.col("node") * 37 + 11) % 264).alias("to")).join(far, "to").drop("to")
    out = metro.metro_course(trips_, proximity.planar_segments(fx.lines(spark, fx.METRO_LINES)), 5)
    return out.select("trip_id", "n", *[F.round(c, 3).alias(c) for c in ("x", "y")])
