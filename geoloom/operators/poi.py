"""Points of interest: rule cascades, standardisation, fusion of two sources, publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import collections as fc
from geoloom.functions import text as ft
from geoloom.operators.lineage import checkpointed
from geoloom.operators.spatial_joins import nearest, points_in_polygons, within_distance, without_near


@dataclass(frozen=True)
class CategoryRules:
    """Rules of one category: tag values, names, and name aliases by brand with a threshold; `unmatched` is the default."""

    tags: Mapping[str, Mapping[str, Sequence[str]]] = field(default_factory=dict)
    names: Mapping[str, Sequence[str]] = field(default_factory=dict)
    similar: Mapping[str, Sequence[str]] = field(default_factory=dict)
    threshold: float = 0.8
    unmatched: str | None = None


def extended_rules(rules: Mapping[str, Mapping], collected: Mapping[str, Sequence[str]]) -> dict:
    """Every collected tag value without a rule gets the rule value -> {tag: [value]}."""
    out = dict(rules)
    for tag, values in collected.items():
        for value in values:
            out.setdefault(value, {tag: [value]})
    return out


def by_tag(values: Mapping[str, Sequence[str]], strict_first: bool = True) -> Column:
    """Whether a row has one of the values, lower-cased, in one of the tag columns.

    With strict_first=False the first tag only has to be present, whatever its value.
    """
    found = F.lit(False)
    for i, (tag, wanted) in enumerate(values.items()):
        hit = F.lower(F.col(tag)).isin([w.lower() for w in wanted]) if i or strict_first else F.col(tag).isNotNull()
        found = found | F.coalesce(hit, F.lit(False))
    return found


def by_name(names: Sequence[str], columns: Sequence[str] = ("name", "brand", "website")) -> Column:
    """Whether a lower-cased column equals one of the names or holds one of them."""
    wanted = [n.lower() for n in names]
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(F.lower(F.col(c)).isin(wanted), F.lit(False)) | ft.any_of(F.lower(F.col(c)), wanted)
    return found


def by_similarity(aliases: Sequence[str], threshold: float, columns: Sequence[str] = ("name", "brand")) -> Column:
    """Whether a column is alike any alias."""
    found = F.lit(False)
    for c in columns:
        found = found | ft.similar_to_any(F.col(c), aliases, threshold)
    return found


def classified(rules: CategoryRules, name_columns: Sequence[str] = ("name", "brand", "website"), similar_columns: Sequence[str] = ("name", "brand")) -> Column:
    """The category of a row: rules run tag, name, similarity, a later kind only where no earlier rule held; else `unmatched`."""
    steps = [(key, by_tag(v)) for key, v in rules.tags.items()]
    steps += [(key, by_name(v, name_columns)) for key, v in rules.names.items()]
    steps += [(key, by_similarity(v, rules.threshold, similar_columns)) for key, v in rules.similar.items()]
    out = F.lit(rules.unmatched)
    for key, hit in reversed(steps):
        out = F.when(hit, F.lit(key)).otherwise(out)
    return out


def cascade(rows: DataFrame, by_key: Mapping[str, CategoryRules], key: Column, name: str = "category", **columns) -> DataFrame:
    """Classify all keys in one pass: rows of a key run that key's rules, others get null."""
    out = F.lit(None).cast("string")
    for value, rules in by_key.items():
        out = F.when(key == value, classified(rules, **columns)).otherwise(out)
    return rows.withColumn(name, out)


#: Words of a vending machine's tags that make it one for food.
FOOD_WORDS = ("food", "bread", "milk", "eggs", "meat", "potato", "honey", "cheese")


def _overruled(rows: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """The category of the last rule that holds, else that which a row has."""
    out = F.col("category")
    for name, hit in rules:
        out = F.when(F.coalesce(hit, F.lit(False)), F.lit(name)).otherwise(out)
    return rows.withColumn("category", out)


def _with_category(rows: DataFrame) -> DataFrame:
    return rows if "category" in rows.columns else rows.withColumn("category", F.lit(None).cast("string"))


def without_pools(rows: DataFrame, key: str = "osm_id") -> DataFrame:
    """Objects but for swimming pools that no rule has classified: a facility counts, not its pools. Every row of such an object goes."""
    pools = rows.where((F.col("leisure") == "swimming_pool") & F.col("category").isNull()).select(key).distinct()
    return rows.join(pools, key, "left_anti")


def fixed_rules(rows: DataFrame, food_words: Sequence[str] = FOOD_WORDS, key: str = "osm_id", transport: bool = False) -> DataFrame:
    """Categories that depend on several tags at once; of rules that hold, the later one counts.

    Expects columns leisure, sport, amenity, shop, name, osm_type, `key`, and tags map<string,string>; words are sought
    in all keys and values of the tags. With `transport`, stop_rules come after sports and before water parks, and need
    their columns. Swimming pools that no rule up to water parks has classified are left out.
    """
    c, tags = F.col, F.to_json("tags")
    yoga = F.lower(c("name")).contains("yoga")
    fitness = (c("leisure") == "sports_centre") & (c("sport") == "fitness") & ~yoga
    out = _overruled(_with_category(rows), [
        ("playground", (c("leisure") == "playground") | (c("amenity") == "playground")),
        ("bike_sharing", (c("amenity") == "bicycle_rental") & c("shop").isNull() & (c("osm_type") == "n")),
        ("gym", (c("leisure") == "fitness_centre") | fitness),
        ("yoga", ((c("sport") == "yoga") | yoga) & c("shop").isNull()),
    ])
    if transport:
        out = stop_rules(out)
    out = without_pools(_overruled(out, [("water_park", c("leisure") == "water_park")]), key)
    return _overruled(out, [
        ("swimming", c("sport") == "swimming"),
        ("farm_shop", c("shop").isin("farm", "honey")),
        ("charging_station", c("amenity") == "charging_station"),
        ("ebike_charging_station", (c("amenity") == "charging_station") & tags.contains('bicycle":"yes"')),
        ("food_vending_machine", (c("amenity") == "vending_machine") & ft.any_of(tags, food_words)),
        ("religious_site", c("amenity").isin("monastery", "place_of_worship") & tags.contains("wikidata")),
    ])


def stop_rules(rows: DataFrame) -> DataFrame:
    """Bus stops, rail stations and subway entrances from highway, public_transport, railway and tags, all of them named.

    Bus stops are sought among rows without a category; stations and entrances overrule what a row has. Stations are
    neither disused nor for tourism only; a row without a railway tag isn't disused.
    """
    c = F.col
    tag = lambda name: c("tags")[name]
    yes = lambda x: F.coalesce(x, F.lit(False))
    named, halts = c("name").isNotNull(), ("stop", "station", "stop_position")
    in_use = named & tag("disused").isNull() & F.coalesce(tag("usage") != "tourism", F.lit(True))
    bus = (c("highway") == "bus_stop") | ((c("public_transport") == "platform") & (tag("bus") == "yes"))
    by_railway = (c("railway") == "station") & in_use & tag("railway:disused").isNull()
    trains = (tag("train") == "yes") | (tag("rail") == "yes")
    gone = yes(c("railway").isin("disused_station", "proposed"))
    by_trains = (yes(c("railway").isin(*halts)) | yes(c("public_transport").isin(*halts))) & ~gone & trains & in_use
    return _overruled(_with_category(rows), [
        ("bus_stop", yes(bus) & named & c("category").isNull()),
        ("rail_station", yes(by_railway) | yes(by_trains)),
        ("subway_entrance", (c("railway") == "subway_entrance") & named),
    ])


def tram_stops(stops: DataFrame, platforms: DataFrame, apart: float = 100.0) -> DataFrame:
    """Stop positions, and platforms without one within `apart` metres (x and y in metres)."""
    return stops.unionByName(without_near(platforms, stops, apart), allowMissingColumns=True)


def named_entrances(entrances: DataFrame, stations: DataFrame, key: str, station_key: str, reach: float = 350.0) -> DataFrame:
    """Entrances with their own name, or else that of the nearest station in reach; those without either are left out."""
    near = nearest(entrances.where("name is null"), stations.where("name is not null"), reach, key, station_key)
    found = near.select(F.col(f"l.{key}").alias("found_key"), F.col("r.name").alias("found_name"))
    joined = entrances.join(found, entrances[key] == F.col("found_key"), "left").withColumn("name", F.coalesce("name", "found_name"))
    return joined.drop("found_key", "found_name").where("name is not null")


def standardised(rows: DataFrame, source: str = "OSM", named_tags: Sequence[str] = ("brand", "origin", "organic")) -> DataFrame:
    """Trimmed and validated columns; tags joined with named columns, without nulls, and with where the row comes from."""
    own = F.create_map(*[x for c in named_tags for x in (F.lit(c), ft.blank_to_null(F.col(c)))])
    origin = F.create_map(F.lit("extended_source"), F.to_json(F.struct("osm_id", "osm_type")))
    return rows.select(
        *[ft.blank_to_null(F.col(c)).alias(c) for c in ("name", "street", "housenumber", "zipcode", "phone", "opening_hours", "operator")],
        ft.valid_email(F.col("email")).alias("email"),
        ft.valid_url(F.col("website")).alias("website"),
        F.when(F.col("capacity").rlike(r"^\s*[0-9]+\s*$"), ft.to_int(F.trim("capacity"))).alias("capacity"),
        F.when(F.lower(F.trim("wheelchair")).isin("yes", "no", "limited"), F.lower(F.trim("wheelchair"))).alias("wheelchair"),
        F.lit(source).alias("source"),
        fc.merged_tags(own, F.col("tags"), origin).alias("tags"),
        *[F.col(c) for c in ("category", "x", "y") if c in rows.columns],
    )


def places(rows: DataFrame, least: float = 0.6) -> DataFrame:
    """Places with a category and a confidence above `least`: first phone and website of their JSON arrays, tags of the rest."""
    tags = fc.merged_tags(F.create_map(F.lit("confidence"), F.col("confidence").cast("string"), F.lit("social_media"), fc.first_of_json_array(F.col("socials")), F.lit("brand"), ft.unquoted(F.col("brand"))))
    out = rows.where("categories is not null and confidence > " + str(least))
    return out.withColumns({"phone": fc.first_of_json_array(F.col("phones")), "website": fc.first_of_json_array(F.col("websites")), "name": ft.unquoted(F.col("names")), "tags": tags})


def similar_pairs(left: DataFrame, right: DataFrame, radius: float, threshold: float, left_id: str = "id", right_id: str = "id", left_name: str = "name", right_name: str = "name") -> DataFrame:
    """(a, b, sim): ids of rows within `radius` whose names share `threshold` of trigrams, or miss it by rounding alone.

    Rows travel as id, point and trigram numbers; pairs of too unlike sizes are never intersected, others once before
    they are pairs. The exact comparison belongs after an aggregate: as a condition Spark would move it into the join
    and count each pair's trigrams several times over."""
    side = lambda rows, key, name: rows.select(F.col(key).alias("id"), "x", "y", ft.trigram_codes(F.col(name)).alias("grams"))
    x, y = F.col("l.grams"), F.col("r.grams")
    near = within_distance(side(left, left_id, left_name), side(right, right_id, right_name), radius, also=ft.may_overlap(x, y, threshold), spread=True)
    return near.select(F.col("l.id").alias("a"), F.col("r.id").alias("b"), ft.trigram_overlap(x, y).alias("sim"))


def alike(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(x, y, name, rep): the least id of all rows at one point with one name; rows without either are left out."""
    known = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col(name).isNotNull())
    return known.groupBy("x", "y", F.col(name).alias("name")).agg(F.min(key).alias("rep"))


def with_alike(rows: DataFrame, found: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """Rows as `l` with what was found for their point and name (x, y, name)."""
    at = found.withColumnsRenamed({"x": "alike_x", "y": "alike_y", "name": "alike_name"})
    here = (F.col("l.x") == F.col("alike_x")) & (F.col("l.y") == F.col("alike_y")) & (F.col(f"l.{name}") == F.col("alike_name"))
    return rows.select(F.struct("*").alias("l")).join(at, here, how).drop("alike_x", "alike_y", "alike_name")


def best_matches(left: DataFrame, right: DataFrame, radius: float, threshold: float, left_id: str = "id", right_id: str = "id", left_name: str = "name", right_name: str = "name") -> DataFrame:
    """(l, r, sim): for each left row the most similar right row within `radius` whose names share `threshold` of trigrams.

    Ids are unique on either side; equal similarities go by the right id. Rows with one point and one name have the same
    partner and are compared once, as their least id. The best partner is an aggregate, combined before its shuffle; whole
    rows meet their ids after it.
    """
    own = alike(left, left_id, left_name)
    pairs = similar_pairs(own, alike(right, right_id, right_name), radius, threshold, "rep", "rep")
    best = pairs.groupBy("a").agg(F.min(F.struct((-F.col("sim")).alias("order"), "b", "sim")).alias("best")).select("a", "best.b", "best.sim").where(F.col("sim") >= threshold)
    found = own.join(best, F.col("rep") == F.col("a")).join(right.select(F.struct("*").alias("r")), F.col("b") == F.col(f"r.{right_id}"))
    return with_alike(left, found.select("x", "y", "name", "r", "sim"), left_name).select("l", "r", "sim")


def fused(left: DataFrame, right: DataFrame, radius: float, threshold: float, unmatched: str = "keep", matched: str = "keep", extra: str = "add", left_all: DataFrame | None = None, key: str = "id", name: str = "name") -> DataFrame:
    """One table of two sources, with `decision` of each row.

    unmatched left rows are kept or dropped; matched ones are kept, or take the right row's values: `combine` fills nulls
    from the right, `replace` prefers the right where it isn't null. Right rows without any similar left row in reach
    (of `left_all`, all categories) are added or dropped. Rows with one point and one name are compared once, as their least
    id. Pairs are computed once: what both sides need of them, the best
    partner of a left row and whether a right row has one, is one aggregate, kept in the folder for checkpoints. Ids of
    both sides have one type.
    """
    own, others = alike(left, key, name), alike(right, key, name)
    pairs = similar_pairs(own, others, radius, threshold, "rep", "rep")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("own"), (-F.col("sim")).alias("order"), F.col("b").alias("other")), F.struct(F.lit(1).alias("side"), F.col("b").alias("own"), (-F.col("sim")).alias("order"), F.col("a").alias("other")))
    met = checkpointed(pairs.select(F.explode(sides).alias("s")).select("s.*").groupBy("side", "own").agg(F.min(F.struct("order", "other")).alias("best")).where(F.col("best.order") <= -threshold))
    partners = right.select(F.struct("*").alias("partner"))
    best = met.where("side = 0").join(partners, F.col("best.other") == F.col(f"partner.{key}")).join(own, F.col("own") == F.col("rep"))
    found = with_alike(left, best.select("x", "y", "name", "partner"), name).select(F.col(f"l.{key}").alias("found_key"), "partner")
    joined = left.join(found, left[key] == F.col("found_key"), "left")
    shared = [c for c in left.columns if c in right.columns and c not in (key, "x", "y")]
    values = []
    for c in left.columns:
        other = F.col(f"partner.{c}") if c in shared else None
        if other is None or matched == "keep":
            values.append(left[c])
        else:
            values.append((F.coalesce(left[c], other) if matched == "combine" else F.coalesce(other, left[c])).alias(c))
    label = {"keep": "kept", "combine": "combined", "replace": "replaced"}[matched]
    out = joined.select(*values, F.when(F.col("partner").isNull(), F.lit("unmatched")).otherwise(F.lit(label)).alias("decision"))
    if unmatched == "drop":
        out = out.where("decision <> 'unmatched'")
    if extra == "add":
        if left_all is None:
            reached = others.join(met.where("side = 1").select("own"), F.col("rep") == F.col("own"), "left_semi")
            new = with_alike(right, reached, name, "left_anti").select("l.*")
        else:
            new = added(left_all, right, radius, threshold, name)
        out = out.unionByName(new.withColumn("decision", F.lit("added")), allowMissingColumns=True)
    return out


def added(left_all: DataFrame, right: DataFrame, radius: float, threshold: float, name: str = "name") -> DataFrame:
    """Right rows without a left row in reach whose name is similar; rows with one point and one name are compared once."""
    grams = lambda rows: rows.select("x", "y", "name").distinct().withColumn("grams", ft.trigram_codes(F.col("name")))
    side = lambda rows: grams(rows.select("x", "y", F.col(name).alias("name")).where("x is not null and y is not null and name is not null"))
    x, y = F.col("l.grams"), F.col("r.grams")
    near = within_distance(side(right), side(left_all), radius, how="left_semi", also=ft.may_overlap(x, y, threshold) & (ft.trigram_overlap(x, y) >= threshold), spread=True)
    return with_alike(right, near.select("l.x", "l.y", "l.name"), name, "left_anti").select("l.*")


def recategorised(rows: DataFrame, top: str) -> DataFrame:
    """Rows of a sub-category under their top-level category, the former one among other_categories."""
    moved = F.col("category") != top
    others = F.coalesce(F.col("other_categories"), F.array().cast("array<string>"))
    return rows.withColumns({"other_categories": F.when(moved, F.array_append(others, F.col("category"))).otherwise(others), "category": F.lit(top)})


def matching_key(source: Column, extended: Column) -> Column:
    """JSON of a row's source and extended source, null unless both are there."""
    return F.when(source.isNotNull() & extended.isNotNull(), F.to_json(F.struct(source.alias("source"), extended.alias("extended_source"))))


def in_area(points: DataFrame, areas: DataFrame, cell: float, rule: str = "rule") -> DataFrame:
    """Points that lie in a subscribed area and in no excluded one; `cell` is the least width of the cells
    that cover areas, a small part of theirs."""
    yes = points_in_polygons(points, areas.where(F.col(rule) == "subscribe"), cell, how="left_semi").select("l.*")
    return points_in_polygons(yes, areas.where(F.col(rule) == "exclude"), cell, how="left_anti").select("l.*")


def published(points: DataFrame, areas: DataFrame, category: str, sources: Sequence[str], cell: float = 1.0) -> DataFrame:
    """Clean points of a category and of listed sources inside the subscribed area."""
    rows = points.where((F.col("category") == category) & F.col("source").isin(list(sources)))
    clean = in_area(rows, areas, cell)
    return clean.withColumns({"name": ft.blank_to_null(F.col("name")), "email": ft.valid_email(F.col("email")), "website": ft.valid_url(F.col("website"))})


def source_dates(subscriptions: DataFrame, dates: Mapping[str, str], fused_source: str = "OSM_Overture") -> DataFrame:
    """Subscriptions with the date of their source; a fused source has the older of its parts."""
    known = fc.lookup({**dates, fused_source: min(dates.values())}, F.col("source")) if dates else F.lit(None).cast("string")
    return subscriptions.withColumn("source_date", F.coalesce(known.cast("timestamp"), F.col("source_date")))
