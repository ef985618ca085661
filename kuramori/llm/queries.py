"""Queries of the problems tagged llm; SQL counterparts are in ``sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kuramori.llm import address, canonical, matching, mixing, mojibake, names, packing, tokens, uniform
from kuramori.llm.sql import SQL
from kuramori.operators.dedupe import one_per_key
from kuramori.session import cut, table

__all__ = ["QUERIES", "SQL"]


def _mapped(spark: SparkSession, folder: str) -> DataFrame:
    ref = table(spark, folder, "heritage_type_ref")
    entries = canonical.reference_entries(ref, "heritage_type_major_code", ["heritage_type_major_ja", "label_kana", "label_en"], ["aliases"])
    values = table(spark, folder, "observed_values").filter("raw_value is not null and raw_value <> ''")
    return canonical.map_values(values.select("obs_id", "source_field", "raw_value"), "raw_value", entries)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The code of each observed value, or ``unmatched``."""
    return _mapped(spark, folder).select("obs_id", F.col("match.code").alias("heritage_type_major_code")).distinct()


def p1_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Values without a code, with how often and in which fields they were typed."""
    m = _mapped(spark, folder).filter(F.col("match.code") == canonical.UNMATCHED)
    return m.groupBy("raw_value").agg(F.count_distinct("obs_id").alias("observations"), F.array_join(F.array_sort(F.collect_set("source_field")), ";").alias("fields"), F.max("match.score").alias("nearest"))


def _kind_entries(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    return canonical.reference_entries(table(spark, folder, "heritage_type_ref"), "heritage_type_major_code", ["heritage_type_major_ja"], ["aliases"])


def p3_entities(spark: SparkSession, folder: str) -> DataFrame:
    """(field, key, entity) of every listing, record and owner text with a readable name."""
    kinds = _kind_entries(spark, folder)
    listings, records = table(spark, folder, "museum_location_review"), table(spark, folder, "records")
    listings = listings.withColumn("cells", names.place_cells("longitude", "latitude"))
    found = names.profiles(listings, "facility_name", "museum_id", "facility_name", "municipality_code", kinds, "cells")
    found = found.union(names.profiles(records, "name", "record_uid", "name", "municipality_code", kinds))
    return names.resolve(found.union(names.profiles(records, "owner", "owner", "owner", None, kinds)))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of listings, records and owner texts that mean the same facility, property or owner."""
    return address.pairs_within(cut(p3_entities(spark, folder)), ["field", "entity"], "key").select("field", "key_a", "key_b")


def p4_places(spark: SparkSession, folder: str) -> DataFrame:
    """(key, place) of every listing and record with a readable address."""
    towns = address.gazetteer_rows(table(spark, folder, "town_master"))
    listings = table(spark, folder, "museum_location_review").select("museum_id", "address_raw", "address_normalized", "municipality_code", "postal_code")
    records = table(spark, folder, "records").filter("address is not null and address <> ''").select("record_uid", "address", "address_detail", "municipality_code")
    found = address.parsed(listings, "museum_id", ["address_raw", "address_normalized"], None, "municipality_code", "postal_code", towns)
    return address.places(found.union(address.parsed(records, "record_uid", ["address"], "address_detail", "municipality_code", None, towns)))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of listings and records with the same postal address."""
    return address.pairs_within(cut(p4_places(spark, folder)), ["place"], "key").select("key_a", "key_b").distinct()


def p6_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Listings and elements that are the same facility, with the score and the calibrated confidence of each match."""
    towns = address.gazetteer_rows(table(spark, folder, "town_master"))
    m = {"id": "museum_id", "name": "facility_name", "city_code": "municipality_code", "city_name": "municipality_name", "address": "address_raw", "address2": "address_normalized", "postal": "postal_code", "lon": "longitude", "lat": "latitude"}
    o = {"id": "osm_id", "name": "osm_name", "city_name": "addr_city", "address": "addr_full", "lon": "lon", "lat": "lat", "use": "amenity"}
    listings = matching.features(table(spark, folder, "museum_location_review"), "m", m, towns)
    elements = matching.features(table(spark, folder, "osm_facilities"), "o", o, towns)
    found = matching.match(listings, elements)
    return found.select(F.col("m_id").alias("museum_id"), F.col("o_id").cast("long").alias("osm_id"), "cosine", "score", "confidence")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of listing and element that are the same facility."""
    return p6_matches(spark, folder).select("museum_id", "osm_id")


def p7_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Values that had to change, with their consistent form."""
    records = uniform.changed_values(table(spark, folder, "records"), "record_uid", ["name", "address"], "records")
    return records.union(uniform.changed_values(table(spark, folder, "museum_location_review"), "museum_id", ["facility_name"], "museum_location_review"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Values that are not in their consistent form."""
    return p7_changes(spark, folder).select("table_name", "row_key", "field").distinct()


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    """Document sizes in tokens, counted once where the texts are read, and written: later stages read the few numbers, not the texts."""
    return cut(one_per_key(tokens.sized(table(spark, folder, "documents"), "doc_id", "text", ["source"]), ["doc_id"]))


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one container of each kind, with the container's fill."""
    return packing.fill_containers(_sized(spark, folder), table(spark, folder, "pack_capacity"), "doc_id")


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """Containers used and space left unused, per kind."""
    return packing.fill_report(p8_packed(spark, folder))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return mixing.balanced_mix(_sized(spark, folder), table(spark, folder, "mix_targets"), "doc_id")


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of each source."""
    sized, targets = _sized(spark, folder), table(spark, folder, "mix_targets")
    return mixing.mix_report(cut(mixing.balanced_mix(sized, targets, "doc_id")), sized, targets)


def p10_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged documents with the restored text and the chain of readings that was undone."""
    return one_per_key(mojibake.restored_documents(table(spark, folder, "documents")), ["doc_id"])


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents damaged by a wrong reading, wholly or in part."""
    return p10_restored(spark, folder).select("doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_unmatched": p1_unmatched,
    "p3_found": p3_found,
    "p3_entities": p3_entities,
    "p4_found": p4_found,
    "p4_places": p4_places,
    "p6_found": p6_found,
    "p6_matches": p6_matches,
    "p7_found": p7_found,
    "p7_changes": p7_changes,
    "p8_packed": p8_packed,
    "p8_report": p8_report,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}
