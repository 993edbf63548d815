"""Facilities of several registries that are the same place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chains import label_chains

EVIDENCE = ("manager_name", "phone", "name")


def deduplicate(df: DataFrame) -> DataFrame:
    """_id, lat, lng, formatted_address, city and official, the records of each place.

    Rows are one place if they share an id, or an address together with a manager, a phone or a name. Each kind of
    evidence is a key of its own, and rows that share any key, in chains, come together; so the outcome does not depend
    on the order of rows. df: _id, record map, formatted_address, city, lat, lng.
    """
    value = lambda k: F.trim(F.try_element_at("record", F.lit(k)))
    long_enough = lambda c: F.when(F.length(c) > 2, c)
    manager = F.array_join(F.array_sort(F.split(value("manager_name"), r"\s+")), " ")
    places = F.array(long_enough(value("address")), F.nullif("formatted_address", F.lit("")))
    others = F.array(*[F.concat_ws("=", F.lit(k), long_enough(manager if k == "manager_name" else value(k))) for k in EVIDENCE])
    others = F.filter(others, lambda x: ~x.endswith("=") & x.contains("="))
    with_place = F.flatten(F.transform(F.filter(places, lambda p: p.isNotNull()), lambda p: F.transform(others, lambda o: F.concat_ws("|", p, o))))
    ids = F.transform(F.filter(F.array(F.col("_id"), long_enough(value("mol_symbol"))), lambda x: x.isNotNull()), lambda x: F.concat(F.lit("id="), x))
    keys = df.select("_id", F.explode(F.array_distinct(F.concat(ids, with_place))).alias("key"))
    chains = label_chains(keys.where(F.col("_id").isNotNull()).distinct(), "_id", "key")
    place = chains.groupBy("_id").agg(F.min("chain").alias("chain"))
    rows = df.join(place, "_id")
    first = F.min_by(F.struct("_id", "lat", "lng", "formatted_address", "city"), "_id")
    records = F.array_sort(F.collect_list(F.struct(F.col("_id").alias("i"), F.to_json("record").alias("r"))))
    return rows.groupBy("chain").agg(first.alias("f"), F.transform(records, lambda x: F.from_json(x["r"], "map<string,string>")).alias("official")).select("f.*", "official")
