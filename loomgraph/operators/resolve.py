"""Surface forms to canonical entities: alias links and embedding similarity inside a type, then components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.ids import entity_id
from loomgraph.functions.text import cosine
from loomgraph.session import materialize, release

MIN_SIMILARITY = 0.92


def surfaces(entities: DataFrame) -> DataFrame:
    """(type, name, seen) of names and aliases; ``seen`` is the least ``seq`` of the type."""
    first = entities.filter("type is not null").groupBy("type").agg(F.min("seq").alias("seen"))
    both = entities.select("type", F.trim("name").alias("name")).unionByName(entities.select("type", F.explode(F.transform("aliases", lambda x: F.trim(x))).alias("name")))
    return both.filter("name <> ''").distinct().join(first, "type")


def alias_links(entities: DataFrame, forms: DataFrame) -> DataFrame:
    """(type, a, b): a name and its alias are one in every type that has both, whatever the row's own type."""
    pairs = entities.select(F.trim("name").alias("x"), F.explode(F.transform("aliases", lambda x: F.trim(x))).alias("y")).filter("x <> '' and y <> '' and x <> y").distinct()
    l, r = forms.select("type", F.col("name").alias("x")), forms.select("type", F.col("name").alias("y"))
    return pairs.join(l, "x").join(r, ["type", "y"]).select("type", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def similar_pairs(vectors: DataFrame, least: float = MIN_SIMILARITY) -> DataFrame:
    """(type, a, b, similarity) of unit vectors (type, name, embedding) of one type, exact.

    Names meet by type; both sides are hashed on the type and a number of blocks, so that each
    task compares one block of one side with one of the other.
    """
    blocks = 8
    l = vectors.select("type", F.col("name").alias("a"), F.col("embedding").alias("va")).withColumn("i", F.pmod(F.xxhash64("a"), F.lit(blocks)))
    r = vectors.select("type", F.col("name").alias("b"), F.col("embedding").alias("vb")).withColumn("j", F.pmod(F.xxhash64("b"), F.lit(blocks)))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    pairs = l.withColumn("j", every).join(r.withColumn("i", every), ["type", "i", "j"]).filter("a < b")
    return pairs.withColumn("similarity", cosine("va", "vb")).filter(F.col("similarity") >= least).select("type", "a", "b", "similarity")


def clusters(forms: DataFrame, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(type, name, root): root is the least name of its component inside the type.

    Every round takes the least root of all neighbours and then the root's own root, so chains
    shorten by half; rounds are written to the shared folder.
    """
    e = links.select("type", "a", "b").unionByName(links.select("type", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = materialize(e, "links")
    now = materialize(forms.select("type", "name", F.col("name").alias("root")).distinct(), "roots")
    for _ in range(max_rounds):
        near = e.join(now, (e["type"] == now["type"]) & (e["b"] == now["name"])).select(e["type"], F.col("a").alias("name"), "root")
        low = now.unionByName(near).groupBy("type", "name").agg(F.min("root").alias("root"))
        up = now.select("type", F.col("name").alias("root"), F.col("root").alias("above"))
        new = materialize(low.join(up, ["type", "root"], "left").select("type", "name", F.least("root", F.coalesce("above", "root")).alias("root")), "roots")
        moved = new.join(now.withColumnRenamed("root", "was"), ["type", "name"]).filter("root <> was").limit(1).count()
        release(now)
        now = new
        if not moved:
            return now
    raise RuntimeError("components did not settle")


def elect(members: DataFrame) -> DataFrame:
    """(type, root, canonical_name, canonical_id): the longest name, then the most words, then the last in order."""
    words = F.size(F.filter(F.split("name", r"(?U)\s+"), lambda x: x != ""))
    best = members.groupBy("type", "root").agg(F.max_by("name", F.struct(F.length("name"), words, "name")).alias("canonical_name"))
    return best.withColumn("canonical_id", entity_id("type", "canonical_name"))


def canonical_map(forms: DataFrame, links: DataFrame) -> DataFrame:
    """(surface, canonical_id, canonical_name, type), one row a surface: of types that share one, the type seen last wins."""
    members = clusters(forms, links)
    named = members.join(elect(members), ["type", "root"]).join(forms.select("type", "seen").distinct(), "type")
    value = F.struct("canonical_id", "canonical_name", "type")
    return named.groupBy(F.col("name").alias("surface")).agg(F.max_by(value, F.struct("seen", "type")).alias("v")).select("surface", "v.*")


def summary(cmap: DataFrame) -> DataFrame:
    return cmap.agg(F.count("*").alias("surfaces"), F.count_distinct("canonical_id").alias("entities")).withColumn("merged", F.col("surfaces") - F.col("entities"))


def known_entities(cmap: DataFrame) -> DataFrame:
    """(canonical_id, entity): one row an entity of the map, ``Name (Type)``, the bare name without a type; in the order of ``entity``.

    The first entry by surface that has a name speaks for an id; an id that never has a name gives no row.
    """
    first = F.struct("surface", "canonical_name", F.col("type").isNull(), "type")
    one = cmap.filter("canonical_id is not null and canonical_name is not null").groupBy("canonical_id").agg(F.min_by(F.struct("canonical_name", "type"), first).alias("e"))
    return one.select("canonical_id", F.concat("e.canonical_name", F.coalesce(F.concat(F.lit(" ("), "e.type", F.lit(")")), F.lit(""))).alias("entity")).orderBy("entity", "canonical_id")


def hint(entities: DataFrame) -> DataFrame:
    """One text of the rows of ``known_entities``, an entity a line, for a prompt; all of it in one row, so for as many as a prompt holds."""
    return entities.agg(F.array_join(F.array_sort(F.collect_list("entity")), "\n").alias("hint"))
