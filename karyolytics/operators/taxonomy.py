"""Lineages of taxa from a table of nodes, with a way round by genus for taxa that the table lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kingdoms of eukaryotes by clade; others are Protozoa. Ranks in the order of reports.
CLADES = {
    "Metazoa": "Animalia", "Fungi": "Fungi", "Viridiplantae": "Plantae", "Rhodophyta": "Plantae", "Glaucophyta": "Plantae",
    "Stramenopiles": "Chromista", "Alveolata": "Chromista", "Rhizaria": "Chromista", "Haptista": "Chromista", "Cryptophyceae": "Chromista", "Sar": "Chromista",
    "Amoebozoa": "Protozoa", "Excavata": "Protozoa", "Opisthokonta": "Protozoa",
}
RANKS = ("phylum", "class", "order", "family", "genus", "species")


def kingdom(domain: Column, clade: Column) -> Column:
    """The domain of bacteria, archaea and viruses; of eukaryotes the kingdom of their clade."""
    of = F.create_map(*(F.lit(x) for pair in CLADES.items() for x in pair))
    return F.when(domain.isin("Bacteria", "Archaea", "Viruses"), domain).when((domain == "Eukaryota") & clade.isNotNull(), F.coalesce(F.try_element_at(of, clade), F.lit("Protozoa"))).otherwise(F.coalesce(domain, clade))


def cleaned(name: Column) -> Column:
    """A species' name without the marks of databases: prefixes of ranks, letters that tell genomes of one genus apart."""
    bare = F.regexp_replace(F.trim(name), "^[a-z]__", "")
    return F.nullif(F.trim(F.regexp_replace(bare, "(^[A-Z][a-z]+)_[A-Z]+\\b", "$1")), F.lit(""))


def lineages(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """taxid, kingdom and ranks of wanted taxids. nodes: taxid, parent, rank, name; a root is its own parent or has none.

    Each taxid walks up from parent to parent as a recursive query; walks end at a root, at a parent that the table lacks, and
    where a table has a loop. Taxids without a node are left out.
    """
    spark = nodes.sparkSession
    up = spark.sql(
        """
        WITH RECURSIVE up(taxid, at, parent, rank, name, steps) AS (
            SELECT w.taxid, n.taxid, n.parent, n.rank, n.name, 0 FROM {wanted} w JOIN {nodes} n ON n.taxid = w.taxid
            UNION ALL
            SELECT up.taxid, n.taxid, n.parent, n.rank, n.name, up.steps + 1 FROM up JOIN {nodes} n ON n.taxid = up.parent
            WHERE up.parent <> up.at AND up.steps < 90)
        SELECT * FROM up""",
        wanted=wanted.select("taxid").distinct(),
        nodes=nodes,
    )
    at = lambda rank: F.min_by(F.when(F.col("rank") == rank, F.col("name")), F.when(F.col("rank") == rank, F.col("steps")))
    out = up.groupBy("taxid").agg(at("domain").alias("domain"), at("kingdom").alias("clade"), *(at(r).alias(r) for r in RANKS))
    return out.select("taxid", kingdom(F.col("domain"), F.col("clade")).alias("kingdom"), *RANKS)


def with_fallback(hits: DataFrame, nodes: DataFrame) -> DataFrame:
    """hits (taxid, name and others) with kingdom and ranks, and by which way they were found: taxid, genus or none.

    Taxa that the table lacks, as those of other databases, go by the first word of their cleaned name if it is a genus with
    a node; their species is then the cleaned name.
    """
    first = F.split(cleaned(F.col("name")), " ")[0]
    own = nodes.select("taxid").distinct().withColumn("_own", F.lit(True))
    genera = nodes.filter("rank = 'genus'").groupBy(F.col("name").alias("_genus")).agg(F.min("taxid").alias("_by_genus"))
    df = hits.join(own, "taxid", "left").withColumn("_genus", F.when(F.col("_own").isNull(), first)).join(genera, "_genus", "left")
    df = df.withColumn("_start", F.when(F.col("_own"), F.col("taxid")).otherwise(F.col("_by_genus")))
    found = lineages(nodes, df.select(F.col("_start").alias("taxid")).filter("taxid is not null")).withColumnRenamed("taxid", "_start")
    df = df.join(found.withColumnRenamed("species", "_species"), "_start", "left")
    species = F.when(F.col("_own"), F.col("_species")).otherwise(cleaned(F.col("name")))
    way = F.when(F.col("_own"), "taxid").when(F.col("_start").isNotNull(), "genus").otherwise("none")
    return df.select(*hits.columns, "kingdom", *RANKS[:-1], species.alias("species"), way.alias("found_by"))
