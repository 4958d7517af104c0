"""Writers of genomic text formats. Lines are built as columns; one file is written only for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import gff3_escape
from ..functions.sequence import reverse_complement, wrap

#: Files of classified sequences by class.
FILES = {"chrom_assigned": "chrs", "chrom_unassigned": "chrs", "organelle_complete": "organelles", "organelle_debris": "debris", "rDNA": "rdna", "contaminant": "contaminants", "chrom_debris": "debris", "debris": "debris", "unclassified": "unclassified"}


def shown(c: Column, kind: str, places: int = 4) -> Column:
    """Booleans as yes and no, numbers with fixed places, nulls empty."""
    if kind == "boolean":
        return F.when(c, "yes").when(~c, "no").otherwise("")
    if kind in ("double", "float"):
        return F.when(c.isNotNull(), F.format_string(f"%.{places}f", c)).otherwise("")
    return F.coalesce(c.cast("string"), F.lit(""))


def tsv(df: DataFrame, path: str, order: list[str], places: int = 4, one_file: bool = True) -> None:
    out = df.select(*(shown(F.col(c), k, places).alias(c) for c, k in df.dtypes), *(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)))
    keys = [f"_o{i}" for i in range(len(order))]
    out = out.repartition(1).sortWithinPartitions(*keys) if one_file else out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out.drop(*keys).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def text(df: DataFrame, path: str, order: list[str]) -> None:
    df.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def fasta(df: DataFrame, path: str, width: int = 80) -> None:
    """df: name, seq; files by range of name."""
    text(df.select("name", F.concat(F.lit(">"), "name", F.lit("\n"), wrap(F.col("seq"), width)).alias("line")), path, ["name"])


def fasta_of(df: DataFrame, names: DataFrame, path: str) -> None:
    fasta(df.join(names, "name", "left_semi"), path)


def classified_fasta(df: DataFrame, path: str) -> None:
    """df: name, seq, class, reverse. A folder for each kind of file; reversed contigs are turned."""
    kind = F.lit("unclassified")
    for k, v in FILES.items():
        kind = F.when(F.col("class") == k, v).otherwise(kind)
    seq = F.when(F.col("reverse"), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    out = df.select(kind.alias("category"), "name", F.concat(F.lit(">"), "name", F.lit("\n"), wrap(seq)).alias("line"))
    out.repartitionByRange("category", "name").sortWithinPartitions("category", "name").select("category", "line").write.mode("overwrite").partitionBy("category").text(path)


def subgenome_fasta(df: DataFrame, path: str) -> None:
    out = df.filter("subgenome <> 'NA'").select("subgenome", F.concat(F.lit(">"), "name", F.lit("\n"), wrap(F.col("seq"))).alias("line"))
    out.write.mode("overwrite").partitionBy("subgenome").text(path)


def fastq(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), F.expr("repeat('I', length(seq))")).alias("line"))


def gff3_lines(features: DataFrame) -> DataFrame:
    """features: contig, start (0-based), end, type, strand, id, parent, note. Lines are 1-based and closed."""
    attrs = F.concat_ws(";", F.concat(F.lit("ID="), gff3_escape(F.col("id"))), F.concat(F.lit("Parent="), gff3_escape(F.col("parent"))), F.concat(F.lit("Note="), gff3_escape(F.col("note"))))
    line = F.concat_ws("\t", "contig", F.lit("karyolytics"), "type", (F.col("start") + 1).cast("string"), F.col("end").cast("string"), F.lit("."), F.coalesce("strand", F.lit(".")), F.lit("."), attrs)
    return features.select("contig", "start", F.lit(2).alias("section"), line.alias("line"))


def gff3(features: DataFrame, contigs: DataFrame, path: str) -> None:
    head = contigs.select("contig", F.lit(0).cast("long").alias("start"), F.lit(1).alias("section"), F.format_string("##sequence-region %s 1 %d", "contig", "contig_len").alias("line"))
    first = contigs.sparkSession.createDataFrame([("", 0, 0, "##gff-version 3")], "contig string, start long, section int, line string")
    text(first.unionByName(head).unionByName(gff3_lines(features)), path, ["section", "contig", "start"])


def agp(placed: DataFrame, path: str) -> None:
    """placed: the rows of scaffold.agp."""
    w = F.concat_ws("\t", "object", F.col("beg").cast("string"), F.col("end").cast("string"), F.col("n").cast("string"), "type")
    line = F.when(F.col("type") == "W", F.concat_ws("\t", w, "component", F.lit("1"), F.col("size").cast("string"), F.lit("+"))).otherwise(F.concat_ws("\t", w, F.col("size").cast("string"), F.lit("scaffold"), F.lit("yes"), F.lit("align_genus")))
    text(placed.withColumn("line", line), path, ["object", "n"])
