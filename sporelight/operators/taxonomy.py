"""Taxonomy: genus ancestors, host names, host divisions, description votes, reference-set preparation."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sequence import canonical_digest, upper_codes
from ..store import written

# Division codes and names.
DIVISIONS = (("G0", "Bacteria"), ("G1", "Invertebrates"), ("G2", "Vertebrates"), ("G3", "Phages"), ("G4", "Plants"), ("G5", "Vertebrates"), ("G6", "Vertebrates"), ("G7", "Synthetic"), ("G8", "Unassigned"), ("G9", "Viruses"), ("G10", "Vertebrates"), ("G11", "EnvironmentalSamples"), ("X1", "Algae"), ("X2", "Archaea"), ("X3", "Fungi"), ("X4", "Protozoa"))
SKIPPED_DIVISIONS = (8, 9)
VERTEBRATE_DIVISIONS = (2, 5, 6)
MIN_LENGTH, MAX_LENGTH = 100, 40_000


def divisions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DIVISIONS), "code string, name string")


def genus_of(nodes: DataFrame, taxa: DataFrame, max_levels: int = 100) -> DataFrame:
    """``tax_id, genus_id``: the nearest proper ancestor of rank genus of each taxon asked for, null if there is none.

    One join by level, over the taxa still open only."""
    tree = nodes.select(F.col("tax_id").alias("at"), "parent", "rank")
    open_ = taxa.select("tax_id").distinct().join(tree.select(F.col("at").alias("tax_id"), F.col("parent").alias("at")), "tax_id")
    found = None
    for _ in range(max_levels):
        step = written(open_.join(tree, "at").select("tax_id", "at", "parent", "rank"), "ancestors")
        hit = step.where("rank = 'genus'").select("tax_id", F.col("at").alias("genus_id"))
        found = hit if found is None else found.unionByName(hit)
        open_ = step.where("rank <> 'genus' AND parent <> at").select("tax_id", F.col("parent").alias("at"))
        if open_.isEmpty():
            break
    return taxa.select("tax_id").distinct().join(found, "tax_id", "left")


def prefixes(text: DataFrame, column: str, key: str) -> DataFrame:
    """``key, prefix, words``: each word prefix of a text, one trailing ; or , stripped."""
    words = F.split(F.trim(F.regexp_replace(F.lower(column), r"\s+", " ")), " ")
    cut = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.struct(i.alias("words"), F.regexp_replace(F.array_join(F.slice(words, 1, i), " "), "[;,]$", "").alias("prefix")))
    return text.where(F.col(column).isNotNull()).select(key, F.explode(cut).alias("p")).select(key, "p.prefix", "p.words")


def match_names(hosts: DataFrame, names: DataFrame, key: str = "id", column: str = "host") -> DataFrame:
    """``key, tax_id``: the taxon of the longest word prefix of the host that is a taxon's name (the last such name wins)."""
    last = names.groupBy("name").agg(F.max_by("tax_id", "ord").alias("tax_id"))
    hit = prefixes(hosts, column, key).join(last.withColumnRenamed("name", "prefix"), "prefix")
    return hit.groupBy(key).agg(F.max_by("tax_id", "words").alias("tax_id"))


def correct_names(hosts: DataFrame, corrections: DataFrame, column: str = "host") -> DataFrame:
    rows = hosts.withColumn("_n", F.lower(F.trim(F.col(column)))).join(corrections.withColumnRenamed("name", "_n"), "_n", "left")
    return rows.withColumn(column, F.coalesce("corrected", "_n")).drop("_n", "corrected")


def classify(records: DataFrame, nodes: DataFrame, names: DataFrame, genus_divisions: DataFrame, previous: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """Divisions and their sources by record.

    ``records``: id, description, and ``sources`` array<struct<tax_id, host>> in
    order.  Divisions of a genus come from the genus table (source ICTV), those of
    a host from its taxon (genbank).  An earlier classification wins over all;
    without any division the description table (manual) counts, else Unassigned."""
    todo = records if previous is None else records.join(previous.select("id"), "id", "left_anti")
    src = written(todo.select("id", F.posexplode_outer("sources").alias("pos", "s")).select("id", "pos", "s.tax_id", "s.host"), "sources")
    virus = src.join(nodes.where("division = 9").select("tax_id"), "tax_id", "left_semi")
    scientific = names.where("name_class = 'scientific name'").groupBy("tax_id").agg(F.min_by("name", "ord").alias("genus"))
    genus = virus.join(genus_of(nodes, virus), "tax_id").join(scientific.withColumnRenamed("tax_id", "genus_id"), "genus_id", "left")
    by_genus = genus.join(genus_divisions, "genus").select("id", F.explode("codes").alias("code"), F.lit("ICTV").alias("source"))
    hosted = virus.where("host IS NOT NULL AND trim(host) <> ''")
    host = match_names(hosted.withColumn("_k", F.struct("id", "pos")), names, "_k").join(nodes.select("tax_id", "division"), "tax_id")
    code = F.when(F.col("division").isin(*VERTEBRATE_DIVISIONS), "G10").otherwise(F.concat(F.lit("G"), F.col("division").cast("string")))
    by_host = host.where(~F.col("division").isin(*SKIPPED_DIVISIONS)).select(F.col("_k.id").alias("id"), code.alias("code"), F.lit("genbank").alias("source")).join(by_genus.select("id", "code"), ["id", "code"], "left_anti")
    labels = F.broadcast(divisions(records.sparkSession))  # sixteen rows
    marked = by_genus.unionByName(by_host).join(labels, "code").groupBy("id").agg(F.array_sort(F.collect_set("code")).alias("codes"), F.array_sort(F.collect_set("source")).alias("source"), F.array_sort(F.collect_set("name")).alias("divisions"))
    last = genus.groupBy("id").agg(F.max_by("genus", "pos").alias("genus"))
    rows = todo.join(marked, "id", "left").join(last, "id", "left")
    if manual is not None:
        rows = rows.join(manual.select(F.col("key").alias("description"), F.col("divisions").alias("_manual")), "description", "left")
    else:
        rows = rows.withColumn("_manual", F.lit(None).cast("array<string>"))
    out = rows.select("id", F.coalesce("genus", F.lit("NA")).alias("genus"), "description", F.coalesce("divisions", "_manual", F.array(F.lit("Unassigned"))).alias("divisions"), F.when(F.col("divisions").isNotNull(), F.col("source")).when(F.col("_manual").isNotNull(), F.array(F.lit("manual"))).otherwise(F.array(F.lit("NA"))).alias("source"))
    if previous is None:
        return out
    return out.unionByName(previous.join(records.select("id"), "id", "left_semi").select("id", "genus", "description", "divisions", F.array(F.lit("manual")).alias("source")))


def division_counts(pairs: DataFrame) -> DataFrame:
    """``genus, division, n, share``: the usual division of each genus (of equals the first by name) and its share."""
    counts = pairs.groupBy("genus", "division").agg(F.count("*").alias("n"))
    by = Window.partitionBy("genus")
    ranked = counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(by), 2)).withColumn("_r", F.row_number().over(by.orderBy(F.desc("n"), "division")))
    return ranked.where("_r = 1").drop("_r")


def best_by_subject(hits12: DataFrame, *more: str) -> DataFrame:
    """Best hit by subject in source order: another replaces it only if identity, match length and score are all greater.

    Only rows above the subject's first one in all three can ever replace it; those are folded
    in order as they stream by, one row held for each subject.  ``more``: further columns to keep."""
    fields = ("query", "identity", "length", "score", *more)
    kinds = {f.name: f.dataType for f in hits12.schema.fields}
    first = hits12.groupBy("subject").agg(F.min_by(F.struct("ord", *fields), "ord").alias("f"))
    above = (F.col("identity") > F.col("f.identity")) & (F.col("length") > F.col("f.length")) & (F.col("score") > F.col("f.score"))
    able = hits12.join(first, "subject").where(above | (F.col("ord") == F.col("f.ord"))).select("subject", "ord", *fields)
    # by a hash of the subject: a repartitioning by the join's own key would be left out of the plan, and the join's skew handling may part a subject
    rows = able.repartition(F.xxhash64("subject")).sortWithinPartitions("subject", "ord").select("subject", *fields)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, schema = None, None
        for batch in batches:
            schema, done = batch.schema, []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if best is None or row[0] != best[0]:
                    if best is not None:
                        done.append(best)
                    best = row
                elif all(row[i] > best[i] for i in (2, 3, 4)):
                    best = row
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], f.type) for i, f in enumerate(schema)], schema=schema)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(best, schema, strict=True)], schema=schema)

    return rows.mapInArrow(fold, T.StructType([T.StructField(c, kinds[c]) for c in ("subject", *fields)]))


def description_votes(unclassified: DataFrame, classified: DataFrame) -> DataFrame:
    """``id, category, share, examples``: majority category of the classified rows that share the longest word prefix of the description.

    A prefix matches whole words at the description's start (literally).  Of equal
    categories the one seen first (least ord) wins; examples are the first five ids."""
    theirs = prefixes(classified.select("ord", "id", "category", "description").withColumn("_k", F.struct("ord", "id", "category")), "description", "_k")
    votes = theirs.groupBy("prefix", "_k.category").agg(F.count("*").alias("n"), F.min("_k.ord").alias("seen"))
    total = Window.partitionBy("prefix")
    top = votes.withColumn("share", F.col("n") / F.sum("n").over(total)).withColumn("_r", F.row_number().over(total.orderBy(F.desc("n"), "seen"))).where("_r = 1")
    place = F.row_number().over(Window.partitionBy("prefix").orderBy("_k.ord"))
    few = theirs.withColumn("_r", place).where("_r <= 5").groupBy("prefix").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k.ord", "_k.id"))), lambda x: x["id"]).alias("examples"))
    mine = prefixes(unclassified, "description", "id").join(top.join(few, "prefix"), "prefix")
    return mine.groupBy("id").agg(F.max_by(F.struct("category", "share", "examples", "prefix", "n"), "words").alias("x")).select("id", "x.*")


def top_hits(hits12: DataFrame, n: int = 5) -> DataFrame:
    """Hits with a query's n best subjects (by their best score, then least ord), in source order."""
    best = hits12.groupBy("query", "subject").agg(F.max("score").alias("_s"), F.min("ord").alias("_o"))
    few = best.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("_s"), "_o"))).where(F.col("_r") <= n)
    return hits12.join(few.select("query", "subject"), ["query", "subject"], "left_semi")


def classify_by_classified(records: DataFrame, hits12: DataFrame, n: int = 5) -> DataFrame:
    """What the classified records say about each unclassified one (``category`` Unassigned): by description and by search.

    ``records``: ``ord, id, description, category``; ``hits12``: hits of classified queries in unclassified subjects, ``ord, query,
    subject, identity, length, mismatches, gaps, score`` and the query's ``division``.  Gives ``id, description, prefix, category, n,
    percent, examples`` (first five ids, comma-joined) and ``division, query, match, identity, score`` of the best hit among each
    query's n best subjects; what is missing is null."""
    known, open_ = records.where("category <> 'Unassigned'"), records.where("category = 'Unassigned'")
    votes = description_votes(open_.select("id", "description"), known)
    matched = top_hits(hits12, n).withColumn("length", F.col("length") - F.col("mismatches") - F.col("gaps"))
    best = best_by_subject(matched, "division").select(F.col("subject").alias("id"), "division", "query", F.col("length").alias("match"), "identity", "score")
    named = votes.select("id", "prefix", "category", "n", F.round(F.col("share") * 100, 2).alias("percent"), F.array_join("examples", ",").alias("examples"))
    return open_.select("id", "description").join(named, "id", "left").join(best, "id", "left")


def drop_exact(records: DataFrame, shortest: int = MIN_LENGTH, longest: int = MAX_LENGTH) -> DataFrame:
    """First record of each sequence or its reverse complement, within the length limits.

    Capitals, complements and digests are made where the texts lie (Arrow); only digests cross the network."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                found = [canonical_digest(upper_codes(t)) if t is not None and shortest <= len(t) <= longest else None for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["ord", "k"])

    kind = T.StructType([T.StructField("ord", records.schema["ord"].dataType), T.StructField("k", T.BinaryType())])
    first = records.select("ord", "sequence").mapInArrow(keys, kind).where("k IS NOT NULL").groupBy("k").agg(F.min("ord").alias("ord"))
    return records.join(first.select("ord"), "ord", "left_semi")


def proteins_of(links: DataFrame, proteins: DataFrame, references: DataFrame) -> DataFrame:
    """Proteins of the references through a reference-to-protein table; a linked protein without sequence is an error."""
    wanted = links.join(references.select("reference_id"), "reference_id", "left_semi")
    both = wanted.join(proteins.select("protein_id", "sequence"), "protein_id", "left")
    return both.select("reference_id", "protein_id", F.when(F.col("sequence").isNotNull(), F.col("sequence")).otherwise(F.raise_error(F.concat(F.lit("no sequence of protein "), "protein_id")).cast("string")).alias("sequence"))


def translations(genbank: DataFrame) -> DataFrame:
    """``reference_id, protein_id, sequence`` of coding features with a translation."""
    from ..sources.readers import qualifier

    cds = genbank.select(F.col("version").alias("reference_id"), F.explode("features").alias("f")).where("f.key = 'CDS'")
    return cds.select("reference_id", qualifier(F.col("f"), "protein_id").alias("protein_id"), F.regexp_replace(qualifier(F.col("f"), "translation"), r"\s", "").alias("sequence")).where("sequence <> ''")


def patch(table: DataFrame, additions: DataFrame, key: str) -> tuple[DataFrame, dict[str, int]]:
    """Rows of known keys are skipped, new ones appended; and the counts of present, skipped and added rows."""
    new = additions.dropDuplicates([key]).join(table.select(key), key, "left_anti")
    before, offered, added = table.count(), additions.count(), new.count()
    return table.unionByName(new, allowMissingColumns=True), {"present": before, "skipped": offered - added, "added": added}


def by_division(info: DataFrame, sequences: DataFrame) -> DataFrame:
    """``division, id, sequence``: a row for each division of each record (write with partitionBy('division'))."""
    return info.select("id", F.explode("divisions").alias("division")).join(sequences.select(F.col("seq_id").alias("id"), "sequence"), "id").select("division", "id", "sequence")


def without_sources(genbank: DataFrame, keywords: tuple[str, ...] = ("SARS",)) -> DataFrame:
    """Records whose source names none of the keywords (as they stand, anywhere in it); records without a source stay."""
    named = F.lit(False)
    for word in keywords:
        named = named | F.coalesce(F.col("source").contains(F.lit(word)), F.lit(False))
    return genbank.where(~named)


def refine(classification: DataFrame, sequences: DataFrame, divisions: DataFrame) -> DataFrame:
    """``division, id, sequence`` after a classification was corrected: each record anew in each of its divisions.

    Of sequences with one id the first (least ord) counts; a division that isn't among ``divisions`` (name) is an error, and so is a record without a sequence."""
    first = sequences.groupBy(F.col("seq_id").alias("id")).agg(F.min_by("sequence", "ord").alias("sequence"))
    rows = classification.select("id", F.explode("divisions").alias("division"))
    known = rows.join(divisions.select(F.col("name").alias("division"), F.lit(True).alias("_ok")).distinct(), "division", "left").join(first, "id", "left")
    checked = F.when(F.col("_ok").isNull(), F.raise_error(F.concat(F.lit("no division: "), "division")).cast("string")).when(F.col("sequence").isNull(), F.raise_error(F.concat(F.lit("no sequence of "), "id")).cast("string")).otherwise(F.col("sequence"))
    return known.select("division", "id", checked.alias("sequence"))
