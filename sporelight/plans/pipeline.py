"""From reads to identified contigs: lazily composed stages; stopping early gives that stage's frame."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import odd_sizes
from ..operators import alignments, contigs, hits, pileup, reads, search
from ..sources import readers
from ..store import written
from .identify import Cutoffs, identify

STAGES = ("prepare_sample", "align_to_virus_reference", "generate_aligned_contigs", "host_subtraction", "de_novo_assembly", "combine_contigs", "remove_redundant_contigs", "identify_virus")
#: How contigs are assembled: several k-mer sizes together, or one, found by a grid of sizes and coverages.
ASSEMBLERS = ("spades", "velvet")
TARGETS = 25  # subjects for each contig in a search
ALTERNATIVES = 10_000  # alignments for each read


@dataclass(frozen=True)
class Config:
    """Options and their defaults; ``hsp_cover`` is accepted and not used."""

    reference: str = "vrl_plant"
    read_lengths: str | None = None
    deduplicate: bool = False
    assembler: str = "spades"
    kmer_span: str = "9-23"
    host_distance: int = 5
    word_size: int = 11
    evalue: float = 1e-5
    translated_evalue: float | None = None
    hsp_cover: float = 0.75
    cutoffs: Cutoffs = field(default_factory=Cutoffs)
    stop_after: str | None = None

    def __post_init__(self):
        if self.stop_after is not None and self.stop_after not in STAGES:
            raise ValueError(f"no stage {self.stop_after}; stages: {', '.join(STAGES)}")
        if self.assembler not in ASSEMBLERS:
            raise ValueError(f"no assembler {self.assembler}; assemblers: {', '.join(ASSEMBLERS)}")


def plan(config: Config, sample: str, data_type: str, n_reads: int, host: bool = True) -> dict:
    """The sample's plan as plain values."""
    stages = [s for s in STAGES if host or s != "host_subtraction"]
    return {**asdict(config), "sample": sample, "data_type": data_type, "reads": n_reads, "stages": stages, "translated_evalue": effective_evalue(config, data_type)}


def effective_evalue(config: Config, data_type: str) -> float:
    if config.translated_evalue is not None:
        return config.translated_evalue
    return 1e-5 if data_type == "mRNA" else 1e-2


def prepare(spark: SparkSession, path: str, config: Config) -> tuple[DataFrame, str]:
    """Reads of wanted lengths, and the sample's data type."""
    raw = readers.read_reads(spark, path)
    kind = reads.data_type(raw)
    if not config.read_lengths:
        return written(raw, "reads"), kind
    ready = written(reads.filter_lengths(raw, config.read_lengths), "reads")
    if ready.isEmpty():
        raise ValueError(f"no reads of length {config.read_lengths} in {path}")
    return ready, kind


def run(spark: SparkSession, reads_path: str, references: DataFrame, annotation: DataFrame, proteins: DataFrame | None = None, id_map: DataFrame | None = None, host: DataFrame | None = None, config: Config | None = None) -> dict:
    """Results by stage name; ``data_type`` and ``library_size`` beside them."""
    config = config or Config()
    out: dict = {}

    def done(stage: str, value) -> bool:
        out[stage] = value
        return config.stop_after == stage

    ready, kind = prepare(spark, reads_path, config)
    out["data_type"], out["library_size"] = kind, ready.count()
    if done("prepare_sample", ready):
        return out
    aligned = written(alignments.cap_alternatives(alignments.align(ready, references, 1), ALTERNATIVES), "alignments")
    best = aligned.withColumn("_m", F.min("nm").over(Window.partitionBy("qname"))).where("nm = _m").drop("_m")
    if done("align_to_virus_reference", best):
        return out
    lengths = references.select(F.col("seq_id").alias("ref_id"), F.length("sequence").alias("length"))
    positions = written(pileup.covered(pileup.structured(best, references), lengths), "positions")
    consensus = pileup.contigs_of(positions)
    if done("generate_aligned_contigs", consensus):
        return out
    rest, mapped = alignments.subtract_host(ready, host, penalty=replace(alignments.HOST_PENALTY, limit=config.host_distance) if kind == "mRNA" else None)
    out["host_reads"] = mapped
    if done("host_subtraction", rest):
        return out
    assembled = assemble(rest, config, kind)
    if done("de_novo_assembly", assembled):
        return out
    both = written(contigs.combine(consensus, assembled), "contigs")
    if done("combine_contigs", both):
        return out
    unique = written(contigs.drop_contained(both), "contigs")
    if done("remove_redundant_contigs", unique):
        return out
    own = written(alignments.cap_alternatives(alignments.align(ready, unique, 1), ALTERNATIVES), "contig-alignments")
    depths = pileup.contig_depths(pileup.depth_by_position(own).withColumnRenamed("rname", "ref_id"), unique, out["library_size"])
    profile = reads.length_histogram(own) if kind == "sRNA" else None

    def hits_of(records: DataFrame, subjects: DataFrame, analysis: str, evalue: float, **more) -> DataFrame:
        rows = search.search(records, subjects, analysis == hits.TRANSLATED, evalue, **more)
        order = F.struct("qseqid", "evalue", (-F.col("bitscore")).alias("score"), "sseqid", "qstart", "qend", "sstart", "send")
        rows = alignments.with_place(rows.withColumn("_order", order), "_order").withColumnRenamed("_place", "ord").drop("_order")
        return hits.limit_targets(hits.annotate(rows, annotation, id_map, analysis), TARGETS)

    nucleotide = hits_of(unique, references, hits.NUCLEOTIDE, config.evalue, word=config.word_size)

    def translated(remaining: DataFrame) -> DataFrame:
        if proteins is None:
            return nucleotide.limit(0)
        return hits_of(remaining, proteins, hits.TRANSLATED, effective_evalue(config, kind))

    done("identify_virus", identify(unique, nucleotide, translated, depths, out["library_size"], config.cutoffs, profile))
    out["depths"] = depths
    return out


def assemble(rows: DataFrame, config: Config, kind: str) -> DataFrame:
    """Contigs by the chosen assembler; duplicates are removed for the grid's input alone."""
    sizes, long = odd_sizes(config.kmer_span), kind == "mRNA"
    if config.assembler == "spades":
        return contigs.assemble_many(rows, sizes, long_reads=long)
    return contigs.assemble_best(reads.drop_duplicates(rows) if config.deduplicate else rows, sizes, long_reads=long)
