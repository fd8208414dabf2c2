"""Command line: ``run`` samples, manage databases (``db``), look at the machine (``tools``)."""

from __future__ import annotations

import argparse
import json
import shutil
import sys
from pathlib import Path

from .plans import database, outputs, pipeline
from .plans.identify import Cutoffs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sporelight")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="find viral sequences in samples")
    run.add_argument("inputs", nargs="+", help="files of reads")
    run.add_argument("--backend", default="spark", choices=["spark", "python"], help=argparse.SUPPRESS)
    run.add_argument("--db-path", help="database folder")
    run.add_argument("--reference", default="vrl_plant", help="name or path of the references")
    run.add_argument("--host-reference", help="FASTA of the host")
    run.add_argument("-o", "--output", default=".", help="folder of the results")
    run.add_argument("-t", "--threads", type=int, default=8, help="cores of a local session")
    run.add_argument("--assembler", choices=pipeline.ASSEMBLERS, default="spades", help="several k-mer sizes together, or one found by a grid")
    run.add_argument("--rm-dup", "--rm_dup", dest="rm_dup", action="store_true", help="remove duplicate reads before the grid's assembly")
    run.add_argument("--read-length", help="lengths such as 21-23:25:27")
    run.add_argument("--kmer-range", default="9-23", help="span of k-mer sizes")
    run.add_argument("--hisat-dist", type=int, default=5, help="edits allowed against the host")
    run.add_argument("--word-size", type=int, default=11, help="word of the nucleotide search")
    run.add_argument("--exp-value", type=float, default=1e-5, help="expectation of the nucleotide search")
    run.add_argument("--exp-valuex", type=float, help="expectation of the translated search")
    run.add_argument("--percent-identity", type=float, default=25.0, help="identity of the translated search")
    run.add_argument("--hsp-cover", type=float, default=0.75, help="accepted, not used")
    run.add_argument("--coverage-cutoff", type=float, default=0.1)
    run.add_argument("--depth-cutoff", type=float, default=5.0)
    run.add_argument("--norm-depth-cutoff", type=float, default=5.0)
    run.add_argument("--diff-ratio", type=float, default=0.25)
    run.add_argument("--diff-contig-cover", type=float, default=0.5)
    run.add_argument("--diff-contig-length", type=int, default=100)
    run.add_argument("--siRNA-percent", dest="sirna", type=float, default=0.5)
    run.add_argument("--check-only", action="store_true", help="look whether the inputs are there")
    run.add_argument("--prepare-only", action="store_true", help="prepare the samples and write their plans")
    run.add_argument("--stop-after", choices=pipeline.STAGES)
    run.add_argument("--keep-temp", action="store_true", help="keep intermediate tables")
    run.add_argument("--debug", action="store_true", help="keep hit tables, depths and plans; a page for each reference")
    db = commands.add_parser("db", help="databases").add_subparsers(dest="action", required=True)
    path = db.add_parser("path")
    path.add_argument("--target", action="store_true")
    verify = db.add_parser("verify")
    verify.add_argument("--path", dest="folder")
    get = db.add_parser("download")
    get.add_argument("--path", dest="folder")
    get.add_argument("--url", required=True)
    get.add_argument("--sha256")
    get.add_argument("--sha256-url")
    pack = db.add_parser("bundle")
    pack.add_argument("--path", dest="folder")
    pack.add_argument("--output")
    pack.add_argument("--db-version", default="1")
    pack.add_argument("--name", default="sporelight")
    tools = commands.add_parser("tools", help="what the machine offers").add_subparsers(dest="action", required=True)
    check = tools.add_parser("check")
    check.add_argument("--json", action="store_true")
    check.add_argument("--strict", action="store_true")
    tools.add_parser("install-hint")
    return top


def config_of(a: argparse.Namespace) -> pipeline.Config:
    cutoffs = Cutoffs(translated_identity=a.percent_identity, coverage=a.coverage_cutoff, depth=a.depth_cutoff, normalized_depth=a.norm_depth_cutoff, diff_ratio=a.diff_ratio, diff_cover=a.diff_contig_cover, diff_length=a.diff_contig_length, sirna=a.sirna)
    return pipeline.Config(reference=a.reference, read_lengths=a.read_length, deduplicate=a.rm_dup, assembler=a.assembler, kmer_span=a.kmer_range, host_distance=a.hisat_dist, word_size=a.word_size, evalue=a.exp_value, translated_evalue=a.exp_valuex, hsp_cover=a.hsp_cover, cutoffs=cutoffs, stop_after=a.stop_after)


def sample_name(path: str) -> str:
    """File name without its suffixes for compression and format."""
    name = Path(path).name
    for group in ((".gz",), (".fastq", ".fq", ".fasta", ".fa")):
        for suffix in group:
            name = name.removesuffix(suffix)
    return name


def session(threads: int):
    from pyspark.sql import SparkSession

    return SparkSession.builder.master(f"local[{threads}]").appName("sporelight").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def run(a: argparse.Namespace, spark=None) -> int:
    """Each sample's results go to ``result_<sample>`` below the output folder."""
    from .sources import readers, writers

    folder, _ = database.resolve(a.db_path)
    reference = database.reference_path(folder, a.reference)
    missing = [p for p in a.inputs if not Path(p).exists()]
    if missing:
        raise FileNotFoundError(f"no input: {', '.join(missing)}")
    config = config_of(a)
    if a.check_only:
        print(f"database: {folder}\nreference: {reference}\ninputs: {len(a.inputs)}")
        return 0
    spark = spark or session(a.threads)
    text = lambda p: str(p)
    fasta = lambda p: readers.read_fasta(spark, text(p))
    references = fasta(reference)
    protein = Path(f"{reference}_prot")
    proteins = fasta(protein) if protein.exists() else None
    info, ids = (next((folder / n for n in names if (folder / n).exists()), None) for names in ((database.MARKERS[0], database.MARKERS[0].removesuffix(".gz")), (database.MARKERS[1], database.MARKERS[1].removesuffix(".gz"))))
    annotation = readers.read_annotation(spark, text(info)) if info else spark.createDataFrame([], "reference_id string, hit_length int, genus string, description string")
    id_map = readers.read_id_map(spark, text(ids)) if ids else None
    host = fasta(database.reference_path(folder, a.host_reference)) if a.host_reference else None
    for path in a.inputs:
        out = Path(a.output) / f"result_{sample_name(path)}"
        ready, kind = pipeline.prepare(spark, path, config)
        if a.prepare_only or a.debug:
            out.mkdir(parents=True, exist_ok=True)
            writers.write_json(str(out / "analysis_plan.json"), {**pipeline.plan(config, sample_name(path), kind, ready.count(), host is not None), "database": str(folder)})
        if a.prepare_only:
            continue
        result = pipeline.run(spark, path, references, annotation, proteins, id_map, host, config)
        if config.stop_after not in (None, "identify_virus"):
            print(f"{path}: stopped after {config.stop_after}")
            continue
        shutil.rmtree(out / "contig_sequences.fa", ignore_errors=True)
        found = result["identify_virus"]
        names = outputs.write_results(spark, str(out), found, result["remove_redundant_contigs"], result["depths"], references, proteins, config.cutoffs.sirna, details=a.debug, keep=a.debug)
        print(f"{out}: {len(names)} files, " + ", ".join(f"{k} {v}" for k, v in found.counts().items()))
    if not a.keep_temp:
        clear_intermediate(spark)
    return 0


def clear_intermediate(spark) -> None:
    """Delete the intermediate tables that this library has written."""
    from .store import shared_folder

    place = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/sporelight")
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def db(a: argparse.Namespace) -> int:
    if a.action == "path":
        if a.target:
            print(database.install_target())
            return 0
        try:
            print(database.resolve()[0])
        except FileNotFoundError as e:
            print(e)
            return 1
    elif a.action == "verify":
        folder = Path(a.folder) if a.folder else next((p for p in database.candidates() if p.is_dir()), database.install_target())
        wrong = database.problems(folder)
        print(f"{folder}: " + ("; ".join(f"{k}: {', '.join(v)}" for k, v in sorted(wrong.items())) or "complete"))
        return 1 if wrong else 0
    elif a.action == "download":
        print(database.download(a.url, database.install_target(a.folder), a.sha256, a.sha256_url))
    else:
        folder = Path(a.folder) if a.folder else database.resolve()[0]
        archive = a.output or f"{a.name}-{a.db_version}.tar.gz"
        print(archive, database.make_bundle(folder, archive, a.name, a.db_version))
    return 0


def tools(a: argparse.Namespace) -> int:
    """All stages run inside Spark: a Java machine and the Python packages are all there is to find."""
    import importlib.util

    if a.action == "install-hint":
        print("pip install pyspark pandas pyarrow numpy\nand a Java 17 runtime on the path")
        return 0
    found = [{"name": "java", "required": True, "path": shutil.which("java")}]
    found += [{"name": n, "required": True, "path": getattr(importlib.util.find_spec(n), "origin", None)} for n in ("pyspark", "pandas", "pyarrow", "numpy")]
    for t in found:
        t["found"] = t["path"] is not None
    print(json.dumps(found, indent=2) if a.json else "\n".join(f"{t['name']}\t{'OK' if t['found'] else 'MISSING'}\t{t['path'] or '-'}" for t in found))
    return 1 if a.strict and not all(t["found"] for t in found) else 0


def main(argv: list[str] | None = None) -> int:
    given = list(sys.argv[1:] if argv is None else argv)
    a = parser().parse_args(given[1:] if given[:1] == ["--"] else given)
    return {"run": run, "db": db, "tools": tools}[a.command](a)


if __name__ == "__main__":
    raise SystemExit(main())
