"""Report frames and pages: DataFrame queries down to report size, then plain templates on the driver."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import identity_text, midline, slug, wrapped
from ..sources.writers import Markup, html_document, html_table
from .hits import group_id, identity_stats, interval

LINE_WIDTH = 95
MIN_BLOCK_PERCENT, MIN_TRACK_PIXELS = 0.35, 3


def identity_color(x: Column) -> Column:
    """Colour class of an identity, clamped to 0..100."""
    y = F.least(F.greatest(x, F.lit(0.0)), F.lit(100.0))
    return F.when(y >= 97, "identity-high").when(y >= 90, "identity-good").when(y >= 75, "identity-fair").otherwise("identity-low")


def accession_link(analysis: Column, group: Column, reference: Column) -> Column:
    """Address of a reference's public record."""
    nucleotide = analysis == "blastn"
    return F.concat(F.lit("https://www.ncbi.nlm.nih.gov/"), F.when(nucleotide, "nuccore/").otherwise("protein/"), F.when(nucleotide, reference).otherwise(group))


def accession_label(analysis: Column) -> Column:
    """What the id beside the link is: a reference's for nucleotide searches, a protein's else."""
    return F.when(analysis == "blastn", "Reference ID").otherwise("Protein ID")


def slug_text(text: str) -> str:
    """The anchor text of :func:`slug` for one value."""
    return "".join(c if c.isalnum() else "-" for c in text).strip("-") or "item"


def strand() -> Column:
    return F.when(F.col("hit_end") >= F.col("hit_start"), "+").otherwise("-")


def summary_rows(analysis: str, summary: DataFrame, final_hits: DataFrame) -> DataFrame:
    """Kept groups by contigs, coverage and name, identities from the final hits (the summary's mean where there are none)."""
    rows = summary.where((F.col("analysis") == analysis) & F.col("passes_filters")).join(identity_stats(final_hits.where(F.col("analysis") == analysis)), "group_id", "left")
    mean = F.col("mean_percent_identity")
    rows = rows.withColumns({"identity": F.coalesce("mean_identity", mean), "identity_max": F.coalesce("max_identity", mean), "identity_min": F.coalesce("min_identity", mean), "link": accession_link(F.col("analysis"), F.col("group_id"), F.col("reference_id")), "row_id": F.concat(F.col("analysis"), F.lit("-"), slug(F.col("group_id")))})
    return rows.orderBy(F.desc("contig_count"), F.desc("covered_bases"), "group_id")


def coverage_blocks(hits: DataFrame) -> DataFrame:
    """Left edge and width, in percent of the reference, of each hit."""
    low, high = interval()
    n = F.col("hit_length")
    return hits.withColumn("left_percent", F.when(n > 0, (low - 1) / n * 100).otherwise(0.0)).withColumn("width_percent", F.when(n > 0, F.greatest((high - low + 1) / n * 100, F.lit(MIN_BLOCK_PERCENT))).otherwise(0.0)).withColumn("color", identity_color(F.col("percent_identity")))


def strand_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy(group_id().alias("group_id")).agg(F.count_if(strand() == "+").alias("forward"), F.count_if(strand() == "-").alias("backward"))


def coverage_strip(length: int, blocks: list) -> str:
    """Blocks of :func:`coverage_blocks` on one line, with the number of hits by strand."""
    if length <= 0 or not blocks:
        return "-"
    forward = sum(b.hit_end >= b.hit_start for b in blocks)
    return f"<div class='strip' title='{len(blocks)} contigs; +:{forward} -:{len(blocks) - forward}'>{_bars(blocks)}</div>"


def coverage_map(length: int, blocks: list) -> str:
    """The same blocks below an axis from 1 to the reference's length."""
    if length <= 0 or not blocks:
        return "<p>No coverage map for this reference.</p>"
    return f"<div class='axis'><span>1</span><span>{length}</span></div><div class='strip'>{_bars(blocks)}</div>"


def _bars(blocks: list) -> str:
    return "".join(f"<i class='{'forward' if b.hit_end >= b.hit_start else 'backward'}' style='left:{b.left_percent:.2f}%;width:{b.width_percent:.2f}%'></i>" for b in blocks)


def alignment_index(hits: DataFrame) -> DataFrame:
    """One row for each contig of each group, in order of place: number of alignments, their numbers, reference span, identity range, first anchor."""
    low, high = interval()
    rows = alignment_order(hits).groupBy("group_id", "contig_id").agg(F.count("*").alias("n"), F.min("number").alias("first_number"), F.max("number").alias("last_number"), F.min(low).alias("start"), F.max(high).alias("end"), F.min("percent_identity").alias("identity_min"), F.max("percent_identity").alias("identity_max"), F.min_by("anchor", "number").alias("anchor"))
    place = F.row_number().over(Window.partitionBy("group_id").orderBy("start", "end", "contig_id"))
    return rows.withColumn("row_id", F.concat(F.lit("alignment-index-row-"), place.cast("string")))


def tracks(hits: DataFrame, width: int = 900) -> DataFrame:
    """One track for each contig of each group, by start, end and name: count, strand or ``mixed``, identity range, pixels."""
    low, high = interval()
    rows = hits.withColumn("group_id", group_id()).groupBy("group_id", "hit_length", "contig_id").agg(F.count("*").alias("n"), F.min(low).alias("first"), F.min(high).alias("first_end"), F.max(high).alias("last"), F.when(F.countDistinct(strand()) > 1, "mixed").otherwise(F.min(strand())).alias("strand"), F.min("percent_identity").alias("identity_min"), F.max("percent_identity").alias("identity_max"))
    place = F.row_number().over(Window.partitionBy("group_id").orderBy("first", "first_end", "contig_id"))
    scale = F.when(F.col("hit_length") > 0, F.lit(float(width)) / F.col("hit_length")).otherwise(0.0)
    return rows.withColumn("track", place).withColumn("x", (F.col("first") - 1) * scale).withColumn("pixels", F.greatest((F.col("last") - F.col("first") + 1) * scale, F.lit(float(MIN_TRACK_PIXELS))))


def ticks(length: int) -> list[int]:
    return sorted({1, *(max(1, length * k // 4) for k in (1, 2, 3, 4))})


def alignment_order(hits: DataFrame) -> DataFrame:
    """Hits by reference interval and contig with their anchor and the neighbours' anchors.

    Each group is sorted once, and by numbers alone: a neighbour's anchor is made from its number, so no text is kept in a window."""
    low, high = interval()
    by = Window.partitionBy("group_id").orderBy(low, high, "contig_id", "ord")
    rows = hits.withColumn("group_id", group_id()).withColumns({"number": F.row_number().over(by), "_more": F.lead(F.lit(True)).over(by)})
    rows = rows.withColumn("_name", F.concat_ws("-", F.lit("alignment"), slug(F.col("group_id"))))
    anchor = lambda n: F.concat("_name", F.lit("-"), n.cast("string"))
    number = F.col("number")
    rows = rows.withColumns({"anchor": anchor(number), "previous": F.when(number > 1, anchor(number - 1)), "next": F.when(F.col("_more"), anchor(number + 1))})
    return rows.drop("_more", "_name")


def alignment_segments(hits: DataFrame, width: int = LINE_WIDTH) -> DataFrame:
    """Wrapped alignment lines with running coordinates: query and hit start and end of each segment."""
    both = F.arrays_zip(wrapped(F.col("query_sequence"), width).alias("q"), wrapped(midline(F.col("query_sequence"), F.col("hit_sequence")), width).alias("m"), wrapped(F.col("hit_sequence"), width).alias("h"))
    rows = hits.select("*", F.posexplode(both).alias("segment", "s")).withColumns({"query_text": F.col("s.q"), "middle": F.col("s.m"), "hit_text": F.col("s.h")}).drop("s")
    by = Window.partitionBy("contig_id", "hit_id", "ord").orderBy("segment").rowsBetween(Window.unboundedPreceding, 0)
    for side, start, end in (("query", "query_start", "query_end"), ("hit", "hit_start", "hit_end")):
        used = F.length(F.replace(f"{side}_text", F.lit("-"), F.lit("")))
        sign = F.when(F.col(end) >= F.col(start), 1).otherwise(-1)
        total = F.sum(used).over(by)
        rows = rows.withColumn(f"{side}_from", F.col(start) + sign * (total - used)).withColumn(f"{side}_to", F.col(start) + sign * (total - 1))
    return rows


def alignment_text(hits: DataFrame, width: int = LINE_WIDTH) -> DataFrame:
    """``contig_id, hit_id, ord, text``: labelled, padded alignment lines, three to a segment."""
    rows = alignment_segments(hits, width)
    pad = F.max(F.greatest(*(F.length(F.col(c).cast("string")) for c in ("query_from", "query_to", "hit_from", "hit_to")))).over(Window.partitionBy("contig_id", "hit_id", "ord"))
    rows = rows.withColumn("_pad", pad)
    number = lambda c: F.lpad(F.col(c).cast("string"), F.col("_pad"), F.lit(" "))
    line = lambda name, a, text, b: F.concat(F.lit(name), number(a), F.lit(" "), F.col(text), F.lit("  "), F.col(b).cast("string"))
    block = F.concat_ws("\n", line("Query ", "query_from", "query_text", "query_to"), F.concat(F.repeat(F.lit(" "), F.col("_pad") + 7), F.col("middle")), line("Hit   ", "hit_from", "hit_text", "hit_to"))
    return rows.groupBy("contig_id", "hit_id", "ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", block.alias("b")))), lambda x: x["b"]), "\n\n").alias("text"))


def targets(summary: DataFrame) -> DataFrame:
    """Anchor of each kept group, for links from other pages."""
    return summary.where("passes_filters").select("analysis", "group_id", F.concat(F.col("analysis"), F.lit(".html#"), F.col("analysis"), F.lit("-"), slug(F.col("group_id"))).alias("target"))


def link_best(best: DataFrame, targets_: DataFrame) -> DataFrame:
    return best.withColumn("group_id", group_id()).join(targets_, ["analysis", "group_id"], "left")


# Columns of the reference page, their titles and the groups above them.
_SUMMARY = ["reference", "reference_id", "hit_length", "coverage", "map", "contig_count", "reference_depth", "normalized_depth", "identity", "identity_max", "identity_min", "genus", "description"]
_TITLES = ["Reference", "Reference ID", "Length", "Coverage", "Map", "#Contig", "Depth", "Depth (Norm)", "%Identity", "%Iden Max", "%Iden Min", "Genus", "Description"]
_GROUPS = [("Reference", 2), ("Coverage", 6), ("Identity", 3), ("Annotation", 2)]
_HELP = {"Coverage": "covered bases and their share of the reference", "Map": "places of the group's contigs on the reference", "Depth (Norm)": "depth for a million reads of the sample"}


def reference_page(analysis: str, summary: DataFrame, final_hits: DataFrame, references: str | None = None) -> str:
    """Kept references of one analysis with their coverage strips; ``references`` names the file of their sequences."""
    kept = summary_rows(analysis, summary, final_hits).collect()  # report-sized
    groups = [r.group_id for r in kept]
    own = coverage_blocks(final_hits.where(F.col("analysis") == analysis).withColumn("group_id", group_id())).where(F.col("group_id").isin(groups))
    blocks: dict[str, list] = {}
    for b in own.select("group_id", "hit_start", "hit_end", "left_percent", "width_percent").orderBy("group_id", "left_percent").collect():
        blocks.setdefault(b.group_id, []).append(b)
    rows = []
    for r in kept:
        row = r.asDict()
        row["reference"] = Markup(f"<a href='{html.escape(r.link)}'>{html.escape(r.group_id)}</a>")
        row["coverage"] = f"{r.covered_bases} ({100 * r.reference_coverage:.1f}%)"
        row["map"] = Markup(coverage_strip(r.hit_length, blocks.get(r.group_id, [])))
        for c in ("reference_depth", "normalized_depth", "identity", "identity_max", "identity_min"):
            row[c] = f"{row[c]:.2f}"
        rows.append(row)
    note = f"<p><a href='{html.escape(references)}'>sequences</a></p>" if references else ""
    table = html_table(rows, _SUMMARY, _GROUPS, titles=_TITLES, help_=_HELP, ids=[r.row_id for r in kept]) if rows else "<p>No reference passed.</p>"
    return html_document(f"{analysis} references", note + table)


def detail_page(analysis: str, group: str, hits: DataFrame) -> str:
    """One reference: coverage map, tracks as SVG, index of its contigs, then its alignments."""
    own = hits.where((F.col("analysis") == analysis) & (group_id() == group))
    rows = tracks(own).orderBy("track").collect()
    length = rows[0].hit_length if rows else 1
    bars = "".join(f"<rect x='{r.x:.1f}' y='{14 * r.track}' width='{r.pixels:.1f}' height='10'><title>{html.escape(r.contig_id)} {r.n} {r.strand} {r.identity_min:.2f}-{r.identity_max:.2f}</title></rect>" for r in rows)
    marks = "".join(f"<text x='{900 * t / max(length, 1):.1f}' y='10'>{t}</text>" for t in ticks(length))
    places = coverage_map(length, coverage_blocks(own).orderBy("left_percent").collect())
    listed = alignment_index(own).orderBy("start", "end", "contig_id").collect()
    contents = [{"contig": Markup(f"<a href='#{r.anchor}'><code>{html.escape(r.contig_id)}</code></a>"), "n": r.n, "order": str(r.first_number) if r.n == 1 else f"{r.first_number}-{r.last_number}", "span": f"{r.start}-{r.end}", "identity": f"{r.identity_min:.2f}-{r.identity_max:.2f}%" if r.identity_min != r.identity_max else f"{r.identity_min:.2f}%"} for r in listed]
    index = html_table(contents, ["contig", "n", "order", "span", "identity"], ids=[r.row_id for r in listed])
    found = alignment_order(own).withColumn("identity", identity_text(F.col("query_sequence"), F.col("hit_sequence"))).join(alignment_text(own), ["contig_id", "hit_id", "ord"]).orderBy("number").collect()
    blocks = "".join(f"<h3 id='{r.anchor}'>{html.escape(r.contig_id)} {r.identity}</h3><p>" + (f"<a href='#{r.previous}'>previous</a> " if r.previous else "") + (f"<a href='#{r.next}'>next</a>" if r.next else "") + f"</p><pre>{html.escape(r.text)}</pre>" for r in found)
    return html_document(f"{group}", f"{places}<svg width='920' height='{14 * (len(rows) + 2)}'>{marks}{bars}</svg>{index}{blocks}")


_RECORD = ["contig", "contig_length", "covered_bases", "contig_coverage"]
_DEPTH = ["mean_depth", "normalized_depth"]
_MATCH = ["target", "hit_id", "genus", "description", "percent_identity", "evalue"]


def undetermined_page(rows: DataFrame, matched: bool, targets_: DataFrame | None = None, candidate_ratio: float | None = None) -> str:
    """Unexplained contigs, all of them or (``matched``) those with a raw hit; small-RNA columns only where counted.

    A contig's cell links its row on the page; a best hit whose group was kept links that group's row (``targets_``)."""
    some = rows.where(F.col("hit_id").isNotNull()) if matched else rows
    if targets_ is not None:
        some = link_best(some, targets_)
    some = some.withColumn("row_id", F.concat(F.lit(f"undetermined-{'hit' if matched else 'all'}-row-"), slug(F.col("seq_id"))))
    found = [r.asDict() for r in some.orderBy(F.desc("normalized_depth"), F.desc("contig_length"), "seq_id").collect()]  # report-sized
    small = "candidate" in rows.columns
    for r in found:
        r["contig"] = Markup(f"<a href='#{r['row_id']}'><code>{html.escape(r['seq_id'])}</code></a>")
        for c in ("contig_coverage", "mean_depth", "normalized_depth"):
            r[c] = f"{r[c]:.2f}"
        if r.get("target"):
            r["target"] = Markup(f"<a href='{html.escape(r['target'])}'>{html.escape(r['group_id'])}</a>")
        if small:
            r["sirna_ratio"] = "" if r["sirna_ratio"] is None else f"{100 * r['sirna_ratio']:.2f}"
    profile = [f"n{n}" for n in range(18, 34)] + ["sirna_ratio", "candidate"] if small else []
    columns = [*_RECORD, *profile, *_DEPTH, *([c for c in _MATCH if c != "target" or targets_ is not None] if matched else [])]
    table = html_table(found, columns, ids=[r["row_id"] for r in found], classes=["candidate" if r.get("candidate") else "" for r in found])
    note = f"<p>Candidates: a share of 21 and 22 nt of at least {100 * candidate_ratio:.2f}%.</p>" if small and candidate_ratio is not None else ""
    return html_document("Undetermined contigs", f"<p>{len(found)} contigs</p>{note}{table}")
