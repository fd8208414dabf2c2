"""Fixed schemas of the records the engine works on (DDL strings; ``ord`` is a record's place in its source)."""

SEQ = "ord long, header string, seq_id string, sequence string"
READS = "ord long, header string, sequence string, plus string, quality string"
SAM = "ord long, qname string, flag string, rname string, pos int, mapq string, cigar string, rnext string, pnext string, tlen string, seq string, qual string, nm int, xa string"
PILEUP = "ord long, ref_id string, pos int, ref_base string, depth int, bases string, quals string"
ANNOTATION = "reference_id string, hit_length int, genus string, description string"
ID_MAP = "protein_id string, reference_id string"
SEARCH = "qseqid string, qlen int, sseqid string, slen int, length int, pident double, evalue double, bitscore double, qstart int, qend int, sstart int, send int, qcovs double, qseq string, sseq string"
HITS = "ord long, analysis string, contig_id string, contig_length int, hit_id string, reference_id string, hit_length int, genus string, description string, alignment_length int, percent_identity double, evalue double, bit_score double, query_start int, query_end int, hit_start int, hit_end int, query_coverage double, query_sequence string, hit_sequence string"
CONTIG_DEPTH = "contig_id string, contig_length int, covered_bases int, total_depth long, mean_depth double, normalized_depth double"
TAX_NODE = "tax_id long, parent long, rank string, division int"
TAX_NAME = "ord long, tax_id long, name string, name_class string"

SUMMARY_COLUMNS = ("analysis", "group_id", "reference_id", "hit_length", "genus", "description", "contig_count", "supporting_contigs", "total_contig_length", "covered_bases", "reference_coverage", "reference_depth", "normalized_depth", "mean_percent_identity", "best_evalue", "max_query_coverage", "passes_coverage_depth", "passes_redundancy", "passes_filters")
HIT_COLUMNS = ("analysis", "contig_id", "contig_length", "hit_id", "reference_id", "hit_length", "genus", "description", "alignment_length", "percent_identity", "evalue", "bit_score", "query_start", "query_end", "hit_start", "hit_end", "query_coverage", "query_sequence", "hit_sequence")
