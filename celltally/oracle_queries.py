"""DuckDB SQL for each registered query (see ``celltally.oracle``)."""

from __future__ import annotations

from celltally.fixtures import N_CELLS
from celltally.oracle import with_views

LEN_CBC, LEN_UMI = 6, 6
K = 4 ** LEN_UMI
LETTERS = ["N", "C", "T", "G", "A"]

OVERLAP_COLS = 'sample, label, chrom, start, "end", qname, strand, gene_fullname'
ROW_COLS = 'sample, chrom, start, "end", qname, strand, gene_fullname'


def _pad(c: str) -> str:
    return f"CASE WHEN length({c}) < 3 THEN lpad({c}, 3, '0') ELSE {c} END"


def _tx(x: str) -> str:
    return (f"round(CASE WHEN {x} >= {K} THEN ln(1 - ({K} - 0.001)/{K}) / ln(1 - 1/{K}) "
            f"WHEN {x} > 0 THEN ln(1 - {x}/{K}) / ln(1 - 1/{K}) ELSE 0.0 END, 6)")


def _dict_sql(hd: int) -> str:
    """Expanded whitelist after ambiguity removal, as a sub-query."""
    if hd == 0:
        variants = """SELECT substr(cbc, 1, p - 1) || 'N' || substr(cbc, p + 1) AS seq, cell
      FROM (SELECT cbc, cell, unnest(range(1, length(cbc) + 1)) AS p FROM fx_whitelist) x"""
    else:
        letters = ", ".join(f"'{c}'" for c in LETTERS)
        variants = f"""SELECT substr(cbc, 1, p - 1) || l || substr(cbc, p + 1) AS seq, cell
      FROM (SELECT cbc, cell, unnest(range(1, length(cbc) + 1)) AS p FROM fx_whitelist) x, (SELECT unnest([{letters}]) AS l) y"""
    return f"""(SELECT seq, min(cell) AS cell FROM (
    SELECT cbc AS seq, cell FROM fx_whitelist UNION ALL {variants}) z
  GROUP BY seq HAVING count(DISTINCT cell) = 1)"""


def _pairs_sql() -> str:
    return """(SELECT r1.sample, r1.rec_no, r1.seq AS r1_seq, r2.name AS r2_name, r2.seq AS r2_seq, r2.plus AS r2_plus,
    r2.qual AS r2_qual, substr(r1.seq, 1, 12) AS bcseq, substr(r1.seq, 1, 6) AS umi, substr(r1.seq, 7, 6) AS cbc
  FROM fx_r1 r1 JOIN fx_r2 r2 USING (sample, rec_no))"""


def _matrix_sql(measure: str) -> str:
    """One conditional sum per cell of the fixture, zero where a gene has none."""
    src = "ox_counts"
    if measure.startswith("transcripts"):
        src = f"(SELECT *, {_tx(measure.replace('transcripts', 'umis'))} AS {measure} FROM ox_counts)"
    where = f"WHERE {measure} > 0" if measure in ("reads_unspliced", "reads_spliced") else ""
    typ, zero = ("DOUBLE", "0.0") if measure.startswith("transcripts") else ("BIGINT", "0")
    cells = [f"{i + 1:03d}" for i in range(N_CELLS)]
    cols = ",\n  ".join(f"CAST(coalesce(sum({measure}) FILTER (WHERE cell = '{c}'), {zero}) AS {typ}) AS \"{c}\"" for c in cells)
    return with_views(f"SELECT sample, gene,\n  {cols}\nFROM {src} t {where} GROUP BY sample, gene", ["ox_counts"])


def _measure_rows() -> str:
    """Entries of all nine matrices; estimates in millionths."""
    out = []
    for part in ("unspliced", "spliced", "total"):
        axis = f" WHERE reads_{part} > 0" if part != "total" else ""
        out += [f"SELECT sample, gene, cell, 'reads_{part}' AS measure, reads_{part} AS v FROM ox_counts{axis}",
                f"SELECT sample, gene, cell, 'umis_{part}' AS measure, umis_{part} AS v FROM ox_counts",
                f"SELECT sample, gene, cell, 'transcripts_{part}' AS measure, CAST(round({_tx(f'umis_{part}')} * 1000000) AS BIGINT) AS v FROM ox_counts"]
    return "\n  UNION ALL ".join(out)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["manifest_scan"] = with_views("SELECT sample, raw_fq_dir, cbc_file FROM fx_manifest", ["fx_manifest"])
    q["whitelist_scan"] = with_views("SELECT cbc, cell FROM fx_whitelist", ["fx_whitelist"])
    q["fastq_pairs"] = with_views(
        """SELECT r1.rec_no, '@' || r1.name AS r1_name, r1.seq AS r1_seq, r1.plus AS r1_plus, r1.qual AS r1_qual,
  '@' || r2.name AS r2_name, r2.seq AS r2_seq, r2.plus AS r2_plus, r2.qual AS r2_qual
FROM fx_r1 r1 JOIN fx_r2 r2 USING (rec_no)""", ["fx_r1", "fx_r2"])
    q["fastq_members"] = q["fastq_pairs"]
    q["gtf_scan"] = with_views(
        """SELECT seqname, source, feature, start_ AS start, end_ AS "end", '.' AS score, strand, '.' AS frame,
  attribute || CASE WHEN start_ % 2 = 1 THEN ' ' ELSE '' END AS attribute
FROM fx_gtf WHERE NOT (feature = 'gene' AND start_ % 3000 = 1)""", ["fx_gtf"])
    q["check_whitelist"] = with_views(
        f"SELECT cbc, cell, CAST(length(cbc) AS BIGINT) AS len FROM fx_whitelist_bad WHERE length(cbc) <> {LEN_CBC}",
        ["fx_whitelist_bad"])
    q["check_pairs"] = with_views(
        """SELECT * FROM (SELECT r1.sample, r1.rec_no, r1.name <> r2.name AS bad_name,
    substr(r1.plus, 1, 1) <> substr(r2.plus, 1, 1) AS bad_plus,
    length(r1.qual) <> length(r1.seq) OR length(r2.qual) <> length(r2.seq) AS bad_length
  FROM fx_r1 r1 JOIN fx_r2_bad r2 USING (sample, rec_no)) t WHERE bad_name OR bad_plus OR bad_length""",
        ["fx_r1", "fx_r2_bad"])
    q["sam_scan"] = with_views("SELECT sample, qname, flag, rname, pos, mapq, cigar FROM fx_aligned", ["fx_aligned"])
    q["contigs_scan"] = with_views(
        "SELECT rname AS contig, row_number() OVER (ORDER BY rname DESC) AS place FROM (SELECT DISTINCT rname FROM fx_aligned) t", ["fx_aligned"])
    q["contig_filter"] = with_views(
        f"SELECT {OVERLAP_COLS} FROM ox_clean WHERE chrom IN (SELECT contig FROM fx_contigs)", ["ox_clean", "fx_contigs"])

    q["barcode_split"] = with_views(
        "SELECT rec_no, substr(seq, 1, 12) AS bcseq, substr(seq, 1, 6) AS umi, substr(seq, 7, 6) AS cbc FROM fx_r1",
        ["fx_r1"])
    q["barcode_strip"] = with_views(
        "SELECT r1.rec_no, substr(r1.seq, 13) AS seq, substr(r1.qual, 13) AS qual FROM fx_r1 r1 JOIN fx_r2 r2 USING (sample, rec_no)",
        ["fx_r1", "fx_r2"])
    q["barcode_expand_hd0"] = with_views(f"SELECT seq, cell FROM {_dict_sql(0)} d", ["fx_whitelist"])
    q["barcode_expand_hd1"] = with_views(f"SELECT seq, cell FROM {_dict_sql(1)} d", ["fx_whitelist"])
    q["barcode_nearest_hd2"] = with_views(
        """SELECT o.cbc, min(w.cell) AS cell
FROM (SELECT DISTINCT substr(seq, 7, 6) AS cbc FROM fx_r1) o JOIN fx_whitelist w
  ON length(o.cbc) = length(w.cbc)
WHERE (CASE WHEN length(o.cbc) = length(w.cbc) THEN hamming(o.cbc, w.cbc) ELSE 99 END) <= 2
GROUP BY o.cbc HAVING count(DISTINCT w.cell) = 1""", ["fx_r1", "fx_whitelist"])
    for hd in (2, 3):
        q[f"barcode_index_hd{hd}"] = with_views(
            f"""SELECT o.cbc, min(w.cell) AS cell
FROM (SELECT DISTINCT substr(seq, 7, 6) AS cbc FROM fx_r1) o JOIN fx_whitelist w ON length(o.cbc) = length(w.cbc)
WHERE (CASE WHEN length(o.cbc) = length(w.cbc) THEN hamming(o.cbc, w.cbc) ELSE 99 END) <= {hd}
GROUP BY o.cbc HAVING count(DISTINCT w.cell) = 1""", ["fx_r1", "fx_whitelist"])
    # the cell's six bases come first in the barcode of a read that is called UMI first elsewhere
    q["barcode_read_r2"] = with_views(
        f"""SELECT r1.sample, r1.rec_no, r2.name || ':' || substr(r1.seq, 1, 12) || ':' || substr(r1.seq, 7, 6) || ':' || substr(r1.seq, 1, 6)
    || ':' || {_pad('d.cell')} AS name, r2.seq AS seq, r2.plus AS plus, r2.qual AS qual
FROM fx_r1 r1 JOIN fx_r2 r2 USING (sample, rec_no) JOIN {_dict_sql(1)} d ON d.seq = substr(r1.seq, 1, 6)""", ["fx_r1", "fx_r2", "fx_whitelist"])
    q["barcode_assign"] = with_views(
        f"SELECT p.sample, p.rec_no, p.cbc, d.cell FROM {_pairs_sql()} p JOIN {_dict_sql(0)} d ON d.seq = p.cbc",
        ["fx_r1", "fx_r2", "fx_whitelist"])
    q["barcoded_reads"] = with_views(
        f"""SELECT p.sample, p.rec_no, p.r2_name || ':' || p.bcseq || ':' || p.umi || ':' || p.cbc || ':' || {_pad('d.cell')} AS name,
  p.r2_seq AS seq, substr(p.r2_plus, 1, 1) AS plus, p.r2_qual AS qual
FROM {_pairs_sql()} p JOIN {_dict_sql(0)} d ON d.seq = p.cbc""", ["fx_r1", "fx_r2", "fx_whitelist"])
    read_stats = f"""SELECT p.sample, count(*) AS n_reads, count(d.cell) AS n_matched,
  CAST(count(d.cell) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS frac
FROM {_pairs_sql()} p LEFT JOIN {_dict_sql(0)} d ON d.seq = p.cbc GROUP BY p.sample"""
    q["read_stats"] = with_views(read_stats, ["fx_r1", "fx_r2", "fx_whitelist"], mode="two")

    q["gtf_attributes"] = with_views(
        """SELECT seqname, feature, start_ AS start, end_ AS "end", strand, regexp_extract(attribute, 'gene_id "([^"]*)"', 1) AS gene_id,
  coalesce(nullif(regexp_extract(attribute, 'gene_name "([^"]*)"', 1), ''), '-') AS gene_name,
  regexp_extract(attribute, 'gene_biotype "([^"]*)"', 1) AS gene_biotype,
  regexp_extract_all(attribute, 'tag "([^"]*)"', 1)[-1] AS tag FROM fx_gtf""", ["fx_gtf"])
    q["gtf_wide"] = with_views(
        """SELECT seqname, source, feature, start_ AS start, end_ AS "end", '.' AS score, strand, '.' AS frame,
  regexp_extract(attribute, 'gene_id "([^"]*)"', 1) AS gene_id,
  coalesce(nullif(regexp_extract(attribute, 'gene_name "([^"]*)"', 1), ''), '-') AS gene_name,
  regexp_extract(attribute, 'gene_biotype "([^"]*)"', 1) AS gene_biotype,
  regexp_extract_all(attribute, 'tag "([^"]*)"', 1)[-1] AS tag FROM fx_gtf""", ["fx_gtf"])
    q["gtf_keys"] = with_views(
        r"""SELECT DISTINCT t[1] AS key FROM (
  SELECT regexp_split_to_array(trim(p), '\s+') AS t FROM (SELECT unnest(string_split(attribute, ';')) AS p FROM fx_gtf) a) b
WHERE len(t) = 2 AND t[1] <> ''""", ["fx_gtf"])
    q["gene_table"] = with_views(
        'SELECT seqname, start_ AS start, end_ AS "end", strand, gene_fullname FROM ox_named WHERE feature = \'gene\'',
        ["ox_named"])
    q["exon_table"] = with_views('SELECT chr, start, "end", strand, gene_fullname FROM ox_exons', ["ox_exons"])
    q["intron_table"] = with_views('SELECT chr, start, "end", strand, gene_fullname FROM ox_introns', ["ox_introns"])
    pool = []
    for kind, src in (("exon", "ox_islands"), ("intron", "ox_gaps")):
        pool.append(f"""SELECT '{kind}' AS kind, g.chr AS chr, CAST(i.s AS BIGINT) AS start, CAST(i.e AS BIGINT) AS "end", g.strand AS strand,
  string_agg(g.gene_fullname, '-' ORDER BY g.gene_fullname) AS gene_fullname, count(*) AS n_genes
FROM {src} i JOIN ox_genes g USING (gene_id) WHERE i.s < i.e GROUP BY g.chr, i.s, i.e, g.strand""")
    q["feature_pool"] = with_views("\nUNION ALL\n".join(pool), ["ox_islands", "ox_gaps", "ox_genes"])

    q["align_blocks"] = with_views('SELECT sample, chrom, start, "end", qname, mapq, strand FROM ox_blocks', ["ox_blocks"])
    q["overlap_exon"] = with_views(f"SELECT {ROW_COLS} FROM ox_overlaps WHERE label = 'exon'", ["ox_overlaps"])
    q["overlap_sweep"] = with_views(f"SELECT {OVERLAP_COLS} FROM ox_overlaps", ["ox_overlaps"])
    q["overlap_intron"] = with_views(f"SELECT {ROW_COLS} FROM ox_overlaps WHERE label = 'intron'", ["ox_overlaps"])
    q["exon_only"] = with_views(f"SELECT {ROW_COLS} FROM ox_clean WHERE label = 'exon'", ["ox_clean"], mode="two")
    q["intron_only"] = with_views(f"SELECT {ROW_COLS} FROM ox_clean WHERE label = 'intron'", ["ox_clean"], mode="two")
    q["label_union"] = with_views(f"SELECT {OVERLAP_COLS} FROM ox_clean", ["ox_clean"])

    q["name_parse"] = with_views(
        "SELECT qname, string_split(qname, ':')[-3] AS umi, string_split(qname, ':')[-1] AS cell FROM fx_aligned",
        ["fx_aligned"])
    q["name_parse_tags"] = with_views(
        f"""SELECT h, {_pad('c')} AS cell, u AS umi FROM (
  SELECT h, regexp_extract(h, 'CBI:([^;]*)', 1) AS c, regexp_extract(h, 'UMI:([^;]*)', 1) AS u FROM fx_tag_names) t""",
        ["fx_tag_names"])
    q["molecules"] = with_views("SELECT sample, cell, gene, umi, n_intron, n_exon FROM ox_molecules", ["ox_molecules"])
    q["counts_reads"] = with_views(
        "SELECT sample, cell, gene, reads_unspliced, reads_spliced, reads_total FROM ox_counts", ["ox_counts"])
    q["counts_umis"] = with_views(
        "SELECT sample, cell, gene, umis_unspliced, umis_spliced, umis_total FROM ox_counts", ["ox_counts"])
    q["counts_bucketed"] = q["counts_umis"]
    q["counts_transcripts"] = with_views(
        f"""SELECT sample, cell, gene, {_tx('umis_unspliced')} AS transcripts_unspliced,
  {_tx('umis_spliced')} AS transcripts_spliced, {_tx('umis_total')} AS transcripts_total FROM ox_counts""",
        ["ox_counts"])
    q["gene_rowcounts"] = with_views(
        "SELECT sample, label, gene_fullname AS gene, count(*) AS n FROM ox_clean GROUP BY sample, label, gene_fullname",
        ["ox_clean"])
    summary = """SELECT sample, count(*) FILTER (WHERE label = 'intron') AS intron_reads,
  count(*) FILTER (WHERE label = 'exon') AS exon_reads, count(*) AS total_reads FROM ox_clean GROUP BY sample"""
    q["overlap_summary"] = with_views(summary, ["ox_clean"], mode="two")
    q["qc_summary"] = with_views(
        f"""SELECT coalesce(s.sample, o.sample) AS sample, s.n_reads, s.n_matched, s.frac, o.intron_reads, o.exon_reads, o.total_reads
FROM ({read_stats}) s FULL OUTER JOIN ({summary}) o ON s.sample = o.sample""",
        ["fx_r1", "fx_r2", "fx_whitelist", "ox_clean"], mode="two")

    q["sink_features"] = with_views(
        """SELECT chr, start, "end", strand, gene_fullname,
  row_number() OVER (PARTITION BY chr ORDER BY start, "end", strand) AS place FROM ox_exons""", ["ox_exons"])
    q["sink_overlaps"] = with_views(f"SELECT {OVERLAP_COLS} FROM ox_clean", ["ox_clean"], mode="two")
    q["sink_gene_counts"] = with_views(
        """SELECT label, sample, gene_fullname AS gene, count(*) AS n,
  row_number() OVER (PARTITION BY label ORDER BY sample, count(*) DESC, gene_fullname) AS place
FROM ox_clean GROUP BY label, sample, gene_fullname""", ["ox_clean"], mode="two")
    q["sink_fastq"] = with_views(
        f"""SELECT p.sample, p.r2_name || ':' || p.bcseq || ':' || p.umi || ':' || p.cbc || ':' || {_pad('d.cell')} AS name,
  p.r2_seq AS seq, substr(p.r2_plus, 1, 1) AS plus, p.r2_qual AS qual
FROM {_pairs_sql()} p JOIN {_dict_sql(0)} d ON d.seq = p.cbc""", ["fx_r1", "fx_r2", "fx_whitelist"], mode="two")
    q["sink_genes"] = f"SELECT *, true AS in_order FROM ({q['gene_table']}) t"
    q["sink_alignments"] = with_views('SELECT sample, chrom, start, "end", qname, mapq, strand, true AS in_order FROM ox_blocks', ["ox_blocks"])
    q["sink_matrices"] = with_views(
        """SELECT sample, measure, line, row_number() OVER (PARTITION BY sample, measure ORDER BY gene NULLS FIRST) AS place FROM (
  SELECT sample, measure, NULL AS gene, 'gene' || chr(9) || string_agg(DISTINCT cell, chr(9) ORDER BY cell) AS line FROM m GROUP BY sample, measure
  UNION ALL
  SELECT g.sample, g.measure, g.gene, g.gene || chr(9) || string_agg(CAST(coalesce(m.v, 0) AS VARCHAR), chr(9) ORDER BY c.cell) AS line
  FROM (SELECT DISTINCT sample, measure, gene FROM m) g JOIN (SELECT DISTINCT sample, measure, cell FROM m) c USING (sample, measure)
  LEFT JOIN m USING (sample, measure, gene, cell) GROUP BY g.sample, g.measure, g.gene) t""", ["ox_counts"]).replace(
        "\nSELECT sample, measure, line, row", """,
m AS (""" + _measure_rows() + """)
SELECT sample, measure, line, row""", 1)

    for fam in ("reads", "umis", "transcripts"):
        for part in ("unspliced", "spliced", "total"):
            m = f"{fam}_{part}"
            q[f"matrix_{m}"] = _matrix_sql(m)
    return q
