"""DuckDB oracle SQL for every registered query.

The fixture views of FIXTURES.md are rebuilt here from SQL text (DuckDB
dialect) and each query is written with plain SQL: theta joins instead of
binned joins, NOT EXISTS instead of islands, per-position exon sets instead
of window merges. DuckDB has only the TESTDATA tables, so every query
carries the views it needs as WITH entries.
"""

from __future__ import annotations

from celltally import fixtures as fx


def dig(x: str) -> str:
    return " || ".join(
        f"substr('ACGT', CAST(floor(({x})/{4 ** i}) AS bigint) % 4 + 1, 1)" for i in range(6)
    )


def _sample(mode: str) -> str:
    return "'S1'" if mode == "one" else "'S' || CAST(l_suppkey % 2 AS VARCHAR)"


def _gtf_values() -> str:
    return ", ".join(f"('{f}', {o}, {w})" for f, o, w in fx.GTF_ROWS)


def _views(mode: str) -> dict[str, tuple[list[str], str]]:
    cbc_code = f"(s_suppkey*{fx.CBC_MULT}+{fx.CBC_ADD}) % {fx.CODE_SPACE}"
    v: dict[str, tuple[list[str], str]] = {}
    v["fx_manifest"] = ([], "SELECT 'S' || s_suppkey AS sample, '/data/fq' AS raw_fq_dir, '/data/cbc.txt' AS cbc_file FROM supplier")
    v["fx_whitelist"] = ([], f"SELECT {dig(cbc_code)} AS cbc, CAST(s_suppkey % {fx.N_CELLS} + 1 AS VARCHAR) AS cell FROM supplier")
    v["fx_whitelist_bad"] = (["fx_whitelist"], "SELECT CASE WHEN length(cell) = 1 THEN substr(cbc,1,5) ELSE cbc END AS cbc, cell FROM fx_whitelist")
    v["fx_rawid"] = ([], f"""SELECT *, 'R' || l_orderkey || ':' || l_partkey || ':' || l_suppkey || ':' || rec_no AS name,
  (l_suppkey*{fx.CBC_MULT}+{fx.CBC_ADD}) % {fx.CODE_SPACE} AS cbc_code, (l_orderkey*7+l_linenumber*3) % 64 AS umi_code,
  {_sample(mode)} AS sample FROM (
  SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) - 1 AS bigint) AS rec_no,
    l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem) t""")
    v["fx_r1"] = (["fx_rawid"], f"""SELECT sample, rec_no, name, seq, '+' AS plus, repeat('I', CAST(length(seq) AS int)) AS qual FROM (
  SELECT sample, rec_no, name, umi || CASE WHEN l_linenumber % 4 = 0 THEN 'N' || substr(cbc,2)
    WHEN l_linenumber % 4 = 1 THEN substr(cbc,1,5) || 'T' ELSE cbc END || 'TTTTTTTT' AS seq
  FROM (SELECT sample, rec_no, name, l_linenumber, {dig('cbc_code')} AS cbc, {dig('umi_code')} AS umi FROM fx_rawid) t) u""")
    v["fx_r2"] = (["fx_rawid"], f"""SELECT sample, rec_no, name, seq, '+' AS plus, repeat('I', CAST(length(seq) AS int)) AS qual FROM (
  SELECT sample, rec_no, name, {dig('l_partkey')} || {dig('l_orderkey')} || {dig('l_suppkey')} || 'ACGTAC' AS seq FROM fx_rawid
  WHERE rec_no < (SELECT count(*) FROM lineitem) - {fx.R2_MISSING_TAIL}) t""")
    v["fx_r2_bad"] = (["fx_r2"], """SELECT sample, rec_no, CASE WHEN rec_no % 500 = 0 THEN name || 'x' ELSE name END AS name, seq,
  CASE WHEN rec_no % 700 = 0 THEN '-' ELSE plus END AS plus,
  CASE WHEN rec_no % 333 = 0 THEN substr(qual,2) ELSE qual END AS qual FROM fx_r2""")
    v["fx_gtf"] = ([], f"""SELECT 'chr' || (p_partkey % 5 + 1) AS seqname, 'fx' AS source, feature,
  1000*CAST(floor(p_partkey/10) AS bigint) + 1 + (p_size % 3)*20 + o AS start_,
  1000*CAST(floor(p_partkey/10) AS bigint) + 1 + (p_size % 3)*20 + o + w AS end_,
  CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand,
  'gene_id "G' || p_partkey || CASE WHEN p_partkey % {fx.NO_NAME} = 0 THEN '' ELSE '"; gene_name "' || replace(p_name,' ','-') END || '"; gene_biotype "' ||
  CASE WHEN feature = 'gene' AND o = 5 THEN 'second' WHEN p_size % 5 = 0 THEN 'lncRNA' WHEN p_size % 5 = 1 THEN 'IG_C_gene' ELSE 'protein_coding' END || '"; note "two words"; tag "basic"; tag "CCDS";' AS attribute
FROM part, (VALUES {_gtf_values()}) v(feature,o,w)
WHERE (feature = 'exon' AND (o <= 60 OR p_partkey % {fx.NO_INTRON} <> 0)) OR (feature = 'gene' AND (o = 0 OR p_partkey % {fx.TWO_GENE_ROWS} = 0))""")
    v["fx_gtf_text"] = (["fx_gtf"], """SELECT CASE WHEN feature = 'gene' AND start_ % 3000 = 1 THEN '#' ELSE '' END || seqname || chr(9) || source || chr(9) || feature || chr(9) || start_ || chr(9) || end_ || chr(9) || '.' || chr(9) || strand || chr(9) || '.' || chr(9) || attribute ||
  CASE WHEN start_ % 2 = 1 THEN ' # note' ELSE '' END AS value FROM fx_gtf""")
    cig = "CASE l_linenumber % 4 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(fx.CIGARS)) + " END"
    v["fx_aligned"] = (["fx_rawid"], f"""SELECT sample, 'chr' || (l_partkey % 5 + 1) AS rname,
  1000*CAST(floor(l_partkey/10) AS bigint) + 1 + (l_orderkey*37+l_linenumber*101) % 1000 AS pos,
  CAST(CASE WHEN l_quantity > 5 THEN 255 ELSE 3 END AS INTEGER) AS mapq,
  CAST(CASE WHEN l_suppkey % {fx.N_CELLS} = {fx.EXON_ONLY_CELL} AND ((l_orderkey*37+l_linenumber*101) % 1000 >= 60 OR l_linenumber % 4 <> 0) THEN 4
    WHEN (l_orderkey+l_linenumber) % 2 = 0 THEN 0 ELSE 16 END AS INTEGER) AS flag,
  {cig} AS cigar,
  name || ':' || umi || cbc || ':' || umi || ':' || cbc || ':' || lpad(CAST(l_suppkey % {fx.N_CELLS} + 1 AS VARCHAR),3,'0') AS qname
FROM (SELECT *, {dig('cbc_code')} AS cbc, {dig('umi_code')} AS umi FROM fx_rawid) t, (VALUES (1), (2)) c(copy)
WHERE copy = 1 OR l_orderkey % {fx.REPEAT_ORDERS} = 0""")
    v["fx_contigs"] = (["fx_aligned"], f"SELECT DISTINCT rname AS contig FROM fx_aligned WHERE rname <> '{fx.ABSENT_CONTIG}'")
    v["fx_tag_names"] = ([], f"SELECT CASE WHEN s_suppkey % 2 = 0 THEN '@' ELSE '' END || 'CBI:' || (s_suppkey % 1500) || ';UMI:' || {dig('s_suppkey*29')} AS h FROM supplier")

    # ---- annotation, plain SQL: attributes by pattern, exons as position sets
    v["ox_attr"] = (["fx_gtf"], """SELECT seqname, feature, start_, end_, strand,
  regexp_extract(attribute, 'gene_id "([^"]*)"', 1) AS gene_id,
  coalesce(nullif(replace(regexp_extract(attribute, 'gene_name "([^"]*)"', 1), '-', '.'), ''), '.') AS gene_name,
  regexp_extract(attribute, 'gene_biotype "([^"]*)"', 1) AS biotype_raw,
  regexp_extract_all(attribute, 'tag "([^"]*)"', 1)[-1] AS tag
FROM fx_gtf""")
    v["ox_named"] = (["ox_attr"], """SELECT *, gene_id || '_' || gene_name || '_' || gene_biotype AS gene_fullname FROM (
  SELECT *, CASE WHEN contains(biotype_raw, '_') THEN array_to_string(list_transform(string_split(biotype_raw, '_'), lambda p: upper(p[1:1]) || lower(p[2:])), '')
    ELSE biotype_raw END AS gene_biotype FROM ox_attr) t""")
    v["ox_genes"] = (["ox_named"], "SELECT gene_id, seqname AS chr, strand, gene_fullname FROM ox_named WHERE feature = 'gene' AND end_ - start_ = 880")  # the first row of the id
    v["ox_exon_pos"] = (["ox_named"], "SELECT DISTINCT gene_id, unnest(range(start_, end_)) AS p FROM ox_named WHERE feature = 'exon'")
    v["ox_islands"] = (["ox_exon_pos"], """SELECT gene_id, min(p) AS s, max(p) + 1 AS e FROM (
  SELECT gene_id, p, p - row_number() OVER (PARTITION BY gene_id ORDER BY p) AS grp FROM ox_exon_pos) t GROUP BY gene_id, grp""")
    v["ox_gaps"] = (["ox_islands"], """SELECT gene_id, s, e FROM (
  SELECT gene_id, lag(e) OVER (PARTITION BY gene_id ORDER BY s) + 1 AS s, s - 1 AS e FROM ox_islands) t WHERE s IS NOT NULL""")
    for kind, src in (("exons", "ox_islands"), ("introns", "ox_gaps")):
        v[f"ox_{kind}"] = ([src, "ox_genes"], f"""SELECT g.chr AS chr, CAST(i.s AS BIGINT) AS start, CAST(i.e AS BIGINT) AS "end", g.strand AS strand,
  string_agg(g.gene_fullname, '-' ORDER BY g.gene_fullname) AS gene_fullname
FROM {src} i JOIN ox_genes g USING (gene_id) WHERE i.s < i.e GROUP BY g.chr, i.s, i.e, g.strand""")

    # ---- alignment blocks: the four fixture CIGARs listed by hand
    v["ox_cigar_blocks"] = ([], """SELECT * FROM (VALUES ('50M', 0, 50), ('25M200N25M', 0, 25), ('25M200N25M', 225, 250),
  ('10S30M', 0, 30), ('20M5D20M2I8M', 0, 53)) c(cigar, off_s, off_e)""")
    v["ox_blocks"] = (["fx_aligned", "ox_cigar_blocks"], """SELECT a.sample, a.rname AS chrom, a.pos - 1 + c.off_s AS start, a.pos - 1 + c.off_e AS "end",
  a.qname, a.mapq, CASE WHEN a.flag & 16 <> 0 THEN '-' ELSE '+' END AS strand
FROM fx_aligned a JOIN ox_cigar_blocks c USING (cigar) WHERE a.flag & 4 = 0""")
    v["ox_overlaps"] = (["ox_blocks", "ox_exons", "ox_introns"], """SELECT DISTINCT b.sample, f.label, b.chrom, greatest(b.start, f.start) AS start,
  least(b."end", f."end") AS "end", b.qname, b.strand, f.gene_fullname
FROM ox_blocks b JOIN (SELECT *, 'exon' AS label FROM ox_exons UNION ALL SELECT *, 'intron' AS label FROM ox_introns) f
  ON b.chrom = f.chr AND b.strand = f.strand AND b.start < f."end" AND f.start < b."end"
WHERE b.mapq = 255""")
    v["ox_clean"] = (["ox_overlaps"], """SELECT * FROM ox_overlaps a WHERE NOT EXISTS (
  SELECT 1 FROM ox_overlaps b WHERE b.sample = a.sample AND b.chrom = a.chrom AND b.label <> a.label
    AND a.start < b."end" AND b.start < a."end")""")
    v["ox_tagged"] = (["ox_clean"], """SELECT sample, label, string_split(qname, ':')[-1] AS cell,
  rtrim(gene_fullname) || '__' || chrom AS gene, string_split(qname, ':')[-3] AS umi FROM ox_clean""")
    v["ox_molecules"] = (["ox_tagged"], """SELECT sample, cell, gene, umi, count(*) FILTER (WHERE label = 'intron') AS n_intron,
  count(*) FILTER (WHERE label = 'exon') AS n_exon FROM ox_tagged GROUP BY sample, cell, gene, umi""")
    v["ox_counts"] = (["ox_molecules"], """SELECT sample, cell, gene,
  CAST(sum(n_intron) AS BIGINT) AS reads_unspliced, CAST(sum(n_exon) AS BIGINT) AS reads_spliced,
  CAST(sum(n_intron + n_exon) AS BIGINT) AS reads_total,
  count(*) FILTER (WHERE n_intron > 0) AS umis_unspliced, count(*) FILTER (WHERE n_intron = 0) AS umis_spliced,
  count(*) AS umis_total FROM ox_molecules GROUP BY sample, cell, gene""")
    return v


def with_views(query: str, needs: list[str], mode: str = "one") -> str:
    """Prefix ``query`` with the WITH entries it needs, in dependency order."""
    views = _views(mode)
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in views[name][0]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return query
    ctes = ",\n".join(f"{n} AS (\n{views[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{query}"
