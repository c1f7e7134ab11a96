"""Read-name and barcode expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_token(line) -> Column:
    """First whitespace-separated token of a line (empty line -> null)."""
    parts = F.split(F.regexp_replace(_c(line), r"^\s+|\s+$", ""), r"\s+")
    tok = F.get(parts, 0)
    return F.when(tok == "", F.lit(None).cast("string")).otherwise(tok)


def split_barcode(seq, len_cbc: int, len_umi: int, umi_first: bool) -> tuple[Column, Column, Column]:
    """(bcseq, umi, cbc) from the leading len_umi+len_cbc bases of a read.

    Short reads give short strings, which match no barcode later.
    """
    bcseq = F.substr(_c(seq), F.lit(1), F.lit(len_umi + len_cbc))
    if umi_first:
        umi = F.substr(bcseq, F.lit(1), F.lit(len_umi))
        cbc = F.substr(bcseq, F.lit(len_umi + 1))
    else:
        cbc = F.substr(bcseq, F.lit(1), F.lit(len_cbc))
        umi = F.substr(bcseq, F.lit(len_cbc + 1))
    return bcseq, umi, cbc


def strip_prefix(s, n: int) -> Column:
    """Drop the first n characters."""
    return F.substr(_c(s), F.lit(n + 1))


def pad_cell(cell) -> Column:
    """Zero-fill a cell id to width 3; longer ids are kept whole."""
    c = _c(cell)
    return F.when(F.length(c) < 3, F.lpad(c, 3, "0")).otherwise(c)


def compose_name(name, bcseq, umi, cbc, cell) -> Column:
    """Barcoded read name ``name:bcseq:umi:cbc:cell`` (cell zero-filled)."""
    return F.concat_ws(":", _c(name), _c(bcseq), _c(umi), _c(cbc), pad_cell(cell))


def parse_name(qname) -> tuple[Column, Column]:
    """(umi, cell) from a barcoded name: third field from the end and last
    field. The leading read name may itself hold ':'."""
    parts = F.split(_c(qname), ":")
    return F.try_element_at(parts, F.lit(-3)), F.try_element_at(parts, F.lit(-1))


def parse_tag_name(h) -> tuple[Column, Column]:
    """(cell, umi) from a tag-style name ``[@]CBI:<cell>;UMI:<umi>``; of a
    repeated tag the last counts; the cell is zero-filled to width 3."""
    def last(tag):
        found = F.regexp_extract_all(F.concat(F.lit(";"), F.regexp_replace(_c(h), "^@", "")), F.lit(f";{tag}:([^;:]*)"), F.lit(1))
        return F.try_element_at(found, F.lit(-1))

    return pad_cell(last("CBI")), last("UMI")
