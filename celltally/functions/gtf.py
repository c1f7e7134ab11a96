"""GTF attribute and gene-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "-"  # value of an attribute a row does not carry


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# A piece between semicolons that holds exactly two whitespace-separated
# tokens: key and value.
ATTRIBUTE_PIECE = r"(?:^|;)\s*([^;\s]+)\s+([^;\s]+)\s*(?=;|$)"
MAP_TYPE = "map<string,string>"


def parse_attributes(attr) -> Column:
    """GTF attribute text -> map<string,string>.

    Pieces are split on ';'; a piece counts only when it holds exactly two
    whitespace-separated tokens (key, value); double quotes are removed from
    the value; when a key repeats the last piece wins. The fold drops an
    earlier entry before adding a repeated key, so the result does not
    depend on ``spark.sql.mapKeyDedupPolicy``.
    """
    a = _c(attr)
    entries = F.zip_with(
        F.regexp_extract_all(a, F.lit(ATTRIBUTE_PIECE), 1),
        F.regexp_extract_all(a, F.lit(ATTRIBUTE_PIECE), 2),
        lambda k, v: F.struct(k.alias("key"), F.replace(v, F.lit('"'), F.lit("")).alias("value")),
    )
    return F.aggregate(
        entries,
        F.create_map().cast(MAP_TYPE),
        lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, _v: k != e["key"]), F.create_map(e["key"], e["value"])),
    )


def attribute_value(attrs, key: str) -> Column:
    """Value of one attribute key from a parsed map, ``-`` when absent."""
    return F.coalesce(F.try_element_at(_c(attrs), F.lit(key)), F.lit(ABSENT))


def attribute_from_text(attr, key: str) -> Column:
    """Value of one attribute key read straight from the attribute text.

    Same rule as :func:`parse_attributes` (two-token pieces only, quotes
    removed, last piece wins, ``-`` when absent) with one regular expression
    and no lambda, so it stays in generated code.
    """
    pattern = r"(?:^|;)\s*\Q" + key.replace("\\E", "") + r"\E\s+([^;\s]+)\s*(?=;|$)"
    found = F.regexp_extract_all(_c(attr), F.lit(pattern), 1)
    last = F.try_element_at(found, F.lit(-1))
    return F.coalesce(F.replace(last, F.lit('"'), F.lit("")), F.lit(ABSENT))


def biotype_camel(s) -> Column:
    """``protein_coding`` -> ``ProteinCoding``: only values holding ``_`` are
    rewritten (each piece capitalised, rest lower case); others stay."""
    c = _c(s)
    camel = F.replace(F.initcap(F.replace(c, F.lit("_"), F.lit(" "))), F.lit(" "), F.lit(""))
    return F.when(c.contains("_"), camel).otherwise(c)


def clean_name(s) -> Column:
    """Every ``-`` of a gene name becomes ``.`` (an absent name becomes ``.``)."""
    return F.translate(_c(s), "-", ".")


def gene_fullname(gene_id, gene_name, gene_biotype) -> Column:
    return F.concat_ws("_", _c(gene_id), _c(gene_name), _c(gene_biotype))
