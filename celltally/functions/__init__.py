"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from celltally.functions.barcodes import (  # noqa: F401
    compose_name,
    first_token,
    pad_cell,
    parse_name,
    parse_tag_name,
    split_barcode,
    strip_prefix,
)
from celltally.functions.cigar import alignment_blocks, strand_of  # noqa: F401
from celltally.functions.gtf import (  # noqa: F401
    attribute_value,
    biotype_camel,
    clean_name,
    gene_fullname,
    parse_attributes,
)
from celltally.functions.counting import gene_key, umi_to_transcripts  # noqa: F401
