"""The barcode index against the written-out dictionary and brute force."""

import random

import pytest

from celltally.operators import barcodes as bc
from celltally.operators import nearest


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def noisy(rnd, barcode, n, letters="ACGTN"):
    out = list(barcode)
    for i in rnd.sample(range(len(out)), min(n, len(out))):
        out[i] = rnd.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("hd", [0, 1, 2])
def test_index_equals_the_dictionary(spark, hd):
    rnd = random.Random(hd)
    entries = [("".join(rnd.choices("ACGT", k=rnd.choice([5, 7]))), str(rnd.randint(1, 9))) for _ in range(40)] + [("", "1"), (None, "2"), ("ACxTN", "3")]
    entries += [entries[0], (entries[1][0], "another cell"), ("GGGGG", "None"), ("GGGGG", None)]
    seen = {noisy(rnd, b, rnd.randint(0, 3), "ACGTNx") for b, _ in entries if b for _ in range(20)} | {"", "ACyTN", "G"}
    whitelist = spark.createDataFrame([(s, *e) for s in ("S1", "S2") for e in entries if s == "S1" or e[1] != "1"], "sample string, cbc string, cell string")
    observed = spark.createDataFrame([(s, x) for s in ("S1", "S2", "S3") for x in [*seen, None] for _ in range(2)], "sample string, cbc string")
    want = bc.barcode_dictionary(whitelist, hd).join(observed.distinct().withColumnRenamed("cbc", "seq"), ["sample", "seq"]).select("sample", "seq", "cell")
    assert len(rows(want)) > 50
    for kept in (None, 1, 2, 3):
        assert rows(nearest.observed_dictionary(observed, whitelist, hd, kept).select("sample", "seq", "cell")) == rows(want)


@pytest.mark.parametrize("length, hd", [(16, 2), (16, 3), (30, 3)])
def test_long_barcodes_equal_brute_force(spark, length, hd):
    """Writing these out would take length ** hd strings for every entry."""
    rnd = random.Random(length + hd)
    entries = [("".join(rnd.choices("ACGT", k=length)), str(i)) for i in range(60)]
    entries += [(noisy(rnd, b, 2, "ACGT"), c + "x") for b, c in entries[:20]]
    seen = sorted({noisy(rnd, b, rnd.randint(0, 5)) for b, _ in entries for _ in range(8)})
    want = []
    for s in seen:
        cells = {c for b, c in entries if sum(x != y for x, y in zip(s, b)) <= hd}
        if len(cells) == 1:
            want.append((s, cells.pop()))
    found = nearest.observed_dictionary(spark.createDataFrame([(s,) for s in seen], "cbc string"), spark.createDataFrame(entries, "cbc string, cell string"), hd)
    assert rows(found) == want and len(want) > 100


def test_keys_grow_with_the_whitelist():
    assert nearest.segments_kept(50, 16, 2) == 1
    assert nearest.segments_kept(700_000, 16, 2) == nearest.MOST_KEPT
    assert nearest.segments_kept(700_000, 4, 3) == 1


def test_empty_whitelist(spark):
    none = spark.createDataFrame([], "cbc string, cell string")
    assert nearest.observed_dictionary(spark.createDataFrame([("ACGT",)], "cbc string"), none, 2).count() == 0
