"""Reading one FASTQ file by many tasks."""

import gzip
import os
import random

import pytest

from celltally.sources import fastq as fq
from celltally.sources import members


def text(n, side, rnd, end="\n"):
    out = []
    for i in range(n):
        seq = "".join(rnd.choices("ACGT", k=rnd.randint(0, 60)))
        out += [f"@r{i} {side}:N:0", seq, f"+{i}" if i % 3 else "+", "I" * len(seq)]
    return end.join(out) + end


def cut(data, n, rnd):
    """``data`` in ``n`` pieces at any byte, some of them empty."""
    at = sorted([0, len(data), *(rnd.randint(0, len(data)) for _ in range(n - 1))])
    return [data[a:b] for a, b in zip(at, at[1:])]


def gz_members(path, data, n, rnd, padding=b""):
    with open(path, "wb") as f:
        for piece in cut(data, n, rnd):
            f.write(gzip.compress(piece))
        f.write(padding)
    return path


def expected(r1, r2):
    def records(t):
        lines = [line.split()[0] if line.split() else "" for line in t.split("\n")]
        return [(a, b, c[:1], d) for a, b, c, d in zip(*[iter(lines)] * 4)]

    return [(i, *a, *b) for i, (a, b) in enumerate(zip(records(r1), records(r2)))]


def got(df):
    return sorted(tuple(r) for r in df.select("rec_no", *[c for c in df.columns if c.startswith(("r1_", "r2_"))]).collect())


def pair(p1, p2, **kw):
    return [{"sample": "S", "r1": p1, "r2": p2, **kw}]


@pytest.mark.parametrize("n1, n2, split_bytes", [(20, 20, 1), (20, 3, 1), (7, 20, 400), (1, 20, 1), (20, 1, 1), (40, 40, 2_000)])
def test_pairs_of_many_members(spark, tmp_path, n1, n2, split_bytes):
    rnd = random.Random(n1 * 100 + n2)
    r1, r2 = text(300, 1, rnd), text(300, 2, rnd)
    p1 = gz_members(str(tmp_path / "a_R1.fq.gz"), r1.encode(), n1, rnd)
    p2 = gz_members(str(tmp_path / "a_R2.fq.gz"), r2.encode(), n2, rnd, b"\0" * 700)
    df = fq.read_fastq_pairs(spark, pair(p1, p2), split_bytes=split_bytes)
    assert got(df) == expected(r1, r2)
    if n1 == 20 == n2:  # the same from an index that many tasks made
        sizes = members.file_sizes(spark, [p1, p2])
        whole = [r.collect() for r in (members.index(spark, sizes, 1 << 20)[0].orderBy("path", "start"), members.index(spark, sizes, 1_500)[0].orderBy("path", "start"))]
        assert whole[0] == whole[1] and len(whole[0]) == 40
    if min(n1, n2) == 1:  # one member: one task
        assert df.rdd.getNumPartitions() == 1
    elif split_bytes == 1:
        assert df.rdd.getNumPartitions() > 10 or n2 < 10


def test_twenty_members_are_twenty_tasks(spark, tmp_path):
    rnd = random.Random(1)
    r1, r2 = text(400, 1, rnd), text(400, 2, rnd)
    lines = r1.split("\n")
    with open(tmp_path / "R1.fq.gz", "wb") as f:
        for i in range(0, 1600, 80):
            f.write(gzip.compress(("\n".join(lines[i:i + 80]) + "\n").encode()))
    p2 = gz_members(str(tmp_path / "R2.fq.gz"), r2.encode(), 20, rnd)
    df = fq.read_fastq_pairs(spark, pair(str(tmp_path / "R1.fq.gz"), p2), split_bytes=1)
    assert df.rdd.getNumPartitions() == 20 and {len(p) for p in df.rdd.glom().collect()} == {20}
    assert got(df) == expected(r1, r2)


@pytest.mark.parametrize("tail", [False, True])
@pytest.mark.parametrize("more", [1, 2])
def test_unequal_files(spark, tmp_path, more, tail):
    rnd = random.Random(more)
    r1, r2 = text(200 if more == 1 else 150, 1, rnd), text(200 if more == 2 else 150, 2, rnd)
    p1 = gz_members(str(tmp_path / "R1.fq.gz"), (r1 + "@half\nAC").encode(), 12, rnd)  # an unfinished record is none
    p2 = gz_members(str(tmp_path / "R2.fq.gz"), r2.encode()[:-1], 9, rnd)  # no newline at the end
    rows = got(fq.read_fastq_pairs(spark, pair(p1, p2), tail=tail, split_bytes=1))
    want = expected(r1, r2)
    assert rows[:150] == want and len(rows) == (200 if tail else 150)
    assert all((r[1] is None) == (more == 2) and (r[5] is None) == (more == 1) for r in rows[150:])
    with pytest.raises(Exception, match="differ in length"):
        fq.read_fastq_pairs(spark, pair(p1, p2, last=False), split_bytes=1).collect()
    with pytest.raises(Exception, match="differ in length"):
        fq.read_fastq_pairs(spark, pair(p1, p2, last=False)).collect()


def test_plain_text_and_single_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fq, "SEARCH_BYTES", 1_000)
    rnd = random.Random(4)
    r1, r2 = text(200, 1, rnd, "\r\n"), text(200, 2, rnd)
    for name, t in (("R1.fq", r1), ("R2.fq", r2)):
        (tmp_path / name).write_bytes(t.encode())
    df = fq.read_fastq_pairs(spark, pair(str(tmp_path / "R1.fq"), str(tmp_path / "R2.fq"), base=1000, chunk="c"), split_bytes=3_000)
    assert df.rdd.getNumPartitions() > 3
    assert got(df) == [(r[0] + 1000, *r[1:]) for r in expected(r1, r2)]
    single = fq.read_fastq(spark, [str(tmp_path / "R2.fq"), gz_members(str(tmp_path / "x.gz"), r2.encode(), 5, rnd)], "S", split_bytes=500)
    assert single.count() == 400 and single.groupBy("rec_no").count().where("count <> 2").isEmpty()


def test_headers_inside_a_member_and_broken_files(spark, tmp_path):
    """Bytes that look like a member, and bytes that do not belong to one."""
    rnd = random.Random(6)
    inner = gzip.compress(text(3, 1, rnd).encode())
    stored = gzip.compress(inner + rnd.randbytes(300_000), 0)  # holds a whole member uncompressed
    path = str(tmp_path / "x.gz")
    with open(path, "wb") as f:
        f.write(stored + gzip.compress(b"@a\nAC\n+\nII\n"))
    size = os.path.getsize(path)
    found, whole = members.index(spark, {path: size}, 10_000_000)
    assert [(r.start, r.stop) for r in found.orderBy("start").collect()] == [(0, len(stored)), (len(stored), size)] and set(whole) == {path}
    with open(path, "ab") as f:
        f.write(b"no member")
    assert members.index(spark, {path: size + 9}, 10_000_000)[1] == {}


def test_empty_files(spark, tmp_path):
    for name in ("R1.fq.gz", "R2.fq.gz"):
        (tmp_path / name).write_bytes(gzip.compress(b"") * 3)
    assert fq.read_fastq_pairs(spark, pair(str(tmp_path / "R1.fq.gz"), str(tmp_path / "R2.fq.gz")), split_bytes=1).count() == 0
