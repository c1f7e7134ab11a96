"""Text files that many tasks can read: an index of gzip members.

gzip does not split, but a file of many members (joined files, block gzip) can
be read from the start of any member. ``index`` finds the members of such
files, every task searching one range of bytes, and counts the lines in each;
plain files are indexed by ranges of bytes. ``Lines`` reads lines in bulk from
such a place on. A member may begin anywhere in a line.
"""

from __future__ import annotations

import gzip
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from celltally.operators.common import land
from celltally.session import file_system

PIECE = 4 << 20
#: First bytes of a gzip member; the flags in the next one use its low five bits.
MAGIC = b"\x1f\x8b\x08"
MEMBERS = "path string, start long, stop long, n_lines long, filled boolean, open boolean"


def pickle_by_value(*modules) -> None:
    """Have ``modules``, this one and those it uses pickled by value."""
    import sys

    from pyspark import cloudpickle

    for module in (*modules, *(sys.modules[m] for m in (__name__, land.__module__, file_system.__module__))):
        cloudpickle.register_pickle_by_value(module)


def open_raw(path: str, start: int = 0):
    """A seekable file, given as path or URI, at byte ``start``."""
    from pyarrow import fs

    if "://" not in path and not re.match("[a-z]+:/", path):
        source, name = fs.LocalFileSystem(), path
    else:
        source, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    raw = source.open_input_file(name)
    raw.seek(start)
    return raw


class Lines:
    """The lines of a file from byte ``start`` on, as Arrow arrays. With
    ``partial`` the first one begins before ``start`` and is left out;
    ``skip`` further lines are too. ``piece`` bytes are read at a time."""

    def __init__(self, path: str, start: int = 0, partial: bool = False, skip: int = 0, piece: int = PIECE):
        self.raw, self.piece = open_raw(path, start), piece
        self.blocks = self._blocks(gzip.GzipFile(fileobj=self.raw) if path.endswith(".gz") else self.raw)
        self.held, self.n_held = [], 0
        for left in ([1] if partial else []) + [skip]:
            while left:
                got = len(self.take(min(left, 1 << 20)))
                left = left - got if got else 0

    def _blocks(self, text):
        """Whole lines in blocks of about a piece."""
        rest = []
        while piece := text.read(self.piece):
            cut = piece.rfind(b"\n") + 1
            if not cut:
                rest.append(piece)
                continue
            yield b"".join([*rest, piece[:cut]])
            rest = [piece[cut:]]
        if last := b"".join(rest):
            yield last

    @staticmethod
    def _split(block: bytes):
        import numpy as np
        import pyarrow as pa

        ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 10) + 1
        if not len(ends) or ends[-1] != len(block):
            ends = np.append(ends, len(block))
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(block)])

    def take(self, n: int):
        """The next ``n`` lines, newlines included; fewer at the end of the file."""
        import pyarrow as pa

        while self.n_held < n and (block := next(self.blocks, None)) is not None:
            lines = self._split(block)
            self.held.append(lines)
            self.n_held += len(lines)
        out, left = [], n
        while self.held and left:
            first = self.held.pop(0)
            out.append(first[:left])
            if len(first) > left:
                self.held.insert(0, first[left:])
            left -= len(out[-1])
        self.n_held -= n - left
        return pa.concat_arrays(out) if out else pa.array([], pa.large_binary())

    def close(self):
        self.raw.close()


def headers(data: bytes):
    """Places in ``data`` where a gzip member may begin."""
    at = data.find(MAGIC)
    while at >= 0:
        if at + 3 >= len(data) or data[at + 3] < 32:
            yield at
        at = data.find(MAGIC, at + 1)


def member_at(path: str, start: int) -> tuple[int, int, bool, bool] | None:
    """(stop, lines, holds text, ends inside a line) of the member at ``start``; None if there is none.

    Its checksum and length are those in its trailer, or zlib refuses it.
    """
    raw, inflate = open_raw(path, start), zlib.decompressobj(31)
    n_read, n_lines, last = 0, 0, b""
    try:
        while not inflate.eof:
            data = raw.read(1 << 20)
            if not data:
                return None
            n_read += len(data)
            while data and not inflate.eof:
                text = inflate.decompress(data, PIECE)
                n_lines += text.count(b"\n")
                last = text[-1:] or last
                data = inflate.unconsumed_tail
    except zlib.error:
        return None
    finally:
        raw.close()
    return start + n_read - len(inflate.unused_data), n_lines, bool(last), last not in (b"", b"\n")


def search(path: str, begin: int, end: int):
    """Pieces of a range of bytes, each with its place; headers over borders are seen once."""
    raw, at = open_raw(path, begin), begin
    while at < end:
        data = raw.read(min(PIECE, end - at) + len(MAGIC))
        yield at, data
        at += PIECE
        raw.seek(at)
    raw.close()


def padded(path: str, start: int, size: int) -> bool:
    """Whether only zero bytes follow, which gzip ignores at the end of a file."""
    return all(not data.strip(b"\0") for _, data in search(path, start, size))


def candidates(path: str, begin: int, end: int):
    for at, data in search(path, begin, end):
        for place in headers(data):
            if at + place < min(at + PIECE, end):
                yield at + place


def _count_headers(batches):
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            n = sum(1 for _ in candidates(row["path"], row["begin"], row["end"]))
            yield pa.RecordBatch.from_pydict({"path": [row["path"]], "n": [n]})


def _find_members(batches):
    import pyarrow as pa

    names = [f.split()[0] for f in MEMBERS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            path, at, end, rows = row["path"], row["begin"], row["end"], []
            if not path.endswith(".gz"):
                n, last = 0, b""
                for place, data in search(path, at, end):
                    data = data[:min(PIECE, end - place)]
                    n, last = n + data.count(b"\n"), data[-1:] or last
                rows.append((path, at, end, n, bool(last), last not in (b"", b"\n")))
            for place in candidates(path, at, end) if path.endswith(".gz") else ():
                # a header that checks out starts the chain; from there each member tells the next
                while at <= place < end and (found := member_at(path, place)):
                    stop, *about = found
                    if stop < row["size"] and padded(path, stop, min(stop + 64, row["size"])) and padded(path, stop, row["size"]):
                        stop = row["size"]
                    rows.append((path, place, stop, *about))
                    at = place = stop
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)


def ranges(spark: SparkSession, sizes: dict[str, int], width: int) -> DataFrame:
    """(path, size, begin, end): the files cut into ranges of ``width`` bytes, one to a task."""
    files = spark.createDataFrame(list(sizes.items()), "path string, size long").where("size > 0")
    cut = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(width).cast("long"))).alias("begin"))
    n = sum(-(-size // width) for size in sizes.values())
    cut = cut.select("*", F.least(F.col("begin") + width, "size").alias("end"), F.row_number().over(Window.orderBy("path", "begin")).alias("i"))
    return cut.repartitionById(max(n, 1), (F.col("i") - 1).cast("int")).drop("i")


def file_sizes(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    out = {}
    for p in paths:
        fs, jpath = file_system(spark, p)
        out[p] = fs.getFileStatus(jpath).getLen()
    return out


def index(spark: SparkSession, sizes: dict[str, int], width: int) -> tuple[DataFrame, dict[str, int]]:
    """Members of the files that split, and their number of lines by path.

    ``sizes``: bytes by path. Members: (path, start, stop, at_line, partial):
    ``at_line`` is the number of the first line that begins at or after
    ``start``, ``partial`` says whether the text there continues a line. A gzip
    file with one header is left out before anything is unpacked, and so is
    one whose members do not follow each other from its first byte to its last.
    """
    gz = {p: n for p, n in sizes.items() if p.endswith(".gz")}
    many = {}
    if gz:
        seen = ranges(spark, gz, width).mapInArrow(_count_headers, "path string, n long")
        many = {r.path: gz[r.path] for r in seen.groupBy("path").agg(F.sum("n").alias("n")).where("n > 1").collect()}  # one row a file
    split = {p: n for p, n in sizes.items() if n > 0 and (p in many or p not in gz)}
    if not split:
        return spark.createDataFrame([], "path string, start long, stop long, at_line long, partial boolean"), {}
    found = land(ranges(spark, split, width).mapInArrow(_find_members, MEMBERS), "members")
    by_file = Window.partitionBy("path").orderBy("start")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    rows = found.select(
        "*", F.lag("stop", 1, 0).over(by_file).alias("expected"), F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("newlines"),
        F.coalesce(F.last(F.when(F.col("filled"), F.col("open")), ignorenulls=True).over(before), F.lit(False)).alias("partial"))
    rows = land(rows.withColumn("at_line", F.col("newlines") + F.col("partial").cast("long")), "member-lines")
    files = rows.groupBy("path").agg(F.bool_and(F.col("start") == F.col("expected")).alias("chained"), F.max("stop").alias("stop"),
                                     F.sum("n_lines").alias("n"), F.max_by(F.when(F.col("filled"), F.col("open")), F.when(F.col("filled"), F.col("start"))).alias("open"))
    whole = {r.path: r.n + int(bool(r.open)) for r in files.collect() if r.chained and r.stop == split[r.path]}  # one row a file
    return rows.where(F.col("path").isin(list(whole))).select("path", "start", "stop", "at_line", "partial"), whole
