"""Byte-level BPE over Arrow batches.

A rank file becomes a ``tokenizers`` model: bytes are written as printable
characters, merges are recovered from the ranks, and the split pattern is
applied match by match. Texts are cut where every match must end, each distinct
piece is encoded once per batch (and remembered by the Python worker), and ids
are gathered back. Decoding maps ids to their bytes, so characters split
between tokens come back whole. Every batch is decoded and compared with its
texts; if a piece was mistaken for another, the batch is encoded plainly. So
are texts that contain an added token of a tokenizer file.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltally.llm import textkit as tk
from celltally.llm.common import fresh, named, ship

#: Distinct pieces a Python worker remembers between batches.
MEMORY_PIECES = 3 << 18
SLICE_BYTES = 2 << 20


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is a visible
    Latin-1 character, else the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    at = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [at[b] for b in range(256)]


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair that each token was merged from, by rank: what is left of its
    bytes after all merges of a lower rank."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


class Codec:
    """A tokenizer with the bytes of its ids and its memory of pieces."""

    def __init__(self, tokenizer, table: dict[int, bytes], added: tuple[bytes, ...] = ()):
        """Without a tokenizer, for decoding alone. ``added``: the contents of its added tokens."""
        self.tokenizer, self.added = tokenizer, added
        size = max(table) + 1
        lengths = np.zeros(size, np.int64)
        for i, b in table.items():
            lengths[i] = len(b)
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(table.get(i, b"") for i in range(size)), np.uint8)
        self.keys, self.at, self.n = np.zeros(0, tk.U), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(0, np.int32), np.zeros(0, bool)

    def forget(self):
        """Keeps the pieces that were met again since they were learnt or last kept."""
        keep = self.used if self.used.sum() < MEMORY_PIECES // 2 else np.zeros(len(self.keys), bool)
        self.ids = self.ids[tk.gather(self.at[keep].astype(np.int64), self.n[keep])]
        self.keys, self.n = self.keys[keep], self.n[keep]
        self.at = (np.cumsum(self.n) - self.n).astype(np.int32)
        self.used = np.zeros(len(self.keys), bool)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys in the memory, and whether each is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[tk.gather(self.starts[ids], self.lengths[ids])]

    def learn(self, data, starts, ends, keys, regular):
        """Encodes pieces and remembers them. Regular pieces go in lines of many
        pieces: a line break between two of them is always a token by itself."""
        if any(b"\n" in c for c in self.added):  # lines could make one
            regular = np.zeros(len(keys), bool)
        some = np.flatnonzero(regular)
        ids, at, n = [], np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        done = 0
        for lo in range(0, len(some), 4096):
            own = some[lo:lo + 4096]
            raw = [data[s:e].tobytes() for s, e in zip(starts[own], ends[own], strict=True)]
            got = np.asarray(self.plain([b"\n".join(raw).decode()])[0], np.int32)
            upto = np.cumsum(self.lengths[got])
            stop = np.cumsum(ends[own] - starts[own] + 1) - 1
            last = np.searchsorted(upto, stop) + 1
            begin = np.concatenate([[0], last[:-1] + 1])
            at[own], n[own] = done + begin, last - begin
            ids.append(got)
            done += len(got)
        odd = np.flatnonzero(~regular)
        for i, got in zip(odd, self.plain([data[starts[i]:ends[i]].tobytes().decode() for i in odd]), strict=True):
            at[i], n[i] = done, len(got)
            ids.append(np.asarray(got, np.int32))
            done += len(got)
        at += len(self.ids)
        self.ids = np.concatenate([self.ids, *ids])
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.used = np.concatenate([self.used, np.zeros(len(at), bool)])[order]
        self.keys = keys[order]
        self.at = np.concatenate([self.at, at.astype(np.int32)])[order]
        self.n = np.concatenate([self.n, n.astype(np.int32)])[order]

    def with_added(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Which texts contain an added token's content."""
        raw, out = data.tobytes(), np.zeros(len(offs) - 1, bool)
        for content in self.added:
            at = raw.find(content, offs[0])
            while at >= 0:
                doc = np.searchsorted(offs, at, "right") - 1
                inside = at + len(content) <= offs[doc + 1]
                out[doc] |= inside
                at = raw.find(content, offs[doc + 1] if inside else at + 1)
        return out

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of each text."""
        odd = self.with_added(data, offs)
        if not odd.any():
            return self.encode_pieces(data, offs)
        size = np.diff(offs)
        upto = np.concatenate([[0], np.cumsum(size[~odd])])
        rest, at = self.encode_pieces(data[tk.gather(offs[:-1][~odd], size[~odd])], upto)
        each = self.plain([data[offs[i]:offs[i + 1]].tobytes().decode() for i in np.flatnonzero(odd)])
        n = np.zeros(len(size), np.int64)
        n[~odd], n[odd] = np.diff(at), [len(x) for x in each]
        offsets = np.concatenate([[0], np.cumsum(n)])
        ids = np.zeros(offsets[-1], np.int32)
        ids[tk.gather(offsets[:-1][~odd], n[~odd])] = rest
        ids[tk.gather(offsets[:-1][odd], n[odd])] = np.concatenate([np.asarray(x, np.int32) for x in each])
        return ids, offsets

    def encode_pieces(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        starts, ends, regular = cut(data, offs)
        distinct, example, which = np.unique(tk.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        at, known = self.find(distinct)
        self.used[at[known]] = True
        if not known.all():
            if len(self.keys) + (~known).sum() > MEMORY_PIECES:
                self.forget()
                _, known = self.find(distinct)
            new = example[~known]
            self.learn(data, starts[new], ends[new], distinct[~known], regular[new])
        at, _ = self.find(distinct)
        n = self.n[at][which]
        ids = self.ids[tk.gather(self.at[at].astype(np.int64)[which], n)]
        upto = np.concatenate([[0], np.cumsum(n)])
        offsets = upto[np.searchsorted(starts, offs)]
        if not np.array_equal(self.decode(ids), data):
            each = self.plain([data[a:b].tobytes().decode() for a, b in zip(offs[:-1], offs[1:], strict=True)])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
            ids = np.fromiter((i for x in each for i in x), np.int32, int(offsets[-1]))
        return ids, offsets


#: Last bytes of a character that is surely no white space, by the byte before them; first bytes likewise.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = _VISIBLE & ~_LETTER
_MARK[[*range(48, 58), 39]] = False
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True


def cut(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts texts where no match of the pattern can reach across.

    That is before a single space or line break between two characters that are
    surely not white space, after such a line break, and between an ASCII
    letter and a mark other than an apostrophe. Returns starts, ends,
    and whether the piece both begins (a leading space aside) and ends with
    such a character.
    """
    n = len(data)
    ends_well = _VISIBLE[data]
    ends_well[1:] |= _LEAD[data[:-1]]
    starts_well = _VISIBLE[data] | _LEAD[data]
    gap = np.zeros(n, bool)
    if n > 2:
        gap[1:-1] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & ends_well[:-2] & starts_well[2:]
    edges = offs[(offs > 0) & (offs < n)]
    gap[edges] = False
    gap[edges - 1] = False
    begin = gap.copy()
    begin[1:] |= gap[:-1] & (data[:-1] == 10)
    begin[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    begin[offs[:-1][offs[:-1] < n]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    lead = (data[starts] == 32) & (ends - starts > 1)
    regular = starts_well[np.minimum(starts + lead, n - 1)] & ends_well[ends - 1]
    return starts, ends, regular


_CODECS: dict = {}


def rank_codec(content: bytes, pattern: str) -> Codec:
    """The codec of a rank file; built once per Python worker."""
    key = (hash(content), pattern)
    if key not in _CODECS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks, chars = read_ranks(content), byte_characters()
        spell = lambda token: "".join(chars[b] for b in token)
        model = models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=[(spell(a), spell(b)) for a, b in merges_of(ranks)])
        t = Tokenizer(model)
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"),
                                                   pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        _CODECS[key] = Codec(t, {r: token for token, r in ranks.items()})
    return _CODECS[key]


def rank_table(content: bytes) -> Codec:
    """The ids of a rank file and their bytes, for decoding."""
    key = (hash(content), None)
    if key not in _CODECS:
        _CODECS[key] = Codec(None, {r: token for token, r in read_ranks(content).items()})
    return _CODECS[key]


def file_codec(content: bytes) -> Codec:
    """The codec of a byte-level tokenizer file; its added tokens are told as the library tells them."""
    key = hash(content)
    if key not in _CODECS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(content.decode())
        back = {c: b for b, c in enumerate(byte_characters())}
        added = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
        table = {i: bytes(back[c] for c in token) for token, i in t.get_vocab(with_added_tokens=False).items() if all(c in back for c in token)}
        _CODECS[key] = Codec(t, table | added, tuple(c for c in added.values() if c))
    return _CODECS[key]


def encode(docs: DataFrame, content: bytes, pattern: str, offsets: bool = False) -> DataFrame:
    """``docs`` plus ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit ids).

    With ``offsets`` also ``starts`` (same form): the code point each token
    begins in; tokens of one split character share it. A null or empty text
    has no ids; all columns of ``docs`` stay (a clashing name of ours gets
    underscores in front); an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    names = [fresh(docs, n) for n in ("n_tokens", "ids", "starts")]
    text = named(docs, "text")
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        codec = rank_codec(shared.value, pattern)
        for batch in batches:
            for part in tk.slices(batch, text, SLICE_BYTES):
                data, offs = tk.text_bytes(part.column(text))
                ids, at = codec.encode(data, offs)
                out = [*part.columns, pa.array(np.diff(at)), tk.binary_rows(ids.astype("<u4"), at)]
                if offsets:
                    out.append(tk.binary_rows(starts_of(codec, data, offs, ids, at), at))
                yield pa.RecordBatch.from_arrays(out, names=[*part.schema.names, *names[:2 + offsets]])

    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema]
                       + [f"{names[0]} long", f"{names[1]} binary"] + [f"{names[2]} binary"] * offsets)
    return docs.mapInArrow(run, schema)


def starts_of(codec: Codec, data, offs, ids, at) -> np.ndarray:
    """The code point, counted from the text's start, that each id begins in."""
    byte = np.cumsum(codec.lengths[ids]) - codec.lengths[ids]
    point = np.cumsum((data & 0xC0) != 0x80) - 1
    base = np.zeros(len(offs) - 1, np.int64)
    filled = offs[:-1] < offs[1:]
    base[filled] = point[offs[:-1][filled]]
    return (point[byte] - np.repeat(base, np.diff(at))).astype("<u4")


def decode(encoded: DataFrame, content: bytes, ids: str = "ids") -> DataFrame:
    """``encoded`` plus ``decoded``: the bytes that the ids stand for (null ids: none)."""
    ship(encoded.sparkSession)
    name = fresh(encoded, "decoded")
    shared = encoded.sparkSession.sparkContext.broadcast(content)

    def run(batches):
        codec = rank_table(shared.value)
        for batch in batches:
            got = batch.column(ids).cast(pa.large_binary()).fill_null(b"")
            offs = np.frombuffer(got.buffers()[1], np.int64)[got.offset:got.offset + len(got) + 1]
            buf = got.buffers()[2]
            values = np.frombuffer(buf, "<u4", (int(offs[-1]) // 4)) if buf is not None else np.zeros(0, "<u4")
            values = values[offs[0] // 4:]
            raw = codec.decode(values.astype(np.int64))
            upto = np.concatenate([[0], np.cumsum(codec.lengths[values])])
            yield pa.RecordBatch.from_arrays([*batch.columns, tk.binary_rows(raw, upto[(offs - offs[0]) // 4])],
                                             names=[*batch.schema.names, name])

    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in encoded.schema] + [f"{name} binary"])
    return encoded.mapInArrow(run, schema)


def report(docs: DataFrame, content: bytes, pattern: str) -> DataFrame:
    """The digest of the registered query, one row per document."""
    out = decode(encode(docs.select("doc_id", "text"), content, pattern).drop("text"), content)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
