"""Operators on awkward rows, against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
import regex
from pyspark.sql import functions as F

from celltally.llm import bpe, chat, idcoder, idfiles, jaccard, mixing, parsing, pii, repeats, resample, rules, slabs
from celltally.llm import textkit as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASH = ("size", "row", "slab", "key", "ids", "n_tokens", "decoded", "log_weight", "kept", "spans", "base", "target", "after", "md5", "again")


def words(t):
    return WORD.findall(t or "")


def rows():
    rnd = random.Random(3)
    vocab = ["".join(rnd.choices("abcdeéß", k=rnd.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choices(vocab, k=n))
    base, passage = text(120), text(20)
    near = base.split()
    near[60] = "other"
    out = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base.upper(), "en", "b"), (4, " ".join(near), "en", "a"), (5, None, None, None),
           (6, "", "en", "a"), (7, " \n\t ", "de", "b"), (8, "two words", "en", "a"), (9, "TWO  words\n", "en", "c"), (10, "x" * 70_000, "en", "a"),
           (11, "again and " * 9_000, "en", "a"), (12, text(40) + " " + passage + "\n" + text(30), "fr", "c"),
           (13, passage + " " + text(50), "fr", "b"), (14, "日本語 の テキスト 😀 " * 5, "ja", "é"), (15, text(300) + "\r\n\x0b" + passage, None, "a"),
           (16, text(60), "en", None), (16, text(61), "en", None), (17, text(20), "en", "a"), (17, out17 := text(20), "en", "a"), (17, out17, "en", "a"),
           (None, base, "en", "a"), (None, text(70), None, "b"), (-4, "#$ | " * 30, "en", "a"),
           (20, "mail a.b@c.de or 10.0.0.1, card 4111 1111 1111 1111, +49 (30) 1234567; 300.1.1.1", "en", "a")]
    return [(i, t, lang, src, len(t) if t is not None else None) for i, t, lang, src in out]


ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for c in CLASH:
        d = d.withColumn(c, F.lit("clash"))
    return d


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ------------------------------------------------------------ n-gram Jaccard

def shingles(t, k):
    w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))}


def brute_components(data, k, percent):
    sets = [shingles(r[1], k) for r in data]
    root, n_links = list(range(len(data))), [0] * len(data)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            same_id = data[i][0] is not None and data[i][0] == data[j][0]
            link = sets[i] and sets[j] and 100 * inter >= percent * (len(sets[i]) + len(sets[j]) - inter)
            if link:
                n_links[i] += 1
                n_links[j] += 1
            if same_id or link:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)), n_links[i]) for i, r in enumerate(data)), key=repr)


COLUMNS = ("doc_id", "n_shingles", "component_id", "n_links")


@pytest.mark.parametrize("k, percent, slab_bytes", [(4, 85, 8 << 20), (4, 85, 20_000), (5, 80, 8 << 20), (1, 50, 8 << 20)])
def test_near_duplicates(docs, k, percent, slab_bytes):
    got = jaccard.near_duplicates(docs, k, percent, slab_bytes, count_links=True)
    assert by_row(got, *COLUMNS) == brute_components(ROWS, k, percent)


def test_near_duplicates_without_ids_and_with_several_texts_of_an_id(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    near = lambda w, i: " ".join([*w[:i], "new", *w[i + 1:]])
    data = [(None, " ".join(a)), (None, " ".join(a)), (7, near(a, 3)), (9, near(b, 5)), (7, " ".join(b)), (None, near(b, 9)),
            (None, "alone " + " ".join(f"c{i}" for i in range(30))), (3, near(a, 50)), (12, "d e f g h i j"), (12, "k l m n o p q")]
    got = jaccard.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 2, 85, count_links=True)
    assert by_row(got, *COLUMNS) == brute_components(data, 2, 85)


@pytest.mark.parametrize("members, size", [(512, 2 << 20), (16, 2 << 20), (512, 3_000)])
def test_all_links_of_a_group(spark, monkeypatch, members, size):
    """Components in one block and in many, of sets of very different sizes."""
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", members)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", size)
    rnd, data = random.Random(8), []
    base = [f"w{i}" for i in range(120)]
    for i in range(220):
        w = base[: 40 + 4 * (i % 21)]
        for _ in range(rnd.randint(0, 2)):
            w[rnd.randrange(len(w))] = f"z{i % 90}"
        data.append((i, " ".join(w)))
    got = jaccard.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 1, 85, count_links=True)
    assert by_row(got, *COLUMNS) == brute_components(data, 1, 85)


def test_slabs_hold_like_amounts_of_text(spark):
    data = [(i, "short") for i in range(2_000)] + [(10_000 + i, "x" * 40_000) for i in range(100)]
    d = spark.createDataFrame(data, "doc_id long, text string")
    base, n = slabs.deal(d, 400_000)
    got = base.groupBy("slab").agg(F.sum(F.octet_length("text")).alias("b"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).orderBy("slab").collect()
    assert max(r.b for r in got) <= 2 * 400_000 and n >= len(got) > 5
    assert all(a.hi < b.lo for a, b in zip(got, got[1:], strict=False))
    nulls = spark.createDataFrame([(None, f"text {i} " + "x" * 400) for i in range(2_000)] + [(i, "y" * 400) for i in range(1_000)], "doc_id long, text string")
    dealt, _ = slabs.deal(nulls, 100_000, by_range=False)
    assert max(r["s"] for r in dealt.groupBy("slab").agg(F.sum(F.octet_length("text")).alias("s")).collect()) <= 2 * 100_000


def test_near_duplicates_of_many_variants(spark):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(40)]
    data = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(40)] = rnd.choice(["p", "q", f"z{i}"])
        data.append((i, " ".join(w)))
    d = spark.createDataFrame(data, "doc_id long, text string")
    got = by_row(jaccard.near_duplicates(d, 2, 85, count_links=True), *COLUMNS)
    assert got == brute_components(data, 2, 85)


# ------------------------------------------------------------------- mixing

def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = total - sum(most * sizes[s] for s in capped)
        spread = sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and most * sizes[s] < weight[s] * free / spread}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * free / spread for s in order}
        capped |= over


def test_mixing(docs):
    sizes = {}
    for r in ROWS:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    want = brute_targets(sizes)
    got = mixing.report(docs).collect()
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((r[0], len(words(r[1]))) for r in ROWS if r[0] is not None)
    source = {r[0]: r[3] for r in ROWS}
    for r in got:
        if r.doc_id is not None:
            assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and (r.n_copies in (math.floor(r.target / r.source_size), math.floor(r.target / r.source_size) + 1))
    assert by_row(mixing.report(docs), "doc_id", "taken") == by_row(mixing.report(docs.repartition(5)), "doc_id", "taken")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.n_copies for r in got)


def test_mix_comes_near_its_targets(spark):
    rnd = random.Random(1)
    d = spark.createDataFrame([(i, "w " * rnd.randint(1, 60), rnd.choice("aaaaabc")) for i in range(6000)], "doc_id long, text string, source string")
    by = {}
    for r in mixing.report(d).join(d.select("doc_id", "source"), "doc_id").collect():
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(taken / target - 1) < 0.05 for target, taken in by.values())


# ------------------------------------------------------- tokens and id files

RANKS = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
ODD = ["", " ", "a  b", "a \n\n b", "\n", "it's\n 's  x　y\u0085 z", "日本語 テキスト 😀 é", "a\r\nb\tc  \n", "  lead", "trail  ", "12 a1b2,c.", " \n a",
       "foo \nbar", "don't we'll I'M", "<|endoftext|> hi", "a  b", "x... y!!", "é.a é,b", "\x00\x01 \x7f"]


@pytest.fixture(scope="module")
def encoding():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_equals_the_library(spark, docs, encoding):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    d = docs.select("doc_id", "text", "ids").unionByName(more.withColumn("ids", F.lit("x")))
    out = bpe.encode(d, RANKS, public_tokenizers.PATTERN, offsets=True)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "_ids", "starts"]
    back = bpe.decode(out, RANKS, ids="_ids").collect()
    assert len(back) == len(ROWS) + len(ODD)
    for r in back:
        text, ids = r.text or "", np.frombuffer(r["_ids"], "<u4")
        assert list(ids) == encoding.encode_ordinary(text) and r.n_tokens == len(ids) and bytes(r.decoded) == text.encode()
        _, starts = encoding.decode_with_offsets(list(ids))
        assert list(np.frombuffer(r.starts, "<u4")) == starts


def test_codec_forgets_and_recovers(encoding, monkeypatch):
    codec = bpe.rank_codec(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "MEMORY_PIECES", 50)
    monkeypatch.setattr(tk, "hash_spans", lambda data, s, e, lower=False, real=tk.hash_spans: real(data, s, e, lower) % np.uint64(200))
    import pyarrow as pa
    texts = [t for _, t, *_ in ROWS if t and len(t) < 5000]
    data, offs = tk.text_bytes(pa.array(texts))
    ids, at = codec.encode(data, offs)  # pieces are mistaken for others: the batch is encoded plainly
    assert [list(ids[a:b]) for a, b in zip(at[:-1], at[1:])] == [encoding.encode_ordinary(t) for t in texts]
    codec.forget()
    codec.keys = codec.keys[:0]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 20_000])
def test_range_coder(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50_258, n), np.full(n, 50_257), rng.integers(0, 4, n), np.arange(n) % 7):
        blob = idcoder.encode_block(ids, 50_258)
        assert np.array_equal(idcoder.decode_block(blob), ids)
    assert n < 20_000 or len(blob) < n / 2
    if n:
        broken = bytearray(blob)
        broken[-1] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            idcoder.decode_block(bytes(broken))


def test_id_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer
    content = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    t = Tokenizer.from_str(content.decode())
    t.encode_special_tokens = True
    want, at = [], 0
    for i, text in sorted(((r[0], r[1] or "") for r in ROWS), key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    for name, slab_bytes in (("one", 8 << 20), ("many", 20_000)):
        path = idfiles.write(docs, str(tmp_path / name), content, slab_bytes=slab_bytes)
        got = idfiles.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
        # null texts sort before empty ones, but both are one end id
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_id_files_with_added_tokens(spark, tmp_path):
    import pyarrow as pa
    from tokenizers import Tokenizer
    content = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    t = Tokenizer.from_str(content.decode())
    texts = ["a <|endoftext|> b", "plain one", "<|endoftext|>", None, "x<|endoftext|><|endoftext|>y\n<|endoftext", "|> no token across texts", "", "日本<|endoftext|>é "]
    want, at = [], 0
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = idfiles.read(spark, idfiles.write(d, str(tmp_path / "ids"), content)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"))
    assert sorted(map(tuple, got.collect())) == want
    assert bpe.file_codec(content).encode(*tk.text_bytes(pa.array(texts[:1])))[0].tolist() == [64, 220, 50256, 275]


# -------------------------------------------------------------- fingerprints

def test_fingerprints(spark, docs):
    got = {r.doc_id: r for r in parsing.compared(docs.where("doc_id is not null and doc_id not in (16, 17)")).collect()}
    many = {r.doc_id: r for r in parsing.compared(docs.where("doc_id is not null and doc_id not in (16, 17)"), slab_bytes=20_000).collect()}
    assert got == many
    data = sorted((r[0], r[1] or "") for r in ROWS if r[0] is not None and r[0] not in (16, 17))
    prints = {r.doc_id: r.fingerprint for r in parsing.fingerprint(docs).collect()}
    for (i, text), (j, after) in zip(data, data[1:] + data[:1]):
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert got[i].fingerprint == prints[i] and 0 <= got[i].near_edited <= 1
        assert got[i].near_next == parsing.likeness(prints[i], prints[j])
        assert (new == text) == (got[i].edited_fingerprint == got[i].fingerprint)
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint and got[1].near_next == 1.0
    assert parsing.likeness(prints[1], prints[4]) > 0.6 > 0.2 > parsing.likeness(prints[1], prints[12])


def test_equal_substrings_share_names():
    import pyarrow as pa
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    middle = text(4000)
    a, b, c = (tk.text_bytes(pa.array([x])) for x in (text(37) + middle + text(5), text(210) + middle, text(4000)))
    x, y, z = (parsing.fingerprints(*t)[0] for t in (a, b, c))
    assert parsing.likeness(x, y) > 0.8 and parsing.likeness(x, z) < 0.1


# ------------------------------------------------------------- quality rules

def brute_counts(text):
    text = text or ""
    w = words(text)
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_rules(docs):
    got = by_row(rules.report(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for r in ROWS:
        c = brute_counts(r[1])
        want.append((r[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want, key=repr)
    assert all(not r.kept for r in rules.report(docs).collect() if r.base_failed)


def test_rules_adapt_to_their_group(spark):
    rnd = random.Random(4)
    plain = lambda: " ".join("".join(rnd.choices("abcdef", k=rnd.randint(2, 8))) for _ in range(80))
    odd = lambda: " ".join("#" + w for w in plain().split())
    data = [(i, plain(), "en", "prose") for i in range(300)] + [(300 + i, odd(), "en", "tags") for i in range(300)] + [(600, odd(), "en", "prose")]
    d = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in rules.report(d).where("not kept").collect()] == [600]
    halves = rules.sketches(rules.counted(d.where("doc_id < 250"))).unionByName(rules.sketches(rules.counted(d.where("doc_id >= 250"))))
    assert by_row(rules.fences(halves), "source", "symbols_high", "upper_low") == by_row(
        rules.fences(rules.sketches(rules.counted(d))), "source", "symbols_high", "upper_low")


def brute_bounds(groups, ratio):
    """(low, high) of a ratio for each group of (lang, source) -> values."""
    def quartiles(values):
        values = sorted(v if v < 1024 else v - v % (1 << (v.bit_length() - 10)) for v in values)
        return len(values), values[-(-len(values) // 4) - 1], values[-(-3 * len(values) // 4) - 1]

    every, out = quartiles([v for g in groups.values() for v in g]), {}
    for (lang, source), values in groups.items():
        n, *own = quartiles(values)
        m, *tongue = quartiles([v for k, g in groups.items() if k[0] == lang for v in g])
        q1, q3 = ((n * a + 20 * ((m * b + 20 * c) // (m + 20))) // (n + 20) for a, b, c in zip(own, tongue, every[1:]))
        reach = max(4 * (q3 - q1), rules.RATIOS[ratio][3])
        out[lang, source] = (q1 - reach, q3 + reach)
    return out


def test_fences_of_any_size_and_ratio(spark):
    """One formula for groups of 1, 199 and 201 rows; ratios beyond 5000 have fences too."""
    rnd = random.Random(8)
    text = lambda n: " ".join("#" * n + "word" for _ in range(60))
    data, groups = [], {}
    for lang, source, n, most in (("en", "a", 199, 2), ("en", "b", 201, 2), ("en", "c", 1, 30), ("de", "d", 40, 30), (None, None, 3, 1)):
        for _ in range(n):
            k = rnd.randint(0, most)
            data.append((len(data), text(k), lang, source))
            groups.setdefault((lang, source), []).append(1000 * k)
    data.append((len(data), text(500), "de", "d"))
    groups["de", "d"].append(500_000)
    d = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    counts = rules.counted(d)
    assert {(r.lang, r.source): (r.symbols_low, r.symbols_high) for r in rules.fences(rules.sketches(counts)).collect()} == brute_bounds(groups, "symbols")
    assert not {r.doc_id: r.kept for r in rules.report(d).collect()}[len(data) - 1]


# ---------------------------------------------------------------------- PII

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 16 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in double) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def brute_spans(t):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, t or "") if valid(k, m.group()))


TERM_WORD = regex.compile(r"\p{L}[\p{L}'-]{2,}")

PII = ["a@b.c%x@d.e", "é日本 x@y.zz 1.2.3.4.5.6.7.8 300.1.1.1 +1 (377) 555-0271 4952935900253052 4952-9359 0025 3052", "1 " * 2000, "a@b" + ".c" * 3000,
       "x" * 5000, "9" * 3000, "+1 2 3 4 5 6 7 8 9 ()--", "0000001.2.3.255", None, "", "1.2.3.4 " * 700]


def test_base_spans(spark, docs):
    d = spark.createDataFrame([(100 + i, t) for i, t in enumerate(PII)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    texts = [(100 + i, t) for i, t in enumerate(PII)] + [(r[0], r[1]) for r in ROWS]
    want = sorted(((i, hashlib.sha256(brute_spans(t).encode()).hexdigest(), *[brute_spans(t).count(k + ":") for k in PATTERNS]) for i, t in texts), key=repr)
    assert by_row(pii.report(d), "doc_id", "base_sha256", "n_email", "n_ip", "n_card", "n_phone") == want


def test_terms_that_disclose(spark, docs):
    rnd = random.Random(1)
    vocab = ["".join(rnd.choices("bcdfglmnprst", k=2)) + rnd.choice("aeiou") + "".join(rnd.choices("bcdfg", k=3)) for _ in range(3000)]
    text = lambda n: " ".join(rnd.choices(vocab, k=n))
    data = [(i, text(60)) for i in range(400)]
    for i in (5, 50, 105):
        data[i] = (i, f"{text(30)} Jeronimo Quellmann at jq@mail.example.com now {text(30)}")
    data[200] = (200, f"I met QUELLMANN, yes. {text(30)}")
    variant = f"{text(40)} Oddword ask@x.org {text(40)}"  # one text in many variants is no evidence
    for i in range(300, 340):
        w = variant.split()
        w[rnd.randrange(len(w))] = "changed"
        data[i] = (i, " ".join(w))
    d = spark.createDataFrame([(i, t, len(t), "x") for i, t in data], "doc_id long, text string, n_chars long, spans string")
    clean = {r.doc_id: r for r in pii.sanitise(d).collect()}
    assert clean[200].text.startswith("I met [TERM], yes. ") and clean[200].n_chars == len(clean[200].text) and clean[200].spans == "x"
    assert "[TERM] [TERM] [TERM] [EMAIL]" in clean[5].text.replace(" at ", " [TERM] ") and "jq@" not in clean[5].text
    assert clean[310].text.count("[TERM]") == 0 and clean[310].text.count("[EMAIL]") == ("ask@x.org" in data[310][1])
    assert all(clean[i].text == t for i, t in data if i not in (5, 50, 105, 200) and not 300 <= i < 340)
    out = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert out[20] == "mail [EMAIL] or [IP], card [CARD], [PHONE]; 300.1.1.1" and out[5] is None


def prose(seed):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choices("bcdfglmnprst", k=2)) + rnd.choice("aeiou") + "".join(rnd.choices("bcdfg", k=3)) for _ in range(3000)]
    return rnd, lambda n: " ".join(rnd.choices(vocab, k=n))


def sanitised(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.text for r in pii.sanitise(d).collect()}


def test_terms_by_several_entities_and_in_a_shared_line(spark):
    _, text = prose(2)
    data = [text(60) for _ in range(400)]
    for i in (5, 50, 105):  # three identifiers of one person within reach of the name
        data[i] = f"{text(30)} Quellmann jq@ex.org +49 30 1234567 +49 30 7654321 {text(30)}"
    line = ("our friendly reception desk is staffed daily please ask there for Zwinglibert under zw@mail.example.com "
            "between nine and seventeen hours except on holidays and sundays")
    for i in (7, 70, 170, 270):  # the same line, over 48 code points on each side, in texts that differ
        data[i] = f"{text(40)} {line} {text(40)}"
    data[200] = "I met Quellmann, yes."
    clean = sanitised(spark, data)
    assert all("Quellmann" not in clean[i] for i in (5, 50, 105, 200)) and clean[200] == "I met [TERM], yes."
    assert all("Zwinglibert" not in clean[i] for i in (7, 70, 170, 270))


def test_capital_letters_of_terms(spark):
    _, text = prose(3)
    data = [text(60) for _ in range(400)]
    names = ["Иванов", "ÉMILE", "Özgür", "İstanbullu", "ΟΔΥΣΣΕΥΣ"]
    for k, name in enumerate(names):
        for i in (5 + k, 50 + k, 105 + k):
            data[i] = f"{text(30)} {name} p{k}@mail.example.com {text(30)}"
    data[200] = "😀 " + " and ".join(names) + " met"
    clean = sanitised(spark, data)
    assert clean[200] == "😀 [TERM] and [TERM] and [TERM] and [TERM] and [TERM] met"
    assert all("[TERM] [EMAIL]" in clean[i + k] for k in range(5) for i in (5, 50, 105))


@pytest.mark.parametrize("n, every", [(30, 6), (400, 3)])
def test_small_tables_and_hot_entities_have_terms(spark, n, every):
    rnd, text = prose(4)
    data = [text(60) for _ in range(n)]
    hot = range(0, n, every)
    for i in hot:  # a hot entity: a name always by it, another word as often elsewhere
        data[i] = f"{text(30)} Quellmann commonword desk@mail.example.com {text(30)}"
    for i in range(1, n, every):
        data[i] = f"{text(30)} commonword {text(30)}"
    variant = f"{text(40)} Oddword ask@x.org {text(40)}"
    odd = [i for i in range(n) if i % every == 2]
    for i in odd:  # variants of one text are no evidence
        w = variant.split()
        w[rnd.randrange(38)] = "changed"
        data[i] = " ".join(w)
    clean = sanitised(spark, data)
    assert all("[TERM] commonword [EMAIL]" in clean[i] for i in hot)
    assert all("Oddword [EMAIL]" in clean[i] for i in odd)


def test_variants_hide_no_evidence(spark):
    rnd, text = prose(6)
    data = [text(60) for _ in range(400)]
    variant = f"{text(40)} Oddword ask@x.org {text(40)}"
    for i in range(300, 340):
        w = variant.split()
        w[rnd.randrange(38)] = "changed"
        data[i] = " ".join(w)
    for i in (9, 90):
        data[i] = f"{text(30)} Oddword ask@x.org {text(30)}"
    clean = sanitised(spark, data)
    assert all("[TERM] [EMAIL]" in clean[i] for i in (9, 90, *range(300, 340)))


@pytest.mark.parametrize("hub", [None, min, max])
def test_a_text_like_all_others_hides_no_evidence(spark, hub):
    _, text = prose(8)
    data = [text(60) for _ in range(300)]
    common = f"{text(30)} Quellmann q@ex.org {text(28)}"
    for i in (3, 30, 130):  # no variants of each other
        data[i] = f"{common} {text(58)}"
    if hub:  # a variant of all three, its md5 the least or the greatest
        data[7] = hub((f"{common} {w}" for w in text(50).split()), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    clean = sanitised(spark, data)
    assert all("[TERM] [EMAIL]" in clean[i] for i in (3, 30, 130, *([7] if hub else [])))


def brute_terms(texts):
    """Disclosing terms by the rule's own words, over all triples of texts."""
    distinct = sorted({t or "" for t in texts})
    near, holds = {}, {}
    for t in distinct:
        for w in set(TERM_WORD.findall(t.lower())):
            holds.setdefault(w, set()).add(t)
        for kind, p in PATTERNS.items():
            for m in re.finditer(p, t):
                if valid(kind, m.group()):
                    a, b = max(m.start() - 48, 0), m.end() + 48
                    left = re.sub(r"^[^\x20\x09-\x0D]*", "", t[a:m.start()]) if a else t[:m.start()]
                    right = re.sub(r"[^\x20\x09-\x0D]*$", "", t[m.end():b]) if b < len(t) else t[m.end():]
                    raw = m.group().lower()
                    entity = kind, re.sub("[^0-9]", "", raw) if kind in ("card", "phone") else raw
                    holds.setdefault(entity, set()).add(t)
                    for w in TERM_WORD.findall(f"{left} {right}".lower()):
                        near.setdefault((w, entity), set()).add(t)
    pairs = {t: {*zip(w := t.lower().split(), [*w[1:], None])} for t in distinct}
    other = lambda a, b: 2 * len(pairs[a] & pairs[b]) <= len(pairs[a] | pairs[b])
    out = set()
    for (w, entity), both in near.items():
        post, own = len(both) / len(holds[w]), math.log2(len(distinct) / len(holds[entity]))
        if len(both) >= 3 and post >= 0.5 and own > 0 and own + math.log2(post) >= 0.8 * own and any(
                other(a, b) and other(a, c) and other(b, c) for a, b, c in itertools.combinations(sorted(both), 3)):
            out.add(w)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_terms_against_brute_force(spark, seed):
    rnd, text = prose(seed + 20)
    data = []
    for p in range(24):  # people with a name, an identifier, and differing habits
        who = f"p{p}@ex.org" if p % 3 else f"+49 30 55501{p:02d}"
        by = [f"{text(12)} Name{chr(97 + p)}son {who} {text(rnd.randint(0, 12))}" for _ in range(rnd.randint(1, 5))]
        elsewhere = [f"{text(20)} Name{chr(97 + p)}son {text(9)}" for _ in range(rnd.randint(0, 6))]
        again = [t + f" {text(1)}" for t in by[:1] for _ in range(rnd.randint(0, 4))]  # variants
        data += by + elsewhere + again + by[:rnd.randint(0, 1)]
    data += [None, "", *[text(20) for _ in range(60)]]
    rnd.shuffle(data)
    terms = brute_terms(data)
    assert 3 <= len(terms) < 24
    want = []
    for i, t in enumerate(data):
        base = [tuple(map(int, s.split(":")[1:])) for s in brute_spans(t).split(",") if s]
        found = [(m.start(), m.end()) for m in TERM_WORD.finditer((t or "").lower()) if m.group() in terms]
        found = [f"term:{a}:{b}" for a, b in found if not any(x < b and a < y for x, y in base)]
        want.append((i, ",".join([*filter(None, [brute_spans(t)]), *found])))
    d = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    assert by_row(pii.report(d), "doc_id", "spans") == sorted(want, key=repr)


# ------------------------------------------------------------------ repeats

def brute_repeats(data, width):
    first, out = {}, []
    for i, t, *_ in data:
        w = words(t)
        for p in range(len(w) - width + 1):
            g = tuple(w[p:p + width])
            first[g] = min(first.get(g, math.inf), -math.inf if i is None else i)
    for i, t, *_ in data:
        w = words(t)
        gone = {p + j for p in range(len(w) - width + 1) if first[tuple(w[p:p + width])] < (-math.inf if i is None else i) for j in range(width)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, slab_bytes", [(13, 8 << 20), (13, 20_000), (5, 20_000), (2, 20_000), (1, 20_000)])
def test_repeats(docs, width, slab_bytes):
    assert by_row(repeats.dedup(docs, width, slab_bytes), "doc_id", "n_words", "n_removed", "kept") == brute_repeats(ROWS, width)


# ---------------------------------------------------------------- chat

def test_chat(spark):
    texts = ["</s>[INST] ok [/INST]", r"[\INST] [\\OUT] \\ <\s>", "plain", "", None, "[/TURN] [TURN] x", "ends with [", "日本 <s", "a" * 30_000]
    roles = ["system", "user", "assistant", "tool", None, "[/TURN] odd", "user"]
    rnd = random.Random(6)
    data = [(c, t, rnd.choice(roles), rnd.choice(texts)) for c in range(40) for t in rnd.sample(range(30), rnd.randint(1, 9))]
    data += [(50, 0, "system", "s"), (50, 1, "user", "u"), (50, 2, "assistant", "a"), (51, 0, "user", "u"), (51, 0, "user", "u"), (None, None, "user", "x")]
    d = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(d)).collect()}
    convs = {}
    for c, t, r, x in data:
        convs.setdefault(c, []).append((t if t is not None else -1, r or "", x or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[50].valid and not got[51].valid and got[None].valid
    probe = chat.read_back(chat.format_chats(chat.with_probe(d))).where("conv_id = -1").first()
    assert probe.n_turns == 2 and probe.loss_chars == 21 and probe.valid
    segs = [tuple(s) for s in chat.format_chats(d).where("conv_id = 50").first().segments]
    assert segs == [("[SYS] ", False), ("s", False), (" [/SYS]", False), ("[INST] ", False), ("u", False), (" [/INST]", False),
                    ("[OUT] ", False), ("a", True), ("</s>", False)]


# ---------------------------------------------------------------- resampling

def test_resampling_is_right_on_held_out_labels(spark):
    rnd = random.Random(8)
    good = lambda: " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(2, 7))) for _ in range(rnd.randint(8, 60)))
    bad = lambda: rnd.choice([" ".join(w + "***" for w in good().split()), " ".join([good().split()[0]] * 30), good().upper()])
    data = [(i, bad() if i % 8 == 0 else good(), int(i % 8 > 0)) for i in range(4000)]
    d = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data if i % 3 == 0], "doc_id long, quality int")
    kept = {r.doc_id for r in resample.select(d, labels).collect()}
    hits = sum((i in kept) == bool(q) for i, _, q in data if i % 3)
    assert hits > 0.98 * sum(1 for i, *_ in data if i % 3)
    assert {r.doc_id for r in resample.select(d.repartition(7), labels).collect()} == kept


def test_kth_largest(spark):
    rnd = random.Random(9)
    keys = [rnd.choice([rnd.gauss(0, 1e4), 5.0, -1.5]) for _ in range(3000)]
    d = spark.createDataFrame([(k,) for k in keys], "key double")
    for k in (1, 2, 700, 1500, 2999, 3000):
        assert resample.kth_largest(d, k) == sorted(keys, reverse=True)[k - 1]


def test_resampling_keeps_columns(docs, spark):
    labels = spark.createDataFrame([(1, 1), (-4, 0), (-4, 1), (None, 0), (12, None)], "doc_id long, quality int")
    out = resample.select(docs, labels)
    assert out.columns == docs.columns and 0 < out.count() <= len(ROWS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert resample.select(docs, none).count() == len(ROWS)  # nothing to learn from: all stay
    assert len(resample.report(docs, labels).collect()) == len(ROWS)


# -------------------------------------------------------------- empty tables

def test_empty_tables(spark, empty, tmp_path):
    content = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    labels = spark.createDataFrame([], "doc_id long, quality int")
    results = [jaccard.near_duplicates(empty), mixing.report(empty), mixing.mix(empty), bpe.report(empty, RANKS, public_tokenizers.PATTERN),
               parsing.compared(empty), parsing.fingerprint(empty), rules.report(empty), pii.report(empty), pii.sanitise(empty), repeats.dedup(empty),
               resample.select(empty, labels), resample.report(empty, labels),
               chat.read_back(chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))),
               idfiles.read(spark, idfiles.write(empty, str(tmp_path / "ids"), content))]
    assert [r.count() for r in results] == [0] * len(results)
