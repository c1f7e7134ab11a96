r"""PII: information-theoretic sanitisation. Built-in functions only.

Base spans are e-mail addresses, IP numbers, card numbers and phone numbers
found by pattern. Beyond them, words that stand next to such entities can
reveal them: over the corpus, a term is a disclosing one if the probability of
an entity given the term is high, it gives away most of the entity's own
information, and enough different texts say so. Equal texts count once; variants of a
text are told by the whole texts and are no evidence of their own, however
alike or unlike the places around the entity are.
Disclosing terms become spans wherever they occur. Sanitised texts have every
span replaced by its kind.

Patterns are written with possessive loops: the same matches, no deep
recursion and no quadratic rescans on very long texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltally.llm.common import col, land

#: Kind -> (pattern, pattern of a cheap first test).
KINDS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][0-9\x20-]{14}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
TERM = "term"
#: Terms are looked for in so many code points on either side of an entity.
CONTEXT_CHARS = 48
WORD = r"\p{L}[\p{L}'-]{2,}"
#: A disclosing term: P(entity | term), share of the entity's information (minus log2 of
#: P(entity)) that it gives away, and different texts behind it, at least.
POSTERIOR, SHARE, CONTEXTS = 0.5, 0.8, 3
#: Texts are variants if more than half of their word pairs agree, as far as so many least hashes tell.
SKETCH = 64
TERMS_BROADCAST_BYTES = 8 << 20
_BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The sum of digits, every second one from the right doubled, is divisible by ten."""
    def one(c, i):
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    places = F.transform(F.split(F.reverse(digits), "(?!$)", -1), one)
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        small = lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False)
        return F.forall(F.transform(F.split(m, r"\."), part), small)
    if kind == "card":
        return _let(_digits(m), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _before(lengths: Column) -> Column:
    """For each entry the sum of the entries before it, in blocks, so that a
    text with very many matches stays far from quadratic."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))

    def of_blocks(sums):
        def one(x, i):
            block = F.floor(i / _BLOCK).cast("int")
            return sums[block] + _sum(F.slice(lengths, block * _BLOCK + 1, i - block * _BLOCK))
        return F.transform(lengths, one)

    return _let(blocks, lambda sums: _let(F.transform(sums, lambda x, b: _sum(F.slice(sums, F.lit(1), b))), of_blocks))


SPANS = "array<struct<kind: string, start: int, end: int>>"


def spans_of(text: Column, kind: str, pattern: Column, valid=None) -> Column:
    """Matches of a pattern as (kind, start, end) in code points, end exclusive."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    hits = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("hit")), lambda z: F.struct(
        F.length(z["gap"]).alias("gap"), F.length(z["hit"]).alias("long"), z["hit"].alias("hit")))

    def placed(hits):
        lengths = F.transform(hits, lambda z: z["gap"] + F.coalesce(z["long"], F.lit(0)))
        starts = _let(lengths, _before)
        spans = F.transform(F.arrays_zip(hits.alias("z"), starts.alias("at")), lambda x: F.struct(
            F.lit(kind).alias("kind"), (x["at"] + x["z"]["gap"]).alias("start"),
            (x["at"] + x["z"]["gap"] + x["z"]["long"]).alias("end"), x["z"]["hit"].alias("hit")))
        spans = F.filter(spans, lambda s: s["hit"].isNotNull() & (valid(s["hit"]) if valid else F.lit(True)))
        return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return F.when(F.size(found) > 0, _let(hits, placed)).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """All base spans, by kind as listed, then by start."""
    none = F.array().cast(SPANS)
    parts = []
    for kind, (pattern, hint) in KINDS.items():
        test = F.contains(text, F.lit(hint)) if hint == "@" else F.rlike(text, F.lit(hint))
        parts.append(F.when(test, spans_of(text, kind, F.lit(pattern), lambda m, k=kind: _valid(k, m))).otherwise(none))
    return F.concat(*parts)


def spelled(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def folded(text: Column) -> Column:
    """The text in lower case, code point by code point: the dotted capital I,
    the only one whose lower case is longer, becomes a plain i."""
    return F.lower(F.translate(text, "\u0130", "I"))


def entities(found: DataFrame) -> DataFrame:
    """(md5, text, s, entity): one row per base span of the rows with ``text`` and ``base``."""
    one = found.where(F.size("base") > 0).select(F.md5("text").alias("md5"), "text", F.explode("base").alias("s"))
    raw = F.lower(F.substring("text", F.col("s.start") + 1, F.col("s.end") - F.col("s.start")))
    entity = F.concat(F.col("s.kind"), F.lit(":"), F.when(F.col("s.kind").isin("card", "phone"), _digits(raw)).otherwise(raw))
    return one.select("md5", "text", "s", entity.alias("entity"))


def contexts(found: DataFrame) -> DataFrame:
    """(entity, term, md5): the terms near each entity of each distinct text."""
    begin = F.greatest(F.col("s.start") - CONTEXT_CHARS, F.lit(0))
    left = F.substring("text", begin + 1, F.col("s.start") - begin)
    left = F.when(begin > 0, F.regexp_replace(left, r"^[^\x20\x09-\x0D]*+", "")).otherwise(left)
    right = F.substring("text", F.col("s.end") + 1, F.lit(CONTEXT_CHARS))
    right = F.when(F.col("s.end") + CONTEXT_CHARS < F.length("text"), F.regexp_replace(right, r"[^\x20\x09-\x0D]*+$", "")).otherwise(right)
    near = folded(F.concat_ws(" ", left, right))
    terms = F.array_distinct(F.regexp_extract_all(near, F.lit(WORD), F.lit(0)))
    return entities(found).select("entity", "md5", F.explode(terms).alias("term")).distinct()


def candidates(found: DataFrame) -> DataFrame:
    """(term, entity, n): pairs that stand together in enough texts (``n``), and
    in their share of the texts where the term stands by any entity. These are
    no more than all texts that hold the term, so the cut loses nothing. Common
    words stand by many entities and go here, before any text is searched."""
    near = contexts(found)
    pairs = near.groupBy("term", "entity").agg(F.count("*").alias("n")).where(F.col("n") >= CONTEXTS)
    texts = near.select("term", "md5").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    return pairs.join(texts, "term").where(F.col("n") >= POSTERIOR * F.col("n_near")).drop("n_near")


def sketch(text: Column) -> Column:
    """For each of ``SKETCH`` hash functions the least hash of the text's pairs of neighbouring words."""
    words = F.split(folded(text), r"[\x20\x09-\x0D]+", -1)
    pairs = _let(words, lambda ws: F.array_distinct(F.transform(ws, lambda w, i: F.hash(w, F.get(ws, i + 1)))))
    least = lambda hs, i: F.array_min(F.transform(hs, lambda h: F.hash(h, F.lit(i))))
    return _let(pairs, lambda hs: F.array(*[least(hs, i) for i in range(SKETCH)]))


def apart(a: Column, b: Column) -> Column:
    """The places where two sketches differ: about ``SKETCH`` times the share of
    word pairs that only one of the texts has. Keeps the triangle inequality."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d))


def evidenced(pairs: DataFrame, found: DataFrame, small) -> DataFrame:
    """The (term, entity) of ``pairs`` that stand together in ``CONTEXTS`` texts
    of which none is a variant of another.

    The texts are taken farthest first: the one farthest from any text, then
    each time the one whose nearest of those taken is farthest. The text that
    the search sets out from is not among them, so a text that resembles all
    others hides none of them. Texts that share no word pair are
    always found, whatever other texts there are: the least distance of those
    taken is at least half of the largest possible.
    """
    held = land(contexts(found).join(small(pairs, 64), ["term", "entity"]), "pii-evidence")
    texts = found.select("text", F.md5("text").alias("md5")).join(held.select("md5").distinct(), "md5", "left_semi")
    texts = texts.select("md5", sketch(F.col("text")).alias("sketch")).dropDuplicates(["md5"])
    rest = land(held.join(texts, "md5").select("term", "entity", "md5", "sketch"), "pii-evidence")
    taken = rest.groupBy("term", "entity").agg(F.array(F.min_by("sketch", "md5")).alias("taken"))
    for n in range(CONTEXTS + 1):
        taken = land(taken, "pii-evidence")
        if n == CONTEXTS:
            break
        nearest = F.array_min(F.transform("taken", lambda t: apart(F.col("sketch"), t)))
        far = rest.join(small(taken, 64 + 4 * SKETCH * CONTEXTS), ["term", "entity"]).groupBy("term", "entity").agg(
            F.max_by(F.struct("taken", "sketch"), F.struct(nearest, "md5")).alias("far"))
        before = F.col("far.taken") if n else F.array().cast("array<array<int>>")
        taken = far.select("term", "entity", F.concat(before, F.array("far.sketch")).alias("taken"))
    least = F.array_min(F.flatten(F.transform("taken", lambda a, i: F.transform(
        F.slice("taken", i + 2, CONTEXTS), lambda b: apart(a, b)))))
    return taken.where(2 * least >= SKETCH).select("term", "entity")


def words_in(texts: DataFrame) -> DataFrame:
    """(doc_id, term): the distinct words of each text."""
    words = F.array_distinct(F.regexp_extract_all(folded(F.col("text")), F.lit(WORD), F.lit(0)))
    return texts.select("doc_id", "md5", F.explode(words).alias("term"))


def located(docs: DataFrame) -> DataFrame:
    """``row`` (the input row as a struct), ``doc_id``, ``text`` (never null),
    ``base`` and ``spans`` (base and disclosing terms), one row per input row.

    Counts of terms and entities are of distinct texts. The rule is the same for
    rare and hot entities and for tables of any size; an entity in every text
    carries no information, so nothing discloses it. Texts without an entity or term have empty spans; repeated
    rows are treated alike; clashing names in ``docs`` do no harm.
    """
    found = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col("doc_id").alias("doc_id"),
                        F.coalesce(col("text").cast("string"), F.lit("")).alias("text"))
    found = found.withColumn("base", base_spans(F.col("text")))
    pairs = land(candidates(found.select("text", "base")), "pii-candidates")
    if pairs.isEmpty():  # no term stands by an entity often enough: none can disclose
        return found.withColumn("spans", F.col("base"))

    def small(df, width):
        size_of = df.agg(F.sum(F.octet_length("term") + width)).first()[0] or 0
        return F.broadcast(df) if size_of <= TERMS_BROADCAST_BYTES else df

    slim = found.select("doc_id", "text", F.md5("text").alias("md5"))
    hits = land(words_in(slim).join(small(pairs.select("term").distinct(), 16), "term"), "pii-hits")
    n_docs = slim.agg(F.count_distinct("md5")).first()[0]
    per_term = hits.select("term", "md5").distinct().groupBy("term").agg(F.count("*").alias("n_term"))
    per_entity = entities(found.select("text", "base")).select("entity", "md5").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    posterior = F.col("n") / F.col("n_term")
    own_bits = F.log2(F.lit(float(n_docs)) / F.col("n_entity"))
    discloses = (own_bits > 0) & (posterior >= POSTERIOR) & (own_bits + F.log2(posterior) >= SHARE * own_bits)
    told = land(pairs.join(per_term, "term").join(per_entity, "entity")
                .where(discloses).select("term", "entity"), "pii-pairs")
    terms = land(evidenced(told, found.select("text", "base"), small).select("term").distinct(), "pii-terms")
    own = land(hits.join(small(terms, 16), "term").groupBy("md5").agg(F.collect_set("term").alias("terms")), "pii-terms")
    pattern = F.concat(F.lit(r"(?<![\p{L}'-])(?:"), F.concat_ws("|", F.col("terms")), F.lit(r")(?![\p{L}'-])"))
    found = found.withColumn("md5", F.md5("text")).join(own, "md5", "left")
    extra = F.when(F.col("terms").isNotNull(), spans_of(folded(F.col("text")), TERM, pattern)).otherwise(F.array().cast(SPANS))
    free = F.filter(extra, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.select("row", "doc_id", "text", "base", F.concat("base", free).alias("spans"))


def cleaned(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind; spans that overlap become one, by the first's kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(state, s):
        gap = F.substring(text, state["pos"] + 1, s["start"] - state["pos"])
        new = F.concat(state["out"], F.array(gap, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.when(s["start"] >= state["pos"], F.struct(s["end"].alias("pos"), new.alias("out"))).otherwise(
            F.struct(F.greatest(s["end"], state["pos"]).alias("pos"), state["out"].alias("out")))

    return F.when(F.size(spans) > 0, F.aggregate(ordered, zero, step, lambda st: F.concat(
        F.concat_ws("", st["out"]), F.substring(text, st["pos"] + 1, F.length(text))))).otherwise(text)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with sanitised texts; ``n_chars``, if it is a column, follows the new text. Null texts stay null."""
    out = located(docs).withColumn("clean", cleaned(F.col("text"), F.col("spans")))
    changed = F.size("spans") > 0
    row = lambda c: F.col("row").getField(c)
    pick = {"text": F.when(changed, F.col("clean")).otherwise(row("text"))}
    if "n_chars" in docs.columns:
        pick["n_chars"] = F.when(changed, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(row("n_chars"))
    return out.select(*[pick.get(c, row(c)).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """The digest of the registered query, one row per document."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return located(docs).select("doc_id", *[n(k) for k in KINDS], F.sha2(spelled(F.col("base")), 256).alias("base_sha256"),
                                spelled(F.col("spans")).alias("spans"))
