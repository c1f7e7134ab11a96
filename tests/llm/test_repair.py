"""Conversation repair against a brute-force search over all edits."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import cache

import pytest
from pyspark.sql import functions as F

from celltally.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
GAP = " \t\n\v\f\r"


def conversations():
    rnd = random.Random(5)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None, "Über"]
    texts = ["Yes.", "No!", "why? \n", "cut off", "", " \t", None, "é. x", "Yes."]
    out = []
    for conv in [*range(60), None]:
        for _ in range(rnd.randint(1, 12)):
            row = (conv, rnd.choice([0, 1, 2, 3, 4, 7, None]), rnd.choice(roles), rnd.choice(texts))
            out += [row] * rnd.choice([1, 1, 1, 1, 3])
    for turn in range(200):  # a long one, well formed but for its damage
        out.append((1000, turn, "user" if turn % 2 == 0 else "assistant", f"turn {turn}."))
    out += [(1001, None, "user", "same.")] * 30
    return out


def damaged(row):
    conv, turn, role, text = row
    said = lambda v: " " if v is None else str(v)
    code = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
    role, text = said(role), said(text)
    text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
    return [] if code == 0 else [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(GAP)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, turns): states are '', 's', 'u', 'a'."""
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for to in allowed[state].replace("s", ""):
                c, audit, turns = best(i, to, inserted + 1)
                options.append((c + 2, "I" + audit, (f"{full[to]}:",) + turns))
        if i < len(rows):
            _, role, text = rows[i]
            c, audit, turns = best(i + 1, state, 0)
            options.append((c + 3, "D" + audit, turns))
            if found[i] not in ("blank", "duplicate"):
                more = found[i] == "truncated"
                if role[:1] and role[:1] in allowed[state]:
                    c, audit, turns = best(i + 1, role[:1], 0)
                    options.append((c + more, "K" + audit, (f"{role}:{text}",) + turns))
                for to in allowed[state].replace("s", ""):
                    c, audit, turns = best(i + 1, to, 0)
                    options.append((c + 2 + more, "R" + audit, (f"{full[to]}:{text}",) + turns))
        return min(options, default=(10**9, "~", ()))

    return best(0, "", 0)


def brute(data):
    out = []
    for conv in dict.fromkeys(r[0] for r in data):
        rows = [d for r in data if r[0] == conv for d in damaged(r)]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        found = faults(rows)
        n = Counter(found)
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, kept = cheapest(tuple(rows), tuple(found)) if rows else (0, "", ())
        assert not audit or re.fullmatch("(s?(ua)+)?", "".join(k[:1] for k in kept))
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least_block", [1, 16])
def test_repair(spark, least_block):
    data = conversations()
    rows = spark.createDataFrame(data, SCHEMA).repartition(5).withColumn("pos", F.lit("clash")).withColumn("conv", F.lit("clash")).withColumn("n", F.lit(9))
    out = repair.report(rows, least_block)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(data)


def test_repaired_rows_follow_the_grammar(spark):
    rows = spark.createDataFrame([r for r in conversations() if r[0] is not None], SCHEMA)
    plan = repair.planned(repair.damage(rows), 1)
    done = {}
    for r in repair.repaired(plan).orderBy("conv", "place").collect():
        done.setdefault(r.conv, []).append(r)
    for edits in done.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in edits if r.role is not None))
        assert [r.place for r in edits] == list(range(len(edits)))
        assert all((r.edit == "D") == (r.role is None) for r in edits)


def test_long_conversation_in_many_blocks(spark):
    """One conversation of a third of all rows: blocks stay near the square root of its length."""
    rows = spark.range(9_000).select(F.when(F.col("id") < 3_000, 7).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"))
    out = {r.conv_id: r for r in repair.report(rows, 1).where("conv_id = 7 OR conv_id > 8990").collect()}
    data = [(7, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(3_000)]
    lines = sorted((d for r in data for d in damaged(r)), key=lambda r: r[0])
    assert len(out) == 10 and len(out[7].audit) >= len(lines) and out[7].gaps == lines[-1][0] - lines[0][0] + 1 - len({r[0] for r in lines})


def test_without_rows(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.report(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
