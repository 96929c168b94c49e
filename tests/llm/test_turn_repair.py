"""Conversation repair: the search against enumeration, queries against plain Python, odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tonality.llm import turn_repair as R

WELL = re.compile(r"(s?(ua)+)?\Z")


def edits_of(rows):
    """(cost, audit, roles) by the operator's search."""
    search, out = R.Survivors(), []
    for row in rows:
        out += list(search.feed(row))
    out += list(search.finish())
    assert search.held <= 4
    return (sum(R._edit_cost(op, row) for op, row, _ in out), "".join(op for op, _, _ in out),
            [role for _, _, role in out if role is not None])


def enumerated(rows):
    """Least (cost, audit) over all edit strings with at most two insertions in a place."""
    best = None
    inserts = [()] + [(a,) for a in "ua"] + list(itertools.product("ua", repeat=2))
    places = []
    for _turn, role, _text, fault in rows:
        extra = 3 if fault == R.CUT_OFF else 0
        ways = [("D", "", 4)]
        if fault not in (R.BLANK, R.DUPLICATE):
            ways += [("K", role[:1] or "?", extra), ("R", "u", 3 + extra), ("R", "a", 3 + extra)]
        places += [[("I" * len(i), "".join(i), 3 * len(i)) for i in inserts], ways]
    places.append([("I" * len(i), "".join(i), 3 * len(i)) for i in inserts])
    for pick in itertools.product(*places):
        roles = "".join(p[1] for p in pick)
        if WELL.match(roles):
            key = (sum(p[2] for p in pick), "".join(p[0] for p in pick))
            best = key if best is None or key < best else best
    return best


def whole_strings(rows):
    """The same by a table of whole strings for every state: for longer conversations."""
    table = {"": (0, "")}  # state: last accepted initial ('' none, 's', 'u', 'a')
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def closed(t):
        for _ in range(3):
            for st, (c, a) in list(t.items()):
                for n in follow[st]:
                    if n != "s" and (n not in t or (c + 3, a + "I") < t[n]):
                        t[n] = (c + 3, a + "I")
        return t

    for _turn, role, _text, fault in rows:
        new = {}

        def offer(st, c, a, new=new):
            if st not in new or (c, a) < new[st]:
                new[st] = (c, a)

        extra = 3 if fault == R.CUT_OFF else 0
        for st, (c, a) in table.items():
            offer(st, c + 4, a + "D")
        if fault not in (R.BLANK, R.DUPLICATE):
            for st, (c, a) in closed(dict(table)).items():
                if role[:1] and role[:1] in follow[st]:
                    offer(role[:1], c + extra, a + "K")
                for n in follow[st]:
                    if n != "s":
                        offer(n, c + 3 + extra, a + "R")
        table = new
    return min(v for st, v in closed(dict(table)).items() if st in ("", "a"))


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "unicorn", " ", ""]
    faults = [None, None, None, R.BLANK, R.DUPLICATE, R.CUT_OFF]
    return [(k, rng.choice(roles[:3] if rng.random() < 0.8 else roles), f"t{k}.", rng.choice(faults)) for k in range(n)]


def test_search_against_enumeration():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 3, 3, 3):
        for _ in range(12):
            rows = random_rows(rng, n)
            got = edits_of(rows)
            assert got[:2] == enumerated(rows), rows
            assert WELL.match("".join(r[:1] for r in got[2]))


def test_search_against_whole_strings():
    rng = random.Random(2)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(0, 40))
        assert edits_of(rows)[:2] == whole_strings(rows), rows


def test_memory_follows_the_unresolved_stretch():
    """A long regular conversation coalesces at once, however long; ties stay until decided."""
    search = R.Survivors()
    emitted = 0
    for k in range(20_000):
        emitted += len(list(search.feed((k, ("user", "assistant")[k % 2], "x.", None))))
    assert search.most_held < 64 and emitted > 19_900
    tied = [(k, "user", "x.", None) for k in range(2001)]
    assert edits_of(tied)[:2] == whole_strings(tied)


def brute(table):
    """{conv_id: row} straight from the rules."""
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        act = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if act == 0:
            continue
        text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
        rows += [(turn, "user" if act == 4 else role, text)] * (2 if act == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in rows if r[0] is not None]
        seen, faulty = set(), []
        for turn, role, text in rows:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = (R.BLANK if not body else R.DUPLICATE if (role, text) in seen
                     else R.CUT_OFF if body[-1] not in ".!?" else None)
            seen.add((role, text))
            faulty.append((turn, role, text, fault))
        cost, audit = whole_strings(faulty)
        left, lines, k = iter(faulty), [], 0
        kept = sum(op != "D" for op in audit)
        for op in audit:
            row = next(left) if op != "I" else None
            if op != "D":
                role = row[1] if op == "K" else ("user", "assistant")[(k + kept % 2) % 2]
                lines.append(f"{role}:{row[2] if row else ''}")
                k += 1
        initials = [r[1][:1] for r in rows]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(sum(f[3] == x for f in faulty) for x in (R.BLANK, R.DUPLICATE, R.CUT_OFF)),
                     sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def query(spark, rows, path, parts=3):
    schema = "conv_id bigint, turn bigint, role string, text string, fault string, conv int, step int"
    spark.createDataFrame([(*r, "f", 1, 2) for r in rows], schema).repartition(parts).write.parquet(
        f"{path}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in R.op12_turn_repair(spark, str(path)).collect()}


def test_query(spark, sf):
    t = pq.read_table(f"{sf}/conversations.parquet").to_pydict()
    want = brute(list(zip(t["conv_id"], t["turn"], t["role"], t["text"], strict=True)))
    got = R.op12_turn_repair(spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    rows = got.collect()
    assert len(rows) == len(want) and {r.conv_id: tuple(r)[1:] for r in rows} == want


def test_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    texts = ["", "  \n", "a.", "a.", "b", "c!", "c! \n", "é…", "x" * 50_000, None, "d?", " ", "e. "]
    rows = [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, None, -5, 0, 1, 2, 2, 3, 900]),
             rng.choice(["user", "assistant", "system", None, "", "User", "tool"]), rng.choice(texts))
            for _ in range(160)]
    rows += [(7, None, None, None)] + [(8, 3, "user", "same.")] * 40 + [(9, k, "user", "same.") for k in range(60)]
    rows += [(10, -(2 ** 63), "user", "a."), (10, 2 ** 63 - 1, "assistant", "b.")]
    want = brute(rows)
    want = {k: (min(v[0], 2 ** 63 - 1), *v[1:]) for k, v in want.items()}
    assert query(spark, rows, tmp_path / "a") == want
    rng.shuffle(rows)
    assert query(spark, rows, tmp_path / "b", 1) == want


def test_conversation_that_vanishes_and_empty_table(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert query(spark, [(gone, 0, "user", "x.")], tmp_path / "a") == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert query(spark, [], tmp_path / "b") == {}


def test_repaired_rows(spark):
    """The operator's own output: the edits themselves, with the texts."""
    df = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "user", " "),
                                (1, 3, "tool", "A."), (2, 0, "assistant", "B.")],
                               "c bigint, t bigint, r string, x string")
    got = R.repair(df, "c", "t", "r", "x").orderBy("conv", "step").collect()
    assert [(r.conv, r.edit, r.turn, r.role, r.text, r.fault) for r in got] == [
        (1, "K", 0, "system", "S.", None), (1, "K", 1, "user", "Q?", None), (1, "D", 2, None, None, "blank"),
        (1, "R", 3, "assistant", "A.", None), (2, "I", None, "user", "", None), (2, "K", 0, "assistant", "B.", None)]


def test_one_long_conversation_streams(spark, monkeypatch):
    """A conversation over many Arrow batches is one stream; its faults come from other tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(5, k, ("user", "assistant")[k % 2], f"text {k % 40}.") for k in range(300)]
        df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
        got = R.repair(df).agg(F.count("*").alias("n"), F.sum("cost").alias("cost")).first()
        faulty = [(t, r, x, R.DUPLICATE if t >= 40 else None) for _, t, r, x in rows]
        assert (got.cost, got.n) == (whole_strings(faulty)[0], 300)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
